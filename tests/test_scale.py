"""Plan-shape and hot-key checks: what must hold for the plan to survive a much larger input."""

import datetime as dt

from pyspark.sql import functions as F

from dividax.operators.aggregates import top_k_per_group
from dividax.operators.fx_join import FxIndex
from dividax.plans.report import build_report
from dividax.sources.fx import synthetic_fx
from dividax.sources.statements import synthetic_statements

from conftest import SF_SMALL


def _plan(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_exact_and_pre_aggregated(spark):
    # one (account, date, ticker) group holds more rows than all other groups together
    hot = spark.range(60000).select(
        F.concat(F.lit("H"), F.col("id").cast("string")).alias("id"), F.lit(0).alias("acct"),
        F.lit("PLN").alias("account_currency"), F.lit("Dividend").alias("Type"),
        F.lit(dt.datetime(2024, 1, 15, 10)).alias("Time"),
        F.lit("HOT.PL PLN 1.0000/ SHR").alias("Comment"), F.lit("HOT.PL").alias("Symbol"),
        F.lit(1.0).cast("decimal(18,6)").alias("Amount"))
    cold = spark.range(1000).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("id"), F.lit(1).alias("acct"),
        F.lit("PLN").alias("account_currency"), F.lit("Dividend").alias("Type"),
        F.lit(dt.datetime(2024, 1, 16, 10)).alias("Time"),
        F.concat(F.lit("T"), (F.col("id") % 50).cast("string"), F.lit(".PL PLN 2.0000/ SHR")).alias("Comment"),
        F.concat(F.lit("T"), (F.col("id") % 50).cast("string"), F.lit(".PL")).alias("Symbol"),
        F.lit(4.0).cast("decimal(18,6)").alias("Amount"))
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 12), 4.0)], "currency string, rate_date date, rate double")
    rep = build_report(hot.unionByName(cold), fx)
    rows = {r["ticker"]: r for r in rep.collect()}
    assert rows["HOT.PL"]["shares"] == 60000.0 and rows["HOT.PL"]["net_dividend"] == 60000.0
    assert len(rows) == 51
    plan = rep._jdf.queryExecution().executedPlan().toString()
    # every aggregation below an exchange is a partial one (map-side combine of hot keys)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            below = " ".join(lines[i + 1:i + 4])
            if "Aggregate" in below:
                assert "partial_" in below, below


def test_flagship_plan_shape(spark):
    stmt = synthetic_statements(spark, SF_SMALL)
    plan = _plan(build_report(stmt, FxIndex(synthetic_fx(spark, SF_SMALL))))
    assert plan.count("BroadcastHashJoin") >= 2            # both FX look-ups broadcast
    assert "SortMergeJoin" not in plan                    # no shuffle join of the statements
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    # the statement scan reads only the columns it needs
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l and "lineitem" in l][0]
    assert "l_extendedprice" not in scan and "l_returnflag" not in scan


def test_top_k_is_bounded_before_the_shuffle(spark):
    df = spark.range(50000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = top_k_per_group(df, ["g"], [F.col("v").desc()], 3)
    plan = _plan(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r["v"] for r in top.where("g = 0").collect()) == [49992, 49995, 49998]


def test_statement_filter_and_columns_reach_the_parquet_scan(spark, tmp_dir):
    path = f"{tmp_dir}/stmt.parquet"
    synthetic_statements(spark, SF_SMALL).write.parquet(path)
    stmt = spark.read.parquet(path)
    rep = build_report(stmt, FxIndex(synthetic_fx(spark, SF_SMALL)))
    plan = _plan(rep)
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l and "Comment#" in l][0]
    assert "PushedFilters: [" in scan and "In(Type" in scan      # F-1 evaluated by the reader
    read_schema = scan.split("ReadSchema:")[1]
    assert "id:" not in read_schema                               # unused columns never read


def test_materialize_cuts_lineage_into_the_checkpoint_folder(spark):
    from dividax.session import materialize
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").groupBy("o_orderstatus").count()
    out = materialize(src)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in plan            # read back from the reliable checkpoint
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, src.collect()))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_counted_samples_read_the_input_once_and_match_brute_force(spark, monkeypatch):
    import datetime as dt
    import random

    from dividax.operators import aggregates

    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "a", "b", None, "none"]), dt.date(2024, 1, rng.randint(1, 9)) if rng.random() < 0.9 else None, f"t{rng.randint(0, 50)}") for _ in range(3000)]
    rows = [(g, d, t, g != "none" and rng.random() < 0.6) for g, d, t in rows]
    df = spark.createDataFrame(rows, "g string, d date, t string, hit boolean").repartition(7)
    for held in (50_000, 1):
        monkeypatch.setattr(aggregates, "GROUPS_HELD", held)
        for every in (False, True):
            found = aggregates.counted_samples(df, ["g"], F.col("hit"), [F.col("d"), F.col("t")], F.col("t"), all_groups=every)
            expected = {}
            for g in {r[0] for r in rows}:
                hits = sorted((r for r in rows if r[0] == g and r[3]), key=lambda r: (r[1] is not None, r[1] or dt.date.min, r[2]))
                if hits or every:
                    expected[g] = (len(hits), ", ".join(r[2] for r in hits[:3]))
            assert {r.g: (r.groups, r.samples) for r in found.collect()} == expected
    assert _plan(aggregates.counted_samples(df, ["g"], F.col("hit"), [F.col("d")], F.col("t"))).split("Initial Plan")[0].count("MapInArrow") == 1
    assert aggregates.counted_samples(df.where("false"), ["g"], F.col("hit"), [F.col("d")], F.col("t")).collect() == []
