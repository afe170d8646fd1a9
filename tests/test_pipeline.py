"""Flagship pipeline: fixture counts, quarantine, metamorphic relations and plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dividax.operators.fx_join import FxIndex
from dividax.plans.report import build_report, build_report_parts
from dividax.sources.fx import synthetic_fx
from dividax.sources.statements import synthetic_statements

from conftest import SF_SMALL


def test_fixture_sizes(spark):
    assert synthetic_statements(spark, SF_SMALL).count() == 9617
    assert synthetic_fx(spark, SF_SMALL).groupBy("currency").count().collect()[0]["count"] == 726


def test_report_and_quarantine_partition_the_groups(spark):
    parts = build_report_parts(synthetic_statements(spark, SF_SMALL), synthetic_fx(spark, SF_SMALL))
    merged, rep, quar = parts.merged.count(), parts.report.count(), parts.quarantine.count()
    assert merged == rep + quar and quar > 0
    late = parts.quarantine.agg(F.max("date")).first()[0]
    assert late > dt.date(2001, 7, 31)  # rates end 2001-07-31: the late rows are quarantined


def _stmt_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, acct int, account_currency string, Type string, Time timestamp, Comment string, Symbol string, Amount double")


BASE = [
    ("1", 0, "PLN", "Dividend", dt.datetime(2024, 1, 15, 10), "SBUX.US USD 0.5700/ SHR", "SBUX.US", 22.8),
    ("2", 0, "PLN", "Withholding Tax", dt.datetime(2024, 1, 15, 10), "SBUX.US USD WHT 15%", "SBUX.US", -3.42),
    ("3", 0, "PLN", "Dividend", dt.datetime(2024, 1, 16, 10), "TXT.PL PLN 1.2000/ SHR", "TXT.PL", 12.0),
    ("4", 0, "PLN", "Dividend", dt.datetime(2024, 1, 17, 10), "HSBA.UK GBP 0.5000/ SHR", "HSBA.UK", 10.0),
]
FX = [("USD", dt.date(2024, 1, 12), 4.0), ("GBP", dt.date(2024, 1, 16), 5.0)]


def _report(spark, rows):
    fx = spark.createDataFrame(FX, "currency string, rate_date date, rate double")
    return {(r["ticker"], r["date"]): r for r in build_report(_stmt_rows(spark, rows), fx).collect()}


def test_small_statement(spark):
    rep = _report(spark, BASE)
    sbux = rep[("SBUX.US", dt.date(2024, 1, 15))]
    # 22.8 PLN / (0.57 USD * 4.0) = 10 shares, net 5.7 USD, rate 15 %, WHT 1.01, tax (5.7*.19-1.01)*4.0
    assert (sbux["shares"], sbux["net_dividend"], sbux["wht_rate"], sbux["wht_pct"]) == (10.0, 5.7, 0.15, "15%")
    assert sbux["wht_amount"] == 1.01 and sbux["fx_rate_d1"] == 4.0 and sbux["tax_due_pln"] == 0.29
    assert sbux["date_d1"] == dt.date(2024, 1, 12)
    uk = rep[("HSBA.UK", dt.date(2024, 1, 17))]
    assert uk["wht_pct"] == "-" and uk["wht_amount"] is None and uk["tax_due_pln"] == round(10.0 * 0.19 * 5.0, 2)
    pl = rep[("TXT.PL", dt.date(2024, 1, 16))]
    assert pl["date_d1"] is None and pl["tax_due_pln"] is None


def test_metamorphic_permutation_and_duplication(spark):
    base = _report(spark, BASE)
    perm = _report(spark, list(reversed(BASE)))
    assert base == perm
    dup = _report(spark, BASE + [(f"{r[0]}b",) + r[1:] for r in BASE])
    for k, r in base.items():
        assert dup[k]["shares"] == 2 * r["shares"]
        assert dup[k]["net_dividend"] == pytest.approx(2 * r["net_dividend"])
        if r["tax_due_pln"] is not None:
            # WHT is cut to 2 dp before the tax formula (stage rounding), amplified by the FX rate
            assert dup[k]["tax_due_pln"] == pytest.approx(2 * r["tax_due_pln"], abs=0.1)


def test_first_comment_rate_wins(spark):
    rows = BASE + [("5", 0, "PLN", "Withholding Tax", dt.datetime(2024, 1, 15, 10), "SBUX.US USD WHT 30%", "SBUX.US", -1.0)]
    rep = _report(spark, rows)
    # both tax legs have type "Withholding Tax": the smaller comment ("...WHT 15%") wins
    assert rep[("SBUX.US", dt.date(2024, 1, 15))]["wht_rate"] == 0.15


def test_plan_shape(spark):
    stmt = synthetic_statements(spark, SF_SMALL)
    rep = build_report(stmt, FxIndex(synthetic_fx(spark, SF_SMALL)))
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_strict_mode_raises_on_missing_fx(spark):
    from dividax.operators.quality import ReportChecks, assert_complete
    fx = spark.createDataFrame(FX, "currency string, rate_date date, rate double")
    ok = build_report_parts(_stmt_rows(spark, BASE), fx)
    assert_complete(ok)
    late = BASE + [("9", 0, "PLN", "Dividend", dt.datetime(2024, 3, 15, 10), "SBUX.US USD 0.5700/ SHR", "SBUX.US", 22.8)]
    with pytest.raises(ValueError, match="exchange rate"):
        assert_complete(build_report_parts(_stmt_rows(spark, late), fx))
    for materialized in (False, True):  # the same, counted in the report's own pass
        checks = ReportChecks()
        parts = build_report_parts(_stmt_rows(spark, late), fx, materialized=materialized, checks=checks)
        parts.report.collect()
        found = checks.violations()
        assert found["missing_fx"][0] == parts.quarantine.count() == 1 and "SBUX.US" in found["missing_fx"][1]
        assert found["missing_d1"] == (0, None)
        with pytest.raises(ValueError, match="exchange rate"):
            checks.raise_if_any()
    with pytest.raises(ValueError):
        build_report_parts(None, fx)


def test_zero_fx_rate_gives_zero_shares_and_is_reported(spark):
    from dividax.operators.aggregates import zero_denominator_report
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 12), 0.0)], "currency string, rate_date date, rate double")
    parts = build_report_parts(_stmt_rows(spark, BASE[:2]), fx)
    rep = parts.report.first()
    assert rep["shares"] == 0.0 and rep["net_dividend"] == 0.0
    z = zero_denominator_report(parts.rows).first()
    assert z["zero_denominator_rows"] == 1 and z["samples"] == "SBUX.US on 2024-01-12"


def test_statement_schema_contract(spark):
    from dividax.operators.quality import schema_problems
    stmt = synthetic_statements(spark, SF_SMALL)
    assert schema_problems(stmt) == []
    assert schema_problems(stmt, strict=True) == ["unexpected column acct", "unexpected column account_currency"]
    bad = stmt.drop("Comment").withColumn("Amount", F.col("Amount").cast("double"))
    assert schema_problems(bad) == ["missing column Comment", "Amount: double != decimal(18,6)"]


def test_metamorphic_split_additivity_and_fully_taxed_insertion(spark):
    base = _report(spark, BASE)
    # splitting a dividend amount over two rows with the same key changes nothing
    split = [r for r in BASE if r[0] != "3"] + [
        ("3a", 0, "PLN", "Dividend", dt.datetime(2024, 1, 16, 10), "TXT.PL PLN 1.2000/ SHR", "TXT.PL", 4.8),
        ("3b", 0, "PLN", "Dividend", dt.datetime(2024, 1, 16, 10), "TXT.PL PLN 1.2000/ SHR", "TXT.PL", 7.2)]
    assert _report(spark, split) == base
    # a ticker already taxed at 30 % at source adds a row but no tax due
    taxed = BASE + [
        ("8", 0, "PLN", "Dividend", dt.datetime(2024, 1, 18, 10), "KO.US USD 0.5000/ SHR", "KO.US", 20.0),
        ("9", 0, "PLN", "Withholding Tax", dt.datetime(2024, 1, 18, 10), "KO.US USD WHT 30%", "KO.US", -6.0)]
    fx = spark.createDataFrame(FX + [("USD", dt.date(2024, 1, 17), 4.0)], "currency string, rate_date date, rate double")
    got = {(r["ticker"], r["date"]): r for r in build_report(_stmt_rows(spark, taxed), fx).collect()}
    ko = got[("KO.US", dt.date(2024, 1, 18))]
    assert ko["tax_due_pln"] is None and ko["wht_pct"] == "30%" and ko["date_d1"] is None and ko["fx_rate_d1"] is None
    assert {k: v for k, v in got.items() if k[0] != "KO.US"} == base


def test_shuffle_join_fallback_matches_broadcast(spark):
    from dividax.params import TaxParams
    stmt = synthetic_statements(spark, SF_SMALL)
    fx = synthetic_fx(spark, SF_SMALL)
    a = build_report(stmt, FxIndex(fx))
    b = build_report(stmt, FxIndex(fx, TaxParams(broadcast_max_rows=0)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_tax_rate_parameter_flows_through_the_report(spark):
    from dividax.params import TaxParams
    rows = BASE + [
        ("8", 0, "PLN", "Dividend", dt.datetime(2024, 1, 18, 10), "KO.US USD 0.5000/ SHR", "KO.US", 20.0),
        ("9", 0, "PLN", "Withholding Tax", dt.datetime(2024, 1, 18, 10), "KO.US USD WHT 19%", "KO.US", -3.8)]
    fx = spark.createDataFrame(FX + [("USD", dt.date(2024, 1, 17), 4.0)], "currency string, rate_date date, rate double")
    at19 = {r["ticker"]: r for r in build_report(_stmt_rows(spark, rows), fx).collect()}
    at25 = {r["ticker"]: r for r in build_report(_stmt_rows(spark, rows), fx, TaxParams(tax_rate=0.25)).collect()}
    assert at19["KO.US"]["tax_due_pln"] is None and at19["KO.US"]["date_d1"] is None
    ko = at25["KO.US"]
    # 10 shares x 0.50 USD; WHT 5.0/0.81*0.19 = 1.17; (5.0*0.25 - 1.17) * 4.0 = 0.32
    assert (ko["net_dividend"], ko["wht_amount"], ko["fx_rate_d1"], ko["tax_due_pln"]) == (5.0, 1.17, 4.0, 0.32)
    assert ko["date_d1"] == dt.date(2024, 1, 17)


def test_every_dividend_row_is_grouped_or_listed(spark):
    from dividax.operators.dividends import dropped_rows, filter_dividends, group_dividends, prepare_rows
    from dividax.sources.statements import damaged_statements, synthetic_statements

    rows = prepare_rows(damaged_statements(synthetic_statements(spark, "/root/testdata/sf0.001")))
    kept = filter_dividends(rows)
    total = lambda df, c: df.agg({c: "sum"}).first()[0]
    dropped = dropped_rows(rows)
    assert dropped.count() > 0
    assert total(kept, "amount") == total(dropped, "amount") + total(group_dividends(kept), "net_dividend")
