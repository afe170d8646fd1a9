"""FX sources and the bounded as-of look-up (S-8..S-11, J-1..J-3) against a brute-force probe loop."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from dividax.operators.fx_join import FxIndex, serving_table
from dividax.params import TaxParams
from dividax.sources.fx import fx_long, read_fx_archives


def _probe(rates, currency, target):
    """The definition: the latest published day among the target and the nine weekdays before it."""
    if currency == "PLN":
        return 1.0
    days = [target - dt.timedelta(days=i) for i in range(1, 20)]
    eligible = {target, *[d for d in days if d.weekday() < 5][:9]}
    published = {d: rate for (c, d), rate in rates.items() if c == currency and d in eligible}
    return published[max(published)] if published else None


def test_asof_matches_probe_loop(spark):
    rnd = random.Random(7)
    start = dt.date(2023, 1, 1)
    rates = {}
    for cur in ("USD", "EUR"):
        for i in range(300):
            d = start + dt.timedelta(days=i)
            # sparse publication with long gaps, and a few weekend-dated rates
            if (d.weekday() < 5 and rnd.random() < 0.6) or (d.weekday() >= 5 and rnd.random() < 0.05):
                rates[(cur, d)] = round(rnd.uniform(3, 5), 4)
    fx = spark.createDataFrame([(c, d, r) for (c, d), r in rates.items()], "currency string, rate_date date, rate double")
    targets = [(c, start + dt.timedelta(days=i)) for c in ("USD", "EUR", "PLN", "SEK") for i in range(-5, 320)]
    t = spark.createDataFrame(targets, "currency string, target_date date")
    idx = FxIndex(fx)
    got = {(r[0], r[1]): r[2] for r in idx.lookup(t, F.col("currency"), F.col("target_date"), "rate").collect()}
    for c, d in targets:
        assert got[(c, d)] == _probe(rates, c, d), (c, d)
    assert idx.broadcastable and idx.rows > 0


def test_saturday_uses_friday(spark):
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 12), 4.01)], "currency string, rate_date date, rate double")
    t = spark.createDataFrame([("USD", dt.date(2024, 1, 13))], "currency string, target_date date")
    assert FxIndex(fx).lookup(t, F.col("currency"), F.col("target_date"), "rate").first()["rate"] == 4.01


def test_broadcast_bound_falls_back_to_shuffle_join(spark):
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 12), 4.01)], "currency string, rate_date date, rate double")
    idx = FxIndex(fx, TaxParams(broadcast_max_rows=0))
    assert not idx.broadcastable
    t = spark.createDataFrame([("USD", dt.date(2024, 1, 15)), (None, dt.date(2024, 1, 15)), ("PLN", None)],
                              "currency string, target_date date")
    got = sorted((r["currency"] or "", r["rate"] if r["rate"] is not None else -1.0)
                 for r in idx.lookup(t, F.col("currency"), F.col("target_date"), "rate").collect())
    assert got == [("", -1.0), ("PLN", 1.0), ("USD", 4.01)]


def _write(path, text):
    with open(path, "w", encoding="iso-8859-1") as f:
        f.write(text)


def test_archive_reader_first_file_wins_and_header_order(spark, tmp_dir):
    a = os.path.join(tmp_dir, "archiwum_tab_a_2023.csv")
    b = os.path.join(tmp_dir, "archiwum_tab_a_2024.csv")
    c = os.path.join(tmp_dir, "archiwum_tab_a_2025.csv")
    _write(a, "data;1USD;1EUR;1GBP;1DKK\nnazwa;1 dolar;1 euro;1 funt;1 korona\n20240105;4,0100;4,3500;5,0000;0,5800\n20240108;3,9900;;5,1000;abc\n")
    # different column order, and a duplicate of 2024-01-05 that must lose (later file)
    _write(b, "data;1EUR;1USD\n20240105;9,9900;9,9900\n20240109;4,4000;4,0200\n")
    _write(c, "wrong_col;1USD\n20240110;4,0000\n")
    wide = read_fx_archives(spark, [b, a, c, os.path.join(tmp_dir, "missing.csv")])
    got = {(r["currency"], r["rate_date"]): r["rate"] for r in fx_long(wide).collect()}
    assert got[("USD", dt.date(2024, 1, 5))] == 4.01
    assert got[("EUR", dt.date(2024, 1, 5))] == 4.35
    assert got[("USD", dt.date(2024, 1, 9))] == 4.02 and got[("EUR", dt.date(2024, 1, 9))] == 4.4
    assert ("EUR", dt.date(2024, 1, 8)) not in got and ("DKK", dt.date(2024, 1, 8)) not in got
    assert ("USD", dt.date(2024, 1, 10)) not in got
    assert len(got) == 8


def test_serving_table_is_bounded(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60) if (dt.date(2024, 1, 1) + dt.timedelta(days=i)).weekday() < 5]
    fx = spark.createDataFrame([("USD", d, 1.0) for d in days], "currency string, rate_date date, rate double")
    n = serving_table(fx).count()
    assert n <= 14 * len(days)


def test_archive_discovery_ignores_other_files(spark, tmp_dir):
    from dividax.sources.fx import archive_glob
    _write(os.path.join(tmp_dir, "archiwum_tab_a_2024.csv"), "data;1USD\n20240105;4,0100\n")
    _write(os.path.join(tmp_dir, "other_2024.csv"), "data;1USD\n20240105;9,9900\n")
    got = fx_long(read_fx_archives(spark, archive_glob(tmp_dir))).collect()
    assert [(r["currency"], r["rate"]) for r in got] == [("USD", 4.01)]
    assert read_fx_archives(spark, archive_glob(os.path.join(tmp_dir, "nothing-here"))).count() == 0


def test_quoted_archive_and_skipped_files(spark, tmp_dir):
    from dividax.sources.fx import skipped_archives
    a, b = (os.path.join(tmp_dir, f"archiwum_tab_a_{y}.csv") for y in (2023, 2024))
    _write(a, '"data";"note";"1USD"\n"20240105";"a ""x""; y";"4,0100"\n')
    _write(b, "date;1USD\n20240108;9,9900\n")
    with open(a, "rb") as f:
        text = f.read()
    with open(a, "wb") as f:
        f.write(b"\xef\xbb\xbf" + text)
    got = [(r["currency"], r["rate_date"], r["rate"]) for r in fx_long(read_fx_archives(spark, [a, b])).collect()]
    assert got == [("USD", dt.date(2024, 1, 5), 4.01)]
    assert [r["file_name"].rsplit("/", 1)[-1] for r in skipped_archives(spark, [a, b]).collect()] == ["archiwum_tab_a_2024.csv"]


def test_jobs_share_a_stored_index_and_leave_nothing_cached(spark, tmp_dir):
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 12), 4.01)], "currency string, rate_date date, rate double")
    other = spark.createDataFrame([("USD", dt.date(2024, 1, 12), 5.0)], "currency string, rate_date date, rate double")
    t = spark.createDataFrame([("USD", dt.date(2024, 1, 15))], "currency string, target_date date")
    path = f"{tmp_dir}/rates-v1"
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    for source in (fx, other):  # the second job finds the first one's build
        index = FxIndex.stored(source, path)
        assert index.lookup(t, F.col("currency"), F.col("target_date"), "rate").first()["rate"] == 4.01
    assert FxIndex.open(spark, path).rows == index.rows > 0
    assert FxIndex.stored(other, f"{tmp_dir}/rates-v2").lookup(t, F.col("currency"), F.col("target_date"), "rate").first()["rate"] == 5.0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_hot_keys_beyond_the_broadcast_bound_equal_the_probe_loop(spark):
    """Weekend rates and look-ups, a key with a third of the rows, rows that need no rate, unknown currencies."""
    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    fx = [(c, start + dt.timedelta(days=d), round(rng.uniform(1, 9), 4)) for c in ("USD", "EUR", "GBP") for d in range(120) if rng.random() < (0.6 if d % 7 < 5 else 0.1) and not 40 <= d <= 60]
    rows = [(rng.choice(["USD", "EUR", "GBP", "PLN", "XXX", None]), start + dt.timedelta(days=rng.randrange(-5, 130))) for _ in range(2000)]
    rows += [("USD", start + dt.timedelta(days=8))] * 1500 + [(None, None)] * 500
    rates = spark.createDataFrame(fx, "currency string, rate_date date, rate double")
    targets = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, currency string, target_date date")
    known = {(c, d): r for c, d, r in fx}
    expected = {i: _probe(known, c, d) if c else None for i, (c, d) in enumerate(rows)}
    for bound in (10_000_000, 0):
        got = FxIndex(rates, TaxParams(broadcast_max_rows=bound)).lookup(targets, F.col("currency"), F.col("target_date"), "rate")
        assert got.columns == ["id", "currency", "target_date", "rate"]
        assert {r["id"]: r["rate"] for r in got.collect()} == expected
    assert "Generate" not in got._jdf.queryExecution().toString()  # no copies of the rates
