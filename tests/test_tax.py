"""Tax arithmetic literal tables (M-1, M-4, M-5, P-12, A-3, A-12)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dividax.functions.money import pct_display, round_half_even, shares_from_amount, tax_due_pln, wht_amount
from dividax.operators.aggregates import tax_by_month, tax_totals
from dividax.params import TaxParams

# net, rate, wht amount (None = "-"), fx (None = "-"), expected tax due (None = "-")
PLN_FORMULA = [
    (100.0, 0.0, None, None, 19.00), (100.0, 0.15, 15.0, None, 4.00), (100.0, 0.18, 18.0, None, 1.00),
    (100.0, 0.19, 19.0, None, None), (100.0, 0.25, 25.0, None, None), (50.0, 0.0, None, 4.0, 38.00),
    (68.0, 0.15, 12.0, 4.0, 3.68), (50.0, 0.15, 9.0, 0.6, 0.30), (33.33, 0.0, None, None, 6.33),
    (10.53, 0.0, None, None, 2.00), (0.01, 0.0, None, None, None), (1000.0, 0.0, None, None, 190.00),
]
USD_FORMULA = [
    (100.0, 0.0, None, 4.0, 76.00), (85.0, 0.15, 15.0, 4.0, 16.00), (81.0, 0.19, 19.0, 4.0, None), (70.0, 0.30, 30.0, 4.0, None),
]


@pytest.mark.parametrize("acct,table", [("PLN", PLN_FORMULA), ("EUR", PLN_FORMULA), ("USD", USD_FORMULA)])
def test_tax_due_tables(spark, acct, table):
    df = spark.createDataFrame([(n, r, w, x, acct) for n, r, w, x, _ in table],
                               "net double, rate double, wht double, fx double, acct string")
    got = [r[0] for r in df.select(tax_due_pln("net", "rate", "wht", "fx", "acct", 0.19)).collect()]
    assert got == [e for *_, e in table]


def test_tax_rate_parameter_validated():
    with pytest.raises(ValueError):
        TaxParams(tax_rate=1.5)
    assert TaxParams(tax_rate=0.2).tax_rate == 0.2


def test_shares_half_even_on_double(spark):
    # 5.7 / (0.57 * 4.0) = 2.5000000000000004 -> 3 shares; net = 3 * 0.57
    df = spark.createDataFrame([(5.7, 0.57, 4.0), (5.0, 2.0, 1.0), (7.0, 2.0, 1.0), (1.0, 0.0, 1.0)], "a double, d double, x double")
    got = [r[0] for r in df.select(shares_from_amount("a", "d", "x")).collect()]
    assert got == [3.0, 2.0, 4.0, 0.0]
    assert df.select(shares_from_amount("a", "d", "x") * F.col("d")).first()[0] == pytest.approx(1.71)


def test_wht_amount(spark):
    df = spark.createDataFrame([
        (85.0, 0.15, 0.0, "PLN"), (85.0, 0.15, -12.3, "USD"), (85.0, 0.0, -12.3, "USD"), (85.0, None, 0.0, "PLN"),
        (85.0, 1.0, 0.0, "PLN"), (85.0, 0.15, 0.0, "USD"),
    ], "net double, rate double, raw double, acct string")
    got = [r[0] for r in df.select(wht_amount("net", "rate", "raw", "acct")).collect()]
    assert got == [15.0, 12.3, None, None, None, 15.0]


def test_pct_display(spark):
    df = spark.createDataFrame([(0.156,), (0.15,), (0.0,), (None,), (0.29,), (0.3,)], "r double")
    assert [r[0] for r in df.select(pct_display("r")).collect()] == ["15%", "15%", "-", "-", "28%", "30%"]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.5,), (-1.005,)], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [0.12, 0.14, 2.5, -1.0]


def test_monthly_totals(spark):
    rep = spark.createDataFrame([
        *[(0, dt.date(2024, m, d), 19.0, 100.0, None, 1.0, False) for m, d in [(1, 5), (1, 9), (2, 5), (2, 6), (3, 5)]],
        (0, dt.date(2024, 3, 7), 19.0, 100.0, None, 4.0, False),
        (0, dt.date(2024, 3, 8), 5.0, 70.0, None, None, True), (0, dt.date(2024, 4, 1), None, 0.0, None, None, False),
    ], "acct int, date date, tax_due_pln double, net_dividend double, fx_rate_d1 double, fx_rate_gross double, quarantined boolean")
    m = {(r["acct"], r["month"]): r["total_tax_pln"] for r in tax_by_month(rep).collect()}
    assert m[(0, "2024-01")] == 38.0 and m[(0, "2024-02")] == 38.0 and m[(None, None)] == 114.0 and m[(0, "2024-04")] == 0.0
    t = tax_totals(rep).first()
    assert (t["total_tax_pln"], t["gross_pln_reported"], t["net_after_tax_pln"]) == (114.0, 600.0, 486.0)
    assert (t["gross_pln_converted"], t["report_rows"], t["unconverted_rows"], t["quarantined_rows"]) == (900.0, 7, 1, 1)
