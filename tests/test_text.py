"""Literal cases of the comment / ticker parsers (T-1, T-3, J-5, J-6, J-7, T-8, T-5..T-7)."""

import pytest
from pyspark.sql import functions as F

from dividax.functions import text as T

PER_SHARE = [
    ("SBUX.US USD WHT 15% 0.3000/ SHR", 0.3, "USD"),
    ("SBUX.US USD WHT 15%", None, "USD"),
    ("TXT.PL PLN WHT 19% 1.2000/ SHR", 1.2, "PLN"),
    ("MSFT.US USD 0.7500/ SHR", 0.75, "USD"),
    ("1.2300 EUR/SHR", 1.23, "EUR"),
    ("some text 2.50 more text", 2.5, None),
    (".", None, None),
    ("", None, None),
    ("no digits here", None, None),
    (None, None, None),
    ("ABC.US 1.2.3 ", None, None),
]


def test_per_share_cascade(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in PER_SHARE], "comment string")
    p = T.per_share_from_comment("comment")
    got = {r["comment"]: (r["dps"], r["currency"]) for r in df.select("comment", p["dps"].alias("dps"), p["currency"].alias("currency")).collect()}
    for comment, dps, cur in PER_SHARE:
        assert got[comment] == (dps, cur), comment


WHT = [
    ("SBUX.US USD WHT 15%", 0.15), ("WHT 27%", 0.27), ("WHT 0%", 0.0), ("WHT 7.5%", 0.075),
    ("some text 19%", 0.19), ("15% withholding applied", 0.15), ("WHT 15% of 30% gross", 0.15),
    ("SBUX.US USD 0.5700/ SHR", None), ("", None), (None, None),
]


def test_wht_rate(spark):
    df = spark.createDataFrame([(c,) for c, _ in WHT], "comment string")
    got = {r[0]: r[1] for r in df.select("comment", T.wht_rate_from_comment("comment")).collect()}
    for comment, rate in WHT:
        if rate is None:
            assert got[comment] is None, comment
        else:
            assert got[comment] == pytest.approx(rate), comment


DEFAULT_WHT = [("AAPL.US", .15), ("PKO.PL", .19), ("NOVOB.DK", .15), ("HSBA.UK", 0.0), ("CRH.IE", .15),
               ("AIR.FR", 0.0), ("SAP.DE", 0.0), ("ASML.NL", 0.0), ("XYZ.ZZ", 0.0), ("ASB.PL", 0.0)]


def test_default_wht(spark):
    df = spark.createDataFrame([(t,) for t, _ in DEFAULT_WHT], "ticker string")
    got = dict(df.select("ticker", T.default_wht_rate("ticker")).collect())
    assert got == dict(DEFAULT_WHT)


CURRENCY = [("A.US", "USD"), ("A.PL", "PLN"), ("A.DK", "DKK"), ("A.UK", "GBP"), ("ASB.PL", "USD"), ("UNKNOWN", "USD"),
            ("X.USD", "USD")] + [(f"A{s}", "EUR") for s in (".FR", ".DE", ".IE", ".NL", ".ES", ".IT", ".BE", ".AT", ".FI", ".PT")]


def test_ticker_currency(spark):
    df = spark.createDataFrame([(t,) for t, _ in CURRENCY], "ticker string")
    got = dict(df.select("ticker", T.ticker_currency("ticker")).collect())
    assert got == dict(CURRENCY)


def test_dividend_currency_prefers_comment(spark):
    df = spark.createDataFrame([("A.US", "EUR"), ("A.US", None), ("A.PL", "")], "ticker string, cur string")
    got = [r[0] for r in df.select(T.dividend_currency(F.col("ticker"), F.col("cur"))).collect()]
    assert got == ["EUR", "USD", "PLN"]


def test_amount_label(spark):
    rows = [(5.7, "SBUX.US", "5.7 USD"), (3.2, "TKT.PL", "3.2 PLN"), (8.1, "NOVOB.DK", "8.1 DKK"), (12.0, "SHEL.UK", "12.0 GBP")]
    df = spark.createDataFrame([(v, t) for v, t, _ in rows], "v double, t string")
    got = [r[0] for r in df.select(T.amount_text(F.col("v"), T.ticker_currency("t"))).collect()]
    assert got == [e for _, _, e in rows]


def test_keyword_label(spark):
    df = spark.createDataFrame([("Blik top up",), ("PEKAO transfer",), ("Bliki",), ("plain",), (None,)], "c string")
    got = [r[0] for r in df.select(T.keyword_label("c")).collect()]
    assert got == ["Blik(Payu) deposit", "Pekao S.A. deposit", "Bliki", "plain", None]


def test_strip_ansi(spark):
    df = spark.createDataFrame([("\x1b[31mAAPL.US\x1b[0m",), ("MSFT.US",)], "t string")
    assert [r[0] for r in df.select(T.strip_ansi("t")).collect()] == ["AAPL.US", "MSFT.US"]


def test_amount_text_parsers(spark):
    df = spark.createDataFrame([("6.84 USD",), ("-",), ("nan",), (None,), ("1 2 3",), ("x USD",)], "s string")
    got = df.select(T.parse_amount_text("s")["value"], T.parse_wht_amount_text("s"), T.parse_fx_text("s")).collect()
    assert [tuple(r) for r in got] == [
        (6.84, 6.84, 6.84), (None, 0.0, 1.0), (None, 0.0, 1.0), (None, 0.0, 1.0), (None, None, None), (None, None, None)]


def test_chart_helpers(spark):
    df = spark.createDataFrame([("1.71 USD",), ("3.2 PLN",), ("-4.5 EUR",)], "s string")
    got = [tuple(r) for r in df.select(T.currency_symbol("s"), T.digits_only_number("s")).collect()]
    assert got == [("$", 1.71), ("PLN", 3.2), ("", 4.5)]
