"""Data-quality operators (F-4, F-6, F-7, F-9, F-11, F-13, F-14)."""

import datetime as dt

import pytest

from dividax.operators import quality as Q


def test_row_level_checks(spark):
    rows = spark.createDataFrame([
        (dt.date(2024, 1, 5), 10.0, "c", dt.date(2024, 1, 4)),
        (dt.date(2024, 1, 6), 10.0, "c", None),          # F-4: data but no D-1
        (None, 10.0, "c", None),                         # no date: not a candidate
    ], "date date, net_dividend double, comment string, date_d1 date")
    assert Q.missing_d1(rows).count() == 1
    with pytest.raises(ValueError, match="Date D-1"):
        Q.raise_if_any(Q.missing_d1(rows), "'Date D-1' value is missing")


def test_merged_level_checks(spark):
    merged = spark.createDataFrame([
        (0, dt.date(2024, 1, 5), "A.US", 0.30, "comment"),
        (0, dt.date(2024, 1, 6), "BUSY.PL", 0.30, "comment"),   # "US" as a substring counts (original rule)
        (0, dt.date(2024, 1, 7), "C.UK", 0.0, "default"),
        (0, dt.date(2024, 1, 8), "D.DE", None, "default"),
        (1, dt.date(2024, 1, 9), "E.US", 0.15, "comment"),
    ], "acct int, date date, ticker string, wht_rate double, rate_source string")
    assert sorted(r["ticker"] for r in Q.wht_anomalies(merged).collect()) == ["C.UK", "D.DE"]   # F-6
    assert [r["ticker"] for r in Q.invalid_rates(merged).collect()] == ["D.DE"]                 # F-9
    us = {r["acct"]: r for r in Q.us_30pct(merged).collect()}                                   # F-7
    assert us[0]["groups"] == 2 and us[0]["examples"] == "A.US, BUSY.PL" and 1 not in us


def test_contracts_and_duplicates(spark):
    stmt = spark.createDataFrame([
        ("1", "Dividend", "A.US", "c"), ("1", "Deposit", None, None), ("2", "Dividend", "bad ticker", None), (None, None, "X", "c"),
    ], "id string, Type string, Symbol string, Comment string")
    assert [(r["id"], r["n"]) for r in Q.duplicate_ids(stmt).collect()] == [("1", 2)]          # F-11
    got = {r["rule"]: r["violations"] for r in Q.input_contract(stmt).collect()}                # F-12/F-13
    assert got == {"null_id": 1, "null_type": 1, "bad_ticker": 1, "null_comment": 1}
    rep = spark.createDataFrame([(dt.date(2024, 1, 5), 1.0, "A.US", -1.0), (None, None, "a b", None)],
                                "date date, net_dividend double, ticker string, shares double")
    out = {r["rule"]: r["violations"] for r in Q.output_contract(rep).collect()}                # F-14
    assert out == {"null_date": 1, "null_net": 1, "bad_ticker": 1, "null_shares": 1, "negative_shares": 1}
