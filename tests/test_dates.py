"""Date parsing and the previous-business-day rule (C-1, C-4) against brute force."""

import datetime as dt


from dividax.functions import dates as D


def test_parse_statement_date(spark):
    rows = ["12.01.2024 10:30:00", "1.2.2024 1:02:03", "", "   ", None, "29.02.2023 10:00:00", "garbage"]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    got = [r[0] for r in df.select(D.parse_statement_date("s")).collect()]
    assert got == [dt.date(2024, 1, 12), dt.date(2024, 2, 1), None, None, None, None, None]


def _brute_prev_bday(d):
    p = d - dt.timedelta(days=1)
    while p.weekday() >= 5:
        p -= dt.timedelta(days=1)
    return p


def test_previous_business_day_brute_force(spark):
    days = [dt.date(2023, 12, 1) + dt.timedelta(days=i) for i in range(400)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = dict(df.select("d", D.previous_business_day("d")).collect())
    assert all(got[d] == _brute_prev_bday(d) for d in days)


def test_business_day_index(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(21)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    idx = dict(df.select("d", D.business_day_index("d")).collect())
    wk = [d for d in days if d.weekday() < 5]
    assert all(idx[b] - idx[a] == 1 for a, b in zip(wk, wk[1:]))
    assert idx[dt.date(2024, 1, 6)] == idx[dt.date(2024, 1, 8)]  # Saturday shares next Monday's ordinal


def test_month_and_iso(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),)], "d date")
    assert df.select(D.month_key("d"), D.iso_date("d")).first() == ("2024-03", "2024-03-09")
