"""Date expressions (C-1 .. C-5).  All are native Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted text layout of statement time stamps ("dd.mm.YYYY HH:MM:SS"); the
#: one-letter fields also accept 1-digit day/month/hour values.
STATEMENT_TIME_FORMAT = "d.M.yyyy H:m:s"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_statement_date(text: Column | str, fmt: str = STATEMENT_TIME_FORMAT) -> Column:
    """C-1: text time stamp -> DATE; empty, blank, null or malformed -> NULL (never raises)."""
    t = F.trim(_col(text))
    return F.when(t == "", F.lit(None).cast("date")).otherwise(
        F.try_to_timestamp(t, F.lit(fmt)).cast("date")
    )


def coerce_date(value: Column | str, formats: tuple[str, ...] = (STATEMENT_TIME_FORMAT, "yyyy-MM-dd", "yyyy-MM-dd H:m:s")) -> Column:
    """C-2: a column that may hold a timestamp, a date or text -> DATE, bad -> NULL.

    Text is tried against each accepted layout in turn, left out where its dots or colons already rule it out
    (a failed parse costs many times one that succeeds)."""
    c = F.trim(_col(value).cast("string"))

    def parsed(layout: str) -> Column:
        date = F.try_to_timestamp(c, F.lit(layout)).cast("date")
        if set(layout) - set("yMdHms-.:/ "):  # other fields may hold any sign
            return date
        fits = [c.contains(sign) if sign in layout else ~c.contains(sign) for sign in ".:"]
        return F.when(fits[0] & fits[1], date)

    return F.coalesce(*[parsed(f) for f in formats])


def to_date_only(ts: Column | str) -> Column:
    """C-3: timestamp -> date (time of day dropped)."""
    return F.to_date(_col(ts))


def previous_business_day(d: Column | str) -> Column:
    """C-4: the day before ``d``, skipping Saturday and Sunday (no holiday calendar).

    Spark ``dayofweek``: 1 = Sunday .. 7 = Saturday."""
    d = _col(d)
    dow = F.dayofweek(d)
    back = F.when(dow == 2, 3).when(dow == 1, 2).otherwise(1)
    return F.date_sub(d, back)


def iso_date(d: Column | str) -> Column:
    """C-5: ISO date text."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def month_key(d: Column | str) -> Column:
    """C-5: ``yyyy-MM`` month key."""
    return F.date_format(_col(d), "yyyy-MM")


# Business-day ordinal used by the bounded as-of FX look-up.  Day 0 is 1900-01-01,
# a Monday; Saturday and Sunday share the ordinal of the following Monday.
_EPOCH_MONDAY = "1900-01-01"


def business_day_index(d: Column | str) -> Column:
    """Ordinal of weekdays: consecutive weekdays differ by 1, a weekend maps to next Monday."""
    n = F.datediff(_col(d), F.lit(_EPOCH_MONDAY).cast("date"))
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def is_weekday(d: Column | str) -> Column:
    dow = F.dayofweek(_col(d))
    return (dow >= 2) & (dow <= 6)
