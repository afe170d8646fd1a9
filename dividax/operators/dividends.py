"""Dividend pipeline steps (F-1, F-2, F-3, A-1, P-8, C-4, T-1, T-2, J-4, M-1, M-2, T-3, A-2, A-3).

Every step is ``DataFrame -> DataFrame``.  Statements are identified by the
statement key columns (``acct``, ``account_currency``), which prefix every grouping
key, so any number of accounts runs in one job.

Shuffles: A-1 and the merged A-2/A-3 aggregation are the only two exchanges; both
use map-side partial aggregation (sum, min_by, max are all partial-aggregatable),
so a hot (account, date, ticker) group collapses to one row per map task before it
is shuffled.  FX look-ups are broadcast hash joins against the calendar-bounded
serving table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, NumericType, StringType, TimestampNTZType, TimestampType

from .. import constants as K
from ..functions.dates import coerce_date, previous_business_day
from ..functions.money import exact, round_half_even, shares_from_amount
from ..functions.text import (
    number_from_text,
    default_wht_rate,
    dividend_currency,
    keyword_label,
    per_share_columns,
    wht_rate_from_comment,
)
from ..params import TaxParams
from .columns import normalize_headers
from .fx_join import FxIndex

STATEMENT_KEYS = ("acct", "account_currency")
GROUP_COLUMNS = ("date", "ticker", "type", "comment")
ROW_KEYS = STATEMENT_KEYS + GROUP_COLUMNS
MERGE_KEYS = STATEMENT_KEYS + ("date", "ticker")


def _date_of(df: DataFrame, name: str):
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return c.cast("date")
    if isinstance(dtype, StringType):
        return coerce_date(c)  # text cells and, as ISO text, date cells of workbooks
    return F.lit(None).cast("date")


def prepare_rows(stmt: DataFrame) -> DataFrame:
    """P-2 + J-7 + C-1/C-3: canonical snake_case rows.

    Input: raw statement rows (English or Polish headers) with statement keys.
    Output: ``acct, account_currency, date, ticker, type, comment, amount``."""
    df = normalize_headers(stmt)
    return df.select(
        *STATEMENT_KEYS,
        _date_of(df, "Date").alias("date"),
        F.col("Ticker").cast("string").alias("ticker"),
        F.col("Type").cast("string").alias("type"),
        keyword_label(F.col("Comment").cast("string")).alias("comment"),
        F.col("Amount").alias("amount"),
    )


def filter_dividends(rows: DataFrame, type_col: str = "type") -> DataFrame:
    """F-1: keep dividend and withholding-tax rows (NULL type rejected)."""
    return rows.where(F.col(type_col).isin(*K.DIVIDEND_TYPES))


def group_dividends(rows: DataFrame) -> DataFrame:
    """A-1: sum ``amount`` per (statement, date, ticker, type, comment) -> ``net_dividend``.

    Rows with a NULL key are dropped (the original's group-by drops them) and listed by
    ``dropped_rows``; an all-NULL amount group sums to 0 as in the original."""
    dtype = rows.schema["amount"].dataType
    if isinstance(dtype, DecimalType):
        amount = F.col("amount")  # exact, order-insensitive sum
    elif isinstance(dtype, NumericType):
        amount = exact("amount")
    else:  # raw sheet text: malformed -> NULL
        amount = exact(number_from_text(F.col("amount")))
    keyed = rows.dropna(subset=list(GROUP_COLUMNS))
    total = F.coalesce(F.sum(amount), F.lit(0))
    return keyed.groupBy(*ROW_KEYS).agg(total.alias("net_dividend"))


def dropped_rows(rows: DataFrame) -> DataFrame:
    """The dividend rows that A-1 leaves out, with the names of their NULL keys in ``missing``."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in GROUP_COLUMNS])
    return filter_dividends(rows).withColumn("missing", missing).where(F.col("missing") != "")


def split_tax_rows(grouped: DataFrame) -> DataFrame:
    """P-5 + P-8: negative sums are withholding tax (``wht_raw``), their net becomes NULL.

    ``wht_raw`` keeps the exact type of the A-1 sum (DECIMAL for decimal input) so its
    later sum is order-insensitive; the net continues as DOUBLE like the original."""
    n = F.col("net_dividend")
    return grouped.withColumns({
        "wht_raw": F.when(n < 0, n),
        "net_dividend": F.when(n >= 0, n).cast("double"),
    })


def derive_shares(df: DataFrame, fx: FxIndex, params: TaxParams | None = None) -> DataFrame:
    """C-4 + T-1 + T-2 + J-4 + M-1 + M-2 (+ F-2, F-3, F-4 flags).

    Adds ``date_d1, dps, dividend_cur, shares, fx_missing_shares, zero_denominator``
    and replaces ``net_dividend`` by ``shares * dps`` on computed rows.  Each derived
    value is staged as a column once (conditional branches are not shared by
    common-subexpression elimination)."""
    params = params or TaxParams()
    parsed = per_share_columns(df, "comment", "dps", "_ps_cur").withColumn("date_d1", previous_business_day("date"))
    eligible = (
        F.col("date").isNotNull() & F.col("net_dividend").isNotNull() & F.col("comment").isNotNull()
        & F.col("dps").isNotNull() & (F.col("dps") > 0)
    )
    staged = parsed.withColumn("_eligible", F.coalesce(eligible, F.lit(False)))
    staged = staged.withColumn("dividend_cur", F.when(F.col("_eligible"), dividend_currency(F.col("ticker"), F.col("_ps_cur"))))
    cur = F.col("dividend_cur")
    foreign = (cur != K.BASE_CURRENCY) if params.convert_all_currencies else (cur == "USD")
    staged = staged.withColumn("_needs_fx", F.coalesce(
        F.col("_eligible") & (F.col("account_currency") == K.BASE_CURRENCY) & foreign, F.lit(False)))
    looked = fx.lookup(staged, F.when(F.col("_needs_fx"), cur), F.col("date_d1"), "_fx_shares")
    looked = looked.withColumn("_fx_used", F.when(F.col("_needs_fx"), F.col("_fx_shares")).otherwise(F.lit(1.0)))
    shares = F.when(F.col("_eligible"), shares_from_amount(F.col("net_dividend"), F.col("dps"), F.col("_fx_used")))
    with_shares = looked.withColumn("shares", shares)
    return with_shares.withColumns({
        "fx_missing_shares": F.col("_needs_fx") & F.col("_fx_shares").isNull(),
        "zero_denominator": F.col("_eligible") & F.coalesce(F.col("dps") * F.col("_fx_used") == 0, F.lit(False)),
        "net_dividend": F.when(F.col("_eligible"), F.col("shares") * F.col("dps")).otherwise(F.col("net_dividend")),
    }).drop("_ps_cur", "_eligible", "_needs_fx", "_fx_shares", "_fx_used")


def merge_rows(df: DataFrame) -> DataFrame:
    """T-3 + A-2 + A-3 in one aggregation per (statement, date, ticker).

    * rate: the first comment in (type, comment) order that yields a rate, rounded
      to 2 dp, else the ticker default (J-6) — ``min_by`` over a NULL-able ordering
      key replaces the original's order-dependent group loop
    * net, shares: sums (all-NULL -> 0), 2 dp; raw WHT amounts: sum
    """
    row_rate = round_half_even(wht_rate_from_comment("comment"), 2)
    with_rate = df.withColumn("_row_rate", row_rate)
    agg = with_rate.groupBy(*MERGE_KEYS).agg(
        F.coalesce(F.sum(exact("net_dividend")).cast("double"), F.lit(0.0)).alias("_net"),
        F.coalesce(F.sum("shares"), F.lit(0.0)).alias("_shares"),
        F.min_by(F.col("_row_rate"), F.when(F.col("_row_rate").isNotNull(), F.struct("type", "comment"))).alias("_comment_rate"),
        F.coalesce(F.sum("wht_raw").cast("double"), F.lit(0.0)).alias("wht_raw"),
        F.max(F.col("fx_missing_shares").cast("int")).cast("boolean").alias("fx_missing_shares"),
        F.count_if(F.col("zero_denominator")).alias("zero_denominator_rows"),
    )
    rate = F.coalesce(F.col("_comment_rate"), round_half_even(default_wht_rate("ticker"), 2))
    return agg.select(
        *MERGE_KEYS,
        round_half_even("_net", 2).alias("net_dividend"),
        round_half_even("_shares", 2).alias("shares"),
        round_half_even(rate, 2).alias("wht_rate"),
        F.when(F.col("_comment_rate").isNotNull(), F.lit("comment")).otherwise(F.lit("default")).alias("rate_source"),
        "wht_raw",
        "fx_missing_shares",
        "zero_denominator_rows",
    )
