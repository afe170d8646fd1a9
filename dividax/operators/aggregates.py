"""Report-level aggregations (A-4 .. A-14) and bounded samples.

Samples ("first 3 examples") never collect a whole group: ``counted_samples`` keeps
a count and ``k`` rows of each group in every task, and ``top_k_per_group`` filters
``row_number() <= k`` over the group, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so even a hot
group ships at most ``k`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.dates import iso_date, month_key
from ..functions.money import exact, round_half_even
from ..functions.text import currency_symbol, digits_only_number


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group in ``order`` (column ``_rank`` 1..k)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)


#: Groups whose counts and candidates a task holds before it hands them on.
GROUPS_HELD = 50_000
#: Spread of the tasks' candidates in front of the last grouping.
SPREAD = 64


def counted_samples(df: DataFrame, keys: Sequence[str], flag: Column, order: Sequence[Column], label: Column, k: int = 3,
                    count: str = "groups", out: str = "samples", all_groups: bool = False) -> DataFrame:
    """Per group: the number of flagged rows and the labels of the first ``k`` of them in ``order``, comma-joined.

    One pass over ``df``: every task counts and keeps the ``k`` first rows of each of its groups, so a
    group sends at most ``k`` rows and a count per task; these are merged in two groupings, the first
    spread by task.  NULLs sort first.  Groups without a flagged row are left out unless ``all_groups``."""
    names = [f"_o{i}" for i in range(len(order))]
    rows = df.select(*keys, *[c.alias(n) for n, c in zip(names, order)], label.cast("string").alias("_label"), F.coalesce(flag, F.lit(False)).alias("_flag"))
    rows = rows if all_groups else rows.where("_flag")
    schema = StructType([*(StructField(f.name, f.dataType) for f in rows.schema if f.name != "_flag"), StructField("_n", LongType())])

    def first_rows(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        numbers, first = None, None

        def held() -> Iterator:
            if numbers is not None:
                counted = numbers.reset_index(name="_n")
                for frame in (counted, first):
                    cells = [pa.array(frame[f.name], f.type, from_pandas=True) if f.name in frame else pa.nulls(len(frame), f.type) for f in arrow]
                    yield from pa.Table.from_arrays(cells, schema=arrow).to_batches()

        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas(types_mapper=pd.ArrowDtype)
            more = frame.groupby(list(keys), dropna=False)["_flag"].sum()
            found = frame[frame["_flag"]].drop(columns="_flag")
            if numbers is not None:
                more = pd.concat([numbers, more]).groupby(level=list(range(len(keys))), dropna=False).sum()
                found = pd.concat([first, found])
            numbers = more.astype("int64[pyarrow]")
            first = found.sort_values(names, na_position="first", kind="stable").groupby(list(keys), dropna=False).head(k)
            if len(numbers) > GROUPS_HELD:
                yield from held()
                numbers, first = None, None
        yield from held()

    # a task's rows are counts (with _n) and candidates (without)
    partial = rows.mapInArrow(first_rows, schema).withColumn("_spread", F.spark_partition_id() % SPREAD)
    candidates = F.collect_list(F.when(F.col("_n").isNull(), F.struct(*names, "_label")))
    some = partial.groupBy(*keys, "_spread").agg(F.sum("_n").alias("_n"), F.slice(F.array_sort(candidates), 1, k).alias("_first"))
    whole = some.groupBy(*keys).agg(F.sum("_n").alias(count), F.slice(F.array_sort(F.flatten(F.collect_list("_first"))), 1, k).alias("_first"))
    return whole.select(*keys, count, F.array_join(F.transform("_first", lambda s: s["_label"]), ", ").alias(out))


def zero_denominator_report(rows: DataFrame) -> DataFrame:
    """A-7: per account, rows whose share denominator was 0, with 3 ``ticker on date`` samples."""
    # samples in report row order (date, ticker), labelled with the look-up date (D-1)
    order = [F.col(c) for c in ("date", "ticker", "type", "comment")]
    label = F.concat(F.col("ticker"), F.lit(" on "), iso_date("date_d1"))
    return counted_samples(rows, ["acct"], F.col("zero_denominator"), order, label, count="zero_denominator_rows", all_groups=True)


def default_rate_fallbacks(merged: DataFrame) -> DataFrame:
    """A-9: groups that fell back to a non-zero ticker-default rate, with 3 samples."""
    flag = (F.col("rate_source") == "default") & (F.col("wht_rate") != 0)
    label = F.concat(F.col("ticker"), F.lit(" on "), iso_date("date"), F.lit(" ("),
                     F.round(F.col("wht_rate") * 100).cast("int").cast("string"), F.lit("%)"))
    return counted_samples(merged, ["acct"], flag, [F.col("date"), F.col("ticker")], label)


def zero_rate_tickers(merged: DataFrame) -> DataFrame:
    """A-8: groups on a 0 % default rate, as one row per (account, ticker) with its
    group count (the original logs the sorted distinct tickers; rows keep it
    distributed, and ``ORDER BY acct, ticker`` at the sink gives the sorted list)."""
    zr = merged.where((F.col("rate_source") == "default") & (F.col("wht_rate") == 0))
    return zr.groupBy("acct", "ticker").agg(F.count(F.lit(1)).alias("groups"))


def _pln(net: str, rate: Column) -> Column:
    return exact(net, 2) * rate.try_cast("decimal(18,4)")


def _total(amount: Column) -> Column:
    return round_half_even(F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)), 2)


def tax_totals(scored: DataFrame) -> DataFrame:
    """A-4 + A-5 + A-6 (+ F-8) per account, from the scored rows (``ReportParts.scored``).

    * total tax: sum of the 2-dp per-row amounts (NULL/``-`` skipped), 2 dp, 0.0 if none
    * gross PLN as reported: sum of net x FX, a masked FX counting 1.0
    * gross PLN converted: the same with the real rate of every row; rows without one are
      left out and counted in ``unconverted_rows``
    * net after tax = gross as reported - tax

    Quarantined rows are in none of the sums, only in ``quarantined_rows``."""
    ok = ~F.col("quarantined")
    agg = scored.groupBy("acct").agg(
        _total(F.when(ok, exact("tax_due_pln", 2))).alias("total_tax_pln"),
        _total(F.when(ok, _pln("net_dividend", F.coalesce("fx_rate_d1", F.lit(1.0))))).alias("gross_pln_reported"),
        _total(F.when(ok, _pln("net_dividend", F.col("fx_rate_gross")))).alias("gross_pln_converted"),
        F.count_if(ok).alias("report_rows"),
        F.count_if(ok & F.col("fx_rate_gross").isNull()).alias("unconverted_rows"),
        F.count_if("quarantined").alias("quarantined_rows"),
    )
    return agg.withColumn("net_after_tax_pln", round_half_even(F.col("gross_pln_reported") - F.col("total_tax_pln"), 2))


def tax_by_month(scored: DataFrame) -> DataFrame:
    """A-12: tax due per account and ``yyyy-MM`` month, with subtotals and a grand total (ROLLUP)."""
    ok = ~F.col("quarantined")
    return scored.withColumn("month", month_key("date")).rollup("acct", "month").agg(
        _total(F.when(ok, exact("tax_due_pln", 2))).alias("total_tax_pln"),
        F.count_if(ok).alias("report_rows"),
        F.count_if("quarantined").alias("quarantined_rows"),
    )


def net_by_ticker(display: DataFrame) -> DataFrame:
    """A-10 + A-11 + J-8 + T-9 + T-10 over the rendered report: total net dividend per
    ticker (numbers read back from the ``"<value> <CUR>"`` text) and the ticker's
    first currency symbol, in report order (date, account)."""
    parsed = display.select(
        F.col("Ticker").alias("ticker"), F.col("Date").alias("date"), "acct",
        currency_symbol("Net Dividend").alias("sym"), digits_only_number("Net Dividend").alias("v"),
    )
    return parsed.groupBy("ticker").agg(
        round_half_even(F.sum(exact("v", 2)).cast("double"), 2).alias("total_net_dividend"),
        F.min_by("sym", F.struct("date", "acct")).alias("currency_symbol"),
        F.count(F.lit(1)).alias("n"),
    )


def ticker_symbols(report: DataFrame) -> DataFrame:
    """A-11: first currency symbol per ticker and the first date it appears."""
    sym = F.when(F.col("dividend_currency") == "PLN", F.lit("PLN")).when(F.col("dividend_currency") == "USD", F.lit("$")).otherwise(F.lit(""))
    return report.withColumn("sym", sym).groupBy("ticker").agg(
        F.min_by("sym", F.struct("date", "acct")).alias("currency_symbol"),
        F.min("date").alias("first_seen"),
    )
