"""The flagship plan: statements + FX rates -> per (account, date, ticker) tax report.

    scan -> P-2/J-7/C-1 -> F-1 -> A-1 (shuffle 1, partial agg) -> P-8 -> C-4/T-1/T-2
    -> J-4 (broadcast FX) -> M-1/M-2 -> T-3/A-2/A-3 (shuffle 2, partial agg)
    -> J-5/P-12/P-13 -> J-1 (broadcast FX) -> M-3/M-4/M-5 -> P-9

Rows whose FX rate is needed but not available within the look-back are not
raised as an error (the original aborts the whole run); they are kept out of
the report and listed by ``quarantine`` (F-10).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import amount_text
from ..functions.dates import iso_date
from ..operators.dividends import (
    MERGE_KEYS,
    derive_shares,
    dropped_rows,
    filter_dividends,
    group_dividends,
    merge_rows,
    prepare_rows,
    split_tax_rows,
)
from ..operators.fx_join import FxIndex
from ..operators.quality import ReportChecks
from ..operators.tax import add_tax_columns
from ..params import TaxParams
from ..session import materialize

REPORT_COLUMNS = (
    "acct", "account_currency", "date", "ticker", "shares", "net_dividend", "dividend_currency",
    "wht_amount", "wht_pct", "wht_rate", "date_d1", "fx_rate_d1", "tax_due_pln",
)


@dataclass
class ReportParts:
    rows: DataFrame        # after shares (A-1 grain)
    merged: DataFrame      # after A-3 (report grain), before quarantine
    report: DataFrame      # clean report rows
    quarantine: DataFrame  # rows excluded for missing FX
    scored: DataFrame      # merged with the flag ``quarantined`` (input of the totals)
    dropped: DataFrame     # dividend rows without a date, ticker or comment


def shares_stage(rows: DataFrame, fx: FxIndex, params: TaxParams) -> DataFrame:
    grouped = group_dividends(filter_dividends(rows))
    return derive_shares(split_tax_rows(grouped), fx, params)


def build_report_parts(stmt: DataFrame, fx: DataFrame | FxIndex, params: TaxParams | None = None,
                       materialized: bool = False, checks: ReportChecks | None = None) -> ReportParts:
    """All stages of the report.  ``checks`` are counted in the pass that computes it.  With ``materialized`` the merged table is computed
    once and checkpointed, so report, quarantine and totals do not each recompute
    the pipeline (use it when more than one output is written)."""
    if stmt is None or fx is None:
        raise ValueError("Statements and FX rates are required (got None).")
    params = params or TaxParams()
    index = fx if isinstance(fx, FxIndex) else FxIndex(fx, params)
    prepared = prepare_rows(stmt)
    rows = shares_stage(prepared, index, params)
    rows = checks.on_rows(rows) if checks else rows
    merged = add_tax_columns(merge_rows(rows), index, params)
    bad = F.coalesce(F.col("fx_missing_shares"), F.lit(False)) | F.col("fx_missing_report")
    scored = merged.withColumn("quarantined", bad)
    scored = checks.on_report(scored) if checks else scored
    if materialized:
        scored = materialize(scored)
        merged = scored.drop("quarantined")
    report = scored.where(~F.col("quarantined")).select(*REPORT_COLUMNS)
    quarantine = scored.where("quarantined").select(
        *MERGE_KEYS,
        F.when(F.col("fx_missing_shares"), F.lit("shares")).otherwise(F.lit("report")).alias("stage"),
        "dividend_currency", "date_d1",
    )
    return ReportParts(rows, merged, report, quarantine, scored, dropped_rows(prepared))


def build_report(stmt: DataFrame, fx: DataFrame | FxIndex, params: TaxParams | None = None) -> DataFrame:
    """Flagship: typed tax report, one row per (account, date, ticker)."""
    return build_report_parts(stmt, fx, params).report


def display_report(report: DataFrame) -> DataFrame:
    """P-9 + P-11 + sink rendering: the original's display columns and texts."""
    dash = F.lit("-")
    return report.select(
        "acct",
        iso_date("date").alias("Date"),
        F.col("ticker").alias("Ticker"),
        F.col("shares").alias("Shares"),
        amount_text("net_dividend", "dividend_currency").alias("Net Dividend"),
        F.coalesce(F.concat(F.col("wht_amount").cast("decimal(18,2)").cast("string"), F.lit(" "), F.col("dividend_currency")), dash).alias("Tax Collected Amount"),
        F.col("wht_pct").alias("Tax Collected %"),
        F.coalesce(iso_date("date_d1"), dash).alias("Date D-1"),
        F.coalesce(F.concat(F.col("fx_rate_d1").cast("decimal(18,4)").cast("string"), F.lit(" PLN")), dash).alias("Exchange Rate D-1"),
        F.coalesce(F.concat(F.col("tax_due_pln").cast("decimal(18,2)").cast("string"), F.lit(" PLN")), dash).alias("Tax Amount PLN"),
    )
