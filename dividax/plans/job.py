"""End-to-end batch job: workbooks + FX archives -> report, quarantine, totals.

    python -m dividax.plans.job <statements folder/glob> <archive folder> <output folder> [tax_rate]

Outputs (all below ``<output folder>``):
  report/          tab-separated display report, sorted by account, date, ticker
  report_parquet/  typed report rows
  quarantine/      rows whose FX rate is missing within the look-back
  dropped_rows/    dividend rows without a date, ticker or comment
  bad_files/       workbooks that could not be decoded
  totals/, monthly/  A-4..A-6 per account, A-12 per account and month with rollups
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from ..operators.aggregates import tax_by_month, tax_totals
from ..params import TaxParams
from ..sources.fx import archive_glob, fx_long, read_fx_archives
from ..sources.report_io import prepare_export, write_report
from ..sources.workbook import cells_to_statements, read_workbook_cells
from .report import build_report_parts, display_report


def run_report_job(spark: SparkSession, statements: str, archives: str, out: str, params: TaxParams | None = None) -> None:
    params = params or TaxParams()
    rows, bad_files = cells_to_statements(read_workbook_cells(spark, statements))
    fx = fx_long(read_fx_archives(spark, archive_glob(archives)))
    parts = build_report_parts(rows, fx, params, materialized=True)  # several outputs share one computation
    report = parts.report
    write_report(prepare_export(display_report(report)), f"{out}/report")
    report.write.mode("overwrite").parquet(f"{out}/report_parquet")
    parts.quarantine.write.mode("overwrite").parquet(f"{out}/quarantine")
    bad_files.write.mode("overwrite").parquet(f"{out}/bad_files")
    parts.dropped.write.mode("overwrite").parquet(f"{out}/dropped_rows")
    tax_totals(parts.scored).write.mode("overwrite").parquet(f"{out}/totals")
    tax_by_month(parts.scored).write.mode("overwrite").parquet(f"{out}/monthly")


def main(argv: list[str]) -> None:
    from ..session import get_session

    if len(argv) < 3:
        raise SystemExit(__doc__)
    params = TaxParams(tax_rate=float(argv[3])) if len(argv) > 3 else TaxParams()
    run_report_job(get_session(), argv[0], argv[1], argv[2], params)


if __name__ == "__main__":
    main(sys.argv[1:])
