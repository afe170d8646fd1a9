"""dividax — a Spark-native dividend and withholding-tax analytics engine.

Layout:
  functions/   Column expressions (dates, text parsers, money/rounding)
  sources/     statement, FX-archive, workbook, findings and report readers/writers
  operators/   DataFrame -> DataFrame steps (filters, groupings, FX as-of join, tax, quality)
  plans/       composed jobs (the tax report, totals, registered queries and their SQL oracles)
  streaming/   incremental runner of the batch plan over a growing statement folder
"""

from .params import TaxParams

__all__ = ["TaxParams"]
