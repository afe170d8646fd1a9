"""FX-archive manifest selection (S-15, O-3).

The original picks the archive files to fetch from a web page: take the first
four-digit number of each label as its year, order by year descending, keep the
first label per year and stop after three years.  Re-aimed as a manifest query
over labels; ties within a year are broken by label (the page order is not
available here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: FIXED VALUE: number of most recent archive years kept.
LATEST_YEARS = 3


def archive_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive labels as a page would list them: two labels per year of ``orders``."""
    years = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.year("o_orderdate").alias("y")).distinct()
    return years.select(F.explode(F.array(
        F.concat(F.lit("archiwum_tab_a_"), F.col("y").cast("string"), F.lit(".csv")),
        F.concat(F.lit("kursy_"), F.col("y").cast("string"), F.lit("_tabela_a.csv")),
    )).alias("label"))


def latest_archives(labels: DataFrame, keep: int = LATEST_YEARS) -> DataFrame:
    """``(year, label)`` of the ``keep`` most recent years, one label per year.

    Labels without a four-digit number are ignored.  The per-year reduction is a
    partial aggregate; the final ``limit`` is the feature (top-k years)."""
    year = F.nullif(F.regexp_extract("label", r"(\d{4})", 1), F.lit("")).cast("int")
    per_year = labels.select(year.alias("year"), "label").where(F.col("year").isNotNull()).groupBy("year").agg(
        F.min("label").alias("label"))
    return per_year.orderBy(F.col("year").desc()).limit(keep)
