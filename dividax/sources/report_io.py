"""Report sink and read-back (S-13, S-14, P-17 .. P-19).

The sink writes tab-separated text with a header, overwriting the target
folder; files are written in parallel (one per partition) unless a single file
is explicitly asked for.  Targets live under the session's shared checkpoint
folder (``spark.checkpoint.dir``) when no path is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.text import strip_ansi
from ..operators.columns import fill_missing, require_columns, round_numeric
from ..session import ensure_checkpoint_dir

#: Schema of the exported report (display columns).
REPORT_SCHEMA = StructType([
    StructField("acct", StringType()),
    StructField("Date", StringType()),
    StructField("Ticker", StringType()),
    StructField("Shares", DoubleType()),
    StructField("Net Dividend", StringType()),
    StructField("Tax Collected Amount", StringType()),
    StructField("Tax Collected %", StringType()),
    StructField("Date D-1", StringType()),
    StructField("Exchange Rate D-1", StringType()),
    StructField("Tax Amount PLN", StringType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def prepare_export(display: DataFrame) -> DataFrame:
    """P-17 .. P-19 + T-8: the exporter's clean-up of the display report."""
    require_columns(display, ["Ticker"], "An export needs the column 'Ticker'; required columns")
    df = display.withColumn("Ticker", strip_ansi("Ticker"))
    if "Tax Collected" in df.columns and "Tax Collected %" in df.columns:  # P-17
        df = df.drop("Tax Collected")
    return round_numeric(fill_missing(df), 2)  # P-18, P-19


#: O-1: report order (the original's group-by order), applied only at the sink.
REPORT_ORDER = ("acct", "Date", "Ticker")


def write_report(df: DataFrame, path: str, single_file: bool = False, ordered: bool = True) -> str:
    """S-13: tab-separated, header, overwrite.

    ``ordered`` sorts by account, date and ticker at the sink (a range-partitioned
    sort of the report grain, not of the input); part files then follow that order."""
    keys = [c for c in REPORT_ORDER if c in df.columns] if ordered else []
    out = df.orderBy(*keys) if keys else df
    out = out.coalesce(1) if single_file else out
    out.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema: StructType = REPORT_SCHEMA) -> DataFrame:
    """S-14: read a written report back with an explicit schema."""
    return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)


def report_roundtrip(spark: SparkSession, display: DataFrame) -> DataFrame:
    path = write_report(prepare_export(display), scratch_path(spark, "report"))
    return read_report(spark, path)



ORDERED_SCHEMA = StructType([StructField("ordinal", LongType()), *REPORT_SCHEMA.fields])


def write_ordered(df: DataFrame, path: str, keys: tuple[str, ...] = REPORT_ORDER) -> str:
    """S-13 / O-1 with proof of the order: tab-separated rows in ``path``/rows with their place
    (``ordinal``, from 1) in the whole report, and a manifest in ``path``/manifest with a row per sorted part
    (part, first_ordinal, n_rows, first_key, last_key).

    Rows are range-partitioned and sorted once and stored with their place in the part; a part's first
    ordinal is the sum of the parts before it, a table of one row per part."""
    spark = df.sparkSession
    parts = scratch_path(spark, "sorted")
    place = F.monotonically_increasing_id()  # part number above 33 bits of row number
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*", F.shiftright(place, 33).cast("int").alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_at")).write.parquet(parts)
    rows, key = spark.read.parquet(parts), F.struct(*keys)
    manifest = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key")).select(
        F.col("_part").alias("part"), (F.sum("n_rows").over(Window.orderBy("_part")) - F.col("n_rows") + 1).alias("first_ordinal"), "n_rows", "first_key", "last_key")
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    starts = spark.read.parquet(f"{path}/manifest").select(F.col("part").alias("_part"), "first_ordinal")  # a row per part
    rows.join(F.broadcast(starts), "_part").select((F.col("first_ordinal") + F.col("_at")).alias("ordinal"), *df.columns).write.mode(
        "overwrite").option("sep", "\t").option("header", True).csv(f"{path}/rows")
    return path


def read_ordered(spark: SparkSession, path: str, schema: StructType = ORDERED_SCHEMA) -> DataFrame:
    """Rows of :func:`write_ordered`, with their ordinals."""
    return read_report(spark, f"{path}/rows", schema)


def order_problems(spark: SparkSession, path: str, keys: tuple[str, ...] = REPORT_ORDER, schema: StructType = ORDERED_SCHEMA) -> DataFrame:
    """(part, problem) of what was written out of order or isn't complete; no rows if the order holds.

    Checked on the rows read back, part by part: the number of rows, each row against the one before
    it in its part, and each part's keys against the manifest and the part before."""
    key = F.struct(*keys)
    manifest = spark.read.parquet(f"{path}/manifest")
    starts = sorted(r["first_ordinal"] for r in manifest.select("first_ordinal").collect())  # a number per part
    rows = read_ordered(spark, path, schema).select(
        "ordinal", key.alias("key"), F.size(F.filter(F.lit(starts), lambda s: s <= F.col("ordinal"))).alias("nth"))
    before = Window.partitionBy("nth").orderBy("ordinal")
    found = rows.withColumn("prev", F.lag("key").over(before)).withColumn("prev_at", F.lag("ordinal").over(before)).groupBy("nth").agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(F.col("prev") > F.col("key")).alias("down"),
        F.count_if(F.col("ordinal") != F.col("prev_at") + 1).alias("gaps"), F.min("key").alias("low"), F.max("key").alias("high"))
    chain = Window.orderBy("first_ordinal")
    parts = manifest.withColumn("nth", F.row_number().over(chain)).withColumn("end", F.lag("last_key").over(chain))
    problems = F.array_compact(F.array(
        F.when(~F.col("seen").eqNullSafe(F.col("n_rows")), F.lit("rows")), F.when(F.col("down") > 0, F.lit("order")),
        F.when(F.col("gaps") > 0, F.lit("gap")), F.when(F.col("end") > F.col("first_key"), F.lit("parts")),
        F.when((F.col("low") != F.col("first_key")) | (F.col("high") != F.col("last_key")), F.lit("keys"))))
    return parts.join(found, "nth", "left").select("part", F.explode(problems).alias("problem"))
