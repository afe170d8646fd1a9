"""FX rate sources (S-7 .. S-12, U-1).

Long form everywhere: ``fx(currency STRING, rate_date DATE, rate DOUBLE)``.

* ``synthetic_fx``       one row per currency and published weekday, derived from
                         ``orders.o_orderdate`` (FIXTURES §2.2).
* ``synthetic_fx_wide``  the same rates as archive rows: ``data`` (yyyyMMdd) and one
                         decimal-comma text column per currency, one logical file per
                         year, plus a description row per file.
* ``read_fx_archives``   the archive CSV reader: one read per file (header order may
                         differ between years; a multi-file CSV read binds columns by
                         position), then ``unionByName``.
* ``fx_long``            wide -> long, cleaning, first-file-wins de-duplication.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K

# FIXED VALUES of the synthetic rate generator (FIXTURES §2.2):
# rate = (base + (N * step) % span) / scale, N = days since 1990-01-01.
FX_FORMULAS = (
    ("USD", 300, 7, 150, 100),
    ("EUR", 400, 11, 120, 100),
    ("GBP", 480, 13, 110, 100),
    ("DKK", 5500, 17, 700, 10000),
)
#: Days of month treated as holidays (no publication).
FX_HOLIDAY_DAYS = (1, 6, 25)
FX_EPOCH = "1990-01-01"


def published_days(spark: SparkSession, sf_dir: str, weekends: bool = False) -> DataFrame:
    """Distinct weekdays of ``o_orderdate`` that are not stand-in holidays (``weekends``: and
    weekend days whose day of month 3 divides)."""
    d = F.col("o_orderdate").cast("date")
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(d.alias("rate_date")).distinct()
    dow = F.dayofweek("rate_date")
    weekday = (dow >= 2) & (dow <= 6)
    kept = weekday & ~F.dayofmonth("rate_date").isin(*FX_HOLIDAY_DAYS)
    return days.where(kept | (~weekday & (F.dayofmonth("rate_date") % 3 == 0)) if weekends else kept)


def _numerators(days: DataFrame) -> DataFrame:
    n = F.datediff(F.col("rate_date"), F.lit(FX_EPOCH).cast("date"))
    cols = [F.col("rate_date")]
    for cur, base, step, span, _scale in FX_FORMULAS:
        cols.append((F.lit(base) + (n * step) % span).alias(f"num_{cur}"))
    return days.select(*cols)


def synthetic_fx(spark: SparkSession, sf_dir: str, weekends: bool = False) -> DataFrame:
    """Long FX table: ``currency, rate_date, rate``."""
    nums = _numerators(published_days(spark, sf_dir, weekends))
    stack = F.explode(
        F.array(*[
            F.struct(F.lit(cur).alias("currency"), (F.col(f"num_{cur}").cast("double") / scale).alias("rate"))
            for cur, _b, _s, _p, scale in FX_FORMULAS
        ])
    ).alias("r")
    return nums.select("rate_date", stack).select("r.currency", "rate_date", "r.rate")


def edge_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``synthetic_fx`` with some weekend-dated rates, and a zero rate on every tenth of a month."""
    rate = F.when(F.dayofmonth("rate_date") == 10, F.lit(0.0)).otherwise(F.col("rate"))
    return synthetic_fx(spark, sf_dir, weekends=True).withColumn("rate", rate)


def _decimal_comma(num, scale: int):
    digits = len(str(scale)) - 1
    return F.concat(
        F.floor(num / scale).cast("string"), F.lit(","), F.lpad((num % scale).cast("string"), digits, "0")
    )


def synthetic_fx_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive-shaped rows: ``file_name, row_no, data, 1USD, 1EUR, 1GBP, 1DKK`` (all text).

    ``row_no`` 0 is the description row (``data`` = ``nazwa``) of each yearly file."""
    nums = _numerators(published_days(spark, sf_dir))
    year = F.year("rate_date")
    rates = nums.select(
        F.concat(F.lit("archiwum_tab_a_"), year.cast("string"), F.lit(".csv")).alias("file_name"),
        F.date_format("rate_date", "yyyyMMdd").alias("data"),
        *[
            _decimal_comma(F.col(f"num_{cur}"), scale).alias(K.FX_ARCHIVE_COLUMNS[cur])
            for cur, _b, _s, _p, scale in FX_FORMULAS
        ],
    )
    desc = rates.select("file_name").distinct().select(
        "file_name", F.lit("nazwa").alias("data"),
        *[F.lit(f"1 {cur}").alias(K.FX_ARCHIVE_COLUMNS[cur]) for cur, *_ in FX_FORMULAS],
    )
    return rates.unionByName(desc).withColumn("row_no", F.when(F.col("data") == "nazwa", 0).otherwise(1 + F.col("data").cast("int") % 10000))


def fx_clean_rows(wide: DataFrame, file_col: str = "file_name", row_col: str = "row_no") -> DataFrame:
    """S-9 + S-10: wide archive rows -> ``_file, _row, currency, rate_date, rate`` (clean, not de-duplicated).

    * absent currency columns are skipped
    * NULL rate, a ``data`` that is not ``yyyyMMdd`` (also drops the description row) and
      non-numeric rate text are dropped; decimal comma -> dot
    """
    present = [(cur, col) for cur, col in K.FX_ARCHIVE_COLUMNS.items() if col in wide.columns]
    if "data" not in wide.columns or not present:
        return wide.sparkSession.createDataFrame(
            [], "_file string, _row long, currency string, rate_date date, rate double")
    stacked = wide.select(
        F.col(file_col).alias("_file"),
        F.col(row_col).alias("_row"),
        F.col("data"),
        F.explode(F.array(*[F.struct(F.lit(cur).alias("currency"), F.col(f"`{col}`").cast("string").alias("raw")) for cur, col in present])).alias("u"),
    )
    text = F.regexp_replace(F.trim(F.col("u.raw")), ",", ".")
    return stacked.select(
        "_file", "_row", F.col("u.currency").alias("currency"),
        F.when(F.col("data").rlike(r"^\d{8}$"), F.try_to_timestamp(F.col("data"), F.lit("yyyyMMdd")).cast("date")).alias("rate_date"),
        F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), text.try_cast("double")).alias("rate"),
    ).where(F.col("rate_date").isNotNull() & F.col("rate").isNotNull())


def fx_long(wide: DataFrame, file_col: str = "file_name", row_col: str = "row_no") -> DataFrame:
    """S-9 .. S-11: clean long rates, first file wins per (currency, date).

    Duplicates: the smallest (file name, row) wins.  The original's order is the
    file-system glob order, which is unspecified, so ascending path is fixed here.
    ``min_by`` is a partial aggregate, so duplicates collapse map-side."""
    clean = fx_clean_rows(wide, file_col, row_col)
    return clean.groupBy("currency", "rate_date").agg(
        F.min_by(F.col("rate"), F.struct("_file", "_row")).alias("rate")
    )


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Keep the paths (or globs) that match something; file-system metadata only, no job."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except PySparkException:  # remote session: no file-system handle here; let the reader decide
        return list(paths)
    kept = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        matches = hp.getFileSystem(conf).globStatus(hp)
        if matches is not None and len(matches) > 0:
            kept.append(p)
    return kept


def archive_glob(folder: str) -> str:
    """S-7: the archives of a data folder (other CSV files there are ignored)."""
    return f"{folder.rstrip('/')}/{K.FX_ARCHIVE_PATTERN}"


def _cells(line) -> Column:
    """Cells of a ``;``-separated line; quoted cells may hold ``;`` and doubled quotes."""
    parts = F.split(line, ';(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda c: F.when(
        c.rlike('^".*"$'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def _headers(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file_name").agg(F.min_by("cells", "row_no").alias("header"), F.min("row_no").alias("header_no"))


def _archive_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame | None:
    targets = existing_paths(spark, [paths] if isinstance(paths, str) else sorted(paths))
    if not targets:
        return None
    return (
        spark.read.option("ignoreMissingFiles", "true").text(targets)
        .select(F.input_file_name().alias("file_name"), F.monotonically_increasing_id().alias("row_no"),
                _cells(F.regexp_replace("value", "^\ufeff|\r$", "")).alias("cells"))
    )


def skipped_archives(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Archive files that ``read_fx_archives`` passes over (no ``data`` column), with their header."""
    lines = _archive_lines(spark, paths)
    if lines is None:
        return spark.createDataFrame([], "file_name string, header array<string>")
    return _headers(lines).where(~F.array_contains("header", "data")).select("file_name", "header")


def read_fx_archives(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """S-7 + S-8 + U-1: archive CSV files (``;``-separated) -> wide rows, in one distributed read.

    ``paths`` is a folder/glob (e.g. ``.../archiwum_tab_a_*.csv``) or a list of files;
    missing files are ignored.  Files are read as text lines; each file's first line
    is its header, so every file binds its own column order (a multi-file CSV read
    would bind all files by the first file's column positions).  Files without a
    ``data`` column are skipped.  The output carries ``file_name`` and ``row_no``
    (line order within the file) for first-file-wins de-duplication.

    Header and rate cells are ASCII; the text reader's UTF-8 decoding only affects
    the (dropped) ISO-8859-1 description row."""
    lines = _archive_lines(spark, paths)
    if lines is None:
        return spark.createDataFrame([], "file_name string, row_no long, data string")
    headers = _headers(lines).where(F.array_contains("header", "data"))
    body = lines.join(headers, "file_name").where(F.col("row_no") > F.col("header_no"))

    def cell(name: str):
        pos = F.array_position(F.col("header"), name)
        return F.when(pos > 0, F.try_element_at(F.col("cells"), pos.cast("int")))

    cols = [F.col("file_name"), F.col("row_no"), cell("data").alias("data")]
    cols += [cell(col).alias(col) for col in K.FX_ARCHIVE_COLUMNS.values()]
    return body.select(*cols)


def write_fx_archives(wide: DataFrame, base: str) -> str:
    """Write archive-shaped rows as ``;``-separated CSV files with a header, one folder
    per year; odd years use a different column order, and a correction set with
    permuted rate columns goes to a folder that sorts after the yearly archives (its
    duplicates must lose).  Used to exercise the archive reader end to end."""
    cols = ["data"] + list(K.FX_ARCHIVE_COLUMNS.values())
    year = F.substring(F.col("file_name"), 16, 4)
    rows = wide.withColumn("year", year)
    even = rows.where(F.col("year").try_cast("int") % 2 == 0).select("year", *[F.col(f"`{c}`") for c in cols])
    odd = rows.where(F.col("year").try_cast("int") % 2 == 1).select("year", *[F.col(f"`{c}`") for c in reversed(cols)])
    corr = rows.where((F.col("data") == "nazwa") | (F.substring("data", 7, 2).try_cast("int") % 3 == 0)).select(
        "year", "data", F.col("1EUR").alias("1USD"), F.col("1USD").alias("1EUR"),
        F.col("1DKK").alias("1GBP"), F.col("1GBP").alias("1DKK"))
    for df, folder in ((even, "a"), (odd, "a"), (corr, "b")):
        # one of the sets is quoted throughout
        df.write.mode("append").partitionBy("year").option("sep", ";").option("header", True).option("quoteAll", df is odd).csv(f"{base}/{folder}")
    return base
