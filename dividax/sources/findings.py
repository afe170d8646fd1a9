"""Security-scan findings reports (S-16, S-17): nested JSON in, flat findings out.

Report shape (one JSON document per report):
``{"metrics": {"_totals": {"loc": n, "SEVERITY.HIGH": n, "SEVERITY.MEDIUM": n, "SEVERITY.LOW": n}},
   "results": [{"test_id", "filename", "line_number", "issue_text", "issue_severity"}, ...]}``

A fleet of reports is read in one ``spark.read.json`` with an explicit schema; a
file that is not valid JSON lands in ``_corrupt_record`` instead of failing the
job, and missing sections are NULL (treated as empty / 0 downstream).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .workbook import write_bytes

RESULT_TYPE = StructType([
    StructField("test_id", StringType()),
    StructField("filename", StringType()),
    StructField("line_number", LongType()),
    StructField("issue_text", StringType()),
    StructField("issue_severity", StringType()),
])
TOTALS_TYPE = StructType([
    StructField("loc", LongType()),
    StructField("SEVERITY.HIGH", LongType()),
    StructField("SEVERITY.MEDIUM", LongType()),
    StructField("SEVERITY.LOW", LongType()),
])
REPORT_SCHEMA = StructType([
    StructField("report_id", StringType()),
    StructField("metrics", StructType([StructField("_totals", TOTALS_TYPE)])),
    StructField("results", ArrayType(RESULT_TYPE)),
    StructField("_corrupt_record", StringType()),
])


def read_findings(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """S-16: read reports (a file, folder or glob); ``report_id`` defaults to the file name,
    ``status`` is ``ok`` or ``unreadable`` (no valid JSON)."""
    df = (
        spark.read.schema(REPORT_SCHEMA).option("multiLine", multiline)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )
    return df.withColumns({
        "report_id": F.coalesce(F.col("report_id"), F.input_file_name()),
        "status": F.when(F.col("_corrupt_record").isNull(), F.lit("ok")).otherwise(F.lit("unreadable")),
    })


#: A JSON token: string (with the colon if it is a key), bracket, separator, other scalar, or a quote that is never closed.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*:)?|[{}\[\],:]|[^\s"{}\[\],:]+|"'


#: A line that holds one member with a plain value: no bracket changes its depth.
_MEMBER_LINE = r'^\s*+"[^"\\]*+"\s*+:\s*+(?:"[^"\\]*+"|[^\s"{}\[\],:]++)\s*+,?\s*+$'


def _step(token: Column) -> Column:
    """How far a token changes the depth of brackets."""
    return F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)


def _before(df: DataFrame, sums: dict[str, Column], states: dict[str, Column]) -> DataFrame:
    """Per split of a file (file, block): the sum of ``sums`` and the last non-NULL of ``states`` over the splits before it.

    One row per split, so the window over a file's splits stays small however long the file is."""
    place = F.struct("at", "pos") if "pos" in df.columns else F.struct("at")
    agg = df.groupBy("file", "block").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()], *[F.max_by(c, F.when(c.isNotNull(), place)).alias(n) for n, c in states.items()])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return agg.select(
        "file", "block", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_0") for n in sums],
        *[F.last(n, ignorenulls=True).over(earlier).alias(f"{n}_0") for n in states])


def read_large_findings(spark: SparkSession, path: str, scratch: str) -> tuple[DataFrame, DataFrame]:
    """S-16 for reports of any length: (reports, results), nothing of a report's size in one row or task.

    ``reports`` has report_id, status, metrics (the totals) and n_results; ``results`` a row per element of
    ``results``: report_id, pos, r.  A document (one per file, any layout) is read as lines, so a file's splits go to different
    tasks.  JSON strings hold no line breaks, so every line starts outside a string and brackets can be
    counted line by line; the depth at a line is a sum over the splits before its own and over the lines before it in
    the split.  Lines inside a result stay whole, the others are cut into tokens; pieces between two separators at the array's depth
    form one result, however many splits it spans.

    ``status`` is ``unreadable`` where brackets do not balance, a string is not closed, a result
    is no object, or a key and its colon are not on one line; such a report has no results, no metrics and no count.
    A file without lines is no report; one of blank lines, or of several documents, is read as what it holds together.
    ``scratch`` is a fresh folder shared by the executors; the cut lines are kept there."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "^\ufeff", "").alias("value"))
    tokens = F.regexp_extract_all("value", F.lit(_TOKEN), F.lit(0))
    walk = F.aggregate(
        F.transform("tokens", _step), F.struct(F.lit(0).alias("net"), F.lit(0).alias("low")),
        lambda s, d: F.struct((s["net"] + d).alias("net"), F.least(s["low"], s["net"] + d).alias("low")))
    member = F.col("value").rlike(_MEMBER_LINE)  # most lines: no token counts, so they aren't cut
    lines.withColumn("tokens", F.when(member, F.array().cast("array<string>")).otherwise(tokens)).withColumn("walk", walk).select(
        "file", "block", "at", "value", "walk.net", "walk.low",
        F.exists("tokens", lambda t: t.isin('"', ":")).alias("broken"),
        (F.size(F.filter("tokens", lambda t: t == "{")) - F.size(F.filter("tokens", lambda t: t == "}"))).alias("braces"),
    ).write.parquet(f"{scratch}/lines")
    lines = spark.read.parquet(f"{scratch}/lines")
    split = Window.partitionBy("file", "block")

    # depth at the start of each line, then the pieces: a line inside a result whole, else its tokens
    starts = _before(lines, {"net": F.col("net")}, {})
    earlier = split.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.join(starts, ["file", "block"]).withColumn("start", F.col("net_0") + F.coalesce(F.sum("net").over(earlier), F.lit(0)))
    lines.groupBy("file").agg(
        ((F.sum("net") == 0) & (F.sum("braces") == 0) & ~F.max("broken") & (F.min(F.col("start") + F.col("low")) >= 0)).alias("balanced")
    ).write.parquet(f"{scratch}/shape")
    shape = spark.read.parquet(f"{scratch}/shape")
    lines = lines.join(shape.where("balanced").select("file"), "file", "left_semi")  # an open bracket would gather the rest of its file
    whole = F.col("start") + F.col("low") >= 3
    pieces = lines.select(
        "file", "block", "at", "start", "net", whole.alias("whole"),
        F.posexplode(F.when(whole, F.array("value")).otherwise(tokens)).alias("pos", "piece"))
    step = F.when(F.col("whole"), F.col("net")).otherwise(_step(F.col("piece")))
    inside = Window.partitionBy("file", "block", "at").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("file", "block", "at", "pos", "piece", "whole", (F.col("start") + F.coalesce(F.sum(step).over(inside), F.lit(0))).alias("depth"))
    key = F.regexp_extract("piece", r'^"(.*)"\s*:$', 1)
    is_key, opens = F.col("piece").rlike(r'^".*"\s*:$') & ~F.col("whole"), F.col("piece").isin("{", "[")
    marks = {
        "section": F.when((F.col("depth") == 1) & is_key, key),
        "part": F.when((F.col("depth") == 2) & is_key, key).when((F.col("depth") == 1) & opens, ""),
        # the separator before a result: the array's bracket or a comma at its depth
        "cut": F.when(((F.col("depth") == 2) & (F.col("piece") == ",")) | ((F.col("depth") == 1) & opens), F.struct("block", "at", "pos")),
    }
    pieces = pieces.select("file", "block", "at", "pos", "piece", "whole", "depth", *[c.alias(n) for n, c in marks.items()])
    pieces.write.parquet(f"{scratch}/pieces")
    pieces = spark.read.parquet(f"{scratch}/pieces")
    so_far = split.orderBy("at", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.join(_before(pieces, {}, {n: F.col(n) for n in marks}), ["file", "block"]).select(
        "file", "block", "at", "pos", "piece", "depth", "whole",
        *[F.coalesce(F.last(n, ignorenulls=True).over(so_far), F.col(f"{n}_0")).alias(n) for n in marks])
    first = (F.col("at") == F.col("cut.at")) & (F.col("pos") == F.col("cut.pos"))
    inner = (F.col("depth") >= 2) & ~((F.col("depth") == 2) & F.col("piece").isin(",", "]", "}")) & ~first
    text = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "pos", "piece"))), lambda x: x["piece"]))

    parsed = StructType([*RESULT_TYPE.fields, StructField("_corrupt_record", StringType())])
    found = pieces.where((F.col("section") == "results") & inner).groupBy("file", "cut").agg(text.alias("text"))
    found = found.select("file", "cut", "text", F.from_json("text", parsed, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select(
        "file", "cut", F.col("r").dropFields("_corrupt_record").alias("r"), (F.col("r._corrupt_record").isNotNull() | ~F.col("text").rlike(r"^\s*\{")).alias("odd"))
    found.write.parquet(f"{scratch}/results")
    found = spark.read.parquet(f"{scratch}/results")

    # single values of a report: its id and the totals (a bounded number of pieces)
    single = pieces.where((F.col("section") == "report_id") & (F.col("depth") == 1) & ~F.col("piece").rlike(r':$|^[{}\[\],]$')).groupBy("file").agg(
        F.max(F.from_json(F.concat(F.lit('{"v":'), "piece", F.lit("}")), "v string")["v"]).alias("named"))
    totals = pieces.where((F.col("section") == "metrics") & (F.col("part") == "_totals") & (F.col("depth") >= 2)
                          & ~((F.col("depth") == 2) & (F.col("piece").isin(",", "}") | is_key))).groupBy("file").agg(
        F.from_json(text, TOTALS_TYPE).alias("_totals"))
    counts = found.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("odd").alias("odd"))
    ok = F.col("balanced") & ~F.coalesce("odd", F.lit(False))
    reports = shape.join(single, "file", "left").join(totals, "file", "left").join(counts, "file", "left").select(
        "file", F.coalesce("named", "file").alias("report_id"), F.when(ok, "ok").otherwise("unreadable").alias("status"),
        F.when(ok, F.struct("_totals")).alias("metrics"), F.when(ok, F.coalesce("n", F.lit(0))).cast("int").alias("n_results"))
    reports.write.parquet(f"{scratch}/reports")
    reports = spark.read.parquet(f"{scratch}/reports")

    # place of a result: the results in the splits before, and those before it in its split
    begun = found.select("file", F.col("cut.block").alias("block"), F.col("cut.at").alias("at"), F.col("cut.pos").alias("pos"), "r")
    number = F.row_number().over(split.orderBy("at", "pos")) - 1
    results = begun.join(_before(begun, {"n": F.lit(1)}, {}), ["file", "block"]).select("file", (F.col("n_0") + number).cast("int").alias("pos"), "r")
    results = results.join(reports.where("status = 'ok'").select("file", "report_id"), "file")
    return reports.drop("file"), results.select("report_id", "pos", "r")


def write_documents(reports: DataFrame, path: str) -> str:
    """Sink of reports as indented documents, one file each, overwrite.

    Each task writes its files itself, by the folder's URI, under names that a repeated task writes again; the
    driver neither moves nor commits them one by one."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, copies = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for report, body in zip(batch["report"].to_pylist(), batch["value"].to_pylist()):
                content = f"{body}\n".encode()
                name = f"{quote(report or '', safe='')[:100]}-{task}-{hashlib.sha256(content).hexdigest()[:16]}"
                copies[name] += 1
                write_bytes(f"{path}/{name}-{copies[name]}.json", content)
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    reports.sparkSession.createDataFrame([], "value string").write.mode("overwrite").text(path)  # an empty folder
    body = F.to_json(F.struct(*[c for c in ("report_id", "metrics", "results") if c in reports.columns]), {"pretty": "true"})
    rows = reports.select(F.col("report_id").alias("report"), body.alias("value"))
    rows.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()
    return path


def write_findings(reports: DataFrame, path: str) -> str:
    """Sink of reports in the shape they are read in (one document per line), overwrite."""
    reports.select(*[c for c in ("report_id", "metrics", "results") if c in reports.columns]).write.mode(
        "overwrite").json(path)
    return path


CONVERTED_SCHEMA = (
    "report_id string, version string, runs array<struct<results: array<struct<ruleId: string, ruleIndex: int, message: struct<text: string>, "
    "locations: array<struct<physicalLocation: struct<artifactLocation: struct<uri: string>, region: struct<startLine: bigint, startColumn: int>>>>, "
    "level: string, partialFingerprints: struct<primaryLocationLineHash: string>>>>>"
)


def write_converted(documents: DataFrame, path: str) -> str:
    """S-17: JSON sink of converted documents, one per line."""
    documents.write.mode("overwrite").json(path)
    return path


def read_converted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONVERTED_SCHEMA).json(path)


# FIXED VALUES of the synthetic findings generator (derived from ``events``):
#: events per report batch (bounds the ``results`` array of every report)
FINDINGS_BATCH = 1000
#: severity by event value: >= 30 HIGH, >= 10 MEDIUM, >= 2 LOW, else missing
SEVERITY_CUTS = ((30, "HIGH"), (10, "MEDIUM"), (2, "LOW"))


def findings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One findings report per (event_type, event_id batch); every event is one result.

    Missing fields are produced on purpose (rule, line, text, severity, one metrics
    entry) so the readers' defaults are exercised."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "user_id", "value")
    sev = None
    for cut, name in SEVERITY_CUTS:
        sev = F.when(F.col("value") >= cut, F.lit(name)) if sev is None else sev.when(F.col("value") >= cut, F.lit(name))
    whole = F.floor("value").cast("long")
    result = F.struct(
        F.when((F.col("event_type") == "error") & (F.col("user_id") % 5 == 0), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("B"), (F.col("user_id") % 12 + 100).cast("string"))).alias("test_id"),
        F.concat(F.lit("src\\pkg"), (F.col("user_id") % 7).cast("string"), F.lit("\\mod"),
                 (F.col("event_id") % 3).cast("string"), F.lit(".py")).alias("filename"),
        F.when(F.col("value") >= 1, F.col("event_id") % 400 + 1).alias("line_number"),
        F.when(F.col("event_type") != "view", F.concat(F.col("event_type"), F.lit(" at "), whole.cast("string"))).alias("issue_text"),
        sev.alias("issue_severity"),
    )
    batch = F.floor(F.col("event_id") / FINDINGS_BATCH).cast("long")
    rows = ev.select(
        F.concat(F.col("event_type"), F.lit("-"), batch.cast("string")).alias("report_id"),
        "event_type", "event_id", whole.alias("whole"), sev.alias("sev"), result.alias("r"),
    )
    agg = rows.groupBy("report_id", "event_type").agg(
        (F.count(F.lit(1)) * 25 + F.sum("whole")).alias("loc"),
        F.count_if(F.col("sev") == "HIGH").alias("high"),
        F.count_if(F.col("sev") == "MEDIUM").alias("medium"),
        F.count_if(F.col("sev") == "LOW").alias("low"),
        F.array_sort(F.collect_list(F.struct("event_id", "r"))).alias("_rs"),
    )
    totals = F.struct(
        F.col("loc").alias("loc"), F.col("high").alias("SEVERITY.HIGH"),
        F.when(F.col("event_type") != "click", F.col("medium")).alias("SEVERITY.MEDIUM"),
        F.col("low").alias("SEVERITY.LOW"),
    )
    return agg.select(
        "report_id",
        F.struct(totals.alias("_totals")).alias("metrics"),
        F.transform("_rs", lambda x: x["r"]).alias("results"),
    )
