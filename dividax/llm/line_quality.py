"""Quality rules: base counts of each text, and lines that many documents of a host share.

DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, words, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A line is shared if over MIN_DOCS and over HOST_SHARE of the host's distinct documents have it.
MIN_DOCS, HOST_SHARE = 5, 0.05
#: So many documents suffice at any size of the host; of lines of LONG_WORDS, over LONG_DOCS.
ENOUGH_DOCS, LONG_WORDS, LONG_DOCS = 100, 50, 3
#: A document is depleted if more than this share of its words stands in shared lines.
MAX_REMOVED = 0.5
WINDOW = 3
#: Shared lines up to which their table is broadcast; beyond, rows are dealt to SALTS copies of it.
BROADCAST_LINES, SALTS = 200_000, 16
_FEW = 64


def repeated_words(w: Column) -> Column:
    """Words of the array ``w`` that stand in a 3-word window found twice or more.

    Windows are compared by 64-bit hashes.  Sorting the hashes finds the repeated ones; the
    windows that have one are marked directly if few hashes are repeated, else by sorting
    (hash, place) pairs, so the work stays n log n for any text."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))

    def places(h: Column, repeated: Column) -> Column:
        direct = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(repeated, x), i)), lambda i: i.isNotNull())
        by_sort = let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda z: F.sort_array(F.transform(
            F.filter(z, lambda e, j: (e["h"].eqNullSafe(F.get(z, j - 1)["h"])) | (e["h"].eqNullSafe(F.get(z, j + 1)["h"]))), lambda e: e["i"])))
        return F.when(F.size(repeated) <= _FEW, direct).otherwise(by_sort)

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(0).alias("last"), F.lit(0).alias("n"))
        step = lambda a, i: F.struct((i + WINDOW).alias("last"), (a["n"] + i + WINDOW - F.greatest(a["last"], i)).alias("n"))
        return F.aggregate(p, start, step, lambda a: a["n"])

    def of(h: Column) -> Column:
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i - 1))))
        return let(repeated, lambda r: F.when(F.size(r) == 0, F.lit(0)).otherwise(covered(places(h, r))))

    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(let(windows, of))


def _lines(text: Column) -> Column:
    """The \\n-split lines of a text that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def normalised(line: Column) -> Column:
    """A line without case, digits, punctuation and extra white space."""
    return F.btrim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))


def _features(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per row: base counts, host, content hash, and (hash, words) of its lines; the texts stay behind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), text.alias("text"))
    counts = let(words(F.col("text")), lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    line = lambda x: F.struct(F.xxhash64(normalised(x)).alias("h"), (normalised(x) != "").alias("lettered"), F.size(words(x)).alias("n"))
    by_line = let(_lines(F.col("text")), lambda ls: F.struct((F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"), F.transform(ls, line).alias("lines")))
    return source.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "host", F.xxhash64("text").alias("content"), counts.alias("c"), by_line.alias("l"),
        F.length(F.translate("text", SPACES, "")).alias("word_chars"), (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
    ).select(
        "row", "doc_id", "host", "content", F.col("c.n_words").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"), F.col("l.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("c.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.filter("l.lines", lambda x: x["lettered"]).alias("lines"),
    )


def shared_lines(features: DataFrame, min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE, enough_docs: int | None = None, long_docs: int | None = None) -> DataFrame:
    """(host, h, n_docs): lines above the limits, counted over the distinct texts of each host.

    A line is shared if over ``min_docs`` and over ``host_share`` of the texts have it; also, where these
    are given, if ``enough_docs`` have it, or if it has LONG_WORDS words and over ``long_docs`` have it.
    Counts are pre-aggregated before each shuffle, so a line that a third of all rows have costs
    one row for each map task; equal texts of a host count once."""
    hosts = features.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    share = (F.col("n_docs") > min_docs) & (F.col("n_docs") > host_share * F.col("host_docs"))
    if enough_docs is None and long_docs is None:
        lines = features.select("host", "content", F.explode(F.array_distinct("lines.h")).alias("h")).distinct()
        counts = lines.groupBy("host", "h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
        return counts.join(hosts, "host").where(share).select("host", "h", "n_docs")
    lines = features.select("host", "content", F.explode("lines").alias("line")).groupBy("host", "content", "line.h").agg(F.max("line.n").alias("n"))
    enough = F.lit(False) if enough_docs is None else F.col("n_docs") >= enough_docs
    long = F.lit(False) if long_docs is None else (F.col("n") >= LONG_WORDS) & (F.col("n_docs") > long_docs)
    counts = lines.groupBy("host", "h").agg(F.count("*").alias("n_docs"), F.max("n").alias("n")).where((F.col("n_docs") > min_docs) | enough | long)
    return counts.join(hosts, "host").where(share | enough | long).select("host", "h", "n_docs")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE, max_removed: float = MAX_REMOVED,
                  enough_docs: int | None = ENOUGH_DOCS, long_docs: int | None = LONG_DOCS) -> DataFrame:
    """Base counts and verdict of every row of ``docs``; other columns are ignored.

    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_lines,
    removed_words, kept).  A row fails the base with under 50 words, or with over half of its words in
    repeated 3-word windows.  Lines (compared without case, digits and punctuation; lines without
    letters are left alone) found in over ``min_docs`` and over ``host_share`` of the host's distinct
    texts count as removed, and so at any size of the host do those found in ``enough_docs`` and those of
    LONG_WORDS words found in over ``long_docs``; a row that loses more than ``max_removed`` of its words is depleted and not
    kept.  NULL text is empty, a NULL host is the host ""; repeated rows give their rows and count as one
    document; an empty table gives no rows.
    """
    features = written(_features(docs, id_col, text_col, host_col))
    shared = written(shared_lines(features, min_docs, host_share, enough_docs, long_docs).select("host", "h"))
    lines = features.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.h", "line.n")
    if shared.count() <= BROADCAST_LINES:
        hits = lines.join(F.broadcast(shared), ["host", "h"])
    else:  # shared lines are the frequent ones, so their rows are salted
        copies = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = lines.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(copies, ["host", "h", "salt"])
    lost = hits.groupBy("row").agg(F.count("*").alias("removed_lines"), F.sum("n").alias("removed_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    return features.drop("lines").join(lost, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        F.coalesce("removed_lines", F.lit(0)).cast("long").alias("removed_lines"), removed.alias("removed_words"),
        (~failed & (removed <= max_removed * F.col("n_words"))).alias("kept"),
    )


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                         enough_docs: int | None = ENOUGH_DOCS, long_docs: int | None = LONG_DOCS, **limits) -> DataFrame:
    """(doc_id, text): every row's text without its shared lines (see ``shared_lines``), lines in their order."""
    shared = written(shared_lines(_features(docs, id_col, text_col, host_col), enough_docs=enough_docs, long_docs=long_docs, **limits))
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                               F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("text")))
    lines = rows.select("row", "host", F.posexplode(F.split("text", "\n")).alias("place", "line")).withColumn("h", F.xxhash64(normalised(F.col("line"))))
    stay = lines.join(shared, ["host", "h"], "left_anti").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))
    return rows.drop("text").join(stay, "row", "left").select("doc_id", F.coalesce(F.array_join("lines.line", "\n"), F.lit("")).alias("text"))
