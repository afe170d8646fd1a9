"""SimHash near-duplicates: fingerprints, pigeonring candidates, components, one copy kept."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices, written
from .components import connected_components

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 8
LARGE_BUCKET = 512


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE_WORDS, seed: int = 42) -> DataFrame:
    """``docs`` with the text replaced by ``simhash`` (long, the 64 bits).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; every run of ``shingle`` words
    (repeats included; the whole sequence if shorter) is hashed with XXH64, and a bit is
    set if it is set in over half of the hashes.  NULL, empty and blank texts get 0.
    """
    names = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("simhash", T.LongType(), False)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in text_slices(batch, text_col):
                marks = [_simhash(text, shingle, seed) for text in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(marks, pa.int64())], names=[*names, "simhash"])

    return docs.mapInArrow(run, schema)


def _simhash(text: str | None, shingle: int, seed: int) -> int:
    from itertools import repeat

    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, runs, repeat(seed))), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded scratch space for very long texts
        ones += np.unpackbits(hashes[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def _segments(m: int) -> list[int]:
    """Widths of ``m`` consecutive segments that cover the 64 bits."""
    return [BITS // m + (i < BITS % m) for i in range(m)]


def _rotated(value: Column, by: int) -> Column:
    return value if by % BITS == 0 else F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))


def link_fingerprints(marks: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, large: int = LARGE_BUCKET) -> DataFrame:
    """(a, b): links among distinct fingerprints (column ``simhash``) that join all pairs at
    ``max_bits`` or fewer differing bits.

    Pigeonring: cut the bits into a ring of ``segments``; a pair within the bound has a start
    from which every chain of l consecutive segments differs in at most l * max_bits / segments
    bits.  The chain of the leading segments whose budget is zero is the join key; the longer
    chains prune in the join condition, and the chain of all segments is the full Hamming check.

    In keys shared by more than ``large`` fingerprints no pairs are formed: there every
    fingerprint is joined with its one-bit neighbours (two bits apart means a common neighbour),
    which is exact and linear.  That way holds for ``max_bits`` up to 2, so a larger bound
    compares all pairs of a key.
    """
    widths = _segments(segments)
    lead = max(l for l in range(1, segments + 1) if l * max_bits < segments or l == 1)
    if max_bits >= segments:
        raise ValueError("segments must exceed max_bits: the ring needs a chain without differences")
    starts = [sum(widths[:i]) for i in range(segments)]
    key_bits = [sum(widths[(i + j) % segments] for j in range(lead)) for i in range(segments)]
    keyed = marks.select("simhash", F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), F.shiftrightunsigned(_rotated(F.col("simhash"), starts[i]), BITS - key_bits[i]).alias("key"))
        for i in range(segments)
    ])).alias("k")).select("simhash", "k.start", "k.key")
    sizes = keyed.groupBy("start", "key").count().where("count > 1")
    keyed = written(keyed.join(sizes, ["start", "key"]))
    pairs = keyed if max_bits > 2 else keyed.where(F.col("count") <= large)
    differ = F.col("a").bitwiseXOR(F.col("b"))

    def chain_ok(i: int) -> Column:
        turned, ok, bits = _rotated(differ, starts[i]), F.lit(True), 0
        for l in range(1, segments + 1):
            bits += widths[(i + l - 1) % segments]
            if l > lead:
                head = turned if bits == BITS else F.shiftrightunsigned(turned, BITS - bits)
                ok = ok & (F.bit_count(head) <= l * max_bits // segments)
        return ok

    ring = F.lit(False)
    for i in range(segments):
        ring = ring | ((F.col("start") == i) & chain_ok(i))
    left = pairs.select("start", "key", F.col("simhash").alias("a"))
    right = pairs.select("start", "key", F.col("simhash").alias("b"))
    links = left.join(right, ["start", "key"]).where((F.col("a") < F.col("b")) & ring).select("a", "b")
    if max_bits <= 2:
        crowd = keyed.where(F.col("count") > large).select("simhash").distinct()
        flips = [F.lit(0).cast("long")] + [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(BITS)]
        if max_bits == 2:
            near = crowd.select("simhash", F.explode(F.transform(F.array(*flips), lambda x: x.bitwiseXOR(F.col("simhash")))).alias("mid"))
            hub = near.groupBy("mid").agg(F.min("simhash").alias("least"), F.count("*").alias("n")).where("n > 1")
            links = links.union(near.join(hub, "mid").where("simhash != least").select(F.col("least").alias("a"), F.col("simhash").alias("b")))
        else:
            near = crowd.select("simhash", F.explode(F.transform(F.array(*flips[1:]), lambda x: x.bitwiseXOR(F.col("simhash")))).alias("other")) if max_bits else crowd.where("false").select("simhash", F.col("simhash").alias("other"))
            links = links.union(near.join(crowd.select(F.col("simhash").alias("other")), "other", "left_semi").select(F.col("simhash").alias("a"), F.col("other").alias("b")))
    return links.distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, **how) -> DataFrame:
    """(doc_id, simhash, component_id) of every row of ``docs``; other columns are ignored.

    ``component_id`` is the least id reachable over fingerprints within ``max_bits`` bits.
    Equal fingerprints are one node, so copies never meet as pairs.  A NULL id takes part but
    is never a component's id (unless the component has no other); repeated rows stay; an empty
    table gives no rows; empty texts share the fingerprint 0.
    """
    shingle = how.pop("shingle", SHINGLE_WORDS)
    marked = written(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", shingle).select("doc_id", "simhash"))
    nodes = written(marked.groupBy("simhash").agg(F.min("doc_id").alias("least_id")))
    parts = connected_components(link_fingerprints(nodes.select("simhash"), max_bits, **how))
    placed = nodes.join(parts, nodes.simhash == parts.node, "left").select("simhash", "least_id", F.coalesce("component", "simhash").alias("component"))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = placed.join(least, "component").select("simhash", "component_id")
    return marked.join(ids, "simhash").select("doc_id", "simhash", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, one for each component: the row with the component's least id.

    Rows are told apart by id and text, so of rows that share an id (or have none) only those in one
    component stand for each other.  Rows with an id come before those without; of several texts with
    the least id one stays by its hash, and of repeated rows one by a hash of all columns.  All
    columns, whatever their names, are returned unchanged.
    """
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    found = simhash_components(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", **how)
    keep = found.groupBy("component_id").agg(F.count(F.when(F.col("doc_id") == F.col("component_id"), 1)).alias("n"))
    keep = keep.select(F.col("component_id.id").alias("k_id"), F.col("component_id.h").alias("k_h"), "n")
    keyed = row.join(keep, F.col("key.id").eqNullSafe(F.col("k_id")) & (F.col("key.h") == F.col("k_h")))
    # keys that name one row need no further look; for the others one row is chosen
    alone = keyed.where("n = 1").select("row")
    chosen = keyed.where("n > 1").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return alone.union(chosen).select("row.*")
