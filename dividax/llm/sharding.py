"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

DataFrame functions only; the map has one row per slot, however many rows the slots hold."""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written

SHARDS = 8
SLOTS = 4096
#: Hashes that equal rows are dealt to, and repeated rows up to which their keys are broadcast.
SPREAD = 1024
BROADCAST_REPEATS = 100_000


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0 of the map: shard of each slot, dealt in turn."""
    return [s % shards for s in range(slots)]


def rebalanced(owner: list[int], size: list[int], shards: int) -> list[int]:
    """A new version of the map: slots move from the fullest to the emptiest shard, each time the
    one whose size comes closest to half the difference, until no move brings the two closer.

    ``owner`` and ``size`` are the shard and the bytes of each slot.  A map for more shards than
    ``owner`` has leaves the new ones empty at first, so that slots move into them."""
    owner = list(owner)
    held = [sorted((size[s], s) for s, o in enumerate(owner) if o == k) for k in range(shards)]
    full = [sum(b for b, _ in h) for h in held]
    while shards > 1:
        top, low = max(range(shards), key=full.__getitem__), min(range(shards), key=full.__getitem__)
        gap = full[top] - full[low]
        at = bisect.bisect_left(held[top], (gap / 2, -1))
        near = [x for x in held[top][max(at - 1, 0) : at + 1] if 0 < x[0] < gap]
        if not near:
            break
        moved = min(near, key=lambda x: (abs(x[0] - gap / 2), x[1]))
        held[top].remove(moved)
        bisect.insort(held[low], moved)
        full[top], full[low] = full[top] - moved[0], full[low] + moved[0]
        owner[moved[1]] = low
    return owner


def with_new_shard(owner: list[int], size: list[int], shards: int) -> list[int]:
    """A new version with one more shard, which takes slots, the largest fitting ones, only into itself
    until it holds an equal part."""
    owner, want, got = list(owner), sum(size) / (shards + 1), 0
    full = [0] * shards
    held: list[list] = [[] for _ in range(shards)]
    for s, o in enumerate(owner):
        full[o] += size[s]
        held[o].append((-size[s], s))
    queue = [(-f, k) for k, f in enumerate(full)]
    heapq.heapify(queue)
    for h in held:
        h.sort()
    while queue and got < want:
        _, k = heapq.heappop(queue)
        fit = next((x for x in held[k] if got - x[0] <= want and full[k] + x[0] >= 0 and x[0] < 0), None)
        if fit is None:
            continue
        held[k].remove(fit)
        owner[fit[1]], got, full[k] = shards, got - fit[0], full[k] + fit[0]
        heapq.heappush(queue, (-full[k], k))
    return owner


def next_map(owner: list[int], size: list[int], shards: int) -> list[int]:
    """The version after ``owner``, for ``shards`` shards: balanced anew, or first grown by one shard at a time."""
    had = max(owner, default=-1) + 1
    if had > shards:
        raise ValueError(f"the map has {had} shards; it can't shrink to {shards}")
    if 0 < had < shards:
        for k in range(had, shards):
            owner = with_new_shard(owner, size, k)
        return owner
    return rebalanced(owner, size, shards)


def _records(docs: DataFrame, id_col: str, text_col: str, slots: int, *others) -> DataFrame:
    """``docs`` as (``others``, key, virtual_slot): the slot is a hash of id and text; of rows that have an equal
    one, all are dealt to SPREAD hashes by their place in the input."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))
    rows = docs.select(*others, F.xxhash64(id_col, text_col).alias("key_"), spread.alias("spread_"))
    repeats = written(docs.select(F.xxhash64(id_col, text_col).alias("key_")).groupBy("key_").agg(F.count("*").alias("n_")).where("n_ > 1").select("key_"))
    if repeats.count() <= BROADCAST_REPEATS:
        rows = rows.join(F.broadcast(repeats.withColumn("again_", F.lit(True))), "key_", "left")
    else:  # rows are dealt by the spread too, so that an often repeated one isn't a single key
        copies = repeats.select("key_", F.lit(True).alias("again_"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("spread_"))
        rows = rows.join(copies, ["key_", "spread_"], "left")
    own = F.pmod(F.when(F.col("again_"), F.xxhash64("key_", "spread_")).otherwise(F.col("key_")), F.lit(slots)).cast("int")
    return rows.withColumn("virtual_slot", own).drop("key_", "spread_", "again_")


def sharded(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False,
            previous: DataFrame | None = None, map_path: str | None = None) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of nearly equal bytes.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version).  A record's
    virtual slot is a hash of its id and text (so rows without id, or copies with ids of their own,
    spread over the slots; repeated rows are spread by their place); the bytes of each slot are summed.
    Version 0 of the slot-to-shard map deals the slots in turn, version 1 is edited to balance the bytes.
    ``previous``, a stored map, is edited instead: its last version is balanced anew or, for more shards,
    takes slots into the new ones only.  All versions with the slots' totals are written to ``map_path`` (a
    new one; else to the shared folder), to be read as the next run's ``previous``.

    ``size`` is the text's UTF-8 bytes plus one, NULL counting as no bytes; ``text_crc32`` of NULL is that
    of the empty text; ``slot`` numbers a shard's rows without a gap from 0; ``grown_shard`` is NULL, as the
    law is "bytes".  An empty table gives no rows.  ``keep_columns`` returns the columns of ``docs`` and
    only ``shard`` and ``virtual_slot`` beside them; columns of ``docs`` with these two names are replaced.

    Only the totals, ``slots`` rows, reach the driver, and only the map, ``slots`` rows, is broadcast.
    """
    spark = docs.sparkSession
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(_records(hashed, "doc_id", "text", slots, "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")))
    total = {r.virtual_slot: (r.bytes, r.n) for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    size = [total.get(s, (0, 0))[0] for s in range(slots)]
    first, version = first_map(shards, slots), 0
    if previous is not None:
        version = previous.agg(F.max("map_version")).first()[0]
        first = [r.shard for r in previous.where(F.col("map_version") == version).orderBy("virtual_slot").collect()]
        if len(first) != slots:
            raise ValueError(f"the stored map has {len(first)} slots instead of {slots}")
    latest = next_map(first, size, shards)
    offset, filled = [], [0] * shards
    for s, shard in enumerate(latest):  # rows of the shard in lower slots
        offset.append(filled[shard])
        filled[shard] += total.get(s, (0, 0))[1]
    columns = "map_version int, virtual_slot int, shard int, bytes long, offset long"
    table = [] if previous is not None else [(0, s, shard, size[s], None) for s, shard in enumerate(first)]
    table += [(version + 1, s, shard, size[s], offset[s]) for s, shard in enumerate(latest)]
    versions = spark.createDataFrame(table, columns).coalesce(1)
    if previous is not None:
        versions = previous.select("map_version", "virtual_slot", "shard", "bytes", "offset").unionByName(versions).coalesce(1)
    if map_path:
        versions.write.parquet(map_path)
        stored = spark.read.schema(versions.schema).parquet(map_path)
    else:
        stored = written(versions)
    current = F.broadcast(stored.where(F.col("map_version") == version + 1).select("virtual_slot", "shard", "offset", "map_version"))
    if keep_columns:
        names = [c for c in docs.columns if c.lower() not in ("shard", "virtual_slot")]
        row = _records(docs, id_col, text_col, slots, F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
        return row.join(current, "virtual_slot", "left").select("row.*", F.col("shard").alias("shard"), F.col("virtual_slot").alias("virtual_slot"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("place", F.row_number().over(within)).join(current, "virtual_slot", "left").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
