"""Merkle manifest: a hash tree per group of rows, and one tree over the groups' roots.

Every level equijoins its nodes with the sibling indices that the others compute (XOR for binary
trees, slot offsets in a run otherwise); slot-zero rows then emit the parents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Children of a node.
FANOUT = 8
#: Columns that a leaf covers, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Runs (range partition, group) up to which their table is broadcast; beyond it, it is joined by shuffle.
BROADCAST_RUNS = 100_000
#: ``monotonically_increasing_id`` keeps the partition above this bit and the row below it.
_PARTITION_BIT = 33
_NO_PATH = "array<struct<before:string,after:string>>"


def node_hash(text: Column) -> Column:
    """Lower-case hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(text, 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of a row: each field as ``-`` if NULL, else its UTF-8 byte count, ``:`` and its text."""
    written_out = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return node_hash(F.concat(*written_out))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings on a path, level by level, left to right."""
    return node_hash(F.array_join(F.transform(path, lambda s: F.concat(s.before, s.after)), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: node_hash(F.concat(s.before, h, s.after)))


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``tree`` (first position of the row's group among all rows), ``idx`` (place in the
    group, from 0) and ``n`` (rows of the group); without ``group``.

    Rows are range-partitioned by group and order, so a group spans as many tasks as it needs; only
    one count for each partition is added up in a single task.  Equal rows are split by a spread
    number.  NULLs come first."""
    keys = [F.col(group), *map(F.col, order), F.col("spread_")]
    rows = rows.withColumn("spread_", F.monotonically_increasing_id())
    at = F.monotonically_increasing_id()
    rows = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread_").withColumn("at_", at))
    rows = rows.withColumn("part_", F.shiftright("at_", _PARTITION_BIT)).withColumn("key_", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    runs = written(rows.groupBy("part_", "key_").agg(F.count("*").alias("rows_"), F.min("at_").alias("first_")))
    parts = runs.groupBy("part_").agg(F.sum("rows_").alias("size_"))
    before = F.expr("coalesce(sum(size_) OVER (ORDER BY part_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    parts = parts.select("part_", (before - F.shiftleft("part_", _PARTITION_BIT)).alias("shift_"))
    runs = runs.join(F.broadcast(parts), "part_").withColumn("first_", F.col("first_") + F.col("shift_"))
    runs = written(runs)
    groups = runs.groupBy("key_").agg(F.min("first_").alias("tree"), F.sum("rows_").alias("n"))
    runs = runs.join(groups, "key_").select("part_", "key_", "shift_", "tree", "n")
    if runs.count() <= BROADCAST_RUNS:
        runs = F.broadcast(runs)
    # a key of this join has at most one range partition's rows
    found = rows.join(runs, ["part_", "key_"])
    found = found.withColumn("idx", F.col("at_") + F.col("shift_") - F.col("tree"))
    return found.drop("part_", "key_", "at_", "shift_", group)


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (tree, idx, n, h, ...) with ``before`` and ``after``: the other digests of their run, joined."""
    idx, h, n = F.col("idx"), F.col("h"), F.col("n")
    if fanout == 2:
        targets = F.array(idx.bitwiseXOR(F.lit(1).cast("long")))
    else:
        slot = idx % fanout
        targets = F.array(*[idx - slot + (slot + offset) % fanout for offset in range(1, fanout)])
    shifted = nodes.where(n > 1).select("tree", idx.alias("from_"), "h", n.alias("n_"), F.explode(targets).alias("idx"))
    shifted = shifted.where(F.col("idx") < F.col("n_"))
    others = shifted.groupBy("tree", "idx").agg(F.array_sort(F.collect_list(F.struct("from_", "h"))).alias("others_"))
    joined = nodes.join(others, ["tree", "idx"], "left")

    def side(keep) -> Column:
        return F.coalesce(F.array_join(F.transform(F.filter("others_", keep), lambda o: o.h), ""), F.lit(""))

    return joined.withColumns({"before": side(lambda o: o.from_ < F.col("idx")), "after": side(lambda o: o.from_ > F.col("idx"))}).drop("others_")


def tree_levels(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees of ``nodes`` (tree, idx, n, h, ...), lowest first, and their roots (tree, h)."""
    levels, tops = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        level = written(with_siblings(nodes, fanout))
        levels.append(level)
        tops.append(level.where("n = 1").select("tree", "h"))
        if most <= 1:
            break
        most = -(-most // fanout)
        zero = level.where((F.col("n") > 1) & (F.col("idx") % fanout == 0))
        parent = node_hash(F.concat("h", "after"))
        nodes = zero.select("tree", F.expr(f"idx div {fanout}").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), parent.alias("h"))
    roots = tops[0]
    for top in tops[1:]:
        roots = roots.unionByName(top)
    return levels, roots


def paths(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The lowest level with ``top`` (its tree's root) and ``path``: siblings from that level up, then
    the path of the tree's root.

    ``tops`` has (tree, top, path) for every root.  Each level takes over its parents' paths; a
    parent has at most ``fanout`` children, so no key is hot."""
    above = None
    for level in reversed(levels):
        found = level.where("n = 1").join(tops, "tree")
        if above is not None:
            up = above.select("tree", F.col("idx").alias("parent_"), "top", F.col("path").alias("up_"))
            here = level.where("n > 1").withColumn("parent_", F.expr(f"idx div {fanout}")).join(up, ["tree", "parent_"])
            own = F.array(F.struct("before", "after"))
            found = found.unionByName(here.withColumn("path", F.concat(own, F.col("up_"))).drop("up_", "parent_"))
        above = found
    return above


def merkle_manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS, fanout: int = FANOUT, present: Mapping[str, Column] | None = None
) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, now, folded_root, verified) of every row of ``docs``.

    Each row is a leaf.  The leaves of a group ascend by id (then by leaf); while a group has
    several nodes, each ``fanout`` consecutive ones become their hash (the last run may be shorter,
    even one node).  The groups' roots, NULL first and by the groups' UTF-8 bytes, form one more
    tree.  ``path`` holds the digests before and after the node in its run, from the leaf to the
    root.  ``present`` gives expressions for fields as they are found now; ``now`` is their
    leaf, ``folded_root`` what it and the path lead to, ``verified`` whether that is the root.

    NULL fields count as ``-``; NULL ids come first; equal rows are separate leaves with equal
    hashes; an empty table has no rows; other columns, whatever their names, are ignored.
    """
    if fanout < 2:
        raise ValueError("a node needs at least two children")
    now = leaf_hash([(present or {}).get(f, F.col(f)) for f in fields])
    leaves = docs.select(F.col(id_col).alias("doc_id"), F.col(group_col).cast("string").alias("group_"), leaf_hash([F.col(f) for f in fields]).alias("h"), now.alias("now"))
    nodes = written(ranked(written(leaves), "group_", ["doc_id", "h"]))
    levels, subroots = tree_levels(nodes, fanout)
    groups = written(ranked(subroots.select("h", F.col("tree").alias("of_"), F.lit(0).alias("group_")), "group_", ["of_"]))
    upper, roots = tree_levels(groups, fanout)
    found = roots.first()
    root = F.lit(found.h if found else None).cast("string")
    tops = paths(upper, roots.select("tree", F.col("h").alias("top"), F.array().cast(_NO_PATH).alias("path")), fanout)
    tops = written(tops.select(F.col("of_").alias("tree"), F.col("h").alias("top"), "path"))
    rows = paths(levels, tops, fanout).withColumn("folded_root", folded(F.col("now"), F.col("path")))
    return rows.select("doc_id", F.col("h").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), "path", "now", "folded_root", (F.col("folded_root") == root).alias("verified"))


def manifest_digests(docs: DataFrame) -> DataFrame:
    """Manifest of ``documents`` with a third of them tampered with.

    Where 3 divides the unsigned CRC-32 of the decimal id (NULL: of no text), A-Z of the text are
    found lower-cased; NULL texts stay."""
    from .common import ascii_lower

    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 0
    rows = merkle_manifest(docs, present={"text": F.when(hit, ascii_lower(F.col("text"))).otherwise(F.col("text"))})
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
