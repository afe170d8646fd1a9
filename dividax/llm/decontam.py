"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_bytes, text_slices

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
NUM_HASHES = 32
#: Shingles a signature block covers; windows are runs of whole blocks.
BLOCK = 8
#: Bound on one pass: at most so many bytes of benchmark text are broadcast at a time.
ITEM_BLOCK_BYTES = 16 << 20


def _words(raw, offsets):
    """(word hashes, first word and number of words of each text)."""
    import numpy as np

    from .hashing import LOOSE

    start, end, doc = LOOSE.spans(raw, offsets)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    return LOOSE.hashes(raw, start, end), np.cumsum(count) - count, count


def _shingles(words, k: int):
    """Hash of every run of ``k`` words and its text, in order of the texts; shorter texts have none."""
    import numpy as np

    from .hashing import chain, mix

    word, first, count = words
    runs = np.maximum(count - k + 1, 0)
    owner = np.repeat(np.arange(len(count)), runs)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(first, runs)
    value = mix(np.full(len(at), k, np.uint64))
    for j in range(k):
        value = chain(value, word[at + j]) if len(at) else value
    return value, owner


def _families(num_hashes: int):
    """Fixed odd multipliers and offsets of the MinHash functions."""
    import numpy as np

    from .hashing import mix

    seeds = mix(np.arange(1, 2 * num_hashes + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return seeds[:num_hashes] | np.uint64(1), seeds[num_hashes:]


def _permuted(values, mult, add):
    """32-bit value of one MinHash function for every shingle (high half of a multiply-add)."""
    import numpy as np

    return ((values * mult + add) >> np.uint64(32)).astype(np.uint32)


class ItemIndex:
    """Bounded block of test items: shingle sets, and signatures partitioned by size.

    An item's partition is the number of blocks in a window that is sure to cover it wherever
    it begins; each partition holds, per hash function, the sorted minima and their items.  Items of few
    shingles are looked up exactly instead: by as many of their shingles as can't all be missing."""

    def __init__(self, texts: list[str], num_hashes: int, k: int, min_containment: float):
        import numpy as np
        import pyarrow as pa

        words = _words(*text_bytes(pa.table({"t": pa.array(texts, pa.string())}), "t"))
        self.k, self.num_hashes = k, num_hashes
        mult, add = _families(num_hashes)
        self.sets = [np.zeros(0, np.uint64)] * len(texts)
        self.length = np.minimum(words[2], k)  # shingle length of each item
        looked_up: dict[int, list] = {}
        by_size: dict[int, list[int]] = {}
        for length in np.unique(self.length[self.length > 0]).tolist():
            value, owner = _shingles(words, length)
            for i in np.flatnonzero(self.length == length).tolist():
                at = np.searchsorted(owner, [i, i + 1])
                self.sets[i] = shingles = np.unique(value[at[0] : at[1]])
                if len(shingles) <= BLOCK:
                    needed = max(int(np.ceil(min_containment * len(shingles) - 1e-9)), 1)
                    looked_up.setdefault(length, []).extend((h, i) for h in shingles[: len(shingles) - needed + 1].tolist())
                else:
                    by_size.setdefault(-(-len(shingles) // BLOCK) + 1, []).append(i)
        self.exact = {}
        for length, found in looked_up.items():
            found.sort()
            self.exact[length] = np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found], np.int64)
        self.partitions = {}
        for blocks, members in sorted(by_size.items()):
            tables = []
            for h in range(num_hashes):
                minima = np.array([_permuted(self.sets[i], mult[h], add[h]).min() for i in members], np.uint32)
                order = np.argsort(minima, kind="stable")
                tables.append((minima[order], np.array(members)[order]))
            self.partitions[blocks] = tables


def _pairs(found, owner, table, items):
    """(document, item) wherever a value of ``found`` stands in the sorted ``table``."""
    import numpy as np

    low = np.searchsorted(table, found)
    hit = np.flatnonzero(table[np.minimum(low, len(table) - 1)] == found)
    low, high = low[hit], np.searchsorted(table, found[hit], side="right")
    spread = high - low
    pick = np.repeat(low - (np.cumsum(spread) - spread), spread) + np.arange(int(spread.sum()))
    return np.unique(np.stack([np.repeat(owner[hit], spread), items[pick]], axis=1), axis=0)


def _candidates(value, owner, index: ItemIndex):
    """(document, item) pairs that agree in a MinHash of some window; windows of every size partition."""
    import numpy as np

    if not len(value) or not index.partitions:
        return np.zeros((0, 2), np.int64)
    # documents without shingles take no part
    names, owner = np.unique(owner, return_inverse=True)
    # documents are padded to whole blocks, so that a block belongs to one document
    count = np.bincount(owner)
    blocks = -(-count // BLOCK)
    pad_first = (np.cumsum(blocks) - blocks) * BLOCK
    place = np.arange(len(value)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(pad_first, count)
    total = int(blocks.sum())
    block_doc = np.repeat(np.arange(len(count)), blocks)
    mult, add = _families(index.num_hashes)
    sizes = sorted(index.partitions)
    found = []
    for h in range(index.num_hashes):
        padded = np.full(total * BLOCK, np.iinfo(np.uint32).max, np.uint32)
        padded[place] = _permuted(value, mult[h], add[h])
        window, width = padded.reshape(total, BLOCK).min(axis=1), 1
        for size in sizes:
            while width < size:  # widen: a window of w + s blocks is two windows of w, s blocks apart
                step = min(width, size - width)
                wide = window.copy()
                np.minimum(wide[:-step], window[step:], out=wide[:-step])
                window, width = wide, width + step
            found.append(_pairs(window, block_doc, *index.partitions[size][h]))
    found = [np.stack([names[f[:, 0]], f[:, 1]], axis=1) for f in found]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", min_containment: float = MIN_CONTAINMENT, num_hashes: int = NUM_HASHES,
                    k: int = SHINGLE_WORDS, item_block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): items contained in documents.

    Words are letters, digits and non-ASCII characters (ASCII punctuation separates), A-Z
    lower-cased; an item of fewer than ``k`` words is one shingle of all its words, found wherever
    a document has them in a row.  Containment is the share of the item's distinct
    shingles that the document has.  Items are partitioned by size; each partition compares the
    MinHash of an item with those of document windows just long enough to cover it (items of at most
    ``BLOCK`` shingles are looked up by the shingles themselves), and each
    candidate is verified on the exact shingle sets.  No document rows are shuffled: the items
    are broadcast in blocks of at most ``item_block_bytes`` of text, one pass over the documents
    for each block (an item larger than a block has a block of its own).

    NULL or blank texts and items contain nothing and are contained in nothing; a repeated row
    gives its rows again; NULL ids stay NULL; other columns are ignored.
    """
    rows = items.select(F.col(item_col).alias("i"), F.coalesce(F.col(item_text_col), F.lit("")).alias("t")).withColumn("n", F.octet_length("t"))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item_type = items.schema[item_col].dataType
    schema = T.StructType([
        source.schema["doc_id"], T.StructField("item_id", item_type), T.StructField("n_shingles", T.LongType()),
        T.StructField("n_shared", T.LongType()), T.StructField("containment", T.DoubleType()),
    ])
    out = None
    for index in _indexes(docs.sparkSession, rows, num_hashes, k, min_containment, item_block_bytes):
        part = source.mapInArrow(_search(index, min_containment, schema), schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _indexes(spark, rows: DataFrame, num_hashes: int, k: int, min_containment: float, item_block_bytes: int) -> Iterator:
    """A broadcast (index, item ids) of every bounded block of items."""
    for block in _item_blocks(rows, item_block_bytes):
        yield spark.sparkContext.broadcast((ItemIndex([t for _, t in block], num_hashes, k, min_containment), [i for i, _ in block]))


def _item_blocks(rows: DataFrame, most: int) -> Iterator[list]:
    """The items in blocks of bounded text size, fetched one partition at a time."""
    block, size = [], 0
    for row in rows.orderBy("i", "t").toLocalIterator():
        if block and size + row.n > most:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += row.n
    if block:
        yield block


def _hits(part, index: ItemIndex, min_containment: float) -> list[tuple[int, int, int, int]]:
    """(row, item, item's shingles, shared shingles) of every item contained in a text of ``part``."""
    import numpy as np

    words = _words(*text_bytes(part, "text"))
    value, owner = _shingles(words, index.k)
    pairs = [_candidates(value, owner, index)]
    rows = []
    for length, (table, items) in index.exact.items():
        found = _pairs(*((value, owner) if length == index.k else _shingles(words, length)), table, items)
        if length == index.k:
            pairs.append(found)
        else:  # one shingle, found as it is
            rows += [(d, i, 1, 1) for d, i in found.tolist()]
    pairs = np.unique(np.concatenate(pairs), axis=0)
    begin = np.searchsorted(owner, np.arange(part.num_rows + 1))
    starts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
    for members in np.split(pairs, starts[1:]) if len(pairs) else []:
        d = int(members[0, 0])
        has = np.unique(value[begin[d] : begin[d + 1]])
        for i in members[:, 1].tolist():
            wanted = index.sets[i]
            common = int(np.isin(wanted, has, assume_unique=True).sum())
            if common >= min_containment * len(wanted):
                rows.append((d, i, len(wanted), common))
    return rows


def _search(shared, min_containment: float, schema):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        index, ids = shared.value
        id_type = to_arrow_type(schema["item_id"].dataType)
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = _hits(part, index, min_containment)
                if rows:
                    at, which, size, common = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id").take(pa.array(at)), pa.array([ids[i] for i in which], id_type),
                        pa.array(size, pa.int64()), pa.array(common, pa.int64()),
                        pa.array([c / s for c, s in zip(common, size, strict=True)], pa.float64()),
                    ], names=schema.names)

    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, n_items, max_containment, item_ids) of the documents that contain an item.

    Repeated rows of an id give one row; ``item_ids`` is sorted (as long as the items found in it)."""
    hits = contained_items(docs, items, id_col, text_col, **how).distinct()
    return hits.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), F.max("containment").alias("max_containment"), F.sort_array(F.collect_set("item_id")).alias("item_ids"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_containment: float = MIN_CONTAINMENT,
    num_hashes: int = NUM_HASHES, k: int = SHINGLE_WORDS, item_block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, columns unchanged; each row is judged by its own text.

    Rows go through one filter for each block of items, all in the task that read them; nothing is shuffled."""
    rows = items.select(F.col(item_col).alias("i"), F.coalesce(F.col(item_text_col), F.lit("")).alias("t")).withColumn("n", F.octet_length("t"))
    place = docs.columns.index(text_col)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    for index in _indexes(docs.sparkSession, rows, num_hashes, k, min_containment, item_block_bytes):
        kept = kept.mapInArrow(_drop(index, min_containment, place), kept.schema)
    return kept.select("row.*")


def _drop(shared, min_containment: float, place: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        index, _ = shared.value
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pc.struct_field(batch.column("row"), [place])], names=["text"])
            keep, before = np.ones(batch.num_rows, bool), 0
            for part in text_slices(texts, "text"):
                keep[[before + hit[0] for hit in _hits(part, index, min_containment)]] = False
                before += part.num_rows
            yield batch.filter(pa.array(keep))

    return run
