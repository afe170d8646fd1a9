"""Katz backoff language model: Good-Turing counts, exactly normalised backoff weights, scoring.

Data flow (every arrow is a Spark shuffle or a written table in the shared folder):

1. texts are packed into blocks of bounded size;
2. each block sends its distinct n-grams, as 64-bit hashes with counts, to hash-range buckets;
3. buckets add the counts up, store the count table, and answer every block;
4. blocks score what needs no backoff weight, and send, per context, the discounted mass and
   the lower-order mass of the n-grams they own (one block owns each distinct n-gram);
5. context buckets compute and store the backoff weights, and score the tokens that back off.

Per-document sums meet at the end.  Only counts of counts, a few numbers per order, reach the
driver.  An n-gram's rows are one per block, so frequent words, pairs and copies are combined
before every shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_bytes, written

ORDER = 2
#: Text bytes of a block: bounds a task's memory.
BLOCK_BYTES = 12 << 20
#: Text bytes for which there is one bucket of n-grams.
BUCKET_BYTES = 24 << 20
#: Counts up to this one are discounted by Turing's ratio, larger ones by its log-linear fit.
TURING_MAX = 5
FIT_MAX = 20
_END, _BEGIN = 0xE2D0E2D0E2D0E2D1, 0xB0E6B0E6B0E6B0E7


# ---------------------------------------------------------------- packed arrays

def _pack(values) -> bytes:
    """64-bit integers as compressed byte planes; ascending values pack as differences."""
    import numpy as np
    import zstandard

    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(blob: bytes):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def _pack_sorted(values) -> bytes:
    import numpy as np

    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(blob: bytes):
    import numpy as np

    return np.cumsum(_unpack(blob), dtype=np.uint64)


def _slices(sorted_hashes, buckets: int):
    """(bucket, from, to) of the hash ranges that hold some of the values."""
    import numpy as np

    edges = [(b << 64) // buckets for b in range(1, buckets)]
    cuts = [0, *np.searchsorted(sorted_hashes, np.array(edges, np.uint64)).tolist(), len(sorted_hashes)]
    return [(b, cuts[b], cuts[b + 1]) for b in range(buckets) if cuts[b] < cuts[b + 1]]


def _batch(schema, rows: list[tuple]):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)


# ---------------------------------------------------------------- blocks

def _blocks(texts: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of ``texts`` (row, train, text) packed: block, rows, train, sizes, compressed text."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(texts.schema["row"].dataType)),
        T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("text", T.BinaryType()),
    ])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush():
            nonlocal number, held, size
            table = pa.Table.from_batches(held)
            raw, offsets = text_bytes(table, "text")
            out = pa.RecordBatch.from_arrays([
                pa.array([(part << 32) | number], pa.int64()),
                *(pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column(c).combine_chunks()) for c in ("row", "train")),
                pa.array([np.diff(offsets)], pa.list_(pa.int64())),
                pa.array([zstandard.compress(raw.tobytes(), 1)], pa.binary()),
            ], names=schema.names)
            number, held, size = number + 1, [], 0
            return out

        for batch in batches:
            _, offsets = text_bytes(batch, "text")
            cut = 0
            while cut < batch.num_rows:
                fits = int(np.searchsorted(offsets, offsets[cut] + block_bytes - size, side="right")) - 1
                stop = min(max(fits, cut + (not held)), batch.num_rows)
                if stop > cut:
                    held.append(batch.slice(cut, stop - cut))
                    size += int(offsets[stop] - offsets[cut])
                if stop < batch.num_rows or size >= block_bytes:
                    yield flush()
                cut = stop
        if held:
            yield flush()

    return texts.mapInArrow(run, schema)


class _Grams:
    """The token stream of a block: begin mark, words, end mark for each text."""

    def __init__(self, row: dict, order: int):
        import numpy as np
        import zstandard

        from .hashing import PLAIN, chain

        sizes = np.array(row["sizes"], np.int64)
        raw = np.frombuffer(zstandard.decompress(row["text"]), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        start, end, doc = PLAIN.spans(raw, offsets)
        self.n = len(sizes)
        self.words = np.bincount(doc, minlength=self.n)
        length = self.words + 2
        first = np.cumsum(length) - length
        token = np.empty(int(length.sum()), np.uint64)
        self.doc = np.repeat(np.arange(self.n, dtype=np.int32), length)
        self.place = np.arange(len(token), dtype=np.int64) - np.repeat(first, length)
        inner = (self.place > 0) & (self.place <= np.repeat(self.words, length))
        token[inner] = PLAIN.hashes(raw, start, end)
        token[first], token[first + length - 1] = np.uint64(_BEGIN), np.uint64(_END)
        self.train = np.array(row["train"], bool)[self.doc]
        self.hashes = [token]  # hashes[m - 1][j]: the n-gram of order m that ends at token j
        for _ in range(1, order):
            longer = np.zeros_like(token)
            longer[1:] = chain(self.hashes[-1][:-1], token[1:])
            self.hashes.append(longer)

    def valid(self, m: int):
        """Tokens that end an n-gram of order m within their text."""
        return self.place >= m - 1


_SENT = T.StructType([T.StructField("order", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                      T.StructField("block", T.LongType()), T.StructField("hashes", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def _send_grams(order: int, buckets: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams = _Grams(row, order)
                for m in range(1, order + 1):
                    ok = grams.valid(m)
                    every = np.unique(grams.hashes[m - 1][ok])
                    seen, n = np.unique(grams.hashes[m - 1][ok & grams.train], return_counts=True)
                    count = np.zeros(len(every), np.uint64)
                    count[np.searchsorted(every, seen)] = n
                    rows = [(m, b, row["block"], _pack_sorted(every[x:y]), _pack(count[x:y])) for b, x, y in _slices(every, buckets)]
                    yield _batch(_SENT, rows)

    return run


# ---------------------------------------------------------------- counts

_COUNTED = T.StructType([T.StructField("kind", T.StringType()), T.StructField("order", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                         T.StructField("block", T.LongType()), T.StructField("hashes", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                         T.StructField("stats", T.ArrayType(T.LongType()))])


def _count_bucket(table):
    """Add up a bucket's counts; answer every block in the order it asked."""
    import numpy as np
    import pyarrow as pa

    table = table.sort_by("block")
    m, bucket = table.column("order")[0].as_py(), table.column("bucket")[0].as_py()
    parts = [_unpack_sorted(x.as_py()) for x in table.column("hashes")]
    every = np.concatenate(parts)
    own = np.concatenate([_unpack(x.as_py()) for x in table.column("counts")])
    by = np.argsort(every, kind="stable")
    sorted_hashes = every[by]
    head = np.flatnonzero(np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]]))
    group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(every))))
    total = np.add.reduceat(own[by], head)
    # answer: twice the count, plus one for the block that owns the n-gram (the first to train on it)
    trains = own[by] > 0
    order_in = np.flatnonzero(trains)
    firsts = order_in[np.unique(group[order_in], return_index=True)[1]]
    answer_sorted = (total * np.uint64(2))[group]
    answer_sorted[firsts] += np.uint64(1)
    answer = np.empty_like(answer_sorted)
    answer[by] = answer_sorted
    rows, at = [], 0
    for block, part in zip(table.column("block").to_pylist(), parts, strict=True):
        rows.append(("answer", m, bucket, block, None, _pack(answer[at : at + len(part)]), None))
        at += len(part)
    keep = total > 0
    grams, counts = sorted_hashes[head][keep], total[keep]
    rows.append(("model", m, bucket, None, _pack_sorted(grams), _pack(counts), None))
    if m == 1:
        counts = counts[grams != np.uint64(_BEGIN)]
    of = np.bincount(np.minimum(counts, FIT_MAX + 2).astype(np.int64), minlength=FIT_MAX + 3)
    rows.append(("stats", m, bucket, None, None, None, [int(counts.sum()), len(counts), *of[1 : FIT_MAX + 2].tolist()]))
    return pa.Table.from_batches([_batch(_COUNTED, rows)])


def good_turing(count_of_counts: list[int]) -> list[float]:
    """Discounted counts r* for r = 1 .. TURING_MAX, then the slope of the log-linear fit.

    Turing's ratio (r + 1) n[r + 1] / n[r] up to ``TURING_MAX`` where it lies in (0, r); else, and
    above, the fitted r (1 + 1/r) ** (slope + 1).  The slope is held below -1, so every count is
    discounted and every seen context leaves some mass."""
    import math

    points = [(math.log(r), math.log(n)) for r, n in enumerate(count_of_counts[:FIT_MAX], 1) if n > 0]
    slope = -2.0
    if len(points) > 1:
        mx, my = (sum(p[i] for p in points) / len(points) for i in (0, 1))
        slope = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
    slope = min(slope, -1.1)
    out = []
    for r in range(1, TURING_MAX + 1):
        n, more = count_of_counts[r - 1], count_of_counts[r]
        turing = (r + 1) * more / n if n else 0.0
        out.append(turing if 0 < turing < r else r * (1 + 1 / r) ** (slope + 1))
    return [*out, slope]


def _discounted(counts, table: list[float]):
    """r* of every count (0 for 0)."""
    import numpy as np

    r = counts.astype(np.float64)
    safe = np.maximum(r, 1)
    out = safe * (1 + 1 / safe) ** (table[-1] + 1)
    low = counts <= TURING_MAX
    out[low] = np.array([0.0, *table[:-1]])[counts[low].astype(np.int64)]
    return out


def _unknown_mass(model: DataFrame, table: list[float], n_all: int) -> float:
    """The probability that discounting takes from the known words: that of the unknown word."""
    if not n_all:
        return 1.0

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for hashes, counts in zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                words = _unpack_sorted(hashes) != np.uint64(_BEGIN)
                yield pa.RecordBatch.from_arrays([pa.array([float(_discounted(_unpack(counts)[words], table).sum())])], names=["mass"])

    seen = model.select("hashes", "counts").mapInArrow(run, "mass double").agg(F.sum("mass")).first()[0]
    return 1 - seen / n_all


# ---------------------------------------------------------------- scores

_PARTIAL = T.StructType([T.StructField("kind", T.StringType()), T.StructField("order", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                         T.StructField("block", T.LongType()), T.StructField("hashes", T.BinaryType()),
                         T.StructField("text", T.ArrayType(T.IntegerType())),
                         *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("x", "y", "z", "w"))])


def _score_block(order: int, buckets: int, stats: dict, tables: dict):
    """Scores without backoff weights; masses of contexts; tokens that wait for a weight."""
    n_all, n_types = stats.get(1, (0, 0))

    def run(block_table, answers):
        import numpy as np
        import pyarrow as pa

        if not block_table.num_rows:
            return pa.Table.from_batches([_batch(_PARTIAL, [])])
        row = block_table.to_pylist()[0]
        grams = _Grams(row, order)
        replies: dict[int, list] = {}
        for m, bucket, blob in sorted(zip(answers.column("order").to_pylist(), answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True), key=lambda r: r[:2]):
            replies.setdefault(m, []).append(_unpack(blob))
        size = len(grams.doc)
        count, owned = [], []
        for m in range(1, order + 1):
            at = np.flatnonzero(grams.valid(m))
            _, first, inverse = np.unique(grams.hashes[m - 1][at], return_index=True, return_inverse=True)
            reply = np.concatenate(replies[m]) if m in replies else np.zeros(0, np.uint64)
            c = np.zeros(size, np.uint64)
            c[at] = (reply >> np.uint64(1))[inverse]
            count.append(c)
            owned.append(at[first[(reply & np.uint64(1)).astype(bool)]])
        predicted = grams.place > 0
        # order 1: the mass that discounting leaves is that of the unknown word
        own = _discounted(count[0], tables[1]) / max(n_all, 1)
        unknown = stats["unknown"]
        prob = [np.where(count[0] > 0, own, unknown)]
        for m in range(2, order + 1):
            context = np.concatenate([[0], count[m - 2][:-1]]).astype(np.float64)
            prob.append(np.divide(_discounted(count[m - 1], tables[m]), context, out=np.zeros(size), where=context > 0))
        used = np.ones(size, np.int8)
        for m in range(2, order + 1):
            used[count[m - 1] > 0] = m
        chosen = prob[0].copy()
        for m in range(2, order + 1):
            chosen = np.where(used == m, prob[m - 1], chosen)
        score = np.where(predicted, np.log10(np.where(predicted, chosen, 1.0)), 0.0)
        base = np.where(predicted, np.log10((count[0] + 1.0) / (n_all + n_types + 1)), 0.0)
        sums = lambda v: np.bincount(grams.doc, weights=v, minlength=grams.n)
        known = sums((predicted & (count[0] > 0)).astype(np.float64))
        out = [("text", None, None, row["block"], None, list(range(grams.n)), sums(score), sums(base), known, grams.words + 1.0)]
        for m in range(2, order + 1):
            # masses of the contexts of owned n-grams
            mine = owned[m - 1]
            mine = mine[grams.place[mine] > 0]
            context = grams.hashes[m - 2][mine - 1]
            keys, inverse = np.unique(context, return_inverse=True)
            upper = np.bincount(inverse, weights=prob[m - 1][mine], minlength=len(keys))
            lower = np.bincount(inverse, weights=prob[m - 2][mine], minlength=len(keys))
            for b, x, y in _slices(keys, buckets):
                out.append(("mass", m, b, None, _pack_sorted(keys[x:y]), None, upper[x:y], lower[x:y], None, None))
            # tokens whose n-gram of this order is not known, though its context is
            wait = np.flatnonzero(predicted & grams.valid(m) & (count[m - 1] == 0))
            wait = wait[count[m - 2][wait - 1] > 0]
            if len(wait):
                context, text = grams.hashes[m - 2][wait - 1], grams.doc[wait]
                by = np.lexsort((text, context))
                context, text = context[by], text[by]
                new = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (text[1:] != text[:-1])]))
                times = np.diff(np.append(new, len(context))).astype(np.float64)
                context, text = context[new], text[new]
                for b, x, y in _slices(context, buckets):
                    out.append(("wait", m, b, row["block"], _pack_sorted(context[x:y]), text[x:y], times[x:y], None, None, None))
        return pa.Table.from_batches([_batch(_PARTIAL, out)])

    return run


_WEIGHED = T.StructType([T.StructField("kind", T.StringType()), T.StructField("order", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                         T.StructField("block", T.LongType()), T.StructField("hashes", T.BinaryType()),
                         T.StructField("text", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.DoubleType()))])


def _weigh_bucket(table):
    """Backoff weights of a bucket's contexts, and the scores of the tokens that wait for them."""
    import numpy as np
    import pyarrow as pa

    rows = table.to_pylist()
    rows.sort(key=lambda r: (r["kind"], r["block"] if r["block"] is not None else -1, r["hashes"]))
    mass = [r for r in rows if r["kind"] == "mass"]
    if not mass:
        return pa.Table.from_batches([_batch(_WEIGHED, [])])
    context = np.concatenate([_unpack_sorted(r["hashes"]) for r in mass])
    keys, inverse = np.unique(context, return_inverse=True)
    upper, lower = (np.bincount(inverse, weights=np.concatenate([r[c] for r in mass]), minlength=len(keys)) for c in "xy")
    weight = np.log10(np.maximum(1 - upper, 1e-300) / np.maximum(1 - lower, 1e-300))
    m, bucket = rows[0]["order"], rows[0]["bucket"]
    out = [("weight", m, bucket, None, _pack_sorted(keys), None, weight)]
    for r in (r for r in rows if r["kind"] == "wait"):
        at = np.searchsorted(keys, _unpack_sorted(r["hashes"]))
        text = np.array(r["text"], np.int64)
        names, inverse = np.unique(text, return_inverse=True)
        out.append(("text", None, None, r["block"], None, names.tolist(), np.bincount(inverse, weights=weight[at] * np.array(r["x"]))))
    return pa.Table.from_batches([_batch(_WEIGHED, out)])


@dataclass
class KatzScores:
    """Scores of the texts, and the tables the model is stored in (in the shared folder)."""

    scores: DataFrame   # the row column, train, n_tokens, n_known, train_tokens, base_score, score
    counts: DataFrame   # order, bucket, hashes (ascending, packed), counts (packed)
    weights: DataFrame  # order, bucket, hashes of contexts (packed), log10 backoff weights
    discounts: dict     # order -> r* for r = 1 .. TURING_MAX, then the slope


def katz_scores(docs: DataFrame, train: Column, row: Column, text_col: str = "text", order: int = ORDER,
                block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> KatzScores:
    """Learn a Katz model of ``order`` from the rows where ``train`` holds; score every row of ``docs``.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end token; contexts
    begin with one begin mark.  The unknown word has the mass that discounting the words leaves, so
    the probabilities after any context add up to one over the known words, the end and the unknown
    word.  NULL, empty and blank texts are one end token.  Repeated rows are scored, and count in
    training, as often as they appear; a NULL ``train`` is false; without training rows every
    probability is that of the unknown word, one.  An empty table gives no rows.  ``row`` is returned
    as it is; no other column is read.

    Words are told apart by 64-bit hashes.
    """
    texts = docs.select(row.alias("row"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    blocks = written(_blocks(texts, block_bytes))
    size = blocks.select(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)"))).first()[0] or 0
    buckets = int(size // bucket_bytes) + 1
    sent = blocks.select("block", "train", "sizes", "text").mapInArrow(_send_grams(order, buckets), _SENT)
    counted = written(sent.groupBy("order", "bucket").applyInArrow(_count_bucket, _COUNTED), "kind")
    width = FIT_MAX + 3
    sums = counted.where("kind = 'stats'").groupBy("order").agg(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(width))).collect()
    stats: dict = {r["order"]: (r["s0"], r["s1"]) for r in sums}
    tables = {m: good_turing([0] * (FIT_MAX + 1)) for m in range(1, order + 1)}
    tables |= {r["order"]: good_turing([r[f"s{i}"] for i in range(2, width)]) for r in sums}
    stats["unknown"] = _unknown_mass(counted.where("kind = 'model' and order = 1"), tables[1], stats.get(1, (0, 0))[0])
    answers = counted.where("kind = 'answer'").select("order", "bucket", "block", "counts")
    partial = written(
        blocks.select("block", "train", "sizes", "text").groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_score_block(order, buckets, stats, tables), _PARTIAL), "kind")
    weighed = written(partial.where("kind in ('mass', 'wait')").groupBy("order", "bucket").applyInArrow(_weigh_bucket, _WEIGHED), "kind")
    pieces = (
        partial.where("kind = 'text'").select("block", F.explode(F.arrays_zip("text", "x", "y", "z", "w")).alias("p"))
        .select("block", "p.text", F.col("p.x").alias("score"), F.col("p.y").alias("base"), F.col("p.z").alias("known"), F.col("p.w").cast("long").alias("n_tokens"))
    )
    late = weighed.where("kind = 'text'").select("block", F.explode(F.arrays_zip("text", "x")).alias("p")).select("block", "p.text", F.col("p.x").alias("late"))
    late = late.groupBy("block", "text").agg(F.sum("late").alias("late"))
    names = blocks.select("block", F.posexplode(F.arrays_zip("rows", "train")).alias("text", "p")).select("block", "text", F.col("p.rows").alias("row"), F.col("p.train").alias("train"))
    scores = (
        names.join(pieces, ["block", "text"]).join(late, ["block", "text"], "left")
        .select("row", "train", "n_tokens", F.col("known").cast("long").alias("n_known"), F.lit(stats.get(1, (0, 0))[0]).cast("long").alias("train_tokens"),
                F.col("base").alias("base_score"), (F.col("score") + F.coalesce("late", F.lit(0.0))).alias("score"))
    )
    counts = counted.where("kind = 'model'").select("order", "bucket", "hashes", "counts")
    weights = weighed.where("kind = 'weight'").select("order", "bucket", "hashes", F.col("x").alias("log10_weight"))
    return KatzScores(scores, counts, weights, tables)
