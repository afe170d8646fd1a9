"""Language identification by error-correcting output codes.

Each language has a codeword.  For each bit a binary n-gram classifier tells the languages with a
one from those with a zero; loss-weighted decoding picks the codeword nearest to the bits' margins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_bytes, text_slices, written

#: Lengths of the byte n-grams, and the buckets that they are hashed into.
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
#: Added to every count.
SMOOTHING = 0.5
#: One of so many learning texts (by hash, so copies stay together) calibrates and weighs the bits; the others are counted.
CALIBRATION = 5
#: More labels than these aren't languages; fitting stops with an error.
MAX_LANGUAGES = 10_000
#: Languages up to which the code has every split of them as a bit; beyond, random bits, so many for each doubling.
EXHAUSTIVE = 5
BITS_PER_DOUBLING = 10
#: The bits' spread counts as at least this part of the gap between their classes, so that texts of mixed languages stay unsure.
LEAST_SPREAD = 3
#: Scores under this are ambiguous, and so are bits outside of the code's correcting radius.
AMBIGUOUS_SCORE = 0.8
#: Predicted for texts without a letter.
UNDETERMINED = "und"
_SLICE_BYTES = 1 << 20


def codebook(n: int):
    """0/1 matrix (language, bit) whose rows differ widely; the same for the same ``n``."""
    import numpy as np

    if n <= EXHAUSTIVE:  # every split into two non-empty sides; the first language is always on the side of the ones
        return np.array([[1 if i == 0 else split >> (i - 1) & 1 for split in range(2 ** (n - 1) - 1)] for i in range(n)], np.int8).reshape(n, -1)
    rng = np.random.default_rng(n)
    bits = int(np.ceil(BITS_PER_DOUBLING * np.log2(n)))
    best, best_key = None, (-1, -1)
    for _ in range(200 if n <= 200 else 5):
        code = rng.integers(0, 2, (n, bits), dtype=np.int8)
        code[0, code.sum(0) == 0] = 1
        code[0, code.sum(0) == n] = 0
        key = (_least_distance(code), int(-abs(code.sum(0) - n / 2).sum()))
        if key > best_key or best is None:
            best, best_key = code, key
    return best


def _least_distance(code) -> int:
    """Smallest Hamming distance of two rows."""
    import numpy as np

    if len(code) < 2:
        return 0
    signs = code.astype(np.float32) * 2 - 1
    least = code.shape[1]
    for i in range(0, len(code), 512):  # blocks of the (language, language) table
        agree = signs[i : i + 512] @ signs.T
        agree[np.arange(len(agree)), np.arange(i, i + len(agree))] = -code.shape[1]
        least = min(least, int((code.shape[1] - agree.max()) / 2))
    return least


def letters_and_spaces(batch, name: str):
    """(bytes, offsets) of a batch's texts in lower case, every run of other ASCII characters as one space.

    Each text has a space before and after it; non-ASCII characters count as letters."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.utf8_lower(pc.fill_null(batch.column(name).cast(pa.large_string()), ""))
    raw, offsets = text_bytes(pa.RecordBatch.from_arrays([column], names=[name]), name)
    sizes = np.diff(offsets)
    # one space before each text and one after the last
    at = np.arange(len(raw)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    out = np.full(len(raw) + len(sizes) + 1, 32, np.uint8)
    out[at] = _letters()[raw]
    starts = offsets[:-1] + np.arange(len(sizes))
    space = out == 32
    again = np.zeros(len(out), bool)
    again[1:] = space[1:] & space[:-1]
    again[starts] = False
    kept = np.concatenate([[0], np.cumsum(~again)])
    return out[~again], np.append(kept[starts], kept[-1] - 1 if len(sizes) else 0)


def _letters():
    import numpy as np

    table = np.full(256, 32, np.uint8)
    keep = [*range(97, 123), *range(128, 256)]
    table[keep] = keep
    table[65:91] = np.arange(97, 123)
    return table


def ngram_buckets(raw, offsets, buckets: int = BUCKETS) -> Iterator[tuple]:
    """(bucket, text) of every n-gram of all ``ORDERS``, an order at a time.

    An n-gram begins in its text and may end with the space after it."""
    import numpy as np

    if not len(raw):
        return
    key = np.zeros(len(raw), np.uint32)
    wide = raw.astype(np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:][text] if len(offsets) > 1 else offsets[:0]
    place = np.arange(len(text))
    for n in range(1, max(ORDERS) + 1):
        # the last character of an n-gram is n - 1 places on
        key = (key[: len(key) - (n > 1)] << np.uint32(8)) | wide[n - 1 :]
        if n in ORDERS:
            inside = place + (n - 1) <= end
            inside = inside[: len(key)]
            spread = (key[: len(inside)][inside] + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            spread ^= spread >> np.uint32(15)
            spread *= np.uint32(0x85EBCA77)
            yield (spread >> np.uint32(16)).astype(np.int64) % buckets, text[: len(inside)][inside]


def _count_batches(batches: Iterator, schema) -> Iterator:
    """(lang, feature, n) of each batch of (text, lang)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        found: dict = {}
        for part in text_slices(batch, "text", _SLICE_BYTES):
            langs = part.column("lang").dictionary_encode()
            of, names = langs.indices.to_numpy().astype(np.int64), langs.dictionary.to_pylist()
            for bucket, text in ngram_buckets(*letters_and_spaces(part, "text")):
                both = of[text] * BUCKETS + bucket
                if len(names) <= 32:
                    dense = np.bincount(both, minlength=len(names) * BUCKETS)
                    for i, name in enumerate(names):
                        counts = dense[i * BUCKETS : (i + 1) * BUCKETS]
                        found[name] = found[name] + counts if name in found else counts
                else:
                    keys, counts = np.unique(both, return_counts=True)
                    yield _count_rows([names[i] for i in (keys // BUCKETS).tolist()], keys % BUCKETS, counts, schema)
        for name, counts in found.items():
            at = np.flatnonzero(counts)
            yield _count_rows([name] * len(at), at, counts[at], schema)


def _count_rows(names: list[str], features, counts, schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(features, pa.int32()), pa.array(counts, pa.int64())], names=schema.names)


@dataclass
class LanguageModel:
    """Languages in order, their codewords, and the bits' classifiers, calibration and loss weights."""

    languages: list[str]
    code: object  #: (language, bit) of 0/1
    weights: object  #: (bit, bucket): log odds of an n-gram
    slope: object  #: per bit: logit of a one = slope * margin + offset
    offset: object
    loss_weights: object  #: (language, bit), each row adding up to one

    def margins(self, part, name: str = "text"):
        """(text, bit): mean log odds of the text's n-grams."""
        import numpy as np

        out = np.zeros((part.num_rows, len(self.weights)))
        number = np.zeros(part.num_rows)
        for bucket, text in ngram_buckets(*letters_and_spaces(part, name)):
            number += np.bincount(text, minlength=part.num_rows)
            for j, weights in enumerate(self.weights):
                out[:, j] += np.bincount(text, weights=weights[bucket], minlength=part.num_rows)
        return out / np.maximum(number, 1)[:, None]

    def decode(self, margins):
        """(best language, runner-up, score, ambiguous) of each row of margins.

        A language's loss is the mean of its bits' logistic losses by its loss weights.  Scores are the
        soft-max of the losses, scaled so that two languages at the code's least distance differ by the
        mean logit of the bits that tell them apart."""
        import numpy as np

        n, bits = self.code.shape
        if bits == 0:  # one language
            rows = len(margins)
            return np.zeros(rows, np.int64), np.full(rows, -1), np.ones(rows), np.zeros(rows, bool)
        logit = margins * self.slope + self.offset
        one, zero = np.logaddexp(0, -logit), np.logaddexp(0, logit)
        loss = one @ (self.loss_weights * self.code).T + zero @ (self.loss_weights * (1 - self.code)).T
        order = np.argsort(loss, axis=1, kind="stable")
        best, second = order[:, 0], order[:, 1]
        distance = max(_least_distance(self.code), 1)
        spread = np.exp(-(loss - loss.min(1, keepdims=True)) * bits / distance)
        score = 1 / spread.sum(1)
        errors = ((logit > 0) != (self.code[best] > 0)).sum(1)
        return best, second, score, (score < AMBIGUOUS_SCORE) | (errors > (distance - 1) // 2)


def fit_languages(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Codes, classifiers and loss weights from the rows where ``learn`` holds and text and language aren't NULL.

    N-gram counts are sums over all counted texts.  The driver gets one row per bucket, language
    and bit; None if no row has a language."""
    import numpy as np

    source = docs.where(learn).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    calibrates = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("feature", T.IntegerType()), T.StructField("n", T.LongType())])
    counts = source.where(~calibrates).mapInArrow(lambda batches: _count_batches(batches, schema), schema)
    counts = written(counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if not totals:  # too few texts to set some aside
        calibrates = F.lit(True)
        counts = written(source.mapInArrow(lambda batches: _count_batches(batches, schema), schema).groupBy("lang", "feature").agg(F.sum("n").alias("n")))
        totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if not totals:
        return None
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} different labels")
    languages = [r.lang for r in totals]
    code = codebook(len(languages))
    size = np.array([r.n + SMOOTHING * BUCKETS for r in totals])
    weights = _bit_weights(counts, languages, code, size)
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]), np.zeros(code.shape[1]), np.ones(code.shape) / max(code.shape[1], 1))
    if code.shape[1]:
        _calibrate(model, source.where(calibrates))
    return model


def _bit_weights(counts: DataFrame, languages: list[str], code, size):
    """Log odds of every bucket for every bit; each language counts alike on its side."""
    import numpy as np

    spark, bits = counts.sparkSession, code.shape[1]
    table = spark.createDataFrame([(lang, float(1 / size[i]), code[i].astype(float).tolist()) for i, lang in enumerate(languages)], "lang string, share double, codeword array<double>")
    p = counts.join(F.broadcast(table), "lang").withColumn("p", F.col("n") * F.col("share"))
    sums = [F.sum(F.col("p") * F.col("codeword")[j]).alias(f"bit{j}") for j in range(bits)]
    found = p.groupBy("feature").agg(F.sum("p").alias("both"), *sums).toArrow()
    features = found.column("feature").to_numpy()
    both = np.zeros(BUCKETS)
    both[features] = found.column("both").to_numpy()
    added = SMOOTHING / size
    out = np.empty((bits, BUCKETS))
    for j in range(bits):
        ones = np.zeros(BUCKETS)
        ones[features] = found.column(f"bit{j}").to_numpy()
        n_ones = code[:, j].sum()
        up = (ones + added @ code[:, j]) / n_ones
        down = (np.maximum(both - ones, 0) + added @ (1 - code[:, j])) / (len(languages) - n_ones)
        out[j] = np.log(up) - np.log(down)
    return out


def _calibrate(model: LanguageModel, rows: DataFrame) -> None:
    """Sets the bits' slopes and offsets (two normal classes of one variance) and the loss weights (how
    often a bit is right on a language)."""
    import numpy as np

    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("margins", T.ArrayType(T.DoubleType()))])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in text_slices(batch, "text", _SLICE_BYTES):
                found = shared.value.margins(part)
                offsets = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("lang").cast(pa.string()), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], names=schema.names)

    margins = written(rows.mapInArrow(run, schema)).select("lang", F.posexplode("margins").alias("bit", "m"))
    number, total, squares, right = (np.zeros(model.code.shape) for _ in range(4))
    at = {lang: i for i, lang in enumerate(model.languages)}
    for r in margins.groupBy("lang", "bit").agg(F.count("*"), F.sum("m"), F.sum(F.col("m") * F.col("m"))).collect():
        if r[0] in at:
            number[at[r[0]], r[1]], total[at[r[0]], r[1]], squares[at[r[0]], r[1]] = r[2:]
    for j in range(model.code.shape[1]):
        sides = [(number[s, j].sum(), total[s, j].sum(), squares[s, j].sum()) for s in (model.code[:, j] == 1, model.code[:, j] == 0)]
        if all(n > 1 for n, _, _ in sides):
            (up, down), within = [t / n for n, t, _ in sides], sum(q - t * t / n for n, t, q in sides)
            if up > down:
                variance = max(within / (sides[0][0] + sides[1][0]), ((up - down) / LEAST_SPREAD) ** 2)
                model.slope[j] = (up - down) / variance
                model.offset[j] = -model.slope[j] * (up + down) / 2
    slope, offset = (F.array(*map(F.lit, x.tolist())) for x in (model.slope, model.offset))
    says_one = F.col("m") * slope[F.col("bit")] + offset[F.col("bit")] > 0
    for r in margins.groupBy("lang", "bit").agg(F.count_if(says_one)).collect():
        if r[0] in at:
            i = at[r[0]]
            right[i, r[1]] = r[2] if model.code[i, r[1]] else number[i, r[1]] - r[2]
    rate = (right + 1) / (number + 2)
    model.loss_weights = rate / rate.sum(1, keepdims=True)


def predict_languages(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, runner_up, ambiguous) of every row of ``docs``, from its whole text alone.

    Texts that are NULL or have no letter are ``und`` with score 0, as is every row without a
    model; ``ambiguous`` marks them too.  Equal losses go to the first language in order.  Repeated rows
    and NULL ids give their rows, an empty table none; other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("runner_up", T.StringType()), T.StructField("ambiguous", T.BooleanType())])
    if model is None:
        return source.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("runner_up"), F.lit(True).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = shared.value
        names = np.array([*model.languages, UNDETERMINED, None], object)
        none = len(model.languages)
        for batch in batches:
            for part in text_slices(batch, "text", _SLICE_BYTES):
                best, second, score, ambiguous = model.decode(model.margins(part))
                blank = ~part.column("has_letter").to_numpy(zero_copy_only=False)
                best = np.where(blank, none, best)
                second = np.where(blank | (second < 0), none + 1, second)
                columns = [part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(np.where(blank, 0.0, score)), pa.array(names[second], pa.string()), pa.array(ambiguous | blank)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)
