"""Quality classifier by co-training of a text view and a metadata view."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_bytes, text_slices, written

#: Bound of the fit: labelled rows that are sampled by a hash of the id.  All unlabelled rows are the pool.
MAX_LABELLED = 12_000
ROUNDS = 3
#: Calibrated confidence from which a view's pseudo-label is handed to the other view.
CONFIDENT = 0.97
TEXT_BITS, META_BITS = 18, 12
_STYLE = 8
#: Bytes of the word beginnings that are features beside the whole words.
_STEMS = (4, 5)
#: Standard errors by which a feature's log odds ratio must stand out.
LEAST_Z = 3.5
#: Weight of a pseudo-labelled row.
PSEUDO = 0.5


# ---------------------------------------------------------------- features

def _distinct(values):
    """Ascending distinct integers by a sort, which takes a small part of the time of numpy's ``unique`` (a hash table)."""
    import numpy as np

    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _text_features(raw, offsets):
    """(document, feature) pairs of the distinct words and word beginnings, and a few style figures of each text."""
    import numpy as np

    from .hashing import LOOSE, mix

    n = len(offsets) - 1
    start, end, doc = LOOSE.spans(raw, offsets)
    shift, high = np.uint64(64 - TEXT_BITS), doc.astype(np.int64) << TEXT_BITS
    of = lambda last, salt: high | (mix(LOOSE.hashes(raw, start, last) + np.uint64(salt)) >> shift).astype(np.int64)
    whole = _distinct(of(end, 0))
    # word beginnings catch families of words of which each one is rare
    pairs = _distinct(np.concatenate([whole, *(of(np.minimum(end, start + k), k) for k in _STEMS)]))
    owner, feature = pairs >> TEXT_BITS, pairs & ((1 << TEXT_BITS) - 1)
    per = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    chars, count = np.maximum(np.diff(offsets), 1), np.bincount(doc, minlength=n)
    distinct = np.bincount(whole >> TEXT_BITS, minlength=n)
    ascii_sign = (raw > 32) & (raw < 127) & ~(((raw | 32) >= 97) & ((raw | 32) <= 122)) & ~((raw >= 48) & (raw <= 57))
    signs, upper = per(ascii_sign) / chars, per((raw >= 65) & (raw <= 90)) / chars
    odd = per(np.isin(raw, np.frombuffer(b"#*$%&|<>{}[]\\^~_=!", np.uint8))) / chars
    words = np.maximum(count, 1)
    variety = distinct / words
    style = np.stack([
        np.log1p(count), np.log(np.maximum(variety, 1e-4)), variety, np.minimum(signs, 0.3) * 10, np.minimum(odd, 0.2) * 10,
        np.log(odd + 1e-3), np.minimum(upper, 0.5) * 4, chars / words / 10,
    ], axis=1)
    return owner, feature, style


def _meta_features(sources, langs, sizes):
    """(document, feature) pairs of the metadata: source, language, size class and their pairs."""
    import numpy as np
    import zlib

    mask = (1 << META_BITS) - 1
    rows = []
    for i, (s, g, n) in enumerate(zip(sources, langs, sizes, strict=True)):
        size = -1 if n is None else int(max(n, 0)).bit_length()
        for name in (f"s:{s}", f"l:{g}", f"n:{size}", f"sl:{s}:{g}", f"ln:{g}:{size}"):
            rows.append((i, zlib.crc32(name.encode()) & mask))
    found = np.array(rows, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


# ---------------------------------------------------------------- fit (bounded sample, numpy)

def _sums(group, index, values, n: int):
    """Per group, the sum of ``values[index]``; a million entries at a time."""
    import numpy as np

    out = np.zeros(n)
    for i in range(0, len(group), 1 << 20):
        out += np.bincount(group[i : i + (1 << 20)], weights=values[index[i : i + (1 << 20)]], minlength=n)
    return out


class Linear:
    """Logistic regression on hashed presence features that differ between the classes, and style figures (Adam, L2)."""

    def __init__(self, bits: int, style: int = 0, decay: float = 2e-4, steps: int = 120):
        import numpy as np

        self.weights, self.style, self.bias = np.zeros(1 << bits), np.zeros(style), 0.0
        self.mean, self.scale = np.zeros(style), np.ones(style)
        self.decay, self.steps = decay, steps

    def margin(self, owner, feature, style, n: int):
        out = _sums(owner, feature, self.weights, n) + self.bias
        return out + ((style - self.mean) / self.scale) @ self.style if len(self.style) else out

    def fit(self, owner, feature, style, target, stats: "Statistics") -> "Linear":
        """Fit on labelled rows.  The features are those of ``stats`` (labelled and pseudo-labelled rows);
        their log odds ratios there, with the class means of the style figures, make one more column,
        so that pseudo-labelled rows teach words that no labelled row has."""
        import numpy as np

        n, used = len(target), stats.feature
        keep = np.flatnonzero(np.isin(feature, used))
        owner, column = owner[keep], np.searchsorted(used, feature[keep])
        dense = np.zeros((n, 0))
        if len(self.style):
            self.mean, self.scale = style.mean(axis=0), style.std(axis=0) + 1e-6
            dense = (style - self.mean) / self.scale
        if stats.pseudo:
            shared = np.bincount(owner, weights=stats.ratio[column], minlength=n)
            shared = shared + style @ stats.slope if len(self.style) else shared
            shift, unit = shared.mean(), shared.std() + 1e-6
            dense = np.column_stack([dense, (shared - shift) / unit])
        rate = float(target.mean())
        theta = np.zeros(len(used) + dense.shape[1] + 1)
        theta[-1] = np.log(max(rate, 1e-3) / max(1 - rate, 1e-3))
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, self.steps + 1):
            z = np.bincount(owner, weights=theta[column], minlength=n) + dense @ theta[len(used) : -1] + theta[-1]
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / n
            grad = np.concatenate([np.bincount(column, weights=g[owner], minlength=len(used)), dense.T @ g, [g.sum()]])
            grad[:-1] += self.decay * theta[:-1]
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        self.weights[:] = 0
        self.weights[used] = theta[: len(used)]
        self.style, self.bias = theta[len(used) : len(used) + len(self.style)].copy(), float(theta[-1])
        if stats.pseudo:
            by = theta[-2] / unit
            self.weights[used] += by * stats.ratio
            self.bias -= by * shift
            if len(self.style):
                self.style += by * stats.slope * self.scale
                self.bias += by * float(stats.slope @ self.mean)
        return self


def _platt(margins, target, penalty: float = 1e-3):
    """Coefficients (bias last) of a logistic fit of ``target`` on the columns of ``margins``, by Newton steps."""
    import numpy as np

    x = np.column_stack([margins, np.ones(len(target))])
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * len(target) * np.eye(len(beta)) / 10 + 1e-9 * np.eye(len(beta))
        step = np.linalg.solve(hessian, x.T @ (p - target) + penalty * len(target) * beta / 10)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class CoTrained:
    """Two calibrated views and their combination; small arrays of fixed size."""

    text: Linear
    meta: Linear
    calibration: list  # per view: (slope, intercept)
    combination: list  # weight of the text view, of the metadata view, intercept
    exchanged: list    # per round: pseudo-labels that each view received
    accuracy: float    # on the labelled rows held out for calibration

    def probabilities(self, text_margin, meta_margin):
        a, b = (c[0] * m + c[1] for c, m in zip(self.calibration, (text_margin, meta_margin), strict=True))
        w = self.combination
        return _sigmoid(a), _sigmoid(b), _sigmoid(w[0] * a + w[1] * b + w[2])


@dataclass
class Statistics:
    """What a view learns from all its labelled and pseudo-labelled rows: the features that stand out and their log odds ratios."""

    feature: object  # ascending
    ratio: object
    slope: object    # per style figure: difference of the class means by variance
    pseudo: int      # pseudo-labelled rows


def fit(rows: "Sample", rounds: int = ROUNDS, confident: float = CONFIDENT) -> CoTrained | None:
    """Co-train on the labelled rows (``style``, ``meta``, ``good`` and ``held``, the calibration part) and
    the pool, which stays in Spark: each round scores it with the rounds' models so far and sums up
    the features of what is sure.  None if the labels hold one class only."""
    import numpy as np

    if not rows:
        return None
    good, held = np.array([r["good"] for r in rows]), np.array([bool(r["held"]) for r in rows])
    learn, check = ~held, held
    if len(set(good[learn])) < 2 or len(set(good[check])) < 2:
        return None
    n = len(rows)
    spread = lambda parts: (np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in parts]), np.concatenate(parts))
    style, none = np.array([r["style"] for r in rows], float), np.zeros((n, 0))
    meta = spread([np.array(r["meta"], np.int32) for r in rows])
    place, target = np.cumsum(learn) - 1, good[learn].astype(float)
    rounds_models, exchanged, before = [], [], [0, 0]
    stats = rows.statistics([], confident)
    for turn in range(rounds + 1):
        models, calibration, margins = [], [], []
        for view, ((owner, feature), dense) in enumerate(((spread(rows.features(stats[0].feature)), style), (meta, none))):
            model = Linear(TEXT_BITS, _STYLE) if view == 0 else Linear(META_BITS)
            on = learn[owner]
            model.fit(place[owner[on]], feature[on], dense[learn], target, stats[view])
            margin = model.margin(owner, feature, dense, n)
            beta = _platt(margin[check], good[check].astype(float))
            models.append(model)
            calibration.append((float(beta[0]), float(beta[1])))
            margins.append(beta[0] * margin + beta[1])
        rounds_models.append((models, calibration))
        if turn == rounds:
            break
        stats = rows.statistics(rounds_models, confident)
        exchanged.append([s.pseudo - b for s, b in zip(stats, before, strict=True)])
        before = [s.pseudo for s in stats]
        if not any(exchanged[-1]):
            break
    both = np.column_stack(margins)
    beta = _platt(both[check], good[check].astype(float))
    accuracy = float((((both[check] @ beta[:2] + beta[2]) >= 0) == (good[check] == 1)).mean())
    return CoTrained(models[0], models[1], calibration, [float(b) for b in beta], exchanged, accuracy)


# ---------------------------------------------------------------- Spark

def _arranged(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, size_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(size_col).cast("long").alias("size"))


def _ints(batch, name: str):
    """(row, value) pairs of a column of packed 32-bit integers."""
    import numpy as np

    raw, offsets = text_bytes(batch, name)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) // 4), np.frombuffer(raw.tobytes(), np.int32)


class Sample(list):
    """The labelled rows (row, good, held, style, meta); ``table`` has them and the pool rows with their features, packed."""

    def __init__(self, table: DataFrame):
        import numpy as np

        self.table = table
        found = table.where("good is not null").select("row", "good", "held", "style", "meta").toArrow().to_pylist()
        super().__init__(sorted((r | {"style": np.frombuffer(r["style"]), "meta": np.frombuffer(r["meta"], np.int32)} for r in found), key=lambda r: r["row"]))

    def features(self, used) -> list:
        """Of each labelled row, the features that are in ``used``."""
        import numpy as np

        shared = self.table.sparkSession.sparkContext.broadcast(used)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            among = np.zeros(1 << TEXT_BITS, bool)
            among[shared.value] = True
            for batch in batches:
                for part in text_slices(batch, "feature"):
                    owner, feature = _ints(part, "feature")
                    on = among[feature]
                    few = np.split(feature[on], np.searchsorted(owner[on], np.arange(1, part.num_rows)))
                    yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([f.tobytes() for f in few], pa.binary())], names=["row", "feature"])

        found = self.table.where("good is not null").select("row", "feature").mapInArrow(run, "row long, feature binary").toArrow()
        by_row = dict(zip(found.column("row").to_pylist(), found.column("feature").to_pylist(), strict=True))
        shared.destroy()
        return [np.frombuffer(by_row[r["row"]], np.int32) for r in self]

    def statistics(self, rounds: list, confident: float) -> list[Statistics]:
        """Per view, over the learning rows and all pool rows that the other view was sure of in one of
        ``rounds`` (models, calibration), the first sure one deciding.

        The rows' features are summed up in Spark; the driver gets those that stand out."""
        import numpy as np

        shared = self.table.sparkSession.sparkContext.broadcast((rounds, confident))
        sizes, names = (1 << TEXT_BITS, 1 << META_BITS), ("yes", "no", "pseudo_yes", "pseudo_no")

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            turns, sure = shared.value
            # per view and class: features; after them the rows, the style figures and their squares
            sums = [np.zeros((4, size + 1 + 2 * _STYLE)) for size in sizes]
            for batch in batches:
                for part in text_slices(batch, "feature"):
                    n = part.num_rows
                    views = [_ints(part, "feature"), _ints(part, "meta")]
                    style = np.frombuffer(text_bytes(part, "style")[0].tobytes()).reshape(n, _STYLE)
                    good = np.array([-1 if g is None else g for g in part.column("good").to_pylist()])
                    given = [np.full(n, -1) for _ in views]
                    for models, calibration in turns:
                        for view in range(2):
                            dense = style if view == 1 else np.zeros((n, 0))  # those of the other view
                            p = _sigmoid(calibration[1 - view][0] * models[1 - view].margin(*views[1 - view], dense, n) + calibration[1 - view][1])
                            new = (good < 0) & (given[view] < 0) & ((p >= sure) | (p <= 1 - sure))
                            given[view] = np.where(new, p >= 0.5, given[view])
                    for view, (owner, feature) in enumerate(views):
                        kind = np.where(good >= 0, 1 - good, np.where(given[view] >= 0, 3 - given[view], -1))
                        for k in range(4):
                            of, size = kind == k, sizes[view]
                            sums[view][k, :size] += np.bincount(feature[of[owner]], minlength=size)
                            sums[view][k, size:] += np.concatenate([[of.sum()], style[of].sum(axis=0), (style[of] ** 2).sum(axis=0)])
            for view, found in enumerate(sums):
                at = np.flatnonzero(found.any(axis=0))
                for i in range(0, len(at), 1 << 16):
                    some = at[i : i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), view, np.int32)), pa.array(some.astype(np.int32)), *(pa.array(found[k, some]) for k in range(4))],
                                                     names=["view", "feature", *names])

        learn = self.table.where("good is null or not held").select("good", "feature", "style", "meta")
        counts = written(learn.mapInArrow(run, "view int, feature int, " + ", ".join(f"{c} double" for c in names))
                         .groupBy("view", "feature").agg(*(F.sum(c).alias(c) for c in names)))
        shared.destroy()
        yes, no = F.col("yes") + PSEUDO * F.col("pseudo_yes"), F.col("no") + PSEUDO * F.col("pseudo_no")
        out = []
        for view, size in enumerate(sizes):
            of = counts.where(F.col("view") == view)
            rest = np.zeros((4, 1 + 2 * _STYLE))
            for r in of.where(F.col("feature") >= size).collect():
                rest[:, r.feature - size] = [r[c] for c in names]
            both = rest[:2] + PSEUDO * rest[2:]
            odds = lambda x, rows: F.log((x + 0.5) / F.greatest(F.lit(float(rows) + 0.5) - x, F.lit(0.5)))
            ratio = odds(yes, both[0, 0]) - odds(no, both[1, 0])
            told = of.where(F.col("feature") < size).select("feature", ratio.alias("ratio")).where(
                F.abs(ratio) >= LEAST_Z * F.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))).toArrow()
            feature, ratios = (np.array(told.column(c).to_pylist()) for c in ("feature", "ratio"))
            order = np.argsort(feature)
            rows = np.maximum(both[:, :1], 1)
            mean, square = both[:, 1 : 1 + _STYLE] / rows, both[:, 1 + _STYLE :] / rows
            slope = (mean[0] - mean[1]) / ((square - mean**2).mean(axis=0) + 1e-6)
            out.append(Statistics(feature[order].astype(np.int32), ratios[order].astype(float), slope, int(rest[2:, 0].sum())))
        return out


def sample_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_pool: int | None = None, columns=("doc_id", "text", "source", "lang", "n_chars")) -> Sample:
    """Features of the labelled rows with the least id hashes and of all unlabelled rows (or of the ``max_pool`` with the least id hashes).

    An id labelled more than once is good only if all its labels are; NULL ids and labels are left
    out; of repeated document rows one is taken."""
    base = _arranged(docs, *columns).where("id is not null")
    marks = written(labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good")))
    ids = base.select("id").distinct().join(marks, F.col("id") == F.col("doc_id"), "left").select("id", "good", F.xxhash64("id").alias("h"))
    first = lambda which, most: ids.where(which).orderBy("h", "id").limit(most)
    # at most max_labelled ids, so they are broadcast
    chosen = written(first("good is not null", max_labelled).select("id", "good", (F.col("h") % 3 == 0).alias("held")))
    fields = ["text", "source", "lang", "size", "id"]
    if max_pool is None:
        others = marks.select(F.col("doc_id").alias("id"))
        pool = base.join(others, "id", "left_anti").select(*fields, F.lit(None).cast("int").alias("good"), F.lit(False).alias("held"))
    else:
        pool = base.join(first("good is null", max_pool).select("id"), "id").select(*fields, F.lit(None).cast("int").alias("good"), F.lit(False).alias("held"))
    rows = base.join(F.broadcast(chosen), "id").select(*fields, "good", "held").union(pool).select(
        "*", F.monotonically_increasing_id().alias("row"), F.xxhash64("text", "source", "lang", "size").alias("mark"))
    schema = "row long, id string, mark long, good int, held boolean, feature binary, style binary, meta binary"

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        packed = lambda arrays: pa.array([a.tobytes() for a in arrays], pa.binary())
        for batch in batches:
            for part in text_slices(batch, "text"):
                owner, feature, style = _text_features(*text_bytes(part, "text"))
                cuts = np.searchsorted(owner, np.arange(1, part.num_rows))
                who, meta = _meta_features(part.column("source").to_pylist(), part.column("lang").to_pylist(), part.column("size").to_pylist())
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("id").cast(pa.string()), part.column("mark"), part.column("good"), part.column("held"),
                    packed(np.split(feature.astype(np.int32), cuts)), packed(style), packed(meta.astype(np.int32).reshape(part.num_rows, -1)),
                ], names=["row", "id", "mark", "good", "held", "feature", "style", "meta"])

    sample = written(rows.mapInArrow(run, schema))
    again = written(sample.groupBy("id").agg(F.count("*").alias("n"), F.min(F.struct("mark", "row")).alias("least")).where("n > 1").select("id", F.col("least.row").alias("first")))
    if not again.isEmpty():
        sample = sample.join(again, "id", "left").where("first is null or first = row").drop("first")
    return Sample(sample)


def classify(docs: DataFrame, model: CoTrained | None, columns=("doc_id", "text", "source", "lang", "n_chars")) -> DataFrame:
    """``docs`` columns id, text_prob, meta_prob, prob, kept for every row (see ``quality_scores``)."""
    base = _arranged(docs, *columns)
    schema = T.StructType([base.schema["id"], *(T.StructField(c, T.DoubleType(), False) for c in ("text_prob", "meta_prob", "prob")), T.StructField("kept", T.BooleanType(), False)])
    if model is None:
        return base.select("id", *(F.lit(1.0).alias(c) for c in ("text_prob", "meta_prob", "prob")), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2 ** TEXT_BITS weights

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                n = part.num_rows
                owner, feature, style = _text_features(*text_bytes(part, "text"))
                who, meta = _meta_features(part.column("source").to_pylist(), part.column("lang").to_pylist(), part.column("size").to_pylist())
                views = m.probabilities(m.text.margin(owner, feature, style, n), m.meta.margin(who, meta, np.zeros((n, 0)), n))
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(v) for v in views), pa.array(views[2] >= 0.5)], names=schema.names)

    return base.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_pool: int | None = None, rounds: int = ROUNDS,
                   columns=("doc_id", "text", "source", "lang", "n_chars")) -> DataFrame:
    """(id, text_prob, meta_prob, prob, kept) of every row of ``docs``.

    A labelled row is good if its quality is 1 and it isn't toxic.  A text view (words and style)
    and a metadata view (source, language, size) learn from a bounded sample of labelled rows, hand
    each other the labels of the unlabelled rows they are sure of, and are calibrated on held-out labelled
    rows; their calibrated log odds are combined there too.  ``prob`` is the combined probability
    of a good document; ``kept`` says it is at least one half.

    NULL text, source, language or size are values like any other (an empty text, "None"); rows
    with NULL ids are scored but not learned from.  Without labels of both classes every row is kept
    with probability 1.  Repeated rows give their rows; an empty table gives none.
    """
    return classify(docs, fit(sample_rows(docs, labels, max_labelled, max_pool, columns), rounds), columns)


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` keeps, columns unchanged and in place (no join)."""
    model = fit(sample_rows(docs, labels, **how))
    names = docs.columns
    if model is None:
        return docs
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text", "source", "lang", "n_chars")
    marked = classify(inner, model, ("row", "text", "source", "lang", "n_chars"))
    return marked.where("kept").select("id.*")
