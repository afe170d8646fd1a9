"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, written

# The base patterns, in their order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # longest runs, so the same as AKIA[A-Z0-9]+ of 20 or more
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

#: Long tokens that are tested for randomness, and the bits of information they need at least.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
MIN_BITS = 100
#: Level of the battery, and rate of words among the tokens reported, within tokens of like encoding and length.
ALPHA, FDR = 0.01, 0.05
# Letters that words of Latin script use most (nine in ten letters and more in English,
# French, German and Spanish; half of them in random text), and the share of them that a word has at least.
FREQUENT = "etaoinshrdlcu"
RARE = "bfgjkmpqvwxyz"
WORD_SHARE = 0.85
#: Encodings from the smallest alphabet to the largest; one-case ones are read in upper case.
ENCODINGS = (
    ("hex", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^([A-Z2-7]+|[a-z2-7]+)$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^([A-Z0-9]+|[a-z0-9]+)$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "^", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
_LEAST_P = 1e-12


def _pieces(text: Column, pattern: str, kind: int, ok) -> Column:
    """Per match: kind, place, characters between it and the match before, its length, ok(match).

    The characters between come from splitting at the pattern, done only where it matches."""
    shape = lambda g: lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), F.length(F.get(g, i)).alias("gap"), F.length(x).alias("len"), ok(x).alias("test"))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda g: F.transform(m, shape(g)))))


def _test(encoding: Column | str | None, p: Column | float | None) -> Column:
    as_col = lambda v, t: (v if isinstance(v, Column) else F.lit(v)).cast(t)
    return F.struct(as_col(encoding, "string").alias("encoding"), as_col(p, "double").alias("p"))


def _normal_p(z: Column) -> Column:
    """Two-sided normal tail probability (rational approximation of the error function, to 1.5e-7)."""
    x = F.abs(z) / math.sqrt(2)
    return let(F.struct(x.alias("x"), (1 / (1 + 0.3275911 * x)).alias("t")), lambda v: F.exp(-v["x"] * v["x"]) * v["t"] * (
        0.254829592 + v["t"] * (-0.284496736 + v["t"] * (1.421413741 + v["t"] * (-1.453152027 + v["t"] * 1.061405429)))))


def _count(token: Column, characters: str) -> Column:
    return (F.length(token) - F.length(F.translate(token, characters, ""))).cast("double")


def _parts(name: str, letters: str) -> list[str]:
    """Parts of an alphabet whose shares words and random text don't have in common."""
    if name == "hex":
        return ["01234", "56789", "ABCDEF"]
    parts = ["".join(c for c in letters if c in part) for part in (FREQUENT.upper(), RARE.upper(), FREQUENT, RARE)]
    return [part for part in (*parts, "".join(c for c in letters if not c.isalpha())) if part]


def _battery(token: Column, values: Column, size: Column, parts: Column) -> Column:
    """Combined p-value (Fisher) of three tests that a token is uniform over an alphabet and independent.

    Chi-squared over the parts of the alphabet; Wald-Wolfowitz runs above and below its middle;
    serial correlation at lag one against the known mean and variance."""
    n = F.size(values).cast("double")

    def chi() -> Column:
        def excess(part):
            return let(n * F.length(part) / size, lambda e: F.pow(F.length(token) - F.length(F.call_function("translate", token, part, F.lit(""))) - e, F.lit(2.0)) / e)

        # upper tail of chi-squared with two (three parts) or four (five parts) degrees of freedom
        return let(F.aggregate(F.transform(parts, excess), F.lit(0.0), lambda a, x: a + x) / 2, lambda x: F.exp(-x) * F.when(F.size(parts) == 5, 1 + x).otherwise(1.0))

    def runs() -> Column:
        high = lambda v: v * 2 >= size
        turns = F.size(F.filter(F.transform(values, lambda v, i: (i > 0) & (high(v) != high(F.get(values, i - 1)))), lambda t: t))
        ups = F.size(F.filter(values, high)).cast("double")
        return let(F.struct(turns.alias("r"), (2 * ups * (n - ups)).alias("k")), lambda s: F.when(
            s["k"] <= n, F.lit(_LEAST_P)).otherwise(_normal_p((s["r"] - s["k"] / n) / F.sqrt(s["k"] * (s["k"] - n) / (n * n * (n - 1))))))

    def serial() -> Column:
        mean = (size - 1) / 2
        products = F.transform(values, lambda v, i: F.when(i > 0, (v - mean) * (F.get(values, i - 1) - mean)).otherwise(0.0))
        return _normal_p(F.aggregate(products, F.lit(0.0), lambda a, x: a + x) / ((size * size - 1) / 12) / F.sqrt(n - 1))

    half = F.lit(0.0)
    for p in (chi(), runs(), serial()):
        half = half - F.log(F.greatest(p, F.lit(_LEAST_P)))
    return let(half, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _word_p(token: Column) -> Column:
    """Bound (Chernoff) on the probability that words have as few frequent letters as the token has."""
    frequent, rare = _count(token, FREQUENT + FREQUENT.upper()), _count(token, RARE + RARE.upper())

    def bound(c: Column) -> Column:
        n = c["f"] + c["r"]
        part = lambda x, share: F.when(x > 0, x * F.log(x / (n * share))).otherwise(0.0)
        return F.when(c["f"] >= n * WORD_SHARE, F.lit(1.0)).otherwise(F.exp(-part(c["f"], WORD_SHARE) - part(c["r"], 1 - WORD_SHARE)))

    return let(F.struct(frequent.alias("f"), rare.alias("r")), bound)


def _randomness(token: Column) -> Column:
    """Encoding of the smallest alphabet that holds a token (NULL: too few bits), and the p-value of its
    being words: 1 where the battery finds that it isn't random.  Upper-case hex has no words; there the
    battery's own p-value tells, ``1 - ALPHA`` of random tokens pass."""
    found = F
    for name, pattern, letters in ENCODINGS:
        read = F.upper(token) if name in ("base32", "base36") else F.translate(token, "-_", "+/") if name == "base64" else token
        found = found.when(token.rlike(pattern), F.struct(
            F.lit(name).alias("name"), read.alias("read"), F.lit(letters).alias("letters"), F.lit(float(len(letters))).alias("size"),
            F.array(*map(F.lit, _parts(name, letters))).alias("parts")))

    def test(e: Column) -> Column:
        values = F.transform(F.sequence(F.lit(1), F.length(e["read"])), lambda i: (F.position(F.substring(e["read"], i, F.lit(1)), e["letters"]) - 1).cast("double"))
        battery = let(values, lambda v: _battery(e["read"], v, e["size"], e["parts"]))
        words = F.when(e["name"] == "hex", _LEAST_P).otherwise(_word_p(token))
        return F.when(F.length(token) * F.log2(e["size"]) < MIN_BITS, _test(None, None)).otherwise(
            _test(e["name"], F.when(battery >= ALPHA, words).otherwise(1.0)))

    return let(found, test)


def secret_spans(docs: DataFrame, text_col: str = "text", carry: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): ``rows`` has row and ``carry`` for every row of ``docs``; ``spans`` has row, kind, start
    and end (code points, end exclusive) of every secret, kind an index into ``KINDS``.

    Base kinds are found by their patterns, leftmost and non-overlapping in each kind.  Tokens of 20 or
    more characters get the randomness battery under the encoding of the smallest alphabet that holds them
    (hex, base32, base36, base62, base64; either case) if they carry enough bits there.  A token that the
    battery doesn't reject gets the probability that words look like it; any other gets 1.  Among tokens
    of one encoding and one doubling of length Benjamini-Hochberg at rate ``FDR`` picks those that are no
    words: spans of kind "random", unless they touch a base span.  NULL and empty texts have no spans.
    The scratch table holds lengths and p-values, never the matched text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    passed = lambda good: F.when(good, _test("", 1.0)).otherwise(_test(None, None))
    source = docs.select(F.monotonically_increasing_id().alias("row"), (carry if carry is not None else F.lit(0)).alias("carry"), text.alias("text"))
    found = written(source.select("row", "carry", F.array(
        _pieces(F.col("text"), ASSIGN, 0, lambda x: passed(F.length(F.regexp_extract(x, ASSIGN, 1)) >= ASSIGN_LEAST)),
        _pieces(F.col("text"), ACCESS, 1, lambda x: passed(F.lit(True))),
        _pieces(F.col("text"), HEX, 2, lambda x: passed(F.lit(True))),
        _pieces(F.col("text"), TOKEN, 3, _randomness),
    ).alias("pieces")).select("row", "carry", F.flatten(F.filter("pieces", lambda p: p.isNotNull())).alias("pieces")))
    in_kind = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        found.select("row", F.explode("pieces").alias("p")).select("row", "p.kind", "p.place", "p.gap", "p.len", "p.test.encoding", "p.test.p")
        .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(in_kind)).where("encoding is not null")
        .select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "encoding", "p", F.floor(F.log2("len")).alias("size"))
    )
    # base spans that a token touches: those that begin before it ends and end after it begins
    base_end, base_start = F.when(F.col("kind") < 3, F.col("end")), F.when(F.col("kind") < 3, F.col("start"))
    ordered = Window.partitionBy("row").orderBy("start")
    placed = written(
        placed.withColumn("before", F.max(base_end).over(ordered))
        .withColumn("after", F.min(base_start).over(ordered.rangeBetween(0, Window.unboundedFollowing)))
        .where((F.col("kind") < 3) | ((F.coalesce("before", F.lit(-1)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))))
    )
    tokens = placed.where("kind = 3").withColumn("level", F.floor(-10 * F.log10(F.greatest("p", F.lit(_LEAST_P)))))
    # Benjamini-Hochberg on a grid of p-values: at most 121 levels in each stratum
    steps = tokens.groupBy("encoding", "size", "level").count()
    stratum = Window.partitionBy("encoding", "size")
    cut = (
        steps.withColumn("at_most", F.sum("count").over(stratum.orderBy(F.desc("level")))).withColumn("tests", F.sum("count").over(stratum))
        .where(F.col("tests") * F.pow(F.lit(10.0), -F.col("level") / 10) <= FDR * F.col("at_most")).groupBy("encoding", "size").agg(F.min("level").alias("cut"))
    )
    # a row for each encoding and doubling of length: some 150 at most
    random = tokens.join(F.broadcast(cut), ["encoding", "size"]).where("level >= cut").select("row", "kind", "start", "end")
    return found.select("row", "carry"), placed.where("kind < 3").select("row", "kind", "start", "end").union(random)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row of ``docs``.

    ``spans`` lists kind:start:end by start, then kind, comma-joined; ``base_sha256`` is the hash of that
    list of the base kinds.  See ``secret_spans``.  Repeated rows and NULL ids give their rows; an empty
    table gives none; other columns are ignored."""
    rows, spans = secret_spans(docs, text_col, F.col(id_col))
    lists = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    all_spans = rows.join(lists, "row", "left").select(F.col("carry").alias("doc_id"), F.coalesce("s", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("s"))
    count = lambda k: F.size(F.filter("s", lambda x: x["kind"] == k)).cast("long")
    return all_spans.select(
        "doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(_joined(F.filter("s", lambda x: x["kind"] < 3)), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """(doc_id, text): texts with every span (overlapping ones merged) replaced by ``mask``.

    Unlike ``scan_secrets`` it carries the texts through a scratch table in the shared folder."""
    rows, spans = secret_spans(docs, text_col, F.struct(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")))
    lists = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("s"))
    step = lambda a, x: F.when(x["end"] <= a["at"], a).otherwise(F.struct(
        F.concat(a["out"], F.when(x["start"] < a["at"], F.lit("")).otherwise(F.concat(F.substring(F.col("t"), (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mask)))).alias("out"), x["end"].alias("at")))
    text = F.aggregate("s", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), step,
                       lambda a: F.concat(a["out"], F.substring(F.col("t"), (a["at"] + 1).cast("int"), F.length("t"))))
    return rows.join(lists, "row", "left").select(F.col("carry.i").alias("doc_id"), F.col("carry.t").alias("t"), "s").select("doc_id", F.when(F.col("s").isNull(), F.col("t")).otherwise(text).alias("text"))
