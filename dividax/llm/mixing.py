"""Mixing by iterative proportional fitting: token weights raked to marginals, then sampling.

DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words, written

DIMENSIONS = ("source", "lang", "topic")
MAX_ROUNDS, TOLERANCE = 50, 1e-6
#: Targets flatten the shares of tokens by this power.
POWER = 0.85
#: Share of all tokens that the sample is to have.
SHARE = 0.75
SEED = 20


def topic_of(text: Column) -> Column:
    """A topic by form, for tables without a topic column: symbols, shouting, or prose by length."""
    size = F.length(text)
    symbols = size - F.length(F.translate(text, "#*$%&|<>", ""))
    capitals = size - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return (
        F.when(symbols * 50 > size, "symbols").when(capitals * 4 > size, "capitals")
        .when(size < 500, "note").when(size < 5000, "article").otherwise("long read")
    )


def _scaled(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with a column divided by its sum, a single number that the driver fetches."""
    total = rows.agg(F.sum(column)).first()[0]
    return rows.withColumn(column, F.col(column) / F.lit(total or 1.0))


def flattened_targets(cells: DataFrame, power: float = POWER) -> dict[str, DataFrame]:
    """Per dimension (value, target): the shares of tokens raised to ``power``, adding up to one."""
    out = {}
    for d in DIMENSIONS:
        sums = cells.groupBy(d).agg(F.sum("tokens").alias("t")).where("t > 0").select(F.col(d).alias("value"), F.pow("t", F.lit(power)).alias("t"))
        out[d] = _scaled(sums, "t").select("value", F.col("t").alias("target"))
    return out


def raked(cells: DataFrame, targets: dict[str, DataFrame], max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions, tokens) plus ``weight``: shares that meet every marginal of ``targets``.

    Each round scales the weights to one dimension's targets after the other, until no marginal is off by
    more than ``tolerance``.  Values without a target get weight 0; targets of values without tokens are
    dropped and the rest scaled to one.  Where cells without tokens make the targets contradict each other,
    the last round's fit stays: exact for the last dimension, closest for the others.  Sums are pre-aggregated; each fit to a
    dimension is written, so that plans stay small."""
    now = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for d, wanted in targets.items():
        there = now.select(F.col(d).alias("value")).distinct()
        live = wanted.join(there, "value", "left_semi").groupBy("value").agg(F.sum("target").alias("target"))
        goal = _scaled(live, "target").select(F.col("value").alias(d), F.col("target").alias(f"target_{d}"))
        now = now.join(goal, d, "left").fillna(0.0, [f"target_{d}"])
    now = written(now)
    sides = [[F.col(d)] for d in targets]
    for _ in range(max_rounds):
        for d in targets:
            factor = now.groupBy(d).agg(F.sum("weight").alias("sum"), F.max(f"target_{d}").alias("target")).select(
                d, F.when(F.col("sum") > 0, F.col("target") / F.col("sum")).otherwise(0.0).alias("factor"))
            now = written(now.join(factor, d).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor"))
        goal = F.coalesce(*[F.when(F.grouping(d) == 0, F.max(f"target_{d}")) for d in targets])
        off = now.groupingSets(sides, *targets).agg(F.abs(F.sum("weight") - goal).alias("off"))
        if (off.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return now.drop(*[f"target_{d}" for d in targets])


def _uniform(id_col: str, text_col: str, seed: int) -> Column:
    """A number in [0, 1) fixed by id, text and seed, so a re-run draws the same sample."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(1 << 53)) / float(1 << 53)


def _keys(docs: DataFrame, id_col: str, text_col: str, topic: Column | None, seed: int) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return [named("source").alias("k_source"), named("lang").alias("k_lang"), F.coalesce(topic if topic is not None else topic_of(text), F.lit("")).alias("k_topic"),
            F.size(words(F.col(text_col))).cast("long").alias("k_tokens"), _uniform(id_col, text_col, seed).alias("k_u")]


def _scale(fitted: DataFrame, share: float) -> float:
    """The factor for which probabilities min(1, factor * ratio) draw ``share`` of all tokens in expectation.

    Cells are summed by their ratio to within 1 % first, so that the driver gets a bounded histogram."""
    bins = [(r.tokens, r.drawn / r.tokens) for r in fitted.where("ratio > 0").groupBy(F.round(F.log("ratio") * 100).cast("long").alias("bin"))
            .agg(F.sum("tokens").cast("double").alias("tokens"), F.sum(F.col("tokens") * F.col("ratio")).alias("drawn")).collect()]
    want = share * (fitted.agg(F.sum("tokens")).first()[0] or 0)
    low, high = 0.0, 1 / min((r for _, r in bins), default=1.0)
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(t * min(1.0, middle * r) for t, r in bins) < want else (low, middle)
    return high


def _probabilities(keyed: DataFrame, targets, power: float, share: float) -> DataFrame:
    """Per cell: weight on the tokens' share, and the probability that goes with it."""
    cells = written(keyed.groupBy(*(F.col(f"k_{d}").alias(d) for d in DIMENSIONS)).agg(F.sum("k_tokens").alias("tokens")))
    fitted = raked(cells, targets or flattened_targets(cells, power))
    total = fitted.agg(F.sum("tokens")).first()[0]
    fitted = fitted.withColumn("ratio", F.col("weight") / F.col("tokens") * F.lit(total).cast("double"))
    return fitted.select(*(F.col(d).alias(f"k_{d}") for d in DIMENSIONS), F.col("ratio").alias("weight"),
                         F.least(F.lit(1.0), F.lit(_scale(fitted, share)) * F.col("ratio")).alias("probability"))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = POWER, share: float = SHARE, topic: Column | None = None, seed: int = SEED,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, sampled) of every row of ``docs``.

    Tokens (words) are summed per cell of source, language and topic and raked to ``targets``: per dimension
    a table (value, target), by default the flattened shares.  ``weight`` is the factor on the cell's share:
    weighted tokens meet every marginal.  ``probability`` is the weight times one factor, at most 1, so that
    ``share`` of all tokens is drawn in expectation (cells that are too small for their weight are taken
    whole); ``sampled`` draws by a fixed hash of the row.  A NULL source or language is the value "";
    rows without tokens in cells without tokens have weight and probability 0; repeated rows are drawn
    alike; an empty table gives no rows.  ``topic`` (an expression on ``docs``) replaces ``topic_of``."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), *_keys(docs, id_col, text_col, topic, seed)))
    cells = _probabilities(rows, targets, power, share)
    return rows.join(cells, [f"k_{d}" for d in DIMENSIONS], "left").select(
        "doc_id", *(F.col(f"k_{d}").alias(d) for d in DIMENSIONS), F.col("k_tokens").alias("n_tokens"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("probability", F.lit(0.0)).alias("probability"),
        (F.col("k_u") < F.coalesce("probability", F.lit(0.0))).alias("sampled"))


def sample_mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = POWER, share: float = SHARE, topic: Column | None = None, seed: int = SEED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sampled rows of ``docs``, columns unchanged (see ``mixed``).  The cells, a table as long as the
    sources times the languages times the topics, meet the rows by an ordinary join."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_keys(docs, id_col, text_col, topic, seed))
    cells = _probabilities(row.drop("row"), targets, power, share)
    return row.join(cells, [f"k_{d}" for d in DIMENSIONS]).where("k_u < probability").select("row.*")
