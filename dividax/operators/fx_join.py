"""Bounded as-of FX look-up (J-1 .. J-4) as an equi-join.

Probe semantics of the original: look at the target date, then step back one
weekday at a time, at most ``lookback_probes`` dates in total; PLN is always 1.0.

Re-expressed: every weekday rate dated ``r`` *serves* each target ``t`` with
``r <= t < next weekday rate`` whose business-day distance is < ``lookback_probes``
(at most ``lookback_probes + 4`` calendar days).  A rate dated on a weekend serves
only its own date and takes precedence there.  The serving table is bounded by
``(#currencies x #published days x 14)`` rows — a calendar-sized dimension that
does not grow with the statements — and is broadcast after an explicit row-count
check.  Beyond the bound the distinct look-ups are answered by one sorted pass over
rates and look-ups per currency (:func:`asof_answers`), and the answers are joined back.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K
from ..functions.dates import business_day_index, is_weekday
from ..params import TaxParams
from ..session import ensure_checkpoint_dir, materialize


#: Beyond the broadcast bound, a key with more than one in this many of the rows is answered by
#: broadcast (so there are fewer such keys than this), any other by the shuffle join.
HEAVY_SHARE = 10_000


def serving_table(fx: DataFrame, lookback_probes: int = K.FX_LOOKBACK_PROBES) -> DataFrame:
    """``fx(currency, rate_date, rate)`` -> ``(currency, target_date, rate, rate_date)``."""
    span = lookback_probes + 4
    wk = fx.where(is_weekday("rate_date"))
    nxt = F.lead("rate_date").over(Window.partitionBy("currency").orderBy("rate_date"))
    last_day = F.least(F.date_add("rate_date", span - 1), F.coalesce(F.date_sub(F.col("_next"), 1), F.date_add("rate_date", span - 1)))
    served = (
        wk.withColumn("_next", nxt)
        .select("currency", "rate_date", "rate", F.explode(F.sequence(F.col("rate_date"), last_day)).alias("target_date"))
        .where(business_day_index("target_date") - business_day_index("rate_date") < lookback_probes)
        .withColumn("_prio", F.lit(1))
    )
    weekend = fx.where(~is_weekday("rate_date")).select(
        "currency", "rate_date", "rate", F.col("rate_date").alias("target_date"), F.lit(0).alias("_prio")
    )
    both = served.unionByName(weekend)
    # at most two candidates per (currency, target): the weekend-dated one wins
    return both.groupBy("currency", "target_date").agg(
        F.min_by(F.struct("rate", "rate_date"), F.col("_prio")).alias("_w")
    ).select("currency", "target_date", "_w.rate", "_w.rate_date")


def asof_answers(keys: DataFrame, rates: DataFrame, lookback_probes: int = K.FX_LOOKBACK_PROBES) -> DataFrame:
    """``keys(currency, target_date, n)``, each pair once, with the ``rate`` that serves it (NULL: none).

    Rates and keys are put in one row per currency and day and sorted; the last weekday rate is
    carried along.  A currency has at most a row per calendar day, whatever the number of statements."""
    days = keys.select("currency", F.col("target_date").alias("day"), "n", F.lit(None).cast("double").alias("own")).unionByName(
        rates.select("currency", F.col("rate_date").alias("day"), F.lit(None).cast("long").alias("n"), F.col("rate").alias("own"))
    ).groupBy("currency", "day").agg(F.max("n").alias("n"), F.max("own").alias("own"))
    order = Window.partitionBy("currency").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    dated = F.when(F.col("own").isNotNull() & is_weekday("day"), F.struct("day", F.col("own").alias("rate")))
    near = business_day_index("day") - business_day_index("last.day") < lookback_probes
    return days.withColumn("last", F.last(dated, ignorenulls=True).over(order)).where("n is not null").select(
        "currency", F.col("day").alias("target_date"), "n", F.coalesce("own", F.when(near, F.col("last.rate"))).alias("rate"))


class FxIndex:
    """A stored serving table plus the decision how to join it.

    Built once per job (S-12 "read once") as a table in the shared folder, reused by every
    look-up and, by its ``path``, by other jobs (:meth:`open`).  Nothing stays cached in the executors."""

    def __init__(self, fx: DataFrame, params: TaxParams | None = None, path: str | None = None):
        params = params or TaxParams()
        path = path or f"{ensure_checkpoint_dir(fx.sparkSession).rstrip('/')}/fx-index-{uuid.uuid4().hex}"
        serving_table(fx, params.lookback_probes).write.mode("overwrite").parquet(path)
        self._use(fx.sparkSession, path, params)

    @classmethod
    def open(cls, spark: SparkSession, path: str, params: TaxParams | None = None) -> FxIndex:
        """The index that another job stored at ``path``."""
        index = cls.__new__(cls)
        index._use(spark, path, params or TaxParams())
        return index

    @classmethod
    def stored(cls, fx: DataFrame, path: str, params: TaxParams | None = None) -> FxIndex:
        """The index at ``path``; built first if there's none.  Name a path for each version of the rates."""
        try:
            return cls.open(fx.sparkSession, path, params)
        except AnalysisException:  # no such folder, or a build that was broken off before its first file
            return cls(fx, params, path)

    def _use(self, spark: SparkSession, path: str, params: TaxParams) -> None:
        self.params, self.path = params, path
        self.table = spark.read.parquet(path)
        # The explicit size check behind the broadcast decision: the serving table is
        # calendar-bounded, but check rather than assume.
        self.rows = self.table.count()
        self.broadcastable = self.rows <= params.broadcast_max_rows

    def lookup(self, df: DataFrame, currency: Column, date: Column, out: str) -> DataFrame:
        """Left-join the rate of ``currency`` on ``date`` into column ``out``.

        PLN -> 1.0 (J-2); a NULL currency or date (look-up not needed) -> NULL;
        a currency outside the archive or a date without a rate within the
        look-back -> NULL, reported by the quality checks (F-10 / J-3)."""
        k_cur, k_date, rate = f"_fx_{out}_k_cur", f"_fx_{out}_k_date", f"_fx_{out}_rate"
        keyed = df.withColumn(k_cur, currency).withColumn(k_date, date)
        names = [F.col("currency").alias(k_cur), F.col("target_date").alias(k_date), F.col("rate").alias(rate)]
        if self.broadcastable:
            joined = keyed.join(F.broadcast(self.table.select(*names)), [k_cur, k_date], "left")
        else:
            joined = self._beyond_broadcast(keyed, names, k_cur, k_date, rate)
        value = F.when(F.col(k_cur) == K.BASE_CURRENCY, F.lit(1.0)).otherwise(F.col(rate))
        return joined.withColumn(out, value).select(*[F.col(f"`{c}`") for c in df.columns if c != out], out)

    def _beyond_broadcast(self, keyed: DataFrame, names: list[Column], k_cur: str, k_date: str, rate: str) -> DataFrame:
        """Shuffle join whose hot keys never meet in one task, without copies of the rates.

        Rows are stored once and read twice: to count their distinct keys, and to be joined with the
        answers.  Keys that hold many rows are few and are broadcast; rows answered so, and rows that
        need no rate, are spread evenly through the join that answers the others."""
        keyed = materialize(keyed)
        needed = F.col(k_cur).isNotNull() & F.col(k_date).isNotNull() & (F.col(k_cur) != K.BASE_CURRENCY)
        keys = keyed.where(needed).groupBy(F.col(k_cur).alias("currency"), F.col(k_date).alias("target_date")).agg(F.count(F.lit(1)).alias("n"))
        rates = self.table.where("target_date = rate_date")  # every rate serves its own date
        answers = materialize(asof_answers(keys, rates, self.params.lookback_probes))
        rows = answers.agg(F.sum("n")).first()[0] or 0
        heavy = F.col("n") * HEAVY_SHARE > rows
        hot, spread, mark = f"{rate}_hot", f"{rate}_spread", f"{rate}_mark"
        first = keyed.join(F.broadcast(answers.where(heavy).select(*names, F.lit(True).alias(mark)).withColumnRenamed(rate, hot)), [k_cur, k_date], "left")
        open_ = needed & F.col(mark).isNull()
        first = first.withColumn(spread, F.when(open_, F.lit(0)).otherwise(F.xxhash64(F.monotonically_increasing_id()).bitwiseOR(1)))
        light = answers.where(~heavy).select(*names, F.lit(0).cast("long").alias(spread))
        # NULLs would meet in one task: the join sees a currency and a day that no rate has instead
        c, d = f"{rate}_c", f"{rate}_d"
        light = light.select(spread, rate, F.col(k_cur).alias(c), F.col(k_date).alias(d))
        first = first.withColumn(c, F.coalesce(k_cur, F.lit(""))).withColumn(d, F.coalesce(k_date, F.to_date(F.lit("0001-01-01"))))
        return first.join(light, [c, d, spread], "left").withColumn(rate, F.coalesce(rate, hot))


def fx_rate_lookup(targets: DataFrame, fx: DataFrame, currency: str = "currency", date: str = "target_date",
                   params: TaxParams | None = None) -> DataFrame:
    """J-1/J-2: rate for each ``(currency, date)`` row of ``targets`` (column ``rate``)."""
    return FxIndex(fx, params).lookup(targets, F.col(currency), F.col(date), "rate")
