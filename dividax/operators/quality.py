"""Data-quality checks (F-4, F-6 .. F-14).

Each check is a DataFrame of violations (or one row of counts per rule),
computed in one pass; ``raise_if_any`` turns a violation set into the original's
fail-fast ``ValueError`` on the driver, fetching only one sample row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampNTZType

from .. import constants as K
from .aggregates import counted_samples

SUPPORTED_FX = ("PLN",) + tuple(K.FX_ARCHIVE_COLUMNS)


def raise_if_any(violations: DataFrame, message: str) -> None:
    """Fail fast with one sample (``limit(1)``: no full scan once a row is found)."""
    sample = violations.limit(1).collect()
    if sample:
        raise ValueError(f"{message}: {sample[0].asDict()}")


def fx_violations(looked_up: DataFrame, currency: str = "currency", date: str = "target_date", rate: str = "rate") -> DataFrame:
    """F-10 / J-3: look-ups without a rate, with the reason."""
    return looked_up.where(F.col(rate).isNull()).select(
        currency, date,
        F.when(~F.col(currency).isin(*SUPPORTED_FX), F.lit("unsupported")).otherwise(F.lit("no_rate")).alias("reason"),
    )


def _lacks_d1() -> Column:
    return F.col("date").isNotNull() & F.col("net_dividend").isNotNull() & F.col("comment").isNotNull() & F.col("date_d1").isNull()


def missing_d1(rows: DataFrame) -> DataFrame:
    """F-4: rows with data to process but no previous-business-day date."""
    return rows.where(_lacks_d1())


def invalid_rates(merged: DataFrame) -> DataFrame:
    """F-9: report rows without a usable withholding rate."""
    return merged.where(F.col("wht_rate").isNull()).select("acct", "date", "ticker")


def no_per_share(rows: DataFrame) -> DataFrame:
    """Dividends whose comment has no positive per-share amount: they keep the account's
    amount but get the ticker's currency as label."""
    return rows.where(F.col("net_dividend").isNotNull() & ~F.coalesce(F.col("dps") > 0, F.lit(False))).select(
        "acct", "date", "ticker", "type", "comment", "net_dividend")


def negative_tax(report: DataFrame) -> DataFrame:
    """Report rows with a negative tax due (a foreign rate just below the flat one)."""
    return report.where(F.col("tax_due_pln") < 0).select("acct", "date", "ticker", "wht_rate", "tax_due_pln")


def wht_anomalies(merged: DataFrame) -> DataFrame:
    """F-6: report rows whose withholding rate is missing or zero."""
    return merged.where(F.col("wht_rate").isNull() | (F.col("wht_rate") == 0)).select(
        "acct", "date", "ticker", "wht_rate", "rate_source")


def us_30pct(merged: DataFrame) -> DataFrame:
    """F-7 + O-2: US rows taxed at 30 % (ticker *contains* ``US``), count and first 3 tickers."""
    flag = F.col("ticker").contains("US") & (F.abs(F.col("wht_rate") - 0.30) < 0.01)
    return counted_samples(merged, ["acct"], flag, [F.col("date"), F.col("ticker")], F.col("ticker"), out="examples")


def duplicate_ids(stmt: DataFrame, id_col: str = "id") -> DataFrame:
    """F-11: transaction IDs occurring more than once."""
    return stmt.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _long_counts(df: DataFrame, contract: str, rules: dict) -> DataFrame:
    agg = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules.items()])
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]))
    return agg.select(F.lit(contract).alias("contract"), stacked.alias("r")).select("contract", "r.rule", "r.violations")


#: F-12: structural contract of raw statement rows (column set, types, nullability).
STATEMENT_CONTRACT = StructType([
    StructField("id", StringType(), False),
    StructField("Type", StringType(), False),
    StructField("Time", TimestampNTZType(), True),
    StructField("Comment", StringType(), True),
    StructField("Symbol", StringType(), True),
    StructField("Amount", DecimalType(18, 6), True),
])


def schema_problems(df: DataFrame, contract: StructType = STATEMENT_CONTRACT, strict: bool = False) -> list[str]:
    """F-12 (structure only, no job): missing columns, type mismatches, nullable where
    the contract forbids NULL (nullability is only a declared property; the value
    check is :func:`input_contract`).  ``strict`` also reports extra columns."""
    fields = {f.name: f for f in df.schema.fields}
    problems = [f"missing column {c.name}" for c in contract.fields if c.name not in fields]
    for c in contract.fields:
        f = fields.get(c.name)
        if f is not None and f.dataType != c.dataType:
            problems.append(f"{c.name}: {f.dataType.simpleString()} != {c.dataType.simpleString()}")
    if strict:
        problems += [f"unexpected column {n}" for n in fields if n not in contract.fieldNames()]
    return problems


def input_contract(stmt: DataFrame) -> DataFrame:
    """F-12 + F-13: raw-statement contract, one row per rule with its violation count."""
    div = F.col("Type").isin(*K.DIVIDEND_TYPES)
    return _long_counts(stmt, "input", {
        "null_id": F.col("id").isNull(),
        "null_type": F.col("Type").isNull(),
        "bad_ticker": div & ~F.coalesce(F.col("Symbol"), F.lit("")).rlike(K.RE_TICKER),
        "null_comment": div & F.col("Comment").isNull(),
    })


def _output_rules() -> dict[str, Column]:
    return {
        "null_date": F.col("date").isNull(),
        "null_net": F.col("net_dividend").isNull(),
        "bad_ticker": ~F.coalesce(F.col("ticker"), F.lit("")).rlike(K.RE_TICKER),
        "null_shares": F.col("shares").isNull(),
        "negative_shares": F.col("shares") < 0,
    }


def output_contract(report: DataFrame) -> DataFrame:
    """F-14: report contract (ticker pattern, shares >= 0, no NULL in required columns)."""
    return _long_counts(report, "output", _output_rules())


class ReportChecks:
    """F-4, F-9, F-10 and F-14 as observed metrics: counted, each with its least sample, in the pass
    that computes the report anyway.  Pass it to ``build_report_parts``, run one action on the report or its
    quarantine, then read :meth:`violations` or call :meth:`raise_if_any`.  One object serves one report;
    reading before an action waits for it."""

    STRICT = {"missing_d1": "a row has no previous business day", "invalid_rate": "a row has no withholding rate",
              "missing_fx": "No exchange rate found within the look-back"}

    def __init__(self):
        self._rows, self._report = Observation(), Observation()

    @staticmethod
    def _metrics(rules: dict[str, Column]) -> list[Column]:
        where = F.concat_ws(" ", F.col("acct").cast("string"), F.col("date").cast("string"), "ticker")
        return [m for name, bad in rules.items() for m in (F.count_if(bad).alias(name), F.min(F.when(bad, where)).alias(f"{name}_first"))]

    def on_rows(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._rows, *self._metrics({"missing_d1": _lacks_d1()}))

    def on_report(self, scored: DataFrame) -> DataFrame:
        kept = {name: ~F.col("quarantined") & F.coalesce(bad, F.lit(False)) for name, bad in _output_rules().items()}
        return scored.observe(self._report, *self._metrics({"invalid_rate": F.col("wht_rate").isNull(), "missing_fx": F.col("quarantined"), **kept}))

    def violations(self) -> dict[str, tuple[int, str | None]]:
        """Check -> (violations, least sample), after an action."""
        seen = {**self._rows.get, **self._report.get}
        return {name: (n, seen[f"{name}_first"]) for name, n in seen.items() if not name.endswith("_first")}

    def raise_if_any(self, names: tuple[str, ...] = tuple(STRICT)) -> None:
        found = self.violations()
        for name in names:
            if found[name][0]:
                raise ValueError(f"{self.STRICT.get(name, name)}: {found[name][0]} rows, first {found[name][1]}")


def assert_complete(parts) -> None:
    """Strict mode (the original's behaviour): raise ``ValueError`` naming the first
    report row that could not be completed (F-4 missing D-1, F-9 missing rate,
    F-10 missing FX).  Each check fetches at most one row."""
    raise_if_any(missing_d1(parts.rows), "a row has no previous business day")
    raise_if_any(invalid_rates(parts.merged), "a row has no withholding rate")
    raise_if_any(parts.quarantine, "No exchange rate found within the look-back")
