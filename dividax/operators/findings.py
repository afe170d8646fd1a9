"""Findings operators (A-13, A-14, T-11, O-4).

All work happens after ``explode(results)``, so per-report aggregation is an
ordinary shuffle aggregation, and the "top N rules" report uses the bounded
top-k pattern (partial window-group limit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import severity_level
from .aggregates import top_k_per_group


def flatten_findings(reports: DataFrame) -> DataFrame:
    """T-11 (+ S-17 payload): one SARIF-style finding per result, with the original's defaults.

    rule ``unknown``, path ``unknown`` with ``\\`` -> ``/``, line 1, message
    ``Security issue detected``, level from severity (default ``note``), and a
    ``path:line`` fingerprint."""
    return flatten_results(reports.select("report_id", F.posexplode("results").alias("pos", "r")))


def flatten_results(results: DataFrame) -> DataFrame:
    """T-11 over rows of one result each (``report_id, pos, r``), as ``read_large_findings`` gives them."""
    found = _finding(F.col("r"))
    return results.select("report_id", F.col("pos").alias("result_index"), *[c.alias(name) for name, c in found.items()])


def _finding(r: Column) -> dict[str, Column]:
    uri = F.translate(F.coalesce(r["filename"], F.lit(K.UNKNOWN)), "\\", "/")
    line = F.coalesce(r["line_number"], F.lit(1))
    return {
        "rule_id": F.coalesce(r["test_id"], F.lit(K.UNKNOWN)),
        "message": F.coalesce(r["issue_text"], F.lit(K.DEFAULT_MESSAGE)),
        "uri": uri,
        "start_line": line,
        "start_column": F.lit(1),
        "level": severity_level(F.coalesce(r["issue_severity"], F.lit("LOW"))),
        "fingerprint": F.concat(uri, F.lit(":"), line.cast("string")),
    }


def converted_findings(reports: DataFrame) -> DataFrame:
    """S-17: every readable report as one converted document (``version``, one run with its results).

    The results stay in their report's array, so nothing is shuffled."""

    def result(r: Column) -> Column:
        f = _finding(r)
        region = F.struct(f["start_line"].alias("startLine"), f["start_column"].alias("startColumn"))
        place = F.struct(F.struct(f["uri"].alias("uri")).alias("artifactLocation"), region.alias("region"))
        return F.struct(
            f["rule_id"].alias("ruleId"), F.lit(0).alias("ruleIndex"), F.struct(f["message"].alias("text")).alias("message"),
            F.array(F.struct(place.alias("physicalLocation"))).alias("locations"), f["level"].alias("level"),
            F.struct(f["fingerprint"].alias("primaryLocationLineHash")).alias("partialFingerprints"),
        )

    results = F.coalesce(F.transform("results", result), F.array())
    return reports.where(F.col("status") == "ok").select(
        "report_id", F.lit(K.CONVERTED_VERSION).alias("version"), F.array(F.struct(results.alias("results"))).alias("runs"))


def flatten_converted(documents: DataFrame) -> DataFrame:
    """The findings of converted documents, one row each."""
    r = documents.select("report_id", F.explode("runs").alias("run")).select("report_id", F.posexplode("run.results").alias("result_index", "r"))
    place = F.col("r.locations")[0]["physicalLocation"]
    return r.select(
        "report_id", "result_index", F.col("r.ruleId").alias("rule_id"), F.col("r.message.text").alias("message"),
        place["artifactLocation"]["uri"].alias("uri"), place["region"]["startLine"].alias("start_line"),
        place["region"]["startColumn"].alias("start_column"), F.col("r.level").alias("level"),
        F.col("r.partialFingerprints.primaryLocationLineHash").alias("fingerprint"),
    )


def finding_counts(reports: DataFrame) -> DataFrame:
    """A-13: per report: status, lines scanned, total issues, High/Medium/Low counts (missing -> 0;
    all NULL for an unreadable report, so that it never passes for a clean one)."""
    totals = F.col("metrics._totals")
    readable = F.col("status") == "ok"
    known = lambda c: F.when(readable, F.coalesce(c, F.lit(0)))
    cols = [
        "report_id",
        "status",
        known(totals["loc"]).alias("lines_scanned"),
        known(F.col("n_results") if "n_results" in reports.columns else F.size(F.col("results"))).alias("total_issues"),
    ]
    for name, key in K.SEVERITY_NAMES:
        cols.append(known(totals[f"SEVERITY.{key}"]).alias(name.lower()))
    return reports.select(*cols)


def top_rules(reports: DataFrame, top_n: int = 3) -> DataFrame:
    """A-14 / O-4: the ``top_n`` most frequent rule IDs per report (ties broken by ID)."""
    flat = reports.select("report_id", F.explode("results").alias("r")).select(
        "report_id", F.coalesce(F.col("r.test_id"), F.lit(K.UNKNOWN)).alias("rule_id"))
    counts = flat.groupBy("report_id", "rule_id").agg(F.count(F.lit(1)).alias("n"))
    top = top_k_per_group(counts, ["report_id"], [F.col("n").desc(), F.col("rule_id")], top_n)
    return top.select("report_id", F.col("_rank").alias("rank"), "rule_id", "n")
