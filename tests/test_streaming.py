"""Incremental report runner: two arrivals of statement files, each reported once."""

import os

from pyspark.sql import functions as F

from dividax.plans.report import build_report
from dividax.sources.fx import synthetic_fx
from dividax.sources.statements import synthetic_statements
from dividax.streaming import start_report_stream

from conftest import SF_SMALL


def test_stream_reports_new_files_once(spark, tmp_dir):
    stmt = synthetic_statements(spark, SF_SMALL)
    fx = synthetic_fx(spark, SF_SMALL)
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("in", "out", "ckpt"))
    stmt.where("acct = 0").write.parquet(os.path.join(src, "part0"))
    q = start_report_stream(spark, src + "/*", stmt.schema, fx, out, ckpt)
    q.awaitTermination(300)
    first = spark.read.parquet(out).count()
    stmt.where("acct = 1").write.parquet(os.path.join(src, "part1"))
    q = start_report_stream(spark, src + "/*", stmt.schema, fx, out, ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    expected = build_report(stmt.where("acct in (0, 1)"), fx)
    assert first > 0 and got.count() == expected.count()
    assert got.groupBy("acct").agg(F.round(F.sum("tax_due_pln"), 2)).orderBy("acct").collect() == \
        expected.groupBy("acct").agg(F.round(F.sum("tax_due_pln"), 2)).orderBy("acct").collect()


def test_restart_without_a_checkpoint_goes_on(spark, tmp_dir):
    stmt = synthetic_statements(spark, SF_SMALL).where("acct = 0 and day(Time) = 2")
    fx = synthetic_fx(spark, SF_SMALL)
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    stmt.write.parquet(os.path.join(src, "part0"))
    for _ in range(2):
        start_report_stream(spark, src + "/*", stmt.schema, fx, out).awaitTermination(300)
    assert [d for d in os.listdir(out) if d.startswith("batch=")] == ["batch=0"]
    assert spark.read.parquet(out).count() == build_report(stmt, fx).count() > 0
