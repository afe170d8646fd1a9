"""File-source stream of statements -> batch tax report per micro-batch.

Each micro-batch holds whole statement files; the report groups by
(account, date, ticker), so a statement must not be split over files.  Progress
and exactly-once file tracking live in the checkpoint, by default beside the output
(``<output>.checkpoint``), so a restart finds it again; a lost executor only re-runs its tasks, and a lost
driver restarts from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.fx_join import FxIndex
from ..params import TaxParams
from ..plans.report import build_report


def start_report_stream(
    spark: SparkSession,
    statements_path: str,
    statement_schema: StructType,
    fx: DataFrame,
    output_path: str,
    checkpoint: str | None = None,
    params: TaxParams | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    params = params or TaxParams()
    index = FxIndex(fx, params)  # the FX serving table is built once and reused by every batch
    stream = spark.readStream.schema(statement_schema).parquet(statements_path)

    def report_batch(batch: DataFrame, batch_id: int) -> None:
        # each micro-batch owns one folder: a batch re-run after a failure overwrites
        # its own output instead of appending a duplicate (idempotent sink)
        build_report(batch, index, params).write.mode("overwrite").parquet(f"{output_path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(report_batch).option(
        "checkpointLocation", checkpoint or f"{output_path.rstrip('/')}.checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
