"""Helpers shared by the corpus operators: scratch tables and native text expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: White space that separates words: space and 0x09-0x0D.
SPACES = " \t\n\x0b\f\r"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later jobs re-read the files after an executor is lost."""
    spark = df.sparkSession
    path = shared_folder(spark)
    out = df.write.option("compression", "zstd")
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable, not copied text)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; empty for NULL or blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(table, name: str):
    """(bytes, offsets) of a string column of an Arrow batch, NULL as empty; no per-row Python."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = table.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) else "", column.type))
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(batch, name: str, most: int = 4 << 20):
    """Consecutive slices of an Arrow batch with at most ``most`` bytes of text each (a row at least),
    so that a task's memory doesn't follow the batch."""
    import numpy as np

    _, offsets = text_bytes(batch, name)
    cut = 0
    while cut < batch.num_rows:
        stop = max(cut + 1, int(np.searchsorted(offsets, offsets[cut] + most, side="right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(cut, stop - cut)
        cut = stop
