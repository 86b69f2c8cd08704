"""Helpers the operators share: the shared work folder, staged tables,
bounded slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Used only by a local session that names no checkpoint folder (tests).
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints/souk"
#: Text bytes handled at once inside a task.
SLICE_BYTES = 4 << 20


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.
    Unset on a cluster: an error, since a machine-local folder would be lost
    with its machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = LOCAL_CHECKPOINTS
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start
    from the files, also after executors are lost."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes (one row at
    least), so Python objects made from a slice stay bounded."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start, size = 0, 0
        for i, length in enumerate(lengths):
            if size and size + length > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length
        yield batch.slice(start, n - start)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
