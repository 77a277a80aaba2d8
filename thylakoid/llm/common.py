"""Helpers shared by the training-data operators: scratch tables, byte-bounded text batches."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Bytes of text that Python code in a task handles at a time.
CHUNK_BYTES = 4 << 20


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, deleted when the driver's JVM ends.

    A local temporary folder is used only where that setting is absent and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = tempfile.mkdtemp(prefix="spark-thylakoid-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/thylakoid-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a frame as Parquet to the shared scratch folder and read it back; this cuts its lineage."""
    spark = df.sparkSession
    path = f"{folder or scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder whose tables nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(total: float, per_partition: float, least: int = 1) -> int:
    """Partitions so that each takes ``per_partition`` of ``total``."""
    return max(least, math.ceil(total / per_partition))


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


def chunks(batch: pa.RecordBatch, text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding at most ``limit`` bytes of the text column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size) + 64
    if start < len(sizes):
        yield batch.slice(start)


def carried(df: DataFrame, carry: bool) -> list:
    """The whole row as a struct, if it is to come along: so none of its names can clash with others."""
    return [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []


def map_texts(df: DataFrame, fn: Callable, schema: dict[str, str], text: int = 1, limit: int = CHUNK_BYTES, after: Callable | None = None) -> DataFrame:
    """``mapInArrow`` over byte-bounded chunks; ``fn`` takes a record batch and returns columns by name,
    of which those in ``schema`` (names and types) stay. ``after`` is called at a partition's end: idle
    workers of a long application should hold no caches."""
    names = [*schema]

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch, text, limit):
                out = fn(chunk)
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)
        if after:
            after()

    return df.mapInArrow(run, ", ".join(f"`{n}` {kind}" for n, kind in schema.items()))


def _array(values):
    return values if isinstance(values, pa.Array) else pa.array(values)


def bytes_of(df: DataFrame, col: str) -> int:
    """Total UTF-8 bytes of a column, over all rows."""
    return int(df.agg(F.sum(F.octet_length(col).cast("long"))).first()[0] or 0)
