"""An extension: mate files that arrive over time, as a stream of complete pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.functions.sequence import sample_base


def arriving_pairs(spark: SparkSession, folder: str, wait: str = "1 day") -> DataFrame:
    """Pairs as soon as both mates lie in the folder. A mate whose partner doesn't come within ``wait`` is
    forgotten, so state stays bounded. Only listings are streamed, not contents."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.fastq.gz").load(folder)
    rows = files.select(sample_base(F.col("path")).alias("sample"), F.regexp_extract("path", r"_([12])\.fastq\.gz$", 1).alias("mate"), "path", F.col("modificationTime").alias("at")).filter("sample is not null").withWatermark("at", wait)
    one = rows.filter("mate = '1'").select("sample", F.col("path").alias("r1_path"), F.col("at").alias("at1"))
    two = rows.filter("mate = '2'").select(F.col("sample").alias("sample2"), F.col("path").alias("r2_path"), F.col("at").alias("at2"))
    near = F.expr(f"sample = sample2 AND at2 BETWEEN at1 - INTERVAL {wait} AND at1 + INTERVAL {wait}")
    return one.join(two, near).select("sample", "r1_path", "r2_path")
