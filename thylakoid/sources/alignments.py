"""Stored alignments: Parquet files sorted by contig and place, with an index of the bins that each file holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Places of a bin of the index.
BIN = 1 << 14


def write_alignments(rows: DataFrame, path: str, contig: str = "chrom", first: str = "pos", last: str = "end", files: int | None = None, bin_size: int = BIN) -> None:
    """Write alignments (or anything else that lies on contigs from ``first`` to ``last``) dealt by ranges and sorted, and their index.

    The index has a row for each contig, bin and file in which something touches the bin. Rows of a file are sorted, so the row groups of a
    file that a region doesn't touch are skipped by their own statistics.
    """
    dealt = rows.repartitionByRange(files, contig, first, last) if files else rows.repartitionByRange(contig, first, last)
    dealt.sortWithinPartitions(contig, first, last).write.parquet(f"{path}/rows")
    stored = rows.sparkSession.read.parquet(f"{path}/rows")
    bins = F.sequence(F.floor(F.col(first) / bin_size), F.floor(F.greatest(first, last) / bin_size))
    held = stored.select(F.col(contig).alias("contig"), F.explode(bins).alias("bin"), F.col("_metadata.file_path").alias("file"))
    held.distinct().repartitionByRange("contig", "bin").sortWithinPartitions("contig", "bin").withColumn("bin_size", F.lit(bin_size)).write.parquet(f"{path}/index")


def overlaps(first: Column, last: Column, start: Column, end: Column) -> Column:
    return (first <= end) & (last >= start)


def read_region(spark: SparkSession, path: str, contig_name, start: int, end: int, contig: str = "chrom", first: str = "pos", last: str = "end") -> DataFrame:
    """What touches the places from ``start`` to ``end`` of a contig; only files that the index names are read.

    The names of these files come to the driver; there are no more than files that touch the region.
    """
    index = spark.read.parquet(f"{path}/index").filter(F.col("contig") == contig_name)
    near = index.filter(F.col("bin").between(F.floor(F.lit(start) / F.col("bin_size")), F.floor(F.lit(end) / F.col("bin_size"))))
    files = sorted(r.file for r in near.select("file").distinct().toLocalIterator())
    stored = spark.read.parquet(f"{path}/rows")
    if not files:
        return stored.limit(0)
    here = spark.read.schema(stored.schema).parquet(*files)
    return here.filter((F.col(contig) == contig_name) & overlaps(F.col(first), F.col(last), F.lit(start), F.lit(end)))


def read_regions(spark: SparkSession, path: str, regions: DataFrame, contig: str = "chrom", first: str = "pos", last: str = "end", bin_size: int = BIN) -> DataFrame:
    """Stored rows with each of many ``regions`` (``chrom, start, stop`` and more columns) that they touch: both meet by contig and bin.

    A pair that shares several bins is found in the first of them. ``regions`` must not have columns of the stored rows but ``chrom``.
    """
    def binned(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
        spans = F.sequence(F.floor(F.col(a) / bin_size), F.floor(F.greatest(a, b) / bin_size))
        return rows.withColumns({"_bin": F.explode(spans), name: F.floor(F.col(a) / bin_size)})

    stored = binned(spark.read.parquet(f"{path}/rows"), first, last, "_from")
    asked = binned(regions.withColumnRenamed("chrom", contig), "start", "stop", "_asked")
    both = stored.join(asked, [contig, "_bin"]).filter(overlaps(F.col(first), F.col(last), F.col("start"), F.col("stop")))
    return both.filter(F.col("_bin") == F.greatest("_from", "_asked")).drop("_bin", "_from", "_asked")
