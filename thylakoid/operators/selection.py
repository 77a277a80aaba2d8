"""Choosing assemblies by tolerance, and files for samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.functions.sequence import within

#: Metrics of a circular assembly and what they are compared with.
LENGTH = ("Length", "Ref_length")
REGIONS = (("LSC", "r_LSC"), ("IRa", "r_IRa"), ("SSC", "r_SSC"), ("IRb", "r_IRb"))


def passes(rows: DataFrame, required: tuple[str, str] | None = LENGTH, regions=REGIONS, least: int = 3, tolerance: float = 0.1) -> DataFrame:
    """Rows whose required metric and at least ``least`` of the regions are within the tolerance."""
    near = sum((within(F.col(v), F.col(r), tolerance).cast("int") for v, r in regions), F.lit(0))
    keep = near >= least
    return rows.filter(keep & within(F.col(required[0]), F.col(required[1]), tolerance) if required else keep)


def first_per_group(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row of each group by ``order``, ties by the other columns: an aggregation, not a sort."""
    rest = [c for c in rows.columns if c not in group and c not in order]
    first = rows.groupBy(*group).agg(F.min(F.struct(*order, *rest)).alias("x"))
    return first.select(*[c if c in group else F.col(f"x.{c}").alias(c) for c in rows.columns])


def latest_per_group(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The last row of each group by ``order``."""
    rest = [c for c in rows.columns if c not in group and c not in order]
    last = rows.groupBy(*group).agg(F.max(F.struct(*order, *rest)).alias("x"))
    return last.select(*[c if c in group else F.col(f"x.{c}").alias(c) for c in rows.columns])


def split_by_success(samples: DataFrame, successes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Samples with a success, and those without."""
    return samples.join(successes, key, "left_semi"), samples.join(successes, key, "left_anti")


def match_files(inputs: DataFrame, files: DataFrame, folder: str, stem: str, name: str, suffix: str = ".fasta") -> DataFrame:
    """For each input the file called exactly ``<stem><suffix>`` in its folder, else the first by name
    that begins with the stem; null if there is none.

    Only equal keys meet: names, and names cut to the lengths that stems of the folder have, of which the
    first is kept before they meet the inputs.
    """
    f = files.select(F.col(folder), F.col(name).alias("_name"))
    lengths = inputs.select(folder, F.length(stem).alias("_n")).distinct()
    cut = f.join(lengths, folder).select(folder, F.substr("_name", F.lit(1), F.col("_n")).alias(stem), "_name")
    exact = F.col("_name") == F.concat(F.col(stem), F.lit(suffix))
    found = cut.groupBy(folder, stem).agg(F.coalesce(F.min(F.when(exact, F.col("_name"))), F.min("_name")).alias("file"))
    return inputs.join(found, [folder, stem], "left").select(*inputs.columns, "file")


def select_assemblies(metrics: DataFrame, files: DataFrame, folder: str = "folder", order: str = "row_ord") -> tuple[DataFrame, DataFrame]:
    """The first passing metrics row of each folder with its file, and the folders without one."""
    good = first_per_group(passes(metrics), [folder], [order])
    chosen = match_files(good, files, folder, "Input", "name").filter("file is not null")
    failed = metrics.select(folder).distinct().join(chosen, folder, "left_anti").withColumn("reason", F.lit("no row within tolerance"))
    return chosen, failed
