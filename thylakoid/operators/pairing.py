"""Mate files and mate reads."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thylakoid.functions.sequence import sample_base


def pair_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Complete pairs of mate files: ``sample, r1_path, r2_path``.

    One aggregation by sample; where a mate occurs in several folders, the first path by name counts.
    """
    mate = F.regexp_extract(F.col(path), r"_([12])\.fastq\.gz$", 1)
    rows = files.select(sample_base(F.col(path)).alias("sample"), mate.alias("mate"), F.col(path).alias("p")).filter("sample is not null")
    pairs = rows.groupBy("sample").agg(F.min(F.when(F.col("mate") == "1", F.col("p"))).alias("r1_path"), F.min(F.when(F.col("mate") == "2", F.col("p"))).alias("r2_path"))
    return pairs.dropna(subset=["r1_path", "r2_path"])


def first_of_each_pair(pairs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Repeated pairs once, the first by ``order``. As an aggregation, so repeats combine before the shuffle."""
    rest = [c for c in pairs.columns if c not in keys and c != order]
    picked = F.min(F.struct(F.col(order), *rest)).alias("first")
    return pairs.groupBy(*keys).agg(picked).select(*keys, F.col(f"first.{order}").alias(order), *[F.col(f"first.{c}").alias(c) for c in rest])


def pair_reads(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Mate reads side by side, by their place in the files; reads without a mate go."""
    def named(df, n):
        return df.select(*keys, *[F.col(c).alias(f"{c}{n}") for c in df.columns if c not in keys])

    return named(left, 1).join(named(right, 2), keys)


def collapse_reads(pairs: DataFrame, keys: list[str], order: str, dedup: bool = True) -> DataFrame:
    """Pairs of equal sequences as one, with the copies' number; or all of them."""
    if not dedup:
        return pairs.withColumn("copies", F.lit(1).cast("long"))
    return pairs.groupBy(*keys).agg(F.min(order).alias(order), F.count("*").alias("copies"))


def trim_ends(reads: DataFrame, seq: str, qual: str, least: int = 3, offset: int = 33) -> DataFrame:
    """Reads without the low-quality bases at their ends; qualities are characters from ``offset``."""
    low = "".join(f"\\x{c:02x}" for c in range(offset, offset + least))
    lead = F.length(F.regexp_extract(qual, f"^[{low}]*", 0))
    size = F.greatest(F.length(F.regexp_replace(qual, f"[{low}]*$", "")) - lead, F.lit(0))
    return reads.withColumns({seq: F.substr(seq, lead + 1, size), qual: F.substr(qual, lead + 1, size)})


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def adapter_start(read: str, adapters: list[np.ndarray], least: int, most: int) -> int:
    """The first place where an adapter, or what of it fits before the read's end, lies with few enough
    mismatches: ``most`` in 16 bases and in longer stretches, less in proportion in shorter ones. The
    read's length if there is none."""
    text, size = _codes(read), len(read)
    first = size
    for adapter in adapters:
        places = np.arange(max(0, min(first, size - min(least, len(adapter)) + 1)))
        if not len(places) or not len(adapter):
            continue
        padded = np.r_[text, np.zeros(len(adapter), np.uint32)]
        wrong = np.zeros(len(places), np.int32)
        for i, base in enumerate(adapter):
            wrong += (padded[i : i + len(places)] != base) & (places + i < size)
        fits = np.flatnonzero(wrong <= np.minimum(most, np.minimum(len(adapter), size - places) * most // 16))
        first = int(fits[0]) if len(fits) else first
    return first


def clip_adapter(reads: DataFrame, seq: str, qual: str, adapter: str | list[str], least: int = 8, most: int = 2) -> DataFrame:
    """Reads cut at the first place where an adapter, or a prefix of one of ``least`` bases at the read's
    end, begins. ``most`` bases may differ in 16 or more, in proportion fewer in shorter stretches (none
    under 8 bases at the default); every other letter, N too, is a difference."""
    wanted = [_codes(a) for a in ([adapter] if isinstance(adapter, str) else adapter)]

    @F.pandas_udf(T.IntegerType())
    def place(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else adapter_start(t, wanted, least, most) for t in texts], dtype="Int32")

    keep = place(F.col(seq))
    return reads.withColumns({seq: F.substr(F.col(seq), F.lit(1), keep), qual: F.substr(F.col(qual), F.lit(1), keep)})


#: Score of a base that is equal in both mates; one that differs loses a tenth of the lower of both qualities.
EQUAL = 0.602


def read_through(seq1: str, qual1: str, seq2: str, qual2: str, adapters: tuple[str, str], least_score: float = 30) -> int | None:
    """The size of the piece that two mates have read through, from its mates' overlap; None if they haven't.

    Mates of a piece of ``n`` bases, shorter than a read, are each other's reverse complement in their first ``n`` bases, and their adapters follow. Of all sizes the
    best by score counts if it reaches ``least_score`` and what follows is more like the adapters than not.
    """
    x, y = (_codes(t) for t in (seq1, seq2))
    if not len(x) or not len(y):
        return None
    p, q = (np.frombuffer(t.encode("latin-1", "replace"), np.uint8)[: len(c)].astype(np.float64) - 33 for t, c in ((qual1, x), (qual2, y)))
    if len(p) < len(x) or len(q) < len(y):
        return None
    other = _PAIRED[y]
    score = np.where((x[:, None] == other) & (other > 0), EQUAL, -np.minimum(p[:, None], q) / 10)
    size = np.arange(len(x))[:, None] + np.arange(len(y)) + 1  # a base and its partner lie this far apart, ends included
    sums = np.bincount(size.ravel(), weights=score.ravel())[: min(len(x), len(y)) + 1]
    n = len(sums) - 1 - int(sums[::-1].argmax())
    if sums[n] < least_score or n >= max(len(x), len(y)):
        return None
    behind = 0.0
    for codes, quality, adapter in ((x, p, adapters[0]), (y, q, adapters[1])):
        tail, wanted = codes[n:], _codes(adapter)
        m = min(len(tail), len(wanted))
        behind += float(np.where(tail[:m] == wanted[:m], EQUAL, -quality[n : n + m] / 10).sum())
    return n if behind > 0 else None


#: What each letter pairs with; 0 pairs with nothing.
_PAIRED = np.zeros(256, np.uint8)
_PAIRED[[ord(c) for c in "ACGT"]] = [ord(c) for c in "TGCA"]


def clip_palindromes(pairs: DataFrame, adapters: tuple[str, str], seq: tuple[str, str] = ("seq1", "seq2"), qual: tuple[str, str] = ("qual1", "qual2"), least_score: float = 30) -> DataFrame:
    """Pairs whose mates read through their piece into the adapters, cut at the piece's end, however little of an adapter is left (``read_through``).

    Pairs with a mate that is null or empty, or with fewer qualities than bases, stay as they are.
    """

    @F.pandas_udf(T.IntegerType())
    def size(a: pd.Series, p: pd.Series, b: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([read_through(*x, adapters, least_score) if all(t is not None for t in x) else None for x in zip(a, p, b, q)], dtype="Int32")

    cut = pairs.withColumn("_size", size(seq[0], qual[0], seq[1], qual[1]))
    return cut.withColumns({c: F.when(F.col("_size").isNull(), F.col(c)).otherwise(F.substr(F.col(c), F.lit(1), F.col("_size"))) for c in (*seq, *qual)}).drop("_size")


def route_pairs(pairs: DataFrame, seq1: str, seq2: str) -> DataFrame:
    """Where a trimmed pair goes: ``paired``, ``unpaired_1``, ``unpaired_2`` or ``dropped``."""
    one, two = F.length(F.coalesce(seq1, F.lit(""))) > 0, F.length(F.coalesce(seq2, F.lit(""))) > 0
    return pairs.withColumn("route", F.when(one & two, "paired").when(one, "unpaired_1").when(two, "unpaired_2").otherwise("dropped"))


def numbered(df: DataFrame, partition: list[str], order: list[str], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
