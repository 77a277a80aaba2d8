"""Gap maps: how columns move when an alignment opens new ones in all of its rows.

A gap map is a sorted list of ``at`` (columns before the new ones) and ``size``. Columns that were opened once stay, so
maps of successive versions compose, and a row is written once and read at any later version.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAPS = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("size", T.IntegerType())]))
#: Parts in which the rows of one alignment meet its gaps, so that a large alignment is many tasks' work.
PARTS = 32
#: Columns of merged rows that a task makes before it passes them on.
MOST_LETTERS = 1 << 21


def _arrays(gaps) -> tuple[np.ndarray, np.ndarray]:
    gaps = [] if gaps is None else gaps
    return np.array([g["at"] for g in gaps], np.int64), np.array([g["size"] for g in gaps], np.int64)


def new_places(gaps, width: int) -> np.ndarray:
    """The new place (from 0) of each of ``width`` columns, and last the new width."""
    at, size = _arrays(gaps)
    opened = np.zeros(width + 1, np.int64)
    np.add.at(opened, at, size)
    return np.arange(width + 1) + np.cumsum(opened)


def _as_gaps(places: np.ndarray) -> list[dict]:
    size = np.diff(places, prepend=-1) - 1
    at = np.flatnonzero(size)
    return [{"at": a, "size": n} for a, n in zip(at.tolist(), size[at].tolist())]


def _composed(first: tuple, then: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Two maps (``at`` and ``size`` as arrays), one after the other, as one: the work grows with their gaps, not with the columns between."""
    if not len(first[0]) or not len(then[0]):
        return first if len(first[0]) else then
    past = np.concatenate([[0], np.cumsum(first[1])])  # columns opened by the first map before and with each of its gaps
    before = np.searchsorted(first[0] + past[:-1], then[0], "left")  # its gaps that begin before the place
    column = np.maximum(then[0] - past[before], np.where(before > 0, first[0][before - 1], 0))
    at, where = np.unique(np.concatenate([first[0], column]), return_inverse=True)
    size = np.zeros(len(at), np.int64)
    np.add.at(size, where, np.concatenate([first[1], then[1]]))
    return at, size


def compose(first, then, width: int) -> list[dict]:
    """The map of ``first`` (of ``width`` columns) followed by ``then`` (of the columns that it leaves)."""
    return [{"at": a, "size": n} for a, n in zip(*(x.tolist() for x in _composed(_arrays(first), _arrays(then))))]


@F.pandas_udf(GAPS)
def gaps_of(aligned: pd.Series) -> pd.Series:
    """The gap map that made an aligned text of its letters: its runs of ``-``."""
    out = []
    for text in aligned:
        if text is None:
            out.append(None)
            continue
        letter = np.frombuffer(text.encode("latin-1", "replace"), np.uint8) != ord("-")
        out.append(_as_gaps(np.r_[np.flatnonzero(letter), len(letter)]))
    return pd.Series(out)


@F.pandas_udf(T.StringType())
def open_columns(text: pd.Series, gaps: pd.Series) -> pd.Series:
    """Texts with ``-`` in the columns that a gap map opens."""
    out = []
    for t, g in zip(text, gaps):
        if t is None or g is None or not len(g):
            out.append(t)
            continue
        parts, last = [], 0
        for gap in g:
            parts += [t[last : gap["at"]], "-" * gap["size"]]
            last = gap["at"]
        out.append("".join([*parts, t[last:]]))
    return pd.Series(out)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _text(codes: np.ndarray) -> str:
    return codes.tobytes().decode("utf-32-le", "surrogatepass")


def lay(first: str, second: str, at: np.ndarray, size: np.ndarray) -> tuple[str, str]:
    """The second of two aligned texts and the letters of the first in the columns of a wider gap map: what the second has between two
    letters of the first comes first in the columns there, then its gaps."""
    a, b = _codes(first), _codes(second)
    letter = a != ord("-")
    own = np.flatnonzero(letter)
    opened = np.zeros(len(own) + 1, np.int64)
    opened[at] = size
    place = np.arange(len(opened)) + np.cumsum(opened)  # of each letter, and the end
    before = np.cumsum(letter)[~letter]  # letters before each column that the first lacks
    put = np.flatnonzero(~letter)
    within = put - np.r_[0, own + 1][before]
    merged, common = (np.full(place[-1], ord("-"), np.uint32) for _ in range(2))
    merged[place[:-1]], common[place[:-1]] = b[own], a[own]
    merged[(place - opened)[before] + within] = b[put]
    return _text(merged), _text(common)


def join_by_parts(rows: DataFrame, groups: DataFrame, keys: list[str], parts: int = PARTS) -> DataFrame:
    """Rows with the columns of their group; a group's row is repeated for each part, so no task need take all of a group's rows."""
    spread = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)).cast("int"))
    return dealt.join(spread, [*keys, "_part"]).drop("_part")


def merge_pairs(pairs: DataFrame, keys: list[str], first: str = "a", second: str = "b") -> DataFrame:
    """Pairwise alignments with one common sequence of each group of ``keys`` (``first``) as one alignment.

    Between two of the common sequence's letters there are as many columns as any pair opens; no letter of a row is lost, and
    rows are as wide as their group. Returns ``pairs`` with ``merged`` and, of the common sequence, ``common``.
    Groups' maps are maxima that tasks combine before a shuffle; a map has one entry a letter at most.
    A group's map comes once to each of its parts, before the part's rows, and isn't repeated for them.
    """
    pairs = pairs.dropna(subset=keys)
    names = pairs.columns
    runs = pairs.select(*keys, F.explode(gaps_of(first)).alias("_gap")).groupBy(*keys, F.col("_gap.at").alias("at")).agg(F.max("_gap.size").alias("size"))
    widest = runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "size"))).alias("_gaps"))
    groups = pairs.select(*keys).distinct().join(widest, keys, "left").withColumn("_gaps", F.coalesce("_gaps", F.array().cast(GAPS)))
    maps = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dealt = pairs.withColumn("_part", F.pmod(F.xxhash64(*pairs.columns), F.lit(PARTS)).cast("int"))
    both = dealt.unionByName(maps, allowMissingColumns=True).repartition(*keys, "_part").sortWithinPartitions(*keys, "_part", F.col("_gaps").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = size = None

        def made(batch: pa.RecordBatch, rows: list, texts: list) -> pa.RecordBatch:
            cut = batch.select(names).take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([*cut.columns, *(pa.array([x[i] for x in texts], pa.string()) for i in range(2))], names=[*names, "merged", "common"])

        for batch in batches:
            gaps, a, b = (batch.column(n) for n in ("_gaps", first, second))
            rows, texts, held = [], [], 0
            for r, opens in enumerate(gaps.is_valid().to_pylist()):
                if opens:
                    at, size = (gaps[r].values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    continue
                rows.append(r)
                texts.append(lay(a[r].as_py(), b[r].as_py(), at, size))
                held += len(texts[-1][0])
                if held > MOST_LETTERS:
                    yield made(batch, rows, texts)
                    rows, texts, held = [], [], 0
            yield made(batch, rows, texts)

    kinds = dict(pairs.dtypes)
    return both.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in pairs.columns), "merged string", "common string"]))


def later_gaps(maps: DataFrame, keys: list[str], version: str = "version", width: str = "width", gaps: str = "gaps") -> DataFrame:
    """For each version of a group the map from its columns to those of the last version (``later``).

    ``maps`` has a group's versions with the columns that each opened and its width after. All maps of a group open no more columns
    than its last version has, so a group of maps is as bounded as a row; rows of the alignment aren't gathered. Groups are dealt over all
    shuffle partitions: their maps are few bytes, by which all of them would be joined to one task's work.
    """

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, versions, counts, ats, sizes = [], [], [], [], []
            for r, group in enumerate(batch.column(len(keys)).to_pylist()):
                later = _arrays(None)
                for one in reversed(group):
                    row.append(r)
                    versions.append(one["version"])
                    counts.append(len(later[0]))
                    ats.append(later[0])
                    sizes.append(later[1])
                    if one["gaps"]:
                        later = _composed(_arrays(one["gaps"]), later)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate([[], *x]).astype(np.int32)) for x in (ats, sizes)], names=["at", "size"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat)
            kind = batch.schema.field(len(keys)).type.value_type.field("version").type
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(row, pa.int64())) for i in range(len(keys))), pa.array(versions, kind), lists], names=[*keys, version, "later"])

    kinds = dict(maps.dtypes)
    held = F.array_sort(F.collect_list(F.struct(F.col(version).alias("version"), F.col(width).alias("width"), F.col(gaps).alias("gaps"))))
    groups = maps.groupBy(*keys).agg(held.alias("_maps"))
    dealt = groups.repartition(int(maps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*keys))
    return dealt.mapInArrow(back, ", ".join([*(f"`{k}` {kinds[k]}" for k in [*keys, version]), f"later {GAPS.simpleString()}"]))


# --- base counts of columns -------------------------------------------------------------------

#: Types of numbers by the bytes that each takes.
_SIZES = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts (a row for each base, a column for each of the alignment's) as one byte that tells how many bytes a number takes,
    and the numbers, of as few bytes as the largest needs."""
    size = next((n for n in _SIZES if counts.max(initial=0) < 1 << (8 * n)), 4)
    return bytes([size]) + counts.astype(_SIZES[size]).tobytes()


def unpack_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, _SIZES[packed[0]], offset=1).reshape(4, -1).astype(np.int64)


def _bases(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    return (x == np.frombuffer(b"ACGT", np.uint8)[:, None]).astype(np.int64)


@F.pandas_udf(T.BinaryType())
def profile_of(text: pd.Series) -> pd.Series:
    """For each column 1 where the row has that base."""
    return pd.Series([pack_counts(_bases(t)) for t in text], dtype=object)


@F.pandas_udf(T.BinaryType())
def grown_profile(counts: pd.Series, gaps: pd.Series, text: pd.Series) -> pd.Series:
    """Counts of columns after a map opened new ones and a row was added."""
    out = []
    for packed, opened, row in zip(counts, gaps, text):
        held, sums = unpack_counts(packed), _bases(row)
        sums[:, new_places(opened, held.shape[1])[:-1]] += held
        out.append(pack_counts(sums))
    return pd.Series(out, dtype=object)


def _most_frequent(counts: np.ndarray) -> str:
    best = np.frombuffer(b"ACGT", np.uint8)[counts.argmax(axis=0)]
    return np.where(counts.max(axis=0, initial=0) > 0, best, ord("N")).astype(np.uint8).tobytes().decode()


@F.pandas_udf(T.StringType())
def packed_consensus(counts: pd.Series) -> pd.Series:
    """As ``profile_consensus``, of packed counts."""
    return pd.Series([_most_frequent(unpack_counts(x)) for x in counts], dtype=object)


@F.pandas_udf(T.StringType())
def profile_consensus(a: pd.Series, c: pd.Series, g: pd.Series, t: pd.Series) -> pd.Series:
    """The most frequent base of each column (A, C, G, T on ties), N where there is none."""
    return pd.Series([_most_frequent(np.stack([np.asarray(x, np.int64) for x in counts])) for counts in zip(a, c, g, t)], dtype=object)
