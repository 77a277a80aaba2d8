"""Columns of multiple alignments: consensus, identity, positions, mismatch windows and blocks.

Rows of an alignment stay whole strings: Arrow functions compare them column by column, and only what
differs between columns' groups (counts, windows, blocks) becomes rows that Spark groups and joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thylakoid.functions.sequence import BASES, majority_base
from thylakoid.operators.gapmap import join_by_parts, profile_consensus
from thylakoid.session import cut_lineage

#: Counts that a task holds before it passes them on.
MOST_COUNTS = 1 << 21
#: Columns whose counts are one row.
TILE = 1024
#: Letters (bytes) whose places a task makes at a time.
MOST_LETTERS = 1 << 20
_GAPS = [ord(c) for c in "-."]
_N = ord("N")


def _struct(kind: T.DataType, *names: str) -> T.StructType:
    return T.StructType([T.StructField(n, kind) for n in names])


def letters(text: str | None) -> np.ndarray:
    """A text's characters as numbers, a-z as A-Z."""
    x = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((x >= 97) & (x <= 122), x - 32, x)


def _is_base(x: np.ndarray) -> np.ndarray:
    return (x == 65) | (x == 67) | (x == 71) | (x == 84)


def column_counts(rows: DataFrame, keys: list[str], seq: str = "seq_aln") -> DataFrame:
    """Counts of bases by column, as arrays (``a, c, g, t``) of tiles of ``TILE`` columns (``tile``, from 0).

    Tasks add up their rows before a shuffle, so what is shuffled is one row a tile, group and task.
    """
    names = [*keys, "tile", *"acgt"]

    def emitted(held: dict, kinds: list) -> Iterator[pa.RecordBatch]:
        for key, counts in held.items():
            tiles = [counts[i : i + TILE] for i in range(0, len(counts), TILE)]
            fixed = [pa.array([v] * len(tiles), kind) for v, kind in zip(key, kinds)]
            sums = [pa.array([np.ascontiguousarray(t[:, i]) for t in tiles], pa.list_(pa.int64())) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(range(len(tiles)), pa.int32()), *sums], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        kinds: list = []
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(len(keys))]
            for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
                x, counts = letters(text), held.get(tuple(key), np.zeros((0, 4), np.int64))
                if len(x) > len(counts):
                    counts = np.concatenate([counts, np.zeros((len(x) - len(counts), 4), np.int64)])
                    held[tuple(key)] = counts
                for i, base in enumerate(BASES):
                    counts[: len(x), i] += x == ord(base)
            if sum(map(len, held.values())) > MOST_COUNTS:
                yield from emitted(held, kinds)
                held = {}
        yield from emitted(held, kinds)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that come sorted by group and tile, added up."""
        at, sums, kinds = None, None, []

        def one() -> pa.RecordBatch:
            fixed = [pa.array([v], kind) for v, kind in zip(at, kinds)]
            return pa.RecordBatch.from_arrays([*fixed, *(pa.array([x], pa.list_(pa.int64())) for x in sums)], names=names)

        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(len(keys) + 1)]
            lists = [batch.column(n) for n in "acgt"]
            for r, key in enumerate(zip(*(batch.column(i).to_pylist() for i in range(len(keys) + 1)))):
                mine = np.stack([x[r].values.to_numpy(zero_copy_only=False) for x in lists])
                if key != at:
                    if at is not None:
                        yield one()
                    at, sums = key, mine.copy()
                else:
                    if mine.shape[1] > sums.shape[1]:
                        sums, mine = mine.copy(), sums
                    sums[:, : mine.shape[1]] += mine
        if at is not None:
            yield one()

    cut = rows.select(*keys, seq)
    types = dict(cut.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keys), "tile int", *(f"{b} array<long>" for b in "acgt")])
    group = [*keys, "tile"]
    return cut.mapInArrow(count, schema).repartition(*group).sortWithinPartitions(*group).mapInArrow(add, schema)


def consensus(rows: DataFrame, keys: list[str], seq: str = "seq_aln") -> DataFrame:
    """Each column's (``col``, from 0) counts of bases and most frequent one (``base``; A, C, G, T on ties, N where no row has one)."""
    cells = column_counts(rows, keys, seq).select(*keys, "tile", F.posexplode(F.arrays_zip(*"acgt")).alias("_i", "_n"))
    counts = cells.select(*keys, (F.col("tile") * TILE + F.col("_i")).alias("col"), "_n.*")
    return counts.select(*keys, "col", "a", "c", "g", "t", F.coalesce(majority_base(*map(F.col, "acgt")), F.lit("N")).alias("base"))


def consensus_texts(rows: DataFrame, keys: list[str], seq: str = "seq_aln") -> DataFrame:
    """Each group's consensus as the string ``cons``, from its tiles; groups without a column have none."""
    tiles = column_counts(rows, keys, seq).select(*keys, "tile", profile_consensus(*"acgt").alias("text"))
    return reassemble(tiles, keys, "tile", "text").withColumnRenamed("seq", "cons")


def with_consensus(rows: DataFrame, texts: DataFrame, keys: list[str], seq: str = "seq_aln") -> DataFrame:
    """Rows with their group's consensus (``cons``, of ``consensus_texts``) as far as the row goes; rows of groups without one go.

    Large groups are joined in parts. A group is as long as its longest row, so with whole consensus texts short rows would hold far more than their own letters.
    """
    return join_by_parts(rows, texts, keys).withColumn("cons", F.substr("cons", F.lit(1), F.coalesce(F.length(seq), F.lit(0))))


@F.pandas_udf(_struct(T.LongType(), "compared", "equal"))
def _identity(seq: pd.Series, cons: pd.Series) -> pd.DataFrame:
    out = []
    for a, b in zip(seq, cons):
        x, y = letters(a), letters(b)
        n = min(len(x), len(y))
        x, y = x[:n], y[:n]
        counted = (y != _N) & (x != _N) & ~np.isin(x, _GAPS)
        out.append((int(counted.sum()), int((counted & (x == y)).sum())))
    return pd.DataFrame(out, columns=["compared", "equal"])


def identity(rows: DataFrame, row: list[str], seq: str = "seq_aln", cons: str = "cons") -> DataFrame:
    """Share of a row's letters that equal the consensus, over columns where that is defined and the row
    has neither gap nor N. Letters that aren't bases count as different."""
    sums = rows.select(*row, _identity(seq, cons).alias("x")).select(*row, "x.*")
    return sums.withColumn("identity", F.when(F.col("compared") > 0, F.col("equal") / F.col("compared")).otherwise(0.0))


def route_by_identity(scores: DataFrame, least: float = 0.95) -> DataFrame:
    return scores.withColumn("status", F.when(F.col("identity") >= least, "accepted").otherwise("rejected"))


def _places(text: str | None) -> np.ndarray:
    x = letters(text)
    letter = _is_base(x) | (x == _N)
    return np.where(letter, np.cumsum(letter), -1).astype(np.int32)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def positions(seq: pd.Series) -> pd.Series:
    """For each column of a row the place (from 1) in the ungapped sequence, -1 where it has none."""
    return pd.Series([_places(text) for text in seq])


def with_positions(rows: DataFrame, row: list[str], seq: str = "seq_aln") -> DataFrame:
    """Rows' ``positions`` as the arrays ``pos``, made for about ``MOST_LETTERS`` at a time: they take far more room than the letters."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(len(row))), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes, dtype=np.int64) // MOST_LETTERS
            borders = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()
            for a, b in zip(borders, borders[1:]):
                cut = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*cut.columns[: len(row)], pa.array([_places(x) for x in cut.column(len(row)).to_pylist()], pa.list_(pa.int32()))], names=[*row, "pos"])

    cut = rows.select(*row, seq)
    kinds = dict(cut.dtypes)
    return cut.mapInArrow(place, ", ".join([*(f"`{c}` {kinds[c]}" for c in row), "pos array<int>"]))


def _compared(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """Per column: both sides have a base; and they differ."""
    x, y = letters(a), letters(b)
    n = min(len(x), len(y))
    x, y = x[:n], y[:n]
    comp = _is_base(x) & _is_base(y)
    return comp, comp & (x != y)


def mismatch_windows(rows: DataFrame, row: list[str], seq: str = "seq_aln", cons: str = "cons", window: int = 400, highest: float = 0.6, lowest: float = 0.35, slack: float = 0.25) -> DataFrame:
    """Complete windows (``s, e``, columns from 0), one every quarter (100 at least), of which half the
    columns are comparable and whose mismatch ratio reaches the row's threshold: its overall ratio plus
    ``slack``, within bounds."""
    step = max(100, window // 4)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def starts(seqs: pd.Series, agreed: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(seqs, agreed):
            comp, mis = _compared(a, b)
            at = np.arange(0, len(comp) - window + 1, step)
            c, m = (np.concatenate([[0], np.cumsum(x)]) for x in (comp, mis))
            overall = m[-1] / c[-1] if c[-1] else 0.0
            limit = max(lowest, min(highest, overall + slack))
            n, wrong = c[at + window] - c[at], m[at + window] - m[at]
            out.append(at[(n >= window * 0.5) & (wrong / np.maximum(n, 1) >= limit)].astype(np.int32))
        return pd.Series(out)

    return rows.select(*row, F.explode(starts(seq, cons)).alias("s")).withColumn("e", F.col("s") + (window - 1))


def merge_intervals(intervals: DataFrame, row: list[str], gap: int) -> DataFrame:
    """Intervals joined where one starts no more than ``gap`` after the furthest end before it."""
    order = Window.partitionBy(*row).orderBy("s", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.coalesce((F.col("s") > before + gap).cast("int"), F.lit(1)))
    island = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*row, "_island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_island")


@F.pandas_udf(T.LongType())
def _comparable(seq: pd.Series, cons: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([int(_compared(a, b)[0][s : e + 1].sum()) for a, b, s, e in zip(seq, cons, first, last)])


def largest_block(blocks: DataFrame, rows: DataFrame, row: list[str], least: int = 2000, seq: str = "seq_aln", cons: str = "cons") -> DataFrame:
    """Of each row's blocks the one with the most comparable columns (``least`` at least), the first of equals."""
    sized = blocks.join(rows.select(*row, seq, cons), row).select(*row, "s", "e", _comparable(seq, cons, "s", "e").alias("comp")).filter(F.col("comp") >= least)
    best = sized.groupBy(*row).agg(F.max(F.struct("comp", (-F.col("s")).alias("first"), "e")).alias("x"))
    return best.select(*row, (-F.col("x.first")).alias("s"), F.col("x.e").alias("e"), F.col("x.comp").alias("comp"))


def max_excess_block(scores: DataFrame, row: list[str], order: str = "col", score: str = "score") -> DataFrame:
    """The stretch of the largest positive sum: ``s, e`` (values of ``order``) and ``total``.

    Prefix sums against the smallest prefix so far: the stretch ends where the difference is first
    largest and starts right after the last place that had that smallest prefix.
    """
    upto = Window.partitionBy(*row).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    n = F.row_number().over(Window.partitionBy(*row).orderBy(order))
    sums = scores.select(*row, F.col(order).alias("o"), F.sum(score).over(upto).alias("p"), n.alias("i"))
    low = Window.partitionBy(*row).orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    origin = F.struct(F.lit(0).cast("long").alias("p"), F.lit(0).alias("i"))
    past = F.min(F.struct(F.col("p").cast("long").alias("p"), (-F.col("i")).alias("i"))).over(low)
    least = F.when(past.isNull() | (past["p"] > 0), origin).otherwise(past)
    gains = sums.withColumn("least", least).withColumn("gain", F.col("p") - F.col("least.p"))
    best = gains.filter("gain > 0").groupBy(*row).agg(F.max(F.struct("gain", (-F.col("i")).alias("i"), "o", (-F.col("least.i") + 1).alias("from"))).alias("x"))
    starts = best.select(*row, F.col("x.gain").alias("total"), F.col("x.o").alias("e"), F.col("x.from").alias("i"))
    return starts.join(sums.select(*row, "i", F.col("o").alias("s")), [*row, "i"]).select(*row, "s", "e", "total")


@F.pandas_udf(_struct(T.IntegerType(), "s", "e"))
def excess_stretch(seq: pd.Series, cons: pd.Series) -> pd.DataFrame:
    """The stretch of columns of a row with the largest excess of mismatches over matches; null without any."""
    out = []
    for a, b in zip(seq, cons):
        comp, mis = _compared(a, b)
        sums = np.concatenate([[0], np.cumsum(2 * mis.astype(np.int64) - comp)])
        least = np.minimum.accumulate(sums)[:-1]
        gain = sums[1:] - least
        end = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[end] <= 0:
            out.append((None, None))
        else:  # from right after the last place that had the smallest sum
            out.append((int(np.flatnonzero(sums[: end + 1] == least[end])[-1]), end))
    return pd.DataFrame(out, columns=["s", "e"]).astype("Int32")


def inversion_block(rows: DataFrame, row: list[str], window: int = 400, least: int = 2000, least_excess: int = 8000, seq: str = "seq_aln", cons: str = "cons") -> DataFrame:
    """A row's stretch that looks inverted: the largest block of mismatch windows, else the stretch with
    the largest excess of mismatches if that is long enough."""
    rows, step = cut_lineage(rows.select(*row, seq, cons)), max(100, window // 4)
    blocks = cut_lineage(largest_block(merge_intervals(mismatch_windows(rows, row, seq, cons, window), row, step), rows, row, least, seq, cons))
    rest = rows.join(blocks, row, "left_anti")
    spans = rest.select(*row, excess_stretch(seq, cons).alias("x")).select(*row, "x.*").filter("s is not null")
    sized = largest_block(spans, rest, row, max(least, least_excess), seq, cons)
    return blocks.withColumn("found_by", F.lit("windows")).unionByName(sized.withColumn("found_by", F.lit("excess")))


@F.pandas_udf(_struct(T.IntegerType(), "q_st", "q_en"))
def _span(seq: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
    out = []
    for text, s, e in zip(seq, first, last):
        x = letters(text)
        letter = _is_base(x) | (x == _N)
        before, upto = int(letter[:s].sum()), int(letter[: e + 1].sum())
        out.append((before + 1, upto) if upto > before else (None, None))
    return pd.DataFrame(out, columns=["q_st", "q_en"]).astype("Int32")


def span_in_query(rows: DataFrame, blocks: DataFrame, row: list[str], seq: str = "seq_aln") -> DataFrame:
    """First and last place (from 1) of the row's own letters inside its block; rows without any go."""
    found = rows.select(*row, seq).join(blocks.select(*row, "s", "e"), row).select(*row, _span(seq, "s", "e").alias("x"))
    return found.select(*row, "x.*").filter("q_st is not null")


def reassemble(cells: DataFrame, keys: list[str], order: str = "col", ch: str = "ch") -> DataFrame:
    """Cells joined to a string again, in order."""
    gathered = F.array_sort(F.collect_list(F.struct(order, ch)))
    return cells.groupBy(*keys).agg(F.array_join(F.transform(gathered, lambda x: x[ch]), "").alias("seq"))


def choose_orientation(candidates: DataFrame, row: list[str], score: str, flipped: str) -> DataFrame:
    """The better of the kept and the flipped candidate; of equals the flipped one. Both rows stay, marked."""
    best = Window.partitionBy(*row).orderBy(F.col(score).desc(), F.col(flipped).desc())
    return candidates.withColumn("chosen", F.row_number().over(best) == 1)
