"""Hard-negative mining with subset-sum tables over bit planes (operator 12)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thylakoid.llm.common import materialize, scratch_folder

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Hundredths of the positive's score between which a negative's score lies.
LEAST, MOST = 50, 95
#: Anchors whose tables a task holds, rows of one cell of the grid, and rows that are scored at a time.
ANCHORS, CELL_ROWS, BLOCK = 1024, 4096, 512
#: Bytes of tables that a task holds; long vectors have fewer anchors a cell.
TABLE_BYTES = 64 << 20
_GROUP = 8


def _planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Rows of whole numbers as packed bit planes of their two's complement: rows x bits x groups of eight dimensions."""
    rows, dims = values.shape
    padded = np.zeros((rows, -(-dims // _GROUP) * _GROUP), np.int64)
    padded[:, :dims] = values
    shifted = (padded[:, None, :] >> np.arange(bits)[:, None]) & 1
    return np.packbits(shifted.astype(np.uint8), axis=2, bitorder="little")


def _values(planes: np.ndarray) -> np.ndarray:
    """The numbers that packed planes hold."""
    bits = planes.shape[1]
    weight = np.array([1 << b for b in range(bits - 1)] + [-(1 << bits - 1)], np.int64)
    ones = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    return (ones * weight[:, None]).sum(axis=1)


class SubsetSums:
    """Scores of anchors against rows: for each group of eight dimensions, the sums of all subsets of an anchor's numbers."""

    def __init__(self, anchors: np.ndarray, bits: int):
        groups = anchors.shape[1] // _GROUP
        most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << bits
        kind = np.int32 if most < 1 << 31 else np.int64
        self.bits = bits
        self.tables = np.zeros((groups, 256, len(anchors)), kind)
        for j in range(_GROUP):  # a subset with dimension j is one without it and the dimension's number
            self.tables[:, 1 << j : 2 << j] = self.tables[:, : 1 << j] + anchors[:, j::_GROUP].T[:, None, :].astype(kind)

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """Inner products, rows x anchors: from the sign's plane down, the sum so far is doubled and the planes' sums are added."""
        out = np.zeros((len(planes), self.tables.shape[2]), self.tables.dtype)
        for b in range(self.bits - 1, -1, -1):
            out <<= 1
            for g, table in enumerate(self.tables):
                looked = table[planes[:, b, g]]
                out = out - looked if b == self.bits - 1 else np.add(out, looked, out=out)
        return out


class Best:
    """The rows of highest score, ties by smaller id, of each of some slots."""

    def __init__(self, slots: int, size: int):
        self.size, self.count = size, np.zeros(slots, np.int64)
        self.score, self.id = np.zeros((slots, size), np.int64), np.zeros((slots, size), np.int64)

    def least(self) -> np.ndarray:
        """The score that a row must reach to come in."""
        return np.where(self.count < self.size, np.iinfo(np.int64).min, self.score[:, -1])

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(slot)
        held = np.arange(self.size) < self.count[touched, None]
        slot = np.r_[np.repeat(touched, self.count[touched]), slot]
        score, ids = np.r_[self.score[touched][held], score], np.r_[self.id[touched][held], ids]
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        keep = rank < self.size
        self.score[slot[keep], rank[keep]], self.id[slot[keep], rank[keep]] = score[keep], ids[keep]
        self.count[touched] = np.minimum(np.diff(np.r_[first, len(slot)]), self.size)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, rank = np.nonzero(np.arange(self.size) < self.count[:, None])
        return slot, self.score[slot, rank], self.id[slot, rank]


def _cells(bits: int, size: int, ranges: bool):
    """Over rows that come sorted by cell, anchors first: the best rows of each anchor in each cell.

    Without ``ranges`` those of the anchor's label; with them those of other labels whose score lies in the
    range of each of the anchor's positives.
    """

    def columns(batch: pa.RecordBatch) -> dict:
        return {n: batch.column(n) for n in batch.schema.names}

    def run(batches):
        cell, state = None, None
        for batch in batches:
            ids = batch.column("cell").to_numpy()
            edge = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1, len(ids)]
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if b == a:
                    continue
                if ids[a] != cell:
                    if state:
                        yield from state.results()
                    cell, state = ids[a], _Cell(bits, size, ranges)
                part = batch.slice(a, b - a)
                anchors = int(np.count_nonzero(part.column("kind").to_numpy() == 0))
                if anchors:
                    state.anchors.append(columns(part.slice(0, anchors)))
                if anchors < b - a:
                    state.meet(columns(part.slice(anchors)))
        if state:
            yield from state.results()

    return run


class _Cell:
    """Some anchors and their best among the rows that they have met."""

    def __init__(self, bits: int, size: int, ranges: bool):
        self.bits, self.size, self.ranges, self.anchors, self.tables = bits, size, ranges, [], None

    def build(self) -> None:
        def gathered(name: str) -> np.ndarray:
            return np.concatenate([part[name].to_numpy(zero_copy_only=False) for part in self.anchors])

        self.tables = {}
        self.row, self.id, self.label, dims = (gathered(n) for n in ("row", "id", "label", "dim"))
        planes = [p for part in self.anchors for p in part["planes"].to_pylist()]
        if self.ranges:  # slots in the order of anchors: a positive each
            held = [p for part in self.anchors for p in part["positives"].to_pylist()]
            self.owner = np.repeat(np.arange(len(held)), [len(p) for p in held])
            self.positive, self.low, self.high = (np.array([p[n] for some in held for p in some], np.int64) for n in ("nth", "low", "high"))
        else:
            self.owner = np.arange(len(self.id))
        self.best = Best(len(self.owner), self.size)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            # rows of a length meet anchors of that length, whose slots follow one another
            self.tables[int(dim)] = at, SubsetSums(_values(_unpack([planes[i] for i in at], self.bits)), self.bits)

    def meet(self, rows: dict) -> None:
        if not self.anchors:
            return
        if self.tables is None:
            self.build()
        ids, labels, dims = (rows[n].to_numpy(zero_copy_only=False) for n in ("id", "label", "dim"))
        planes = rows["planes"].to_pylist()
        for dim, (at, sums) in self.tables.items():
            mine = np.flatnonzero(dims == dim)
            slots = np.flatnonzero(np.isin(self.owner, at))
            column = np.searchsorted(at, self.owner[slots])
            for i in range(0, len(mine), BLOCK):
                some = mine[i : i + BLOCK]
                scores = sums.scores(_unpack([planes[r] for r in some], self.bits))
                least = self.best.least()[slots]
                if self.ranges:
                    low, high = np.maximum(self.low[slots], least), self.high[slots]
                    wide = scores[:, column]
                    open_ = (wide >= low) & (wide <= high)
                    r, s = np.nonzero(open_)
                    right = labels[some[r]] != self.label[self.owner[slots[s]]]
                else:
                    wide = scores
                    r, s = np.nonzero(wide >= least)
                    right = (labels[some[r]] == self.label[self.owner[slots[s]]]) & (ids[some[r]] != self.id[self.owner[slots[s]]])
                r, s = r[right], s[right]
                if len(r):
                    self.best.add(slots[s], wide[r, s].astype(np.int64), ids[some[r]])

    def results(self):
        if self.tables is None:
            return
        slot, score, ids = self.best.rows()
        out = {"row": self.row[self.owner[slot]], "score": score, "id": ids}
        if self.ranges:
            out["nth"] = self.positive[slot].astype(np.int32)
        yield pa.RecordBatch.from_pydict(out)


def _unpack(planes: list[bytes], bits: int) -> np.ndarray:
    if not planes[0]:
        return np.zeros((len(planes), bits, 0), np.uint8)
    return np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), bits, -1)


def _pack(bits: int):
    """Rows of whole numbers to their planes."""

    def run(batches):
        for batch in batches:
            lists = batch.column("values")
            sizes = np.diff(lists.offsets.to_numpy())
            packed: list = [b""] * batch.num_rows
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.r_[0, np.cumsum(sizes)]
            for dim in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == dim)
                values = flat[first[at][:, None] + np.arange(dim)]
                for i, planes in zip(at, _planes(values, bits)):
                    packed[i] = planes.tobytes()
            kept = [n for n in batch.schema.names if n != "values"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(sizes.astype(np.int32)), pa.array(packed, pa.binary())], names=[*kept, "dim", "planes"])

    return run


def hard_negatives(table: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchors_a_cell: int = ANCHORS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Rows of other labels that score almost as high with an anchor as its positives do.

    Components become ``floor(scale * x)``; a score is the whole inner product, exact. Rows rank by score,
    the higher first, then by id. An anchor's positives are its first ``positives`` other rows of its label;
    for each, the negatives are the first ``negatives`` rows of other labels whose score is between ``least``
    and ``most`` hundredths of the positive's. ``is_anchor`` is an expression over ``table``.

    Returns ``anchor_id, positive_id, rank`` (from 1), ``negative_id, positive_score, negative_score``; a positive without
    a negative has no row. Rows with a null id, label or vector, or with null or non-finite components, take no part;
    nor do those with a component so large that scores could leave 56 bits. Vectors meet those of their own length,
    empty ones score 0. Equal rows (id, label, vector) count once; of rows that repeat an id otherwise each counts for
    itself, as anchor too, but never as a positive of its own id. Other columns aren't read.

    Anchors in blocks of ``anchors_a_cell`` meet rows in blocks of about ``cell_rows``, one cell of the grid a
    time; a row is sent once for each block of anchors, as packed bit planes. Cells return the best rows of each anchor only.
    """
    spark = table.sparkSession
    folder = scratch_folder(spark)
    vector = F.col(vector_col).cast("array<double>")
    values = F.transform(vector, lambda x: F.floor(x * scale))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limit = F.sqrt(F.lit(2.0**55) / F.greatest(F.size(vector), F.lit(1)))
    small = F.forall(vector, lambda x: F.abs(x * scale) < limit - 1)
    rows = table.filter(sound & small & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), is_anchor.alias("anchor"), values.alias("values"))
    rows = rows.dropDuplicates(["id", "label", "values"])
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), folder)
    # numbers from -2^(bits - 1) to 2^(bits - 1) - 1
    reach = F.greatest(F.coalesce(F.array_max("values"), F.lit(0)), -F.coalesce(F.array_min("values"), F.lit(0)) - 1)
    most_value, n, n_anchors, dims = rows.agg(F.coalesce(F.max(reach), F.lit(0)), F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("values")), F.lit(0))).first()
    bits = max(1, int(most_value).bit_length() + 1)
    packed = materialize(rows.mapInArrow(_pack(bits), "id long, label long, anchor boolean, row long, dim int, planes binary"), folder)
    held = max(1, min(anchors_a_cell, TABLE_BYTES // (256 * 8 * max(1, -(-dims // _GROUP)))))
    tall, wide = max(1, math.ceil(n_anchors / held)), max(1, math.ceil(n / cell_rows))

    def meet(anchors: DataFrame, size: int) -> DataFrame:
        ranges = "positives" in anchors.columns
        every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
        up, along = F.pmod(F.xxhash64("row"), F.lit(tall)), F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(wide))
        common = ["row", "id", "label", "dim", "planes"]
        left = anchors.select(*common, *(["positives"] if ranges else []), F.lit(0).alias("kind"), up.alias("up"), every(wide).alias("along"))
        right = packed.select(*common, F.lit(1).alias("kind"), along.alias("along"), every(tall).alias("up"))
        both = left.unionByName(right, allowMissingColumns=ranges).withColumn("cell", (F.col("up") * wide + F.col("along")).cast("long")).drop("up", "along")
        dealt = both.repartition(tall * wide, "cell").sortWithinPartitions("cell", "kind")
        return dealt.mapInArrow(_cells(bits, size, ranges), "row long, score long, id long" + (", nth int" if ranges else ""))

    def ranked(found: DataFrame, by: list[str], size: int, number: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        return found.withColumn(number, F.row_number().over(order)).filter(F.col(number) <= size)

    anchors = packed.filter("anchor")
    near = materialize(ranked(meet(anchors, positives), ["row"], positives, "nth"), folder)
    near = near.filter("score >= 0")  # below zero the range is empty
    bounds = F.struct("nth", F.expr(f"({least} * score + 99) div 100").alias("low"), F.expr(f"{most} * score div 100").alias("high"))
    asked = materialize(anchors.join(near.groupBy("row").agg(F.collect_list(bounds).alias("positives")), "row"), folder)
    found = ranked(meet(asked, negatives), ["row", "nth"], negatives, "rank")
    ends = anchors.select("row", F.col("id").alias("anchor_id")).join(near.select("row", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "row")
    out = found.join(ends, ["row", "nth"])
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
