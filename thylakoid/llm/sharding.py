"""Balanced shards of indivisible groups by Karmarkar-Karp differencing (operator 8)."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thylakoid.llm.common import materialize, partitions_for, scratch_folder

#: Groups that one task differences, and partial partitions that one task combines.
CELL_GROUPS, FAN_IN = 20_000, 500


def difference(loads: np.ndarray) -> np.ndarray:
    """Karmarkar-Karp over partial partitions.

    ``loads`` is (items, shards): the loads of each item's parts. Items are combined two by two,
    those of the largest spread first, the largest part of one with the smallest of the other.
    Returns (items, shards): the final place of every part of every item.
    """
    n, k = loads.shape
    order = np.argsort(-loads, axis=1, kind="stable")
    sums = [*np.take_along_axis(loads, order, axis=1)]  # descending
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        by = np.argsort(-total, kind="stable")
        joined.append((a, b, by))
        sums[a] = sums[b] = None
        sums.append(total[by])
        heapq.heappush(heap, (int(total[by[-1]] - total[by[0]]), len(sums) - 1))
    place = np.empty((len(sums), k), np.int64)  # of each part of a node, in its descending order
    place[-1] = np.arange(k)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, by = joined[node - n]
        place[a][by] = place[node]
        place[b][k - 1 - by] = place[node]
    out = np.empty((n, k), np.int64)
    np.put_along_axis(out, order, place[:n], axis=1)
    return out


def _combine(shards: int, key: str, parent: str):
    """Difference the partial partitions of one cell: their parts' places and the cell's own loads."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(key, kind="stable")
        loads = np.array(cell["loads"].tolist(), np.int64).reshape(len(cell), shards)
        place = difference(loads)
        total = np.zeros(shards, np.int64)
        np.add.at(total, place.ravel(), loads.ravel())
        return pd.DataFrame({key: cell[key].to_numpy(), parent: cell[parent].to_numpy(), "place": list(place), "total": [total] + [None] * (len(cell) - 1)})

    return run


def assign_groups(groups: DataFrame, shards: int, cell_groups: int = CELL_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """A shard for each group (columns ``g1``, ``g2``, ``size``), so that loads are near equal.

    Groups are hashed into cells of about ``cell_groups``; each cell is differenced into one partial
    partition, and those are differenced in turn, ``fan_in`` at a time, until one is left. So no task
    holds more than a cell, and the driver holds none.
    """
    folder = scratch_folder(groups.sparkSession)
    cells = partitions_for(groups.count(), cell_groups)
    first = groups.withColumn("cell", F.pmod("g1", F.lit(cells)).cast("long"))

    def local(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["size", "g1", "g2"], ascending=[False, True, True], kind="stable")
        loads = np.zeros((len(cell), shards), np.int64)
        loads[:, 0] = cell["size"]
        shard = difference(loads)[:, 0]
        total = np.zeros(shards, np.int64)
        np.add.at(total, shard, cell["size"].to_numpy())
        return pd.DataFrame({"g1": cell["g1"].to_numpy(), "g2": cell["g2"].to_numpy(), "cell": cell["cell"].to_numpy(), "part": shard.astype(np.int32), "total": [total] + [None] * (len(cell) - 1)})

    placed = materialize(first.groupBy("cell").applyInPandas(local, "g1 long, g2 long, cell long, part int, total array<long>"), folder)
    level, node, steps = placed.filter("total is not null").select(F.col("cell").alias("n0"), F.col("total").alias("loads")), cells, 0
    where = None  # cell and part -> part of its present ancestor
    while node > 1:
        up = partitions_for(node, fan_in)
        key, parent = f"n{steps}", f"n{steps + 1}"
        kids = level.withColumn(parent, F.expr(f"{key} div {fan_in}"))
        found = materialize(kids.groupBy(parent).applyInPandas(_combine(shards, key, parent), f"{key} long, {parent} long, place array<long>, total array<long>"), folder)
        level = found.filter("total is not null").select(parent, F.col("total").alias("loads"))
        moves = found.select(key, parent, F.posexplode("place").alias("part", "to"))
        if where is None:
            where = moves.select(F.col(key).alias("cell"), "part", parent, F.col("to").cast("int").alias("at"))
        else:
            step = moves.select(key, F.col("part").alias("at"), parent, F.col("to").cast("int").alias("next"))
            where = where.join(step, [key, "at"]).select("cell", "part", parent, F.col("next").alias("at"))
        node, steps = up, steps + 1
    if where is None:
        return placed.select("g1", "g2", F.col("part").alias("shard"))
    return placed.join(where, ["cell", "part"]).select("g1", "g2", F.col("at").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", slot_rows: int = 50_000) -> DataFrame:
    """All documents in ``shards`` shards of near equal bytes, equal texts in one shard.

    Returns one row per document row: the id column, ``size`` (UTF-8 bytes plus 1; a null text has no
    bytes), ``text_crc32`` (0 for a null text, as for an empty one), ``law`` (``bytes``), ``shard``,
    ``slot`` (from 0 without gaps in each shard) and ``grown_shard`` (null: growing moves rows under
    this law). Null texts are one group, empty ones another. Repeated rows and null ids get slots of
    their own. A group larger than a fair share fills its shard alone as far as that goes: groups are
    never divided. Other columns aren't read.

    Slots count rows within (shard, slice) and add the slices' running totals; slices come from the
    id's hash, so a hot group of texts is spread over them; rows of one id, or of null ids, share a slice.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text.isNull(), text).alias("g1"),
        F.xxhash64(F.lit(1), text, text.isNull()).alias("g2"),
    )
    rows = materialize(rows)
    groups = rows.groupBy("g1", "g2").agg(F.sum("size").alias("size"))
    slices = partitions_for(rows.count(), slot_rows * shards)
    placed = rows.join(assign_groups(groups, shards), ["g1", "g2"]).withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)))
    placed = materialize(placed.select("id", "size", "text_crc32", "shard", "slice"))
    before = placed.groupBy("shard", "slice").count()
    before = before.withColumn("start", F.sum("count").over(Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, "start").drop("count")
    within = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("id", "text_crc32", "size")) - 1
    return placed.withColumn("nth", within).join(before, ["shard", "slice"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("nth")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

