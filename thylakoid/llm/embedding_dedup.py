"""Embedding near-dedup: sign hashing, exact cosine verification, connected components (operator 9)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import materialize, scratch_folder
from thylakoid.llm.components import connected_components

THRESHOLD, MISS, SEED = 0.93, 1e-4, 7
#: Vectors of one bucket that a task compares at a time; larger buckets are cut into blocks and dealt in pairs of them.
BLOCK_ROWS = 1024
#: Vectors that a bucket of unrelated ones holds on average.
BUCKET_ROWS = 32


def tables_for(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits of a hash and number of tables, for ``n`` vectors of one label: a pair at the threshold
    shares no bucket with probability ``miss`` at most, and one further above it less often."""
    bits = max(4, min(24, math.ceil(math.log2(max(n, 1) / BUCKET_ROWS))) if n > BUCKET_ROWS else 4)
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _sign_hashes(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """For each vector the number of its side of the table's random hyperplanes."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], bits * tables))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def _matrix(column: pa.ListArray, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _hash_vectors(bits: int, tables: int, seed: int):
    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                hashes = _sign_hashes(_matrix(part.column("vector"), part.num_rows), bits, tables, seed)
                yield part.append_column("hashes", pa.array(list(hashes), pa.list_(pa.int32())))

    return run


def _compare(threshold: float):
    """Over rows that come sorted by bucket: link counts and links that connect, one bucket at a time."""
    names = ["label", "dim", "tab", "key", "left", "right"]

    def run(batches):
        held = None
        for batch in batches:
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            ids = np.array([rows.column(c).to_numpy(zero_copy_only=False) for c in names])
            edge = np.r_[0, np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1]
            for a, b in zip(edge[:-1], edge[1:]):
                if b - a > 1:
                    yield from bucket(rows.slice(a, b - a))
            held = rows.slice(edge[-1])
        if held is not None and held.num_rows > 1:
            yield from bucket(held)

    def bucket(rows):
        n = rows.num_rows
        rep, weight = rows.column("rep").to_numpy(), rows.column("weight").to_numpy()
        block = rows.column("block").to_numpy()
        tab, left, right = (rows.column(c)[0].as_py() for c in ("tab", "left", "right"))
        vectors = _matrix(rows.column("vector"), n)
        vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        hashes = _matrix(rows.column("hashes"), n)
        close = vectors @ vectors.T >= threshold
        np.fill_diagonal(close, False)
        if left != right:  # pairs within a block have a task of their own
            close &= block[:, None] != block[None, :]
        if not close.any():
            return
        i, j = np.nonzero(np.triu(close))
        fresh = np.ones(len(i), bool)  # counted in the first table whose bucket they share
        for t in range(tab):
            fresh &= hashes[i, t] != hashes[j, t]
        found = np.zeros(n, np.int64)
        np.add.at(found, i[fresh], weight[j[fresh]])
        np.add.at(found, j[fresh], weight[i[fresh]])
        some = np.flatnonzero(found)
        a, b = [], []
        open_ = np.flatnonzero(close.any(axis=1))
        while len(open_) > 1:
            front, open_ = [open_[0]], open_[1:]
            while front and len(open_):
                seed = front.pop()
                near = close[seed, open_]
                a.append(np.full(near.sum(), rep[seed]))
                b.append(rep[open_[near]])
                front += open_[near].tolist()
                open_ = open_[~near]
        a, b = np.concatenate(a), np.concatenate(b)
        yield pa.RecordBatch.from_pydict({"a": np.r_[rep[some], a], "b": pa.array(np.r_[np.zeros(len(some), np.int64), b], mask=np.r_[np.ones(len(some), bool), np.zeros(len(b), bool)]), "n": np.r_[found[some], np.zeros(len(a), np.int64)]})

    return run


def near_vectors(table: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED, block_rows: int = BLOCK_ROWS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Link vectors of one label whose cosine, in double precision, is at least ``threshold``.

    Returns one row per input row: the id column, ``n_links`` (other ids linked directly),
    ``component_id`` (the smallest id reachable, the own one included), ``kept`` (id = component_id).
    Null labels, null, empty or zero vectors, and vectors with null or non-finite components link with
    nothing: no links, their own component. Vectors of different length never link. Rows that repeat
    an id and vector count as one; a null id is in no link. Other columns aren't read.

    Equal vectors are one vertex with a weight. Pairs meet in buckets of sign hashes (``tables_for``);
    a pair that shares several is counted in the first. Buckets of more than ``block_rows`` are cut
    into blocks by a hash of the id, and each pair of blocks is a group of its own, so no task holds
    more than two blocks. Links leave a task as counts and as a forest, never as all pairs.
    """
    spark = table.sparkSession
    folder = scratch_folder(spark)
    vector = F.col(vector_col).cast("array<double>")
    sound = F.coalesce(
        F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0.0),
        F.lit(False),
    )
    rows = table.select(
        F.col(id_col).alias("id"),
        F.when(sound, F.col(label_col)).alias("label"),
        F.when(sound, F.xxhash64(vector)).alias("h1"),
        F.when(sound, F.xxhash64(F.lit(1), vector)).alias("h2"),
        F.when(sound, F.col(vector_col)).alias("vector"),
    )
    groups = rows.filter("label is not null").groupBy("label", "h1", "h2").agg(F.min("id").cast("long").alias("rep"), F.count_distinct("id").alias("weight"), F.min("vector").alias("vector"))
    groups = materialize(groups.withColumn("dim", F.size("vector")), folder)
    most = groups.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(most, threshold, miss)
    lean = groups.select("label", "dim", "rep", "weight", "vector")
    hashed = materialize(lean.mapInArrow(_hash_vectors(bits, tables, seed), "label {0}, dim int, rep long, weight long, vector {1}, hashes array<int>".format(*(dict(lean.dtypes)[c] for c in ("label", "vector")))), folder)
    keyed = hashed.select("*", F.posexplode("hashes").alias("tab", "key"))
    bucket = ["label", "dim", "tab", "key"]
    large = keyed.groupBy(*bucket).count().filter(F.col("count") > block_rows).withColumn("blocks", F.ceil(F.col("count") / block_rows).cast("int")).drop("count")
    dealt = keyed.join(large, bucket, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*bucket, F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "rep", "weight", "vector", "hashes")
    group = [*bucket, "left", "right"]
    found = materialize(dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_compare(threshold), "a long, b long, n long"), folder)
    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.filter("b is not null").select("a", "b"), folder)
    known = groups.select("label", "h1", "h2", "rep", "weight").join(counts, "rep", "left").join(roots.withColumnRenamed("v", "rep"), "rep", "left")
    known = known.select("label", "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    out = rows.select("id", "label", "h1", "h2").join(known, ["label", "h1", "h2"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").cast("long").alias("component_id"),
        (F.coalesce("component_id", "id") == F.col("id")).alias("kept"),
    )
