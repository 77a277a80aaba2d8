"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import materialize, scratch_folder


#: A vertex with more links than this, or than a hundred-thousandth of all links, is hot.
LEAST_HOT, MOST_HOT = 256, 100_000


def connected_components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """``(v, root)`` for every vertex of ``links`` (``a``, ``b``) that isn't the smallest of its component.

    Loops and repeated links are harmless; null ends are ignored. Every round is a few joins and
    combined aggregations on the remaining links, written to the shared scratch folder; links of a vertex
    that has very many are joined in several parts. Only a row count and a checksum reach the driver.
    """
    folder = folder or scratch_folder(links.sparkSession)
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), folder
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        hot = max(LEAST_HOT, 2 * before[0] // MOST_HOT)
        hot = hot if both.groupBy("v").count().agg(F.max("count")).first()[0] > hot else None
        # large star: the neighbours above a centre go to its smallest neighbour
        large = _with_least(both, hot, F.least("v", "m")).filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        # small star: a centre and its neighbours below go to the smallest of these
        low = large.groupBy("v").agg(F.min("u").alias("u"))
        moved = _with_least(large, hot, F.col("m")).filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = materialize(moved.unionByName(low).distinct(), folder)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select("v", F.col("u").alias("root"))


def _with_least(pairs: DataFrame, hot: int | None, value) -> DataFrame:
    """Pairs ``v, u`` with ``m``, an expression over the smallest ``u`` of their ``v`` (as ``m``) and ``v``.

    A vertex of more than ``hot`` pairs is joined in parts of about that many, dealt by ``u``. Those
    vertices are at most ``MOST_HOT`` by the choice of ``hot``, so their list can be broadcast. None: there is no such vertex.
    """
    least = pairs.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")).withColumn("m", value)
    if hot is None:
        return pairs.join(least.drop("n"), "v").select("v", "u", "m")
    parts = F.ceil(F.col("n") / hot).cast("int")
    crowded = F.broadcast(least.filter(F.col("n") > hot).select("v", parts.alias("parts")))
    dealt = pairs.join(crowded, "v", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("u"), F.col("parts")), F.lit(0)).cast("int"))
    spread = least.select("v", "m", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return dealt.join(spread, ["v", "part"]).select("v", "u", "m")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("v", "u")).alias("x")).first()
    return row.n, row.x
