"""URL rules through a blocked Bloom filter and an exact hash join (operator 4)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.llm.common import ascii_lower, partitions_for

#: Bits a listed key gets in the filter, bits set for each, and the bits of a block (eight 64-bit words).
BITS_PER_KEY, PROBES, BLOCK_WORDS = 16, 8, 8
#: The filter is broadcast, so its size is bounded: with more keys than these bytes serve, bits per key go down.
MOST_BYTES = 64 << 20


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path
    (up to ``?``, ``#`` or the end); both empty for null and where ``://`` is missing."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return ascii_lower(host), path


def canonical(host: Column, path: Column) -> Column:
    """The key under which a rule is listed."""
    return F.concat(host, path)


class BlockedBloom:
    """A Bloom filter whose probes for one key all fall into one block of 512 bits."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def build(cls, keys: DataFrame, hash_col: str, n_keys: int) -> "BlockedBloom":
        """From a column of 64-bit hashes. Tasks build partial filters of the (bounded) full size and
        only their set words travel, OR-ed on the way."""
        bits = min(BITS_PER_KEY * max(n_keys, 1), MOST_BYTES * 8)
        blocks = partitions_for(bits, 64 * BLOCK_WORDS)

        def fold(batches):
            words = np.zeros(blocks * BLOCK_WORDS, np.uint64)
            for batch in batches:
                at, bit = _probes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), blocks)
                np.bitwise_or.at(words, at.ravel(), bit.ravel())
            used = np.flatnonzero(words)
            yield pa.RecordBatch.from_pydict({"word": pa.array(used, pa.int64()), "bits": pa.array(words[used].view(np.int64))})

        partial = keys.select(hash_col).dropna().mapInArrow(fold, "word long, bits long")
        rows = partial.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(blocks * BLOCK_WORDS, np.uint64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(words)

    def might_hold(self, hashes: np.ndarray) -> np.ndarray:
        at, bit = _probes(hashes.view(np.uint64), len(self.words) // BLOCK_WORDS)
        return ((self.words[at] & bit) == bit).all(axis=0)


def _probes(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key, the words and bits of its probes: the high half picks the block, the low half the bits."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    step = hashes * np.uint64(0x9E3779B97F4A7C15)
    at, bit = [], []
    for k in range(PROBES):
        place = (step >> np.uint64(7 * k)) & np.uint64(64 * BLOCK_WORDS - 1)
        at.append(block * np.uint64(BLOCK_WORDS) + (place >> np.uint64(6)))
        bit.append(np.uint64(1) << (place & np.uint64(63)))
    return np.array(at).astype(np.int64), np.array(bit)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The verdict on each url by the longest rule that fits it.

    ``rules`` has ``host``, ``path``, ``verdict``. A rule fits its host and all subdomains if the
    url's path starts with the rule's path. The longest is that whose host and path together are
    longest; of equally long ones, the one with the longer host. Rules that are listed twice with
    one verdict count once; with two, the smaller verdict text holds. Null rule fields never fit.

    Returns one row per page row: the id column, ``host``, ``path``, ``rule`` (host and path, else
    null), ``verdict`` (the rule's, else ``default``). Null urls and urls without ``://`` have an
    empty host and path, which no rule fits. Other columns aren't read; repeated rows stay.

    Every url offers its host's suffixes, each with the path prefixes of the lengths that occur in
    rules (a few numbers, gathered as such). The filter passes few of them on; those join the rules
    exactly, by hash, so no false positive survives. A verdict is found once per distinct url part.
    """
    spark = pages.sparkSession
    rules = rules.select("host", "path", "verdict").dropna().withColumn("host", ascii_lower(F.col("host"))).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    listed = rules.withColumn("rule", canonical(F.col("host"), F.col("path"))).withColumn("host_len", F.length("host"))
    keyed = listed.withColumn("h", F.xxhash64("host", "path"))
    lengths = sorted(r.n for r in listed.select(F.length("path").alias("n")).distinct().toLocalIterator())
    bloom = spark.sparkContext.broadcast(BlockedBloom.build(keyed, "h", keyed.count()).words)

    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.transform(F.filter(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n)))
    offers = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("host"), p.alias("path")))))
    parts = urls.filter(F.col("host") != "").select("host", "path").distinct()
    offered = parts.select("host", "path", F.explode(offers).alias("o")).select("host", "path", F.col("o.host").alias("o_host"), F.col("o.path").alias("o_path")).withColumn("h", F.xxhash64("o_host", "o_path"))

    def pass_on(batches):
        filt = BlockedBloom(bloom.value)
        for batch in batches:
            yield batch.filter(pa.array(filt.might_hold(batch.column(4).to_numpy(zero_copy_only=False))))

    likely = offered.mapInArrow(pass_on, offered.schema)
    hits = likely.join(listed.select(F.col("host").alias("o_host"), F.col("path").alias("o_path"), "rule", "verdict", "host_len"), ["o_host", "o_path"])
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), "host_len", "rule", "verdict")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")
