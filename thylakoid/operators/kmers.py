"""k-mer similarity, exact-match anchors and read mapping.

k-mers of up to 31 bases are numbers of two bits a base, made from whole sequences at a time by Arrow
functions, so a sequence costs time in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thylakoid.functions.sequence import revcomp
from thylakoid.session import cut_lineage

#: Parts in which the places of a k-mer at more than so many places are joined.
SALTS, HOT_PLACES = 16, 1000
#: Rows that an Arrow function puts out at a time, and pairs of equal k-mers that it holds at a time.
OUT_ROWS, PAIRS = 1 << 18, 1 << 21
#: Bases of a contig in one row where reads meet their reference.
TILE = 1024

_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _CODE[_b + 32] = _i


def kmer_codes(seq: str | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (from 0) and codes of a sequence's k-mers in any case, without those with other letters than ACGT."""
    if not 1 <= k <= 31:
        raise ValueError("k must be from 1 to 31")
    base = _CODE[np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)]
    n = len(base) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code, done, size, part = np.zeros(n, np.int64), 0, 1, (base & 3).astype(np.int64)
    while size <= k:  # codes of 1, 2, 4 .. letters, put together for the sizes that k holds
        if k & size:
            code = (code << (2 * size)) | part[done : done + n]
            done += size
        part = (part[:-size] << (2 * size)) | part[size:]
        size *= 2
    odd = np.concatenate([[0], np.cumsum(base > 3)])
    at = np.flatnonzero(odd[k:] == odd[:n])
    return at, code[at]


def kmer_positions(rows: DataFrame, keys: list[str], seq: str, k: int) -> DataFrame:
    """Every k-mer (``kmer``, as a number) with its place ``i`` (from 0); those with other letters than ACGT are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, text in enumerate(batch.column(len(keys)).to_pylist()):
                at, code = kmer_codes(text, k)
                for a in range(0, len(at), OUT_ROWS):
                    part = slice(a, a + OUT_ROWS)
                    row = pa.array(np.full(len(at[part]), r))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in range(len(keys))), pa.array(at[part].astype(np.int32)), pa.array(code[part])], names=[*keys, "i", "kmer"])

    cut = rows.select(*keys, F.col(seq).alias("_seq"))
    kinds = dict(cut.dtypes)
    return cut.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), "i int", "kmer long"]))


def shared_kmers(k: int):
    """A function of two sequences: how many different k-mers both have, and how many either has."""

    @F.pandas_udf("shared long, total long")
    def count(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out, last, mine = [], None, None
        for x, y in zip(a, b):
            if mine is None or x != last:
                last, mine = x, np.unique(kmer_codes(x, k)[1])
            out.append(_shared(mine, mine if x == y else np.unique(kmer_codes(y, k)[1])))
        return pd.DataFrame(out, columns=["shared", "total"])

    return count


def _shared(one: np.ndarray, other: np.ndarray) -> tuple[int, int]:
    """How many of two sorted sets' values both have, and how many either has: two sorted runs are merged, not sorted."""
    both = np.sort(np.concatenate([one, other]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared, len(both) - shared


def shared_kmers_of_both(k: int):
    """As ``shared_kmers`` of a sequence with each of two others: its own k-mers are made once."""

    @F.pandas_udf("shared_a long, total_a long, shared_b long, total_b long")
    def count(ref: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for x, *others in zip(ref, a, b):
            mine = np.unique(kmer_codes(x, k)[1])
            out.append([n for y in others for n in _shared(mine, mine if x == y else np.unique(kmer_codes(y, k)[1]))])
        return pd.DataFrame(out, columns=["shared_a", "total_a", "shared_b", "total_b"])

    return count


def kmer_jaccard(rows: DataFrame, pairs: DataFrame, key: str, seq: str, k: int = 21) -> DataFrame:
    """Jaccard similarity of the k-mer sets of given pairs (columns ``a``, ``b``); 0 if a set is empty or
    a sequence missing. Sequences join their pairs; sets are made and met pair by pair, and nothing is exploded."""
    side = {x: rows.select(F.col(key).alias(x), F.col(seq).alias(f"_{x}")) for x in "ab"}
    both = pairs.select("a", "b").join(side["a"], "a", "left").join(side["b"], "b", "left")
    out = both.select("a", "b", shared_kmers(k)("_a", "_b").alias("x"))
    return out.select("a", "b", "x.shared", "x.total", F.when(F.col("x.total") > 0, F.col("x.shared") / F.col("x.total")).otherwise(0.0).alias("jaccard"))


def match_islands(a: str | None, b: str | None, k: int) -> np.ndarray:
    """Maximal exact matches of at least ``k`` bases, as rows of (place in a, place in b, size).

    Equal k-mers at successive places of one diagonal are one match. Pairs of equal k-mers are held for
    a stretch of ``a`` at a time; matches that cross its end are joined after.
    """
    (i, x), (j, y) = kmer_codes(a, k), kmer_codes(b, k)
    order = np.argsort(y, kind="stable")
    j, y = j[order], y[order]
    low, high = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    upto = np.cumsum(high - low)
    parts, start = [np.zeros((0, 3), np.int64)], 0
    while start < len(x):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS, "right")))
        n = (high - low)[start:end]
        first = np.repeat(i[start:end], n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[start:end], n)
        diagonal = first - j[place]
        order = np.lexsort((first, diagonal))
        parts.append(_joined(diagonal[order], first[order], first[order] + 1))
        start = end
    rows = np.concatenate(parts)
    if len(parts) > 2:
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        rows = _joined(*rows.T)
    return np.stack([rows[:, 1], rows[:, 1] - rows[:, 0], rows[:, 2] - rows[:, 1] + k - 1], axis=1)


def _joined(diagonal: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Stretches (sorted by diagonal and start) that touch, as one."""
    if not len(start):
        return np.zeros((0, 3), np.int64)
    new = np.flatnonzero(np.r_[True, (diagonal[1:] != diagonal[:-1]) | (start[1:] != end[:-1])])
    return np.stack([diagonal[new], start[new], end[np.r_[new[1:] - 1, len(end) - 1]]], axis=1)


def exact_matches(rows: DataFrame, keys: list[str], a: str, b: str, k: int) -> DataFrame:
    """Maximal exact matches of at least ``k`` bases between two sequences of one row: ``a0``, ``b0``
    (places from 0) and ``size``."""

    @F.pandas_udf("array<struct<a0: int, b0: int, size: long>>")
    def find(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([[{"a0": p, "b0": q, "size": n} for p, q, n in match_islands(x, y, k).tolist()] for x, y in zip(left, right)])

    return rows.select(*keys, F.explode(find(a, b)).alias("x")).select(*keys, "x.*")


def best_border_match(matches: DataFrame, keys: list[str], side: str) -> DataFrame:
    """The longest match of each row; of equals, on the left the one whose end in ``b`` lies furthest
    right, on the right the one whose start lies furthest left."""
    near = F.col("b0") + F.col("size") - 1 if side == "left" else -F.col("b0")
    best = matches.groupBy(*keys).agg(F.max(F.struct("size", near.alias("near"), (-F.col("a0")).alias("a"), "b0")).alias("x"))
    return best.select(*keys, (-F.col("x.a")).alias("a0"), F.col("x.b0").alias("b0"), F.col("x.size").alias("size"))


def nearest_anchors(rows: DataFrame, keys: list[str], a: str, b: str, k: int = 25) -> DataFrame:
    """Last (``left``) and first (``right``) place in ``b`` of a k-mer that ``a`` has too; null without any."""

    @F.pandas_udf("left int, right int")
    def find(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(left, right):
            at, code = kmer_codes(y, k)
            hit = at[np.isin(code, kmer_codes(x, k)[1])]
            out.append((int(hit[-1]), int(hit[0])) if len(hit) else (None, None))
        return pd.DataFrame(out, columns=["left", "right"]).astype("Int32")

    return rows.select(*keys, find(a, b).alias("x")).select(*keys, "x.*")


def map_reads(reads: DataFrame, contigs: DataFrame, read_key: list[str], seq: str = "seq", contig: str = "chrom", k: int = 15, stride: int = 1, least_seeds: int = 2, within: tuple[str, ...] = ()) -> DataFrame:
    """Places of reads on contigs by seed votes: ``chrom, pos`` (from 1), ``strand``, ``seeds``, ``mapq``.

    k-mers of a read and of its reverse complement join the contigs' k-mers, at all of their places;
    these seeds vote for (contig, strand, diagonal), and the diagonal of most seeds is the place: an
    ungapped mapping. With ``stride``, only every so manieth k-mer of a read is a seed. A place needs
    ``least_seeds`` seeds, or all seeds of a read that has fewer. ``mapq`` falls from 60 to 0 as the
    second-best place nears the best. Columns of ``within`` (part of the read's key, and in ``contigs``) must be equal.

    Contigs keep only k-mers that reads have before anything is shuffled by k-mer. A k-mer at more than
    ``HOT_PLACES`` places is joined in ``SALTS`` parts; votes are added up before their shuffle.
    """
    both = reads.select(*read_key, F.col(seq).alias("s"), F.lit("+").alias("strand")).unionByName(reads.select(*read_key, revcomp(F.col(seq)).alias("s"), F.lit("-").alias("strand")))
    seeds = cut_lineage(kmer_positions(both, [*read_key, "strand"], "s", k).filter(F.col("i") % stride == 0))
    same = [*within, "kmer"]
    index = kmer_positions(contigs, [*within, contig], seq, k).withColumnRenamed("i", "at")
    index = cut_lineage(index.join(seeds.select(*same).distinct(), same, "left_semi"))
    hot = index.groupBy(*same).count().filter(F.col("count") > HOT_PLACES).select(*same, F.lit(True).alias("hot"))
    is_hot = F.coalesce("hot", F.lit(False))
    part = F.when(is_hot, F.pmod(F.xxhash64(contig, "at"), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    index = index.join(hot, same, "left").withColumn("salt", part).drop("hot")
    dealt = seeds.join(hot, same, "left").withColumn("salt", F.explode(every)).drop("hot")
    votes = dealt.join(index, [*same, "salt"]).groupBy(*read_key, contig, "strand", (F.col("at") - F.col("i") + 1).alias("pos")).agg(F.count("*").alias("seeds"))
    order = Window.partitionBy(*read_key).orderBy(F.desc("seeds"), contig, "pos", "strand")
    two = votes.withColumn("n", F.row_number().over(order)).filter("n <= 2")
    first = F.min(F.when(F.col("n") == 1, F.struct(contig, "pos", "strand", "seeds"))).alias("x")
    best = two.groupBy(*read_key).agg(first, F.coalesce(F.max(F.when(F.col("n") == 2, F.col("seeds"))), F.lit(0)).alias("second"))
    sizes = seeds.groupBy(*read_key, "strand").count().groupBy(*[F.col(c).alias(f"_{c}") for c in read_key]).agg(F.max("count").alias("n"))
    best = best.join(sizes, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in read_key]).filter(F.col("x.seeds") >= F.least(F.lit(least_seeds), F.col("n")))
    return best.select(*read_key, "x.*", (60 * (1 - F.col("second") / F.col("x.seeds"))).cast("int").alias("mapq"))


def coordinate_order(rows: DataFrame, place: list[str | Column]) -> DataFrame:
    """Rows with ``nth``, their number (from 0) in the order of ``place``: alignments by contig and position.

    Rows are dealt by ranges of ``place`` and sorted there; the ranges' counts, one row each, give where
    every range begins.
    """
    columns = rows.columns
    keys = [F.col(p) if isinstance(p, str) else p for p in place]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    here = F.monotonically_increasing_id()
    dealt = cut_lineage(dealt.withColumns({"_part": F.shiftrightunsigned(here, 33).cast("int"), "_in": here.bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return dealt.join(F.broadcast(before), "_part").select(*columns, (F.col("_before") + F.col("_in")).alias("nth"))


def bases_on_reference(mapped: DataFrame, reads: DataFrame, contigs: DataFrame, read_key: list[str], contig: str = "chrom") -> DataFrame:
    """Each mapped read base at its reference position, with its pileup bucket and quality.

    Contigs are cut into tiles and reads at tiles' borders, so both meet by (contig, tile) and no contig
    is exploded or repeated for its reads.
    """
    back = F.col("strand") == "-"
    placed = mapped.join(reads, read_key).select(contig, "pos", "strand", F.when(back, revcomp(F.col("seq"))).otherwise(F.col("seq")).alias("s"), F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("q"))
    last = F.col("pos") + F.length("s") - 1
    spans = F.filter(F.sequence(F.floor((F.col("pos") - 1) / TILE), F.floor((last - 1) / TILE)), lambda t: t >= 0)
    cut = placed.filter(F.length("s") > 0).select("*", F.explode(spans).alias("tile"))
    tiles = contigs.select(contig, F.posexplode(F.regexp_extract_all(F.upper("seq"), F.lit(f"(?s).{{1,{TILE}}}"), F.lit(0))).alias("tile", "letters")).withColumn("tile", F.col("tile").cast("long"))
    first = (F.col("tile") * TILE + 1).cast("int")
    begin, end = F.greatest(F.col("pos"), first), F.least(last, first + (TILE - 1))
    piece = lambda text, start: F.split(F.substr(F.col(text), start, end - begin + 1), "")
    cells = cut.join(tiles, [contig, "tile"]).select(contig, "strand", begin.alias("begin"), F.posexplode(F.arrays_zip(piece("s", begin - F.col("pos") + 1).alias("b"), piece("q", begin - F.col("pos") + 1).alias("q"), piece("letters", begin - first + 1).alias("ref"))).alias("i", "x"))
    cells = cells.select(contig, "strand", (F.col("begin") + F.col("i")).alias("pos"), "x.ref", F.upper("x.b").alias("b"), (F.ascii("x.q") - 33).alias("quality")).filter("ref <> ''")
    bucket = F.when(F.col("b") == F.col("ref"), F.when(F.col("strand") == "+", ".").otherwise(",")).otherwise(F.col("b"))
    return cells.select(contig, "pos", "ref", bucket.alias("bucket"), "quality")
