"""SimHash near-dedup by pigeonhole blocks (operator 6)."""

from __future__ import annotations

import math
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import carried, map_texts, materialize, remove_folder, scratch_folder
from thylakoid.llm.components import connected_components

SHINGLE, MOST_BITS, SEED = 4, 4, 42
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16
#: Rows of a bucket that a task compares at a time; larger buckets are cut into blocks and dealt in pairs
#: of them. Which buckets are, is told by one in so many fingerprints.
BLOCK_ROWS, TOLD_BY = 4096, 64
#: For texts that are alike: words a shingle, fingerprint bits that may differ, the similarity and the
#: probability (at most) with which an average pair of that similarity meets in no bucket, unrelated ones in a bucket.
ALIKE_SHINGLE, ALIKE_BITS, SIMILARITY, MISS, BUCKET_ROWS = 5, 28, 0.8, 0.03, 8
#: Texts of one group whose shingles a task compares at a time.
ALIKE_ROWS = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: One byte's bits, each in a byte of its own.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view("<u8").ravel()


def _shingles(text: str | None, size: int):
    """Slices of a text's words, lower-cased and joined by spaces, that are its shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return b"", [], []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - size + 1)
    return joined, starts[:n], ends[min(size, len(words)) - 1 :]


def _majority(hashes: list[np.ndarray]) -> np.ndarray:
    """The bits that are set in over half of all hashes (rows of bytes, in blocks), as numbers of 64 bits."""
    counts = np.zeros(8 * hashes[0].shape[1], np.int64)
    for block in hashes:
        sums = np.add.reduceat(_SPREAD[block], np.arange(0, len(block), 255), axis=0)  # a byte counts to 255
        counts += sums.view(np.uint8).reshape(-1, len(counts)).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > sum(map(len, hashes)), bitorder="little").view("<u8")


def _cuts(pieces):
    """A text's shingles as byte strings, some at a time."""
    joined, starts, ends = pieces
    for i in range(0, len(starts), BLOCK):
        yield map(joined.__getitem__, map(slice, starts[i : i + BLOCK].tolist(), ends[i : i + BLOCK].tolist()))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text's word shingles: a bit is set if it is in over half their XXH64."""
    from xxhash import xxh64_intdigest

    pieces = _shingles(text, size)
    if not len(pieces[1]):
        return 0
    counted = [np.fromiter(map(xxh64_intdigest, cut, repeat(SEED)), np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8) for cut in _cuts(pieces)]
    return int(_majority(counted)[0])


def shingle_set(text: str | None, size: int = ALIKE_SHINGLE) -> np.ndarray:
    """XXH3 hashes (rows of two numbers) of a whole text's different word shingles, sorted by the first."""
    from xxhash import xxh3_128_digest

    pieces = _shingles(text, size)
    if not len(pieces[1]):
        return np.zeros((0, 2), np.uint64)
    hashes = np.frombuffer(b"".join(b"".join(map(xxh3_128_digest, cut)) for cut in _cuts(pieces)), "<u8").reshape(-1, 2)
    return hashes[np.unique(hashes[:, 0], return_index=True)[1]]


def wide_fingerprint(text: str | None, size: int = ALIKE_SHINGLE) -> np.ndarray:
    """128-bit SimHash of a whole text's different word shingles, as two numbers; zero without words."""
    return _wide(shingle_set(text, size))


def _wide(hashes: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.zeros(2, np.uint64)
    return _majority([hashes[i : i + BLOCK].view(np.uint8) for i in range(0, len(hashes), BLOCK)])


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``fp`` (a signed long with the fingerprint's bits) for every row."""
    kind = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
        return {"doc": batch.column(0), "fp": pa.array(found.view(np.int64))}

    return map_texts(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), run, {"doc": kind, "fp": "long"})


def block_masks(n: int, most_bits: int = MOST_BITS) -> list[int]:
    """Masks such that fingerprints within ``most_bits`` agree under one of them at least.

    The 64 bits are cut into ``most_bits + r`` blocks, of which differing bits can touch ``most_bits``;
    the masks are all choices of ``r`` blocks. ``r`` grows with the number of fingerprints, so that
    unrelated ones seldom share a key: every choice finds all close pairs.
    """
    for r in range(1, 7):
        blocks = most_bits + r
        if n <= 2 ** (64 * r // blocks - 2) or r == 6:
            break
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(blocks)]
    return [sum(x) for x in combinations(block, r)]


def sampled_masks(n: int, similarity: float = SIMILARITY, miss: float = MISS, seed: int = SEED) -> list[tuple[int, int]]:
    """Masks of random bits of 128 such that a pair that differs in as many bits as texts of that similarity
    do on average agrees under none with probability ``miss`` at most, and an unrelated pair under one as
    seldom as ``n`` fingerprints need."""
    bits = max(8, min(48, math.ceil(math.log2(max(n, 1) / BUCKET_ROWS)) if n > BUCKET_ROWS else 8))
    differ = round(128 * math.acos(2 * similarity / (1 + similarity)) / math.pi)
    agree = math.comb(128 - differ, bits) / math.comb(128, bits)
    tables = math.ceil(math.log(miss) / math.log(1 - agree))
    rng = np.random.default_rng(seed)
    masks = []
    for _ in range(tables):
        chosen = sum(1 << int(b) for b in rng.choice(128, bits, replace=False))
        masks.append((chosen & (1 << 64) - 1, chosen >> 64))
    return masks


def _links(fp: np.ndarray, rep: np.ndarray, most_bits: int) -> tuple[list, list]:
    """Links that connect what lies within ``most_bits`` in one bucket of distinct fingerprints (rows of words).

    Each is compared only with those that no link has reached yet: a bucket full of close copies is
    used up after a few comparisons with all, and links are fewer than its members.
    """
    a, b = [], []
    open_ = np.arange(len(fp))
    while len(open_) > 1:
        front, open_ = [open_[0]], open_[1:]
        while front and len(open_):
            seed = front.pop()
            near = np.bitwise_count(fp[open_] ^ fp[seed]).sum(axis=1) <= most_bits
            found = open_[near]
            if len(found):
                a.append(np.full(len(found), rep[seed]))
                b.append(rep[found])
                front += found.tolist()
                open_ = open_[~near]
    return a, b


def _bucket_links(most_bits: int, words: int):
    """Over rows (key, rep, fingerprint's words) that come sorted by the first; a bucket's rows may span batches."""

    def run(batches):
        held = None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2 + words)]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            edge = np.flatnonzero(rows[0][1:] != rows[0][:-1]) + 1
            last = int(edge[-1]) if len(edge) else 0
            held = [x[last:] for x in rows]
            if last:
                yield from emit([x[:last] for x in rows], np.r_[0, edge[:-1]])
        if held is not None and len(held[0]):
            yield from emit(held, np.array([0]))

    def emit(rows, first):
        rep, fp = rows[1], np.stack(rows[2:], axis=1).view(np.uint64)
        size = np.diff(np.r_[first, len(fp)])
        two = first[size == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]).sum(axis=1) <= most_bits]
        a, b = [rep[near]], [rep[near + 1]]
        for start, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            more = _links(fp[start : start + n], rep[start : start + n], most_bits)
            a, b = a + more[0], b + more[1]
        yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def bucket_links(keyed: DataFrame, most_bits: int, fp: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``a, b`` that connect rows (``key, rep`` and fingerprint words ``fp``) of one key within ``most_bits``.

    Buckets of about more than ``block_rows`` are cut into blocks by a hash of ``rep``, and each pair of
    blocks is a group of its own, so no task holds more than two blocks. Their size is estimated from
    one in ``TOLD_BY`` vertices; a wrong estimate makes a group larger, never a link less.
    """
    told = keyed.filter(F.pmod(F.xxhash64(F.lit("told"), "rep"), F.lit(TOLD_BY)) == 0).groupBy("key").count()
    large = told.filter(F.col("count") * TOLD_BY > block_rows).select("key", F.ceil(F.col("count") * TOLD_BY / block_rows).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = keyed.join(large, "key", "left").select("key", "rep", *fp, blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # a bucket's pair of blocks is a group; groups that share a hash are compared as one
    group = F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))
    lean = dealt.select(group.alias("key"), "rep", *fp)
    return lean.repartition("key").sortWithinPartitions("key", *fp).mapInArrow(_bucket_links(most_bits, len(fp)), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most_bits: int = MOST_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose SimHash fingerprints are linked at ``most_bits`` differing bits or fewer.

    Texts are lower-cased (A-Z) and cut at ASCII white space; shingles are ``size`` words, repeats
    included (a shorter text is one shingle). A null, empty or blank text has fingerprint zero, which
    links like any other. Ids must be whole numbers.

    Returns one row per document row: the id column, ``fingerprint`` (16 hex digits), ``component_id``
    (the smallest id reachable over links, the own one included). Rows that repeat an id each get their
    own fingerprint's component. Rows with a null id get a component if a document with an id shares
    their fingerprint, else null; they link nothing. Other columns aren't read.

    Equal fingerprints are one vertex, so exact copies cost one row after a combined aggregation. Every
    close pair shares a block key; a key's distinct fingerprints are compared where they lie sorted, large
    buckets in pairs of blocks.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    rows = materialize(fingerprints(docs, size, id_col, text_col), folder)
    distinct = materialize(rows.filter("doc is not null").groupBy("fp").agg(F.min("doc").cast("long").alias("rep")), folder)
    masks = block_masks(distinct.count(), most_bits)
    keyed = distinct.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("block", "bits"), "fp", "rep")
    links = bucket_links(keyed.select(F.xxhash64("block", "bits").alias("key"), "rep", "fp"), most_bits, ["fp"])
    roots = connected_components(links, folder)
    known = distinct.join(roots, distinct["rep"] == roots["v"], "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return rows.join(known, "fp", "left").select(
        F.col("doc").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _under_masks(masks: list[tuple[int, int]]):
    """Rows (rep, f1, f2) once for each mask, with a hash of the mask's number and the bits that it leaves."""

    def run(batches):
        for batch in batches:
            rep, f1, f2 = (batch.column(i) for i in range(3))
            x, y = (f.to_numpy(zero_copy_only=False).view(np.uint64) for f in (f1, f2))
            for i, (a, b) in enumerate(masks):
                key = (x & np.uint64(a)) * _MIX ^ (y & np.uint64(b)) + np.uint64(i)
                for _ in range(2):
                    key = (key ^ (key >> np.uint64(31))) * _MIX
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), rep, f1, f2], names=["key", "rep", "f1", "f2"])

    return run


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of different numbers."""
    if not len(a) or not len(b) or min(len(a), len(b)) < 0.01 * max(len(a), len(b)):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int(np.count_nonzero(b[at] == a))
    return shared / (len(a) + len(b) - shared)


def _as_set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def _like_centre(similarity: float):
    """Whether each text is alike the centre of its group."""

    def run(batches):
        for batch in batches:
            mine, other = (batch.column(n).to_pylist() for n in ("shingles", "centre"))
            alike = [_similarity(_as_set(x), _as_set(y)) >= similarity for x, y in zip(mine, other)]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("comp"), pa.array(alike, pa.bool_())], names=["rep", "comp", "alike"])

    return run


def _verified(similarity: float, most_bits: int):
    """Over rows that come sorted by cell, those still open first: links of open texts with any text of their group that is
    alike, as far as they join what nothing has joined yet."""

    def run(batches):
        cell, open_, prints, root = None, [], None, {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            found = []
            columns = [batch.column(n).to_pylist() for n in ("comp", "up", "along", "kind", "rep", "f1", "f2", "shingles", "group")]
            for comp, up, along, kind, rep, f1, f2, shingles, group in zip(*columns):
                if (comp, up, along) != cell:
                    cell, open_, root = (comp, up, along), [], {}
                mine = rep if group is None else group  # texts that are alike their centre are one
                print_ = np.array([f1, f2], np.int64).view(np.uint64)
                if kind == 0:
                    open_.append((rep, print_, _as_set(shingles)))
                    prints = None
                    continue
                if not open_:
                    continue
                prints = np.stack([o[1] for o in open_]) if prints is None else prints
                near = np.flatnonzero(np.bitwise_count(prints ^ print_).sum(axis=1) <= most_bits)
                here = _as_set(shingles) if len(near) else None
                for i in near.tolist():
                    other = open_[i]
                    if find(other[0]) != find(mine) and _similarity(other[2], here) >= similarity:
                        root[find(other[0])] = find(mine)
                        found.append((other[0], rep))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def verified_links(texts: DataFrame, similarity: float, most_bits: int, folder: str, block_rows: int = ALIKE_ROWS) -> DataFrame:
    """Links ``a, b`` between texts (``rep, comp, size, f1, f2, centre_rep, shingles``) of one group (``comp``, of ``size`` texts) whose
    similarity reaches the bound; they connect all that is connected.

    Every text is first compared with its group's centre, dealt in parts of large groups. Those that aren't alike it meet all
    texts of the group, both cut into blocks; so a large group of copies costs one comparison each, and no task holds more than two blocks.
    """
    parts = F.ceil(F.col("size") / block_rows).cast("int")
    centres = texts.filter("rep = centre_rep").select("comp", F.col("shingles").alias("centre"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    dealt = texts.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
    judged = materialize(dealt.join(centres, ["comp", "part"]).select("rep", "comp", "shingles", "centre").mapInArrow(_like_centre(similarity), "rep long, comp long, alike boolean"), folder)
    star = texts.filter("rep <> centre_rep").select("rep", "centre_rep").join(judged.filter("alike"), "rep").select(F.col("rep").alias("a"), F.col("centre_rep").alias("b"))
    left = judged.filter("not alike").groupBy("comp").agg(F.count("*").alias("open"))
    rest = materialize(texts.join(judged.select("rep", "alike"), "rep").join(left, "comp"), folder)
    tall, wide = F.ceil(F.col("open") / block_rows).cast("int"), parts
    block = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "rep"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    group = F.when(F.col("alike"), F.col("centre_rep")).alias("group")
    common = ["comp", "rep", "f1", "f2", "shingles", group]
    open_ = rest.filter("not alike").select(*common, F.lit(0).alias("kind"), block("up", tall).alias("up"), every(wide).alias("along"))
    against = rest.select(*common, F.lit(1).alias("kind"), block("along", wide).alias("along"), every(tall).alias("up"))
    cells = open_.unionByName(against)
    order = ["comp", "up", "along", "kind"]
    more = cells.repartition("comp", "up", "along").sortWithinPartitions(*order).mapInArrow(_verified(similarity, most_bits), "a long, b long")
    return star.unionByName(more)


def drop_alike(docs: DataFrame, size: int = ALIKE_SHINGLE, similarity: float = SIMILARITY, most_bits: int = ALIKE_BITS, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows without those that are near copies of another: of each group one row stays, that of the
    smallest id, of equal ids one of the smallest fingerprint; null ids come last.

    Texts are near copies when the similarity (Jaccard) of their sets of ``size``-word shingles is ``similarity`` or more; groups are what such links
    connect. Candidates come from 128-bit fingerprints of the sets: those that differ in ``most_bits`` bits or fewer (at
    a similarity of 0.8, 19 differ on average). So many bits leave no blocks that every close pair must share; rows meet under masks of
    random bits instead, and a pair that differs in 19 bits under none with probability ``miss``. Every link is then verified on the whole sets.

    All columns stay as they are; they must be of kinds that Spark can order. It is decided row by row: of rows that repeat an id with different
    texts each is judged by its own, of repeated rows, and of rows of one id with equal sets, the least stays. Rows without a word (null, empty or
    blank texts) are near copies of nothing and all stay. Ids must be whole numbers.
    """
    spark = docs.sparkSession
    folder, work = scratch_folder(spark), scratch_folder(spark)
    prints = ["f1", "f2", "s1", "s2"]

    def run(batch: pa.RecordBatch) -> dict:
        from xxhash import xxh3_128_digest

        found = []
        for text in batch.column(1).to_pylist():
            hashes = shingle_set(text, size)
            digest = np.frombuffer(xxh3_128_digest(hashes[:, 0].tobytes()), "<u8") if len(hashes) else np.zeros(2, np.uint64)
            found.append(np.concatenate([_wide(hashes), digest]))
        all_ = np.array(found, np.uint64).reshape(-1, 4).view(np.int64)
        return {"doc": batch.column(0), "row": batch.column(2)} | {n: pa.array(np.ascontiguousarray(all_[:, i])) for i, n in enumerate(prints)}

    def sets(batch: pa.RecordBatch) -> dict:
        made = [np.ascontiguousarray(shingle_set(t, size)[:, 0]).tobytes() for t in batch.column(0).to_pylist()]
        return {n: batch.column(n) for n in kept_columns} | {"shingles": pa.array(made, pa.binary())}

    whole = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), *carried(docs, True))
    rows = materialize(map_texts(whole, run, {"doc": "long", **dict.fromkeys(prints, "long"), "row": dict(whole.dtypes)["row"]}), folder)
    blank = (F.col("s1") == 0) & (F.col("s2") == 0)
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc")).alias("first")
    distinct = materialize(rows.filter(~blank).groupBy(*prints).agg(first).withColumn("rep", F.monotonically_increasing_id()), folder)
    masks = sampled_masks(distinct.count(), similarity, miss)
    keyed = distinct.select("rep", "f1", "f2").mapInArrow(_under_masks(masks), "key long, rep long, f1 long, f2 long")
    roots = materialize(connected_components(bucket_links(keyed, most_bits, ["f1", "f2"]), work), work)

    member = roots.select(F.col("v").alias("rep"), F.col("root").alias("comp")).unionByName(roots.select(F.col("root").alias("rep"), F.col("root").alias("comp")).distinct())
    candidates = materialize(distinct.join(member, "rep"), work)
    groups = candidates.groupBy("comp").agg(F.count("*").alias("size"), F.min(F.struct("first", "f1", "f2", "rep")).alias("x")).select("comp", "size", F.col("x.rep").alias("centre_rep"))
    kept_columns = ["rep", "comp", "size", "centre_rep", "f1", "f2"]
    texts = rows.select("doc", *prints, F.col("row")[text_col].alias("text")).join(candidates, prints).filter(F.col("doc").eqNullSafe(F.col("first.doc")))
    texts = texts.dropDuplicates(["rep"]).join(groups, "comp").select("text", *kept_columns)
    kinds = dict(texts.dtypes)
    texts = materialize(map_texts(texts, sets, {n: kinds[n] for n in kept_columns} | {"shingles": "binary"}, text=0), work)
    final = materialize(connected_components(verified_links(texts, similarity, most_bits, work), work), folder)
    remove_folder(spark, work)

    grouped = distinct.join(final, F.col("rep") == F.col("v"), "left").withColumn("root", F.coalesce("root", "rep"))
    kept = grouped.groupBy("root").agg(F.min(F.struct("first", *prints)).alias("x")).select("x.first", *[f"x.{p}" for p in prints])
    chosen = rows.join(kept, prints).filter(F.col("doc").eqNullSafe(F.col("first.doc")))
    one = chosen.groupBy(*prints).agg(F.min("row").alias("row"))
    return one.select("row").unionByName(rows.filter(blank).select("row")).select("row.*")
