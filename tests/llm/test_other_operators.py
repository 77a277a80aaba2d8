"""URL rules, shards, embeddings, components, the pipeline and the registered queries."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from thylakoid.llm import queries
from thylakoid.llm.components import connected_components
from thylakoid.llm.embedding_dedup import near_vectors, tables_for
from thylakoid.llm.sharding import assign_groups, difference, shard_documents
from thylakoid.llm.url_filter import BlockedBloom, judge_urls, rule_table

sys.path.insert(0, str(Path(__file__).parent))
SMALL = "/root/testdata/sf0.001"


# --- URLs ------------------------------------------------------------------------------------


def judge_by_hand(url, rules, default):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def test_urls(spark):
    rules = [*queries.URL_RULES, ("block", "a.b", "/x"), ("allow", "b", "/x/y"), ("block", "com", "/spam")]
    urls = ["http://Example.COM/en/1", "https://www.example.com/en/x?q#f", "https://a.www.example.com/en/", "ftp://x.net/es/", "x.net/es/", "http://net/fr/", "http://x.net/fr", None, "", "://", "http://?://x.com/", "http://a.b/x/y/z", "http://c.a.b/xq", "http://com/spam", "http://notcom/", "a://b://c.com/", "http://x.com", "http://x.com?/en/", "http://x.com#/", "http://" + "sub." * 500 + "net/es/" + "p" * 9000, "http://é.com/é", "http://x.net/es/\n"]
    rows = [*enumerate(urls), (0, urls[0]), (None, urls[1])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("verdict", F.lit(1))
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rule_table(spark, rules)).collect()), key=str)
    assert got == sorted([(i, *judge_by_hand(u, rules, "allow")) for i, u in rows], key=str)
    assert judge_urls(pages.limit(0), rule_table(spark, rules)).count() == 0
    assert {r.verdict for r in judge_urls(pages, rule_table(spark, rules).limit(0), "block").collect()} == {"block"}


def test_bloom_holds_what_it_was_built_from(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bloom = BlockedBloom.build(keys, "h", 5000)
    held = np.array([r.h for r in keys.collect()])
    assert bloom.might_hold(held).all()
    other = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    assert bloom.might_hold(other).mean() < 0.02


# --- shards ----------------------------------------------------------------------------------


def test_differencing():
    rng = np.random.default_rng(2)
    loads = np.zeros((400, 7), np.int64)
    loads[:, 0] = rng.integers(1, 10_000, 400)
    place = difference(loads)[:, 0]
    sums = np.bincount(place, loads[:, 0], 7)
    assert sums.sum() == loads.sum() and sums.max() - sums.min() <= 5
    parts = rng.integers(0, 100, (50, 4))
    place = difference(parts)
    assert (np.sort(place, axis=1) == np.arange(4)).all()
    assert difference(np.array([[5, 0]])).tolist() == [[0, 1]]


def test_cells_and_levels_agree(spark):
    sizes = spark.range(3000).select(F.xxhash64("id").alias("g1"), F.col("id").alias("g2"), (F.pmod(F.xxhash64("id"), F.lit(500)) + 1).alias("size"))
    shards = assign_groups(sizes, 5, cell_groups=100, fan_in=4)
    loads = [r[0] for r in sizes.join(shards, ["g1", "g2"]).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert shards.count() == 3000 and len(loads) == 5 and max(loads) - min(loads) <= 30


def test_shards(spark):
    rows = [(i, "é" * (i % 37)) for i in range(300)] + [(400, None), (401, None), (402, ""), (5, "x"), (5, "x"), (None, "y"), (403, "z" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("clash")).withColumn("shard", F.lit(9))
    out = shard_documents(docs, 4, slot_rows=10).toPandas()
    assert len(out) == len(rows) and set(out.law) == {"bytes"} and out.grown_shard.isna().all()
    for shard, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part))) and 0 <= shard < 4
    assert out[out.doc_id == 400]["size"].tolist() == [1] and out[out.doc_id == 400].text_crc32.tolist() == [0]
    assert out[out.doc_id < 300].groupby("text_crc32").shard.nunique().max() == 1
    assert shard_documents(docs.limit(0), 4).count() == 0


# --- vectors ---------------------------------------------------------------------------------


def vectors_by_hand(rows, threshold):
    n, out = len(rows), []
    units = []
    for i, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        a = np.array(v, float) if ok else None
        units.append(a / np.linalg.norm(a) if ok else None)
    link = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in range(n)]
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root = min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(link[i]), root, root == rows[i][0]))
    return sorted(out)


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_vectors(spark, block_rows):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for _ in range(12):
        centre = rng.standard_normal(16)
        for _ in range(8):
            rows.append((n, (centre + rng.standard_normal(16) * 0.25).tolist(), int(rng.integers(0, 2))))
            n += 1
    rows += [(500, rows[0][1], rows[0][2]), (501, rows[0][1], rows[0][2]), (502, None, 1), (503, [], 1), (504, [0.0] * 16, 1), (505, [float("nan")] * 16, 1), (506, rows[1][1], None), (507, [1.0, None], 1), (508, [float("inf")] * 16, 1), (509, [1.0, 2.0], 1), (510, [2.0, 4.0], 1)]
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None, label) for i, v, label in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("clash")).withColumn("n_links", F.lit(0))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(table, miss=1e-9, block_rows=block_rows).collect())
    assert got == vectors_by_hand(rows, 0.93)
    assert near_vectors(table.limit(0)).count() == 0
    again = near_vectors(table.unionByName(table.filter("vec_id = 500")), miss=1e-9).filter("vec_id = 500").collect()
    assert len(again) == 2 and again[0].n_links == dict((g[0], g[1]) for g in got)[500]


def test_tables_keep_the_stated_miss():
    bits, tables = tables_for(100_000, 0.93, 1e-4)
    agree = (1 - np.arccos(0.93) / np.pi) ** bits
    assert (1 - agree) ** tables <= 1e-4


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(25)] + [(7, 7), (None, 3)]
    got = {r.v: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in pairs:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {v: find(v) for v in parent if find(v) != v}


# --- queries and pipeline --------------------------------------------------------------------


def test_every_operator_has_its_query():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece"]


ODD = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """The smallest table with nulls, repeated rows and ids, long texts and columns of clashing names."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    some = docs.orderBy("doc_id").limit(3).collect()
    extra = [(10_001, "12 !", "en", "s", 4), (10_002, None, None, None, None), (None, some[0].text, None, "s", 1), (10_003, some[1].text, "en", "s", 1), (10_003, some[1].text, "en", "s", 1), (10_003, some[2].text + " " + "different words here " * 3000, "en", "s", 1), (10_004, "", "en", "s", 0)]
    extra.append((10_003, " ".join(f"{w}{i}" for i, w in enumerate(["einer", "wort", "satz"] * 90)), "de", "s", 1))
    return docs.unionByName(spark.createDataFrame(extra, ODD)).withColumn("row", F.lit("extra")).withColumn("kept", F.lit(1)).withColumn("tag", F.lit("t")).cache()


def as_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_language_stage(spark, odd_docs):
    out = corpus_pipeline.language_id(spark, odd_docs, SMALL)
    assert out.columns == odd_docs.columns
    kept, every = as_rows(out), as_rows(odd_docs)
    gone = list(every)
    for r in kept:
        gone.remove(r)
    assert all(not any(c.isalpha() for c in r[1] or "") for r in gone if r[0] in (10_001, 10_002, 10_004)) and {10_001, 10_002, 10_004} <= {r[0] for r in gone}
    assert len(gone) <= 3 + 0.02 * len(every) and sum(r[0] is None for r in kept) == 1


def test_line_stage(spark, odd_docs):
    from test_text_operators import lines_by_hand

    out = corpus_pipeline.line_dedup(spark, odd_docs, SMALL)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    want = lines_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()], 5)
    got = sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str)
    assert got == sorted(((d, kept) for d, _, _, kept in want), key=str)
    assert any(n for _, _, n, _ in want)
    changed = {r.doc_id: r for r in out.collect()}
    assert all(changed[d].n_chars == len(kept) for d, _, n, kept in want if n and d is not None)


def test_simhash_stage(spark, odd_docs):
    out = corpus_pipeline.simhash_dedup(spark, odd_docs, SMALL)
    assert out.columns == odd_docs.columns
    shingles = {}
    for r in odd_docs.collect():
        w = (r.text or "").encode().lower().split()
        shingles[(r.doc_id, r.text)] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else None
    kept = as_rows(out)
    left = {(r[0], r[1]) for r in kept}
    order = lambda k: (k[0] is None, k[0] or 0)
    alike = lambda x, y: len(x & y) / len(x | y)
    missed = near = 0
    for key, mine in shingles.items():
        others = [k for k, x in shingles.items() if k != key and x and mine and alike(mine, x) >= 0.8]
        if mine is None or not others:  # clean and blank rows stay
            assert key in left, key
        missed += key in left and any(order(k) < order(key) for k in others)
        near += any(order(k) < order(key) for k in others)
    assert missed <= 0.1 * near and near > 10
    assert len(kept) - len(left) <= 2 and sum(r[0] == 10_003 for r in kept) == 1


def test_decontamination_stage(spark, odd_docs):
    from test_text_operators import hits_by_hand

    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    out = corpus_pipeline.decontamination(spark, odd_docs, SMALL)
    assert out.columns == odd_docs.columns
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    judged = hits_by_hand(rows, [(r.item_id, r.text) for r in bench.collect()])
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((x[0] for x in judged if not x[4]), key=str)
    assert any(x[4] for x in judged)


def test_sentencepiece_stage(spark, odd_docs):
    import hashlib

    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = corpus_pipeline.sentencepiece(spark, odd_docs, SMALL)
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in out.collect()), key=str) == sorted(want, key=str)
    assert all(hashlib.sha256(bytes(r.ids)).hexdigest() == r.ids_sha256 for r in out.collect())


def test_stages_take_empty_tables(spark, odd_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.limit(0), SMALL).count() == 0


def test_the_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:  # as the stages give it one by one
        docs = stage(spark, docs, SMALL)
    assert as_rows(out.drop("ids")) == as_rows(docs.drop("ids"))
    assert 0.5 * 200 < out.count() <= 200


def test_vectors_at_the_registered_parameters(spark):
    rng = np.random.default_rng(4)
    centres = [rng.standard_normal(64) for _ in range(60)]
    rows = [(i, [float(np.float32(x)) for x in centres[i % 60] + rng.standard_normal(64) * 0.27], i % 2) for i in range(360)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(table).collect())
    want = vectors_by_hand(rows, 0.93)
    found, there = sum(x[1] for x in got), sum(x[1] for x in want)
    assert [x[0] for x in got] == [x[0] for x in want] and there * 0.995 <= found <= there and there > 100


def test_a_hub_is_joined_in_parts(spark):
    links = spark.range(1, 5000).selectExpr("0L as a", "id as b").unionByName(spark.range(1, 3000).selectExpr("10000L as a", "id as b"))
    got = connected_components(links).groupBy("root").count().collect()
    assert [(r.root, r["count"]) for r in got] == [(0, 5000)]
