"""Line dedup, decontamination, language ID, SimHash and suffix dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from thylakoid.llm import simhash, suffix_dedup
from thylakoid.llm.common import scratch_folder
from thylakoid.llm.decontamination import contaminated, decontaminate
from thylakoid.llm.language_id import char_models, fit, held_out, identify
from thylakoid.llm.line_dedup import LineRuns, drop_repeated_lines
from thylakoid.llm.simhash import _links, block_masks, drop_alike, fingerprint, near_duplicates, sampled_masks, shingle_set, verified_links, wide_fingerprint
from thylakoid.llm.suffix_dedup import cut_repeated_strings, front_code, front_decode, merge_runs

DOCS = "doc_id long, text string"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def frame(spark, rows, **clash):
    df = spark.createDataFrame(rows, DOCS)
    for name, value in clash.items():
        df = df.withColumn(name, F.lit(value))
    return df


# --- lines -----------------------------------------------------------------------------------


def lines_by_hand(rows, least_docs):
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(k) >= 40 and d is not None:
                held.setdefault(k, set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not ((k := lower(x.strip(" \t\n\x0b\x0c\r"))) in held and len(held[k]) >= least_docs and d is not None and d < max(held[k]))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines(spark):
    hot, other = "A line that very many of these documents hold, é!", "x" * 40
    rows = [(i, f"own {i}\n  {hot}\t\n{other if i % 3 == 0 else ''}") for i in range(20)]
    rows += [(20, hot.upper().replace("É", "é")), (21, None), (22, ""), (None, hot), (3, rows[3][1]), (23, "\n".join([hot] * 3)), (24, "short\nshort"), (25, "y" * 39), (26, "w " * 50_000)]
    rows += [(30 + i, "y" * 39) for i in range(6)] + [(40 + i, "\u00a0" + "z" * 39) for i in range(6)]
    docs = frame(spark, rows, h1="clash", gone=1, n_lines=2)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in drop_repeated_lines(docs).collect()), key=str)
    assert got == lines_by_hand(rows, 5)
    assert drop_repeated_lines(docs.limit(0)).count() == 0
    carried = drop_repeated_lines(docs, carry=True)
    assert carried.select("row.*").columns == docs.columns and carried.count() == len(rows)


def test_runs_are_compacted_and_count_like_one_table(spark):
    runs, rng, seen = LineRuns(spark, fan_in=2), random.Random(1), {}
    for batch in range(5):  # in descending order of ids
        rows = [(1000 - batch * 100 + rng.randrange(20), h, h + 1) for h in rng.choices(range(30), k=40)]
        before = set(seen)
        for d, h, _ in rows:
            seen.setdefault(h, set()).add(d)
        run = runs.add(spark.createDataFrame(rows, "doc long, h1 long, h2 long")).collect()
        assert {r.h1 for r in run} == {h for _, h, _ in rows}
        assert {r.h1 for r in run if r.last_doc is not None} == {h for _, h, _ in rows} - before
    assert len(runs.runs()) == 2  # 5 runs in levels of two: 4 + 1
    counts = {r.h1: (r.n_docs, r.last_doc) for r in runs.counts().collect()}
    assert counts == {h: (len(d), max(d)) for h, d in seen.items()}
    # a batch meets the runs where they lie: only the batch's own rows are exchanged
    asked = runs.looked_up(spark.createDataFrame([(1, 2, 3)], "doc long, h1 long, h2 long"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert len(scans) == 2
    for i in scans:
        level, above = depth(lines[i]), []
        for line in reversed(lines[:i]):
            if depth(line) < level:
                level = depth(line)
                above.append(line)
                if "Join" in line:
                    break
        assert above and not any("Exchange" in line for line in above)
    runs.drop()


def test_many_dropped_lines_in_a_long_text(spark):
    common = [f"line number {i} that all five documents of this test hold" for i in range(3000)]
    rows = [(i, "\n".join(["own"] + common + [f"{i}"])) for i in range(5)] + [(9, "x\n" + common[7] + "\n" + common[7]), (None, common[1])]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in drop_repeated_lines(frame(spark, rows), batches=3).collect()), key=str)
    assert got == lines_by_hand(rows, 5)


# --- decontamination -------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def hits_by_hand(rows, items, window=13):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t or ""))
        if i is not None and w:
            for k in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[k : k + window]), set()).add(str(i))
    out = []
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        out.append((d, len(w), len(hit), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_windows(spark, shard_bytes):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 13, 20])))) for i in range(12)] + [(90, None), (None, "w1"), (91, " .. "), (92, "Été, w1"), (93, "Été, w1")]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(30)]
    rows += [(50, None), (51, ""), (52, items[2][1].upper() + "!! " + "filler " * 30), (None, items[3][1]), (53, "x été  W1 é"), (54, "ÉTÉ w1"), (54, "ÉTÉ w1"), (55, "long " * 40_000 + items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate(frame(spark, rows, items="clash", id=3), bench, shard_bytes=shard_bytes).withColumn("bad", contaminated())
    got = out.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"]), r.bad) for r in got), key=str) == hits_by_hand(rows, items)
    texts = dict(rows)
    for r in got:
        cut = [WORD.findall(lower(texts[r.doc_id][s.start : s.end])) for s in r.text_spans]
        assert sum(map(len, cut)) == r.n_hit
    assert decontaminate(frame(spark, rows).limit(0), bench).count() == 0
    assert decontaminate(frame(spark, rows), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


# --- language --------------------------------------------------------------------------------


def kneser_ney_by_hand(words, symbols, order=5):
    """P(symbol | what comes before in its word), from a language's words and their counts."""
    seen = [{} for _ in range(order + 1)]
    for word, count in words:
        marked = "^" + word + "$"
        for n in range(1, order + 1):
            for end in range(max(n, 2), len(marked) + 1):
                g = marked[end - n : end]
                seen[n][g] = seen[n].get(g, 0) + count
    adjusted = [{} for _ in range(order + 1)]
    for n in range(1, order + 1):
        for g, c in seen[n].items():
            adjusted[n][g] = c if n == order or g[0] == "^" else sum(h[1:] == g for h in seen[n + 1])

    def p(symbol, before):
        before = before[len(before) - min(len(before), order - 1) :]
        lower = 1 / (symbols + 1) if not before else p(symbol, before[1:])
        counts = adjusted[len(before) + 1]
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        d = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
        here = [c for g, c in counts.items() if g[:-1] == before]
        if not here:
            return lower
        return max(counts.get(before + symbol, 0) - d, 0) / sum(here) + d * len(here) / sum(here) * lower

    return p


def test_models_against_brute_force(spark):
    rng = random.Random(31)
    words = {lang: [("".join(rng.choices(alphabet, k=rng.randint(1, 9))), rng.randint(1, 4)) for _ in range(60)] for lang, alphabet in (("x", "abcde"), ("y", "cdeé"))}
    rows = [(lang, w, n) for lang, ws in words.items() for w, n in dict(ws).items()]
    models = char_models(spark.createDataFrame(rows, "lang string, word string, n long"))
    asked = ["abcde", "cdeécdeé", "a", "éa", "zzz", "edcbaedcba", *(w for _, w, _ in rows[:20])]
    got = models.score(asked)
    assert models.langs == ["x", "y"] and got[:, 2].tolist() == [len(w) + 1 for w in asked]
    symbols = len({c for _, w, _ in rows for c in w} | {"$"})
    for k, lang in enumerate(models.langs):
        p = kneser_ney_by_hand([(w, n) for x, w, n in rows if x == lang], symbols)
        for w, total in zip(asked, got[:, k].tolist()):
            marked = "^" + w + "$"
            want = sum(np.log(p(marked[i], marked[:i])) for i in range(1, len(marked)))
            assert abs(total - want) < 1e-3 * len(marked), (lang, w)
        for before in ("^", "^ab", "^cdec", "^dd"):  # all known symbols and the share of unknown ones
            assert abs(sum(p(c, before) for c in "abcdeé$") + p("?", before) - 1) < 1e-9


def next_probabilities(models, before, symbols):
    """P(symbol | a word's first letters) of every language; ``$`` ends the word."""
    upto = lambda w: next_score(models, w)
    return {c: np.exp(upto(before + c) - upto(before)) for c in symbols}


def next_score(models, marked):
    """Log-probability of a word's first symbols: what its whole score has beyond that of its end."""
    from thylakoid.llm.language_id import ORDER

    total = np.zeros(len(models.langs))
    for i in range(1, len(marked)):
        total += one_symbol(models, marked[max(0, i - ORDER + 1) : i + 1])
    return total


def one_symbol(models, gram):
    from thylakoid.llm.language_id import _Grams

    inner = [c for c in gram if c not in "^$"]
    grams = _Grams(["".join(inner)])
    at = 1 + len(inner) if gram[-1] == "$" else len(inner)
    return np.array([of_one(m, grams, at, len(gram)) for m in models.models])


def of_one(models, grams, at, n):
    out = 0
    while n:
        ids, logp = models.tables[n]
        key = grams.keys[n][at]
        row = np.searchsorted(ids, key)
        if row < len(ids) and ids[row] == key:
            return out + logp[row].astype(float)
        ctx, left = models.leaves[n]
        if n == 1:
            return out + models.unknown
        key = grams.keys[n - 1][at - 1]
        row = np.searchsorted(ctx, key)
        if row < len(ctx) and ctx[row] == key:
            out = out + left[row].astype(float)
        n -= 1


def test_models_keep_all_n_grams_and_add_up_to_one(spark):
    rng = random.Random(32)
    words = {(f"l{i:02}", "".join(rng.choices("abcdef", k=rng.randint(2, 9)))) for i in range(30) for _ in range(40)}
    table = spark.createDataFrame([(x, w, 1) for x, w in words], "lang string, word string, n long")
    for models in (char_models(table), char_models(table, fetch_rows=500)):
        for i, lang in enumerate(models.langs):
            for n in range(2, 6):
                own = {("^" + w + "$")[j : j + n] for x, w in words if x == lang for j in range(len(w) + 3 - n)}
                assert len(models.models[i].tables[n][0]) == len(own)
        for before in ("^", "^a", "^ab", "^fffa", "^abcdef"):
            total = sum(next_probabilities(models, before, "abcdef$?").values())
            assert np.allclose(total, 1, atol=1e-4), before


def test_a_language_without_learned_documents_is_learned_from_the_rest(spark):
    rng = random.Random(33)
    make = lambda letters, n: " ".join("".join(rng.choices(letters, k=4)) for _ in range(n))
    rows = [(i, make("abc", 30), "x") for i in range(60)] + [(1000 + i, make("дежз", 30), "y") for i in range(1)]
    for shift in range(8):  # wherever that one document falls
        models = fit(spark.createDataFrame([(i + shift * (i >= 1000), t, lang) for i, t, lang in rows], "doc_id long, text string, lang string"))
        got = identify(frame(spark, [(1, make("дежз", 20)), (2, make("abc", 20))]), models).collect()
        assert {r.doc_id: r.lang_pred for r in got} == {1: "y", 2: "x"}


def test_languages(spark):
    rng = random.Random(5)
    sounds = {"aa": ["ba", "lo", "mi"], "bb": ["ström", "gä", "ck"], "cc": ["ñu", "qui", "xo"]}
    make = lambda lang, n: " ".join("".join(rng.choices(sounds[lang], k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, make(lang, 30), lang) for i in range(240) for lang in [rng.choice("abc") * 2]]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !?", "bb"), (903, make("bb", 40_000), "bb"), (None, make("cc", 9), None), (5, rows[5][1], rows[5][2]), (904, "²³ Ⅷ", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    models = fit(docs.filter(~held_out(F.col("doc_id"))))
    out = identify(docs.drop("lang"), models).collect()
    assert len(out) == len(rows)
    want = {d: lang for d, _, lang in rows}
    for r in out:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902, 904):
            assert r.lang_pred == "und" and r.rejected and r.score == 0
        else:
            assert r.lang_pred == (want[r.doc_id] or "cc") and not r.rejected
    assert identify(docs.limit(0), models).count() == 0
    assert fit(docs.limit(0)) is None
    assert {r.lang_pred for r in identify(docs, None).collect()} == {"und"}


def test_junk_in_the_sample_sets_no_limit(spark):
    rng = random.Random(15)
    sounds = {"aa": ["ba", "lo", "mi", "re", "tu"], "bb": ["ström", "gä", "ck", "ei", "ut"]}
    make = lambda lang, n: " ".join("".join(rng.choices(sounds[lang], k=rng.randint(1, 4))) for _ in range(n))
    junk = lambda n: " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(rng.randint(2, 9))) for _ in range(n))
    rows = [(i, junk(40) if i % 25 == 0 else make(lang, 60), lang) for i in range(900) for lang in [rng.choice("ab") * 2]]
    models = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [(i, make(rng.choice("ab") * 2, n)) for i, n in enumerate([1, 2, 3, 5, 10, 30, 100, 1000] * 40)]
    asked += [(10_000 + i, junk(n)) for i, n in enumerate([20, 60, 500] * 5)]
    got = {r.doc_id: r.rejected for r in identify(frame(spark, asked), models).collect()}
    assert sum(x for i, x in got.items() if i < 10_000) <= 1
    assert all(x for i, x in got.items() if i >= 10_000)


def test_texts_with_letters_stay_if_nothing_was_learned(spark):
    docs = frame(spark, [(1, "some text"), (2, "12 !"), (3, None), (4, "²³ Ⅷ")])
    assert {r.doc_id: r.rejected for r in identify(docs, None).collect()} == {1: False, 2: True, 3: True, 4: True}


# --- SimHash ---------------------------------------------------------------------------------


def fingerprint_by_hand(t):
    from xxhash import xxh64_intdigest

    w = re.findall(r"[^\x20\x09-\x0d]+", lower(t or ""))
    if not w:
        return 0
    h = [xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    rng = random.Random(6)
    for t in [None, "", " \n", "a", "A b", "a b c", "a b c d", "É\u00a0x y\x1cz w", *(" ".join(rng.choices(["ab", "Cd", "é"], k=k)) for k in (4, 5, 300, 1000))]:
        assert fingerprint(t) == fingerprint_by_hand(t), t


@pytest.mark.parametrize("n", [10, 10**6, 10**9])
def test_masks_find_all_close_pairs(n):
    rng, masks = random.Random(n), block_masks(n)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_links_in_a_bucket_connect_all_that_is_close():
    rng = random.Random(8)
    fp = np.array(sorted({sum(1 << b for b in rng.sample(range(14), 7)) for _ in range(200)}), np.uint64)
    a, b = _links(fp[:, None], np.arange(len(fp)), 2)
    near = [(i, j) for i in range(len(fp)) for j in range(i) if bin(int(fp[i] ^ fp[j])).count("1") <= 2]
    links = list(zip(np.concatenate(a).tolist(), np.concatenate(b).tolist()))
    assert roots(len(fp), links) == roots(len(fp), near) and len(links) < len(fp)


@pytest.mark.parametrize("block_rows", [4096, 3])
def test_near_duplicates(spark, monkeypatch, block_rows):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(simhash, "TOLD_BY", 64 if block_rows > 3 else 1)
    monkeypatch.setattr(simhash.bucket_links, "__defaults__", (block_rows,))
    rng = random.Random(7)
    base = [[f"{rng.randrange(9999)}" for _ in range(400)] for _ in range(12)]
    rows, i = [], 100
    for words in base:
        for _ in range(6):
            copy = list(words)
            if rng.random() < 0.8:
                copy[rng.randrange(400)] = "changed"
            rows.append((i, " ".join(copy)))
            i -= 1
    rows += [(500, None), (501, ""), (502, "  \n"), (503, "a"), (503, "a"), (504, "b c"), (None, rows[0][1]), (505, "q " * 60_000)]
    out = near_duplicates(frame(spark, rows, fp="clash", rep=1, component_id=2)).collect()
    assert len(out) == len(rows)
    fps = [(d, fingerprint_by_hand(t)) for d, t in rows]
    known = [x for x in fps if x[0] is not None]
    pairs = [(i, j) for i in range(len(known)) for j in range(i) if bin(known[i][1] ^ known[j][1]).count("1") <= 4]
    root = roots(len(known), pairs)
    least = {}
    for (d, _), r in zip(known, root):
        least[r] = min(least.get(r, d), d)
    want = sorted([(d, f"{f:016x}", least[r]) for (d, f), r in zip(known, root)] + [(None, f"{fps[-2][1]:016x}", next(least[r] for (d, f), r in zip(known, root) if f == fps[-2][1]))], key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=str) == want
    assert near_duplicates(frame(spark, rows).limit(0)).count() == 0


def edited(rng, words, similarity, size=5):
    """A copy of which single words are replaced until so much of the shingles is shared."""
    shingles = lambda w: {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    out, own, n = list(words), shingles(words), 0
    while len(own & shingles(out)) / len(own | shingles(out)) > similarity:
        before, n = list(out), n + 1
        out[rng.randrange(len(out))] = f"new{n}"
    return before


def test_alike_texts_are_dropped(spark):
    rng = random.Random(41)
    text = lambda: [f"{rng.randrange(5000)}" for _ in range(rng.randint(150, 600))]
    rows, near = [], {}
    for i in range(100):
        words = text()
        rows.append((i, " ".join(words)))
        for k, similarity in enumerate((0.8, 0.85, 0.9, 0.95)):
            near[1000 + 4 * i + k] = similarity
            rows.append((1000 + 4 * i + k, " ".join(edited(rng, words, similarity))))
    clean = [(5000 + i, " ".join(text())) for i in range(300)]
    got = {r.doc_id for r in drop_alike(frame(spark, rows + clean)).collect()}
    assert got >= set(range(100)) | {d for d, _ in clean}
    missed = {s: sum(d in got for d, x in near.items() if x == s) for s in (0.8, 0.85, 0.9, 0.95)}
    assert missed[0.8] <= 10 and missed[0.85] <= 2 and missed[0.9] <= 1 and missed[0.95] == 0, missed


def test_texts_below_the_similarity_stay(spark):
    rng = random.Random(43)
    rows = []
    for i in range(60):
        words = [f"{rng.randrange(5000)}" for _ in range(rng.randint(60, 500))]
        rows.append((3 * i, " ".join(words)))
        rows += [(3 * i + k, " ".join(edited(rng, words, s)[:-1] + [f"last{i}"] * (s < 0.7))) for k, s in ((1, 0.7), (2, 0.6))]
    # a chain: each is alike the next one only
    words = [str(rng.randrange(9999)) for _ in range(300)]
    chain = [(1000 + i, " ".join(words[15 * i : 15 * i + 160])) for i in range(8)]
    got = {r.doc_id for r in drop_alike(frame(spark, rows + chain)).collect()}
    grams = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, t in rows + chain if (w := t.split())}
    alike = lambda x, y: len(grams[x] & grams[y]) / len(grams[x] | grams[y]) >= 0.8
    assert not any(alike(3 * i, 3 * i + k) for i in range(60) for k in (1, 2))
    assert all(alike(1000 + i, 1001 + i) for i in range(7)) and not alike(1000, 1002)
    assert got == {d for d, _ in rows} | {1000}


def test_open_texts_of_a_large_group_meet_all_of_it(spark):
    rng = random.Random(44)
    words = [str(rng.randrange(9999)) for _ in range(400)]
    rows = [(i, " ".join(edited(rng, words, 0.85 if i else 0.82))) for i in range(59)] + [(59, " ".join(words))]  # all are alike the last
    got = {r.doc_id for r in drop_alike(frame(spark, rows)).collect()}
    assert 0 in got and len(got) <= 6
    grams = [np.sort(shingle_set(t)[:, 0]) for _, t in rows]
    texts = [(i, 7, 60, int(f[0]), int(f[1]), 0, g.tobytes()) for i, (_, t) in enumerate(rows) for f, g in [(wide_fingerprint(t).view(np.int64), grams[i])]]
    table = spark.createDataFrame(texts, "rep long, comp long, size long, f1 long, f2 long, centre_rep long, shingles binary")
    alike = {(i, j) for i in range(60) for j in range(60) if i != j and len(np.intersect1d(grams[i], grams[j])) >= 0.8 * len(np.union1d(grams[i], grams[j]))}
    links = [(r.a, r.b) for r in verified_links(table, 0.8, 128, scratch_folder(spark), block_rows=7).collect()]
    assert set(links) <= alike | {(b, a) for a, b in alike}
    assert roots(60, links) == roots(60, sorted(alike))


def test_rows_decide_which_alike_texts_go(spark):
    rng = random.Random(42)
    a, b, c = (" ".join(str(rng.randrange(9999)) for _ in range(80)) for _ in range(3))
    rows = [(5, a), (5, a), (7, a + " x"), (7, b), (None, a), (None, c), (None, c), (8, None), (8, None), (9, ""), (9, " \n"), (10, "one"), (11, "ONE"), (2, b.upper()), (12, "w " * 50_000)]
    docs = frame(spark, rows, row="clash", f1=1, text2="x")
    got = drop_alike(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(5, a), (None, c), (8, None), (8, None), (9, ""), (9, " \n"), (10, "one"), (2, b.upper()), (12, "w " * 50_000)], key=str)
    assert drop_alike(docs.limit(0)).count() == 0


def test_wide_fingerprints():
    from xxhash import xxh3_128_intdigest

    rng = random.Random(43)
    for t in [None, "", " \n", "a", "A b c d e", *(" ".join(rng.choices(["ab", "Cd", "é"], k=k)) for k in (6, 400))]:
        w = re.findall(r"[^\x20\x09-\x0d]+", lower(t or ""))
        h = {int.from_bytes(xxh3_128_intdigest(" ".join(w[i : i + 5]).encode()).to_bytes(16, "big"), "little") for i in range(max(1, len(w) - 4))} if w else set()
        want = sum(1 << b for b in range(128) if h and 2 * sum(x >> b & 1 for x in h) > len(h))
        got = wide_fingerprint(t)
        assert int(got[0]) | int(got[1]) << 64 == want, t


@pytest.mark.parametrize("n", [10, 10**6, 10**9])
def test_sampled_masks_keep_the_stated_miss(n):
    masks = sampled_masks(n)
    bits = bin(masks[0][0]).count("1") + bin(masks[0][1]).count("1")
    assert 2.0**bits * 8 >= n or bits == 48
    rng, missed = random.Random(n), 0
    for _ in range(400):
        diff = sum(1 << b for b in rng.sample(range(128), round(128 * np.arccos(1.6 / 1.8) / np.pi)))
        missed += not any(diff & (a | b << 64) == 0 for a, b in masks)
    assert missed <= 400 * 0.05


# --- suffixes --------------------------------------------------------------------------------


def test_front_coding_and_merging():
    rng = random.Random(9)
    words = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    runs = []
    for k in range(5):
        mine = sorted(words[k * 60 : k * 60 + (60 if k else 0)])
        if not mine:
            runs.append(([], []))
            continue
        table = np.array(mine, "S9").view(np.uint8).reshape(len(mine), 9)
        shared, rest = front_code(table, np.array([len(w) for w in mine]))
        again = front_decode(shared.tolist(), [len(w) for w in mine], rest.tobytes())
        assert again == mine
        runs.append((again, shared.tolist()))
    run, place, shared = merge_runs(runs)
    out = [runs[r][0][p] for r, p in zip(run, place)]
    assert out == sorted(words[60:])
    for a, b, n in zip(out, out[1:], shared[1:]):
        assert n == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
    assert merge_runs([([], []), ([], [])]) == ([], [], [])


def cut_by_hand(rows, n=50):
    first, texts = {}, [(d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        for i in range(len(t) - n + 1 if d is not None else 0):
            first[t[i : i + n]] = min(first.get(t[i : i + n], d), d)
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1 if d is not None else 0):
            if first[t[i : i + n]] < d:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((d, len(t), int(gone.sum()), int(np.diff(np.r_[0, gone.astype(int)]).clip(0).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [1500, 8 << 20])
def test_suffixes(spark, monkeypatch, part_bytes):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("aeéñxy ", k=rng.randint(2, 8)))
    passages = ["".join(word() for _ in range(k)) for k in (9, 12, 40, 200)]
    rows = [(i, "".join(rng.choice([word(), word(), rng.choice(passages)[: rng.randint(30, 400)]]) for _ in range(rng.randint(0, 30)))) for i in rng.sample(range(1000), 60)]
    rows += [(2000, rows[0][1]), (2001, rows[0][1] + "!"), (2002, None), (2003, ""), (2004, "a" * 300), (2005, "b" + "a" * 120), (2006, "a" * 49), (None, rows[1][1]), (rows[2][0], rows[2][1]), (rows[3][0], rows[4][1]), (-5, rows[5][1][5:]), (2007, "\x00" * 60 + "ab"), (2008, "\x00" * 61)]
    rows.append((3000, passages[3] * 30))
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 700)
    docs = frame(spark, rows, doc="clash", home=1, n_bytes=2, part=3)
    out = cut_repeated_strings(docs, part_bytes=part_bytes).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == cut_by_hand(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed for r in out)
    assert cut_repeated_strings(docs.limit(0)).count() == 0


def test_texts_of_one_id_are_numbered(spark):
    rows = [(i % 40, f"{i % 70:05}") for i in range(400)] + [(None, "a"), (None, None), (1, None), (99, "x")]
    keyed = lambda rows: frame(spark, rows).withColumnRenamed("doc_id", "doc")
    tagged = suffix_dedup._tagged(keyed(rows)).collect()
    tags = {}
    for r in tagged:
        if r.doc is not None:
            tags.setdefault((r.doc, r.text or ""), set()).add(r.tag)
    assert len(tagged) == len(rows) and all(len(t) == 1 for t in tags.values())
    assert len({(d, *t) for (d, _), t in tags.items()}) == len(tags) and tags[99, "x"] == {0}
    assert {r.tag for r in suffix_dedup._tagged(keyed([(1, "a"), (2, "a"), (None, "a"), (None, "b")])).collect()} == {0}


def test_tasks_that_hold_no_long_text(spark):
    rows = [(1, "short"), (2, None), (3, ""), (None, None), (4, "x" * 49), (4, "x" * 49)]
    for parts in (1, 6):
        out = cut_repeated_strings(frame(spark, rows).repartition(parts)).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == cut_by_hand(rows)
    mixed = frame(spark, rows).repartition(1).unionByName(frame(spark, [(8, "y" * 60), (9, "y" * 60)]).repartition(1))
    assert {r.doc_id: r.n_removed for r in cut_repeated_strings(mixed).collect() if r.n_removed} == {9: 60}


def test_stretches_of_a_text_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 500)
    data = np.frombuffer(random.Random(1).randbytes(2600), np.uint8)
    covered = []
    for _, borders, at in suffix_dedup._pieces(np.array([0, 2600]), 50):
        _, start, count, *_ = suffix_dedup.stretches(data[borders[0] : borders[-1]], borders - borders[0], 50)
        covered += [i for s, c in zip((start + at).tolist(), count.tolist()) for i in range(s, s + c)]
    assert sorted(covered) == list(range(2600 - 49))
