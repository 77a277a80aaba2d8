"""Operators against plain Python on small inputs, and on a synthetic circular genome."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from thylakoid.functions.sequence import AMBIGUITY
from thylakoid.operators import alignment, breakpoints, gapmap, kmers, mapping, msa, pairing, pileup, seeds, selection
from thylakoid.plans import growing, pipelines
from thylakoid.sources import alignments
from thylakoid.sources.files import read_fasta, write_fasta


def comp(s):
    return s.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def pileup_by_hand(bases):
    names = dict(zip([".", ",", "A", "C", "G", "T", "N", "+", "-", "^", "$", "other"], [0] * 12))
    i = 0
    while i < len(bases):
        c = bases[i]
        i += 1
        if c in "^$.,":
            names[c] += 1
            i += c == "^"
        elif c in "+-":
            names[c] += 1
            digits = ""
            while i < len(bases) and bases[i] in "0123456789":
                digits += bases[i]
                i += 1
            if not digits:
                names["other"] += 1
                break
            i += int(digits)
        elif c.upper() in "ACGTN":
            names[c.upper()] += 1
        elif c.upper() in AMBIGUITY:
            for b in AMBIGUITY[c.upper()]:
                names[b] += 1
        elif c != "*":
            names["other"] += 1
    return tuple(names.values())


def test_pileup_parser(spark):
    rng = random.Random(1)
    rows = ["^I.,+2AGa$*-1tRr.", "", "+", "-A.", "+0A", "A+10" + "c" * 12, "^", "+3AC", "*?b"]
    rows += ["".join(rng.choice(".,ACgtN+-123^$*RyZ") for _ in range(rng.randint(0, 25))) for _ in range(300)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, b string").select("i", pileup.parse_pileup(F.col("b")).alias("n"))
    got = {r.i: tuple(r.n) for r in df.collect()}
    assert got[0] == (2, 1, 3, 0, 2, 0, 0, 1, 1, 1, 1, 0)
    for i, r in enumerate(rows):
        assert got[i] == pileup_by_hand(r), r


def test_variants_and_mutations(spark):
    cols = "pos int, ref string, ref_fwd long, ref_rev long, a long, c long, g long, t long"
    rows = [(1, "A", 0, 0, 0, 3, 2, 0), (2, "A", 0, 0, 0, 2, 0, 0), (3, "R", 5, 0, 1, 0, 0, 0), (4, "A", 9, 9, 0, 0, 0, 0), (5, "C", 2, 1, 3, 0, 0, 0), (6, "C", 1, 1, 2, 0, 0, 2), (7, "g", 0, 0, 3, 2, 0, 0)]
    counts = spark.createDataFrame(rows, cols)
    assert {r.pos for r in pileup.variants(counts).collect()} == {1, 3, 5, 7}
    assert {(r.pos, r.base) for r in pileup.mutations(counts).collect()} == {(1, "C"), (2, "C"), (6, "A"), (7, "A")}
    seqs = spark.createDataFrame([("x", "acgt"), ("y", "AC"), ("z", "")], "k string, seq string")
    changes = spark.createDataFrame([("x", 2, "T"), ("x", 9, "A"), ("x", 2, "G"), ("z", 1, "A")], "k string, pos int, base string")
    assert {(r.k, r.seq) for r in pileup.apply_mutations(seqs, changes, "k").collect()} == {("x", "aGgt"), ("y", "AC"), ("z", "")}


def test_pairing(spark):
    files = spark.createDataFrame([("/a/s1_1.fastq.gz",), ("/a/s1_2.fastq.gz",), ("/b/s1_1.fastq.gz",), ("/a/s2_1.fastq.gz",), ("/a/x.txt",), ("/a/s3_2.fastq",)], "path string")
    assert [tuple(r) for r in pairing.pair_files(files).collect()] == [("s1", "/a/s1_1.fastq.gz", "/a/s1_2.fastq.gz")]
    reads = spark.createDataFrame([(1, "ACGT", "!I#I"), (2, "ACG", "!!\""), (3, "", ""), (4, "AC", "II")], "i int, s string, q string")
    assert [(r.i, r.s, r.q) for r in pairing.trim_ends(reads, "s", "q").orderBy("i").collect()] == [(1, "CGT", "I#I"), (2, "", ""), (3, "", ""), (4, "AC", "II")]
    clipped = pairing.clip_adapter(spark.createDataFrame([("AAGGTTCC", "12345678"), ("AAAAGGT", "1234567"), ("AAGG", "1234"), ("GGTTAGGTT", "123456789")], "s string, q string"), "s", "q", "GGTT", 3)
    assert [(r.s, r.q) for r in clipped.collect()] == [("AA", "12"), ("AAAA", "1234"), ("AAGG", "1234"), ("", "")]
    dup = spark.createDataFrame([("A", "C", 2), ("A", "C", 1), ("A", "G", 3)], "s1 string, s2 string, i int")
    assert {(r.i, r.copies) for r in pairing.collapse_reads(dup, ["s1", "s2"], "i").collect()} == {(1, 2), (3, 1)}
    assert pairing.collapse_reads(dup, ["s1", "s2"], "i", dedup=False).count() == 3


def test_selection(spark):
    names = "folder string, row_ord int, Input string, Length string, Ref_length string, LSC string, IRa string, SSC string, IRb string, r_LSC string, r_IRa string, r_SSC string, r_IRb string"
    ref = ("10", "10", "10", "10")
    rows = [("a", 0, "x", "120", "100", "10", "10", "10", "10", *ref), ("a", 1, "y", "110", "100", "10", "11", "9", "99", *ref), ("a", 2, "z", "100", "100", "10", "10", "10", "10", *ref), ("b", 0, "x", "100", "100", "10", "10", "99", "nan", *ref), ("c", 0, "w", "100", "100", "10", "10", "10", "", *ref)]
    files = spark.createDataFrame([("a", "y2.fasta"), ("a", "y.fasta"), ("a", "z.fasta"), ("c", "w_b.fasta"), ("c", "w_a.fasta")], "folder string, name string")
    chosen, failed = selection.select_assemblies(spark.createDataFrame(rows, names), files)
    assert {(r.folder, r.Input, r.file) for r in chosen.collect()} == {("a", "y", "y.fasta"), ("c", "w", "w_a.fasta")}
    assert [r.folder for r in failed.collect()] == ["b"]


def largest_stretch(scores):
    """Of all stretches the one of the largest positive sum; the first end, then the last start."""
    every = [(sum(scores[i : j + 1]), -j, i) for i in range(len(scores)) for j in range(i, len(scores))]
    total, end, start = max(every, default=(0, 0, 0))
    return (start, -end, total) if total > 0 else None


def test_max_excess(spark):
    rng = random.Random(2)
    rows = {k: [rng.choice([-1, 0, 1]) for _ in range(rng.randint(1, 40))] for k in range(60)} | {99: [-1, -1, 0]}
    df = spark.createDataFrame([(k, i, v) for k, s in rows.items() for i, v in enumerate(s)], "k int, col int, score int")
    got = {r.k: (r.s, r.e, r.total) for r in msa.max_excess_block(df, ["k"]).collect()}
    assert got == {k: largest_stretch(s) for k, s in rows.items() if largest_stretch(s)}


def test_windows_and_merging(spark):
    rng = random.Random(3)
    n, flags = 3000, []
    for i in range(n):
        p = 0.8 if 1000 <= i < 1900 else 0.02
        c = int(rng.random() < 0.95)
        flags.append((1, i, c, int(c and rng.random() < p)))
    seq = "".join("-" if not f[2] else "C" if f[3] else "a" for f in flags)
    df = spark.createDataFrame([(1, seq, "A" * n)], "k int, seq_aln string, cons string")
    overall = sum(f[3] for f in flags) / sum(f[2] for f in flags)
    limit, want = max(0.35, min(0.6, overall + 0.25)), []
    for s in range(0, n - 399, 100):
        w = flags[s : s + 400]
        if sum(f[2] for f in w) >= 200 and sum(f[3] for f in w) / sum(f[2] for f in w) >= limit:
            want.append((s, s + 399))
    bad = msa.mismatch_windows(df, ["k"])
    assert sorted((r.s, r.e) for r in bad.collect()) == want and want
    blocks = msa.merge_intervals(bad, ["k"], 100)
    assert [(r.s, r.e) for r in blocks.collect()] == [(want[0][0], want[-1][1])]
    assert [(r.s, r.e, r.found_by) for r in msa.inversion_block(df, ["k"], least=500).collect()] == [(want[0][0], want[-1][1], "windows")]
    assert msa.inversion_block(df, ["k"], least=2000).count() == 0
    gaps = spark.createDataFrame([(1, 0, 10), (1, 5, 30), (1, 41, 50), (1, 130, 140), (2, 0, 1)], "k int, s int, e int")
    assert sorted((r.k, r.s, r.e) for r in msa.merge_intervals(gaps, ["k"], 11).collect()) == [(1, 0, 50), (1, 130, 140), (2, 0, 1)]


def test_consensus_goes_as_far_as_its_row(spark):
    """Short rows of a group with one long row don't hold the long consensus."""
    rows = spark.createDataFrame([("g", i, "ACGT" * (5000 if i == 0 else i)) for i in range(4)] + [("g", 4, ""), ("g", 5, None)], "k string, row int, seq_aln string")
    got = msa.with_consensus(rows, msa.consensus_texts(rows, ["k"]), ["k"])
    assert {r.row: (r.cons, r.seq_aln) for r in got.collect()} == {r.row: (r.seq_aln or "", r.seq_aln) for r in rows.collect()}


def test_seeds_hold_their_reads_length(spark, monkeypatch):
    """Reads' lengths come with their seeds, so seeds aren't shuffled to find them."""
    plans, keep = [], mapping.cut_lineage
    monkeypatch.setattr(mapping, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df))
    text = "".join("ACGT"[i * i * 7919 % 101 % 4] for i in range(600))
    reads = spark.createDataFrame([(1, text[100:220])], "read int, seq string")
    got = mapping.map_gapped(reads, spark.createDataFrame([("c", text)], "chrom string, seq string"), ["read"]).collect()
    assert [(r.chrom, r.cigar) for r in got] == [("c", "120=")] and "Join" not in plans[0]


def test_merged_pairs_leave_python_in_slices(spark, monkeypatch):
    """A group's map isn't repeated for its rows on the way to Python, and rows are passed on before a batch of them is full."""
    monkeypatch.setattr(gapmap, "MOST_LETTERS", 100)
    letters = "ACGT" * 10
    pairs = spark.createDataFrame([("g", i, letters[:i] + "-" * (i % 4) + letters[i:], letters[:i] + "T" * (i % 4) + letters[i:]) for i in range(40)] + [(None, 99, "A", "A")], "g string, i int, a string, b string")
    merged = gapmap.merge_pairs(pairs, ["g"])
    got = {r.i: r for r in merged.collect()}
    width = 40 + sum(i % 4 for i in range(40))
    assert len(got) == 40 and {len(r.merged) for r in got.values()} == {len(r.common) for r in got.values()} == {width}
    assert all(r.merged.replace("-", "") == r.b and r.common.replace("-", "") == letters for r in got.values())
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "_laid" not in plan


def test_positions_in_slices(spark, monkeypatch):
    """Places come for some letters at a time, and no batch that leaves Python holds many more."""
    monkeypatch.setattr(msa, "MOST_LETTERS", 50)
    rows = spark.createDataFrame([(i, "AC-GN" * (i % 7) if i % 11 else None) for i in range(300)] + [(300, "A" * 500)], "row int, seq_aln string").coalesce(1)
    want = {r.row: list(r.x) for r in rows.select("row", msa.positions("seq_aln").alias("x")).collect()}
    assert {r.row: list(r.pos) for r in msa.with_positions(rows, ["row"]).collect()} == want


def test_consensus_identity_and_positions(spark):
    rows = spark.createDataFrame([(0, "AC-GN"), (1, "AT-GN"), (2, "TTcRN")], "row int, seq_aln string").withColumn("k", F.lit(1))
    agreed = msa.consensus(rows, ["k"])
    assert "".join(r.base for r in agreed.orderBy("col").collect()) == "ATCGN"
    scores = {r.row: (r.compared, r.equal) for r in msa.identity(msa.with_consensus(rows, msa.consensus_texts(rows, ["k"]), ["k"]), ["row"]).collect()}
    assert scores == {0: (3, 2), 1: (3, 3), 2: (4, 2)}
    assert rows.filter("row = 0").select(msa.positions("seq_aln").alias("x")).first().x == [1, 2, -1, 3, 4]


def test_excess_stretches(spark):
    rng = random.Random(12)
    rows = {k: [rng.choice([-1, 0, 1]) for _ in range(rng.randint(0, 40))] for k in range(200)}
    text = lambda scores: "".join({-1: "A", 0: "-", 1: "G"}[v] for v in scores)
    df = spark.createDataFrame([(k, text(v), "A" * len(v)) for k, v in rows.items()], "k int, a string, b string")
    got = {r.k: tuple(r.x) for r in df.select("k", msa.excess_stretch("a", "b").alias("x")).collect()}
    for k, scores in rows.items():
        best = largest_stretch(scores)
        assert got[k] == (best[:2] if best else (None, None))


def test_exact_matches(spark):
    rng = random.Random(4)
    a = "".join(rng.choice("ACGT") for _ in range(120))
    b = a[10:50] + "N" + a[60:90] + comp(a[:20])
    got = {(r.a0, r.b0, r.size) for r in kmers.exact_matches(spark.createDataFrame([(1, a, b)], "k int, a string, b string"), ["k"], "a", "b", 12).collect()}
    assert got == {(10, 0, 40), (60, 41, 30)}
    best = kmers.best_border_match(kmers.exact_matches(spark.createDataFrame([(1, a, b)], "k int, a string, b string"), ["k"], "a", "b", 12), ["k"], "right").first()
    assert (best.a0, best.b0, best.size) == (10, 0, 40)


def local_by_hand(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 2, h[i, j - 1] - 2)
    return h.max()


def test_local_alignment():
    rng = random.Random(5)
    assert alignment.local_ends("TTACGTA", "GGACGTC") == (3, 6, 3, 6, 8)
    assert alignment.local_ends("AAA", "CCC") is None and alignment.local_ends("", "A") is None
    for _ in range(60):
        a, b = ("".join(rng.choice("ACGT") for _ in range(rng.randint(1, 25))) for _ in range(2))
        found = alignment.local_ends(a, b)
        assert (found[4] if found else 0) == local_by_hand(a, b)


def test_banded_alignment():
    rng = random.Random(6)
    a = "".join(rng.choice("ACGT") for _ in range(500))
    b = a[:100] + "GG" + a[100:300] + a[304:]
    x, y = alignment.banded_pair(a, b)
    assert len(x) == len(y) and x.replace("-", "") == a and y.replace("-", "") == b
    assert x.count("-") == 2 and y.count("-") == 4 and sum(p == q for p, q in zip(x, y)) == 496
    assert alignment.banded_pair("", "AC") == ("--", "AC") and alignment.banded_pair("AC", "") == ("AC", "--")


@pytest.mark.parametrize("cells", [1 << 27, 200_000, 60_000])
def test_indels_that_cancel_are_aligned(monkeypatch, cells):
    monkeypatch.setattr(alignment, "MOST_CELLS", cells, raising=False)
    rng = random.Random(16)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    a = part(3000)
    b = a[:600] + part(300) + a[600:2200] + a[2500:]
    x, y = alignment.banded_pair(a, b)
    assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)
    assert sum(p == q for p, q in zip(x, y)) == 2700 and x.count("-") == y.count("-") == 300
    # unlike sequences: the best score, whether cells are few or many
    a, b = part(300), part(280)
    score = lambda x, y: sum(-2 if "-" in p else 1 if p[0] == p[1] else -1 for p in zip(x, y))
    x, y = alignment.banded_pair(a, b)
    assert x.replace("-", "") == a and y.replace("-", "") == b
    row = [-2 * j for j in range(281)]
    for i, p in enumerate(a):
        new = [-2 * (i + 1)]
        for j, q in enumerate(b):
            new.append(max(row[j] + (1 if p == q else -1), row[j + 1] - 2, new[-1] - 2))
        row = new
    assert score(x, y) == row[-1]


def test_shortcuts_of_alignments_are_the_whole_matrix():
    rng = random.Random(18)
    pairs = []
    for n in range(400):
        letters = "AC" if n % 2 else "ACGT"
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))
        b = "".join(c for c in a if rng.random() > 0.15) if n % 4 < 2 else "".join(c + rng.choice(letters) * (rng.random() < 0.1) if rng.random() > 0.1 else "" for c in a)
        pairs.append((a, b) if n % 3 else (b, a))
    for (a, b), got in zip(pairs, alignment.banded_pairs(pairs)):
        assert got == alignment._in_bands([(a, b)], max(len(a), len(b), 1), 1, -1, -2)[0][:2]
    assert sum(alignment.align_in_order(a, b) is not None for a, b in pairs) >= 200


def test_similar_texts_need_no_wide_band(monkeypatch):
    rng = random.Random(19)
    a = "".join(rng.choice("ACGT") for _ in range(4000))
    changed = a[:1000] + ("C" if a[1000] != "C" else "A") + a[1001:]
    cells, fill = [], alignment._in_bands
    monkeypatch.setattr(alignment, "_in_bands", lambda pairs, half, *costs: cells.append(half) or fill(pairs, half, *costs))
    assert alignment.banded_pairs([(a, a[:2000] + "GATTACA" + a[2000:]), (a[:900] + a[905:], a), (a, a)])[2] == (a, a) and not cells
    assert alignment.banded_pair(a, changed) == (a, changed) and cells == [8]


def test_pairs_aligned_side_by_side():
    rng = random.Random(17)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    pairs = [(part(rng.randrange(0, 90)), part(rng.randrange(0, 90))) for _ in range(60)] + [("", ""), ("A", ""), ("", "C")]
    for (a, b), (x, y) in zip(pairs, alignment.banded_pairs(pairs, band=8)):
        assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)
        row = [-2 * j for j in range(len(b) + 1)]
        for i, p in enumerate(a):
            new = [-2 * (i + 1)]
            for j, q in enumerate(b):
                new.append(max(row[j] + (1 if p == q else -1), row[j + 1] - 2, new[-1] - 2))
            row = new
        assert sum(-2 if "-" in p else 1 if p[0] == p[1] else -1 for p in zip(x, y)) == row[-1]


def test_adapters_with_errors_are_clipped(spark):
    adapter, other = "AGATCGGAAGAGCACACGTC", "CTGTCTCTTATACACATCTC"
    wrong = "AGATCTGAAGAGCACAGGTC"
    reads = [(0, "TTGCAATGCC" + wrong + "AAAA"), (1, "TTGCAATGCC" + adapter[:9].replace("C", "T")), (2, "TTGCAATGCC" + other[:12]), (3, "TTGCAATGCC" + adapter[:7]), (4, "TTGCAATGCC" + wrong.replace("AAG", "TTG")), (5, None), (6, ""), (7, adapter[:8] + "GG" + other)]
    df = spark.createDataFrame(reads, "i int, s string").withColumn("q", F.col("s"))
    got = {r.i: r.s for r in pairing.clip_adapter(df, "s", "q", [adapter, other]).collect()}
    assert got == {0: "TTGCAATGCC", 1: "TTGCAATGCC", 2: "TTGCAATGCC", 3: reads[3][1], 4: reads[4][1], 5: None, 6: "", 7: adapter[:8] + "GG"}


@pytest.fixture(scope="module")
def genome():
    """A circular genome with two inverted copies of a repeat around a short single-copy region."""
    rng = random.Random(7)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    long, repeat, short = part(9000), part(2400), part(3000)
    return long, repeat, short


def test_rotation(spark, genome):
    ref = "".join([genome[0], genome[1], genome[2], comp(genome[1])])
    rows = [(cut, ref, ref[cut:] + ref[:cut]) for cut in (0, 1, 5000, 12000)]
    rows += [(-cut, ref, comp(ref[cut:] + ref[:cut])) for cut in (7, 9000)]
    noisy = list(ref[3000:] + ref[:3000])
    for i in range(5):
        noisy[len(ref) - 3000 + i * 17] = "N"
    rows.append((77, ref, "".join(noisy)))
    df = spark.createDataFrame(rows, "k int, r string, q string")
    got = {r.k: r for r in alignment.rotate_to_anchor(df, ["k"], "r", "q").collect()}
    for k, _, _ in rows:
        if k != 77:
            assert got[k].seq == ref, k
    assert got[77].seq.replace("N", "") != "" and got[77].seq[:6000].replace("N", "")[-3000:] == ref[3000:6000]
    none = spark.createDataFrame([(1, ref, genome[2][:500]), (2, "ACG", ref), (3, ref, "")], "k int, r string, q string")
    assert {r.k: r.seq for r in alignment.rotate_to_anchor(none, ["k"], "r", "q").collect()} == {1: genome[2][:500], 2: ref, 3: ""}


def test_inversion_is_found_and_undone(spark, genome):
    long, repeat, short = genome
    ref = long + repeat + short + comp(repeat)
    turned = long + repeat + comp(short) + comp(repeat)
    out = {r.k: r for r in pipelines.repair_inversions(spark.createDataFrame([(1, ref, turned), (2, ref, ref)], "k int, cons string, new string"), "k").collect()}
    assert out[2].seq == ref and not out[2].flipped
    assert out[1].flipped and out[1].after > out[1].before
    assert sum(a != b for a, b in zip(out[1].seq, ref)) < 80


def test_reads_map_and_vote(spark, genome):
    ref = genome[0][:3000]
    sample = list(ref)
    for i in (500, 1500):
        sample[i] = {"A": "C", "C": "A", "G": "T", "T": "G"}[sample[i]]
    sample = "".join(sample)
    rng = random.Random(8)
    reads = []
    for i in range(400):
        at = rng.randrange(0, 2900)
        s = sample[at : at + 100]
        reads.append((i, comp(s) if i % 2 else s, "I" * 100))
    reads.append((999, "ACGT" * 5, "I" * 20))
    df = spark.createDataFrame(reads, "id int, seq string, qual string")
    contigs = spark.createDataFrame([("c", ref)], "chrom string, seq string")
    found = pipelines.variant_table(df, contigs, ["id"])
    assert {r.pos for r in found.collect()} == {501, 1501}
    fixed = pipelines.correct_sequences(contigs, found).first()
    assert fixed.seq == sample and fixed.header == ">c, Hordeum vulgare, 3000"


def test_reads_of_common_passages_map_like_brute_force(spark):
    rng = random.Random(18)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    passage = part(60)
    contigs = [(f"c{i:03}", part(40 + i % 7) + passage + part(30)) for i in range(200)]
    own = contigs[150][1]
    changed = "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i % 17 == 16 else c for i, c in enumerate(contigs[3][1][:100]))
    reads = [(0, passage), (1, comp(passage)), (2, own[20:90]), (3, contigs[7][1][3:19]), (4, contigs[8][1][2:17]), (5, passage[:14]), (6, changed), (None, passage[5:50])]
    got = pipelines.map_reads(spark.createDataFrame(reads, "id int, seq string"), spark.createDataFrame(contigs, "chrom string, seq string"), ["id"]).collect()

    def by_hand(read, stride, least):
        votes = {}
        for strand, s in (("+", read), ("-", comp(read))):
            for i in range(0, len(s) - 14, stride):
                for name, text in contigs:
                    at = text.find(s[i : i + 15])
                    while at >= 0:
                        votes[name, at - i + 1, strand] = votes.get((name, at - i + 1, strand), 0) + 1
                        at = text.find(s[i : i + 15], at + 1)
        best = sorted(votes.items(), key=lambda x: (-x[1], x[0]))[:2]
        return (*best[0][0], best[0][1]) if best and best[0][1] >= min(least, len(read) - 14) else None

    want = {i: x for i, s in reads if (x := by_hand(s, 1, 2))}
    assert len(got) == len(want) == 7
    assert {r.id: (r.chrom, r.pos, r.strand, r.seeds) for r in got} == want
    assert want[0] == ("c000", 41, "+", 46) and want[2][0] == "c150" and want[6][:2] == ("c003", 1)


def test_minimizers_agree_on_both_strands():
    rng = random.Random(51)
    for _ in range(50):
        seq = "".join(rng.choice("ACGTN" if rng.random() < 0.02 else "ACGT") for _ in range(rng.randrange(0, 200)))
        at, code, own = mapping.minimizers(seq, 7, 4)
        back = {(len(seq) - 7 - i, c, 1 - o) for i, c, o in zip(*mapping.minimizers(comp(seq), 7, 4))}
        same = set(zip(at.tolist(), code.tolist(), own.tolist()))
        assert len(same ^ back) <= 0.2 * len(same) + 4  # equal hashes in a window are settled by place
    assert len(mapping.minimizers("A" * 1000)[0]) <= 1000 / mapping.W + 1


def local_score(a, b):
    """The best local alignment's score, by hand."""
    low, first, more = -(10**9), mapping.OPEN + mapping.EXTEND, mapping.EXTEND
    best, row, put = 0, [0] * (len(b) + 1), [low] * (len(b) + 1)
    for x in a:
        new, lack = [0], low
        for j, y in enumerate(b):
            lack = max(lack + more, new[j] + first)
            put[j + 1] = max(put[j + 1] + more, row[j + 1] + first)
            new.append(max(0, row[j] + (mapping.MATCH if x == y else mapping.MISMATCH), put[j + 1], lack))
        row, best = new, max(best, *new)
    return best


def walked(cigar, pos, read, contig):
    """The score of a CIGAR, whose steps must fit the texts."""
    i, j, score = 0, pos - 1, 0
    for n, step in mapping.cigar_steps(cigar):
        if step in "=X":
            assert all((read[i + x] == contig[j + x]) == (step == "=") for x in range(n))
            score += n * (mapping.MATCH if step == "=" else mapping.MISMATCH)
        i, j = i + n * (step in "=XIS"), j + n * (step in "=XD")
        score += (mapping.OPEN + n * mapping.EXTEND) * (step in "ID")
    assert i == len(read)
    return score


def test_reads_with_gaps_map(spark):
    rng = random.Random(52)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    contigs = {f"c{i}": part(rng.randrange(300, 5000)) for i in range(6)}
    contigs["repeat"] = part(300) + contigs["c0"][100:400] + part(300)
    reads, true = [], {}
    for i in range(240):
        name = f"c{rng.randrange(6)}"
        at, size = rng.randrange(0, len(contigs[name]) - 200), rng.randrange(60, 180)
        s = list(contigs[name][at : at + size])
        for _ in range(rng.randrange(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("ACGT")
        cut = rng.randrange(25, len(s) - 25)
        s = s[:cut] + list(part(i % 4)) + s[cut + (i % 3) * 2 :]
        s = "".join(s)
        reads.append((i, comp(s) if i % 2 else s))
        true[i] = (name, at + 1, "-" if i % 2 else "+", s)
    reads += [(900, None), (901, ""), (902, "ACGT"), (903, part(100)), (904, contigs["c1"][:120].lower())]
    df = spark.createDataFrame(reads, "id int, seq string")
    table = spark.createDataFrame(list(contigs.items()) + [("none", None), ("short", "ACG")], "chrom string, seq string")
    got = {r.id: r for r in mapping.map_gapped(df, table, ["id"]).collect()}
    assert not {900, 901, 902, 903} & set(got) and (got[904].chrom, got[904].pos, got[904].cigar) == ("c1", 1, "120=")
    right = exact = 0
    for i, (name, at, strand, s) in true.items():
        if i not in got:
            continue
        r = got[i]
        text = contigs[r.chrom]
        lies = s if r.strand == strand else comp(s)
        assert walked(r.cigar, r.pos, lies, text) == r.score
        right += r.chrom in (name, "repeat") and (r.chrom == "repeat" or abs(r.pos - at) <= 30)
        exact += r.score == max(local_score(lies, text), 0)
    assert right >= 0.98 * len(true) and exact >= 0.97 * len(true)
    assert mapping.map_gapped(df.limit(0), table, ["id"]).count() == 0


def test_mates_map_together(spark):
    rng = random.Random(54)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    repeat = part(400)
    contig = part(3000) + repeat + part(3000) + repeat + part(3000)
    reads = []

    def pair(i, at, size, first=lambda s: s, second=lambda s: s):
        reads.append((i, 1, first(contig[at : at + 100])))
        reads.append((i, 2, second(comp(contig[at + size - 100 : at + size]))))

    for i in range(120):
        pair(i, 20 + i * 20, 300 + rng.randrange(-20, 21))
    pair(500, 6650, 300)  # the second copy of the repeat holds one mate whole
    pair(501, 3300, 290)
    noisy = lambda s: "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if j % 9 == 8 else c for j, c in enumerate(s))
    pair(502, 7200, 300, second=noisy)  # no seed of 15 is left: the mate is looked for
    pair(503, 1000, 2500)  # too far apart to be a pair
    reads += [(504, 1, contig[50:150]), (505, 1, part(100)), (505, 2, contig[60:160])]
    df = spark.createDataFrame([(i, m, s, "I" * len(s)) for i, m, s in reads], "id int, mate int, seq string, qual string")
    table = spark.createDataFrame([("c", contig)], "chrom string, seq string")
    places = mapping.candidate_places(df, table, ["id", "mate"]).cache()
    middle, spread = mapping.insert_sizes(places, ["id"])
    assert abs(middle - 300) < 8 and 5 <= spread < 25
    got = {(r.id, r.mate): r for r in mapping.pair_places(places, df, table, ["id"]).collect()}
    assert all(got[i, m].proper and got[i, 1].pos == 21 + i * 20 for i in range(120) for m in (1, 2))
    assert (got[500, 1].pos, got[500, 2].pos, got[500, 1].proper) == (6651, 6851, True)
    assert (got[501, 1].pos, got[501, 2].pos, got[501, 2].strand) == (3301, 3491, "-")
    assert (502, 2) not in {(r.id, r.mate) for r in places.collect()}
    assert got[502, 2].proper and abs(got[502, 2].pos - 7401) < 20 and walked(got[502, 2].cigar, got[502, 2].pos, comp(next(s for i, m, s in reads if (i, m) == (502, 2))), contig) == got[502, 2].score
    assert not got[503, 1].proper and got[503, 1].pos == 1001 and got[503, 2].pos == 3401
    assert got[504, 1].pos == 51 and (505, 1) not in got and got[505, 2].pos == 61
    assert mapping.pair_places(places.filter("id > 600"), df, table, ["id"]).count() == 0


def test_runs_of_one_letter_stay_linear(spark):
    rng = random.Random(53)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    contig = part(500) + "A" * 100_000 + part(500)
    df = spark.createDataFrame([(0, "A" * 2000), (1, contig[480:700]), (2, "A" * 60 + contig[100_500:100_560])], "id int, seq string")
    table = spark.createDataFrame([("c", contig)], "chrom string, seq string")
    assert mapping._stretches(table, ["chrom"], "seq", 15, 5, 2000).filter("code = 0").count() <= 3
    got = {r.id: r for r in mapping.map_gapped(df, table, ["id"]).collect()}
    assert got[0].score == 4000 and (got[1].pos, got[1].cigar) == (481, "220=") and (got[2].pos, got[2].cigar) == (100_441, "120=")


def test_kmers_of_both(spark, monkeypatch):
    rng = random.Random(55)
    part = lambda n: "".join(rng.choice("ACGTN" if n % 2 else "AC") for _ in range(n))
    words = lambda x, k: {x[i : i + k] for i in range(len(x) - k + 1) if "N" not in x[i : i + k]}
    for k in (1, 2, 7, 21, 31):
        texts = [[part(rng.randrange(0, 90)) for _ in range(3)] for _ in range(30)] + [["ACGT" * 20] * 3]
        made, codes = [], kmers.kmer_codes
        monkeypatch.setattr(kmers, "kmer_codes", lambda *x: made.append(x) or codes(*x))  # noqa: B023
        got = kmers.shared_kmers_of_both(k).func(*map(pd.Series, zip(*texts)))
        monkeypatch.setattr(kmers, "kmer_codes", codes)
        sizes = lambda x, y: (len(words(x, k) & words(y, k)), len(words(x, k) | words(y, k)))  # noqa: B023, E731
        assert [tuple(r) for r in got.to_numpy()] == [(*sizes(x, y), *sizes(x, z)) for x, y, z in texts]
        assert len(made) <= 3 * 30 + 1
        for x, _, _ in texts:
            at, code = codes(x, k)
            assert code.tolist() == [int("".join(str("ACGT".index(c)) for c in x[i : i + k]), 4) for i in at] and len(at) == sum("N" not in x[i : i + k] for i in range(len(x) - k + 1))


def test_seeds_and_places_come_in_few_batches(spark, monkeypatch):
    rng = random.Random(54)
    contig = "".join(rng.choice("ACGT") for _ in range(512))
    reads = [contig[i : i + 100] for i in range(0, 400, 4)]
    sent = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, fn, schema: sent.append(fn) or df)
    mapping._stretches(spark.createDataFrame([("", "")], "read string, seq string"), ["read"], "seq", 15, 5, 1024)
    rows = pa.RecordBatch.from_pydict({"read": [str(i) for i in range(100)], "_seq": reads})
    made = list(sent[0](iter([rows])))
    assert len(made) == 1 and set(made[0].column("read").to_pylist()) == {str(i) for i in range(100)}
    # both bins of a short contig are one alignment, and exact reads none
    filled, fill = [], mapping.align_in_bands
    monkeypatch.setattr(mapping, "align_in_bands", lambda some, *rest: filled.extend(some) or fill(some, *rest))
    changed = contig[50:100] + ("C" if contig[100] != "C" else "A") + contig[101:150]
    both = pa.RecordBatch.from_pydict({"read": ["x", "x", "y", "y"], "s": [changed, changed, reads[3], reads[3]], "region": [contig] * 4, "start": [0] * 4})
    got = pa.Table.from_batches(mapping._extend(15, 5)(iter([both]))).to_pylist()
    assert [(r["read"], r["pos"], r["cigar"]) for r in got] == [("x", 50, "50=1X49=")] * 2 + [("y", 12, "100=")] * 2 and len(filled) == 1


def test_pileup_of_a_cigar():
    seen = list(mapping.observe(11, "+", "2S3=1I2=2D1X1=1S", "NNACGTACGTN", list(range(11))))
    assert seen == [(13, "+", 4), (15, "-", 7), (11, "^", 2), (19, "$", 9), (11, ".", 2), (12, ".", 3), (13, ".", 4), (14, ".", 6), (15, ".", 7), (18, "G", 8), (19, ".", 9)]
    assert list(mapping.observe(1, "-", "3S", "ACG", [1, 2, 3])) == []


def opened_by_hand(text, gaps):
    cells = [""] + list(text)
    for at, size in gaps:
        cells[at] += "-" * size
    return "".join(cells)


def test_later_gaps_are_dealt_over_tasks(spark):
    rows = [(f, v, 100 + 3 * v, [(50 + 3 * (v - 1), 3)] if v else []) for f in range(400) for v in range(3)]
    later = gapmap.later_gaps(spark.createDataFrame(rows, "f int, version int, width int, gaps array<struct<at int, size int>>"), ["f"])
    got = later.withColumn("task", F.spark_partition_id()).collect()
    assert {r.version: [tuple(x) for x in r.later] for r in got if r.f == 7} == {0: [(50, 6)], 1: [(53, 3)], 2: []}
    assert len(got) == 1200 and len({r.task for r in got}) > 1


def test_counts_take_few_bytes():
    for most in (0, 1, 255, 256, 65_535, 65_536, 70_000):
        counts = np.array([[0, most], [1, 0], [most, 2], [0, 0]])
        packed = gapmap.pack_counts(counts)
        assert (gapmap.unpack_counts(packed) == counts).all() and len(packed) == 1 + 8 * (1 if most < 256 else 2 if most < 65_536 else 4)


def test_gap_maps_compose(spark):
    rng = random.Random(31)
    for _ in range(200):
        width = rng.randrange(0, 12)
        first = sorted((at, rng.randrange(1, 4)) for at in rng.sample(range(width + 1), rng.randrange(0, width + 1)))
        wide = width + sum(n for _, n in first)
        then = sorted((at, rng.randrange(1, 4)) for at in rng.sample(range(wide + 1), rng.randrange(0, wide + 1)))
        both = gapmap.compose(*([{"at": a, "size": n} for a, n in g] for g in (first, then)), width)
        text = "ACGTACGTACGT"[:width]
        assert opened_by_hand(text, [(g["at"], g["size"]) for g in both]) == opened_by_hand(opened_by_hand(text, first), then)


def test_pairs_merge_into_columns(spark):
    rng = random.Random(32)
    rows = []
    for group, center in (("x", "ACGTTGCA"), ("y", "GG"), ("z", "")):
        for i in range(6):
            a, b = "", ""
            for at in range(len(center) + 1):
                new = "".join(rng.choice("ACGT") for _ in range(rng.choice((0, 0, 0, 1, 3))))
                a, b = a + "-" * len(new), b + new
                if at < len(center):
                    a, b = a + center[at], b + rng.choice((center[at], "-", "T"))
            rows.append((group, i, a, b))
    rows += [("y", 6, "GG", "GG"), ("w", 0, "AC", "-C")]
    got = gapmap.merge_pairs(spark.createDataFrame(rows, "g string, i int, a string, b string"), ["g"]).collect()
    assert len(got) == len(rows)
    for group in "wxyz":
        mine = [r for r in got if r.g == group]
        assert len({r.common for r in mine}) == 1 and len({len(r.merged) for r in mine} | {len(mine[0].common)}) == 1
        sizes = {}
        for r in mine:  # by hand: the widest insertion before each letter
            at = n = 0
            for c in r.a + "$":
                if c == "-":
                    n += 1
                else:
                    sizes[at] = max(sizes.get(at, 0), n)
                    at, n = at + 1, 0
        assert mine[0].common == opened_by_hand(mine[0].a.replace("-", ""), sizes.items())
        for r in mine:
            assert r.merged.replace("-", "") == r.b.replace("-", "")
            # where the pair has a letter of the common sequence, the row has the same beside it
            beside = lambda x, y: [q for p, q in zip(x, y) if p != "-"]
            assert beside(r.common, r.merged) == beside(r.a, r.b)


def test_alignment_grows_version_by_version(spark, genome, tmp_path):
    long, repeat, short = (x[: len(x) // 3] for x in genome)
    ref = long + repeat + short + comp(repeat)
    other = "".join(random.Random(9).choice("ACGT") for _ in range(len(ref)))
    one = ref[:700] + "GATTACA" + ref[700:]
    two = ref[:400] + "CC" + ref[400:2000] + ref[2010:]
    three = ref[:3000] + "TT" + ref[3000:]
    path, lost = str(tmp_path / "store"), str(tmp_path / "rejected")
    growing.start_alignments(path, spark.createDataFrame([("f", ">ref", ref), ("g", ">other", other)], "family string, header string, seq string"))
    settings = pipelines.Settings(least_block=600, least_excess=600)

    def add(*rows):
        new = spark.createDataFrame(rows, "family string, header string, seq string")
        return {r.header: r.status for r in growing.add_samples(spark, path, new, settings, lost).collect()}

    def at(version):
        return {(r.family, r.row_ord): r.seq_aln for r in growing.rows_at(spark, path, version).collect()}

    assert add(("f", ">one", one[300:] + one[:300]), ("g", ">o1", other[:50] + other[58:])) == {">one": "accepted", ">o1": "accepted"}
    first = at(1)
    assert add(("f", ">bad", other), ("g", ">o2", None), ("h", ">h", ref)) == {">bad": "rejected", ">o2": "empty", ">h": "no family"}
    assert add(("f", ">two", two)) == {">two": "accepted"}
    assert add(("f", ">three", comp(three))) == {">three": "accepted"}
    final = at(None)
    # no letter is lost, rows are equally wide, and letters of the reference stay in one column
    assert [final["f", i].replace("-", "") for i in range(4)] == [ref, one, two, three]
    assert {len(final["f", i]) for i in range(4)} == {len(ref) + 7 + 2 + 2} and len(final["g", 1]) == len(other)
    for i in (1, 2, 3):
        assert sum(a == b != "-" for a, b in zip(final["f", 0], final["f", i])) >= len(ref) - 10
    assert at(1) == first and {len(v) for (f, _), v in first.items() if f == "f"} == {len(ref) + 7}
    assert at(0) == {("f", 0): ref, ("g", 0): other}
    # each version wrote its own row only
    assert {r.version: r.n for r in spark.read.parquet(path).groupBy("version").agg(F.count("*").alias("n")).collect()} == {0: 2, 1: 2, 2: 1, 3: 1}
    kept = spark.read.parquet(lost)
    whole = growing.rows_at(spark, path, 1, kept).filter("family = 'f'").orderBy("row_ord").collect()
    assert [r.header for r in whole] == [">ref", ">one", ">bad"] and len({len(r.seq_aln) for r in whole}) == 1
    assert whole[2].seq_aln.replace("-", "") == kept.first().seq_aln.replace("-", "")


def test_inversion_ends(spark):
    rng = random.Random(41)
    rows, planted = [], {}
    for i in range(100):
        text = "".join(rng.choice("ACGT") for _ in range(4000))
        first, size = rng.randrange(50, 1500), rng.randrange(1200, 2300)
        turned = text[: first - 1] + comp(text[first - 1 : first - 1 + size]) + text[first - 1 + size :]
        if i % 2:  # with differences and a gap before the segment
            turned = "".join(rng.choice("ACGT") if rng.random() < 0.02 else c for c in turned)
            text, turned = text[:20] + "--" + text[20:], turned[:20] + "GA" + turned[20:]
        rows.append((i, text, turned))
        planted[i] = (first + 2 * (i % 2), first + 2 * (i % 2) + size - 1)
    rows += [(100, "ACGT" * 10, "ACGT" * 10), (101, "", "")]
    got = {r.i: r for r in breakpoints.inversion_ends(spark.createDataFrame(rows, "i int, cons string, new string"), ["i"]).collect()}
    near = [i for i, (a, b) in planted.items() if abs(got[i].first_place - a) <= 5 and abs(got[i].last_place - b) <= 5]
    assert len(near) >= 95
    assert got[101].first_place is None and len(got) == 102
    # by hand: the gain of every pair of ends
    for _ in range(60):
        a = "".join(rng.choice("ACGT-N") for _ in range(18))
        b = "".join(rng.choice("ACGT-") for _ in range(18))
        total = rng.randrange(2, 36)
        bare, cons = b.replace("-", ""), a.replace("-", "")
        places = [j for j, c in enumerate(b) if c != "-"]
        gain = {}
        for x in range(len(bare)):
            for y in range(x, len(bare)):
                won = sum(1 <= total - q - 1 <= len(cons) and comp(bare[q]) == cons[total - q - 2] for q in range(x, y + 1))
                gain[x + 1, y + 1] = won - sum(a[places[q]] == bare[q] for q in range(x, y + 1))
        best = max(gain.values(), default=0)
        want = min(((y, -x) for (x, y), v in gain.items() if v == best), default=None)
        assert breakpoints.best_ends(a, b, total) == ((-want[1], want[0], best) if best > 0 else None)


def test_inversion_of_a_real_size_is_undone(spark):
    rng = random.Random(136)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    long, repeat, short = part(80_500), part(21_600), part(12_762)
    ref = long + repeat + short + comp(repeat)
    turned = long + repeat + comp(short) + comp(repeat)
    assert len(ref) == 136_462
    row = pipelines.repair_inversions(spark.createDataFrame([(1, ref, turned)], "k int, cons string, new string"), "k").first()
    assert row.flipped and row.before < 0.85 and row.after == 1.0 and row.by == "breakpoints"
    assert abs(row.first - 102_101) <= 5 and abs(row.last - 114_862) <= 5 and row.seq == ref


def test_reads_for_assembly(spark):
    adapter = "AGATCGGAAGAGC"
    a, b, c = "ACGTTGCAAC", "TTGACCATGA", "GGATTACAGG"
    mates = [("s", 1, 0, a + adapter, "I" * 23), ("s", 2, 0, b, "#" + "I" * 9), ("s", 1, 1, a + adapter, "I" * 23), ("s", 2, 1, b, "I" * 10),
             ("s", 1, 2, adapter, "I" * 13), ("s", 2, 2, c, "I" * 10), ("t", 1, 0, c, "I" * 10), ("t", 2, 0, c, "#" * 10), ("t", 1, 1, c, "I" * 10)]
    df = spark.createDataFrame(mates, "sample string, mate int, read_idx int, seq string, qual string")
    got = {(r.sample, r.read_idx): (r.seq1, r.seq2, r.copies, r.route) for r in pipelines.reads_for_assembly(df, adapter).collect()}
    assert got == {("s", 0): (a, b[1:], 2, "paired"), ("s", 2): ("", c, 1, "unpaired_2"), ("t", 0): (c, "", 1, "unpaired_1")}


def test_read_through_pairs_are_cut(spark):
    rng = random.Random(61)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    behind = ("AGATCGGAAGAGCACACGTCTGAACTCCAGTCA", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT")
    rows, want = [], {}
    for i in range(150):
        n = 62 + i % 53  # pieces of 93 to 99 leave 1 to 7 bases of the adapters
        piece = part(n)
        mates = [(x + a + part(100))[:100] for x, a in ((piece, behind[0]), (comp(piece), behind[1]))]
        quals = ["I" * 100, "I" * 100]
        if i >= 60:  # errors of low quality
            for m in (0, 1):
                for j in rng.sample(range(100), 3):
                    mates[m] = mates[m][:j] + rng.choice("ACGTN") + mates[m][j + 1 :]
                    quals[m] = quals[m][:j] + "#" + quals[m][j + 1 :]
        rows.append((i, mates[0], quals[0], mates[1], quals[1]))
        want[i] = min(n, 100)
    other = part(90)
    rows += [(900, part(100), "I" * 100, part(100), "I" * 100), (901, None, None, part(50), "I" * 50), (902, "", "", "", ""), (903, other + part(10), "I" * 100, comp(other) + part(10), "I" * 100), (904, other, "I", comp(other), "I")]
    got = {r.i: r for r in pairing.clip_palindromes(spark.createDataFrame(rows, "i int, seq1 string, qual1 string, seq2 string, qual2 string"), behind).collect()}
    wrong = {i: (n, len(got[i].seq1), len(got[i].seq2)) for i, n in want.items() if not len(got[i].seq1) == len(got[i].seq2) == len(got[i].qual1) == len(got[i].qual2) == n}
    assert not wrong
    assert len(got[900].seq1) == 100 and got[901].seq1 is None and len(got[901].seq2) == 50 and got[902].seq1 == ""
    assert len(got[903].seq1) == 100 and len(got[904].seq1) == 90  # no adapter behind; too few qualities


def test_stored_alignments_are_looked_up_by_region(spark, tmp_path):
    rng = random.Random(62)
    rows = [(f"c{rng.randrange(3)}", p := rng.randrange(1, 60_000), p + rng.randrange(0, 300), i) for i in range(4000)] + [("c1", 10, 50_000, 9999), ("c9", 5, 5, 1)]
    path = str(tmp_path / "store")
    alignments.write_alignments(spark.createDataFrame(rows, "chrom string, pos long, end long, i int"), path, files=12, bin_size=1024)
    every = set(spark.read.parquet(f"{path}/rows").inputFiles())
    for chrom, start, end in (("c0", 20_000, 20_500), ("c1", 30_000, 30_010), ("c2", 1, 3), ("c9", 5, 5), ("c9", 6000, 7000), ("none", 1, 100)):
        found = alignments.read_region(spark, path, chrom, start, end)
        assert sorted(r.i for r in found.collect()) == sorted(i for c, a, b, i in rows if c == chrom and a <= end and b >= start)
        assert len(set(found.inputFiles())) <= (4 if found.count() else len(every))
    assert len(every) >= 8
    held = spark.read.parquet(f"{path}/rows").withColumn("f", F.col("_metadata.file_name")).collect()
    ranges = sorted((min((r.chrom, r.pos) for r in held if r.f == f), max((r.chrom, r.pos) for r in held if r.f == f)) for f in {r.f for r in held})
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    asked = [(f"c{k % 4}", 700 * k, 700 * k + 5000 * (k % 3), k) for k in range(60)]
    both = alignments.read_regions(spark, path, spark.createDataFrame(asked, "chrom string, start long, stop long, k int"), bin_size=1024)
    assert sorted((r.k, r.i) for r in both.collect()) == sorted((k, i) for c, s, e, k in asked for d, a, b, i in rows if c == d and a <= e and b >= s)


def test_whole_run(spark, genome, tmp_path):
    long, repeat, short = (x[: len(x) // 3] for x in genome)
    ref = long + repeat + short + comp(repeat)
    rng = random.Random(21)
    swap = {"A": "C", "C": "A", "G": "T", "T": "G"}
    true = ref[:900] + swap[ref[900]] + ref[901:]
    turned = true[1000:] + true[:1000]
    wrong = turned[:200] + swap[turned[200]] + turned[201:]  # an assembler's mistake, which the reads correct
    other = "".join(rng.choice("ACGT") for _ in range(len(ref)))
    mates = []
    for sample, text in (("a", turned), ("b", other)):
        for i, at in enumerate(range(0, len(text) - 240, 20)):
            mates += [(sample, 1, i, text[at : at + 100], "I" * 100), (sample, 2, i, comp(text[at + 140 : at + 240]), "I" * 100)]
    mates.append(("no contig", 1, 0, "ACGT" * 20, "I" * 80))
    df = spark.createDataFrame(mates, "sample string, mate int, read_idx int, seq string, qual string")
    contigs = spark.createDataFrame([("a", wrong), ("b", other), ("no reads", other)], "sample string, seq string")
    contigs = contigs.unionByName(spark.createDataFrame([("letters", "ACGT!"), ("twice", ref), ("twice", ref), ("empty", "")], "sample string, seq string")).withColumn("family", F.lit("f"))
    contigs = contigs.unionByName(spark.createDataFrame([("stray", ref, "g")], "sample string, seq string, family string"))
    df = df.unionByName(spark.createDataFrame([(x, 1, 0, "ACGT" * 20, "I" * 80) for x in ("letters", "twice", "empty", "stray")], df.schema))
    reference = spark.createDataFrame([("f", ">ref", ref)], "family string, header string, seq string")
    folder = {n: str(tmp_path / n) for n in ("store", "rejected", "records")}
    s = pipelines.Settings(least_block=600, least_excess=600)
    out = growing.run_samples(spark, df, contigs, reference, folder["store"], s, folder["rejected"])
    said = {(r.sample, r.stage): r.status for r in out.collect()}
    passed = {(x, stage): "ok" for x in "ab" for stage in ("input", "mapping", "correction")}
    wrong = {"no contig": "no contig", "no reads": "no reads", "letters": "bad letters", "twice": "several contigs", "empty": "empty contig", "stray": "no family"}
    assert said == passed | {("a", "alignment"): "accepted", ("b", "alignment"): "rejected"} | {(x, "input"): why for x, why in wrong.items()}
    assert out.filter("sample = 'a' and stage = 'correction'").first().amount == 1
    rows = growing.rows_at(spark, folder["store"]).orderBy("row_ord").collect()
    assert [(r.row_ord, r.header.split(",")[0]) for r in rows] == [(0, ">ref"), (1, ">a")]
    assert rows[1].seq_aln == true
    write_fasta(growing.rows_at(spark, folder["store"]).select("header", F.col("seq_aln").alias("seq")), folder["records"])
    records = {r.header.split(",")[0]: r.seq for r in read_fasta(spark, folder["records"]).collect()}
    assert records == {">ref": ref, ">a": true}
    kept = growing.rows_at(spark, folder["store"], 1, spark.read.parquet(folder["rejected"])).orderBy("row_ord").collect()
    assert [r.header.split(",")[0] for r in kept] == [">ref", ">a", ">b"] and kept[2].seq_aln.replace("-", "") == other


def test_seeds_are_no_rows(spark, monkeypatch):
    """What mapping writes between its steps has a few rows a read, not one for each seed (F1)."""
    rng = random.Random(401)
    written, keep = [], mapping.cut_lineage

    def counted(df):
        out = keep(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(mapping, "cut_lineage", counted)
    contigs = [(f"c{i}", "".join(rng.choice("ACGT") for _ in range(3000))) for i in range(8)]
    reads = [(i, contigs[i % 8][1][13 * i % 2800 :][:150]) for i in range(160)]
    got = mapping.map_gapped(spark.createDataFrame(reads, "id int, seq string"), spark.createDataFrame(contigs, "chrom string, seq string"), ["id"]).collect()
    assert sorted((r.id, r.chrom, r.pos, r.cigar) for r in got) == [(i, f"c{i % 8}", 13 * i % 2800 + 1, "150=") for i in range(160)]
    assert sum(written) <= 10 * len(reads)


def test_packed_seeds_vote_as_rows_would(monkeypatch):
    rng = random.Random(402)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    texts = ["", "A", part(14), part(15), part(22), "N" * 30, part(500) + "n" + part(90).lower(), "A" * 900 + part(40), part(4000), "ACGT" * 300, "ü" + part(60)]
    for text in texts:
        assert seeds.unpack_text(seeds.pack_text(text)) == (text if "n" in text or set(text) - set("ACGT") else text.upper())
    for k, w in ((15, 5), (7, 4), (4, 9)):
        row, at, code, own = seeds.minimizers_of_many(texts, k, w)
        for i, text in enumerate(texts):
            assert [x.tolist() for x in mapping.minimizers(text, k, w)] == [x[row == i].tolist() for x in (at, code, own)]
    numbers = [np.array([0, 5, -3, 1 << 40, 7]), np.arange(5), np.zeros(5, np.int64)]
    assert [x.tolist() for x in seeds.unpack_numbers(seeds.pack_numbers(*numbers))] == [x.tolist() for x in numbers]
    # votes of every pair of equal seeds, by hand; hot seeds go in parts
    k, w, size, near, buckets = 15, 5, 1024, 64, 3
    shared = part(60)
    contigs = [part(700) + shared + part(800) for _ in range(30)]
    reads = [c[i : i + 120] for i, c in enumerate(contigs)] + [shared, mapping.minimizers.__doc__, "A" * 40]
    sides = []
    for kind, some in enumerate((contigs, reads)):
        rows = pa.RecordBatch.from_pydict({"id": [(1 << 33) + 7 * i for i in range(len(some))], "packed": [seeds.pack_text(t) for t in some]})
        made = pa.Table.from_batches(seeds._seeds_packed(kind, buckets, k, w, size)(iter([rows])))
        row, *found = seeds.stretches_of_many(some, k, w, size)
        sides.append((made, [(int(rows["id"][r].as_py()), *map(int, x), len(some[r])) for r, *x in zip(row, *found)]))
        assert kind or sum(map(len, made.column("blob").to_pylist())) < 6.5 * len(row)
    want = []
    for rid, code, own, first, last, n in sides[1][1]:
        for cid, other, its, start, stop, _ in sides[0][1]:
            if code == other:
                low, high = (start - last, stop - first) if own == its else (start - (n - k - first), stop - (n - k - last))
                want += [(rid, cid, (b + 1) * 2 + (own != its)) for b in range(max((low - near) // size, -1), max((high + near) // size, -1) + 1)]
    for pairs, piece in ((1 << 20, 1000), (20, 4)):
        monkeypatch.setattr(seeds, "HOT_PAIRS", pairs)
        monkeypatch.setattr(seeds, "HOT_PART", piece)
        votes, hot = [], 0
        for p in range(buckets):
            bucket = pa.concat_tables([t.filter(pc.equal(t.column("part"), p)) for t, _ in sides])
            out = seeds._meet(k, size, near)(bucket)
            parts = out.filter(pc.equal(out.column("kind"), 1))
            hot += len(parts)
            out = [out.filter(pc.equal(out.column("kind"), 0))] + [pa.Table.from_batches([b]) for b in seeds._meet_hot(k, size, near)(iter(parts.to_batches()))]
            for blob in pa.concat_tables(out).column("blob").to_pylist():
                rid, cid, lies = seeds.unpack_numbers(blob)
                votes += zip(np.cumsum(rid).tolist(), cid.tolist(), lies.tolist())
        assert sorted(votes) == sorted(want) and (hot > 0) == (pairs == 20)


def test_pileups_by_tile(spark, monkeypatch):
    """Reads over tiles' ends, at contigs' ends and in several batches of one tile count as their observations do one by one; no base is shuffled (F2)."""
    rng = random.Random(403)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    contigs = {"c1": part(3000), "c2": part(90) + "n" + part(60).lower(), "c3": part(40)}
    rows, seen = [], {}
    for i in range(400):
        name = rng.choice(list(contigs)[:2])
        text = contigs[name].upper()
        steps, pos, read = [], rng.randrange(1, max(2, len(text) - 100)), ""
        at = pos - 1
        for step in rng.choice(("=", "S=X=", "=I=D=S", "S", "I=", "=D=X=")):
            n = rng.randrange(1, 4) if step != "=" else rng.randrange(1, 25)
            steps.append(f"{n}{step}")
            read += text[at : at + n].ljust(n, "A") if step == "=" else "" if step == "D" else "".join(rng.choice("ACGTNacgR") for _ in range(n))
            at += n * (step in "=XD")
        strand, cigar = rng.choice("+-"), "".join(steps)
        qual = "".join(chr(33 + rng.randrange(5, 40)) for _ in range(rng.choice((0, len(read) // 2, len(read), len(read) + 2))))
        rows.append((i, name, pos, strand, cigar, read.translate(mapping._COMPLEMENT)[::-1] if strand == "-" else read, qual or None))
        numbers = [ord(c) - 33 for c in qual] + [0] * (len(read) - len(qual))
        for place, bucket, quality in mapping.observe(pos, strand, cigar, read, numbers[::-1] if strand == "-" else numbers):
            if quality >= 13 and place <= len(text):
                cell = seen.setdefault((name, place), {"ref": text[place - 1]})
                cell[bucket] = cell.get(bucket, 0) + 1
    df = spark.createDataFrame(rows, "id int, chrom string, pos int, strand string, cigar string, seq string, qual string")
    table = spark.createDataFrame([*contigs.items(), ("none", None)], "chrom string, seq string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        counts = mapping.pileups(df.drop("seq", "qual"), df.select("id", "seq", "qual"), table, ["id"], tile=64)
        got = {(r.chrom, r.pos): r for r in counts.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == set(seen) and len(got) == counts.count()
    for at, cell in seen.items():
        assert got[at].ref == cell["ref"] and all(got[at][n] == cell.get(mark, 0) for n, mark in pileup.BUCKETS.items())
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 0 and "bucket" not in plan


def test_reads_stay_within_their_group(spark, monkeypatch):
    """Reads meet their own group's contigs only, as if the group were mapped alone; a large group is dealt, and no seed is a row (F3)."""
    rng = random.Random(404)
    part = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    same = part(900)
    contigs = [(g, f"{g}{i}", same if i == 0 else part(2500)) for g in "abc" for i in range(3)] + [("d", "d0", None), ("e", "e0", part(800))]
    reads = []
    for g, count in (("a", 150), ("b", 30), ("c", 5), ("d", 4), ("f", 4)):
        for i in range(count):
            text = rng.choice([t for h, _, t in contigs if h == (g if g in "abc" else "a")])
            at = rng.randrange(0, len(text) - 130)
            s = text[at : at + 60] + part(i % 3) + text[at + 60 + i % 2 : at + 125]
            reads.append((g, i, comp(s) if i % 4 == 0 else s))
    df = spark.createDataFrame(reads, "grp string, id int, seq string")
    table = spark.createDataFrame(contigs, "grp string, chrom string, seq string")
    monkeypatch.setattr(mapping, "GROUP_READS", 40)
    names = ["grp", "id", "chrom", "pos", "strand", "cigar", "score"]
    written, keep = [], mapping.cut_lineage
    monkeypatch.setattr(mapping, "cut_lineage", lambda frame: written.append(frame.count()) or keep(frame))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 23)
    try:
        got = sorted(tuple(r[n] for n in names) for r in mapping.candidate_places(df, table, ["grp", "id"], within=("grp",)).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(written) <= len({g for g, _, _ in reads})
    want = []
    for g in "abc":
        alone = mapping.candidate_places(df.filter(F.col("grp") == g), table.filter(F.col("grp") == g), ["grp", "id"])
        want += [tuple(r[n] for n in names) for r in alone.collect()]
    assert got == sorted(want) and {x[0] for x in got} == set("abc")


def test_pairs_find_best_places_once(spark, monkeypatch):
    """Reads' best places, which three steps of the pairs need, are ranked once (F4)."""
    rng = random.Random(405)
    contig = "".join(rng.choice("ACGT") for _ in range(3000))
    reads = [(i, m, contig[a : a + 100] if m == 1 else comp(contig[a + 200 : a + 300])) for i in range(30) for a in [40 + 80 * i] for m in (1, 2)]
    df = spark.createDataFrame(reads, "id int, mate int, seq string")
    table = spark.createDataFrame([("c", contig)], "chrom string, seq string")
    places = mapping.candidate_places(df, table, ["id", "mate"]).cache()
    ranked, rank = [], mapping.best_places
    monkeypatch.setattr(mapping, "best_places", lambda some, *rest: ranked.append(some is places) or rank(some, *rest))
    got = mapping.pair_places(places, df, table, ["id"]).collect()
    assert {(r.id, r.mate, r.pos, r.proper, r.size) for r in got} == {(i, m, 41 + 80 * i + 200 * (m == 2), True, 300) for i in range(30) for m in (1, 2)}
    assert sum(ranked) == 1
