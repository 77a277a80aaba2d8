"""Personal data, hard negatives and the fill-in-middle transformation against brute force."""

import hashlib
import math
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thylakoid.llm import fill_in_middle as fim
from thylakoid.llm import personal_data as pii
from thylakoid.llm.hard_negatives import SubsetSums, _planes, _values, hard_negatives

# --- personal data -----------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and odd % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], [*PATTERNS].index(s[0])))


NUMBERS = ["4524132264652876", "4524 1322 6465 2876", "378282246310005", "3782 822463 10005", "+1 (269) 555-3296", "10.0.0.255", "1.2.3.4.5.6.7.8.9", "999.1.2.3", "+49-30-1234567", "a.b@c-d.e", "x@y@z.org", "@", "+", ".", "-", " ", "ä", "0", "7 ", "12.", "a@b", "\n"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(NUMBERS), max_size=14).map("".join) | st.text("a.@+-0159 ()é", max_size=40))
def test_base_spans_equal_the_patterns(text):
    base, more = pii.find(text)
    assert base == base_by_hand(text)
    assert not set(base) & set(more) and all(0 <= a < b <= len(text) for _, a, b in more)


def kinds(text):
    return [(k, text[a:b]) for k, a, b in pii.find(text)[1]]


def test_further_spans():
    assert kinds("call +1 (269) 555-3296 4524132264652876 now") == [("phone", "+1 (269) 555-3296"), ("card", "4524132264652876")]
    assert kinds("12 4524132264652876 33") == [("card", "4524132264652876")]
    assert kinds("7 4524 1322 6465 2876 1") == [("card", "4524 1322 6465 2876")]
    assert kinds("tel:030-123456789 and hotel:0301234567890") == [("phone", "030-123456789")]
    assert kinds("ftp://me.x:s3cret@files.example.com/a") == [("login", "me.x:s3cret@files.example.com")]
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00 AND SO ON") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert kinds("iban DE89 3704 0044 0532 0130 01") == []
    assert kinds("Account no. 12345678, accounts 12345678") == [("account", "12345678")]
    assert kinds("ssn 123-45-6789") == [("account", "123-45-6789")]
    assert kinds("version 1.2.3.4.5 of 2024-01-01, http://example.com/a@b:c") == []


def test_personal_data_rows(spark):
    long = "wort " * 200_000 + "a@b.cd " + "9" * 3_000 + "@" * 1000
    texts = [None, "", "mail a@b.cd, b@c.de", "é a@b.cd", long, "mail a@b.cd, b@c.de", "x"]
    ids = [1, 2, 3, None, 5, 3, 3]
    rows = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumn("base", F.lit("clash")).withColumn("id", F.lit(0)).withColumn("row", F.lit(0))
    got = pii.find_personal_data(rows, carry=True)
    held = [(r.doc_id, r.n_email, [tuple(s) for s in r.spans], r.redacted, r.row.base, r.row.text) for r in got.collect()]
    assert sorted(((i, t) for i, *_, t in held), key=str) == sorted(zip(ids, texts), key=str)
    for i, n, spans, redacted, clash, text in held:
        assert clash == "clash" and spans == base_by_hand(text or "") and n == sum(s[0] == "email" for s in spans)
        assert redacted == (re.sub(PATTERNS["email"], "<email>", text) if text else text)
    assert pii.find_personal_data(rows.limit(0)).count() == 0
    text = got.filter("doc_id = 3 and n_email = 2").select(pii.joined("spans").alias("s")).first().s
    assert text == "email:5:11,email:13:19"


# --- hard negatives ----------------------------------------------------------------------------


def mined_by_hand(rows, is_anchor, positives=5, negatives=3, least=50, most=95):
    kept = {}
    for i, label, vector in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            q = tuple(math.floor(256 * x) for x in vector)
            kept.setdefault((i, label, q), None)
    out = []
    for i, label, q in kept:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, p)), j, other) for j, other, p in kept if len(p) == len(q) and (j, other, p) != (i, label, q))
        for minus, j, other in [s for s in scored if s[2] == label and s[1] != i][:positives]:
            fits = [(s, k) for s, k, o in scored if o != label and 50 * -minus <= 100 * -s <= 95 * -minus]
            out += [(i, j, n + 1, k, -minus, -s) for n, (s, k) in enumerate(fits[:negatives])]
    return sorted(out)


def test_planes_and_subset_sums_are_exact():
    rng = np.random.default_rng(3)
    for dims, most in ((1, 3), (8, 200), (13, 5000), (64, 1 << 20)):
        x, y = rng.integers(-most, most, (7, dims)), rng.integers(-most, most, (11, dims))
        bits = int(most).bit_length() + 1
        assert (_values(_planes(x, bits))[:, :dims] == x).all()
        assert (SubsetSums(_values(_planes(x, bits)), bits).scores(_planes(y, bits)) == y @ x.T).all()


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    near = rng.standard_normal((6, 12))
    rows = [(i, int(rng.integers(0, 4)), [float(np.float32(v)) for v in (near[rng.integers(0, 6)] + 0.3 * rng.standard_normal(12)) / 3]) for i in range(300)]
    rows += [(i + 300, 1, rows[10][2]) for i in range(40)]  # one vector of many rows
    rows += [(50, 2, rows[7][2]), (50, 2, rows[7][2]), (8, 3, rows[9][2]), (60, 0, rows[60][2]), rows[4], rows[4]]
    rows += [(350, 1, None), (400, None, rows[3][2]), (None, 1, rows[3][2]), (450, 1, [None] * 12), (500, 1, [float("nan")] * 12), (550, 1, [float("inf")] * 12)]
    rows += [(600, 1, []), (601, 1, []), (602, 2, []), (650, 1, [0.0] * 12), (700, 0, [1.0] * 5), (701, 0, [1.0] * 5), (702, 1, [0.7] * 5), (800, 1, [1e30] * 5), (-50, 1, [-0.5] * 12)]
    table = spark.createDataFrame(rows, "vec_id long, embedding_label int, embedding array<double>".replace("embedding_label", "label")).withColumn("row", F.lit("clash")).withColumn("score", F.lit(0))
    expected = mined_by_hand([r for r in rows if r[0] != 800], lambda i: i % 50 == 0)
    for cells in ({}, {"anchors_a_cell": 3, "cell_rows": 40}):
        got = sorted(tuple(r) for r in hard_negatives(table, F.col("vec_id") % 50 == 0, **cells).collect())
        assert got == expected and len(got) > 50
    assert hard_negatives(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives(table.filter("vec_id = 1"), F.col("vec_id") % 50 == 0).count() == 0


# --- fill in the middle ------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@settings(max_examples=500, deadline=None)
@given(st.text("ab \t\n\x0b\x0c\r\x08\x0e\x1f\x00\x7f!é漢\U0001f600\x85\xa0", max_size=60))
def test_units_equal_the_pattern(text):
    found, units = UNIT.findall(text), fim.Units(text.encode())
    assert units.count == len(found)
    assert [units.end(k) for k in range(len(found) + 1)] == [len("".join(found[:k]).encode()) for k in range(len(found) + 1)]


def fim_by_hand(text, doc_id):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    units = UNIT.findall(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or h[2] % 100 >= 50 or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_rows(spark):
    texts = [None, "", " ", "one", "two <P> marks <", "é漢 x  y\n\n", "a <S", "M> <P b < <", ("wort é\n" * 90_000), "same", "same"]
    rows = [(i * 100 + j, t) for i, t in enumerate(texts) for j in range(12)] + [(7, "again"), (7, "again"), (7, "other"), (None, "null id"), (None, None), (-3, "minus three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("output", F.lit("clash")).withColumn("n", F.lit("clash")).withColumn("id", F.lit(1))
    got = [(r.doc_id, r.row.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fim.fill_in_middle(docs, carry=True).collect()]
    assert sorted(got, key=str) == sorted([(i, t, *fim_by_hand(t, i)) for i, t in rows], key=str)
    assert {g[3] for g in got} == {"plain", "psm", "spm"}
    for r in fim.fill_in_middle(docs, texts=False, carry=True).collect():
        assert r.restored_sha256 == hashlib.sha256((r.row.text or "").encode()).hexdigest()
        assert r.output_sha256 == hashlib.sha256(fim_by_hand(r.row.text, r.doc_id)[-1].encode()).hexdigest()
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
