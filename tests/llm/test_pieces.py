"""Encoding, decoding and counting against the library, on awkward texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from thylakoid.llm.pieces import LONG_WORD, PieceModel, encode_decode
from thylakoid.llm.token_counts import JsonCounter, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return PieceModel(MODEL)


def texts():
    rng = random.Random(3)
    fixed = ["", " ", "  ", " a", "a ", "\n", "\n a\n\nb", "▁x ▁▁", "é世界 \U0001f600 <s></s> <0x41>", "\x00\t\ty", "x" * (LONG_WORD + 50), " " * (LONG_WORD + 9), "=" * 700 + "ab" * 400]
    made = ["".join(rng.choice("abcdefgh  \n\té世▁.,-=01") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return fixed + made + ["".join(rng.choice("the ing on er_  ") for _ in range(rng.randint(0, 80))) for _ in range(400)]


def test_ids_and_decoding_equal_the_library(library, pieces):
    for text, raw in zip(texts(), pieces.encode_batch(texts())):
        ids = np.frombuffer(raw, "<u4").astype(np.int64)
        assert ids.tolist() == [library.bos_id(), *library.encode(text), library.eos_id()], repr(text)
        assert pieces.decode(ids) == library.decode(ids.tolist())


def test_decoding_of_any_ids(library, pieces):
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(260) for _ in range(rng.randint(0, 12))]
        assert pieces.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_frames(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, ""), (4, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).withColumn("ids", F.lit(0))
    out = {(r.doc_id, r.ids_sha256): r for r in encode_decode(docs, MODEL).collect()}
    assert len(out) == 5 and encode_decode(docs, MODEL).count() == 6
    null = next(r for k, r in out.items() if k[0] == 2)
    assert null.n_tokens == 2 and null.decoded == "" and null.decoded_sha256 == hashlib.sha256(b"").hexdigest()
    long = next(r for k, r in out.items() if k[0] == 4)
    assert long.n_tokens == len(library.encode("word " * 30_000)) + 2 and long.decoded == library.decode(library.encode("word " * 30_000))
    assert encode_decode(docs.limit(0), MODEL).count() == 0


def test_counts(spark, library):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (7, "a"), (7, "a"), (8, "tok " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit("clash"))
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, MODEL).collect())
    want = sorted((i is None, i, len((t or "").encode()), n, n > 4096) for i, t in rows for n in [len(library.encode(t or ""))])
    assert got == want
    assert token_counts(docs.limit(0), MODEL).count() == 0


def test_counts_of_a_json_vocabulary():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    some = ["hello world", "", "<|endoftext|> x", "é" * 50]
    assert JsonCounter(path).count([*some, None]) == [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in some] + [0]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_json_counts_of_long_texts_in_parts(name):
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path(name), random.Random(6)
    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    made = ["".join(rng.choice(["the", "ing", " ", "  ", " a", "\n", "\u00a0", "é", "1", "'s", "<|endoftext|>", "世", "-", "\t"]) for _ in range(300)) for _ in range(200)]
    some = [*made, "word " * 40_000, "x" * 70_000, " " * 500]
    want = [len(whole.encode(t, add_special_tokens=False).ids) for t in some]
    for part in (1, 7, 1 << 16):
        counter = JsonCounter(path, part)
        assert counter.count(some) == want
    cut = name.startswith("byte")
    assert (len([*JsonCounter(path)._cut("word " * 40_000)]) > 1) == cut and (len([*JsonCounter(path, 1)._cut("a b c")]) == 3) == cut
