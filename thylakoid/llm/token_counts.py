"""Token counts with a public tokenizer's library (operator 5)."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from thylakoid.llm.common import map_texts
from thylakoid.llm.pieces import SPACE, remember, split_words

#: Distinct words whose lengths a worker remembers.
CACHE_WORDS = 400_000
#: Bytes of text that go to the library in one call.
BATCH_BYTES = 1 << 20
_between_words = re.compile("(?<=[0-9A-Za-z]) (?=[A-Za-z])")


class PieceCounter:
    """Lengths from the sentencepiece library.

    Texts are cut before runs of spaces and around line ends where the vocabulary shows that no piece
    spans such a place, so the counts of the parts add up to that of the whole. Each part goes to the
    library behind a line end, whose own tokens are taken off: so the library's dummy space never
    touches it.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        spans = any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces)
        # an encoding of spaces and line ends one by one shows that the model doesn't normalise them away
        self.whole = spans or self.library.encode(f" \n{SPACE} ") != self.library.encode(f"{SPACE}\n  ") or len(self.library.encode("\n\n")) != 3
        self.lead = len(self.library.encode("\n"))
        self.cache: dict[str, int] = {}

    def _lengths(self, words: list[str]) -> list[int]:
        out: list[int] = []
        rest = iter(words)
        ahead = next(rest, None)
        while ahead is not None:  # batches of about the same bytes
            batch, held = [], 0
            while ahead is not None and (not batch or held + len(ahead) < BATCH_BYTES):
                batch.append("\n" + ahead)
                held += len(ahead)
                ahead = next(rest, None)
            out += [len(ids) - self.lead for ids in self.library.encode(batch, num_threads=1)]
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        if self.whole:
            return [len(ids) for ids in self.library.encode([t or "" for t in texts], num_threads=1)]
        cut = [split_words(t) for t in texts]
        remember(self.cache, cut, self._lengths, CACHE_WORDS)
        return [sum(map(self.cache.__getitem__, words)) for words in cut]


class JsonCounter:
    """Lengths from the tokenizers library, in batches of about the same bytes.

    Texts over ``part`` letters are cut before a space between an ASCII letter or digit and an ASCII letter,
    where byte-level pre-tokenization always starts a new word, so the counts of the parts add up to that of
    the whole. With a normalizer, another pre-tokenizer, or added tokens that hold or take in spaces, texts
    stay whole; so does a stretch without such a place.
    """

    def __init__(self, path: str, part: int = 1 << 16):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cache: dict = {}
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        words = spec["pre_tokenizer"] or {}
        plain = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words["add_prefix_space"]
        loose = any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
        self.part = part if plain and not loose and not spec["normalizer"] else None

    def _cut(self, text: str) -> Iterator[str]:
        start = 0
        while self.part and len(text) - start > self.part and (space := _between_words.search(text, start + self.part)):
            yield text[start : space.start()]
            start = space.start()
        yield text[start:]

    def count(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        batch: list[tuple[int, str]] = []
        held = 0
        for at, text in enumerate(texts):
            for part in self._cut(text or ""):
                batch.append((at, part))
                held += len(part.encode())
                if held >= BATCH_BYTES:
                    self._add(batch, out)
                    batch, held = [], 0
        self._add(batch, out)
        return out

    def _add(self, batch: list[tuple[int, str]], out: list[int]) -> None:
        for (at, _), found in zip(batch, self.library.encode_batch([part for _, part in batch], add_special_tokens=False)):
            out[at] += len(found.ids)


_counters: dict[str, object] = {}


def counter(path: str):
    """The counter for a vocabulary file, once for each worker: ``.model`` or ``.json``."""
    if path not in _counters:
        _counters[path] = PieceCounter(path) if path.endswith(".model") else JsonCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, without added special tokens.

    Returns one row per input row: the id column, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than
    ``limit`` tokens). A null or empty text has no bytes and no tokens. Other columns are not read;
    repeated rows and null ids are kept as they are.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> dict:
        tokens = counter(model_path).count(batch.column(1).to_pylist())
        return {
            id_col: batch.column(0),
            "n_bytes": pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
        }

    return map_texts(docs.select(id_col, text_col), run, {id_col: kind, "n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}, after=lambda: counter(model_path).cache.clear())
