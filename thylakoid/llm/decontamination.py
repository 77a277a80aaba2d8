"""Benchmark decontamination with an Aho-Corasick automaton over word windows (operator 2)."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import bytes_of, carried, chunks, partitions_for

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(lowered(text))


def lowered(text: str) -> str:
    """A-Z in lower case and nothing else, so places stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


#: Benchmark text that one automaton holds, and so what is broadcast at a time.
SHARD_BYTES = 8 << 20
WINDOW = 13


class Windows:
    """The automaton over the word windows of some benchmark items; words are numbers."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        import ahocorasick

        self.ids: dict[str, int] = {}
        held: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if words:
                for i in range(max(1, len(words) - window + 1)):
                    held.setdefault(tuple(words[i : i + window]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, owners in held.items():
            self.automaton.add_word(words, (len(words), owners))
        self.empty = not held
        if held:
            self.automaton.make_automaton()

    def scan(self, words: list[str]) -> tuple[np.ndarray | None, set[str]]:
        """Which words lie in an occurrence of a window, and the items whose windows occur."""
        get = self.ids.get
        numbers = tuple([get(w, 0) for w in words])
        if self.empty or not words:
            return None, set()
        cover, items = None, set()
        for end, (size, owners) in self.automaton.iter(numbers):
            if cover is None:
                cover = np.zeros(len(words) + 1, np.int64)
            cover[end - size + 1] += 1
            cover[end + 1] -= 1
            items |= owners
        return None if cover is None else np.cumsum(cover[:-1]) > 0, items


_built: dict[str, Windows] = {}


def _automaton(key: str, shard, window: int) -> Windows:
    """The automaton of a broadcast shard; a worker keeps the last one."""
    if key not in _built:
        _built.clear()
        _built[key] = Windows(shard.value, window)
    return _built[key]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES, offsets: bool = True, carry: bool = False) -> DataFrame:
    """Words of each document that lie in a word window of a benchmark item.

    Words are runs of digits, ASCII letters (lower-cased) and characters from U+0080. A window is
    ``window`` consecutive words of an item, or the whole item if it has fewer (and at least one).

    Returns one row per document row: the id column, ``n_words``, ``n_hit`` (words in any occurrence
    of a window), ``items`` (sorted ids, as strings, of items with occurring windows), ``spans`` (runs
    of hit words, by word), ``text_spans`` (the same runs as character offsets into the original text,
    end exclusive; null unless ``offsets``). Null and empty texts have no words. Items with a null id
    or text, or without words, have no windows; equal items all count. With ``carry``, the whole input
    row comes along as the struct ``row``; else other columns aren't read. Repeated rows and null ids stay.

    The benchmark goes to the executors in shards of about ``shard_bytes`` of text, so what is
    broadcast is bounded whatever the benchmark's size; with more than one, the documents pass
    through one scan a shard, which adds to the spans found so far.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).dropna()
    n = partitions_for(bytes_of(items, "text"), shard_bytes)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(None).cast(_WORD_SPANS).alias("spans"), F.lit(None).cast("array<string>").alias("items"), *carried(docs, carry))
    for k in range(n):
        rows = items if n == 1 else items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        shard = spark.sparkContext.broadcast([(r.item, r.text) for r in rows.toLocalIterator()])
        found = _scan(found, shard, window, k == n - 1, offsets)
    return found.withColumnRenamed("id", id_col)


_WORD_SPANS, _TEXT_SPANS = "array<struct<first: int, last: int>>", "array<struct<start: int, end: int>>"


def _scan(found: DataFrame, shard, window: int, last: bool, offsets: bool) -> DataFrame:
    """Add one shard's hits; the last scan counts words and maps spans to offsets."""
    key = uuid.uuid4().hex

    def run(batches):
        windows = _automaton(key, shard, window)
        for whole in batches:
            for batch in chunks(whole, 1):
                out: dict[str, list] = {n: [] for n in ("n_words", "n_hit", "spans", "items", "text_spans")}
                for text, had, held in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                    words = words_of(text) if text else []
                    hit, owners = windows.scan(words)
                    spans = merged(_spans(hit), had)
                    out["spans"].append(spans)
                    out["items"].append(sorted(owners.union(held or ())))
                    if last:
                        at = [m.span() for m in WORD.finditer(lowered(text))] if spans and offsets else []
                        out["n_words"].append(len(words))
                        out["n_hit"].append(sum(s["last"] - s["first"] + 1 for s in spans))
                        out["text_spans"].append([{"start": at[s["first"]][0], "end": at[s["last"]][1]} for s in spans] if offsets else None)
                arrays = {n: pa.array(v, _ARROW[n]) for n, v in out.items() if n in schema} | {n: batch.column(n) for n in kept}
                yield pa.RecordBatch.from_pydict({n: arrays[n] for n in schema})

    kinds = dict(found.dtypes)
    kept = [n for n in ("id", "text", "row") if n in kinds and not (last and n == "text")]
    schema = {n: kinds[n] for n in kept} | {"spans": _WORD_SPANS, "items": "array<string>"}
    if last:
        schema |= {"n_words": "long", "n_hit": "long", "text_spans": _TEXT_SPANS}
    return found.mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in schema.items()))


_ARROW = {
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "spans": pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
    "items": pa.list_(pa.string()),
    "text_spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
}


def _spans(hit: np.ndarray | None) -> list[dict]:
    if hit is None:
        return []
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False]))
    return [{"first": a, "last": b} for a, b in zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())]


def merged(spans: list[dict], more: list[dict] | None) -> list[dict]:
    """Two lists of word runs as one list of maximal runs."""
    if not more:
        return spans
    out: list[dict] = []
    for s in sorted([*spans, *more], key=lambda s: s["first"]):
        if out and s["first"] <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], s["last"])
        else:
            out.append(dict(s))
    return out


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """A twentieth of the words, one at least."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
