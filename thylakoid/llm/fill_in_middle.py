"""Fill-in-middle transformation: unit borders by arithmetic on words of eight bytes (operator 13)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import carried, map_texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 documents those that are transformed, and of 100 of these those whose suffix comes first.
FIM_RATE, SPM_RATE, SEED = 50, 80, 42
#: Words of eight bytes that are marked at a time.
BLOCK = 1 << 16

_ONES = np.uint64(0x0101010101010101)
_HIGH, _LOW = _ONES << np.uint64(7), _ONES * np.uint64(0x7F)
_BYTE, _TOP = np.uint64(8), np.uint64(56)


def _spaces(x: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is one of space, tab, line ends, vertical tab and form feed."""
    low = x & _LOW
    # sums of bytes below 128 stay in their byte; the high bit tells that the bound was reached
    from_9, from_14 = low + _ONES * np.uint64(128 - 9), low + _ONES * np.uint64(128 - 14)
    not_space = (low ^ (_ONES * np.uint64(0x20))) + _LOW
    return ((from_9 & ~from_14) | ~not_space) & ~x & _HIGH


def _ends(x: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The high bit of each byte of words that ends a unit: no space, and a space follows."""
    space = _spaces(x)
    follows = (space >> _BYTE) | (_spaces(after) << _TOP)
    return ~space & follows & _HIGH


class Units:
    """The units of one text: runs of other characters with the white space before them, and white space at the end.

    Bytes are words of eight, padded with spaces, so a unit's end is a byte that is no space before one that
    is. Kept are the ends of each word, as counts; the marks are made again where a cut is looked up.
    """

    def __init__(self, text: bytes):
        self.size = len(text)
        padded = text + b" " * (8 + -len(text) % 8)
        self.words = np.frombuffer(padded, "<u8")
        n = len(self.words) - 1
        counts = np.zeros(n, np.uint8)
        for i in range(0, n, BLOCK):
            counts[i : i + BLOCK] = np.bitwise_count(_ends(self.words[i : min(n, i + BLOCK)], self.words[i + 1 : min(n, i + BLOCK) + 1]))
        self.upto = np.cumsum(counts, dtype=np.int64)
        found = int(self.upto[-1]) if n else 0
        self.tail = self.size > 0 and text[-1:].isspace()
        self.count = found + self.tail

    def end(self, k: int) -> int:
        """Bytes of the first ``k`` units."""
        if k == 0:
            return 0
        if k == self.count:
            return self.size
        word = int(np.searchsorted(self.upto, k))
        marks = _ends(self.words[word : word + 1], self.words[word + 1 : word + 2]) >> np.uint64(7)
        rank = k - (int(self.upto[word - 1]) if word else 0)
        # byte i of the product counts the marks up to byte i; bytes that count fewer lie before the end
        running = (marks * _ONES).view(np.uint8)
        return 8 * word + int(np.count_nonzero(running < rank)) + 1


def _letters(part: bytes) -> int:
    """Code points: bytes that don't continue one."""
    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits from the SHA-256 of ``seed:id``; a null id counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transform(text: bytes, doc_id: int | None, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> dict:
    """One document's parts and output; see ``fill_in_middle``."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    units = Units(text)
    out = {"n": units.count, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    if not text or h3 % 100 >= fim_rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return out
    first, second = sorted((h1 % (units.count + 1), h2 % (units.count + 1)))
    a, b = units.end(first), units.end(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    spm = h4 % 100 < spm_rate
    parts = [SUFFIX, suffix, PREFIX, prefix] if spm else [PREFIX, prefix, SUFFIX, suffix]
    return out | {"form": "spm" if spm else "psm", "prefix_chars": _letters(prefix), "middle_chars": _letters(middle), "output": b"".join([*parts, MIDDLE, middle])}


def restore(output: bytes, form: str) -> bytes:
    """The text that an output of this form was made from."""
    if form == "plain":
        return output
    rest, middle = output.split(MIDDLE)
    if form == "spm":
        suffix, prefix = rest.removeprefix(SUFFIX).split(PREFIX)
    else:
        prefix, suffix = rest.removeprefix(PREFIX).split(SUFFIX)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, carry: bool = False) -> DataFrame:
    """Documents cut at two unit borders and written as prefix, suffix and middle for infilling.

    Returns one row per document row: the id column, ``n`` (units), ``form`` (``plain``, ``psm`` or ``spm``),
    ``prefix_chars`` and ``middle_chars`` (null if plain), ``output_sha256`` and ``restored_sha256`` (of what
    ``restore`` makes of the output), with ``texts`` also ``output``, and with ``carry`` the input row as the
    struct ``row``; other columns aren't read. The cuts and the form depend on the seed and the id only.

    Null and empty texts have no units and are plain; so is a text that holds a marker. A null id draws like
    an empty one. Repeated rows have equal results, rows that repeat an id with another text their own. Texts
    of any length are cut whole; nothing is shuffled.
    """

    def run(batch: pa.RecordBatch) -> dict:
        made = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one = transform(text.encode() if text else b"", doc_id, seed, fim_rate, spm_rate)
            one["output_sha256"] = hashlib.sha256(one["output"]).hexdigest()
            one["restored_sha256"] = hashlib.sha256(restore(one["output"], one["form"])).hexdigest()
            if not texts:
                one.pop("output")
            made.append(one)
        out = {n: pa.array([one[n] for one in made], kind) for n, kind in arrow.items() if n != "output"}
        if texts:
            out["output"] = pa.array([one["output"].decode() for one in made], pa.string())
        return out | {"id": batch.column(0)} | ({"row": batch.column(2)} if carry else {})

    arrow = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output_sha256": pa.string(), "restored_sha256": pa.string()}
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carried(docs, carry))
    kinds = dict(whole.dtypes)
    schema = {"id": kinds["id"], "n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output_sha256": "string", "restored_sha256": "string"}
    schema |= {"output": "string"} if texts else {}
    schema |= {"row": kinds["row"]} if carry else {}
    return map_texts(whole, run, schema).withColumnRenamed("id", id_col)
