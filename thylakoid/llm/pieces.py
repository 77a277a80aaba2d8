"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 3).

Text is cut where no vocabulary piece can span (before a run of spaces, around line ends), so
merges never cross a cut. The distinct words of a batch are laid out as one flat symbol array;
each round finds the lowest pair rank of every word, merges its leftmost occurrences and compacts
the arrays, until no word has a pair left.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from thylakoid.llm.common import map_texts

SPACE = "▁"
NO_RANK = np.iinfo(np.int32).max
#: Words of more symbols are merged through a queue, in the same order: rounds would be as many as symbols.
LONG_WORD = 512
#: Distinct words whose ids a worker remembers.
CACHE_WORDS = 300_000
#: Words whose symbols are merged together: their arrays stay in the processor's cache.
GROUP_WORDS = 30_000
_spaced = re.compile(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*")


def split_words(text: str | None) -> list[str]:
    """Words with the separator before them: a line end is kept, one space is implied, more are spelled out.

    Only for vocabularies without pieces that hold a line end, or a space after something else.
    """
    if not text:
        return []
    if text[0] == " " or "  " in text or SPACE in text:
        return _spaced.findall(SPACE + text.replace(" ", SPACE))
    return text.replace("\n", " \n").split(" ")


def spelled(word: str) -> str:
    """The word with its space, if that was implied."""
    return word if word[:1] in (SPACE, "\n") and word else SPACE + word


def remember(cache: dict, cut: list[list[str]], compute, most: int) -> None:
    """Give every word in ``cut`` an entry; when the cache is full, only these words stay."""
    wanted = set().union(*cut)
    new = [w for w in wanted if w not in cache]
    if len(cache) + len(new) > most:
        kept = {w: cache[w] for w in wanted if w in cache}
        cache.clear()
        cache.update(kept)
    if new:
        cache.update(zip(new, compute([*map(spelled, new)])))


class PieceModel:
    """A BPE model with byte fallback, as arrays."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if train.model_type != train.BPE or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or kinds & {4, 5}:
            raise ValueError("only BPE models with byte fallback, identity normalisation and a dummy prefix are supported")
        self.pieces = [p.piece for p in model.pieces]
        self.bos, self.eos, self.unk = train.bos_id, train.eos_id, train.unk_id
        self.byte_ids = np.zeros(256, np.int64)
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece spans a space, so words can't be told apart")
        if any("\n" in p for p in normal):
            raise ValueError("a piece holds a line end, so lines can't be told apart")

        symbols = dict(normal)  # a character that is in pieces but is none itself can still be merged
        for p in normal:
            for c in p:
                symbols.setdefault(c, len(self.pieces) + len(symbols))
        width = max(symbols.values()) + 1
        levels = {s: r for r, s in enumerate(sorted({-p.score for p in model.pieces if p.type == 1}))}
        rank = {p: levels[-model.pieces[i].score] for p, i in normal.items()}
        keys, ranks, merged, touchy = [], [], [], np.zeros(width, bool)
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is None or b is None:
                    continue
                keys.append(a * width + b)
                ranks.append(rank[p])
                merged.append(i)
                for part, at in ((p[:k], a), (p[k:], b)):
                    touchy[at] |= part in rank and len(part) > 1 and rank[p] <= rank[part]
        self.width = width
        self.pairs = {k: (r, m) for k, r, m in zip(keys, ranks, merged)}
        self.slots = np.full(1 << max(10, len(keys).bit_length() + 2), -1)  # open addressing
        self.slot_rank, self.slot_makes = np.full(len(self.slots), NO_RANK, np.int32), np.full(len(self.slots), -1, np.int32)
        for at, (k, (r, m)) in zip(self._slot(np.array([*self.pairs])).tolist(), self.pairs.items()):
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at], self.slot_rank[at], self.slot_makes[at] = k, r, m
        self.touchy = touchy  # after making such a symbol, a pair of no higher rank may appear beside it
        chars = {ord(s): i for s, i in symbols.items() if len(s) == 1}
        self.chars = np.array(sorted(chars), np.uint32)
        self.char_ids = np.array([chars[c] for c in self.chars.tolist()])
        self.is_piece = np.zeros(width, bool)
        self.is_piece[list(normal.values())] = True

        spoken = []
        for p in model.pieces:
            if p.type == 1:
                spoken.append(p.piece.replace(SPACE, " ").encode())
            elif p.type == 6:
                spoken.append(bytes([int(p.piece[3:5], 16)]))
            else:
                spoken.append(" ⁇ ".encode() if p.type == 2 else b"")
        self.flat = np.frombuffer(b"".join(spoken), np.uint8)
        self.lengths = np.array([len(s) for s in spoken])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.silent = np.array([p.type == 3 for p in model.pieces])
        self.is_byte = np.array([p.type == 6 for p in model.pieces])
        self.cache: dict[str, bytes] = {}

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair and the symbol it makes; no rank where the vocabulary lacks it."""
        key = np.where((left < 0) | (right < 0), np.int64(1) << 60, left * self.width + right)
        at = self._slot(key)
        found = self.slots[at]
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.slots)
            found = self.slots[at[open_]]
            open_ = open_[(found != key[open_]) & (found >= 0)]
        return self.slot_rank[at], self.slot_makes[at]

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        sym = np.where(self.chars[at] == code, self.char_ids[at], -1)
        code = code.astype(np.int64)
        word = np.repeat(np.arange(len(words)), size)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        long = size > LONG_WORD
        if long.any():
            for w in np.flatnonzero(long):
                mine = slice(*np.searchsorted(word, (w, w + 1)))
                s, c = self._queue(sym[mine], code[mine])
                done.append((np.full(len(s), w), s, c))
            keep = ~long[word]
            sym, code, word = sym[keep], code[keep], word[keep]

        rank = np.full(len(sym), NO_RANK, np.int32)  # of the pair that starts here
        makes = np.full(len(sym), -1)
        if len(sym) > 1:
            rank[:-1], makes[:-1] = self._rank(sym[:-1], sym[1:])
            apart = np.flatnonzero(word[:-1] != word[1:])
            rank[apart], makes[apart] = NO_RANK, -1
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[first, len(sym)])
            lowest = np.minimum.reduceat(rank, first)
            if (over := lowest == NO_RANK).any():
                rest = np.repeat(~over, count)
                done.append((word[~rest], sym[~rest], code[~rest]))
                sym, code, word, rank, makes = sym[rest], code[rest], word[rest], rank[rest], makes[rest]
                continue
            pick = np.flatnonzero(rank == np.repeat(lowest, count))
            owner = word[pick]
            start = np.r_[True, owner[1:] != owner[:-1]]
            group = np.cumsum(start) - 1
            unsafe = np.bincount(group, self.touchy[makes[pick]]) > 0
            run = np.flatnonzero(np.r_[True, pick[1:] != pick[:-1] + 1])  # neighbours overlap: every other one
            nth = np.arange(len(pick)) - np.repeat(run, np.diff(np.r_[run, len(pick)]))
            pick = pick[np.where(unsafe[group], start, nth % 2 == 0)]
            sym[pick] = makes[pick]
            keep = np.ones(len(sym), bool)
            keep[pick + 1] = False
            new = pick - np.arange(len(pick))  # where the merged symbols are after compaction
            sym, code, word, rank, makes = sym[keep], code[keep], word[keep], rank[keep], makes[keep]
            beside = np.zeros(len(sym), bool)
            beside[new] = True
            beside[new[new > 0] - 1] = True
            near = np.flatnonzero(beside)
            rank[near], makes[near] = NO_RANK, -1
            near = near[near < len(sym) - 1]
            near = near[word[near] == word[near + 1]]
            rank[near], makes[near] = self._rank(sym[near], sym[near + 1])
        return self._spell(len(words), done)

    def _queue(self, sym: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One long word: merges in order of rank, then place, through a heap."""
        s, n = sym.tolist(), len(sym)
        nxt, prev = [*range(1, n), -1], [-1, *range(n - 1)]
        ranks, makes = self._rank(sym[:-1], sym[1:])
        heap = [(r, i, i + 1, s[i], s[i + 1], m) for i, (r, m) in enumerate(zip(ranks.tolist(), makes.tolist())) if r != NO_RANK]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, j, a, b, m = heapq.heappop(heap)
            if not (alive[i] and alive[j] and s[i] == a and s[j] == b and nxt[i] == j):
                continue
            s[i], alive[j], nxt[i] = m, False, nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            for x, y in ((prev[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0 and s[x] >= 0 and s[y] >= 0 and (found := self.pairs.get(s[x] * self.width + s[y])):
                    heapq.heappush(heap, (found[0], x, y, s[x], s[y], found[1]))
        left = np.flatnonzero(alive)
        return np.array(s)[left], code[left]

    def _spell(self, n: int, done: list) -> list[bytes]:
        word, sym, code = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, sym, code = word[order], sym[order], code[order]
        known = (sym >= 0) & self.is_piece[np.maximum(sym, 0)]
        if not known.all():  # such a character becomes the pieces of its UTF-8 bytes
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in code[~known].tolist()]
            count = np.ones(len(sym), np.int64)
            count[~known] = list(map(len, raw))
            spread = np.repeat(known, count)
            ids = np.repeat(sym, count)
            ids[~spread] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            word = np.repeat(word, count)
        else:
            ids = sym
        ends = np.searchsorted(word, np.arange(n + 1)) * 4
        flat = ids.astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def merge_all(self, words: list[str]) -> list[bytes]:
        return [ids for i in range(0, len(words), GROUP_WORDS) for ids in self.merge_words(words[i : i + GROUP_WORDS])]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end ids, as bytes."""
        cut = [split_words(t) for t in texts]
        remember(self.cache, cut, self.merge_all, CACHE_WORDS)
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        get = self.cache.__getitem__
        return [begin + b"".join(map(get, words)) + end for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, the mark of a space as a space, without the dummy one; bytes that form no character become U+FFFD."""
        ids = ids[~self.silent[ids]]
        if not len(ids):
            return ""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        raw = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - size), size)]
        lead = int(self.pieces[ids[0]].startswith(SPACE))
        try:
            return raw[lead:].tobytes().decode()
        except UnicodeDecodeError:
            pass
        out, at = [], 0
        cuts = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for part in np.split(ids, cuts):
            width = int(self.lengths[part].sum())
            piece = raw[at : at + width].tobytes()
            out.append(_each_invalid_byte(piece) if self.is_byte[part[0]] else piece.decode())
            at += width
        return "".join(out)[lead:]


def _each_invalid_byte(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that is not part of a character."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model, once for each worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode whole texts with begin and end ids, and decode those ids again.

    Returns one row per input row: the id column, ``n_tokens`` (all ids), ``ids`` (little-endian
    unsigned 32-bit integers; null unless ``keep_ids``), ``ids_sha256``, ``decoded_sha256`` and
    ``decoded`` (null unless ``keep_ids``). A null text counts as empty: two ids, an empty decoding.
    Other columns are not read. Repeated rows and null ids are kept as they are.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch) -> dict:
        pieces = model(model_path)
        ids = pieces.encode_batch(batch.column(1).to_pylist())
        decoded = [pieces.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in ids]
        return {
            id_col: batch.column(0),
            "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in decoded],
            "ids": pa.array(ids if keep_ids else [None] * len(ids), pa.binary()),
            "decoded": pa.array(decoded if keep_ids else [None] * len(ids), pa.string()),
        }

    schema = {id_col: kind, "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "binary", "decoded": "string"}
    return map_texts(docs.select(id_col, text_col), run, schema, after=lambda: model(model_path).cache.clear())
