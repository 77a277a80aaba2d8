"""Removal of byte strings that repeat across documents, by merging sorted suffix runs (operator 10).

A string of ``length`` bytes that two documents share also shares its *anchor*: the place whose 16 bytes
hash lowest among all places of the string. Neighbouring strings mostly have the same anchor; such a
stretch of strings is kept as one suffix, which begins at the anchor, ends with the last string and
carries the bytes before the anchor behind it. Steps, each one exchange:

1. Anchors' hashes meet by hash; those that occur in one document only can't belong to a shared string.
2. The other anchors meet their documents; each task sorts their suffixes into runs, front-coded (the
   length of the prefix shared with the suffix before, and the rest), cut by a hash of the anchor.
3. Runs of one part are merged by a loser tree that keeps, for every run's head, the length of the prefix
   it shares with the last suffix put out. Heads that differ there are ordered without looking at bytes;
   equal ones are compared from there on. Equal suffixes, and those of one anchor, come out side by side,
   which tells the smallest document holding each string.
4. The found stretches meet their documents again, and are cut out.

Only hashes decide nothing: each removal comes from compared bytes, or from 128-bit hashes of strings
that have their anchor in common. Texts travel packed and compressed, in parts of a bounded size.
"""

from __future__ import annotations

import hashlib
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.llm.common import bytes_of, chunks, materialize, partitions_for

LENGTH = 50
#: Bytes whose hash makes an anchor.
GRAM = 16
#: Bytes of text for one part of an exchange, for the anchors sorted at a time, and hashed at a time.
PART_BYTES, CHUNK_BYTES, PIECE_BYTES = 12 << 20, 8 << 20, 1 << 20

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
_ROW = "kind int, part int, data binary"


def _pack(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Arrays as bytes, by byte planes, compressed."""
    import zstandard

    planes = [(a.dtype.str, len(a), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in arrays]
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(planes, 5))


def _unpack(data: bytes) -> list[np.ndarray]:
    import zstandard

    planes = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
    return [np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind) for kind, n, raw in planes]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, part, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_pydict({"kind": pa.array(kind, pa.int32()), "part": pa.array(part, pa.int32()), "data": pa.array(data, pa.binary())})


def _mix(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    h = (low * _A) ^ ((high * _B) >> np.uint64(23)) ^ (high * _C)
    h ^= h >> np.uint64(32)
    h *= _B
    return h ^ (h >> np.uint64(29))


def _spread(h: np.ndarray) -> np.ndarray:
    """Anchors' hashes are the lowest of many; these are even again."""
    return _mix(h, h >> np.uint64(7))


def stretches(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The stretches of strings with one anchor in texts that lie end to end.

    ``bounds`` are the texts' borders. Returns, for each: the text, the first string's start in it, how
    many strings, the anchor's distance from that start, and the anchor's hash.
    """
    n, wide = len(data), length - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64)
    words = np.ndarray((n - 7,), "<u8", data, 0, (1,)).copy()
    h = _mix(words[: n - GRAM + 1], words[8:])
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal ones
    span = 1
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < wide:
        low = np.minimum(low[: span - wide], low[wide - span :])
    whole = np.ones(len(low), bool)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        whole[max(a, b - length + 1) : b] = False
    start = np.flatnonzero(whole)
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    anchor = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    count = np.diff(np.r_[first, len(start)])
    start, anchor = start[first], anchor[first]
    text = np.searchsorted(bounds, start, "right") - 1
    return text, start - bounds[text], count, anchor - start, _spread(h[anchor])


def _pieces(bounds: np.ndarray, length: int):
    """(first text, borders, offset in the first text) of pieces of bounded size; long texts overlap themselves."""
    i, n = 0, len(bounds) - 1
    while i < n:
        if bounds[i + 1] - bounds[i] > PIECE_BYTES:
            for at in range(0, int(bounds[i + 1] - bounds[i]) - length + 1, PIECE_BYTES):
                yield i, bounds[i] + np.array([at, min(at + PIECE_BYTES + length - 1, bounds[i + 1] - bounds[i])]), at
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE_BYTES, "right")) - 1)
        yield i, bounds[i : j + 1], 0
        i = j


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch's binary column ``text``, and the texts' borders in them."""
    col = batch.column("text")
    if col.null_count:
        col = col.fill_null(b"")
    _, offsets, data = col.buffers()
    bounds = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def _by_part(kind: int, part: np.ndarray, *arrays: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Rows that deal the arrays' entries to their parts, in the given order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    ends = [*cut[1:], len(part)] if len(part) else []
    return [(kind, int(part[a]), _pack(*(x[order[a:b]] for x in arrays))) for a, b in zip(cut, ends)]


def _gather_anchors(length: int, bits: int, parts: int):
    """Documents -> kind 0: anchors by hash (a document's own), kind 1: anchors known to be shared, by home."""

    def run(batches):
        for whole in batches:
            for batch in chunks(whole, 3, CHUNK_BYTES):
                data, bounds = _texts(batch)
                doc, tag, home = (batch.column(i).to_numpy() for i in range(3))
                found = []
                for first, borders, at in _pieces(bounds, length):
                    text, start, count, before, h = stretches(data[borders[0] : borders[-1]], borders - borders[0], length)
                    found.append((text + first, start + at, count, before, h >> np.uint64(64 - bits)))
                if not found:
                    continue
                text, start, count, before, h = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((doc[text], h))
                text, start, count, before, h = (x[order] for x in (text, start, count, before, h))
                edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
                size = np.diff(np.r_[edge, len(h)])
                many = np.repeat(doc[text[edge]] != doc[text[edge + size - 1]], size)
                start, count, before = start.astype(np.uint32), count.astype(np.uint8), before.astype(np.uint8)
                rows = _by_part(1, home[text[many]], doc[text[many]], tag[text[many]], start[many], count[many], before[many])
                # one entry says that a hash is shared here; the others carry their place
                lone, mark = ~many, np.zeros(len(h), bool)
                mark[edge] = many[edge]
                send = np.flatnonzero(lone | mark)
                part = ((h[send] >> np.uint64(max(0, bits - 32))) * np.uint64(parts) >> np.uint64(min(bits, 32))).astype(np.int64)
                cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
                for a, b in zip(cut, [*cut[1:], len(part)]):
                    mine = send[a:b]
                    used, at = np.unique(text[mine], return_inverse=True)
                    step = np.diff(h[mine], prepend=np.uint64(0))
                    rows.append((0, int(part[a]), _pack(step, lone[mine], at.astype(np.uint32), start[mine], count[mine], before[mine], doc[used], tag[used], home[used])))
                yield _rows(rows)

    return run


def _grouped(batches):
    """(part, rows by kind) of rows that come sorted by part and kind."""
    part, held = None, {}
    for batch in batches:
        for kind, p, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if p != part and held:
                yield part, held
                held = {}
            part = p
            held.setdefault(kind, []).append(data)
    if held:
        yield part, held


def _shared_anchors(batches):
    """Kind 0 by hash -> kind 1 by home: the anchors that two documents at least have. Kind 1 passes through."""
    for part, held in _grouped(batches):
        rows = [(1, part, d) for d in held.get(1, [])]
        runs = [_unpack(d) for d in held.get(0, [])]
        if runs:
            h = np.concatenate([np.cumsum(r[0]) for r in runs])
            lone = np.concatenate([r[1] for r in runs])
            docs = [np.concatenate([r[i] for r in runs]) for i in (6, 7, 8)]
            shift = np.cumsum([0, *(len(r[6]) for r in runs[:-1])])
            at = np.concatenate([r[2].astype(np.int64) + s for r, s in zip(runs, shift)])
            start, count, before = (np.concatenate([r[i] for r in runs]) for i in (3, 4, 5))
            order = np.argsort(h, kind="stable")
            h, lone, at = h[order], lone[order], at[order]
            edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            size = np.diff(np.r_[edge, len(h)])
            doc = docs[0][at]
            shared = (np.minimum.reduceat(doc, edge) != np.maximum.reduceat(doc, edge)) | ~np.logical_and.reduceat(lone, edge)
            pick = np.flatnonzero(np.repeat(shared, size) & lone)
            own, place = at[pick], order[pick]
            rows += _by_part(1, docs[2][own], docs[0][own], docs[1][own], start[place], count[place], before[place])
        yield _rows(rows)


def _pack_documents(batches):
    """Documents -> kind 2 by home: packed texts."""
    for whole in batches:
        for batch in chunks(whole, 3, CHUNK_BYTES):
            data, bounds = _texts(batch)
            doc = batch.column(0)
            ids, known = doc.fill_null(0).to_numpy(), doc.is_valid().to_numpy(zero_copy_only=False)
            tag, home = (batch.column(i).to_numpy() for i in (1, 2))
            rows = []
            for h in np.unique(home):
                mine = np.flatnonzero(home == h)
                body = np.concatenate([data[bounds[i] : bounds[i + 1]] for i in mine])
                rows.append((2, int(h), _pack(ids[mine], known[mine], tag[mine], np.diff(bounds)[mine], body, level=6)))
            yield _rows(rows)


def _documents(packed: list[bytes]):
    for data in packed:
        ids, known, tag, size, body = _unpack(data)
        ends = np.cumsum(size)
        raw = body.tobytes()
        for i, k, t, a, b in zip(ids.tolist(), known.tolist(), tag.tolist(), (ends - size).tolist(), ends.tolist()):
            yield (i if k else None), t, raw[a:b]


def _by_document(packed: list[bytes]) -> tuple[dict, list[np.ndarray]]:
    """Entries (doc, tag, ...) sorted by document: where each one's lie, and the other arrays."""
    if not packed:
        return {}, []
    doc, tag, *rest = (np.concatenate(x) for x in zip(*map(_unpack, packed)))
    order = np.lexsort((tag, doc))
    doc, tag = doc[order], tag[order]
    edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]) if len(doc) else []
    where = {(d, t): (a, b) for d, t, a, b in zip(doc[edge].tolist(), tag[edge].tolist(), edge, [*edge[1:], len(doc)])}
    return where, [x[order] for x in rest]


def _sorted_runs(length: int, parts: int):
    """Kinds 1 and 2 by home -> kind 0: front-coded suffix runs by anchor; kind 1: stretches to remove, by home."""
    widest = 2 * length - GRAM

    def run(batches):
        for home, held in _grouped(batches):
            where, rest = _by_document(held.get(1, []))
            suffixes: list[bytes] = []
            picked, owner, tags = [], [], []
            for doc, tag, text in _documents(held.get(2, [])) if where else ():
                if doc is None or (doc, tag) not in where:
                    continue
                a, b = where.pop((doc, tag))  # a repeated row has the same strings
                picked.append(np.arange(a, b))
                owner.append(np.full(b - a, doc))
                tags.append(np.full(b - a, tag))
                start, count, before = (x[a:b].astype(np.int64) for x in rest)
                mid, end = (start + before).tolist(), (start + count + (length - 1)).tolist()
                suffixes += [text[m:e] + text[s:m] for s, m, e in zip(start.tolist(), mid, end)]
            if not suffixes:
                continue
            pick, owner, tags = np.concatenate(picked), np.concatenate(owner), np.concatenate(tags)
            start, count, before = (x[pick] for x in rest)
            order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__))
            table = np.array([suffixes[i] for i in order.tolist()], f"S{widest}").view(np.uint8).reshape(len(order), widest)
            start, count, before, owner, tags = (x[order] for x in (start, count, before, owner, tags))
            size = count.astype(np.int64) + (length - 1)
            # equal suffixes of this run: only the smallest document's goes on, the others' are found here
            same = np.r_[False, (size[1:] == size[:-1]) & (before[1:] == before[:-1]) & (table[1:] == table[:-1]).all(axis=1)]
            edge = np.flatnonzero(~same)
            least = np.repeat(np.minimum.reduceat(owner, edge), np.diff(np.r_[edge, len(order)]))
            over = owner > least
            rows = [(1, home, _pack(owner[over], tags[over], start[over], count[over]))] if over.any() else []
            grams = table[:, :GRAM].copy().view("<u8")
            part = (_spread(_mix(grams[:, 0], grams[:, 1])) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            keep = np.flatnonzero(~over)
            keep = keep[np.argsort(part[keep], kind="stable")]
            cut = np.flatnonzero(np.r_[True, part[keep][1:] != part[keep][:-1]])
            for a, b in zip(cut, [*cut[1:], len(keep)]):
                mine = keep[a:b]
                front, rest_bytes = front_code(table[mine], size[mine])
                rows.append((0, int(part[mine[0]]), _pack(front, size[mine].astype(np.uint8), before[mine], owner[mine], tags[mine], start[mine], np.full(1, home, np.int32), rest_bytes, level=6)))
            yield _rows(rows)

    return run


def front_code(table: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted strings (padded rows of a matrix): the prefix shared with the one before, and the rests' bytes."""
    shared = np.zeros(len(table), np.int64)
    if len(table) > 1:
        equal = table[1:] == table[:-1]
        shared[1:] = np.where(equal.all(axis=1), table.shape[1], equal.argmin(axis=1))
        shared[1:] = np.minimum(shared[1:], np.minimum(size[1:], size[:-1]))
    at = np.arange(table.shape[1])
    return shared.astype(np.uint8), table[(at >= shared[:, None]) & (at < size[:, None])]


def front_decode(shared: list[int], size: list[int], rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for k, n in zip(shared, size):
        last = last[:k] + rest[at : at + n - k]
        at += n - k
        out.append(last)
    return out


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs of (strings, prefix shared with the one before in the run) by a loser tree.

    Returns, in order, each string's run, its place there and the prefix it shares with the one put out
    before. ``shared[r]`` is what run r's head shares with the last string put out: of two heads, the one
    that shares more is smaller; only heads that share equally much are compared, from there on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    head = [strings[0] if strings else None for strings, _ in runs] + [None] * (width - len(runs))
    shared, place = [0] * width, [0] * width
    losers = [0] * width
    runs_out, places_out, shared_out = [], [], []

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared prefix is then with the winner."""
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        known = shared[a]
        if known != shared[b]:
            return (a, b) if known > shared[b] else (b, a)
        if x == y:
            shared[b] = len(y)
            return a, b
        n = min(len(x), len(y))
        differ = int.from_bytes(x[known:n], "big") ^ int.from_bytes(y[known:n], "big")
        upto = n - ((differ.bit_length() + 7) >> 3)
        if x[upto:] < y[upto:]:
            shared[b] = upto
            return a, b
        shared[a] = upto
        return b, a

    winners = [*range(width)]
    level = width
    while level > 1:
        level //= 2
        nexts = []
        for i in range(level):
            win, lose = play(winners[2 * i], winners[2 * i + 1])
            losers[level + i] = lose
            nexts.append(win)
        winners = nexts
    best = winners[0]
    while head[best] is not None:
        runs_out.append(best)
        places_out.append(place[best])
        shared_out.append(shared[best])
        place[best] = at = place[best] + 1
        strings, fronts = runs[best]
        if at < len(strings):
            head[best], shared[best] = strings[at], fronts[at]
        else:
            head[best] = None
        node = (width + best) >> 1
        while node:
            other = losers[node]
            y = head[other]
            if y is not None:
                x = head[best]
                if x is None or shared[other] > shared[best]:
                    losers[node], best = best, other
                elif shared[other] == shared[best]:
                    best, losers[node] = play(best, other)
            node >>= 1
    return runs_out, places_out, shared_out


def _merged_parts(length: int):
    """Kind 0 by anchor -> kind 1 by home: stretches to remove. Kind 1 passes through."""

    def run(batches):
        for part, held in _grouped(batches):
            rows = [(1, part, d) for d in held.get(1, [])]
            if 0 in held:
                rows += _resolve([_unpack(d) for d in held[0]], length)
            yield _rows(rows)

    return run


def _resolve(packed: list[list[np.ndarray]], length: int) -> list[tuple[int, int, bytes]]:
    runs, at = [], np.cumsum([0, *(len(r[0]) for r in packed)])
    for front, size, *_, rest in packed:
        fronts = front.tolist()
        runs.append((front_decode(fronts, size.tolist(), rest.tobytes()), fronts))
    run, place, shared = (np.array(x, np.int64) for x in merge_runs(runs))
    order = at[run] + place
    size, before, doc, tag, start = (np.concatenate([r[i] for r in packed])[order] for i in range(1, 6))
    home = np.concatenate([np.full(len(r[0]), r[6][0]) for r in packed])[order]
    size, before = size.astype(np.int64), before.astype(np.int64)
    same = np.r_[False, (shared[1:] == size[1:]) & (size[1:] == size[:-1]) & (before[1:] == before[:-1])]
    edge = np.flatnonzero(~same)
    kind = np.cumsum(~same) - 1  # of distinct suffixes
    least = np.minimum.reduceat(doc, edge)
    group = (np.cumsum(shared < GRAM) - 1)[edge]  # of one anchor
    over = doc > least[kind]
    out_doc, out_tag, out_home = [doc[over]], [tag[over]], [home[over]]
    out_start, out_count = [start[over]], [size[over] - length + 1]

    several = np.bincount(group)[group] > 1
    chosen = np.flatnonzero(several)
    if len(chosen):
        strings = [runs[r][0][p] for r, p in zip(run[edge[chosen]].tolist(), place[edge[chosen]].tolist())]
        tails = (size[edge[chosen]] - before[edge[chosen]]).tolist()
        flat = np.frombuffer(b"".join([s[t:] + s[:t] for s, t in zip(strings, tails)]) + bytes(8), np.uint8)
        count = size[edge[chosen]] - length + 1
        base = np.cumsum(size[edge[chosen]]) - size[edge[chosen]]
        anchor, held, name = before[edge[chosen]], least[chosen], group[chosen]
        owners, places = [], []
        for ahead in range(length - GRAM + 1):  # equal strings have the anchor at the same distance
            at = anchor - ahead
            mine = np.flatnonzero((at >= 0) & (at < count))
            h1, h2 = _string_hashes(flat, base[mine] + at[mine], length)
            by = np.lexsort((held[mine], h2, h1, name[mine]))
            mine, h1, h2 = mine[by], h1[by], h2[by]
            new = np.r_[True, (name[mine][1:] != name[mine][:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(mine) else mine
            gone = held[mine[first]] < held[mine] if len(mine) else new[:0]
            owners.append(mine[gone])
            places.append(at[mine[gone]])
        owner, at = np.concatenate(owners), np.concatenate(places)
        by = np.lexsort((at, owner))
        owner, at = owner[by], at[by]
        # runs of such strings within each suffix, for every entry of its smallest document
        begin = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)]) if len(owner) else owner
        long = np.diff(np.r_[begin, len(owner)])
        runs_of = np.bincount(owner[begin], minlength=len(chosen))
        number = np.full(len(edge), -1)
        number[chosen] = np.arange(len(chosen))
        entry = np.flatnonzero(~over & (number[kind] >= 0))
        mine = number[kind[entry]]
        times = runs_of[mine]
        offset = np.cumsum(runs_of) - runs_of
        which = np.repeat(offset[mine] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        entry = np.repeat(entry, times)
        out_doc.append(doc[entry])
        out_tag.append(tag[entry])
        out_home.append(home[entry])
        out_start.append(start[entry] + at[begin][which])
        out_count.append(long[which])
    doc, tag, home, start, count = (np.concatenate(x) for x in (out_doc, out_tag, out_home, out_start, out_count))
    return _by_part(1, home, doc, tag, start.astype(np.uint32), count.astype(np.uint8))


def _string_hashes(flat: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the ``length`` bytes at each place."""
    words = np.ndarray((len(flat) - 7,), "<u8", flat, 0, (1,))
    a = b = np.full(len(at), length, np.uint64)
    for k in [*range(0, length - 7, 8), length - 8]:
        w = words[at + k]
        a = (a ^ w) * _A
        a ^= a >> np.uint64(31)
        b = (b + w) * _C
        b ^= b >> np.uint64(29)
    return a, b


def _cut_out(length: int, id_type: str, bodies: bool):
    """Kinds 1 and 2 by home -> a row for each document."""

    def run(batches):
        for _, held in _grouped(batches):
            where, rest = _by_document(held.get(1, []))
            out: dict[str, list] = {n: [] for n in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
            for doc, tag, text in _documents(held.get(2, [])):
                begin = end = np.zeros(0, np.int64)
                if (doc, tag) in where:
                    a, b = where[doc, tag]
                    begin = rest[0][a:b].astype(np.int64)
                    end = begin + rest[1][a:b].astype(np.int64) + (length - 1)
                    order = np.argsort(begin, kind="stable")
                    begin, end = begin[order], np.maximum.accumulate(end[order])
                    new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
                    begin, end = begin[new], end[np.r_[new[1:] - 1, len(end) - 1]]
                keep = b"".join([text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)])])
                out["id"].append(doc)
                out["n_bytes"].append(len(text))
                out["n_removed"].append(int((end - begin).sum()))
                out["n_spans"].append(len(begin))
                out["kept_sha256"].append(hashlib.sha256(keep).hexdigest())
                out["spans"].append([{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())] if bodies else None)
                out["kept"].append(keep if bodies else None)
                if bodies and sum(map(len, out["kept"])) > CHUNK_BYTES:
                    yield _documents_out(out)
                    out = {n: [] for n in out}
            yield _documents_out(out)

    return run


def _documents_out(out: dict) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = {"id": pa.int64(), "kept_sha256": pa.string(), "spans": span, "kept": pa.binary()}
    return pa.RecordBatch.from_pydict({n: pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()})


def _tagged(rows: DataFrame) -> DataFrame:
    """Rows (``doc, text``) with a ``tag`` that tells rows of one id apart by their text; it travels with every entry.

    Where ids are unique it is zero; else the different texts of ids that repeat are numbered, by their SHA-256."""
    repeated = rows.filter("doc is not null").groupBy("doc").count().filter("count > 1").select("doc")
    if repeated.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    hashed = rows.withColumn("_hash", F.sha2(F.coalesce("text", F.lit(b"")), 256))
    numbers = materialize(hashed.select("doc", "_hash").join(repeated, "doc", "left_semi").distinct().withColumn("_n", F.monotonically_increasing_id() + 1))
    return hashed.join(numbers, ["doc", "_hash"], "left").select("doc", "text", F.coalesce("_n", F.lit(0)).alias("tag"))


def cut_repeated_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES, bodies: bool = True) -> DataFrame:
    """Remove each byte that lies in a ``length``-byte string which also starts in a document with a smaller id.

    Texts are UTF-8 bytes; strings never cross documents, overlapping ones all count, and they are judged
    on the input. ``length`` is 32 to 135 bytes.

    Returns one row per document row: the id column, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), ``kept_sha256``, ``spans`` (their start and end, exclusive) and ``kept`` (the remaining
    bytes; both null unless ``bodies``). Null texts count as empty. Ids must be whole numbers; rows that
    repeat an id are not smaller than each other, and each is judged by its own text (their different texts
    are numbered). Rows with a null id are neither cut nor a reason to cut. Other columns aren't read.

    No task holds more than a part: about ``part_bytes`` of text, the anchors of one slice of hashes, or
    the suffixes of one slice of anchors. From a run, a suffix that many of its documents share goes on
    once, so a passage that a third of all documents hold reaches its part once a run.
    """
    if not 2 * GRAM <= length <= 135:
        raise ValueError("length must be from 32 to 135")
    kind = dict(docs.dtypes)[id_col]
    text = F.col(text_col).cast("binary")
    total = bytes_of(docs, text_col)
    parts = partitions_for(total, part_bytes)
    bits = min(64, math.ceil(math.log2(max(total, 2))) + 12)
    rows = _tagged(docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("text")))
    rows = rows.select("doc", "tag", F.pmod(F.xxhash64("doc", "tag"), F.lit(parts)).cast("int").alias("home"), "text")
    packed = rows.mapInArrow(_pack_documents, _ROW)

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition(parts, "part").sortWithinPartitions("part", "kind")

    anchors = rows.filter("doc is not null").mapInArrow(_gather_anchors(length, bits, parts), _ROW)
    shared = dealt(anchors).mapInArrow(_shared_anchors, _ROW)
    runs = dealt(shared.unionByName(packed)).mapInArrow(_sorted_runs(length, parts), _ROW)
    found = dealt(runs).mapInArrow(_merged_parts(length), _ROW)
    cut = dealt(found.unionByName(packed)).mapInArrow(_cut_out(length, kind, bodies), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept binary")
    return cut.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
