"""Approximate anchors, circular orientation and alignment kernels.

Dynamic programming over two sequences has no relational form; such kernels run as Arrow-batched
functions over rows that Spark has already brought together and bounded in length.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thylakoid.functions.sequence import hamming, revcomp, rotate
from thylakoid.operators.kmers import shared_kmers

_N = ord("N")


def _mismatches(text: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """Mismatches of the pattern at every place of the text; N matches anything."""
    places = np.zeros(len(text) - len(pattern) + 1, np.int32)
    for i, p in enumerate(pattern):
        if p != _N:
            part = text[i : i + len(places)]
            places += (part != p) & (part != _N)
    return places


@F.pandas_udf(T.IntegerType())
def first_approximate(text: pd.Series, pattern: pd.Series, most: pd.Series) -> pd.Series:
    """The leftmost place (from 0) where the pattern fits with so many mismatches at most; -1 if none."""
    out = []
    for t, p, m in zip(text, pattern, most):
        if t is None or p is None or len(p) > len(t):
            out.append(-1)
            continue
        found = np.flatnonzero(_mismatches(np.frombuffer(t.encode("latin-1", "replace"), np.uint8), np.frombuffer(p.encode("latin-1", "replace"), np.uint8)) <= m)
        out.append(int(found[0]) if len(found) else -1)
    return pd.Series(out)


def local_ends(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple | None:
    """Smith-Waterman ends (from 1: a's first and last, b's first and last) and score; None without a match.

    Rows of the matrix are computed at a time: a run of gaps in ``a`` is a running maximum of scores freed of
    their slope. Of equal scores the first cell by row wins; the way
    back prefers the diagonal, then up, then left.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return None
    x, y = np.frombuffer(a.encode("latin-1", "replace"), np.uint8), np.frombuffer(b.encode("latin-1", "replace"), np.uint8)
    score = np.zeros((n + 1, m + 1), np.int32)
    slope = np.arange(m + 1, dtype=np.int32) * gap
    for i in range(1, n + 1):
        best = np.maximum(score[i - 1] + gap, 0)
        best[1:] = np.maximum(best[1:], score[i - 1, :-1] + np.where(y == x[i - 1], match, mismatch))
        score[i] = np.maximum.accumulate(best - slope) + slope
    i, j = divmod(int(score.argmax()), m + 1)
    best = int(score[i, j])
    if best <= 0:
        return None
    end = i, j
    while score[i, j] > 0:
        at = i, j
        if score[i, j] == score[i - 1, j - 1] + (match if x[i - 1] == y[j - 1] else mismatch):
            i, j = i - 1, j - 1
        elif score[i, j] == score[i - 1, j] + gap:
            i -= 1
        else:
            j -= 1
    return at[0], end[0], at[1], end[1], best


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in ("a_st", "a_en", "b_st", "b_en", "score")]))
def smith_waterman(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Ends and score of the best local alignment of two short sequences (match 2, mismatch -1, gap -2)."""
    found = [local_ends(x.upper(), y.upper()) if x and y else None for x, y in zip(a, b)]
    return pd.DataFrame([f or (None,) * 5 for f in found], columns=["a_st", "a_en", "b_st", "b_en", "score"]).astype("Int32")


def rotation_candidates(rows: DataFrame, keys: list[str], ref: str, query: str, anchor: int = 200, most: int = 10) -> DataFrame:
    """How each row's circular query can be turned to start where the reference starts.

    For both orientations: the query starts there already; the reference's end and start lie side by
    side in the doubled query; its start alone does. Returns candidates ``orientation, rule, cut, mm``.
    """
    r = F.upper(F.col(ref))
    first, last = F.substr(r, F.lit(1), F.lit(anchor)), F.substr(r, F.length(r) - (anchor - 1))
    usable = rows.filter((F.length(ref) >= anchor) & (F.length(query) > 0))
    q = F.upper(F.col(query))
    turned = usable.select(*keys, first.alias("first"), F.concat(last, first).alias("circle"), F.explode(F.array(F.struct(F.lit("fwd").alias("o"), q.alias("q")), F.struct(F.lit("rev").alias("o"), revcomp(q).alias("q")))).alias("x"))
    turned = turned.select(*keys, "first", "circle", F.col("x.o").alias("orientation"), F.col("x.q").alias("q")).withColumn("two", F.concat("q", "q"))
    # a pandas function is as costly as its text is long, so all three rules share one batch of rows
    found = turned.select(*keys, "orientation", F.length("q").alias("n"), hamming(F.col("first"), F.substr(F.col("q"), F.lit(1), F.lit(anchor))).alias("head"), first_approximate("two", "circle", F.lit(most)).alias("circle"), first_approximate("two", "first", F.lit(most)).alias("start"))
    rules = F.array(
        F.struct(F.lit("head").alias("rule"), F.when(F.col("head") <= most, 0).alias("cut"), F.col("head").alias("mm")),
        F.struct(F.lit("circle").alias("rule"), F.when(F.col("circle") >= 0, (F.col("circle") + anchor) % F.col("n")).alias("cut"), F.lit(most).alias("mm")),
        F.struct(F.lit("start").alias("rule"), F.when(F.col("start").between(0, F.col("n") - 1), F.col("start")).alias("cut"), F.lit(most).alias("mm")),
    )
    cells = found.select(*keys, "orientation", F.posexplode(rules).alias("rank", "r"))
    return cells.select(*keys, "orientation", "rank", F.col("r.rule").alias("rule"), F.col("r.cut").cast("int").alias("cut"), F.col("r.mm").cast("int").alias("mm")).filter("cut is not null")


def rotate_to_anchor(rows: DataFrame, keys: list[str], ref: str, query: str, anchor: int = 200, most: int = 10, k: int = 21, forward_first: bool = False) -> DataFrame:
    """Queries turned to the reference's start: ``seq, orientation, rule, cut``; unchanged if nothing fits.

    Each orientation's best candidate (a start already in place, then the circle, then the start alone)
    is turned, and the orientation that shares more k-mers with the reference wins, the forward one on
    ties. With ``forward_first``, a forward candidate always wins over the reverse one, but for a start
    already in place with fewer mismatches.
    """
    cand = rotation_candidates(rows, keys, ref, query, anchor, most)
    best = cand.groupBy(*keys, "orientation").agg(F.min(F.struct("rank", "rule", "cut", "mm")).alias("x")).select(*keys, "orientation", "x.*")
    q = F.upper(F.col(query))
    turned = best.join(rows, keys).withColumn("seq", rotate(F.when(F.col("orientation") == "rev", revcomp(q)).otherwise(q), F.col("cut")))
    if forward_first:
        head = (F.col("rule") == "head").cast("int")
        order = F.struct(F.col("mm"), (F.col("orientation") == "rev").cast("int").alias("o"), (-head).alias("h"))
    else:
        turned = turned.withColumn("shared", shared_kmers(k)(F.upper(F.col(ref)), F.col("seq"))["shared"])
        order = F.struct((-F.col("shared")).alias("s"), (F.col("orientation") == "rev").cast("int").alias("o"))
    winner = turned.groupBy(*keys).agg(F.min(F.struct(order.alias("by"), "seq", "orientation", "rule", "cut")).alias("x"))
    out = rows.select(*keys, q.alias("_q")).join(winner, keys, "left")
    return out.select(*keys, F.coalesce("x.seq", "_q").alias("seq"), F.coalesce("x.orientation", F.lit("fwd")).alias("orientation"), F.col("x.rule").alias("rule"), F.coalesce("x.cut", F.lit(0)).alias("cut"))


#: Cells of one alignment's way back that are held at a time, and the size of its anchors.
MOST_CELLS, ANCHOR = 1 << 27, 25
#: Cells of alignments that are filled side by side.
SIDE_CELLS = 1 << 24


def anchor_chain(a: str, b: str, k: int = ANCHOR) -> list[tuple[int, int]]:
    """Places of k-mers that occur once in both, in the longest chain that rises in both."""
    once = []
    for text in (a, b):
        seen: dict[str, int] = {}
        for i in range(len(text) - k + 1):
            word = text[i : i + k]
            seen[word] = -1 if word in seen else i
        once.append(seen)
    pairs = sorted((i, j) for word, i in once[0].items() if i >= 0 and (j := once[1].get(word, -1)) >= 0)
    ends, last, before = [], [], [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        before[n] = last[at - 1] if at else -1
        ends[at : at + 1], last[at : at + 1] = [j], [n]
    chain, n = [], last[-1] if last else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def _same_end(a: bytes, b: bytes, i: int, j: int) -> int:
    """How many letters ``a`` up to ``i`` and ``b`` up to ``j`` end with in common."""
    n, size, most = 0, 64, min(i, j)
    while n < most:
        size = min(size, most - n)
        if a[i - n - size : i - n] == b[j - n - size : j - n]:
            n, size = n + size, 2 * size
        elif size == 1:
            break
        else:
            size //= 2
    return n


def align_in_order(a: str, b: str) -> tuple[str, str] | None:
    """The best global alignment where one text has all letters of the other in their order (or equals it); else None.

    Then no alignment scores more than one that matches all letters of the shorter one, and every such has as many gaps. From the end equal letters
    are matched wherever they meet, as the way back of the whole matrix does: a match's diagonal is never the worse step.
    """
    if len(a) > len(b):
        turned = align_in_order(b, a)
        return turned and turned[::-1]
    x, y = a.encode("latin-1", "replace"), b.encode("latin-1", "replace")
    i, j, parts, end = len(a), len(b), [], len(b)
    while 0 < i <= j:
        n = _same_end(x, y, i, j)
        if n:
            parts += ["-" * (end - j), a[i - n : i]]
            i, j = i - n, j - n
            end = j
        j -= i > 0
    if i:
        return None
    return "".join(reversed([*parts, "-" * end])), b


def banded_pair(a: str, b: str, band: int = 64, match: int = 1, mismatch: int = -1, gap: int = -2) -> tuple[str, str]:
    """Global alignment of two similar sequences; see ``banded_pairs``."""
    return banded_pairs([(a, b)], band, match, mismatch, gap)[0]


def banded_pairs(pairs: list[tuple[str, str]], band: int = 64, match: int = 1, mismatch: int = -1, gap: int = -2) -> list[tuple[str, str]]:
    """Global alignments of pairs of similar sequences, many side by side.

    Pairs of which one has the other's letters in their order need no matrix (``align_in_order``). Other pairs begin in a band an eighth as wide,
    whose result stands only if every path outside it scores less, so it is the whole matrix's. The band around the diagonal is widened until no path outside it can score more: such a path has so
    many gaps that its best possible score is known. Where that takes too many cells, the alignment goes
    through a chain of exact matches and only what lies between them is aligned so; without a chain,
    the sequences are cut where the best path crosses the middle of the first.
    """
    out: list = [None] * len(pairs)
    todo: dict[int, list[int]] = {}
    usual = [min(max(band, abs(len(a) - len(b)) + band // 2), max(len(a), len(b))) for a, b in pairs]

    def queue(i: int, half: int) -> None:
        n, m = map(len, pairs[i])
        half = 1 << max(half - 1, 0).bit_length()
        if n <= 1 or (n + 1) * (2 * min(half, max(n, m)) + 1) <= MOST_CELLS:
            todo.setdefault(half, []).append(i)
        else:
            out[i] = _through_chain(*pairs[i], band, match, mismatch, gap)

    for i, (a, b) in enumerate(pairs):
        out[i] = align_in_order(a, b) if match > max(mismatch, 2 * gap) else None
        if out[i] is None:
            queue(i, min(usual[i], abs(len(a) - len(b)) + band // 8))
    while todo:
        half = min(todo)
        some = sorted(todo.pop(half), key=lambda i: len(pairs[i][0]))
        while some:
            count = max(1, SIDE_CELLS // ((len(pairs[some[-1]][0]) + 1) * (2 * half + 1)))
            now, some = some[-count:], some[:-count]
            for i, (x, y, score) in zip(now, _in_bands([pairs[i] for i in now], half, match, mismatch, gap)):
                n, m = map(len, pairs[i])
                gaps = 2 * (half + 1) - abs(n - m)
                if half >= max(n, m) or score + (half >= usual[i]) > match * (n + m - gaps) // 2 + gap * gaps:
                    out[i] = x, y
                else:
                    queue(i, max(2 * half, usual[i]))
    return out


def _through_chain(a: str, b: str, band: int, match: int, mismatch: int, gap: int) -> tuple[str, str]:
    n = len(a)
    chain, parts, i, j = anchor_chain(a, b), [], 0, 0
    for at, to in chain:
        if at < i or to < j:
            if at - i == to - j and at + ANCHOR > i:  # goes on with the match before it
                parts.append((a[i : at + ANCHOR], b[j : to + ANCHOR]))
                i, j = at + ANCHOR, to + ANCHOR
            continue
        parts += [banded_pair(a[i:at], b[j:to], band, match, mismatch, gap), (a[at : at + ANCHOR], b[to : to + ANCHOR])]
        i, j = at + ANCHOR, to + ANCHOR
    if chain:
        parts.append(banded_pair(a[i:], b[j:], band, match, mismatch, gap))
    else:
        middle = n // 2
        down = _last_row(a[:middle], b, match, mismatch, gap)
        up = _last_row(a[middle:][::-1], b[::-1], match, mismatch, gap)[::-1]
        cut = int((down + up).argmax())
        parts = [banded_pair(a[:middle], b[:cut], band, match, mismatch, gap), banded_pair(a[middle:], b[cut:], band, match, mismatch, gap)]
    return "".join(x for x, _ in parts), "".join(y for _, y in parts)


def _last_row(a: str, b: str, match: int, mismatch: int, gap: int) -> np.ndarray:
    """Best scores of all of ``a`` against every prefix of ``b``."""
    x, y = np.frombuffer(a.encode("latin-1", "replace"), np.uint8), np.frombuffer(b.encode("latin-1", "replace"), np.uint8)
    slope = np.arange(len(b) + 1, dtype=np.int64) * gap
    row = slope.copy()
    for i in range(len(a)):
        best = row + gap
        best[1:] = np.maximum(best[1:], row[:-1] + np.where(y == x[i], match, mismatch))
        row = np.maximum.accumulate(best - slope) + slope
    return row


def _in_bands(pairs: list[tuple[str, str]], half: int, match: int, mismatch: int, gap: int) -> list[tuple[str, str, int]]:
    """The best alignments within ``half`` of the diagonal and their scores, one row of all pairs at a time."""
    count, longest, width, low = len(pairs), max(len(a) for a, _ in pairs), 2 * half + 1, -(1 << 28)
    sizes = np.array([(len(a), len(b)) for a, b in pairs])
    n, m = sizes[:, :1], sizes[:, 1:]
    x, y = np.zeros((count, longest), np.uint8), np.full((count, longest + width + 1), 1, np.uint8)
    for r, (a, b) in enumerate(pairs):
        x[r, : len(a)] = np.frombuffer(a.encode("latin-1", "replace"), np.uint8)
        letters = np.frombuffer(b.encode("latin-1", "replace"), np.uint8)[: max(0, longest + half)]
        y[r, half + 1 : half + 1 + len(letters)] = letters  # the letter before place j lies at half + j
    back = np.zeros((longest + 1, count, width), np.uint8)
    js = np.arange(-half, half + 1)
    row = np.where((js >= 0) & (js <= m), js * gap, low).astype(np.int32)
    back[0] = 2
    slope = (np.arange(width) * gap).astype(np.int32)
    up = np.full((count, width), low, np.int32)
    for i in range(1, longest + 1):
        j = js + i
        inside = (j >= 0) & (j <= m)
        diagonal = row + np.where(y[:, i : i + width] == x[:, i - 1 : i], match, mismatch).astype(np.int32)
        diagonal[:, j < 1] = low
        up[:, :-1] = row[:, 1:] + gap
        best = np.where(inside, np.maximum(diagonal, up), low)
        # a run of gaps to the left is a running maximum of scores freed of their slope
        left = np.maximum.accumulate(best - slope, axis=1) + slope
        back[i] = np.where(left > best, 2, np.where(diagonal >= up, 0, 1))
        row = np.where(i > n, row, np.where(inside, left, low))
    return [(*_way_back(a, b, back[: len(a) + 1, r].tobytes(), half), int(row[r, len(b) - len(a) + half])) for r, (a, b) in enumerate(pairs)]


def _way_back(a: str, b: str, back: bytes, half: int) -> tuple[str, str]:
    i, j, out_a, out_b = len(a), len(b), [], []
    while i or j:
        step = back[i * (2 * half + 1) + j - i + half] if i else 2
        if step == 0 and i and j:
            i, j = i - 1, j - 1
            out_a.append(a[i])
            out_b.append(b[j])
        elif step == 1 and i:
            i -= 1
            out_a.append(a[i])
            out_b.append("-")
        else:
            j -= 1
            out_a.append("-")
            out_b.append(b[j])
    return "".join(reversed(out_a)), "".join(reversed(out_b))


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in "ab"]))
def align_pair(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Two similar sequences with gaps, of equal length."""
    whole = [i for i, (x, y) in enumerate(zip(a, b)) if x is not None and y is not None]
    out: list = [(None, None)] * len(a)
    for i, pair in zip(whole, banded_pairs([(a.iloc[i], b.iloc[i]) for i in whole])):
        out[i] = pair
    return pd.DataFrame(out, columns=["a", "b"])
