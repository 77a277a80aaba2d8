"""Both ends of an inverted segment at once: prefix sums of matches as it is against matches turned round."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thylakoid.operators.kmers import kmer_codes
from thylakoid.operators.msa import letters

#: What each letter (as A-Z) pairs with; 0 pairs with nothing.
_PAIR = np.zeros(128, np.uint32)
_PAIR[[ord(c) for c in "ACGT"]] = [ord(c) for c in "TGCA"]
_GAPS = [ord("-"), ord(".")]
_NO_GAPS = {ord("-"): None, ord("."): None}
_BACK = {ord(a): b for a, b in zip("ACGTacgt", "TGCAtgca")}


def turned_sum(cons: str, new: str, k: int, first: int = 1, last: int | None = None) -> int | None:
    """The sum (from 1) of a place in ``cons`` and the place in ``new`` that it pairs with when a segment is turned round.

    k-mers of ``new`` from ``first`` to ``last`` that occur once there, turned round, vote with the place where they occur once
    in ``cons``; the sum of most votes wins, the smallest of equals. None without a vote.
    """
    part = new[first - 1 : last]
    places, codes = kmer_codes(cons, k)
    turned, other = kmer_codes(part.translate(_BACK)[::-1], k)
    sides = []
    for at, code in ((places, codes), (len(part) - k - turned, other)):
        unique, index, count = np.unique(code, return_index=True, return_counts=True)
        sides.append((unique[count == 1], at[index[count == 1]]))
    _, i, j = np.intersect1d(sides[0][0], sides[1][0], assume_unique=True, return_indices=True)
    if not len(i):
        return None
    # places from 0 of the k-mer in cons and of its partner in new; their first letter pairs with the partner's last
    sums, votes = np.unique(sides[0][1][i] + sides[1][1][j] + first - 1 + k - 1 + 2, return_counts=True)
    return int(sums[votes.argmax()])


def best_ends(cons: str, new: str, total: int) -> tuple[int, int, int] | None:
    """First and last place (from 1) in the ungapped ``new`` of the segment that gains most matches with ``cons`` when turned round
    about ``total``, and the gain; of equals the one that ends first, then the shortest. None without a gain.

    Matches as they are come from the columns of the given alignment; outside the segment they stay, inside they are lost.
    """
    x, y = letters(cons), letters(new)
    held = ~np.isin(y, _GAPS)
    base, other = y[held], x[~np.isin(x, _GAPS)]
    as_is = (base == x[held]) & (_PAIR[np.minimum(base, 127)] > 0)
    partner = total - np.arange(1, len(base) + 1)  # from 1, in cons
    inside = (partner >= 1) & (partner <= len(other))
    round_ = np.zeros(len(base), bool)
    round_[inside] = _PAIR[np.minimum(base[inside], 127)] == other[partner[inside] - 1]
    sums = np.concatenate([[0], np.cumsum(round_.astype(np.int64) - as_is)])
    least = np.minimum.accumulate(sums)[:-1]
    gain = sums[1:] - least
    if not len(gain) or gain.max() <= 0:
        return None
    end = int(gain.argmax())
    start = int(np.flatnonzero(sums[: end + 1] == least[end])[-1])
    return start + 1, end + 1, int(gain[end])


def inversion_ends(rows: DataFrame, keys: list[str], cons: str = "cons", new: str = "new", k: int = 15, first: str | None = None, last: str | None = None) -> DataFrame:
    """The ends ``first_place, last_place`` (from 1, in the ungapped ``new``) of each row's inverted segment, their ``gain`` in
    matches and the sum ``total`` of paired places; null where no k-mer votes or nothing is gained.

    ``cons`` and ``new`` are aligned, with gaps. With ``first`` and ``last`` (places in ``new``), only k-mers between them vote.
    """

    @F.pandas_udf("first_place int, last_place int, gain int, total int")
    def find(c: pd.Series, n: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for x, y, f, t in zip(c, n, a, b):
            total = turned_sum(x.translate(_NO_GAPS), y.translate(_NO_GAPS), k, max(1, int(f)), None if pd.isna(t) else int(t))
            ends = best_ends(x, y, total) if total is not None else None
            out.append((*ends, total) if ends else (None, None, None, total))
        return pd.DataFrame(out, columns=["first_place", "last_place", "gain", "total"]).astype("Int32")

    found = find(cons, new, F.col(first) if first else F.lit(1), F.col(last) if last else F.lit(None).cast("int"))
    return rows.select(*keys, found.alias("x")).select(*keys, "x.*")
