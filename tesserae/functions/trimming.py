"""Read trimming rules. Each returns how many bases to cut; Arrow batches, as a running sum has no relational form."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def quality_cut(quality: str, cutoff: int) -> int:
    """Bases to cut from the end of a quality string: where the running sum of cutoff - score, from the end, peaks before it falls below 0."""
    total = best = cut = 0
    for i, c in enumerate(reversed(quality), 1):
        total += cutoff - (ord(c) - 33)
        if total < 0:
            break
        if total > best:
            best, cut = total, i
    return cut


def dark_g_cut(seq: str, quality: str, cutoff: int) -> int:
    """As quality_cut for two-colour instruments, where G's count as of just too low a quality."""
    total = best = cut = 0
    for i, (b, c) in enumerate(zip(reversed(seq), reversed(quality), strict=True), 1):
        total += 1 if b in "Gg" else cutoff - (ord(c) - 33)
        if total < 0:
            break
        if total > best:
            best, cut = total, i
    return cut


def poly_tail(seq: str, base: str = "A", least: int = 3) -> int:
    """Length of the best tail of one base: 1 for it, -2 for others, at most a fifth others."""
    score = best = cut = others = 0
    for i, b in enumerate(reversed(seq), 1):
        if b == base:
            score += 1
        else:
            score, others = score - 2, others + 1
        if score > best and others * 5 <= i:
            best, cut = score, i
    return cut if cut >= least else 0


def adapter_cut(seq: str, adapter: str, errors: float = 0.1, overlap: int = 3, left: bool = False) -> tuple[int, int]:
    """(start, end) of the adapter's best match, (-1, -1) without one.

    Semi-global alignment: a right adapter may run off the read's end, a left one off its start. A match of n adapter
    bases may have int(n * errors) edits and needs at least `overlap` bases; more matched bases win, then fewer edits,
    then the leftmost.
    """
    if left:
        s, e = adapter_cut(seq[::-1], adapter[::-1], errors, overlap)
        return (-1, -1) if s < 0 else (len(seq) - e, len(seq) - s)
    m, best = len(adapter), None
    cost, start = [*range(m + 1)], [0] * (m + 1)

    def consider(i: int, j: int) -> None:
        nonlocal best
        if j >= overlap and cost[j] <= int(j * errors):
            rank = (-(j - cost[j]), cost[j], start[j])
            if best is None or rank < best[0]:
                best = (rank, start[j], i)

    consider(0, m)
    for i, b in enumerate(seq, 1):
        diagonal, diagonal_start = cost[0], start[0]
        cost[0], start[0] = 0, i
        for j in range(1, m + 1):
            options = ((diagonal + (b != adapter[j - 1]), diagonal_start), (cost[j] + 1, start[j]), (cost[j - 1] + 1, start[j - 1]))
            diagonal, diagonal_start = cost[j], start[j]
            cost[j], start[j] = min(options)
        consider(i, m)
    for j in range(m):
        consider(len(seq), j)
    return (-1, -1) if best is None else best[1:]


def quality_trim_length(quality: Column, cutoff: int) -> Column:
    @F.pandas_udf("int")
    def cut(q: pd.Series) -> pd.Series:
        return q.map(lambda x: quality_cut(x or "", cutoff))

    return cut(quality)


def dark_g_trim_length(seq: Column, quality: Column, cutoff: int) -> Column:
    @F.pandas_udf("int")
    def cut(s: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([dark_g_cut(a or "", b or "", cutoff) for a, b in zip(s, q, strict=True)])

    return cut(seq, quality)


def poly_trim_length(seq: Column, base: str = "A") -> Column:
    @F.pandas_udf("int")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda x: poly_tail(x or "", base))

    return cut(seq)


def adapter_span(seq: Column, adapter: str, errors: float, overlap: int, left: bool) -> Column:
    """struct(start, end)."""

    @F.pandas_udf("start int, end int")
    def find(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([adapter_cut(x or "", adapter, errors, overlap, left) for x in s], columns=["start", "end"])

    return find(seq)
