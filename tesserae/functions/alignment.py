"""Local alignment with affine gaps (scores for match, mismatch, gap open and extension), for oligos against long reads."""

from __future__ import annotations

# Match, mismatch, opening and extending a gap in either sequence.
MATCH, MISMATCH, OPEN, EXTEND = 2.0, -1.5, -3.0, -1.0


def least_score(a: str, b: str, share: float = 0.4) -> float:
    """Seven matches at least, and a share of the shorter sequence's full score."""
    return max(int(share * min(len(a), len(b)) * MATCH), 14)


def local_alignments(read: str, oligo: str, share: float = 0.4) -> list[tuple[int, int, float]]:
    """(start, end, score) in the read of local alignments that reach the least score, one for each end that no better,
    overlapping one claims."""
    n, low = len(oligo), -1e9
    floor = least_score(read, oligo, share)
    best, start = [0.0] * (n + 1), [0] * (n + 1)
    down, down_start = [low] * (n + 1), [0] * (n + 1)
    ends: list[tuple[float, int, int]] = []
    for i, b in enumerate(read, 1):
        diagonal, diagonal_start = best[0], i - 1
        right, right_start = low, 0
        best[0], start[0] = 0.0, i
        top: tuple[float, int] | None = None
        for j in range(1, n + 1):
            opened = best[j] + OPEN
            if opened >= down[j] + EXTEND:
                down[j], down_start[j] = opened, start[j]
            else:
                down[j] += EXTEND
            opened = best[j - 1] + OPEN
            if opened >= right + EXTEND:
                right, right_start = opened, start[j - 1]
            else:
                right += EXTEND
            score, at = diagonal + (MATCH if b == oligo[j - 1] else MISMATCH), diagonal_start
            if down[j] > score:
                score, at = down[j], down_start[j]
            if right > score:
                score, at = right, right_start
            diagonal, diagonal_start = best[j], start[j]
            best[j], start[j] = (score, at) if score > 0 else (0.0, i)
            if score > 0 and (top is None or score > top[0]):
                top = (score, at)
        if top and top[0] >= floor:
            ends.append((top[0], top[1], i))
    taken: list[tuple[int, int, float]] = []
    for score, s, e in sorted(ends, key=lambda x: (-x[0], x[1], x[2])):
        if all(e <= a or s >= z for a, z, _ in taken):
            taken.append((s, e, score))
    return sorted(taken)
