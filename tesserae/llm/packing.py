"""Packing token sequences: shallow length combinations, non-negative least squares, greedy residuals.

A document becomes its token ids and an end id. Whole windows are cut off first; what remains is shorter than a
window. Combinations of a few remainder lengths that fill a window exactly are enumerated, their repeat counts solved
against the histogram of lengths by non-negative least squares, rounded and bounded by supply. Remainders that no
combination takes are laid end to end and cut at window ends; the last, partial window is cut into powers of two,
which need no padding. The driver sees the histogram only (window - 1 numbers); every piece's place follows in closed
form from its length and its rank among the remainders of that length.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import map_texts, staged, worker_state
from tesserae.llm.token_count import byte_symbols

#: Pattern of byte-level pre-tokenisation in this vocabulary's format (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Sequences of whole windows are numbered from here on, a task's together.
WHOLE = 1 << 40


def load_encoder(path: str) -> tiktoken.Encoding:
    """The encoder of a byte-level BPE vocabulary file whose ids follow the order of its merges (checked)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = {c: b for b, c in enumerate(byte_symbols())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    if [vocab[a + b] for a, b in merges] != [*range(256, 256 + len(merges))]:
        raise ValueError(f"{path}: ids don't follow the order of merges")
    ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode(encoder: tiktoken.Encoding, text: str) -> list[int]:
    if any(s in text for s in encoder.special_tokens_set):
        return encoder.encode(text, allowed_special="all")
    return encoder.encode_ordinary(text)


def combinations(histogram: dict[int, int], window: int, hot: int = 24) -> list[tuple[int, ...]]:
    """Length multisets that sum to window: all pairs; triples and repeats around the hot most frequent lengths."""
    there = sorted(histogram)
    has = set(there)
    found = {(a, window - a) for a in there if a <= window - a and window - a in has}
    for a in sorted(there, key=lambda n: (-histogram[n], n))[:hot]:
        found.update(tuple(sorted((a, b, window - a - b))) for b in there if window - a - b in has)
        found.update(tuple(sorted([a] * k + [window - k * a])) for k in range(3, window // a + 1) if k <= 8 and window - k * a in has)
        if window % a == 0 and window // a <= 8:
            found.add((a,) * (window // a))
    return sorted(found)


def repeats(histogram: dict[int, int], patterns: list[tuple[int, ...]], sweeps: int = 40) -> list[int]:
    """min ||Ax - h|| over x >= 0 by cyclic coordinate descent; then rounded, never above the supply of a length."""
    left = {n: float(c) for n, c in histogram.items()}
    parts = [list(Counter(p).items()) for p in patterns]
    norms = [sum(m * m for _, m in q) for q in parts]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        moved = 0.0
        for i, q in enumerate(parts):
            step = max(-x[i], sum(m * left[n] for n, m in q) / norms[i])
            if step:
                x[i] += step
                moved = max(moved, abs(step))
                for n, m in q:
                    left[n] -= m * step
        if moved < 0.25:
            break
    supply, out = dict(histogram), [0] * len(patterns)
    for up in (False, True):  # rounded counts first, then what supply still allows
        for i in sorted(range(len(patterns)), key=lambda j: (-x[j], j)):
            can = min(supply[n] // m for n, m in parts[i])
            take = can if up else min(can, round(x[i]))
            out[i] += take
            for n, m in parts[i]:
                supply[n] -= m * take
    return out


class Layout:
    """Where the remainder of a given length and rank goes: [(start in it, length, sequence, offset)]."""

    def __init__(self, histogram: dict[int, int], window: int):
        self.window = window
        patterns = combinations(histogram, window)
        used: dict[int, int] = defaultdict(int)
        runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        sequence = 0
        for p, n in zip(patterns, repeats(histogram, patterns), strict=True):
            if n:
                at = 0
                for length in p:
                    runs[length].append((used[length], sequence, at))
                    used[length] += n
                    at += length
                sequence += n
        self.used = dict(used)
        self.starts = {k: np.array([r[0] for r in v]) for k, v in runs.items()}
        self.runs = dict(runs)
        self.first_residual = sequence
        self.base, at = {}, 0
        for length in sorted(histogram):
            self.base[length] = at
            at += (histogram[length] - used[length]) * length
        self.residual_windows, rest = divmod(at, window)
        self.tail = [1 << b for b in range(window.bit_length(), -1, -1) if rest >> b & 1]

    def places(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        taken = self.used.get(length, 0)
        if rank < taken:
            start, sequence, at = self.runs[length][int(np.searchsorted(self.starts[length], rank, side="right")) - 1]
            return [(0, length, sequence + rank - start, at)]
        at, done, out = self.base[length] + (rank - taken) * length, 0, []
        while done < length:
            w, o = divmod(at + done, self.window)
            room, sequence = self.window - o, self.first_residual + w
            if w == self.residual_windows:
                for part in self.tail:
                    if o < part:
                        room = part - o
                        break
                    o -= part
                    sequence += 1
            n = min(room, length - done)
            out.append((done, n, sequence, o))
            done += n
        return out


def tokenized(df: DataFrame, vocabulary: str, window: int, text: str, key: str, end_id: int) -> DataFrame:
    """Per document: its task, token count, CRCs of whole windows (numbered in the task), and the remainder with its rank in the task."""

    def run(batches):
        encoder = worker_state(f"encoder:{vocabulary}", lambda: load_encoder(vocabulary))
        task, whole, ranks = TaskContext.get().partitionId(), 0, defaultdict(int)
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for t in b.column(1).to_pylist():
                ids = np.array([*encode(encoder, t or ""), end_id], dtype="<u4")
                k, rest = divmod(len(ids), window)
                crcs = [zlib.crc32(ids[i * window : (i + 1) * window].tobytes()) for i in range(k)]
                for c, v in zip(out, (len(ids), whole, crcs, rest, ranks[rest], ids[k * window :].tobytes()), strict=True):
                    c.append(v)
                whole += k
                ranks[rest] += 1
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary())
            made = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([task] * len(b), pa.int32()), *made], names=[key, "task", "doc_tokens", "whole_before", "crcs", "rest", "rank", "ids"])

    kind = df.schema[key].dataType.simpleString()
    return map_texts(df.select(key, text), run, f"`{key}` {kind}, task int, doc_tokens long, whole_before long, crcs array<long>, rest int, rank long, ids binary")


def pack(df: DataFrame, vocabulary: str, window: int = 1024, text: str = "text", key: str = "doc_id", end_id: int = 0) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone. Repeated rows are packed once each; an empty table gives no piece. Texts
    of any length are cut into whole windows. Other columns of df are not read. window must be a power of two. Every
    sequence is full, but for some of a power of two of tokens at the very end: nothing is padded.
    """
    if window & (window - 1):
        raise ValueError("window: a power of two")
    docs = staged(tokenized(df, vocabulary, window, text, key, end_id), "tokens")
    counts = docs.filter("rest > 0").groupBy("rest", "task").agg(F.count("*").alias("n"))
    # a rank in the task becomes a rank among all: the earlier tasks' counts come before
    before = F.sum("n").over(Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts = staged(counts.select("rest", "task", "n", F.coalesce(before, F.lit(0)).alias("before")), "ranks")
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    layout = Layout(histogram, window)
    kind = df.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches):
        for b in batches:
            rows: list[list] = [[] for _ in range(7)]
            for r in b.to_pylist():
                n = r["doc_tokens"]
                own = [(i * window, window, crc, WHOLE * (r["task"] + 1) + r["whole_before"] + i, 0) for i, crc in enumerate(r["crcs"])]
                if r["rest"]:
                    head = n - r["rest"]
                    own += [(head + s, m, zlib.crc32(r["ids"][4 * s : 4 * (s + m)]), q, o) for s, m, q, o in layout.places(r["rest"], r["before"] + r["rank"])]
                for s, m, crc, q, o in own:
                    for c, v in zip(rows, (r["key"], s, m, crc, n, q, o), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], b.column(0).type), *(pa.array(c, pa.int64()) for c in rows[1:])], names=names)

    ranked = docs.withColumnRenamed(key, "key").join(counts.select("rest", "task", "before"), ["rest", "task"], "left")
    ranked = ranked.select("key", "task", "doc_tokens", "whole_before", "crcs", "rest", "rank", "before", "ids")
    return map_texts(ranked, place, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
