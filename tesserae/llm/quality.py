"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

score = sigmoid(w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise interactions of low rank,
in time linear in the features. Labels, lang, source and doc_id are never features.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import column, map_texts, worker_state

#: Hash buckets of words; rank of the interactions; bound on the labelled rows that a model is fitted on.
BUCKETS, RANK, SAMPLE = 1024, 8, 6000
#: Entries of a worker's cache word -> bucket before it starts anew.
CACHE_WORDS = 400_000
MARKS = b"!|*#$%&.,\n\"+@:;-_/<>=()?'"


def _classes() -> np.ndarray:
    """Byte classes: one per mark, then digits, A-Z, a-z, space, other control, bytes of other code points, other ASCII."""
    to = np.full(256, len(MARKS) + 6)
    for i, b in enumerate(MARKS):
        to[b] = i
    for i, (a, z) in enumerate(((48, 57), (65, 90), (97, 122), (32, 32))):
        to[a : z + 1] = len(MARKS) + i
    to[:32] = np.where(to[:32] < len(MARKS), to[:32], len(MARKS) + 4)
    to[128:] = len(MARKS) + 5
    return to


CLASSES = _classes()
N_STATS = len(MARKS) + 7 + 11
#: Which statistic is log(1 + bytes).
LOG_SIZE = len(MARKS) + 7 + 1


def text_features(text: str, cache: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(structure and metadata statistics, word counts by bucket) of one whole text."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    kinds = np.bincount(CLASSES, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=len(MARKS) + 7) / size
    ids = []
    for w in words:
        i = cache.get(w)
        if i is None:
            if len(cache) >= CACHE_WORDS:
                cache.clear()
            i = cache[w] = zlib.crc32(w)
        ids.append(i)
    at = np.array(ids, dtype=np.int64)
    hashed = np.bincount(at % BUCKETS, minlength=BUCKETS)
    lines = text.split("\n")
    pairs = at[:-1] * 31 + at[1:]
    m = max(1, n)
    stats = [
        np.log1p(n), np.log1p(size), size / m / 10, len(np.unique(at)) / m, len(np.unique(pairs)) / max(1, n - 1), float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0,
        len(set(lines)) / len(lines), np.log1p(len(lines)), n / len(lines) / 50, hashed.max() / m, len(text) / size,
    ]
    return np.concatenate([np.sqrt(kinds), stats]).astype(np.float32), hashed


def _vectors(stats: np.ndarray, counts: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> np.ndarray:
    """Rows of features: standardised statistics within 5 deviations, then root-scaled word counts of unit length.

    Shares mean little in a text of a few words, so the statistics of short texts shrink towards the mean.
    """
    size = np.expm1(stats[:, LOG_SIZE : LOG_SIZE + 1])
    stats = mean + (stats - mean) * (size / (size + 50))
    words = np.sqrt(counts.astype(np.float32))
    words /= np.maximum(np.sqrt((words * words).sum(1, keepdims=True)), 1e-6)
    return np.concatenate([np.clip((stats - mean) / dev, -5, 5), words], axis=1)


class FactorisationMachine:
    def __init__(self, n: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w0, self.w, self.v = 0.0, np.zeros(n, np.float32), rng.normal(0, 0.02, (n, RANK)).astype(np.float32)
        self.mean, self.dev = np.zeros(N_STATS, np.float32), np.ones(N_STATS, np.float32)

    def raw(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.v
        return self.w0 + x @ self.w + 0.5 * ((s * s).sum(1) - (x * x) @ (self.v * self.v).sum(1))

    def score(self, stats: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(_vectors(stats, counts, self.mean, self.dev)).astype(np.float64), -30, 30)))

    def fit(self, stats: np.ndarray, counts: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.05, decay: float = 1e-4, seed: int = 0) -> None:
        """AdaGrad on the logistic loss; passes in a seeded order."""
        self.mean, self.dev = stats.mean(0), stats.std(0) + 1e-3
        x, rng = _vectors(stats, counts, self.mean, self.dev), np.random.default_rng(seed)
        g0, gw, gv = 1e-6, np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for i in range(0, len(y), batch):
                b = order[i : i + batch]
                xb = x[b]
                e = (1 / (1 + np.exp(-np.clip(self.raw(xb), -30, 30))) - y[b]).astype(np.float32) / len(b)
                d0, dw = float(e.sum()), xb.T @ e + decay * self.w
                dv = xb.T @ (e[:, None] * (xb @ self.v)) - self.v * ((xb * xb).T @ e)[:, None] + decay * self.v
                g0, gw, gv = g0 + d0 * d0, gw + dw * dw, gv + dv * dv
                self.w0 -= rate * d0 / np.sqrt(g0)
                self.w -= rate * dw / np.sqrt(gw)
                self.v -= rate * dv / np.sqrt(gv)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(column(key).cast("string")) % 3 == 1, F.lit(False))


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> FactorisationMachine:
    """Fit on at most `sample` labelled rows outside the held-out third, those first by a hash of the key (the documented bound).

    Labels other than 0 and 1, and null keys, are left out; a key with several labels counts once, with its largest, and
    one with several rows counts once, with the row of the least features.
    Without any labelled row the machine stays blank: every score is 0.5.
    """
    chosen = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key").limit(sample)
    rows = df.select(column(key).alias("key"), column(text).alias("text")).join(F.broadcast(chosen), F.col("key") == F.col("_key")).select("_label", "text", "key")

    def run(batches):
        for b in batches:
            cache: dict[bytes, int] = {}
            made = [text_features(t or "", cache) for t in b.column(1).to_pylist()]
            at = [np.flatnonzero(c) for _, c in made]
            columns = [b.column(2), b.column(0), pa.array([s.tobytes() for s, _ in made], pa.binary()), pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()), pa.array([c[i].astype("<u4").tobytes() for i, (_, c) in zip(at, made, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "y", "stats", "at", "n"])

    made = map_texts(rows, run, f"key {df.schema[key].dataType.simpleString()}, y {labels.schema[label].dataType.simpleString()}, stats binary, at binary, n binary")
    got = made.groupBy("key").agg(F.min(F.struct("stats", "at", "n", "y")).alias("r")).select("r.*").collect()  # one row of each key: `sample` at most
    machine = FactorisationMachine(N_STATS + BUCKETS)
    if got:
        got.sort(key=lambda r: (bytes(r["stats"]), bytes(r["at"]), bytes(r["n"]), r["y"]))  # the order of arrival must not matter
        stats, counts = np.stack([np.frombuffer(r["stats"], np.float32) for r in got]), np.zeros((len(got), BUCKETS), np.float32)
        for c, r in zip(counts, got, strict=True):
            c[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
        machine.fit(stats, counts, np.array([r["y"] for r in got], np.float32))
    else:
        machine.v[:] = 0
    return machine


def quality_scores(df: DataFrame, machine: FactorisationMachine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score, predicted (1 if score >= 0.5) of every row; a narrow map, no shuffle.

    A null text counts as empty; empty texts are scored like others. A null key is not held out. Repeated rows each get
    a row; an empty table gives none. Other columns are not read.
    """
    model = machine.__dict__

    def run(batches):
        own = FactorisationMachine(1)
        own.__dict__.update(model)
        cache = worker_state("quality-words", dict)
        for b in batches:
            score = np.zeros(len(b))
            texts = b.column(1).to_pylist()
            for i in range(0, len(texts), 256):
                made = [text_features(t or "", cache) for t in texts[i : i + 256]]
                score[i : i + 256] = own.score(np.stack([s for s, _ in made]), np.stack([c for _, c in made]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], names=[key, "score"])

    kind = df.schema[key].dataType.simpleString()
    scored = map_texts(df.select(column(key), column(text)), run, f"`{key}` {kind}, score double")
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(df: DataFrame, machine: FactorisationMachine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df, every column, whose text scores 0.5 or more.

    Null texts count as empty; repeated rows go or stay together; an empty table gives none. Columns may have any names.
    """
    model = machine.__dict__

    def run(batches):
        own = FactorisationMachine(1)
        own.__dict__.update(model)
        cache = worker_state("quality-words", dict)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            stay = np.zeros(len(b), bool)
            for i in range(0, len(texts), 256):
                made = [text_features(t or "", cache) for t in texts[i : i + 256]]
                stay[i : i + 256] = own.score(np.stack([s for s, _ in made]), np.stack([c for _, c in made])) >= 0.5
            yield b.filter(pa.array(stay))

    return map_texts(df, run, df.schema)
