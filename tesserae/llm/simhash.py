"""SimHash near-duplicates by covering locality-sensitive hashing.

The masks form a covering code: bit i carries a vector p(i) of radius + 1 bits, and mask v keeps the bits with
<p(i), v> = 1. The vectors of any `radius` differing bits span too little to fill the space, so some v <> 0 is orthogonal
to all of them: under that mask the two fingerprints are equal. Every pair within the radius therefore meets.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import column, map_texts, row_mark, staged
from tesserae.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Fingerprints compared with each other directly; larger buckets are split by further masks.
BLOCK = 256
#: From so many fingerprints on, a bucket is dealt anew over tasks; so many such buckets are broadcast (their rows are counted first).
HOT, MOST_HOT = 16_384, 100_000


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(whole, seed)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        start = (end - size)[: len(words) - shingle + 1].tolist()
        hashes = [xxhash.xxh64_intdigest(whole[a:b], seed) for a, b in zip(start, end[shingle - 1 :].tolist(), strict=True)]
    each = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(each), 1 << 16):
        ones += np.unpackbits(each[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(each), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """key and fp (64 bits, as a long) of every row."""

    def run(batches):
        for b in batches:
            made = np.array([fingerprint(t or "", shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made.view(np.int64))], names=["key", "fp"])

    return map_texts(df.select(key, text), run, f"key {df.schema[key].dataType.simpleString()}, fp long")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """2^(radius+1) - 1 masks, each of about half the bits; any two words within the radius agree under one at least."""
    return covering(tuple(range(bits)), radius)


@cache
def covering(places: tuple[int, ...], radius: int) -> list[int]:
    """Masks over some bit places: words that differ in these places alone, in `radius` at most, agree under one at least.

    Few places carry vectors with the top bit set, so that every mask but one keeps half of them.
    """
    top = 1 << radius
    carried = [top + i for i in range(len(places))] if len(places) <= top else [1 + i % (2 * top - 1) for i in range(len(places))]
    return list(dict.fromkeys(sum(1 << i for i, p in zip(places, carried, strict=True) if (p & v).bit_count() & 1) for v in range(1, 2 * top)))


def free_places(mask: int, bits: int = 64) -> tuple[int, ...]:
    return tuple(i for i in range(bits) if not mask >> i & 1)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of two or more in sorted keys."""
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    start, end = cut[:-1], cut[1:]
    some = end - start > 1
    return start[some], end[some]


def _labels(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the first that it reaches by steps within the radius, compared block by block."""
    label = np.arange(len(fps))
    while True:
        new = label.copy()
        for i in range(0, len(fps), 512):
            near = np.bitwise_count(fps[i : i + 512, None] ^ fps[None, :]) <= radius
            new[i : i + 512] = np.minimum(np.where(near, label[None, :], len(fps)).min(1), label[i : i + 512])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def forest(fps: np.ndarray, radius: int, free: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what links connect among distinct fingerprints that differ in free places alone; not all links.

    Up to BLOCK are compared directly. More are split by a covering of the free places, of which about half stay free in
    a part: 2^8 fingerprints at most are left in one after a split of 16 places.
    """
    if len(fps) <= BLOCK or len(free) <= radius + 1:
        label = _labels(fps, radius)
        far = np.flatnonzero(label != np.arange(len(fps)))
        return [(fps[far], fps[label[far]])]
    out = []
    for m in covering(free, radius):
        if not m:
            continue
        part = fps & np.uint64(m)
        order = np.argsort(part, kind="stable")
        start, end = _runs(part[order])
        two = start[end - start == 2]
        a, b = fps[order[two + 1]], fps[order[two]]
        close = np.bitwise_count(a ^ b) <= radius
        out.append((a[close], b[close]))
        left = tuple(i for i in free if not m >> i & 1)
        for s, e in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist(), strict=True):
            out += forest(fps[order[s:e]], radius, left)
    return out


def _edges(t: np.ndarray, k: np.ndarray, fp: np.ndarray, radius: int, free: list[tuple[int, ...]]) -> np.ndarray:
    """(a, b) rows for whole buckets, in order of (t, k)."""
    start, end = _runs(np.r_[0, np.cumsum((t[1:] != t[:-1]) | (k[1:] != k[:-1]))])
    fp = fp.view(np.uint64)
    two = start[end - start == 2]
    two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
    found = [(fp[two + 1], fp[two])]
    for s, e in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist(), strict=True):
        found += forest(fp[s:e], radius, free[t[s]])
    a, b = (np.concatenate(c) for c in zip(*found, strict=True))
    return np.unique(np.stack([a, b], axis=1), axis=0).view(np.int64)


def _solved(dealt: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """Edges of the buckets of dealt (t, k, fp), t being the mask's number. Rows come sorted; one bucket at a time is held back."""
    free = [free_places(m) for m in masks]

    def run(batches):
        kept: list[tuple[np.ndarray, ...]] = []  # rows of the bucket that may go on, a few rows or whole batches each
        for b in batches:
            t, k, fp = (c.to_numpy() for c in b.columns)
            if not len(t):
                continue
            last = int(np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (k[1:] != k[:-1])])[-1])
            if last == 0 and kept and (kept[-1][0][-1], kept[-1][1][-1]) == (t[0], k[0]):
                kept.append((t, k, fp))
                continue
            done = [np.concatenate(c) for c in zip(*kept, (t[:last], k[:last], fp[:last]), strict=True)]
            kept = [(t[last:], k[last:], fp[last:])]
            if len(done[0]):
                yield _batch(_edges(*done, radius, free))
        if kept:
            yield _batch(_edges(*(np.concatenate(c) for c in zip(*kept, strict=True)), radius, free))

    def _batch(pairs):
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in pairs.T], names=["a", "b"])

    return dealt.select("t", "k", "fp").repartition("t", "k").sortWithinPartitions("t", "k").mapInArrow(run, "a long, b long")


def links(classes: DataFrame, radius: int, hot: int | None = None) -> DataFrame:
    """(a, b) edges over distinct fingerprints (column fp): their components are those of all pairs within the radius.

    Buckets of more than `hot` fingerprints are counted first (partial counts per task) and dealt anew by a covering of
    their mask's free places, so that no task takes one whole: 16 places are free then, 65,536 fingerprints at most.
    """
    masks = covering_masks(radius)
    hot = HOT if hot is None else hot
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)]))
    dealt = classes.select("fp", tables.alias("at")).select("at.t", "at.k", "fp")
    full = staged(dealt.groupBy("t", "k").count().filter(F.col("count") > hot).select("t", "k"), "hot-buckets")
    n_full = full.count()
    if not n_full:
        return _solved(dealt, radius, masks).distinct()
    full = F.broadcast(full) if n_full <= MOST_HOT else full
    finer = [list(m | f for f in covering(free_places(m), radius) if f) for m in masks]
    flat = [(i, f) for i, fs in enumerate(finer) for f in fs]
    first = {i: [j for j, (o, _) in enumerate(flat) if o == i] for i in range(len(masks))}
    of = F.array(*[F.array(*[F.struct(F.lit(j).alias("t"), F.lit(_signed(flat[j][1])).alias("m")) for j in first[i]]) for i in range(len(masks))])
    deep = dealt.join(full, ["t", "k"]).select("fp", F.explode(F.get(of, F.col("t"))).alias("f")).select("f.t", F.col("fp").bitwiseAND(F.col("f.m")).alias("k"), "fp")
    cold = _solved(dealt.join(full, ["t", "k"], "left_anti"), radius, masks)
    return cold.unionByName(_solved(deep, radius, [f for _, f in flat])).distinct()


def _grouped(rows: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """rows (id: a struct, fp), staged, and (fp, least): the smallest id that each fingerprint reaches."""
    rows = staged(rows, "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("id").alias("own")), "classes")
    roots = components(links(classes, radius))
    member = staged(classes.join(roots, F.col("fp") == F.col("node")).select("fp", "own", "root"), "members")
    group = member.groupBy("root").agg(F.min("own").alias("least"))
    group = classes.join(member.join(group, "root").select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "own").alias("least"))
    return rows, staged(group, "components")


def near_components(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id (smallest key reachable) of every row.

    Words are split at space and control characters 9 to 13; A-Z count as a-z. Fewer words than a shingle are one
    shingle; a null, empty or wordless text has fingerprint zero and links like any other. Rows of one fingerprint are
    one node, so copies never pair up. Repeated rows each get a row; an empty table gives none; a null key is never
    the smallest of a group that has another. Other columns are not read.
    """
    own = fingerprints(df.select(column(key).alias("key"), column(text).alias("text")), "key", "text", shingle)
    rows, group = _grouped(own.select(F.struct(F.col("key").isNull().alias("none"), "key").alias("id"), "fp"), radius)
    # written, so that the last join has an exchange on either side and a fingerprint of very many rows is split
    return rows.join(group, "fp").select(F.col("id.key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.key").alias("component_id"))


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of df (every column of it) per group: that with the smallest key, null last; of rows with one key, that with the least hash.

    Rows alike in every column count once. Null and empty texts are one group; an empty table gives no rows. Columns
    may have any names.
    """
    own = df.select(F.struct("*").alias("row"), column(key).alias("key"), column(text).alias("text"), row_mark(df).alias("mark"))
    made = fingerprints(own.select(F.struct(F.col("key").isNull().alias("none"), "key", "mark").alias("id"), "text"), "id", "text", shingle)
    _, group = _grouped(made.select(F.col("key").alias("id"), "fp"), radius)
    kept = group.select(F.struct("least.key", "least.mark").alias("own")).distinct()
    # repeats of a row meet in their tasks before they travel
    return own.groupBy(F.struct("key", "mark").alias("own")).agg(F.first("row").alias("row")).join(kept, "own", "left_semi").select("row.*")
