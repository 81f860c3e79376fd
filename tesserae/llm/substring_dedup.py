"""Substring dedup: super-k-mer partitioning of word windows.

A window's minimiser is the least hash of its short word groups. Consecutive windows that share one travel as one packed
string, the super-k-mer, to their minimiser's bucket; sorting the windows of a bucket finds exactly which are equal, and
the smallest document each starts in. Only minimisers that two documents have can hide a repeat, so a first pass over
8-byte minimisers decides which strings travel at all. A minimiser of very many documents sends its windows one by one,
bucketed by the whole window; equal strings of a task are merged before they are shuffled.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType

from tesserae.llm.common import column, map_texts, small_batches, staged, text_or_empty

U = np.uint64
LAST = (1 << 63) - 1
#: Words of a group that is hashed for the minimiser.
GROUP = 8
#: A minimiser of more documents, or more windows, sends its windows one by one; below both a bucket fits a task (some 200 MB at most).
HOT_DOCUMENTS, HOT_WINDOWS = 10_000, 2_000_000
#: Rows, and bytes of packed words, of a batch of super-k-mers.
OUT_ROWS, OUT_BYTES = 20_000, 16 << 20


def _minimisers(words: list[bytes], window: int) -> np.ndarray:
    """The minimiser of each window of the words, as signed 64 bits."""
    digest = xxhash.xxh64_intdigest
    each = np.array([digest(w) for w in words], dtype=U)
    n = len(each) - GROUP + 1
    mixed = np.zeros(n, U)
    for i in range(GROUP):
        mixed = mixed * U(0x9E3779B97F4A7C15) + each[i : i + n]
    mixed = (mixed ^ (mixed >> U(32))) * U(0xD6E8FEB86659FD93)
    mixed ^= mixed >> U(32)
    wide, low = window - GROUP + 1, mixed
    span = 1
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < wide:
        low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
    return low.view(np.int64)


def _stretches(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of equal minimisers."""
    cut = np.flatnonzero(np.r_[True, low[1:] != low[:-1], True])
    return cut[:-1], cut[1:]


def _summaries(df: DataFrame, window: int) -> DataFrame:
    """id, h (a hash of the text), n_words, whole (SHA-256 of all words), lows (distinct minimisers, and how many windows have each)."""

    def run(batches):
        pair = pa.list_(pa.struct([("low", pa.int64()), ("n", pa.int64())]))
        for b in batches:
            n, whole, lows = [], [], []
            for t in b.column(2).to_pylist():
                words = t.encode().split()
                n.append(len(words))
                whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
                own = np.unique(_minimisers(words, window), return_counts=True) if len(words) >= window else None
                lows.append(None if own is None else [{"low": k, "n": c} for k, c in zip(own[0].tolist(), own[1].tolist(), strict=True)])
            made = [pa.array(n, pa.int64()), pa.array(whole, pa.string()), pa.array(lows, pair)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=["id", "h", "n_words", "whole", "lows"])

    return map_texts(df, run, f"id {_kind(df)}, h long, n_words long, whole string, lows array<struct<low:long,n:long>>")


def _kind(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def _super_kmers(df: DataFrame, window: int) -> DataFrame:
    """(bucket, packed, digest, id, h, at) of each stretch of windows whose minimiser is shared; hot ones window by window.

    Equal strings of a document are one row: at lists the words that they start at.
    """

    def run(batches):
        names = ["bucket", "packed", "digest", "id", "h", "at"]
        for b in batches:
            kinds = [pa.int64(), pa.binary(), pa.binary(), b.column(0).type, pa.int64(), pa.list_(pa.int32())]
            rows: list[list] = [[] for _ in names]
            size = 0
            for i, h, t, shared in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = t.encode().split()
                low = _minimisers(words, window)
                hot = {x["low"]: x["hot"] for x in shared}
                own: dict[bytes, tuple] = {}
                for s, e in zip(*(c.tolist() for c in _stretches(low)), strict=True):
                    m = int(low[s])
                    if m not in hot:
                        continue
                    for at, end in ((k, k + 1) for k in range(s, e)) if hot[m] else ((s, e),):
                        packed = b" ".join(words[at : end + window - 1])
                        digest = xxhash.xxh3_128_digest(packed)
                        if digest in own:
                            own[digest][2].append(at)
                        else:
                            own[digest] = (int.from_bytes(digest[:8], "little", signed=True) if hot[m] else m, packed, [at])
                for digest, (bucket, packed, at) in own.items():
                    for c, v in zip(rows, (bucket, packed, digest, i, h, at), strict=True):
                        c.append(v)
                    size += len(packed)
                    if len(rows[0]) > OUT_ROWS or size > OUT_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)
                        rows, size = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)

    return map_texts(df, run, f"bucket long, packed binary, digest binary, id {_kind(df)}, h long, at array<int>")


def _sortable(i: int | dict) -> object:
    return (i["none"], i["key"]) if isinstance(i, dict) else i


def _ranks(packed: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank, begin): a number per window, equal for equal windows alone, string after string; and where each string's windows begin.

    Words become numbers; sorting pairs of ranks doubles the length that a rank stands for, so windows are compared word
    by word without being written out.
    """
    numbers: dict[bytes, int] = {}
    rank = np.array([numbers.setdefault(w, len(numbers)) for p in packed for w in p.split(b" ")], np.int64)
    size = np.array([p.count(b" ") + 1 for p in packed])
    span = 1
    pair = lambda far: np.unique(rank[: len(rank) - far] * (rank.max() + 1) + rank[far:], return_inverse=True)[1]
    while span * 2 <= window:
        rank, span = pair(span), span * 2
    if span < window:
        rank = pair(window - span)
    first = np.r_[0, np.cumsum(size)]
    inside = np.concatenate([np.arange(a, z - window + 1) for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)])
    return rank[inside], np.r_[0, np.cumsum(size - window + 1)]


def _first_seen(group: list[tuple[bytes, bytes, object]], window: int):
    """Per super-k-mer (packed, digest, least id): digest and runs (from, to, id) of the smallest document each window starts in."""
    if len(group) == 1:
        packed, digest, i = group[0]
        yield digest, [{"from": 0, "to": packed.count(b" ") + 2 - window, "first": i}]
        return
    order = sorted(range(len(group)), key=lambda k: _sortable(group[k][2]))
    rank, begin = _ranks([group[k][0] for k in order], window)
    # strings come by ascending id, so the first place of a rank is that of its smallest document
    _, first, which = np.unique(rank, return_index=True, return_inverse=True)
    least = np.searchsorted(begin, first, side="right") - 1
    least = least[which]
    for k, (a, z) in zip(order, zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True), strict=True):
        own = least[a:z]
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
        # two strings of one document have one id: runs that differ in the string alone are harmless
        yield group[k][1], [{"from": s, "to": e, "first": group[order[int(own[s])]][2]} for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _sorted_buckets(distinct: DataFrame, window: int) -> DataFrame:
    """digest, runs of every distinct super-k-mer; rows arrive sorted by bucket, one bucket at a time is held."""
    of = distinct.schema["id"].dataType

    def rows(batches):
        for b in small_batches(batches):
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    def run(batches):
        kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("first", to_arrow_type(of))]))
        out: list[tuple] = []

        def made():
            return pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.binary()), pa.array([r for _, r in out], kind)], names=["digest", "runs"])

        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            out += _first_seen([(p, d, i) for _, p, d, i in group], window)
            if len(out) > 10_000:
                yield made()
                out = []
        yield made()

    return distinct.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, f"digest binary, runs array<struct<from:int,to:int,first:{of.simpleString()}>>")


def repeats(own: DataFrame, seen: DataFrame, window: int, hot: int, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """id, h, spans (array of from, to: words that some repeated window covers) of texts that have any. own: id, h, text."""
    lows = seen.select("id", "h", F.inline("lows"))
    shared = lows.groupBy("low").agg(F.min("id").alias("a"), F.max("id").alias("z"), F.count("*").alias("docs"), F.sum("n").alias("windows"))
    shared = shared.filter("a < z").select("low", ((F.col("docs") > hot) | (F.col("windows") > hot_windows)).alias("hot"))
    shared = staged(shared, "shared")  # so that the join has an exchange on either side and a minimiser of very many documents is split
    wanted = lows.join(shared, "low").groupBy("id", "h").agg(F.collect_set(F.struct("low", "hot")).alias("shared"))
    packed = staged(_super_kmers(own.join(wanted, ["id", "h"]).select("id", "h", "text", "shared"), window), "super-kmers")
    distinct = packed.groupBy("bucket", "packed", "digest").agg(F.min("id").alias("id"))
    first = _sorted_buckets(distinct.select("bucket", "packed", "digest", "id"), window)
    met = packed.select("digest", "id", "h", "at").join(first, "digest")
    met = met.select("id", "h", "at", F.filter("runs", lambda r: r["first"] < F.col("id")).alias("runs")).filter(F.size("runs") > 0)
    spans = met.select("id", "h", F.explode("at").alias("at"), "runs").select("id", "h", "at", F.inline("runs"))
    spans = spans.select("id", "h", F.struct((F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to") + (window - 1)).alias("to")).alias("span"))
    return spans.groupBy("id", "h").agg(F.collect_set("span").alias("spans"))


def without_repeats(df: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text", with_text: bool = False, hot: int = HOT_DOCUMENTS, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """key, n_words, n_removed, kept_sha256 (and kept, the words that stay, joined by one space) of every row.

    A word goes if a window of `window` words covers it whose word sequence also starts in a row with a smaller key;
    windows are judged on the input. A null text has no words; a null key comes after all others. Rows with one key are
    one document here: none takes from the other. Repeated rows each get a row. An empty table gives none. Other columns
    are not read. Words are what bytes.split() gives, unchanged; keys are of any type that sorts.
    """
    kind = df.schema[key].dataType
    short = isinstance(kind, IntegralType) and (df.agg(F.max(column(key))).first()[0] or 0) < LAST  # a long is free for null
    i = F.coalesce(column(key).cast("long"), F.lit(LAST)) if short else F.struct(column(key).isNull().alias("none"), column(key).alias("key"))
    own = df.select(i.alias("id"), text_or_empty(column(text)).alias("text"))
    own = own.select("id", F.xxhash64("text").alias("h"), "text")
    id_kind = _kind(own)
    seen = staged(_summaries(own, window), "summaries")
    spans = staged(repeats(own, seen, window, hot, hot_windows), "spans")

    def cut(batches):
        for b in batches:
            removed, sha, kept = [], [], []
            for t, found in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                words = t.encode().split()
                edge = np.zeros(len(words) + 1, np.int32)
                for s in found or ():
                    edge[s["from"]] += 1
                    edge[s["to"]] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                left = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
                removed.append(len(words) - int(stay.sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode() if with_text else None)
            made = [pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=["id", "h", "n_removed", "sha", "kept"])

    some = own.join(spans, ["id", "h"], "left" if with_text else "inner").select("id", "h", "text", "spans")
    some = map_texts(some, cut, f"id {id_kind}, h long, n_removed long, sha string, kept string").dropDuplicates(["id", "h"])
    out = seen.select("id", "h", "n_words", "whole").join(some, ["id", "h"], "left")
    back = F.when(F.col("id") != LAST, F.col("id")).cast(kind) if short else F.col("id.key")
    return out.select(back.alias(key), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"), *(["kept"] if with_text else []))
