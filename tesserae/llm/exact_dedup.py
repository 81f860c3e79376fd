"""Exact deduplication: a static binary-fuse filter per immutable snapshot, exact buckets behind it.

Digests of a new batch are grouped among themselves, then screened shard by shard against the snapshot's filters.
Positives meet the snapshot's exact digests; texts behind a shared digest are compared byte for byte.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tesserae.llm.common import column, row_mark, staged, text_or_empty

U = np.uint64
#: Keys of a filter shard, at most on average; a shard is built and probed in one task, and there is one per task at least.
SHARD_KEYS = 1 << 15


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A strong 64-bit finaliser over key + seed (wrapping arithmetic)."""
    x = keys + U((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class BinaryFuse:
    """A static approximate set of 64-bit keys: three cells in adjacent segments whose XOR is the key's 8-bit print."""

    def __init__(self, seed: int, segment: int, cells: np.ndarray):
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def _slots(keys: np.ndarray, seed: int, segment: int, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
        h = _mixed(keys, seed)
        first = (((h >> U(32)) * U(n_cells // segment - 2)) >> U(32)).astype(np.int64)
        step = U(segment - 1)
        at = [(first + i) * segment + ((h >> U(shift)) & step).astype(np.int64) for i, shift in enumerate((0, 14, 18))]
        return np.stack(at), (_mixed(h, 7) & U(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        """Peels cells that one key alone uses, round after round; another seed (and in time more room) where that stalls."""
        keys = np.unique(keys.astype(U))
        n = len(keys)
        segment = 1 << max(2, min(14, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
        for seed in range(1, 200):
            room = (1.125 if n > 50_000 else 1.3) + 0.02 * seed
            n_cells = max(3, math.ceil(n * room / segment) + 2) * segment
            at, prints = cls._slots(keys, seed, segment, n_cells)
            count = np.bincount(at.ravel(), minlength=n_cells)
            owner = np.zeros(n_cells, np.int64)  # XOR of the key numbers in a cell: the key itself once it is alone
            for row in at:
                np.bitwise_xor.at(owner, row, np.arange(n))
            order: list[tuple[np.ndarray, np.ndarray]] = []
            done = 0
            while len(alone := np.flatnonzero(count == 1)):
                who, first = np.unique(owner[alone], return_index=True)
                order.append((who, alone[first]))
                done += len(who)
                for row in at[:, who]:
                    np.subtract.at(count, row, 1)
                    np.bitwise_xor.at(owner, row, who)
            if done == n:
                cells = np.zeros(n_cells, np.uint8)
                for who, cell in reversed(order):
                    cells[cell] = 0
                    cells[cell] = prints[who] ^ cells[at[0, who]] ^ cells[at[1, who]] ^ cells[at[2, who]]
                return cls(seed, segment, cells)
        raise ValueError("no seed peels these keys")

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at, prints = self._slots(keys.astype(U), self.seed, self.segment, len(self.cells))
        return (self.cells[at[0]] ^ self.cells[at[1]] ^ self.cells[at[2]]) == prints


def snapshot_filters(digests: DataFrame, shards: int) -> DataFrame:
    """One filter row per shard of a snapshot's distinct digests: shard, seed, segment, cells."""

    def build(t: pa.Table) -> pa.Table:
        f = BinaryFuse.build(t["key"].to_numpy())
        return pa.table({"shard": t["shard"][:1], "seed": [f.seed], "segment": [f.segment], "cells": [f.cells.tobytes()]}, schema=pa.schema([("shard", pa.int64()), ("seed", pa.int32()), ("segment", pa.int32()), ("cells", pa.binary())]))

    return _sharded(digests, shards).groupBy("shard").applyInArrow(build, "shard long, seed int, segment int, cells binary")


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    """key: 64 bits of the digest; shard: other bits of it, so equal digests share both."""
    return groups.withColumn("key", F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")).withColumn("shard", F.pmod(F.conv(F.substring(F.hex("digest"), 17, 15), 16, 10).cast("long"), F.lit(shards)))


def screened(groups: DataFrame, filters: DataFrame, shards: int, parts: int = 1) -> DataFrame:
    """groups with `positive`: whether the snapshot's filter may hold the digest (never false for one it holds).

    A shard's digests are probed in `parts` tasks, each with a copy of its filter, so a batch may outgrow the snapshot.
    """
    names = ["digest", "keeper", "n"]

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            hit = np.zeros(left.num_rows, bool)
        else:
            f = right.to_pylist()[0]
            hit = BinaryFuse(f["seed"], f["segment"], np.frombuffer(f["cells"], np.uint8)).may_hold(left["key"].to_numpy())
        return left.select(names).append_column("positive", pa.array(hit))

    schema = ", ".join(f"{c} {groups.schema[c].dataType.simpleString()}" for c in names) + ", positive boolean"
    left = _sharded(groups, shards).withColumn("part", F.pmod("key", F.lit(parts)))
    right = filters.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(probe, schema)


def _digested(df: DataFrame, old: bool, key: str, text: str, mark: Column) -> DataFrame:
    return df.select(column(key).alias("key"), F.unhex(F.sha2(text_or_empty(column(text)), 256)).alias("digest"), mark.alias("mark"), F.lit(old).alias("old"))


def _grouped(rows: DataFrame) -> DataFrame:
    """digest, keeper (key, mark, old, row: the largest), n."""
    return rows.groupBy("digest").agg(F.max(F.struct("key", "mark", "old", "row")).alias("keeper"), F.count("*").alias("n"))


@dataclass
class Snapshot:
    """An immutable part, digested once: groups (digest, keeper, n), a filter per shard, and a text for each digest."""

    groups: DataFrame
    filters: DataFrame
    texts: DataFrame
    shards: int

    @staticmethod
    def of(rows: DataFrame, texts: DataFrame, least_shards: int) -> Snapshot:
        groups = staged(_grouped(rows), "snapshot")
        shards = max(least_shards, 1 << max(0, math.ceil(math.log2(max(1, groups.count() / SHARD_KEYS)))))
        return Snapshot(groups, staged(snapshot_filters(groups.select("digest"), shards), "filters"), texts, shards)

    @staticmethod
    def write(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> Snapshot:
        """Digest df and write its groups, texts and filters under path; batches that come later only read these."""
        spark = df.sparkSession
        rows = staged(_digested(df, True, key, text, F.lit(0).cast("long")).withColumn("row", F.monotonically_increasing_id()), "digests")
        made = Snapshot.of(rows, _one_text(df, text), _tasks(df))
        made.groups.write.parquet(f"{path}/groups")
        made.filters.withColumn("shards", F.lit(made.shards)).write.parquet(f"{path}/filters")
        made.texts.select("digest", F.col("least").alias("text"), _checked().alias("same")).filter("same").drop("same").write.parquet(f"{path}/texts")
        return Snapshot.load(spark, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Snapshot:
        filters = spark.read.parquet(f"{path}/filters")
        shards = filters.agg(F.max("shards")).first()[0] or 1
        texts = spark.read.parquet(f"{path}/texts").select("digest", F.col("text").alias("least"), F.col("text").alias("most"))
        return Snapshot(spark.read.parquet(f"{path}/groups"), filters.drop("shards"), texts, shards)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _one_text(df: DataFrame, text: str) -> DataFrame:
    """digest, least, most: a digest's texts meet as the smallest and the largest of each task, so copies never travel together."""
    own = df.select(text_or_empty(column(text)).alias("text")).select("text", F.unhex(F.sha2("text", 256)).alias("digest"))
    return own.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))


def _checked() -> Column:
    return F.when(F.col("least") != F.col("most"), F.raise_error(F.lit("two texts with one SHA-256")).cast("boolean")).otherwise(F.lit(True))


def _merged(df: DataFrame, snapshot: DataFrame | Snapshot | None, key: str, text: str, mark: Column) -> tuple[DataFrame, DataFrame]:
    """(rows: key, digest, mark, old, row; groups: digest, keeper, n) of df and, where it is a table, snapshot; texts checked byte for byte."""
    rows = _digested(df, False, key, text, mark)
    texts = df.select(column(text).alias("text"))
    if isinstance(snapshot, DataFrame):
        rows = rows.unionByName(_digested(snapshot, True, key, text, mark))
        texts = texts.unionByName(snapshot.select(column(text).alias("text")))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    groups = _grouped(rows.filter(~F.col("old")))
    seen = _one_text(texts, "text")
    if snapshot is not None:
        if isinstance(snapshot, DataFrame):
            snapshot = Snapshot.of(rows.filter("old"), None, _tasks(df))
        groups = staged(groups, "batch")
        found = staged(screened(groups, snapshot.filters, snapshot.shards, max(1, math.ceil(groups.count() / (snapshot.shards * 4 * SHARD_KEYS)))), "screened")
        positive = found.filter("positive").select("digest", "keeper", "n")
        # exact buckets: positives that the snapshot really holds are merged into its groups
        bucket = snapshot.groups.select("digest", "keeper", "n")
        if snapshot.texts is not None:  # its rows aren't asked for, so only the groups and texts that positives meet matter
            bucket = bucket.join(positive.select("digest"), "digest", "left_semi")
            seen = seen.unionByName(snapshot.texts.join(positive.select("digest"), "digest", "left_semi"))
            seen = seen.groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        met = positive.unionByName(bucket).groupBy("digest").agg(F.max("keeper").alias("keeper"), F.sum("n").alias("n"))
        groups = met.unionByName(found.filter(~F.col("positive")).select("digest", "keeper", "n"))
    groups = staged(groups, "groups")
    # the byte check: every digest of two rows or more has one text
    checked = seen.join(groups.filter("n > 1").select("digest"), "digest", "left_semi").select("digest", _checked().alias("same"))
    # written, so that a later join has an exchange on either side and a digest of very many rows is split
    return rows, staged(groups.join(checked, "digest", "left").filter(F.coalesce("same", F.lit(True))).drop("same"), "checked")


def exact_groups(df: DataFrame, snapshot: DataFrame | Snapshot | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, keep_id, group_size, kept, text_sha256 of every row of df and of snapshot, an immutable earlier part.

    The snapshot is a table, whose rows are returned too, a Snapshot, which is only probed, or None: nothing. Of equal
    texts the row with the largest key stays, whichever part it is in; exactly one row of a group is kept even where
    rows repeat (a null key ranks lowest). Null texts count as empty and are one group. An empty table gives no rows.
    Other columns are not read. Two texts behind one SHA-256 would stop the job.
    """
    rows, groups = _merged(df, snapshot, key, text, F.lit(0).cast("long"))
    out = rows.join(groups, "digest")
    kept = (F.col("row") == F.col("keeper.row")) & (F.col("old") == F.col("keeper.old"))
    return out.select(F.col("key").alias(key), F.col("keeper.key").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def arrivals(df: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame | None]:
    """(batch, snapshot) of one table: the lower half of the key's range, or of a hash of keys that are no integers, stands for what came earlier."""
    if isinstance(df.schema[key].dataType, IntegralType):
        least, most = df.agg(F.min(column(key)), F.max(column(key))).first()
        if least is None:
            return df, None
        old = F.coalesce(column(key) <= (least + most) // 2, F.lit(False))
    else:
        old = F.xxhash64(column(key)) < 0
    return df.filter(~old), df.filter(old)


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (every column) of each group of equal texts in df: that with the largest key, of rows with one key that with the largest hash; see arrivals.

    Null texts count as empty; a null key ranks lowest; rows alike in every column count once. An empty table gives no
    rows. Columns may have any names.
    """
    own = df.select(F.struct("*").alias("row"), column(key).alias("key"), column(text).alias("text"), row_mark(df).alias("mark"))
    _, groups = _merged(*arrivals(own, "key"), "key", "text", F.col("mark"))
    kept = groups.select(F.struct("keeper.key", "keeper.mark").alias("own"))
    # repeats of a row meet in their tasks before they travel
    return own.groupBy(F.struct("key", "mark").alias("own")).agg(F.first("row").alias("row")).join(kept, "own", "left_semi").select("row.*")
