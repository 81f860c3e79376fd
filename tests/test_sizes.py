"""Queries on tables of a size or shape at which they once failed, against their SQL."""

import random
import time

import pytest
from oracle import connect, differences

from tesserae import registry
from tesserae.operators import intervals
from tesserae.sources import bam

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def unmerged(spark):
    """Every shuffle partition becomes a file, as on large tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def against_sql(spark, name, sf_dir):
    return differences(registry.queries()[name](spark, sf_dir), connect(sf_dir), registry.oracle_sql()[name])


def test_triples_from_several_files(spark, tmp_path, unmerged):
    rows = [(i, f"text {i}" * (i % 5), ("en", "de", "fr")[i % 3], f"s{i % 7}", 6) for i in range(200)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert against_sql(spark, "triples_by_format", str(tmp_path)) == ""


def test_dense_matrix_of_many_cells(spark, tmp_path):
    """A column each for so many cells is more than a driver can plan."""
    e = spark.range(60_000).selectExpr("id AS event_id", "timestamp'2024-01-01' AS ts", "if(id % 11 = 0, null, id % 19997) AS user_id", "if(id % 7 = 0, null, concat('g', id % 3)) AS event_type", "1.0D AS value", "'{}' AS props")
    e.write.parquet(f"{tmp_path}/events.parquet")
    assert against_sql(spark, "dge_text_scan", str(tmp_path)) == ""


def test_block_counts(spark, monkeypatch):
    """Many small buckets, features at several chromosomes and of all lengths, repeats, against brute force."""
    rng = random.Random(3)
    monkeypatch.setattr(intervals, "TABLE", 800)  # 64 features in a bucket
    place = lambda most: (rng.choice("ab"), s := rng.randrange(5000), s + rng.randrange(1, most))
    feats = [(rng.randrange(400), *place(rng.choice((2, 9, 300, 3000)))) for _ in range(900)]
    blocks = [(rng.randrange(150), *place(20)) for _ in range(400)] * 2 + [(None, "a", 0, 5000), (7, None, 0, 10), (999, "c", 0, 9)]
    b = spark.createDataFrame(blocks, "read long, chrom string, start long, end long")
    f = spark.createDataFrame(feats, "right_id long, chrom string, start long, end long")
    want = {}
    for read, c, s, e in blocks:
        want.setdefault(read, set()).update(i for i, d, t, g in feats if c == d and s < g and t < e)
    got = intervals.block_counts(b, f, ["chrom"]).collect()
    assert len(got) == len({r["read"] for r in got}) and {r["read"]: r["n"] for r in got} == {k: len(v) for k, v in want.items() if v}


def test_block_counts_of_dense_places(spark):
    """2.4e9 pairs of a read and a feature are never listed."""
    f = spark.range(200_000).selectExpr("id AS right_id", "'a' AS chrom", "id % 50 AS start", "id % 50 + 60 AS end")
    b = spark.range(36_000).selectExpr("id div 3 AS read", "'a' AS chrom", "id % 40 AS start", "id % 40 + 20 + id % 3 AS end")
    t = time.time()
    n = {r["read"]: r["n"] for r in intervals.block_counts(b, f, ["chrom"]).collect()}
    assert len(n) == 12_000 and time.time() - t < 90
    assert all(n[k] == 4000 * sum(any(i % 40 < s + 60 and s < i % 40 + 20 + i % 3 for i in range(3 * k, 3 * k + 3)) for s in range(50)) for k in range(0, 12_000, 97))


def test_bam_in_blocks(spark, tmp_path):
    """A file is decoded by as many tasks as it has blocks, numbers and names as in one; one whose records cross members is one task."""
    df = spark.range(30_000).repartition(7).selectExpr("concat('r', id) AS qname", "4 * int(id % 2) AS flag", "if(id % 2 = 0, concat('c', id % 3), '*') AS rname", "int(id % 900) AS pos", "255 AS mapq", "concat(id % 90 + 1, 'M') AS cigar",
        "substr(repeat('ACGTNacgtn', 10), 1, int(id % 90) + 1) AS seq", "substr(repeat(concat('!I~', char(40 + id % 50)), 25), 1, int(id % 90) + 1) AS qual", "map('CB', sha2(string(id), 256), 'NH', string(id % 4), 'XZ', '') AS tags")
    path = str(tmp_path / "x.bam")
    bam.write_bam(df, path, {"c0": 1000, "c1": 1000, "c2": 1000})
    data = (tmp_path / "x.bam").read_bytes()
    whole = b"".join(bam.inflated(data))
    (tmp_path / "y.bam").write_bytes(b"".join(bam.member(whole[i : i + 5000]) for i in range(0, len(whole), 5000)) + bam.END_OF_FILE)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        x, y = bam.read_bam(spark, path), bam.read_bam(spark, str(tmp_path / "y.bam"))
        both = bam.read_bam(spark, str(tmp_path / "*.bam"))
        assert x.rdd.getNumPartitions() > 4 and y.rdd.getNumPartitions() == 1
        rows = lambda d: [tuple(r) for r in d.orderBy("record_no").drop("file").collect()]
        assert rows(x) == rows(y) and [r[0] for r in rows(x)] == list(range(30_000)) and both.count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = df.selectExpr("qname", "flag", "rname", "pos", "mapq", "cigar", "upper(seq) AS seq", "qual", "tags['CB'] AS cb", "tags['NH'] AS nh", "tags['XZ'] AS xz")
    got = x.selectExpr("qname", "flag", "rname", "pos", "mapq", "cigar", "seq", "qual", "tags['CB'] AS cb", "tags['NH'] AS nh", "tags['XZ'] AS xz")
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
