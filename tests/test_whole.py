"""Queries that read whole tables, against brute force."""

import datetime as dt
import math

from tesserae import registry

SF = "/root/testdata/sf0.001"


def rows(spark, name, sf_dir=SF):
    return [r.asDict(recursive=True) for r in registry.queries()[name](spark, sf_dir).collect()]


def test_whole_intervals(spark):
    day = lambda d: (dt.date.fromisoformat(str(d)[:10]) - dt.date(1992, 1, 1)).days
    table = lambda n, *c: spark.read.parquet(f"{SF}/{n}.parquet").select(*c).collect()
    feats = [(k, c, day(d), day(d) + 1 + k % 20) for k, c, d in table("orders", "o_orderkey", "o_orderpriority", "o_orderdate")]
    chrom = {k: c for k, c, _, _ in feats}
    want = {}
    for k, i, d in table("lineitem", "l_orderkey", "l_linenumber", "l_shipdate"):
        ids = [f for f, c, s, e in feats if c == chrom.get(k) and day(d) < e and s < day(d) + 2]
        if ids:
            want.setdefault(k * 10 + i, []).append((len(ids), min(ids), max(ids)))
    got = {}
    for r in rows(spark, "interval_overlaps"):
        got.setdefault(r["left_id"], []).append((r["n"], r["least"], r["most"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and any(k // 10 % 20 for k in got)
    seen = rows(spark, "interval_segments")
    for r in seen:
        assert r["ids"] == ",".join(map(str, sorted(f for f, c, s, e in feats if c == r["chrom"] and s < r["end"] and r["start"] < e)))
    assert {i for r in seen for i in r["ids"].split(",")} == {str(f) for f, *_ in feats}


def test_whole_signatures(spark, tmp_path):
    names = ["click", "view", "click"] * 3 + ["purchase", "view", "click", "purchase"]
    own = [(i, 7, dt.datetime(2024, 1, 1, 0, i), n, 1.0) for i, n in enumerate(names)] + [(99, 8, dt.datetime(2024, 1, 1), "view", 1.0)]
    spark.createDataFrame(own, "event_id long, user_id long, ts timestamp, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = lambda name: rows(spark, name, str(tmp_path))
    assert sum(r["n"] for r in got("part_starts")) == len(own)
    assert {(r["prefix"], r["n"]) for r in got("completeness")} == {("view,click,purchase", 1), ("view", 1)}
    assert [(r["qname"], r["start"]) for r in got("first_occurrence")] == [("7/2024-01-01", 100)]
    assert {r["signature"] for r in got("signature_counts")} == {"?click+", "view"}
    assert {r["parts"]: r["n"] for r in got("synthesis_rates")} == {1: 2, 2: 1, 3: 1}
    assert sum(r["n"] for r in got("relative_names")) == 2 and {(r["qname"], r["gap_start"]) for r in got("pair_gaps")} == {("7/2024-01-01", 25), ("8/2024-01-01", None)}


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_whole_texts(spark, tmp_path):
    text = "abcd" * 30 + "eee" + "f" * 5000
    spark.createDataFrame([(1, text, "en", "a", len(text)), (2, "?", "en", "a", 1), (3, None, "en", "a", 0)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    seq = "ACGT" * 30 + "NNN" + "A" * 5000
    got = rows(spark, "kmer_positions", str(tmp_path))
    assert sorted((r["position"], r["kmer"], r["n"]) for r in got) == [(i, seq[i : i + 3], 1) for i in range(len(seq) - 2)]
    (r,) = rows(spark, "barcode_compression", str(tmp_path))
    assert (r["runs"], r["compressed"]) == (122, 120 * 2 + 2 + 5)
    (r,) = rows(spark, "barcode_entropy", str(tmp_path))
    share = [seq.count(c) / len(seq) for c in "ACGTN"]
    assert r["entropy"] == round(-sum(p * math.log2(p) for p in share), 2) and len(r["reverse_complement"]) == len(seq)


def test_whole_union(spark, tmp_path):
    spark.createDataFrame([(i, "x", "en", "a", 10) for i in (-2, -1, 0, 1, 2, 3, 4, 5, 5, None)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r["n"], r["n_chars"]) for r in rows(spark, "united_parts", str(tmp_path))] == [(10, 100)]
