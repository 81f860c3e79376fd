"""Document fingerprints: who follows whom with null, repeated and heavy keys, and differences that no sketch recovers."""

import pytest
from pyspark.sql import functions as F

from tesserae.llm import lookup_sketch as ls


def order_of(rows):
    """Keys by descending value, null last; rows of one key in any order."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


@pytest.mark.parametrize("bucket", [2, 7, 1024])
def test_next_with_heavy_keys(spark, monkeypatch, bucket):
    monkeypatch.setattr(ls, "BUCKET_ROWS", bucket)
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [(5, f"five {i}") for i in range(60)] + [(None, f"none {i}") for i in range(40)] + [(i, f"t{i}") for i in range(-20, 20)] + [(low, "low"), (high, "high"), (high, "high"), (5, "five 0")]
    df = spark.createDataFrame(rows, "key long, text string").repartition(5)
    got = ls.with_next(df, "key", ["text"]).select("key", "text", F.col("next.text").alias("next")).collect()
    assert sorted((r["key"] is None, r["key"] or 0, r["text"]) for r in got) == sorted((k is None, k or 0, t) for k, t in rows)
    # following from row to row visits every row once, in the order of keys
    after = {}
    for r in got:
        after.setdefault(r["text"], []).append(r["next"])
    keys = dict((t, k) for k, t in rows)
    assert sorted(n for v in after.values() for n in v) == sorted(t for _, t in rows)
    walk, at = [], "high"
    while any(after.values()):
        own = after[at]
        if not own:
            break
        nxt = at if at in own else own[0]  # a repeated row is followed by itself first
        own.remove(nxt)
        walk.append(at)
        at = nxt
    assert len(walk) == len(rows) and at == "high"
    assert [keys[t] for t in walk] == [k for k, _ in order_of(rows)]
    again = ls.with_next(df.repartition(2), "key", ["text"]).select("text", F.col("next.text").alias("next")).collect()
    assert sorted((r["text"], r["next"]) for r in got) == sorted((r["text"], r["next"]) for r in again)


def test_unrecovered_bins_are_compared(spark, monkeypatch):
    """Sketches of one cell a row recover next to nothing; the difference is exact all the same."""
    monkeypatch.setattr(ls, "TRIES", ((1, (0, 3, 6)), (1, (9, 12, 15))))
    df = spark.createDataFrame([(list(range(0, 200)), list(range(100, 350))), ([], [1, 2]), ([7], [7])], "a array<long>, b array<long>")
    d = ls.difference(F.col("a"), F.col("b"), ls.sketch(F.col("a")), ls.sketch(F.col("b")))
    assert [(r["d"]["ok"], r["d"]["a"], r["d"]["b"]) for r in df.select(d.alias("d")).collect()] == [(True, 100, 150), (True, 0, 2), (True, 0, 0)]


def test_keys_must_be_integers(spark):
    with pytest.raises(TypeError):
        ls.fingerprints(spark.createDataFrame([("a", "x")], "doc_id string, text string"))
