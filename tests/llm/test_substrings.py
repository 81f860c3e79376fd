"""Substring dedup: odd keys, hot and periodic texts, and the ranks behind it, against brute force."""

import hashlib
import time

import numpy as np
import pytest

from tesserae.llm import substring_dedup as sd


def slow(rows, window):
    """(key, n_words, n_removed, sha) of every row; null keys come last."""
    place = lambda k: (k is None, k)
    first = {}
    for k, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            s = tuple(w[i : i + window])
            first[s] = min(first.get(s, place(k)), place(k))
    out = []
    for k, t in rows:
        w = (t or "").encode().split()
        stay = np.ones(len(w), bool)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < place(k):
                stay[i : i + window] = False
        out.append((k, len(w), int((~stay).sum()), hashlib.sha256(b" ".join(x for x, s in zip(w, stay, strict=True) if s)).hexdigest()))
    return sorted(out, key=repr)


def result(df, **more):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in sd.without_repeats(df, **more).collect()), key=repr)


def texts(seed, n):
    rng = np.random.default_rng(seed)
    blocks = [" ".join(f"b{j}w{i}" for i in rng.integers(0, 40, 30)) for j in range(6)] + ["same " * 45, "x y " * 20, "p q r " * 30]
    return [" ".join(rng.choice(blocks, rng.integers(0, 6))) + rng.choice(["", " tail", "\n"]) for _ in range(n)]


@pytest.mark.parametrize("hot,windows", [(10_000, 2_000_000), (2, 2_000_000), (10_000, 10)])
def test_against_brute_force(spark, hot, windows):
    rows = [*enumerate(texts(1, 40)), (None, texts(1, 40)[3]), (None, texts(1, 40)[4]), (3, texts(1, 40)[9]), (7, None), (7, "")]
    df = spark.createDataFrame([(*r, 1, 2, "x", 4) for r in rows], "doc_id long, text string, id int, h int, low string, spans int").repartition(3)
    assert result(df, window=20, hot=hot, hot_windows=windows) == slow(rows, 20)


def test_keys_of_any_kind(spark):
    t = " ".join(f"w{i}" for i in range(60))
    for kind, keys in (("long", [sd.LAST, None, sd.LAST - 1]), ("string", ["b", "a", None]), ("int", [-5, None, 3]), ("long", [-(1 << 63), 0, sd.LAST])):
        rows = [(k, t) for k in keys]
        assert result(spark.createDataFrame(rows, f"doc_id {kind}, text string")) == slow(rows, 50)


def test_ranks():
    rng = np.random.default_rng(0)
    packed = [" ".join(map(str, rng.integers(0, 3, n))).encode() for n in (7, 7, 20, 300)]
    for window in (7, 5, 1, 4):
        rank, begin = sd._ranks(packed, window)
        every = [tuple(p.split()[i : i + window]) for p in packed for i in range(len(p.split()) - window + 1)]
        assert begin[-1] == len(every) == len(rank)
        assert len(set(zip(rank.tolist(), every, strict=True))) == len(set(every)) == len(set(rank.tolist()))


def test_a_long_text_of_one_word(spark):
    """20 MB of one word, twice: windows are never written out."""
    long = "word " * 4_000_000
    rows = [(1, long), (2, long + "end"), (3, "word " * 60)]
    t = time.time()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in sd.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (4_000_000, 0), 2: (4_000_001, 4_000_000), 3: (60, 60)} and time.time() - t < 200
