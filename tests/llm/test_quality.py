"""Quality classifier: the score by brute force, what interactions add, the bound on what is fitted, odd tables."""

import math
import re
import zlib

import numpy as np
import pytest

from tesserae.llm import quality as ql


def slow_features(text):
    """(statistics, word counts by bucket), one character and one word at a time."""
    raw = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    kinds = [0] * (len(ql.MARKS) + 7)
    for c in raw:
        if c in ql.MARKS:
            kinds[ql.MARKS.index(c)] += 1
        else:
            place = 0 if 48 <= c <= 57 else 1 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 3 if c == 32 else 4 if c < 32 else 5 if c >= 128 else 6
            kinds[len(ql.MARKS) + place] += 1
    size, n = max(1, len(raw)), len(words)
    hashes = [zlib.crc32(w) for w in words]
    counts = [0] * ql.BUCKETS
    for h in hashes:
        counts[h % ql.BUCKETS] += 1
    pairs = {a * 31 + b for a, b in zip(hashes, hashes[1:])}
    lines = text.split("\n")
    again = sum(a == b for a, b in zip(hashes, hashes[1:])) / (n - 1) if n > 1 else 0.0
    rest = [math.log1p(n), math.log1p(size), size / max(1, n) / 10, len(set(hashes)) / max(1, n), len(pairs) / max(1, n - 1), again, len(set(lines)) / len(lines), math.log1p(len(lines)), n / len(lines) / 50, max(counts) / max(1, n), len(text) / size]
    return [math.sqrt(k / size) for k in kinds] + rest, counts


def slow_score(m, text):
    stats, counts = slow_features(text)
    size = math.expm1(stats[ql.LOG_SIZE])
    x = []
    for s, mean, dev in zip(stats, m.mean.tolist(), m.dev.tolist(), strict=True):
        x.append(max(-5.0, min(5.0, (s - mean) * (size / (size + 50)) / dev)))
    root = [math.sqrt(c) for c in counts]
    length = max(math.sqrt(sum(r * r for r in root)), 1e-6)
    x += [r / length for r in root]
    at = [i for i, v in enumerate(x) if v]
    raw = m.w0 + sum(float(m.w[i]) * x[i] for i in at)
    raw += sum(float(m.v[i] @ m.v[j]) * x[i] * x[j] for k, i in enumerate(at) for j in at[k + 1 :])  # every pair
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, raw))))


TEXTS = [None, "", " \n\t", "one", "Two words", "A line, and\nanother line.\nA line, and", "é日本 x y", "BUY!!! NOW!!! " * 20, "word " * 5000, "the quick brown fox jumps over the lazy dog " * 9]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, 7, "m") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, y int, stats string")


def test_scores_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    train = [(i, " ".join(rng.choice(["good", "fine", "well", "spam", "junk!", "BUY"], 12, p=[0.3, 0.3, 0.3, 0.03, 0.03, 0.04] if i % 2 else [0.05, 0.05, 0.1, 0.3, 0.2, 0.3]))) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    m = ql.train(table(spark, train), labels)
    rows = [*enumerate(TEXTS), (3, "one"), (None, "good spam")]
    got = ql.quality_scores(table(spark, rows), m).collect()
    want = sorted(((i is None, i or 0, slow_score(m, t or "")) for i, t in rows))
    assert [(a, b) for a, b, _ in want] == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got)
    for r, (_, _, s) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["score"])), want, strict=True):
        assert r["score"] == pytest.approx(s, abs=2e-3) and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    kept = ql.keep_quality(table(spark, rows), m)
    assert kept.columns == table(spark, rows).columns and sorted(map(str, kept.select("doc_id").collect())) == sorted(f"Row(doc_id={r['doc_id']})" for r in got if r["predicted"])


def test_interactions_are_needed():
    """Good if exactly one of two words is there: no sum of single words can tell, pairs can."""
    rng = np.random.default_rng(1)
    n = 3000
    a, b = rng.random(n) < 0.5, rng.random(n) < 0.5
    cache = {}
    texts = [" ".join(rng.permutation([*(["apple"] * 4 if x else []), *(["pear"] * 4 if y else []), *rng.choice([f"w{i}" for i in range(30)], 8)])) for x, y in zip(a, b, strict=True)]
    made = [ql.text_features(t, cache) for t in texts]
    stats, counts = np.zeros((n, ql.N_STATS), np.float32), np.stack([c for _, c in made]).astype(np.float32)  # words alone
    y = (a != b).astype(np.float32)
    m = ql.FactorisationMachine(ql.N_STATS + ql.BUCKETS)
    m.fit(stats[:2000], counts[:2000], y[:2000])
    whole = ((m.score(stats[2000:], counts[2000:]) >= 0.5) == y[2000:]).mean()
    flat = ql.FactorisationMachine(ql.N_STATS + ql.BUCKETS)
    flat.v[:] = 0
    flat.fit(stats[:2000], counts[:2000], y[:2000])
    assert not flat.v.any()
    linear = ((flat.score(stats[2000:], counts[2000:]) >= 0.5) == y[2000:]).mean()
    assert whole > 0.9 and linear < 0.75, (whole, linear)


def test_bounded_fit(spark, monkeypatch):
    """A labelled key of very many rows counts once."""
    seen = []
    monkeypatch.setattr(ql.FactorisationMachine, "fit", lambda self, stats, counts, y: seen.append(len(y)))
    df = table(spark, [(5, f"x {i}") for i in range(500)] + [(i, "y") for i in range(40)])
    ql.train(df, spark.createDataFrame([(i, 1) for i in range(40)] * 3, "doc_id long, quality int"), sample=20)
    assert seen == [20]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    got = ql.quality_scores(docs, ql.train(docs, labels)).filter("held_out").join(labels.select("doc_id", "quality"), "doc_id")
    right, n = got.filter("predicted = quality").count(), got.count()
    assert n > 20 and right / n >= 0.95
