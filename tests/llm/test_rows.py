"""Row identity (null and repeated keys, clashing names), hot buckets, many sources and saved snapshots."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tesserae.llm import common
from tesserae.llm import exact_dedup as ed
from tesserae.llm import mixing as mx
from tesserae.llm import simhash as sh

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "_kept string, _digest int, _shard int, _key int, row int, mark int, own int, least int, key int, fp int, id int, size int, `a.b` int"


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, 5000, n))


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"], *range(12)) for i, t, s in rows], f"{SCHEMA}, {CLASH}").repartition(3)


ROWS = [(None, prose(80, 1), "a"), (None, prose(80, 2), "a"), (5, prose(80, 3), "b"), (5, prose(80, 4), "b"), (7, prose(80, 3) + " more", "b"), (7, "", None), (8, None, None), (9, "x", "a"), (9, "x", "a")]


def test_near_dedup_tells_rows_apart(spark):
    df = clashing(spark, ROWS)
    kept = sh.near_dedup(df)
    assert kept.columns == df.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    groups = {sh.fingerprint(t or "") for _, t, _ in ROWS}
    assert sum(got.values()) <= len(groups) and set(got.values()) == {1}
    assert (5, prose(80, 4)) in got and (None, prose(80, 1)) in got and (None, prose(80, 2)) in got  # unlike texts of one key all stay
    assert [k for k, t in got if not t] == [7] and (9, "x") in got
    assert sorted(map(str, kept.collect())) == sorted(map(str, sh.near_dedup(df.repartition(5)).collect()))


def test_exact_dedup_tells_rows_apart(spark):
    df = clashing(spark, [*ROWS, (3, prose(80, 1), "z"), (None, prose(80, 2), "other")])
    kept = ed.exact_dedup(df)
    assert kept.columns == df.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == {(3, prose(80, 1)): 1, (None, prose(80, 2)): 1, (5, prose(80, 3)): 1, (5, prose(80, 4)): 1, (7, prose(80, 3) + " more"): 1, (8, None): 1, (9, "x"): 1}
    assert sorted(map(str, kept.collect())) == sorted(map(str, ed.exact_dedup(df.repartition(5)).collect()))
    named = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "doc_id string, text string")
    assert sorted(r["doc_id"] for r in ed.exact_dedup(named).collect()) == ["b", "c"]


def test_mix_tells_rows_apart(spark):
    df = clashing(spark, ROWS)
    out = mx.mix(df, shards=4)
    assert out.columns == df.columns
    words, target = Counter(), {}
    for r in mx.mixture(df, shards=4).collect():
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    taken = Counter()
    for r in out.collect():
        words[r["doc_id"], r["text"]] += 1
        taken[r["source"]] += len(r["text"].split())
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())
    once = Counter((i, t) for i, t, _ in ROWS)
    assert all(n <= 3 * once[k] for k, n in words.items() if k in once)
    three = spark.createDataFrame([(7, "a b c d e", "en", "s", 9)] * 3 + [(8, "x y", "en", "t", 3)], SCHEMA)
    want = {r["source"]: r["target"] for r in mx.mixture(three).collect()}
    got = Counter()
    for r in mx.mix(three).collect():
        got[r["source"]] += len(r["text"].split())
    assert all(abs(got[s] - t) <= 0.5 for s, t in want.items())


def test_many_sources(spark, monkeypatch):
    """100,000 sources: numbered by range, filled by rounds, split by groups of groups; every target is met."""
    monkeypatch.setattr(mx, "SMALL_SOURCES", 1000)
    n = 100_000
    df = spark.range(n).selectExpr("id AS doc_id", "trim(repeat('w ', 1 + id % 3)) AS text", "CASE WHEN id = 7 THEN NULL ELSE 's' || id END AS source").union(spark.range(300).selectExpr("id + 200000", "repeat('big ', 2000)", "'s1'"))
    got = mx.mixture(df, shards=8).select("source", "size", "source_size", "target", "taken").toPandas()
    per = got.groupby("source", dropna=False).agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum")).reset_index()
    order = per.sort_values("source", key=lambda c: c.map(lambda s: (1, b"") if s is None or s != s else (0, s.encode())))
    w = np.array([(5, 2, 1)[i % 3] for i in range(len(order))], float)
    cap = 3.0 * order["size"].to_numpy()
    at = np.argsort(cap / w, kind="stable")
    rest, weight, unit = float(order["size"].sum()), w.sum(), None
    for i in at:
        if cap[i] / w[i] > rest / weight:
            break
        rest, weight = rest - cap[i], weight - w[i]
    unit = rest / weight
    assert np.allclose(order["target"].to_numpy(), np.minimum(cap, unit * w))
    assert (np.abs(order["taken"].to_numpy() - order["target"].to_numpy()) <= 0.5).all() and (got["taken"] <= 3 * got["size"]).all()


def test_grouped_quotas(spark, monkeypatch):
    monkeypatch.setattr(mx, "GROUP", 4)
    quotas = spark.createDataFrame([(i, 1 + i % 5) for i in range(70)], "ix long, n long")
    got = mx.shard_quotas(quotas, 8, 3).collect()
    per, shard = Counter(), Counter()
    for r in got:
        per[r["ix"]] += r["k"]
        shard[r["shard"]] += r["k"]
    assert per == {i: 1 + i % 5 for i in range(70)} and set(shard) == set(range(8)) and max(shard.values()) - min(shard.values()) <= 1


def test_hot_buckets_are_dealt_anew(spark, monkeypatch):
    """A bucket of very many fingerprints, and the pairs that only it holds."""
    rng = np.random.default_rng(2)
    mask = sh.covering_masks(4)[0]
    free = sh.free_places(mask)
    base = int(rng.integers(0, 1 << 62)) & mask
    fps = {base | sum(1 << free[int(j)] for j in rng.choice(len(free), rng.integers(0, 9), replace=False)) for _ in range(3000)}
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    calls = []
    monkeypatch.setattr(sh, "staged", lambda d, name: calls.append(name) or common.staged(d, name))
    for hot in (100, 1 << 20):
        root = {r["node"]: r["root"] for r in sh.components(sh.links(df, 4, hot)).collect()}
        label = sh._labels(fps, 4)
        parts = {}
        for f, k in zip(fps.view(np.int64).tolist(), label.tolist(), strict=True):
            parts.setdefault(k, set()).add(root.get(f, f))
        assert all(len(p) == 1 for p in parts.values()) and len(parts) == len(set(map(min, parts.values())))


def test_forest_of_a_large_bucket():
    """100,000 fingerprints in one bucket, without comparing all pairs."""
    rng = np.random.default_rng(3)
    mask = sh.covering_masks(4)[3]
    free = sh.free_places(mask)
    fps = np.unique(np.array([sum(1 << free[j] for j in np.flatnonzero(b)) for b in rng.random((100_000, len(free))) < 0.5], np.uint64))
    near = fps[:2000] ^ np.uint64(1 << free[0] | 1 << free[9])
    every = np.unique(np.concatenate([fps, near]))
    parent = {int(f): int(f) for f in every}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in sh.forest(every, 4, free):
        assert (np.bitwise_count(a ^ b) <= 28).all()
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            parent[find(x)] = find(y)
    assert all(find(int(a)) == find(int(b)) for a, b in zip(fps[:2000], near, strict=True))
    some = rng.choice(len(every), 300, replace=False)
    for i in some:
        for j in np.flatnonzero(np.bitwise_count(every ^ every[i]) <= 4):
            assert find(int(every[i])) == find(int(every[j]))


def test_saved_snapshot(spark, tmp_path, monkeypatch):
    old = spark.createDataFrame([(1, "x"), (2, "y"), (9, "x"), (3, None)], "doc_id long, text string")
    new = spark.createDataFrame([(4, "x"), (5, "z"), (6, "z"), (7, ""), (10, "y"), (None, "q")], "doc_id long, text string")
    ed.Snapshot.write(old, str(tmp_path / "snap"))
    got = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in ed.exact_groups(new, ed.Snapshot.load(spark, str(tmp_path / "snap"))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(4, sha("x")): (9, 3, False), (5, sha("z")): (6, 2, False), (6, sha("z")): (6, 2, True), (7, sha("")): (7, 2, True), (10, sha("y")): (10, 2, True), (None, sha("q")): (None, 1, True)}
    assert ed.exact_groups(new.limit(0), ed.Snapshot.load(spark, str(tmp_path / "snap"))).count() == 0
    # a large batch, probed in parts, against a small and an empty snapshot
    monkeypatch.setattr(ed, "SHARD_KEYS", 8)
    batch = spark.range(3000).selectExpr("id + 100 AS doc_id", "'t' || (id % 2000) AS text")
    for snap in (old, old.limit(0), spark.range(500).selectExpr("id AS doc_id", "'t' || id AS text")):
        ours = ed.exact_groups(batch, snap)
        assert ours.filter("kept").count() == ours.select("text_sha256").distinct().count() and ours.count() == 3000 + snap.count()


def test_shared_folder_wants_a_shared_folder(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        common.shared_folder(Session())
