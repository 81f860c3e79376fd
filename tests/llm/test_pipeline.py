"""The pipeline's stages, each on what the one before it kept, and the queries with SQL."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from oracle import connect, differences

sys.path.insert(0, str(Path(__file__).parent))
from test_corpus_operators import brute_components, slow_fingerprint, slow_targets  # noqa: E402
from test_quality import slow_score  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline
    from tesserae.llm.common import staged, table

    docs = table(spark, SF, "documents")
    columns, n = docs.columns, docs.count()
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        if name in ("quality", "exact", "near"):
            assert docs.columns == columns and docs.count() <= n
            n = docs.count()
            assert docs.select("doc_id").distinct().count() == n
        if name == "exact":
            assert docs.select("text").distinct().count() == n
    assert "sequence_id" in docs.columns
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


@pytest.mark.parametrize("name", ["secrets_base", "mixing_targets", "op8_substring_dedup", "op10_exact_dedup"])
def test_sql(spark, name):
    from tesserae.llm import queries

    assert differences(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == ""


def corpus():
    """(doc_id, text, source): prose, its copies and near copies, junk, empty texts, null and repeated keys."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ep", "ze") for b in ("pha", "ta", "mma", "lta", "silon", "nu", "xi")]
    prose = [" ".join(rng.choice(words, rng.integers(60, 200))) + "." for _ in range(40)]
    rows = [(i, t, "abc"[i % 3]) for i, t in enumerate(prose)]
    rows += [(100 + i, prose[i], "d") for i in range(6)] + [(200 + i, prose[i + 10] + " end", "a") for i in range(6)]
    rows += [(300 + i, "BUY NOW!!! $$$ " * (20 + i), "b") for i in range(12)] + [(400, None, "a"), (401, "", None), (None, prose[3] + " more", "a"), (7, prose[20], "a"), (8, prose[8], "c")]
    return rows


def test_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    from tesserae.llm import quality as ql
    from tesserae.llm.common import staged, table

    own = [(i, t, "en", s, len(t or "")) for i, t, s in corpus()]
    spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(not (t or "$").count("$")), 0) for i, t, _ in corpus() if i is not None and i != 401]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)
    docs = table(spark, sf, "documents")
    machine = ql.train(docs, table(spark, sf, "labels"))
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf), name)
        got[name] = docs.collect()
    plain = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)

    want = Counter((i, t) for i, t, *_ in own if slow_score(machine, t or "") >= 0.5)
    assert plain(got["quality"]) == want and sum(want.values()) < len(own)

    best = {}
    for i, t in want:
        best[t or ""] = max(best.get(t or "", (-1, "")), (-1 if i is None else i, t or ""))
    assert {(-1 if i is None else i, t or "") for i, t in plain(got["exact"])} == set(best.values()) and len(got["exact"]) == len(best)

    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in got["exact"]))
    label = brute_components([slow_fingerprint(t) for _, _, t in rows])
    least = {}
    for k, r in enumerate(rows):
        least.setdefault(label[k], r[:2])
    near = Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in got["near"])
    assert near == Counter(least.values()) and len(got["near"]) < len(got["exact"])

    size = lambda r: len((r["text"] or "").encode().split())
    sizes, taken, times = Counter(), Counter(), Counter()
    for r in got["near"]:
        sizes[r["source"]] += size(r)
    for r in got["mix"]:
        taken[r["source"]] += size(r)
        times[r["doc_id"]] += 1
        assert r["n_chars"] == len(r["text"])
    assert all(abs(taken[s] - t) <= 0.5 for s, t in slow_targets(dict(sizes)).items()) and max(times.values()) <= 3

    encoder = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for r in got["mix"]:
        ids.setdefault(r["doc_id"], []).append(np.array(encoder.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4"))
    tokens, sequences = Counter(), {}
    for r in got["pack"]:
        tokens[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    assert tokens == {i: sum(map(len, x)) for i, x in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0


def test_without_a_module(monkeypatch):
    """A module that can't be imported takes the corpus queries away, and no others."""
    import builtins

    import __spark_entry__

    for name in [n for n in sys.modules if n.startswith("tesserae.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def blocked(name, *args, **more):
        if name == "tiktoken":
            raise ModuleNotFoundError(name)
        return real(name, *args, **more)

    monkeypatch.setattr(builtins, "__import__", blocked)
    names = __spark_entry__.queries()
    assert "tag_histogram" in names and "op7_packing" not in names and "pipeline" not in names
