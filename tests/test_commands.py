"""Command line, project files, SAM headers, signature catalogs and small sources by hand-made cases."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from tesserae.__main__ import main
from tesserae.operators import catalog, longread, matrix, qc
from tesserae.project import Project
from tesserae.sources import bam, headers, sequences


def test_projects(tmp_path, capsys):
    root = str(tmp_path / "p")
    main(["init", root])
    with pytest.raises(catalog.CatalogError):
        Project.init(root)
    main(["config", root, "add", "run_modes", "fast", "n_beads=5", "umi_cutoff=[1, 2]", "mesh_data=true"])
    main(["config", root, "update", "run_modes", "fast", "n_beads=7"])
    main(["config", root, "add", "species", "mouse"])
    main(["config", root, "delete", "species", "mouse"])
    assert Project.open(root).config.run_mode("fast")["n_beads"] == 7 and Project.open(root).config.kinds["species"] == {}
    main(["projects", root, "add", "a", "s1", "r2=[x.fq]", "species=mouse"])
    main(["projects", root, "add", "a", "s2", "r2=[y.fq]", "species=mouse"])
    main(["projects", root, "merge", "a", "m", "a/s1", "a/s2"])
    main(["projects", root, "update", "a", "s1", "run_modes=[default, fast]"])
    main(["projects", root, "delete", "a", "s2"])
    own = Project.open(root).catalog
    assert list(own.samples) == [("a", "s1"), ("a", "m")] and own.samples["a", "m"]["merged_from"] == [("a", "s1"), ("a", "s2")]
    capsys.readouterr()
    main(["projects", root, "list"])
    assert capsys.readouterr().out.splitlines()[0] == "a\ts1\tmouse\tdefault,fast"
    main(["config", root, "list", "run_modes"])
    assert "fast" in capsys.readouterr().out
    for bad in (["projects", root, "add", "a", "s1", "r2=[z]"], ["projects", root, "delete", "a", "nope"], ["config", root, "add", "nope", "x"], ["config", root, "add", "pucks", "x", "noequals"], ["projects", str(tmp_path), "list"]):
        with pytest.raises(catalog.CatalogError):
            main(bad)


SIGNATURES = """
default: d
blocks: {P5: AATGATACGGCGACCACCGAGATCTACAC, TSO: AAGCAGTGGTATCAACGCAGAGTGAATGGG}
signatures:
  d: {intact_bead: "P5,TSO", prio: 1, read1_primer: P5}
  e: {prio: 2}
"""


def test_signature_catalog_and_long_reads(spark, tmp_path):
    blocks, sig = catalog.signature_catalog(SIGNATURES)
    assert blocks["P5_RC"] == "GTGTAGATCTCGGTGGTCGCCGTATCATT" and sig["e"] == {"intact_bead": "P5,TSO", "prio": 2, "read1_primer": "P5"}
    rng = random.Random(0)
    body = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    whole = blocks["P5"] + blocks["TSO"] + body(200)
    back = whole[::-1].translate(str.maketrans("ACGT", "TGCA"))
    (tmp_path / "s.yaml").write_text(SIGNATURES)
    with gzip.open(tmp_path / "r.fq.gz", "wt") as f:
        f.writelines(f"@q{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate([whole, back, blocks["P5"] + body(100)]))
    main(["longread", "align", str(tmp_path / "r.fq.gz"), str(tmp_path / "s.yaml"), str(tmp_path / "m")])
    main(["longread", "report", str(tmp_path / "m"), str(tmp_path / "s.yaml"), "d", str(tmp_path / "out")])
    got = {r["prefix"]: r["n"] for r in spark.read.parquet(str(tmp_path / "out/completeness")).collect()}
    assert got == {"P5,TSO": 2, "P5": 1}
    main(["longread", "report", str(tmp_path / "m"), str(tmp_path / "s.yaml"), "d", str(tmp_path / "out"), "--exclude", "TSO"])
    assert [(r["signature"], r["n"]) for r in spark.read.parquet(str(tmp_path / "out/signatures")).collect()] == [("P5", 1)]
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y"])], "qname string, signature array<string>")
    assert [r[0] for r in longread.with_signatures(df, "y", "x").collect()] == ["b"]


def test_headers():
    original = headers.parsed("@HD\tVN:1.6\tSO:unsorted\n@RG\tID:A\tSM:x\n@PG\tID:pre\tPN:pre\tCL:a b\n@PG\tID:star\tPN:star\tPP:pre\n@CO\tfree text\there\n")
    aligned = headers.parsed("@HD\tVN:1.4\tSO:coordinate\n@SQ\tSN:chr1\tLN:10\n@PG\tID:star\tPN:star\tCL:--x\n@PG\tID:tag\tPP:star\n")
    text = headers.rendered(headers.spliced(original, aligned))
    assert text == (
        "@HD\tVN:1.6\tSO:coordinate\n@SQ\tSN:chr1\tLN:10\n@RG\tID:A\tSM:x\n@PG\tID:pre\tPN:pre\tCL:a b\n@PG\tID:star\tPN:star\tPP:pre\n"
        "@PG\tID:star.1\tPN:star\tPP:star\tCL:--x\n@PG\tID:tag\tPP:star.1\n@CO\tfree text\there\n"
    )
    assert headers.parsed(text) == headers.spliced(original, aligned)
    assert ("RG", {"ID": "A", "SM": "NA"}) in headers.spliced([x for x in original if x[0] != "RG"], aligned)
    issues, chain = headers.repaired([{"ID": "a"}, {"ID": "b", "PP": "a"}, {"ID": "b", "PP": "b"}, {"ID": "c"}, {"ID": "d", "PP": "zz"}])
    assert [(p["ID"], p.get("PP")) for p in chain] == [("a", None), ("b", "a"), ("b.1", "b"), ("c", "b.1"), ("d", "c")] and len(issues) == 4
    assert headers.repaired(chain) == ([], chain)
    assert headers.free_id({"x", "x.1"}, "x") == "x.2" and headers.free_id({"x.3"}, "x.3") == "x.4"
    with pytest.raises(headers.BrokenChain):
        headers.in_order([{"ID": "a"}, {"ID": "b"}])


def test_any_reads_and_skimming(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"x{n}.fastq").write_text("".join(f"@r{n}.{i}\nACGT\n+\nIIII\n" for i in range(10)))
    df = spark.createDataFrame([(f"b{i}", 4, "*", 0, 0, "*", "ACGTN"[: i % 5 + 1], "*", {"XA": "5", "XB": "text"}) for i in range(2000)], "qname string, flag int, rname string, pos int, mapq int, cigar string, seq string, qual string, tags map<string,string>")
    bam.write_bam(df.repartition(3), str(tmp_path / "y.bam"))
    got = sequences.read_any(spark, [str(tmp_path / "x*.fastq"), str(tmp_path / "y.bam")])
    assert got.count() == 2020 and got.filter("name LIKE 'b%'").agg(F.countDistinct("name")).first()[0] == 2000
    assert sequences.read_any(spark, str(tmp_path / "x*.fastq"), skim=5).count() == 4
    r = bam.read_bam(spark, str(tmp_path / "y.bam")).filter("qname = 'b7'").first()
    assert (r["seq"], r["qual"], r["tags"]) == ("ACG", "*", {"XA": "5", "XB": "text"})


def test_inflating_many_small_members():
    import time

    data = b"".join(bam.member(bytes([i % 256]) * 50) for i in range(60_000)) + bam.END_OF_FILE
    t = time.time()
    assert sum(map(len, bam.inflated(data))) == 3_000_000 and time.time() - t < 10
    plain = gzip.compress(b"a" * 100_000) + gzip.compress(b"") + gzip.compress(bytes(range(256)) * 1000)
    assert b"".join(bam.inflated(plain)) == b"a" * 100_000 + bytes(range(256)) * 1000


def test_mismatch_bound_by_pieces(spark):
    rng = random.Random(1)
    for length, n in ((8, 30), (12, 40), (6, 5)):
        codes = ["".join(rng.choice("ACGT") for _ in range(length)) for _ in range(n)]
        least = min(sum(a != b for a, b in zip(x, y)) for i, x in enumerate(codes) for y in codes[i + 1 :])
        got = qc.mismatch_bound(spark.createDataFrame([(c,) for c in codes], "barcode string"))
        assert got == min(3, -(-least // 2) - 1)


def test_principal_components(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 6)) @ np.diag([9, 5, 3, 1, 0.5, 0.1])
    rows = [(i, f"g{j}", float(x[i, j])) for i in range(80) for j in range(6)]
    got = matrix.principal_components(spark.createDataFrame(rows, "cell int, gene string, x double"), [f"g{j}" for j in range(6)], 3)
    p = np.array([r["pca"].toArray() for r in got.orderBy("cell").collect()])
    _, _, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = x @ v[:3].T
    assert np.allclose(np.abs(p), np.abs(want), atol=1e-6)
