"""Operators without a table of their own: reads, annotation, long reads, catalogs, strategies, sources, streams."""

import gzip
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.engine import Engine
from tesserae.operators import alignments as al
from tesserae.operators import catalog as cat
from tesserae.operators import counts, intervals, longread, matrix, mesh, qc, reads, strategy, tiles, tissue
from tesserae.sources import bam, lines, sequences, tables
from tesserae.streaming import ingest


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=repr)


# ---- reads ----

READ = "pair int, record_no long, qname string, r1 string, q1 string, r2 string, q2 string"


def test_preprocess(spark):
    r2 = "ACGTTGCAACGGTTAACCGG" + "A" * 20 + "CC"
    df = spark.createDataFrame([(0, 0, "n", "ACGTACGTACGTTTTTTTTTGG", "I" * 22, r2, "I" * 40 + "##"), (0, 1, "m", "A" * 22, "I" * 22, "ACGT", "IIII")], READ)
    out = reads.preprocessed(df, "quality:right=25;polyA;barcode:cell=r1[0:12],UMI=r1[12:20]")
    a, b = (r.asDict() for r in out.orderBy("record_no").collect())
    assert (a["CB"], a["MI"], a["a3"], a["t3"], a["a5"]) == ("ACGTACGTACGT", "TTTTTTTT", ["Q", "polyA"], [2, 20], [])
    assert a["r2"] == "ACGTTGCAACGGTTAACCGG" and len(a["q2"]) == 20 and b["r2"] == "ACGT"
    assert reads.long_enough(out).count() == 1
    stats = {(r["measure"], r["name"], r["value"]): r["count"] for r in rows(reads.preprocessing_stats(df, out, "s"))}
    assert stats["reads", "N", "input"] == 2 and stats["bases", "L_in", "42"] == 1 and stats["bases", "L_out", "20"] == 1 and stats["reads", "A3", "polyA"] == 1 and stats["bases", "polyA", "20"] == 1 and stats["bases", "Q", "A3_total"] == 2
    flavor = reads.preprocessed(df, [("clip", {"left": 2})])
    assert flavor.first()["CB"] == "ACGTACGTACGT" and flavor.orderBy("record_no").first()["r2"].startswith("GTTG")
    with pytest.raises(ValueError):
        reads.parse_steps("nonsense:x=1")


def test_adapter_steps(spark):
    df = spark.createDataFrame([(0, 0, "n", "NA", "##", "TTTTACGTACGTAC", "I" * 14)], READ)
    assert reads.preprocessed(df, "adapter:name=X,seq=ACGTACGTAC").first()["r2"] == "TTTT"
    assert reads.preprocessed(df, "qquant;simple_name:prefix=r;clip:right=2").select("qname", "q2").first() == ("r0", "I" * 12)
    t = spark.createDataFrame([(0, 0, "n", "NA", "##", "TTTTTTACGG", "I" * 10)], READ)
    got = reads.preprocessed(t, "polyA:rev_comp=true").first()
    assert (got["r2"], got["a5"], got["t5"]) == ("ACGG", ["polyA"], [6])
    dark = spark.createDataFrame([(0, 0, "n", "NA", "##", "ACGGG", "IIIII")], READ)
    assert reads.preprocessed(dark, "nextseq_quality:cutoff=30").first()["r2"] == "AC"


def test_samples_nest(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("qname"))
    small, large = ({r[0] for r in reads.subsampled(df, p).collect()} for p in (10, 30))
    assert small < large and 400 < len(large) < 800
    assert reads.random_rows(df, 7, "qname").count() == 7


# ---- alignments ----


def test_alignment_rules(spark):
    df = spark.createDataFrame(
        [(0, "20M", ["g1"], ["CODING"], ["+"], [], ["polyA"]), (16, "2S15M", ["g1", "g2"], ["UTR", "INTRONIC"], ["+", "-"], ["TSO"], ["polyA"]), (0, "10M", None, None, None, [], [])],
        "flag int, cigar string, gn array<string>, gf array<string>, gs array<string>, a5 array<string>, a3 array<string>",
    )
    p = al.count_predicates(F.col("cigar"), F.col("a5"), F.col("a3"), F.lit("g"))
    s = al.strand_and_type(F.col("gs"), F.col("gf"), F.col("flag"))
    got = df.select(al.gene_of(F.col("gn"), F.col("gf")).alias("g"), *[v.alias(k) for k, v in (p | s).items()], al.top_function(F.col("gf")).alias("top")).collect()
    assert [r["g"] for r in got] == ["g1", "g1", "NA"]
    assert [(r["short"], r["primer"], r["ligation_product"]) for r in got] == [(False, False, True), (True, True, False), (True, True, False)]
    assert [(r["strand_type"], r["read_type"]) for r in got] == [("plus_plus", "CODING"), ("minus_AMB", "INTERGENIC"), ("plus_AMB", "INTERGENIC")]
    assert [r["top"] for r in got[:2]] == ["CODING", "UTR"]


def test_small_rna(spark):
    df = spark.createDataFrame([("2S20M", [], ["polyA"], "x", False, False), ("3S10M12S", ["SMART_TSO"], [], "junk", False, True), ("20M", [], ["polyA"], "x", True, True)], "cigar string, a5 array<string>, a3 array<string>, af string, pool boolean, gene boolean")
    v = al.small_rna_verdict(*map(F.col, ("cigar", "a5", "a3", "af", "pool", "gene")))
    assert [r[0] for r in df.select(v).collect()] == ["pass", "TSO,pool,junk,no_polyA,no_lig_NN,short_match,too_much_clipped", "no_lig_NN"]


def test_statistics(spark):
    df = spark.createDataFrame([("a__sig:x,y__", 4, 0, "*", "ACGT", None), ("b__sig:x__", 16, 255, "2S10M5N10M3S", "AC" + "G" * 20 + "TTT", ["UTR", "CODING"]), ("c", 0, 3, "25M", "A" * 25, None)], "qname string, flag int, mapq int, cigar string, seq string, gf array<string>")
    got = {(r["measure"], r["kind"], r["key"]): r["n"] for r in rows(al.alignment_statistics(df, oligos=True))}
    want = {
        ("aln_types", "", "N_reads"): 3, ("aln_types", "", "unmapped"): 1, ("aln_types", "", "unique"): 1, ("aln_types", "", "mapped"): 2, ("read_lengths", "all", "25"): 2, ("read_lengths", "mapped", "25"): 2,
        ("tag_types", "", "CODING"): 1, ("uniq_tag_types", "", "CODING"): 1, ("cigar_types", "", "SMS"): 1, ("match_len_by_cigar", "all", "20"): 1, ("match_len_by_utag", "CODING", "20"): 1, ("sc_lengths", "5'", "3"): 1,
        ("sc_seq", "3'", "AC"): 1, ("oligo_count", "", "x"): 2, ("oligo_by_tag", "NA", "y"): 1, ("oligo_by_mapstat", "unique", "x"): 1, ("tag_types", "", "INTERGENIC"): 1,
    }
    assert {k: got.get(k) for k in want} == want and ("match_len_by_tag", "all", "0") not in got
    assert al.alignment_statistics(df, only="sig").filter("key = 'N_reads'").first()["n"] == 2


def test_fisher(spark):
    df = spark.createDataFrame([("x", 2, 7, 8, 1), ("y", 5, 5, 5, 5)], "o string, a long, b long, c long, d long")
    got = rows(al.fisher_exact(df, "a", "b", "c", "d", pseudo=1))
    n = lambda k: math.comb(11, k) * math.comb(11, 12 - k) / math.comb(22, 12)
    assert [r["o"] for r in got] == ["x"]
    assert got[0]["p_value"] == pytest.approx(sum(n(k) for k in range(1, 12) if n(k) <= n(3) * (1 + 1e-7)))


def test_best_genes(spark):
    kind = "array<struct<name:string,function:string,sense:boolean,exonic:boolean>>"
    df = spark.createDataFrame([([("b", "f1", True, True), ("a", "f2", True, True), ("c", "f3", True, False)],), ([("c", "f3", False, True), ("d", "f4", False, False)],)], f"g {kind}")
    assert [tuple(r[0]) for r in df.select(al.best_genes(F.col("g"))).collect()] == [("a,b", "f2"), ("c", "f3")]


def test_lookups(spark):
    df = spark.createDataFrame([("chr1", 1), ("chrX", 2)], "rname string, i int")
    names = spark.createDataFrame([("chr1", "one")], "original string, target string")
    assert [r["gene"] for r in al.gene_by_reference(df, names).orderBy("i").collect()] == ["one", "chrX"]
    lookup = spark.createDataFrame([("chr1", "rRNA", "n1")], "ref string, af string, an string")
    assert [(r["af"], r["an"]) for r in al.abundant_rna(df, lookup).orderBy("i").collect()] == [("rRNA", "n1"), ("NA", "NA")]


# ---- counts ----


def test_margins_agree(spark):
    df = spark.createDataFrame([(c, g, u) for c in range(5) for g in range(4) for u in range((c * g) % 3 + 1) for _ in range(2)], "c int, g int, u int")
    sums = {(r["umis"], r["reads"]) for r in rows(counts.check_margins(counts.margins(df, "c", "g", "u")))}
    assert len(sums) == 1
    c = counts.molecule_counts(df, "c", "g", "u")
    assert counts.large_enough(c, 5, 4) and not counts.large_enough(c, 6, 4)
    with_reads = counts.cell_metrics(c.withColumn("gene", F.col("gene").cast("string")), reads=spark.createDataFrame([(0, 100)], "cell int, n_reads long"))
    assert [r["n_reads"] for r in rows(with_reads)] == [100]
    for f in ("exon", "intron", "all"):
        for n in (False, True):
            own = df.select(F.col("c").alias("CB"), F.col("g").alias("gn"), F.col("u").alias("MI"), F.lit("CODING" if f != "intron" else "INTRONIC").alias("gf"), F.lit(255).alias("mapq"))
            assert counts.dge(own, f, n).agg(F.sum("n")).first()[0] == df.count() // (1 if n else 2)


# ---- annotation ----


def test_annotation(spark):
    feats = spark.createDataFrame(
        [("1", "exon", 100, 200, "+", "g1", "t", "G1"), ("1", "CDS", 120, 180, "+", "g1", "t", "G1"), ("1", "exon", 150, 300, "+", "g2", "t", "G2"), ("1", "exon", 100, 200, "-", "g3", "t", "G3")],
        "chrom string, feature string, start int, end int, strand string, gene_id string, gene_type string, gene_name string",
    )
    own = spark.createDataFrame([("a", "1", "+", 125, 130), ("b", "1", "+", 250, 260), ("c", "1", "+", 500, 510), ("d", "1", "+", 160, 170), ("e", "1", "+", 101, 103), ("e", "1", "+", 250, 252)], "read string, chrom string, strand string, start int, end int")
    got = {r["read"]: (r["gf"], r["gn"]) for r in rows(intervals.annotated(own, feats))}
    assert got == {"a": (["CDS"], ["G1"]), "b": (["non-coding"], ["G2"]), "c": (["INTERGENIC"], ["NA"]), "d": (["CDS"], ["G1"]), "e": (["non-coding", "non-coding"], ["G1", "G2"])}
    both = {r["read"]: (r["gn"], r["gs"]) for r in rows(intervals.annotated(own, feats, antisense=True))}
    assert both["a"] == (["G1", "G3"], ["+", "-"]) and both["c"] == (["NA"], ["NA"])


def test_segments_merge(spark):
    parts = spark.createDataFrame([("1", 0, 5, [1]), ("1", 5, 9, [1]), ("1", 9, 12, [1, 2]), ("1", 20, 22, [1, 2])], "chrom string, start int, end int, ids array<int>")
    assert [(r["start"], r["end"]) for r in rows(intervals.merged_segments(parts, ["chrom"]))] == [(0, 9), (20, 22), (9, 12)]


# ---- space ----


def test_mesh(spark):
    spots = spark.createDataFrame([(i, float(i % 20) * 10, float(i // 20) * 10) for i in range(400)], "cell_bc int, x_pos double, y_pos double")
    for kind in ("hexagon", "circle"):
        got = mesh.meshed(spots, 1.0, 40, 60, 10, kind)
        assert 0 < got.count() <= 400 and got.select("cell_bc").distinct().count() == got.count()
        if kind == "circle":
            assert all(math.hypot(r["x_pos"] - r["cx"], r["y_pos"] - r["cy"]) < 15 for r in got.collect())
    lattice = mesh.Lattice(6, 4, 0.0, 60.0, 0.0, 60.0, True)
    centres = [(r["unit"], r["cx"], r["cy"]) for r in mesh.lattice_points(spark, lattice).collect()]
    inside = spots.filter("x_pos <= 55 AND y_pos <= 55").select("x_pos", "y_pos", mesh.hexagon_of(F.col("x_pos") + 1, F.col("y_pos") + 2, lattice).alias("h")).collect()
    sx, sy = lattice.step
    for r in inside:  # nearest in the lattice's own metric
        d = lambda c, r=r: ((r["x_pos"] + 1 - c[1]) / sx) ** 2 + 3 * ((r["y_pos"] + 2 - c[2]) / sy) ** 2
        assert r["h"] is None or d((0, r["h"]["cx"], r["h"]["cy"])) <= min(map(d, centres)) + 1e-9
    assert mesh.divisible(1.0, 1.0) == (0.999, 1.001) and mesh.divisible(0.0, 0.0) == (-0.001, 0.001) and mesh.divisible(3, 1) == (1, 3)
    nan, inf = float("nan"), float("inf")
    assert {mesh.divisible(*e) for e in ((nan, 1.0), (1.0, nan), (inf, 2.0), (-inf, inf), (nan, nan))} == {(-0.001, 0.001)}
    for e in ((5.0, 5.0), (-5.0, -5.0), (1e15, 1e15 + 0.125), (5e-324, 5e-324), (-1e300, -1e300), (7.0, 7.0 + 1e-15), (-2.0, 3.0), (0.0, 1e-300)):
        low, high = mesh.divisible(*e)
        assert low < high and low <= min(e) and high >= max(e), e
    assert mesh.divisible(-2.0, 3.0) == (-2.0, 3.0) and mesh.divisible(0.0, 1e-300) == (0.0, 1e-300)
    with pytest.raises(ValueError):
        mesh.meshed(spots, mesh_type="square")


def test_raster(spark):
    df = spark.createDataFrame([(i, float(i % 3), float(i // 3), 200) for i in range(9)], "i int, x_pos double, y_pos double, v long")
    image = mesh.raster(df, 1.0, "v").withColumn("on", ~((F.col("px") == 1) & (F.col("py") == 1)))
    assert all(r["on"] for r in mesh.filled(image).collect())
    assert mesh.raster(df, 3.0, "v").first()["value"] == 1800
    assert mesh.thresholded(mesh.raster(df, 1.0, "v"), 30).filter("on").count() == 9


def test_components(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "cell_bc int")
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(8, 9)], "a int, b int")
    assert [r["island"] for r in tissue.connected(nodes, edges).orderBy("cell_bc").collect()] == [0] * 7 + [7, 8, 8, 10, 11]


def test_barcode_cleaning(spark):
    df = spark.createDataFrame([(x,) for x in ("ACGTACGTACGT", "TAG=XC", "AATTTTTTAA", "CCTTGGAACC", "GATTGCACGGAT")], "cell_bc string")
    primer = "TTCCAAGGAA"[::-1]
    kept = [r[0] for r in tiles.clean_barcodes(df, primer).collect()]
    assert "TAG=XC" not in kept and "AATTTTTTAA" not in kept and "ACGTACGTACGT" in kept


def test_stitch(spark):
    t = spark.createDataFrame([("A", 0.0, 0.0, "1")], "cell_bc string, x_pos double, y_pos double, puck_id string")
    c = spark.createDataFrame([("1", 0, 100, 0)], "puck_id string, x_offset long, y_offset long, z_offset long")
    assert rows(tiles.stitched(t, c)) == [{"cell_bc": "A:1", "x_pos": 0.0, "y_pos": 100.0, "puck_id": "1"}]
    assert tiles.one_value(t, "puck_id")


# ---- tables ----


def test_collapse_and_zero_fill(spark):
    c = spark.createDataFrame([("s", "a", 90, 120), ("s", "b", 1, 120), ("s", "c", 9, 120)], "s string, name string, n long, total long")
    got = {r["name"]: r["n"] for r in rows(qc.collapsed_counts(c, ["s"], threshold=0.1, total="total"))}
    assert got == {"a": 90, "misc": 10, "NA": 20}
    k = qc.kmer_positions(spark.createDataFrame([("AC",), ("AA",)], "s string"), "s", 1)
    assert qc.zero_filled(k, "position", "kmer", list("ACGTN")).count() == 10


def test_attributes(spark, tmp_path):
    stats = spark.createDataFrame([("s1", "bead", "complete", 0.5)], "sample string, kind string, name string, value double")
    samples = spark.createDataFrame([("s1",), ("s2",)], "sample string")
    assert [r["value"] for r in qc.attribute_by_sample(stats, samples, "sample", "bead", "complete").orderBy("sample").collect()] == [0.5, None]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/L1a.txt.gz").write_text("")
    assert cat.find_file(str(tmp_path), "L1a").endswith("L1a.txt.gz") and cat.find_file(str(tmp_path), "L1") is None


def test_mismatches(spark):
    of = lambda *b: qc.mismatch_bound(spark.createDataFrame([(x,) for x in b], "barcode string"))
    assert of("AAAA", "TTTT") == 1 and of("AAAAAAAA", "TTTTTTTT", "CCCCCCCC") == 3 and of("ACGT") == 4


def test_matrix(spark):
    data = [(c, f"g{g}", (c * 7 + g * 3) % 5 + (10 if g == c % 3 else 1), 1) for c in range(12) for g in range(6)]
    counts_ = spark.createDataFrame(data, "cell int, gene string, umis long, reads long")
    x = matrix.normalised(counts_)
    assert matrix.variable_genes(x, 12, 3, bins=2).count() == 3
    assert matrix.principal_components(x, [f"g{i}" for i in range(6)], 2).count() == 12
    clusters = spark.createDataFrame([(c, c % 3) for c in range(12)], "cell int, cluster int")
    m = matrix.markers(x, clusters)
    best = m.orderBy("cluster", F.desc("score")).collect()
    assert {(r["cluster"], r["gene"]) for r in best if r["score"] == max(q["score"] for q in best if q["cluster"] == r["cluster"])} == {(0, "g0"), (1, "g1"), (2, "g2")}
    assert all(0 <= r["pval"] <= r["pval_adj"] <= 1 for r in best)
    t = spark.createDataFrame([("l1", "a", 0.2), ("l1", "b", 0.9), ("l1", "b", 0.1), ("l1", "b", 0.8)], "location string, cluster string, weight double")
    assert rows(matrix.cluster_of_location(t)) == [{"location": "l1", "cluster": "b"}]


# ---- long reads ----


def test_longread(spark):
    oligos = {"start": "ACGTTGCAAGCTAC", "poly": "TTGGCCAATTGGAC"}
    seq = "TTTTT" + oligos["start"] + "ACGTACGT" + oligos["poly"] + "GGGGG"
    r = spark.createDataFrame([("q1", seq), ("q2", "ACACACAC")], "qname string, seq string")
    matches = longread.oligo_matches(r, oligos)
    got = rows(matches)
    assert [(m["oligo"], m["start"], m["end"]) for m in got] == [("poly", 27, 41), ("start", 5, 19)]
    per = longread.oriented(longread.per_read(longread.relevant_matches(matches, oligos, relevant=["start", "poly"])), "start")
    one = per.first()
    assert one["signature"] == ["start", "poly"] and not one["turned"]
    gap = longread.between(per, "start", "poly", least=8, most=8).first()
    assert seq[gap["gap_start"] : gap["gap_end"]] == "ACGTACGT"
    assert rows(longread.not_yet_aligned(r, matches).select("qname")) == [{"qname": "q2"}]
    cdna = longread.insert_bounds(per, "start", distal=10).first()
    assert (cdna["cdna_start"], cdna["cdna_end"]) == (19, 27)
    assert longread.first_occurrence(per, "poly").first()["start"] == 27


def test_orientation(spark):
    part = "array<struct<start:int,end:int,oligo:string,score:double>>"
    df = spark.createDataFrame([("q", 50, [(0, 10, "poly_RC", 1.0), (20, 30, "start_RC", 2.0)], "ACGTT")], f"qname string, L int, parts {part}, seq string")
    got = longread.oriented(df, "start", "seq").first()
    assert got["signature"] == ["start", "poly"] and [(p["start"], p["end"]) for p in got["parts"]] == [(20, 30), (40, 50)] and got["seq"] == "AACGT"


@pytest.mark.parametrize(("sig", "want", "full"), [(["a", "b"], "a,b", "a,b"), (["a", "b", "b", "b_RC", "c"], "?b+", "a,b+,b_RC,c"), ([], "", ""), (["a_RC", "a_RC"], "?a+", "a_RC+"), (["a", "a", "b", "b"], "?a+", "a+,b+")])
def test_contraction(spark, sig, want, full):
    df = spark.createDataFrame([(sig,)], "s array<string>")
    assert df.select(longread.contracted(F.col("s")), longread.contracted(F.col("s"), False)).first() == (want, full)


def test_digest(spark):
    c = spark.createDataFrame([("P5,bead_start,OP1,polyT,N70X", 5), ("bead_start,polyT", 2), ("bead_start", 1), ("x,y", 3)], "signature string, n long")
    got = {(r["kind"], r["name"]): r["n"] for r in rows(longread.digest(c, "P5,bead_start,OP1,polyT,N70X"))}
    assert got == {("bead", "complete"): 5, ("bead", "missing_OP1"): 2, ("bead", "only_bead_start"): 1, ("other", "bead-related"): 8, ("other", "x,y"): 3, ("found", "bead_start"): 8, ("found", "bead_start,OP1"): 5, ("found", "bead_start,polyT"): 2, ("found", "bead_start,OP1,polyT"): 5}
    assert longread.core_signature("P5,a,b,N70X") == ["a", "b"]


def test_edits(spark):
    df = spark.createDataFrame([("ACGTT",), ("ACTT",), ("AAGTT",)], "match_seq string")
    got = {(r["position"], r["kind"], r["edit"]): r["n"] for r in rows(longread.edit_profile(df, "ACGTT"))}
    assert got[0, "match", "AA"] == 3 and got[1, "edit", "CA"] == 1 and got[2, "edit", "G-"] == 1


def test_examples_and_contexts(spark):
    part = "array<struct<start:int,end:int,oligo:string,score:double>>"
    df = spark.createDataFrame([(f"q{i}", [(0, 5, "a", 1.0), (5, 9, "b", 1.0), (9, 12, "c", 1.0)], "ACGT") for i in range(15)], f"qname string, parts {part}, seq string").withColumn("signature", F.transform("parts", lambda p: p["oligo"]))
    assert longread.examples(df).count() == 11
    assert rows(longread.completeness_contexts(df, ["a", "b"])) == [{"kind": "prefix", "context": "", "n": 15}, {"kind": "suffix", "context": "c", "n": 15}]
    m = longread.matching_signature(df, ["b"], substring=True)
    assert m.count() == 15 and rows(longread.part_dimensions(m))[0]["starts"] == [5]


# ---- strategies and catalogs ----


@pytest.mark.parametrize(("text", "want"), [("rRNA:bowtie2->genome:STAR", "bowtie2:rRNA->STAR:genome"), ("bowtie2@x:rRNA,STAR:genome:final", "bowtie2@x:rRNA,STAR:genome:final"), ("STAR:genome", "STAR:genome")])
def test_strategy(text, want):
    assert strategy.normalised_strategy(text) == want


def test_strategy_chain():
    rules, links = strategy.parse_strategy("bowtie2@custom:rRNA->STAR@default:genome")
    assert [r.source for r in rules] == ["uBAM", "not_rRNA.bowtie2"] and links == {"final": "genome.STAR"} and [r.keep_unmapped for r in rules] == [False, True]
    for bad, error in (("STAR", strategy.StrategyError), ("STAR:a:b:c", strategy.StrategyError), ("STAR:nope", strategy.UnknownReference), ("STAR@zz:genome", strategy.UnknownFlavor)):
        with pytest.raises(error):
            strategy.parse_strategy(bad, {"genome"}, {"default"})


def test_catalog(spark):
    c = cat.Catalog()
    c.add("p", "s1", r1=["a"], r2=["b"], run_modes="['x', 'y']", puck_ids=["t1"], puck_files=["f1"])
    c.add("p", "s2", r2="[c]", run_modes=["y"], puck_ids=["t2"], puck_files=["f2"])
    for bad, error in ((("p", "s1"), cat.Duplicate), (("p", "s3"), cat.Missing)):
        with pytest.raises(error):
            c.add(*bad)
    with pytest.raises(cat.Inconsistent):
        c.add("p", "s4", r1=["a", "b"], r2=["c"])
    c.merge("p", "m", [("p", "s1"), ("p", "s2")])
    assert c.samples["p", "m"]["run_modes"] == ["y"] and c.leaves("p", "m") == [("p", "s1"), ("p", "s2")] and c.get("puck", sample_id="s2") == "default"
    c.update("p", "s2", map_strategy="STAR:other")
    with pytest.raises(cat.Inconsistent):
        c.merge("p", "m2", [("p", "s1"), ("p", "s2")])
    df = c.to_df(spark)
    assert cat.tiles_of(df.filter("sample_id = 'm'")).count() == 2 and df.filter(cat.has_dge()).count() == 3 and df.filter(cat.is_external()).count() == 0 and df.filter(cat.is_spatial(["visium"])).count() == 3
    matches = spark.createDataFrame([("t1", True), ("t2", False)], "tile string, pass_threshold boolean")
    assert sorted(r["puck_id"] for r in cat.passing_tiles(df.filter("sample_id = 'm'"), matches).collect()) == ["no_spatial_data", "t1"]
    assert cat.sample_info(df, "p", "m").first()["n_pucks"] == 2
    assert {r["variable"]: r["default"] for r in cat.run_mode_matrix(spark, cat.Config(), ["default"]).collect()}["n_beads"] == "100000"
    c.delete("p", "s2")
    with pytest.raises(cat.Missing):
        c.delete("p", "s2")
    assert cat.as_list("[nan]") == [] and cat.as_list('["a", "b"]') == ["a", "b"] and cat.as_bool("Yes") and not cat.as_bool("f")


def test_config():
    c = cat.Config()
    c.add("run_modes", "base", n_beads="5", mesh_data="true")
    c.add("run_modes", "child", parent_run_mode="base", n_beads=7)
    got = c.run_mode("child")
    assert got["n_beads"] == 7 and got["mesh_data"] is True and got["umi_cutoff"] == [100, 300, 500]
    c.add("adapters", "SMART", seq="ACGT")
    c.add("adapter_flavors", "f", cut_left={"SMART": {"min_overlap": 5}})
    assert c.adapters_of("f")[0]["min_overlap"] == 5
    with pytest.raises(cat.Duplicate):
        c.add("adapters", "SMART")
    with pytest.raises(cat.Missing):
        c.puck("nope")
    with pytest.raises(cat.Inconsistent):
        c.delete("pucks", "default")
    assert c.puck("nope", or_empty=True) == {} and cat.filled("{a}/{b}", {"a": 1}) == "1/NO_b" and cat.bam_tag_names()["cell"] == "CB"
    c.add("species", "m", path="{root}/x")
    assert c.expanded(root="/r").kinds["species"]["m"]["path"] == "/r/x"


# ---- sources ----


def test_fastq(spark, tmp_path):
    for n in (1, 2):
        with gzip.open(tmp_path / f"r{n}.fastq.gz", "wt") as f:
            f.writelines(f"@read{i} extra:{n}\n{'ACGT'[i % 4] * (n + 3)}\n+\n{'I' * (n + 3)}\n" for i in range(50))
    one, two = (str(tmp_path / f"r{n}.fastq.gz") for n in (1, 2))
    got = sequences.read_reads(spark, [two], [one]).orderBy("record_no").collect()
    assert len(got) == 50 and (got[7]["qname"], got[7]["r1"], got[7]["r2"]) == ("read7", "TTTT", "TTTTT")
    assert sequences.read_reads(spark, [two]).first()["r1"] == "NA"
    (tmp_path / "m.csv").write_text(f"R2,R1,cell\n{two},{one},c1\n{two},,\n")
    assert {r["cell"] for r in sequences.read_sample_matrix(spark, str(tmp_path / "m.csv")).select("cell").distinct().collect()} == {"c1", "1"}
    assert sequences.read_triples(spark, one).count() == 50


def test_lines_over_many_blocks(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text("".join(f"line {i}\n" for i in range(20_000)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert lines.numbered_lines(spark, str(p)).filter(F.col("value") != F.concat(F.lit("line "), F.col("line_no").cast("string"))).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_fasta_sam_gtf(spark, tmp_path):
    (tmp_path / "x.fa").write_text("#c\n>a one\nAC\nGT\n>b\nTT\n")
    assert [(r["name"], r["seq"]) for r in rows(sequences.read_fasta(spark, str(tmp_path / "x.fa")))] == [("a one", "ACGT"), ("b", "TT")]
    reads_ = spark.createDataFrame([("q", "ACGT", "IIII", "CELL", "UMI", ["Q"], [2])], "qname string, r2 string, q2 string, CB string, MI string, a3 array<string>, t3 array<int>")
    sam = sequences.render_sam(reads_)
    assert sam.first()[0] == "q\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII\tCB:Z:CELL\tMI:Z:UMI\tA3:Z:Q\tT3:Z:2\tRG:Z:A"
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\n@CO\tfree text\n" + sam.first()[0] + "\n")
    r = sequences.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (r["flag"], r["CB"], r["tags"]["A3"], r["gn"]) == (4, "CELL", "Q", None)
    assert sequences.read_sam_header(spark, str(tmp_path / "x.sam")).filter("kind = 'HD'").first()["fields"] == {"VN": "1.6"}
    assert sequences.read_triples(spark, str(tmp_path / "x.sam"), tag="CB").first()["seq"] == "CELL"
    (tmp_path / "x.gtf").write_text('#h\n1\ts\texon\t11\t20\t.\t+\t.\tgene_id "g"; gene_type "t"; gene_name "n";\n1\ts\texon\t11\t20\t.\t+\t.\tgene_id "g"; gene_type "t"; gene_name "n";\n1\ts\ttranscript\t1\t2\t.\t+\t.\tx "y";\nshort\tline\n')
    assert rows(tables.read_gtf(spark, str(tmp_path / "x.gtf"))) == [{"chrom": "1", "feature": "exon", "start": 10, "end": 20, "strand": "+", "gene_id": "g", "gene_type": "t", "gene_name": "n"}]
    (tmp_path / "y.gtf").write_text('1\ts\texon\t11\t20\t.\t+\t.\tgene_name "n";\n')
    assert tables.read_gtf(spark, str(tmp_path / "y.gtf"), strict=False).first()["gene_id"] is None
    with pytest.raises(Exception, match="no gene_id"):
        tables.read_gtf(spark, str(tmp_path / "y.gtf")).collect()


def test_bam(spark, tmp_path):
    import struct

    def record(name, flag, ref, pos, cigar, seq, tags):
        ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
        codes = ["=ACMGRSVTWYHKDBN".index(b) for b in seq] + [0]
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 255, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + bytes([40] * len(seq)) + tags
        return struct.pack("<i", len(body)) + body

    head = b"@HD\tVN:1\n"
    data = b"BAM\1" + struct.pack("<i", len(head)) + head + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    data += record("r1", 0, 0, 9, [(3, "M"), (2, "S")], "ACGTN", b"CBZCELL\0NHC\x01XBBs" + struct.pack("<Ihh", 2, 5, -6)) + record("r2", 4, -1, -1, [], "AC", b"")
    (tmp_path / "x.bam").write_bytes(gzip.compress(data[:60]) + gzip.compress(data[60:]) + gzip.compress(b""))
    a, b = bam.read_bam(spark, str(tmp_path / "x.bam")).orderBy("record_no").collect()
    assert (a["qname"], a["rname"], a["pos"], a["cigar"], a["seq"], a["qual"], a["tags"]) == ("r1", "chr1", 10, "3M2S", "ACGTN", "IIIII", {"CB": "CELL", "NH": "1", "XB": "5,-6"})
    assert (b["qname"], b["flag"], b["rname"], b["cigar"], b["seq"]) == ("r2", 4, "*", "*", "AC")


def test_engine(spark, tmp_path):
    e = Engine(spark, str(tmp_path))
    e.process(spark.createDataFrame([("a", "g1", "u1"), ("a", "g1", "u1"), ("a", "g2", "u2"), ("b", "g1", "u3")], "CB string, gene string, MI string"), "p", "s")
    assert [(r["cell"], r["total_counts"], r["n_reads"]) for r in rows(e.load("p", "s", part="obs"))] == [("a", 2, 3), ("b", 1, 1)]
    spark.createDataFrame([("a", 1.0, 1.0), ("b", 90.0, 90.0)], "cell_bc string, x_pos double, y_pos double").write.parquet(e.path("p", "s", "puck"))
    assert e.load_spatial("p", "s").count() == 2
    assert e.load_mesh("p", "s", spot_diameter_um=20, mesh_type="hexagon").agg(F.sum("umis")).first()[0] <= 3
    t = spark.createDataFrame([("AC",), ("GT",)], "cell_bc string")
    assert tiles.known_barcodes(t, spark.createDataFrame([("AC",), ("TG",)], "cell_bc string")).first() == (2, 1, 1)
    assert tiles.image_coordinates(spark.createDataFrame([(3.0, 5.0)], "x_pos double, y_pos double"), 2.0, 1.0, 1.0).first() == (4.0, 8.0)


def test_tables(spark, tmp_path):
    (tmp_path / "L1a_tile_2104.txt").write_text("barcodes\txcoord\tycoord\nAA\t1\t2\nAA\t9\t9\nCC\t3\t4\n")
    got = rows(tables.read_barcodes(spark, str(tmp_path / "L1a_tile_2104.txt")))
    assert [(r["cell_bc"], r["x_pos"], r["puck_id"]) for r in got] == [("AA", 1.0, "L1a_tile_2104"), ("CC", 3.0, "L1a_tile_2104")]
    (tmp_path / "cs.csv").write_text("puck_id,x_offset,y_offset,z_offset\nt1,0,100,0\nt1,5,5,5\n")
    assert rows(tables.read_coordinate_system(spark, str(tmp_path / "cs.csv"))) == [{"puck_id": "t1", "x_offset": 0, "y_offset": 100, "z_offset": 0}]
    (tmp_path / "d.txt").write_text("GENE\tAA\tCC\ng1\t0\t3\ng2\t1\t0\n")
    assert [(r["cell"], r["gene"], r["umis"]) for r in rows(tables.read_dge_text(spark, str(tmp_path / "d.txt")))] == [("AA", "g2", 1), ("CC", "g1", 3), (None, "mt-missing", 0)]
    (tmp_path / "s.txt").write_text("\n".join(["x"] * 7) + "\nAA\t10\t5\t3\n")
    assert rows(tables.read_dge_summary(spark, str(tmp_path / "s.txt"))) == [{"cell_bc": "AA", "n_reads": 10, "n_umi": 5, "n_genes": 3}]
    (tmp_path / "star.log").write_text("     Number of input reads |\t2505000\n  Uniquely mapped reads % |\t81.25%\n  Average mapped length |\t60.5\n  Number of chimeric reads |\tNA\n")
    assert {r["metric"]: r["value"] for r in rows(tables.read_star_log(spark, str(tmp_path / "star.log")))} == {"input_reads": 2.5, "avg_mapped_length": 60.5, "chimeric": None}
    (tmp_path / "b.log").write_text("100 reads; of these:\n  100 (100.00%) were unpaired; of these:\n    60 (60.00%) aligned 0 times\n    30 (30.00%) aligned exactly 1 time\n    10 (10.00%) aligned >1 times\n40.00% overall alignment rate\n")
    assert rows(tables.read_bowtie_log(spark, str(tmp_path / "b.log"))) == [{"reads": 100, "unaligned": 60, "once": 30, "several": 10, "rate": 40.0}]
    (tmp_path / "sheet.csv").write_text("Investigator,me\nDate,2020\n[Data]\nSample_ID,index,Sample_Project,Description\ns1,ACGT,p1,x_mouse\n")
    assert rows(tables.read_sample_sheet(spark, str(tmp_path / "sheet.csv")))[0]["species"] == "mouse"
    m = spark.createDataFrame([("a", "g", 1.5)], "cell string, gene string, umis double")
    m.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="whole"):
        tables.read_matrix(spark, str(tmp_path / "bad")).collect()
    tables.write_matrix(str(tmp_path / "m"), m, m)
    assert spark.read.parquet(str(tmp_path / "m/counts")).count() == 1
    made = []
    for _ in range(2):
        tables.compiled_or_make(spark, str(tmp_path / "c"), lambda: made.append(1) or m)
    assert made == [1]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.sam").write_text("@HD\tVN:1\n" + "".join(f"q{i}\t0\t1\t5\t255\t4M\t*\t0\t0\tACGT\tIIII\tCB:Z:c{i % 2}\tMI:Z:u{i % 3}\tgn:Z:g\n" for i in range(12)))
    df = ingest.stream_sam(spark, str(tmp_path / "in")).select(F.col("tags")["CB"].alias("cell"), F.col("tags")["gn"].alias("gene"), F.col("tags")["MI"].alias("umi"), "arrived")
    for i, out in enumerate((ingest.running_molecules(ingest.first_seen_stream(df, ["cell", "gene", "umi"], within=None), "cell", "gene"), ingest.approximate_molecules(df, "cell", "gene", "umi"))):
        q = out.writeStream.outputMode("complete").format("memory").queryName(f"molecules{i}").option("checkpointLocation", str(tmp_path / f"cp{i}")).start()
        q.processAllAvailable()
        q.stop()
        assert [(r["cell"], r["umis"]) for r in rows(spark.table(f"molecules{i}"))] == [("c0", 3), ("c1", 3)]
    w = ingest.windowed_counts(ingest.stream_table(spark, str(tmp_path / "none"), "ts timestamp, k string"), "ts", "5 minutes", ["k"]) if (tmp_path / "none").mkdir() is None else None
    assert w.isStreaming


def test_neighbours_by_vector(spark):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(60, 5)) * 100, [[1e6] * 5], np.zeros((3, 5))])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    want = {(i, j) for i in range(len(x)) for j in [j for j in sorted(range(len(x)), key=lambda j: (d[i, j], j)) if j != i][:7]}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id long, v array<double>")
    for own in (df, df.filter("v IS NOT NULL").withColumn("v", array_to_vector("v"))):
        got = matrix.neighbours_by_vector(own, "id", "v", 7, block=20).collect()
        assert {(r["id"], r["neighbour"]) for r in got} == want and len(got) == len(want)
        assert all(abs(r["distance"] - d[r["id"], r["neighbour"]]) < 1e-9 for r in got)
    assert matrix.neighbours_by_vector(df.limit(0), "id", "v").count() == 0
    names = df.limit(3).select(F.concat(F.lit("c"), "id").alias("id"), "v")
    assert matrix.neighbours_by_vector(names, "id", "v", 7).count() == 6
