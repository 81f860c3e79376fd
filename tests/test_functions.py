"""Column functions and trimming rules on hand-made cases."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tesserae.functions import alignment, matching, slices, trimming
from tesserae.functions import sequence as sq


def values(spark, column, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("s"))).collect()]


def test_sequences(spark):
    assert values(spark, sq.reverse_complement, "ACGTN", "acgt-RY", "", None) == ["NACGT", "RY-acgt", "", None]
    assert values(spark, sq.is_nucleotides, "ACGTN-", "XYZ") == [True, False]
    words = ["AAAA", "ACGT", "AACCGGTT", "AAB", ""]
    entropy = [round(-sum(c / len(w) * math.log2(c / len(w)) for c in Counter(w).values()), 2) + 0.0 if w else 0.0 for w in words]
    assert values(spark, sq.shannon_entropy, *words) == entropy
    assert values(spark, sq.compressed_length, "AAAA", "ACGT", "A" * 12, "AAB", "") == [2, 8, 3, 4, 0]
    assert values(spark, sq.collapsed_runs, "AAABBA") == ["ABA"]
    assert values(spark, sq.phred, "!I") == [[0, 40]]
    quality = "".join(chr(33 + q) for q in range(42))
    assert values(spark, sq.quantize_quality, quality) == ["".join(chr(33 + (round(q / 10) * 10 if q <= 40 else q)) for q in range(42))]
    assert [(x.position, x.kmer) for x in values(spark, lambda c: sq.kmers(c, 3), "ACGTA")[0]] == [(0, "ACG"), (1, "CGT"), (2, "GTA")]
    assert values(spark, lambda c: sq.kmers(c, 3), "AC") == [[]]
    assert len(sq.all_kmers(2)) == 25
    assert values(spark, lambda c: sq.hamming(c, F.lit("ACGT")), "ACGA", "TT", "ACGTTT") == [1, 2, 0]
    assert values(spark, sq.short_number, "5")[0] == "5"
    assert values(spark, sq.oligo_partner, "X", "X_RC") == ["X_RC", "X"]
    assert values(spark, sq.coarse_cigar, "MIMDM", "MNM") == ["M", "M"]


def test_cigar(spark):
    got = values(spark, sq.cigar_summary, "2S20M1I5M3S", "20M", "5M10M4S2S", "")
    assert [(r.clip5, r.clip3, r.n_match, r.total_match) for r in got] == [(2, 3, 20, 25), (0, 0, 20, 20), (0, 2, 10, 15), (0, 0, 0, 0)]


@pytest.mark.parametrize("expression", ["r1[0:12]", "r1[12:20]", "r1[8:20][::-1]", "r1[0:8]+r1[31:39]", "r1[-5:]", "r1[:-3]", "r1[::-1]", "r1[3]", "r1[-2]", "r1[2:27]", "r1[5:2]", "r1[-4:-1]", "'AC' + r1[0:2]", "r1[10:2:-1]", "r1[-1:-4:-1]"])
def test_slices(spark, expression):
    text = "ACGTTGCAACGGTTAACCGGATATCGCGTACGTAGCTAGCTA"
    got = values(spark, lambda c: slices.parse_slices(expression, {"r1": c}), text)
    assert got == [eval(expression, {"r1": text})]  # noqa: S307  the test's own expression


@pytest.mark.parametrize("bad", ["r9[0:2]", "r1[0:2", "__import__('os')", "r1[::2]", "r1[0:2];r1", "r1[]", "", "r1.x", "r1[0:2]+"])
def test_bad_slices(bad):
    with pytest.raises(slices.SliceError):
        slices.parse_slices(bad, {"r1": F.lit("x")})


def test_quality_trimming():
    assert trimming.quality_cut("I" * 30, 25) == 0
    assert trimming.quality_cut("###IIIIIII"[::-1], 25) == 3
    assert trimming.quality_cut("IIIII" + "###I#I#", 25) == 7
    assert trimming.quality_cut("", 25) == 0
    assert trimming.dark_g_cut("ACGGG", "IIIII", 30) == 3


def test_poly_tail():
    assert trimming.poly_tail("ACGT" + "A" * 20) == 20 and trimming.poly_tail("ACGTAA") == 0 and trimming.poly_tail("") == 0
    assert trimming.poly_tail("CCCC" + "AAAAAAAAGAAAAAAAAAAA") == 20
    assert trimming.poly_tail("TTTTTTTTCC"[::-1], "T") == 8


def test_adapters():
    assert trimming.adapter_cut("TTTTACGTACGTAC", "ACGTACGTAC") == (4, 14)
    assert trimming.adapter_cut("TTTTACGTACTTAC", "ACGTACGTAC") == (4, 14)
    assert trimming.adapter_cut("TTTTTTACG", "ACGTACGTAC") == (6, 9)
    assert trimming.adapter_cut("TTTTTTTT", "ACGTACGTAC") == (-1, -1)
    assert trimming.adapter_cut("GTACTTTT", "ACGTAC", left=True) == (0, 4)


def test_longest_shared():
    assert matching.longest_shared("TTACGTT", "GGACGG") == (3, 5) and matching.longest_shared("", "A") == (0, 0)


def test_alignment():
    oligo = "ACGTTGCAAGCT"
    assert alignment.local_alignments("TTTT" + oligo + "GGGG", oligo) == [(4, 16, 24.0)]
    hit = alignment.local_alignments("TTTT" + oligo[:6] + "A" + oligo[7:] + "GGGG", oligo)
    assert hit == [(4, 16, 20.5)]
    assert alignment.local_alignments("TTTTTTTTTT", oligo) == []
    two = alignment.local_alignments(oligo + "TTTTTT" + oligo, oligo)
    assert [(s, e) for s, e, _ in two] == [(0, 12), (18, 30)]
