"""Column functions over nucleotide strings, quality strings, barcodes and CIGARs; all JVM-side."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# IUPAC codes and their complements; gaps stay.
IUPAC, COMPLEMENT = "ACGTUNRYSWKMBDHVacgtunryswkmbdhv", "TGCAANYRSWMKVHDBtgcaanyrswmkvhdb"


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), IUPAC, COMPLEMENT)


def complement(seq: Column) -> Column:
    return F.translate(seq, IUPAC, COMPLEMENT)


def is_nucleotides(seq: Column) -> Column:
    """Whether every character has a complement (or is a gap sign)."""
    return seq.rlike(f"^[{IUPAC}=+-]*$")


def characters(seq: Column) -> Column:
    return F.filter(F.split(seq, ""), lambda c: c != "")


def shannon_entropy(seq: Column) -> Column:
    """Entropy of a string's characters in bits, rounded half even to 2 places; 0 for an empty string."""
    n = F.length(seq)
    share = F.transform(F.array_distinct(characters(seq)), lambda c: (n - F.length(F.replace(seq, c, F.lit("")))) / n)
    total = F.aggregate(share, F.lit(0.0), lambda a, p: a - p * F.log2(p))
    return F.when(n > 0, F.bround(total, 2) + F.lit(0.0)).otherwise(F.lit(0.0))


def runs(seq: Column) -> Column:
    """Maximal stretches of one character."""
    return F.regexp_extract_all(seq, F.lit(r"(?s)((.)\2*)"), F.lit(1))


def compressed_length(seq: Column) -> Column:
    """Length of the run-length encoding that writes a letter and a count for every run."""
    return F.aggregate(runs(seq), F.lit(0), lambda a, r: a + 1 + F.length(F.length(r).cast("string")))


def collapsed_runs(seq: Column) -> Column:
    return F.array_join(F.transform(runs(seq), lambda r: F.substring(r, 1, 1)), "")


def hamming(a: Column, b: Column) -> Column:
    """Differing positions up to the shorter length."""
    n = F.least(F.length(a), F.length(b))
    pairs = F.zip_with(characters(F.substr(a, F.lit(1), n)), characters(F.substr(b, F.lit(1), n)), lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.aggregate(pairs, F.lit(0), lambda s, x: s + x)


#: Characters of the pieces that long texts are cut into, as a substring far into a text is slow to get at.
PIECE = 48


def overlapping_pieces(seq: Column, k: int) -> Column:
    """A text in pieces of PIECE characters, each with the first k - 1 of the next."""
    pieces = F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.transform(F.arrays_zip(pieces.alias("p"), F.slice(pieces, F.lit(2), F.greatest(F.size(pieces), F.lit(1))).alias("q")), lambda z: F.concat(z["p"], F.substring(F.coalesce(z["q"], F.lit("")), 1, k - 1)))


def kmers(seq: Column, k: int) -> Column:
    """Array of (position from 0, k-mer), in order; each is a substring of a short piece, as at every position of a long text it would be quadratic."""
    joined = overlapping_pieces(seq, k)

    def of_piece(text: Column, j: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.least(F.length(text) - k, F.lit(PIECE - 1))), lambda i: (i >= 0) & (i <= F.length(text) - k))
        return F.transform(places, lambda i: F.struct((j * PIECE + i).cast("int").alias("position"), F.substr(text, i + 1, F.lit(k)).alias("kmer")))

    return F.coalesce(F.flatten(F.transform(joined, of_piece)), F.array().cast("array<struct<position:int,kmer:string>>"))


def all_kmers(k: int, letters: str = "ACGTN") -> list[str]:
    return ["".join(x) for x in product(letters, repeat=k)]


def phred(quality: Column) -> Column:
    """Array of Phred scores of a quality string (offset 33)."""
    return F.transform(characters(quality), lambda c: F.ascii(c) - 33)


def quantize_quality(quality: Column, width: int = 10, most: int = 40) -> Column:
    """Scores rounded half even to multiples of width, as one translate(); scores above `most` stay."""
    scores = range(most + 1)
    return F.translate(quality, "".join(chr(33 + q) for q in scores), "".join(chr(33 + round(q / width) * width) for q in scores))


def cigar_ops(cigar: Column) -> Column:
    """Array of (n, op)."""
    parts = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^(\d+)", 1).cast("int").alias("n"), F.right(p, F.lit(1)).alias("op")))


def cigar_summary(cigar: Column) -> Column:
    """(clip5, clip3, n_match, total_match): leading clip, last other clip, longest single and summed match runs."""
    ops = cigar_ops(cigar)
    zero = F.lit(0)
    first = F.get(ops, zero)
    later = F.filter(F.slice(ops, 2, 1_000_000), lambda o: o["op"] == "S")
    match = F.transform(F.filter(ops, lambda o: o["op"] == "M"), lambda o: o["n"])
    return F.struct(
        F.when(first["op"] == "S", first["n"]).otherwise(zero).alias("clip5"),
        F.coalesce(F.get(later, F.size(later) - 1)["n"], zero).alias("clip3"),
        F.coalesce(F.array_max(match), zero).alias("n_match"),
        F.aggregate(match, zero, lambda a, n: a + n).alias("total_match"),
    )


def coarse_cigar(ops: Column) -> Column:
    """A string of CIGAR letters with every M x M of gap operations x collapsed."""
    return F.regexp_replace(ops, "M([IDN]M)+", "M")


def safe_divide(a: Column, b: Column) -> Column:
    """a / b with 0 where that is undefined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def one_place(x: Column) -> Column:
    """A number with one decimal place; halves are what the binary number makes of them."""
    return F.call_function("format_number", x, F.lit("0.0"))


def short_number(n: Column) -> Column:
    """1234567 as 1.2M."""
    return F.when(n >= 1_000_000, F.concat(one_place(n / 1e6), F.lit("M"))).when(n >= 1000, F.concat(one_place(n / 1e3), F.lit("k"))).otherwise(n.cast("string"))


def tag(tags: Column, name: str, default: str = "NA") -> Column:
    """A record's tag from its map of tags."""
    return F.coalesce(tags[name], F.lit(default))


def random_barcode(length: int, *key: Column, seed: int = 0, letters: str = "ACTG") -> Column:
    """A string of random letters, the same for the same key and seed."""
    each = [F.substring(F.lit(letters), F.pmod(F.xxhash64(F.lit(seed), F.lit(i), *key), F.lit(len(letters))).cast("int") + 1, F.lit(1)) for i in range(length)]
    return F.concat(*each) if each else F.lit("")


def sample_name(path: Column) -> Column:
    """A sample's name from its file's: without folders, what conversion tools put around it, and beyond its second _ part."""
    base = F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"sts_|pb_|ds_|\.fq|\.bam|lima\.", "")
    return F.when(F.length(base) - F.length(F.replace(base, F.lit("_"), F.lit(""))) > 1, F.substring_index(base, "_", 2)).otherwise(base)


def oligo_partner(name: Column) -> Column:
    """X <-> X_RC."""
    return F.when(name.endswith("_RC"), F.regexp_replace(name, "_RC$", "")).otherwise(F.concat(name, F.lit("_RC")))
