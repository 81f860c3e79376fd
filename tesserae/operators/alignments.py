"""Alignments: gene assignment, strand and type classes, multi-mappers, statistics, small-RNA verdicts."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.sequence import cigar_ops, cigar_summary, coarse_cigar

UNIQUE, SECONDARY, UNMAPPED, REVERSE = 255, 256, 4, 16
#: Gene functions from the most to the least telling (fixed values).
HIERARCHY = ("CODING", "UTR", "INTRONIC", "INTERGENIC")
#: Aliases of gene functions in other annotation schemes (fixed values).
CANONICAL = {"CDS": "CODING", "intron": "INTRONIC", "non-coding": "UTR"}


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def mapped(df: DataFrame) -> DataFrame:
    return df.filter(~has_flag(F.col("flag"), UNMAPPED))


def unmapped(df: DataFrame) -> DataFrame:
    return df.filter(has_flag(F.col("flag"), UNMAPPED))


def unique_mappers(df: DataFrame) -> DataFrame:
    return df.filter(F.col("mapq") >= UNIQUE)


def gene_of(gn: Column, gf: Column, ignored: tuple[str, ...] = ("INTERGENIC", "INTRONIC")) -> Column:
    """One distinct gene over the functions that count: that gene; none or several: multi_mapper; no functions: NA."""
    pairs = F.filter(F.arrays_zip(gn.alias("gn"), gf.alias("gf")), lambda p: ~p["gf"].isin(*ignored))
    genes = F.array_distinct(F.transform(pairs, lambda p: p["gn"]))
    return F.when(gf.isNull() | (F.size(gf) == 0), F.lit("NA")).when(F.size(genes) == 1, F.get(genes, F.lit(0))).otherwise(F.lit("multi_mapper"))


def gene_by_reference(df: DataFrame, names: DataFrame | None = None, chrom: str = "rname") -> DataFrame:
    """gene: the reference's name, translated by names (original, target) where listed."""
    if names is None:
        return df.withColumn("gene", F.col(chrom))
    to = names.select(F.col("original").alias(chrom), F.col("target").alias("_target"))
    return df.join(to, chrom, "left").withColumn("gene", F.coalesce("_target", chrom)).drop("_target")


def abundant_rna(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """af and an of a reference from lookup (ref, af, an); NA where it isn't listed."""
    out = df.join(lookup.withColumnRenamed("ref", "rname"), "rname", "left")
    return out.withColumns({c: F.coalesce(c, F.lit("NA")) for c in ("af", "an")})


def top_function(gf: Column) -> Column:
    """The most telling function of a list; the list itself, joined, where none is known."""
    case = F.when(F.size(F.array_distinct(gf)) == 1, F.get(gf, F.lit(0)))
    for f in HIERARCHY:
        case = case.when(F.array_contains(gf, f), F.lit(f))
    return case.otherwise(F.array_join(gf, ","))


def best_genes(genes: Column) -> Column:
    """Genes at the best priority, as struct(names: sorted and comma-joined, function: of the last of them).

    genes: array of struct(name, function, sense, exonic). Sense and exonic comes first, then sense, exonic, neither.
    """
    order = lambda g: F.when(g["sense"] & g["exonic"], 0).when(g["sense"], 1).when(g["exonic"], 20).otherwise(30)
    best = F.array_min(F.transform(genes, order))
    top = F.filter(genes, lambda g: order(g) == best)
    return F.struct(F.array_join(F.array_sort(F.array_distinct(F.transform(top, lambda g: g["name"]))), ",").alias("names"), F.element_at(F.transform(top, lambda g: g["function"]), -1).alias("function"))


def overlapping_genes(gn: Column, gf: Column, gs: Column, flag: Column) -> Column:
    """The input of best_genes from parallel lists and the read's strand."""
    read = F.when(has_flag(flag, REVERSE), "-").otherwise("+")
    return F.transform(F.arrays_zip(gn.alias("n"), gf.alias("f"), gs.alias("s")), lambda z: F.struct(z["n"].alias("name"), z["f"].alias("function"), (z["s"] == read).alias("sense"), z["f"].isin("UTR", "CODING").alias("exonic")))


def has_part(tags: Column, text: str) -> Column:
    """Whether any of a list of tag values holds a text (SMART_TSO holds TSO)."""
    return F.coalesce(F.exists(tags, lambda t: t.contains(text)), F.lit(False))


def name_flags(text: Column, words: list[str], prefix: str = "name") -> dict[str, Column]:
    """prefix_has_W and prefix_missing_W by substring."""
    out = {f"{prefix}_has_{w}": text.contains(w) for w in words}
    return out | {f"{prefix}_missing_{w}": ~text.contains(w) for w in words}


def count_predicates(cigar: Column, a5: Column, a3: Column, gene: Column) -> dict[str, Column]:
    """What a counted alignment is: short, primer, targeted_primer, ligation_product, everything."""
    short = cigar_summary(cigar)["n_match"] < 17
    tailed = has_part(a3, "polyA")
    primer = has_part(a5, "TSO") | ~tailed
    return {"short": short, "primer": primer, "targeted_primer": primer, "ligation_product": ~short & ~primer & tailed & (gene != "NA"), "everything": F.lit(True)}


#: Domains of the two classes (fixed values).
READ_TYPES = ["INTERGENIC", "INTRONIC", "CODING", "UTR", "AMB"]
STRAND_TYPES = ["minus_minus", "minus_plus", "plus_plus", "plus_minus", "plus_AMB", "minus_AMB"]


def strand_and_type(gs: Column, gf: Column, flag: Column) -> dict[str, Column]:
    """strand_type: the read's strand and that of its genes (AMB: none or several), as minus_plus; read_type: the one gene
    function, AMB for several, INTERGENIC without one gene strand."""
    none = F.array().cast("array<string>")
    strands, kinds = F.array_distinct(F.coalesce(gs, none)), F.array_distinct(F.coalesce(gf, none))
    word = lambda c: F.when(c == "-", "minus").when(c == "+", "plus").otherwise(c)
    gene = F.when(F.size(strands) == 1, word(F.get(strands, F.lit(0)))).otherwise("AMB")
    read = F.when(has_flag(flag, REVERSE), "minus").otherwise("plus")
    kind = F.when(F.size(strands) != 1, "INTERGENIC").when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).otherwise("AMB")
    return {"strand_type": F.concat(read, F.lit("_"), gene), "read_type": kind}


def collapsed(values: Column, ambiguous: str = "AMB") -> Column:
    return F.when(F.size(F.array_distinct(values)) == 1, F.get(values, F.lit(0))).otherwise(F.lit(ambiguous))


def small_rna_verdict(cigar: Column, a5: Column, a3: Column, af: Column, pool: Column | None = None, gene_pool: Column | None = None) -> Column:
    """'pass', or what is wrong with a small-RNA alignment, in a fixed order.

    pool, gene_pool: whether the reference name, else its gene, is targeted; they count for reads with a TSO only.
    """
    c = cigar_summary(cigar)
    last = F.element_at(cigar_ops(cigar), -1)
    clip3 = F.when(last["op"] == "S", last["n"]).otherwise(0)
    tso, no = has_part(a5, "TSO"), F.lit(False)
    by_name, by_gene = (no if p is None else p for p in (pool, gene_pool))
    tests = [
        (tso, "TSO"), (tso & by_name, "POOL"), (tso & ~by_name & by_gene, "pool"), (af == "junk", "junk"), (~has_part(a3, "polyA"), "no_polyA"),
        (c["clip5"] != 2, "no_lig_NN"), (c["n_match"] < 17, "short_match"), (clip3 > 10, "too_much_clipped"),
    ]
    wrong = F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, n in tests]))
    return F.when(F.size(wrong) == 0, F.lit("pass")).otherwise(F.array_join(wrong, ","))


def resolved_multi_mappers(df: DataFrame, read: str = "qname", hits: str = "NH", function: str = "XF", good: tuple[str, ...] = ("UTR", "CODING")) -> DataFrame:
    """Unique alignments stay; of a read's several, the only one in an exon does, as primary; reads without exactly one go.

    One window per read replaces an algorithm over adjacent rows, so the input needs no order.
    """
    exonic = F.col(function).isin(*good)
    n = F.count(F.when(exonic, 1)).over(Window.partitionBy(read))
    keep = df.withColumn("_n", n).filter((F.col(hits) == 1) | ((F.col("_n") == 1) & exonic)).drop("_n")
    return keep.withColumn("flag", F.col("flag").bitwiseAND(F.lit(~SECONDARY))) if "flag" in df.columns else keep


def alignment_statistics(df: DataFrame, oligos: bool = False, only: str | None = None) -> DataFrame:
    """(measure, kind, key, n): all counters of one scan.

    aln_types, read_lengths (by mapping status), tag_types, uniq_tag_types, cigar_types, match_len_by_cigar, _by_tag and
    _by_utag (each also under `all`), sc_lengths and sc_seq (by end of the read as sequenced), and with oligos the parts
    that read names list behind __sig: (oligo_count, oligo_by_mapstat, oligo_by_tag). Unmapped rows count by length and
    oligos only. only: text that a counted row's name holds.
    """
    rows = df if only is None else df.filter(F.col("qname").contains(only))
    up, uniq, rev = has_flag(F.col("flag"), UNMAPPED), F.col("mapq") == UNIQUE, has_flag(F.col("flag"), REVERSE)
    ops = cigar_ops(F.coalesce("cigar", F.lit("")))
    first, last = F.get(ops, F.lit(0)), F.try_element_at(ops, F.lit(-1))
    gf = F.when(F.col("gf").isNull(), "INTERGENIC").otherwise(top_function(F.col("gf"))) if "gf" in df.columns else F.lit("INTERGENIC")
    own = rows.select(
        "seq", up.alias("up"), uniq.alias("uniq"), rev.alias("rev"), gf.alias("tag"), F.length("seq").cast("string").alias("L"),
        F.when(uniq, "unique").otherwise("multimapper").alias("status"), coarse_cigar(F.array_join(F.transform(ops, lambda o: o["op"]), "")).alias("type"),
        F.aggregate(F.filter(ops, lambda o: o["op"] == "M"), F.lit(0), lambda a, o: a + o["n"]).cast("string").alias("m"),
        F.when(first["op"] == "S", first["n"]).alias("head"), F.when(last["op"] == "S", last["n"]).alias("tail"),
        (F.filter(F.split(F.regexp_extract("qname", "__sig:(.*?)(?:__|$)", 1), ","), lambda p: p != "") if oligos else F.array().cast("array<string>")).alias("parts"),
    )
    text = lambda c: F.lit(c) if isinstance(c, str) else c
    put = lambda m, k, v: F.struct(F.lit(m).alias("measure"), text(k).alias("kind"), text(v).alias("key"))
    col = F.col
    always = [put("aln_types", "", "N_reads"), put("read_lengths", "all", col("L"))]
    lost = [put("aln_types", "", "unmapped"), put("read_lengths", "unmapped", col("L"))]
    found = [put("aln_types", "", "mapped"), put("aln_types", "", col("status")), put("read_lengths", "mapped", col("L")), put("read_lengths", col("status"), col("L")), put("tag_types", "", col("tag")), put("cigar_types", "", col("type"))]
    found += [put("match_len_by_cigar", k, col("m")) for k in (col("type"), "all")] + [put("match_len_by_tag", k, col("m")) for k in (col("tag"), "all")]
    only_uniq = [put("uniq_tag_types", "", col("tag"))] + [put("match_len_by_utag", k, col("m")) for k in (col("tag"), "all")]

    def clips(n: str, bases: Column, forward: str, backward: str) -> Column:
        end = F.when(col("rev"), backward).otherwise(forward)
        both = F.array(put("sc_lengths", end, col(n).cast("string")), put("sc_seq", end, bases))
        return F.when(col(n).isNotNull(), both).otherwise(F.slice(both, 1, 0))

    def by_part(m: str, kind) -> Column:
        return F.transform("parts", lambda p: put(m, kind, p))

    ends = [clips("head", F.substr("seq", F.lit(1), F.coalesce("head", F.lit(0))), "5'", "3'"), clips("tail", F.right("seq", F.coalesce("tail", F.lit(0))), "3'", "5'")]
    mapped_rows = F.concat(F.array(*found), F.when(col("uniq"), F.array(*only_uniq)).otherwise(F.slice(F.array(*only_uniq), 1, 0)), *ends, by_part("oligo_by_mapstat", "mapped"), by_part("oligo_by_mapstat", col("status")), by_part("oligo_by_tag", col("tag")))
    unmapped_rows = F.concat(F.array(*lost), by_part("oligo_by_mapstat", "unmapped"), by_part("oligo_by_tag", "NA"))
    every = F.concat(F.array(*always), by_part("oligo_count", ""), F.when(col("up"), unmapped_rows).otherwise(mapped_rows))
    return own.select(every.alias("x")).select(F.inline("x")).groupBy("measure", "kind", "key").agg(F.count("*").alias("n"))


def mean_length(hist: DataFrame, length: str = "key", n: str = "n") -> DataFrame:
    """Weighted mean of a length histogram, per other column."""
    by = [c for c in hist.columns if c not in (length, n)]
    return hist.groupBy(*by).agg((F.sum(F.col(length).cast("double") * F.col(n)) / F.sum(n)).alias("mean_length"))


def tag_statistics(df: DataFrame, tag: str, is_first: str = "is_first") -> DataFrame:
    """Per tag value, count and percent over reads and, separately, over first-seen molecules."""
    scopes = F.explode(F.concat(F.array(F.lit("reads")), F.when(F.col(is_first), F.array(F.lit("umis"))).otherwise(F.array().cast("array<string>"))))
    n = df.select(scopes.alias("scope"), F.col(tag).alias("value")).groupBy("scope", "value").agg(F.count("*").alias("n"))
    return n.withColumn("percent", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("scope")))


def hypergeometric_p(x: int, y: int, z: int, w: int) -> float:
    """Two-sided p of a 2x2 table: the weight of all tables with its margins that are no likelier.

    Likelihoods rise up to the mode and fall from there, so these tables are two tails; each is summed from its inner end
    outwards by the ratio of neighbours, in pieces, until a piece adds nothing. The far tail's end is found by bisection.
    """
    lf = math.lgamma
    rows, cols, n = x + y, x + z, x + y + z + w
    low, high = max(0, rows + cols - n), min(rows, cols)
    const = lf(rows + 1) + lf(n - rows + 1) + lf(cols + 1) + lf(n - cols + 1) - lf(n + 1)
    log = lambda k: const - lf(k + 1) - lf(rows - k + 1) - lf(cols - k + 1) - lf(n - rows - cols + k + 1)
    mode = min(high, max(low, (rows + 1) * (cols + 1) // (n + 2)))
    limit = log(x) + 1e-7

    def last(inside: int, outside: int) -> int | None:
        """The place nearest the mode, on one side of it, that is no likelier than x; None if there is none."""
        if log(outside) > limit:
            return None
        while abs(inside - outside) > 1:
            mid = (inside + outside) // 2
            inside, outside = (mid, outside) if log(mid) > limit else (inside, mid)
        return outside

    def tail(start: int, step: int) -> float:
        total, at, end = 0.0, start, high if step > 0 else low
        while True:
            k = np.arange(at, min(end, at + 4095) + 1 if step > 0 else max(end, at - 4095) - 1, step, dtype=np.float64)
            if step > 0:
                ratio = (rows - k) * (cols - k) / ((k + 1) * np.maximum(n - rows - cols + k + 1, 1))
            else:
                ratio = k * np.maximum(n - rows - cols + k, 0) / ((rows - k + 1) * (cols - k + 1))
            piece = math.exp(log(at)) * float(np.cumprod(np.r_[1.0, ratio[:-1]]).sum())
            total, at = total + piece, at + step * len(k)
            if (at - end) * step > 0 or piece <= total * 1e-15:
                return total

    if log(mode) <= limit:
        return 1.0
    ends = [(last(mode, low), -1) if low < mode else (None, -1), (last(mode, high), 1) if high > mode else (None, 1)]
    return min(1.0, sum(tail(k, step) for k, step in ends if k is not None))


def fisher_exact(table: DataFrame, a: str, b: str, c: str, d: str, pseudo: int = 1, alpha: float = 0.05) -> DataFrame:
    """Two-sided exact test of each row's 2x2 table (pseudo added to every cell): odds_ratio and p_value, p below alpha only."""

    @F.pandas_udf("double")
    def p_value(wa: pd.Series, wb: pd.Series, wc: pd.Series, wd: pd.Series) -> pd.Series:
        return pd.Series([hypergeometric_p(*map(int, q)) for q in zip(wa, wb, wc, wd, strict=True)])

    cells = [F.col(x) + pseudo for x in (a, b, c, d)]
    out = table.withColumn("odds_ratio", cells[0] * cells[3] / (cells[1] * cells[2]).cast("double")).withColumn("p_value", p_value(*cells))
    return out.filter(F.col("p_value") < alpha)
