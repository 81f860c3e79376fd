"""Reads: preprocessing steps, their pipeline string, and its statistics.

A read is (qname, r1, q1, r2, q2) with parallel arrays a5/t5 and a3/t3: what was trimmed at either end, and how much.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions.sequence import quantize_quality
from tesserae.functions.slices import parse_slices
from tesserae.functions.trimming import adapter_span, dark_g_trim_length, poly_trim_length, quality_trim_length

Step = Callable[[DataFrame], DataFrame]


def with_trim_columns(df: DataFrame) -> DataFrame:
    for c, kind in (("a5", "array<string>"), ("t5", "array<int>"), ("a3", "array<string>"), ("t3", "array<int>")):
        if c not in df.columns:
            df = df.withColumn(c, F.array().cast(kind))
    return df


def _trimmed(df: DataFrame, left: Column, right: Column, name: str) -> DataFrame:
    """Cut r2 and q2 and note what was cut, where anything was."""
    df = with_trim_columns(df).withColumn("_l", left).withColumn("_r", right)
    keep = F.greatest(F.length("r2") - F.col("_l") - F.col("_r"), F.lit(0))
    df = df.withColumns({"_r2": F.substr("r2", F.col("_l") + 1, keep), "_q2": F.substr("q2", F.col("_l") + 1, keep)})
    for end, n in (("5", "_l"), ("3", "_r")):
        some = F.col(n) > 0
        df = df.withColumn(f"a{end}", F.when(some, F.array_append(f"a{end}", F.lit(name))).otherwise(F.col(f"a{end}")))
        df = df.withColumn(f"t{end}", F.when(some, F.array_append(f"t{end}", F.col(n))).otherwise(F.col(f"t{end}")))
    return df.withColumns({"r2": F.col("_r2"), "q2": F.col("_q2")}).drop("_l", "_r", "_r2", "_q2")


def clip(left: int = 0, right: int = 0) -> Step:
    def step(df: DataFrame) -> DataFrame:
        keep = F.greatest(F.length("r2") - left - right, F.lit(0))
        return df.withColumns({c: F.substr(c, F.lit(left + 1), keep) for c in ("r2", "q2")})

    return step


def quality(left: int = 0, right: int = 25) -> Step:
    def step(df: DataFrame) -> DataFrame:
        zero = F.lit(0)
        cut5 = quality_trim_length(F.reverse("q2"), left) if left else zero
        cut3 = quality_trim_length(F.col("q2"), right) if right else zero
        df = df.withColumn("_5", cut5).withColumn("_3", cut3)
        gone = F.col("_5") + F.col("_3") >= F.length("q2")  # nothing is left: all of it counts as cut from the end
        left_, right_ = F.when(gone, 0).otherwise(F.col("_5")), F.when(gone, F.length("q2")).otherwise(F.col("_3"))
        return _trimmed(df, left_, right_, "Q").drop("_5", "_3")

    return step


def nextseq_quality(cutoff: int = 30) -> Step:
    return lambda df: _trimmed(df, F.lit(0), dark_g_trim_length(F.col("r2"), F.col("q2"), cutoff), "NextQ")


def poly_a(rev_comp: bool = False) -> Step:
    """Trim a poly-A tail, or with rev_comp a poly-T head."""

    def step(df: DataFrame) -> DataFrame:
        if rev_comp:
            return _trimmed(df, poly_trim_length(F.reverse("r2"), "T"), F.lit(0), "polyA")
        return _trimmed(df, F.lit(0), poly_trim_length(F.col("r2")), "polyA")

    return step


def adapter(name: str, seq: str, where: str = "right", max_errors: float = 0.1, min_overlap: int = 3) -> Step:
    def step(df: DataFrame) -> DataFrame:
        df = df.withColumn("_hit", adapter_span(F.col("r2"), seq, max_errors, min_overlap, where == "left"))
        found = F.col("_hit.start") >= 0
        left = F.when(found, F.col("_hit.end")).otherwise(0) if where == "left" else F.lit(0)
        right = F.lit(0) if where == "left" else F.when(found, F.length("r2") - F.col("_hit.start")).otherwise(0)
        return _trimmed(df, left, right, name).drop("_hit")

    return step


def quantize(bin_width: int = 10) -> Step:
    return lambda df: df.withColumn("q2", quantize_quality(F.col("q2"), bin_width))


def simple_name(prefix: str = "", number: str = "record_no") -> Step:
    """Reads are renamed to their record number, which sources provide."""
    return lambda df: df.withColumn("qname", F.concat(F.lit(prefix), F.col(number).cast("string")))


def barcode(cell: str = "r1[:12]", UMI: str = "r1[12:20]", seq: str = "r2", qual: str = "r2_qual") -> Step:  # noqa: N803
    """CB and MI, and new r2 and q2, from slice expressions over r1, r2, r1_qual, r2_qual, qname and i5i7."""

    def step(df: DataFrame) -> DataFrame:
        index = F.regexp_extract("qname", r":([ACGTN+]+)$", 1)
        named = {"r1": F.col("r1"), "r2": F.col("r2"), "r1_qual": F.col("q1"), "r2_qual": F.col("q2"), "qname": F.col("qname"), "i5i7": F.replace(index, F.lit("+"), F.lit(""))}
        return df.withColumns({"CB": parse_slices(cell, named), "MI": parse_slices(UMI, named), "r2": parse_slices(seq, named), "q2": parse_slices(qual, named)})

    return step


STEPS: dict[str, Callable[..., Step]] = {
    "clip": clip, "quality": quality, "nextseq_quality": nextseq_quality, "polyA": poly_a, "adapter": adapter, "qquant": quantize, "simple_name": simple_name, "barcode": barcode,
}
KINDS = {"left": int, "right": int, "cutoff": int, "bin_width": int, "max_errors": float, "min_overlap": int, "rev_comp": lambda x: x.lower() in ("1", "true", "yes")}


def parse_steps(spec: str) -> list[tuple[str, dict]]:
    """'quality:right=25;polyA;barcode:cell=r1[0:12],UMI=r1[12:20]' as [(name, parameters)]."""
    out = []
    for part in filter(None, (p.strip() for p in spec.split(";"))):
        name, _, args = part.partition(":") if part.split(":")[0] in STEPS else (part, "", "")
        if name not in STEPS:
            raise ValueError(f"no preprocessing step {name!r}; there are {sorted(STEPS)}")
        pairs = dict(a.split("=", 1) for a in filter(None, args.split(",")))
        out.append((name, {k: KINDS.get(k, str)(v) for k, v in pairs.items()}))
    return out


def preprocessed(df: DataFrame, steps: str | list[tuple[str, dict]]) -> DataFrame:
    """Run steps in order. Given as a list (a flavour) a barcode step is added last if there is none, and sees trimmed reads."""
    todo = parse_steps(steps) if isinstance(steps, str) else list(steps)
    if not isinstance(steps, str) and all(n != "barcode" for n, _ in todo):
        todo.append(("barcode", {}))
    df = with_trim_columns(df)
    for name, args in todo:
        df = STEPS[name](**args)(df)
    return df


def long_enough(df: DataFrame, least: int = 18, column: str = "r2") -> DataFrame:
    return df.filter(F.length(column) >= least)


def every_nth(df: DataFrame, n: int, number: str = "record_no") -> DataFrame:
    """Records 0, n, 2n, ...; n of 0 or 1 keeps all."""
    return df.filter(F.col(number) % n == 0) if n > 1 else df


def sample_number(key: str) -> Column:
    """From 0 to 99 by a hash of the name."""
    return F.pmod(F.xxhash64(key), F.lit(100))


def subsampled(df: DataFrame, percent: int, key: str = "qname") -> DataFrame:
    """A deterministic sample by name: all rows of a name stay together, larger samples hold smaller ones."""
    return df.filter(sample_number(key) < percent)


def in_samples(df: DataFrame, number: Column, step: int = 10) -> DataFrame:
    """df once for every sample (pct: step, 2 step ... 100) that a row is in: those above its number from 0 to 99.

    One scan makes all samples, and larger ones hold smaller ones.
    """
    first = (F.floor(number / step) + 1) * step
    return df.withColumn("pct", F.explode(F.sequence(first.cast("long"), F.lit(100).cast("long"), F.lit(step).cast("long"))))


def random_rows(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows without replacement, in the order of a seeded hash."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def preprocessing_stats(before: DataFrame, after: DataFrame, sample: str, output: DataFrame | None = None) -> DataFrame:
    """(sample, measure, name, value, count): reads in (and out, where output is given), base counts by length in and out,
    reads per adapter, and per adapter the trims by length and their total."""
    row = lambda m, n, v, c: F.struct(F.lit(m).alias("measure"), n.alias("name"), v.cast("string").alias("value"), c.cast("long").alias("count"))
    one = F.lit(1)

    def trims(end: str) -> list[Column]:
        a, t = f"a{end}", f"t{end}"
        z = F.arrays_zip(a, t)
        reads_ = F.transform(z, lambda x: row("reads", F.lit(f"A{end}"), x[a], one))
        return [reads_, F.transform(z, lambda x: row("bases", x[a], x[t], one)), F.transform(z, lambda x: row("bases", x[a], F.lit(f"A{end}_total"), x[t]))]

    parts = [before.select(F.explode(F.array(row("reads", F.lit("N"), F.lit("input"), one), row("bases", F.lit("L_in"), F.length("r2"), one))).alias("x"))]
    parts.append(after.select(F.explode(F.concat(F.array(row("bases", F.lit("L_out"), F.length("r2"), one)), *[x for e in "53" for x in trims(e)])).alias("x")))
    if output is not None:
        parts.append(output.select(row("reads", F.lit("N"), F.lit("output"), one).alias("x")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    counted = rows.select("x.*").groupBy("measure", "name", "value").agg(F.sum("count").alias("count"))
    return counted.select(F.lit(sample).alias("sample"), "measure", "name", "value", "count")


def paired(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """Zip two FASTQ scans by file pair and record number; the name is R1's, up to white space."""
    a = r1.select("pair", "record_no", F.regexp_extract("name", r"^(\S*)", 1).alias("qname"), F.col("seq").alias("r1"), F.col("qual").alias("q1"))
    b = r2.select("pair", "record_no", F.col("seq").alias("r2"), F.col("qual").alias("q2"))
    return a.join(b, ["pair", "record_no"])


def single(r2: DataFrame) -> DataFrame:
    """Single-end reads: r1 is the sentinel NA with quality ##."""
    return r2.select("pair", "record_no", F.regexp_extract("name", r"^(\S*)", 1).alias("qname"), F.lit("NA").alias("r1"), F.lit("##").alias("q1"), F.col("seq").alias("r2"), F.col("qual").alias("q2"))


def merged_samples(parts: list[DataFrame], name: str = "qname") -> DataFrame:
    """All rows of several samples (columns that one lacks are null there), sorted by name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.orderBy(name)


def first_seen(df: DataFrame, key: list[str], order: list[str], name: str = "is_first") -> DataFrame:
    """Flag the first row of every key in a stated order (duplicates are PCR copies of a molecule)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)) == 1)
