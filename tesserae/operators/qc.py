"""Quality-control tables: curves, deciles, densities, nucleotide distributions, mapping statistics, sample summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DENSE = 2.5066282746310002  # sqrt(2 pi)


def knee(cells: DataFrame, by: list[str], value: str = "n_reads", key: str = "cell_bc") -> DataFrame:
    """Rank and cumulative sum of reads, largest first; ties by key. Cells without a value go.

    No task sorts a whole group: cells are counted per value and stretch of keys, running sums over these counts say what
    comes before each stretch, and rows are numbered within theirs.
    """
    own = cells.filter(F.col(value).isNotNull()).withColumn("_part", _stretch(cells, key))
    counts = own.groupBy(*by, value, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy(F.desc(value), "_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    counts = counts.select(*by, value, "_part", zero(F.sum("_n").over(before)).alias("_before"), F.coalesce(F.sum(F.col("_n") * F.col(value)).over(before), F.lit(0)).alias("_sum"))
    own = own.withColumn("_i", F.row_number().over(Window.partitionBy(*by, value, "_part").orderBy(key)))
    same = None
    for c in (*by, value, "_part"):
        test = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        same = test if same is None else same & test
    met = own.alias("a").join(counts.alias("b"), same)
    return met.select(*[F.col(f"a.{c}") for c in cells.columns], (F.col("b._before") + F.col("a._i")).alias("rank"), (F.col("b._sum") + F.col("a._i") * F.col(f"a.{value}")).alias("cumulative"))


def _stretch(cells: DataFrame, key: str) -> Column:
    """A coarser key that sorts alike: the first characters of a text, a number without its last digits."""
    return F.substring(key, 1, 4) if cells.schema[key].dataType.typeName() == "string" else F.floor(F.col(key) / 4096)


def _per_group(rows: DataFrame, cells: DataFrame, by: list[str], **values: Column) -> DataFrame:
    """rows with aggregates of their group's cells beside them: a row per group is joined."""
    per = cells.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(*[v.alias(n) for n, v in values.items()])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(per, same).drop(*[f"_{c}" for c in by]) if by else rows.withColumn("_one", F.lit(1)).join(per.withColumn("_one", F.lit(1)), "_one").drop("_one")


def deciles(cells: DataFrame, by: list[str], value: str = "n_reads", key: str = "cell_bc") -> DataFrame:
    """Tenths of the cumulative reads, 1 to 10; the row that reaches the total falls out, as its number is 11."""
    k = _per_group(knee(cells, by, value, key), cells, by, _total=F.sum(value))
    out = k.withColumn("decile", (F.floor(F.col("cumulative") / (F.col("_total") / 10)) + 1).cast("int"))
    return out.filter("decile < 11").drop("rank", "cumulative", "_total")


def decile_medians(cells: DataFrame, by: list[str], values: list[str], key: str = "cell_bc", weight: str = "n_reads") -> DataFrame:
    """Long table (by, decile, observation, value): medians of values and the number of cells."""
    m = deciles(cells, by, weight, key).groupBy(*by, "decile").agg(*[F.median(v).alias(v) for v in values], F.count("*").cast("double").alias("cell_count"))
    return m.unpivot([*by, "decile"], [*values, "cell_count"], "observation", "value")


def equal_width_class(value: Column, low: Column, high: Column, n: int = 4) -> Column:
    """Class 1..n of equal-width, right-closed bins over [low, high]; the lowest value is included."""
    at = F.ceil((value - low) * n / F.nullif(high - low, F.lit(0))).cast("int")
    return F.when(value == low, 1).otherwise(F.greatest(F.lit(1), F.least(F.lit(n), at)))


def nucleotides(cells: DataFrame, by: list[str], value: str = "n_reads", key: str = "cell_bc") -> DataFrame:
    """(by, quartile, position, nucleotide, n) of barcodes, quartiles of the cumulative reads by equal width."""
    # reads aren't negative: the cumulative sum starts at the most reads of a cell and ends at their sum
    k = _per_group(knee(cells, by, value, key), cells, by, _low=F.max(value), _high=F.sum(value))
    q = k.withColumn("quartile", equal_width_class(F.col("cumulative"), F.col("_low"), F.col("_high")))
    chars = F.filter(F.split(F.col(key), ""), lambda c: c != "")
    return q.select(*by, "quartile", F.posexplode(chars).alias("position", "nucleotide")).groupBy(*by, "quartile", "position", "nucleotide").agg(F.count("*").alias("n"))


def cutoff_curve(cells: DataFrame, values: list[str], by: str = "total_counts", first: int = 10, last: int = 20_000, step: int = 10) -> DataFrame:
    """Per cutoff (first, first + step, ... below last): cells strictly above it and medians of values; cutoffs without cells go.

    Cells are first counted per (highest cutoff below, value); only those counts meet the cutoffs, so the expansion is
    bounded by the number of different values, not of cells.
    """
    top = F.least(F.ceil(F.col(by)) - 1, F.lit(last - 1))
    reach = (F.floor((top - first) / step) * step + first).cast("long")
    long = cells.filter(top >= first).select(reach.alias("reach"), F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values])).alias("x"))
    counts = long.groupBy("reach", "x.name", "x.value").agg(F.count("*").alias("n"))
    each = counts.withColumn("cutoff", F.explode(F.sequence(F.lit(first).cast("long"), F.col("reach"), F.lit(step).cast("long"))))
    of = lambda v: F.when(F.col("name") == v, F.col("n")).otherwise(0)
    return each.groupBy("cutoff").agg(F.sum(of(values[0])).alias("n_cells"), *[F.percentile(F.when(F.col("name") == v, F.col("value")), 0.5, of(v)).alias(f"median_{v}") for v in values])


def histogram(df: DataFrame, value: str, n: int = 100, low: float | None = None, high: float | None = None, log: bool = False) -> DataFrame:
    """(bin, low, high, n): equal-width bins (of log10 if log), the last one closed; empty bins are absent."""
    x = F.log10(F.col(value)) if log else F.col(value).cast("double")
    rows = df.select(x.alias("x")).filter("x IS NOT NULL")
    if low is None or high is None:
        e = rows.agg(F.min("x"), F.max("x")).first()
        low, high = (0.0, 1.0) if e[0] is None else (float(e[0]), float(e[1]))
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / n
    at = F.least(F.floor((F.col("x") - low) / width), F.lit(n - 1)).cast("int")
    out = rows.filter((F.col("x") >= low) & (F.col("x") <= high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    edge = (lambda c: F.pow(F.lit(10.0), c)) if log else (lambda c: c)
    return out.select("bin", edge(low + F.col("bin") * width).alias("low"), edge(low + (F.col("bin") + 1) * width).alias("high"), "n")


def density(df: DataFrame, value: str, by: list[str], bandwidth: float = 0.1, points: int = 100, cells: int = 1000) -> DataFrame:
    """(by, x, density): Gaussian kernel density of log10(value) at `points` places over its range.

    Values are first counted in `cells` fine bins over the common range, so the product with the places is of bounded
    size whatever the input; bins of a value each (cells = 0) give the exact sum.
    """
    own = df.filter(F.col(value) > 0).select(*by, F.log10(value).alias("v"))
    e = own.agg(F.min("v"), F.max("v")).first()
    low, high = (0.0, 1.0) if e[0] is None else (e[0], e[1])
    v = F.col("v")
    if cells and high > low:
        v = low + (F.least(F.floor((v - low) / ((high - low) / cells)), F.lit(cells - 1)) + 0.5) * ((high - low) / cells)
    binned = own.groupBy(*by, v.alias("v")).agg(F.count("*").alias("n"))
    step = (high - low) / max(1, points - 1)
    places = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: low + i * step))
    z = (F.col("x") - F.col("v")) / bandwidth
    return binned.withColumn("x", places).groupBy(*by, "x").agg((F.sum(F.col("n") * F.exp(-z * z / 2)) / (F.sum("n") * bandwidth * DENSE)).alias("density"))


def medians_above(df: DataFrame, by: list[str], value: str, cutoffs: list[int], on: str = "total_counts") -> DataFrame:
    """(by, cutoff, median): the median of value per group over rows above each of a few cutoffs."""
    each = F.explode(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: F.col(on) > c))
    return df.select(*by, value, each.alias("cutoff")).groupBy(*by, "cutoff").agg(F.median(value).alias("median"))


def run_mode_summary(cells: DataFrame, by: list[str]) -> DataFrame:
    """Per run mode: n_beads, sum_reads (millions), and medians to 3 places."""
    med = [F.bround(F.median(c), 3).alias(f"median_{n}") for c, n in (("n_genes_by_counts", "genes"), ("reads_per_counts", "pcr"), ("n_reads", "reads"), ("total_counts", "umis"))]
    return cells.groupBy(*by).agg(F.count("*").alias("n_beads"), F.bround(F.sum("n_reads") / 1e6, 3).alias("sum_reads"), *med)


def sample_metrics(cells: DataFrame, counts: DataFrame, cutoff: int = 0, cell: str = "cell_bc", gene: str = "gene") -> DataFrame:
    """One row: genes and spots of cells above the cutoff, and their medians. counts: (cell, gene) of the count matrix."""
    rows = cells.filter(F.col("total_counts") > cutoff)
    genes = counts.join(rows.select(F.col(cell).alias("cell")), "cell", "left_semi").agg(F.countDistinct(gene).alias("n_genes"))
    per = rows.agg(F.count("*").alias("n_spots"), F.median("total_counts").alias("median_umis"), F.median("n_genes_by_counts").alias("median_genes"))
    both = per.unionByName(genes, allowMissingColumns=True)  # two single rows become one
    return both.agg(*[F.max(c).alias(c) for c in ("n_genes", "n_spots", "median_umis", "median_genes")])


def collapsed_counts(counts: DataFrame, by: list[str], name: str = "name", n: str = "n", threshold: float = 0.01, total: str | None = None, missing: str = "NA") -> DataFrame:
    """(by, name, n, fraction): names below the threshold share become misc; what the total has beyond all names is `missing`.

    total: a column with the group's total (default: the sum of n).
    """
    part = Window.partitionBy(*by)
    whole = F.max(total).over(part) if total else F.sum(n).over(part)
    own = counts.select(*by, F.col(name).alias("name"), F.col(n).alias("n"), whole.alias("_all"), F.sum(n).over(part).alias("_sum"))
    kept = own.groupBy(*by, F.when(F.col("n") / F.col("_all") < threshold, "misc").otherwise(F.col("name")).alias("name")).agg(F.sum("n").alias("n"), F.max("_all").alias("_all"))
    rest = own.groupBy(*by).agg((F.max("_all") - F.max("_sum")).alias("n"), F.max("_all").alias("_all")).filter("n > 0").select(*by, F.lit(missing).alias("name"), "n", "_all")
    return kept.select(*by, "name", "n", "_all").unionByName(rest).select(*by, "name", "n", (F.col("n") / F.col("_all")).alias("fraction"))


def ordered_counts(counts: DataFrame, name: str = "name", n: str = "n") -> DataFrame:
    """(place, name, n): counts by falling n, ties by name, numbered from 1; for tables of a few names."""
    order = Window.orderBy(F.desc(n), name)
    return counts.select(F.row_number().over(order).alias("place"), F.col(name).alias("name"), F.col(n).alias("n")).orderBy("place")


def transposed(table: DataFrame, key: str) -> DataFrame:
    """A small table's columns as rows, named `key`, and the values of its key as columns."""
    return table.transpose(F.col(key))


def relative_name(signature: Column, intact: list[str]) -> Column:
    """complete, missing_..., or only_..., with _extra_... for parts that the intact signature lacks."""
    every = F.array(*map(F.lit, sorted(set(intact))))
    seen = F.array_distinct(F.split(signature, ","))
    there, missing, extra = F.array_intersect(every, seen), F.array_except(every, seen), F.array_sort(F.array_except(seen, every))
    text = F.when(F.size(missing) <= F.size(there), F.concat(F.lit("missing_"), F.array_join(missing, ","))).otherwise(F.concat(F.lit("only_"), F.array_join(there, ",")))
    return F.when(signature == ",".join(intact), F.lit("complete")).otherwise(F.concat(text, F.when(F.size(extra) > 0, F.concat(F.lit("_extra_"), F.array_join(extra, ","))).otherwise(F.lit(""))))


def regrouped(counts: DataFrame, pattern: str, name: str = "name", n: str = "n") -> DataFrame:
    """Counts of names that match a pattern and of the others."""
    return counts.groupBy(F.col(name).rlike(pattern).alias("matches")).agg(F.sum(n).alias("n"))


def kmer_positions(df: DataFrame, seq: str, k: int, letters: str = "ACGTN") -> DataFrame:
    """(position, kmer, n) over all sequences; zeros of the full domain come from `zero_filled`."""
    from tesserae.functions.sequence import PIECE, overlapping_pieces

    pieces = df.select(F.posexplode(overlapping_pieces(F.col(seq), k)).alias("j", "piece")).filter(F.length("piece") >= k)
    at = pieces.select("j", "piece", F.explode(F.sequence(F.lit(0), F.least(F.length("piece") - k, F.lit(PIECE - 1)))).alias("i"))
    rows = at.select((F.col("j") * PIECE + F.col("i")).alias("position"), F.substr("piece", F.col("i") + 1, F.lit(k)).alias("kmer"))
    return rows.groupBy("position", "kmer").agg(F.count("*").alias("n"))


def zero_filled(counts: DataFrame, position: str, name: str, domain: list[str]) -> DataFrame:
    """Every name of a fixed domain at every position seen, zeros included."""
    every = counts.select(position).distinct().withColumn(name, F.explode(F.array(*map(F.lit, domain))))
    return every.join(counts, [position, name], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def merged_mapping_logs(logs: DataFrame, sums: list[str], mean: str) -> DataFrame:
    return logs.agg(*[F.sum(c).alias(c) for c in sums], F.avg(mean).alias(mean))


def mapping_table(stats: DataFrame, total: str, parts: list[str]) -> DataFrame:
    """Counts as text with their percent of the total: '123 (45.6%)'."""
    from tesserae.functions.sequence import one_place, safe_divide

    pct = lambda c: F.concat(F.col(c).cast("long").cast("string"), F.lit(" ("), one_place(safe_divide(F.col(c) * 100.0, F.col(total))), F.lit("%)"))
    return stats.select(*[c for c in stats.columns if c not in parts], *[pct(c).alias(c) for c in parts])


def overview(stats: DataFrame, sample: str, name: str, n: str, names: list[str], total: str) -> DataFrame:
    """One row per sample: percent of the total for every name, 0 where it is missing."""
    wide = stats.groupBy(sample).pivot(name, [*names, total]).agg(F.first(n)).na.fill(0)
    return wide.select(sample, F.col(total).alias(total), *[F.coalesce(F.try_divide(F.col(x) * 100.0, F.col(total)), F.lit(0.0)).alias(x) for x in names])


def reads_order(logs: DataFrame, sample: str = "sample", reads: str = "reads") -> DataFrame:
    """Mapping logs by falling reads, then sample."""
    return logs.orderBy(F.desc(reads), sample)


def normalised_histogram(counts: DataFrame, by: list[str], n: str = "n") -> DataFrame:
    """counts with `fraction`: n over the sum of its group."""
    return counts.withColumn("fraction", F.col(n) / F.sum(n).over(Window.partitionBy(*by)))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int = 20) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= n)


def mismatch_bound(barcodes: DataFrame, code: str = "barcode", most: int = 3, alone: int = 4) -> int:
    """Mismatches that demultiplexing can allow: least over pairs of ceil(distance / 2) - 1, at most `most`; `alone` for one.

    Barcodes within 2 * most of each other agree in one of 2 * most + 1 pieces, so only those that share a piece meet;
    where none do, `most` is allowed. Repeated barcodes are at distance 0. A code is compared up to the shorter length.
    """
    from tesserae.functions.sequence import hamming

    own = barcodes.select(F.col(code).alias("a")).groupBy("a").agg(F.count("*").alias("n"))
    n, several, short = own.agg(F.sum("n"), F.max("n"), F.min(F.length("a"))).first()
    if (n or 0) < 2:
        return alone
    if several > 1:
        return -1
    parts = 2 * most + 1
    cuts = [short * i // parts for i in range(parts + 1)]
    pieces = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.substring("a", cuts[i] + 1, cuts[i + 1] - cuts[i]).alias("p")) for i in range(parts)]))
    dealt = own.select("a", pieces.alias("x")).select("a", "x.i", "x.p")
    least = dealt.join(dealt.withColumnRenamed("a", "b"), ["i", "p"]).filter("a < b").agg(F.min(hamming(F.col("a"), F.col("b")))).first()[0]
    return most if least is None else min(most, math.ceil(least / 2) - 1)


def attribute_by_sample(stats: DataFrame, samples: DataFrame, sample: str, kind: str, name: str, value: str = "value") -> DataFrame:
    """(sample, value) of one kind and name for every listed sample, null where it has none."""
    own = stats.filter((F.col("kind") == kind) & (F.col("name") == name)).select(sample, value)
    return samples.select(sample).join(own, sample, "left")
