"""Counting: molecules per cell and gene in long form, margins, tag histograms, whitelists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAIN = "count"
#: Gene functions that each flavour of count matrix takes (fixed values).
FLAVORS = {"exon": ("CODING", "UTR"), "intron": ("INTRONIC",), "all": ("CODING", "UTR", "INTRONIC")}


def molecule_counts(df: DataFrame, cell: str, gene: str, umi: str, channels: dict[str, Column] | None = None) -> DataFrame:
    """(cell, gene, channel, umis, reads): distinct molecules and rows; a row counts in every channel whose predicate holds.

    Cells and genes that any channel touches are rows of the matrix; in long form a missing row is a zero.
    """
    channels = channels or {MAIN: F.lit(True)}
    own = df.select(F.col(cell).alias("cell"), F.col(gene).alias("gene"), F.col(umi).alias("umi"), *[p.alias(f"c{i}") for i, p in enumerate(channels.values())])
    # rows of one molecule are merged first, all channels at once: the second exchange then moves molecules, not reads
    molecules = own.groupBy("cell", "gene", "umi").agg(*[F.count_if(f"c{i}").alias(f"c{i}") for i in range(len(channels))])
    per = molecules.groupBy("cell", "gene").agg(*[x for i in range(len(channels)) for x in (F.count(F.when(F.col(f"c{i}") > 0, F.col("umi"))).alias(f"u{i}"), F.sum(f"c{i}").alias(f"r{i}"))])
    if len(channels) == 1:
        return per.select("cell", "gene", F.lit(next(iter(channels))).alias("channel"), F.col("u0").alias("umis"), F.col("r0").alias("reads")).filter("reads > 0")
    rows = F.array(*[F.struct(F.lit(n).alias("channel"), F.col(f"u{i}").alias("umis"), F.col(f"r{i}").alias("reads")) for i, n in enumerate(channels)])
    return per.select("cell", "gene", F.inline(F.filter(rows, lambda r: r["reads"] > 0)))


def dge(df: DataFrame, flavor: str = "exon", reads: bool = False, multi_mappers: bool = False, cell: str = "CB", gene: str = "gn", umi: str = "MI", function: str = "gf", mapq: str = "mapq") -> DataFrame:
    """A count matrix of one flavour: rows by gene function, unique mappers only unless multi_mappers; molecules or reads."""
    rows = df.filter(F.col(function).isin(*FLAVORS[flavor]))
    if not multi_mappers:
        rows = rows.filter(F.col(mapq) >= 255)
    counts = molecule_counts(rows, cell, gene, umi)
    return counts.select("cell", "gene", F.col("reads" if reads else "umis").alias("n"))


def margins(df: DataFrame, cell: str, gene: str, umi: str) -> DataFrame:
    """Reads, molecules and distinct partners of every cell, every gene and every pair in one pass (GROUPING SETS).

    level is 'cell', 'gene' or 'both'. Molecules of a cell are distinct (gene, umi), of a gene distinct (cell, umi).
    """
    molecules = df.groupBy(F.col(cell).alias("cell"), F.col(gene).alias("gene"), F.col(umi).alias("umi")).agg(F.count("*").alias("reads"))
    both = molecules.groupBy("cell", "gene").agg(F.count("umi").alias("umis"), F.sum("reads").alias("reads"))
    c, g = F.col("cell"), F.col("gene")
    sets = both.groupingSets([[c], [g], [c, g]], c, g)
    level = F.when(F.grouping("gene") == 1, "cell").when(F.grouping("cell") == 1, "gene").otherwise("both")
    return sets.agg(level.alias("level"), F.sum("umis").alias("umis"), F.sum("reads").alias("reads"), F.count("*").alias("partners"))


def check_margins(margin: DataFrame) -> DataFrame:
    """Sums per level; all levels of a consistent matrix agree."""
    return margin.groupBy("level").agg(F.sum("umis").alias("umis"), F.sum("reads").alias("reads"))


def tag_histogram(df: DataFrame, tag: str, least: int = 1, flag: str | None = None) -> DataFrame:
    """(tag, n) of tags seen at least `least` times; secondary alignments don't count where a flag column is given."""
    rows = df if flag is None else df.filter(F.col(flag).bitwiseAND(F.lit(256)) == 0)
    return rows.filter(F.col(tag).isNotNull()).groupBy(F.col(tag).alias("tag")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent tags, ties by the larger tag; sorted by Spark's top-k, no full sort."""
    return counts.orderBy(F.desc("n"), F.desc("tag")).limit(n)


def whitelisted(df: DataFrame, key: str, whitelist: DataFrame, by: str) -> DataFrame:
    """Rows whose key is listed (left semi join)."""
    return df.join(whitelist.select(F.col(by).alias("_listed")).distinct(), F.col(key) == F.col("_listed"), "left_semi")


def cell_metrics(counts: DataFrame, mitochondrial: str = "^(mt|Mt|MT)-", reads: DataFrame | None = None) -> DataFrame:
    """Per cell: total_counts, n_genes_by_counts, total_counts_mt, pct_counts_mt, n_reads and reads_per_counts.

    counts: (cell, gene, umis, reads), one row for each cell and gene. n_reads comes from `reads` (cell, n_reads; cells without are dropped) or from counts.
    """
    mt = F.sum(F.when(F.col("gene").rlike(mitochondrial), F.col("umis")).otherwise(0))
    out = counts.groupBy("cell").agg(F.sum("umis").alias("total_counts"), F.count_if(F.col("umis") > 0).alias("n_genes_by_counts"), mt.alias("total_counts_mt"), F.sum("reads").alias("n_reads"))
    if reads is not None:
        out = out.drop("n_reads").join(reads.select("cell", "n_reads"), "cell")
    pct = F.coalesce(F.try_divide(F.col("total_counts_mt") * 100.0, F.col("total_counts")), F.lit(0.0))
    return out.withColumn("pct_counts_mt", pct).withColumn("reads_per_counts", F.coalesce(F.try_divide(F.col("n_reads").cast("double"), F.col("total_counts")), F.lit(0.0)))


def gene_metrics(counts: DataFrame) -> DataFrame:
    """Per gene: total_counts and n_cells_by_counts, from one row for each cell and gene."""
    return counts.groupBy("gene").agg(F.sum("umis").alias("total_counts"), F.count_if(F.col("umis") > 0).alias("n_cells_by_counts"))


def above_cutoff(metrics: DataFrame, cutoff: int, column: str = "total_counts") -> DataFrame:
    """Strictly more than the cutoff."""
    return metrics.filter(F.col(column) > cutoff)


def filtered_matrix(counts: DataFrame, least_genes: int = 1, least_cells: int = 3) -> DataFrame:
    """Cells with few genes go first, then genes in few of the cells that stay; counts have one row for each cell and gene.

    The matrix is counted once: what is counted per cell and per gene are windows over it, not joins with it.
    """
    some = counts.withColumn("_n", F.count("*").over(Window.partitionBy("cell"))).filter(F.col("_n") >= least_genes)
    return some.withColumn("_n", F.count("*").over(Window.partitionBy("gene"))).filter(F.col("_n") >= least_cells).drop("_n")


def sorted_axes(counts: DataFrame) -> DataFrame:
    """The matrix with its cells and genes in order, each numbered from 0: (cell, gene, i, j, ...), sorted."""
    cells, genes = (counts.select(c).distinct().withColumn(n, F.row_number().over(Window.orderBy(c)) - 1) for c, n in (("cell", "i"), ("gene", "j")))
    return counts.join(cells, "cell").join(genes, "gene").orderBy("i", "j")


def large_enough(counts: DataFrame, least_cells: int = 100, least_genes: int = 1001) -> bool:
    n = counts.agg(F.countDistinct("cell"), F.countDistinct("gene")).first()
    return n[0] >= least_cells and n[1] >= least_genes


def bulk_counts(df: DataFrame, gene: str, discard: Column) -> DataFrame:
    """Rows per gene: counted, and per reason of discarding (null: kept)."""
    return df.groupBy(F.col(gene).alias("gene")).agg(F.count(F.when(discard.isNull(), 1)).alias("counted"), F.count(discard).alias("discarded"))


def domain_counts(df: DataFrame, columns: dict[str, list[str]], other: str = "OTHER") -> DataFrame:
    """Counts of (measure, value) over fixed domains, zeros included; values outside a domain count as `other`."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.when(F.col(m).isin(*v), F.col(m)).otherwise(other).alias("value")) for m, v in columns.items()]))
    seen = df.select(pairs.alias("p")).groupBy("p.measure", "p.value").agg(F.count("*").alias("n"))  # no more rows than the domains have
    every = df.sparkSession.createDataFrame([(m, x) for m, v in columns.items() for x in [*v, other]], "measure string, value string")
    return every.join(F.broadcast(seen), ["measure", "value"], "left").select("measure", "value", F.coalesce("n", F.lit(0)).alias("n"))
