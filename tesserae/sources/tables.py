"""Annotation, barcode, matrix and log files, and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators.tiles import keep_first
from tesserae.sources.lines import numbered_lines

PUCK_NAME = r"(L[1-4][a-b]_tile_[1-2][0-9]{2,3})"


def gtf_attribute(attributes: Column, name: str) -> Column:
    v = F.regexp_extract(attributes, rf'(?:^|[;\s]){name} "([^"\s]*)"', 1)
    return F.when(v != "", v)


def read_gtf(spark: SparkSession, paths: str | list[str], features: tuple[str, ...] = ("exon", "CDS", "UTR"), attributes: tuple[str, ...] = ("gene_id", "gene_type", "gene_name"), strict: bool = True) -> DataFrame:
    """Distinct (chrom, feature, start, end, strand, attributes), start from 0, end exclusive. Lines of other than nine
    fields are left out; a missing attribute is an error if strict, else null."""
    f = F.split("value", "\t")
    rows = spark.read.text(paths).filter(~F.col("value").startswith("#")).filter(F.size(f) == 9)
    at = lambda i: F.get(f, F.lit(i))
    rows = rows.filter(at(2).isin(*features))
    get = [gtf_attribute(at(8), a) for a in attributes]
    if strict:
        get = [F.coalesce(g, F.raise_error(F.concat(F.lit(f"no {a} in: "), at(8)))) for g, a in zip(get, attributes, strict=True)]
    return rows.select(at(0).alias("chrom"), at(2).alias("feature"), (at(3).cast("int") - 1).alias("start"), at(4).cast("int").alias("end"), at(6).alias("strand"), *[g.alias(a) for g, a in zip(get, attributes, strict=True)]).distinct()


# Header names of barcode files and what they are called here.
ALIASES = {"xcoord": "x_pos", "ycoord": "y_pos", "barcodes": "cell_bc", "barcode": "cell_bc"}


def read_barcodes(spark: SparkSession, path: str, puck_id: str | None = None, puck_column: str | None = None, pattern: str = PUCK_NAME) -> DataFrame:
    """(cell_bc, x_pos, y_pos, puck_id) of a table separated by comma, bar or tab; the first of equal barcodes stays.

    The puck's id is given, a column of the table, or the first group of `pattern` in the file's name (else its stem).
    """
    lines = numbered_lines(spark, path)
    head = lines.filter("line_no = 0").first()["value"]
    sep = max(",|\t", key=head.count)
    names = [ALIASES.get(h.strip().strip('"'), h.strip().strip('"')) for h in head.split(sep)]
    f = F.split("value", f"\\Q{sep}\\E")
    get = lambda n: F.get(f, F.lit(names.index(n)))
    if puck_id or puck_column:
        puck = F.lit(puck_id) if puck_id else get(ALIASES.get(puck_column, puck_column))
    else:
        puck = F.coalesce(F.nullif(F.regexp_extract("file", pattern, 1), F.lit("")), F.regexp_extract("file", r"([^/]+?)(?:\.[^/]*)?$", 1))
    rows = lines.filter("line_no > 0 AND value <> ''").select("line_no", get("cell_bc").alias("cell_bc"), get("x_pos").cast("double").alias("x_pos"), get("y_pos").cast("double").alias("y_pos"), puck.alias("puck_id"))
    return keep_first(rows, ["cell_bc"], ["line_no"]).drop("line_no")


def read_coordinate_system(spark: SparkSession, path: str) -> DataFrame:
    lines = numbered_lines(spark, path)
    head = [h.strip() for h in lines.filter("line_no = 0").first()["value"].split(",")]
    f = F.split("value", ",")
    get = lambda n: F.get(f, F.lit(head.index(n))) if n in head else F.lit("0")
    rows = lines.filter("line_no > 0 AND value <> ''").select("line_no", get("puck_id").alias("puck_id"), *[get(c).cast("long").alias(c) for c in ("x_offset", "y_offset", "z_offset")])
    return keep_first(rows, ["puck_id"], ["line_no"]).drop("line_no")


#: Parts into which the columns of a dense matrix are dealt when its zeros are filled in.
PARTS = 64


def dense_lines(counts: DataFrame, gene: str = "gene", cell: str = "cell", n: str = "n") -> DataFrame:
    """(head: 0 for the header and 1 for others, gene, value) of a dense text matrix, a gene a line and a cell a column, in the cells' order.

    counts: a row per gene and cell that isn't 0. Zeros are filled in as rows, by an equi-join of the genes with every part
    of the cells, so no plan has a column per cell; a null name is an empty one.
    """
    c = counts.select(F.col(gene).alias("gene"), F.col(cell).alias("cell"), F.col(n).cast("string").alias("v"), F.lit(True).alias("there"))
    cells = c.select("cell").distinct().withColumn("part", F.pmod(F.xxhash64("cell"), F.lit(PARTS)))
    genes = c.select("gene").distinct().withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    zeros = genes.join(cells, "part").select("gene", "cell", F.lit("0").alias("v"), F.lit(False).alias("there"))
    full = c.unionByName(zeros).groupBy("gene", "cell").agg(F.max_by("v", "there").alias("v")).withColumn("head", F.lit(1))
    names = cells.select(F.lit("GENE").alias("gene"), "cell", F.coalesce(F.col("cell").cast("string"), F.lit("")).alias("v"), F.lit(0).alias("head"))
    lists = full.unionByName(names).groupBy("head", "gene").agg(F.array_sort(F.collect_list(F.struct("cell", "v"))).alias("f"))
    return lists.select("head", "gene", F.concat_ws("\t", F.coalesce("gene", F.lit("")), F.array_join(F.col("f.v"), "\t")).alias("value"))


def read_dge_text(spark: SparkSession, path: str, missing_gene: str | None = "mt-missing") -> DataFrame:
    """(cell, gene, umis) of a dense text matrix, barcodes in the first line, a gene a line; non-zeros only. Empty names are null.

    If no gene name starts with mt-, a row of `missing_gene` without counts is noted under a null cell, so that
    mitochondrial shares are defined.
    """
    lines = numbered_lines(spark, path)
    cells = lines.filter("line_no = 0").select(F.posexplode(F.split("value", "\t")).alias("i", "cell")).filter("i > 0")
    rows = lines.filter("line_no > 0").select(F.split("value", "\t").alias("f"))
    long = rows.select(F.get("f", F.lit(0)).alias("gene"), F.posexplode("f").alias("i", "n")).filter("i > 0 AND n <> '0'")
    name = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    out = long.join(cells, "i").select(name("cell"), name("gene"), F.col("n").cast("int").alias("umis")).filter("umis <> 0")
    if missing_gene:
        none = rows.agg(F.bool_or(F.lower(F.get("f", F.lit(0))).startswith("mt-")).alias("has")).filter("NOT coalesce(has, false)")
        out = out.unionByName(none.select(F.lit(None).cast("string").alias("cell"), F.lit(missing_gene).alias("gene"), F.lit(0).alias("umis")))
    return out


def read_matrix(spark: SparkSession, path: str, fmt: str = "parquet", value: str = "umis") -> DataFrame:
    """A long matrix from outside; negative or fractional counts are an error, zeros are left out."""
    df = spark.read.format(fmt).options(**({"header": True, "inferSchema": True} if fmt == "csv" else {})).load(path)
    bad = (F.col(value) < 0) | (F.col(value) != F.floor(value))
    checked = F.when(bad, F.raise_error(F.lit("counts must be whole and not negative")).cast("long")).otherwise(F.col(value).cast("long"))
    return df.withColumn(value, checked).filter(F.col(value) != 0)


def read_dge_summary(spark: SparkSession, path: str, preamble: int = 7) -> DataFrame:
    """(cell_bc, n_reads, n_umi, n_genes) behind a preamble (its last line the header)."""
    f = F.split("value", "\t")
    names = ("cell_bc", "n_reads", "n_umi", "n_genes")
    return numbered_lines(spark, path).filter((F.col("line_no") >= preamble) & (F.col("value") != "")).select(*[F.get(f, F.lit(i)).cast("string" if i == 0 else "long").alias(n) for i, n in enumerate(names)])


#: Labels of the aligner's final log and what they are called here (fixed values).
STAR_LABELS = {
    "Number of input reads": "input_reads", "Uniquely mapped reads number": "uniq_mapped_reads", "Number of reads mapped to multiple loci": "multi_mapped_reads",
    "Number of reads mapped to too many loci": "too_many_mapped_reads", "Number of reads unmapped: too many mismatches": "unmapped_mismatches", "Number of reads unmapped: too short": "unmapped_too_short",
    "Number of reads unmapped: other": "unmapped_other", "Number of chimeric reads": "chimeric", "Average mapped length": "avg_mapped_length",
}


def read_star_log(spark: SparkSession, path: str) -> DataFrame:
    """(metric, value) of an aligner's final log: reads in millions to two places, the average length as it is, NA as null."""
    p = F.split("value", r"\|")
    name = F.create_map(*[F.lit(x) for kv in STAR_LABELS.items() for x in kv])[F.trim(F.get(p, F.lit(0)))]
    rows = spark.read.text(path).filter(F.size(p) == 2).select(name.alias("metric"), F.trim(F.get(p, F.lit(1))).try_cast("double").alias("v")).filter("metric IS NOT NULL")
    return rows.select("metric", F.when(F.col("metric") == "avg_mapped_length", F.col("v")).otherwise(F.bround(F.col("v") / 1e6, 2)).alias("value"))


def read_bowtie_log(spark: SparkSession, path: str) -> DataFrame:
    """One row: reads, unaligned, once, several, and the overall rate, of every block in the file added up."""
    v = F.col("value")
    num = lambda p: F.sum(F.when(v.rlike(p), F.regexp_extract(v, r"^\s*(\d+)", 1).cast("long")))
    one = spark.read.text(path).agg(num(r"^\d+ reads; of these").alias("reads"), num("aligned 0 times").alias("unaligned"), num("aligned exactly 1 time").alias("once"), num("aligned >1 times").alias("several"))
    return one.withColumn("rate", F.coalesce(F.try_divide((F.col("once") + F.col("several")) * 100.0, F.col("reads")), F.lit(0.0)))


def read_split_counts(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", r"\s+")
    n = F.get(f, F.lit(1)).cast("long")
    return spark.read.text(path).filter(F.size(f) >= 2).select(F.get(f, F.lit(0)).alias("name"), n.alias("n"), F.bround(n / 1e6, 2).alias("millions"))


def read_downsampled(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Cell tables of several sampling percents, tagged and united."""
    out = None
    for pct, p in sorted(paths.items()):
        own = spark.read.csv(p, header=True, inferSchema=True).withColumn("pct", F.lit(pct))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(project_id, sample_id, demux_index, species, investigator, sequencing_date) of an Illumina sheet's [Data] table;
    the species is the last _ part of the description."""
    lines = numbered_lines(spark, path)
    f = F.split("value", ",")
    at = lambda i: F.get(f, F.lit(i))
    cut = lines.filter(F.col("value").startswith("[Data]")).agg(F.min("line_no")).first()[0]
    if cut is None:
        raise ValueError(f"{path}: no [Data] table")
    head = lines.filter(F.col("line_no") == cut + 1).first()["value"].split(",")
    named = [F.max_by(F.when(at(0) == n, at(1)), F.when(at(0) == n, F.col("line_no"))) for n in ("Investigator", "Date")]
    who, when = lines.filter(F.col("line_no") < cut).agg(*named).first()
    get = lambda n: at(head.index(n)) if n in head else F.lit(None).cast("string")
    rows = lines.filter((F.col("line_no") > cut + 1) & (F.col("value") != ""))
    species = F.element_at(F.split(F.coalesce(get("Description"), F.lit("")), "_"), -1)
    return rows.select(get("Sample_Project").alias("project_id"), get("Sample_ID").alias("sample_id"), get("index").alias("demux_index"), species.alias("species"), F.lit(who).alias("investigator"), F.lit(when).alias("sequencing_date"))


def write_stats(df: DataFrame, path: str) -> None:
    """Statistics as one ordered tab-separated table."""
    df.orderBy("name", "value").coalesce(1).write.csv(path, sep="\t", header=True, mode="overwrite")


def write_matrix(path: str, counts: DataFrame | None = None, obs: DataFrame | None = None, var: DataFrame | None = None) -> None:
    """A matrix as Parquet tables counts, obs and var in one folder."""
    for name, df in (("counts", counts), ("obs", obs), ("var", var)):
        if df is not None:
            df.write.mode("overwrite").parquet(f"{path}/{name}")


def numeric_columns(df: DataFrame, keep: tuple[str, ...] = ("cell_bc",)) -> DataFrame:
    return df.select(*[c for c, t in df.dtypes if c in keep or t in ("int", "bigint", "smallint", "tinyint", "float", "double") or t.startswith("decimal")])


def compiled_or_make(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at path, written by make() first if it isn't there (checked through Spark's own file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
