"""Files of every format, written from the tables into the shared folder and read back by the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import counts
from tesserae.plans.common import molecules, table
from tesserae.plans.reads import BASES_SQL, bases
from tesserae.registry import query
from tesserae.sources import bam, headers, sequences, tables
from tesserae.sources.shared import new_path


def text(df: DataFrame, value: Column | str, name: str, *order: str, first: list[str] = (), compression: str | None = None) -> str:
    """A folder of text files with a value a line (which may hold several); with order or first lines: one file."""
    spark = df.sparkSession
    own = df.select(value.alias("value") if isinstance(value, Column) else F.col(value).alias("value"), *order)
    if order or first:
        own = own.withColumn("_n", F.lit(len(first)))
        head = spark.createDataFrame([(x, i) for i, x in enumerate(first)], "value string, _n int")
        own = own.unionByName(head, allowMissingColumns=True).repartition(1).sortWithinPartitions("_n", *order)
    path = new_path(spark, name)
    own.select("value").write.text(path, compression=compression)
    return path


# ---- reads ----

READS_SQL = f"SELECT doc_id, coalesce(seq, '') AS seq FROM ({BASES_SQL})"


def read_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bases(spark, sf_dir).select("doc_id", F.coalesce("seq", F.lit("")).alias("seq"))


def fastq_of(name: Column, seq: Column, letter: str = "I") -> Column:
    return F.concat_ws("\n", F.concat(F.lit("@"), name), seq, F.lit("+"), F.repeat(F.lit(letter), F.length(seq)))


@query(f"SELECT 'd' || doc_id || ' x:1' AS name, seq, length(seq) AS n_qual FROM ({READS_SQL})")
def fastq_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's letters as a FASTQ record, in gzip files."""
    d = read_rows(spark, sf_dir)
    path = text(d, fastq_of(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(" x:1")), F.col("seq")), "fastq", compression="gzip")
    return sequences.read_fastq(spark, path).select("name", "seq", F.length("qual").cast("long").alias("n_qual"))


@query(f"SELECT 'd' || doc_id AS qname, substr(seq, 1, 28) AS r1, seq AS r2 FROM ({READS_SQL})")
def paired_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_rows(spark, sf_dir).withColumn("n", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    r1 = text(d, fastq_of(F.concat("n", F.lit(" 1")), F.substring("seq", 1, 28)), "r1", "doc_id")
    r2 = text(d, fastq_of(F.concat("n", F.lit(" 2")), F.col("seq")), "r2", "doc_id")
    return sequences.read_reads(spark, [r2], [r1]).select("qname", "r1", "r2")


@query(f"SELECT 'd' || doc_id AS qname, 'NA' AS r1, '##' AS q1, seq AS r2 FROM ({READS_SQL})")
def single_end_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_rows(spark, sf_dir)
    path = text(d, fastq_of(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.col("seq")), "single")
    return sequences.read_reads(spark, [path]).select("qname", "r1", "q1", "r2")


@query("""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE '1' END AS cell, 'c' || c_custkey AS qname, CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, '#', 'N') ELSE 'NA' END AS r1, c_mktsegment AS r2 FROM customer
""")
def sample_matrix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("n", F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    even, odd = c.filter("c_custkey % 2 = 0"), c.filter("c_custkey % 2 = 1")
    r1 = text(even, fastq_of(F.col("n"), F.replace("c_name", F.lit("#"), F.lit("N"))), "m1", "c_custkey")
    r2 = [text(d, fastq_of(F.col("n"), F.col("c_mktsegment")), "m2", "c_custkey") for d in (even, odd)]
    sheet = text(spark.createDataFrame([(f"{r2[0]},{r1},even", 0), (f"{r2[1]},,", 1)], "value string, i int"), "value", "sheet", "i", first=["R2,R1,cell"])
    return sequences.read_sample_matrix(spark, sheet).select("cell", "qname", "r1", "r2")


@query(f"SELECT 'd' || doc_id || ' of ' || source AS name, seq FROM ({READS_SQL}) JOIN documents USING (doc_id)")
def fasta_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's letters as a FASTA record, 60 letters a line."""
    d = read_rows(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    head = F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit(" of "), F.col("source"))
    path = text(d, F.concat_ws("\n", head, F.regexp_replace("seq", "(.{60})", "$1\n")), "fasta", "doc_id", first=["# a comment"])
    return sequences.read_fasta(spark, path).select("name", "seq")


@query(f"SELECT doc_id::VARCHAR AS name, upper(lang) AS seq FROM documents UNION ALL SELECT 'd' || doc_id, seq FROM ({READS_SQL}) UNION ALL SELECT 'd' || doc_id, source FROM documents")
def triples_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call for text tables, a tag of SAM lines, and FASTQ, by the path's extension."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.upper("lang").alias("lang"), "source")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    csv = new_path(spark, "column") + ".csv"
    docs.orderBy("doc_id").select(F.concat_ws(";", F.col("doc_id").cast("string"), "lang").alias("value")).write.text(csv)
    sam = new_path(spark, "tagged") + ".sam"
    docs.select(F.concat_ws("\t", name, *map(F.lit, ("4", "*", "0", "0", "*", "*", "0", "0", "A", "I")), F.concat(F.lit("CB:Z:"), "source")).alias("value")).write.text(sam)
    fastq = text(read_rows(spark, sf_dir), fastq_of(name, F.col("seq")), "reads")
    by_column = sequences.read_triples(spark, csv, separator=";", column=1).select(F.col("seq"))
    ids = sequences.read_column(spark, csv, 0, separator=";", file_too=True).withColumnRenamed("seq", "id")
    numbered = sequences.read_column(spark, csv, 1, separator=";", file_too=True).join(ids, ["file", "name"]).select(F.col("id").alias("name"), "seq")
    assert by_column.columns == ["seq"]
    return numbered.unionByName(sequences.read_triples(spark, fastq)).unionByName(sequences.read_triples(spark, sam, tag="CB"))


@query(f"SELECT 'd' || doc_id AS name, seq FROM ({READS_SQL}) UNION ALL SELECT 'c' || c_custkey, repeat('ACGTN', (c_custkey % 40 + 1)::INTEGER) FROM customer")
def any_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FASTQ and BAM files through one entry."""
    fastq = text(read_rows(spark, sf_dir), fastq_of(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.col("seq")), "any")
    own = table(spark, sf_dir, "customer").withColumn("n", (F.col("c_custkey") % 40 + 1).cast("int"))
    rec = own.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("qname"), F.lit(4).alias("flag"), F.lit("*").alias("rname"), F.lit(0).alias("pos"), F.lit(0).alias("mapq"), F.lit("*").alias("cigar"), F.repeat(F.lit("ACGTN"), F.col("n")).alias("seq"), F.repeat(F.lit("IIII!"), F.col("n")).alias("qual"), F.lit(None).cast("map<string,string>").alias("tags"))
    path = new_path(spark, "unaligned") + ".bam"
    bam.write_bam(rec, path)
    return sequences.read_any(spark, [fastq, path]).select("name", "seq")


# ---- alignments ----

CIGAR_SQL = "l_linenumber || 'S' || l_quantity::INTEGER || 'M' || (l_linenumber * 100) || 'N' || (l_quantity::INTEGER + 1) || 'M'"


def alignment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as alignments: the order is the read, the part's brand the reference."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    q, k = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    s = lambda c: c.cast("string")
    cigar = F.concat(s(k), F.lit("S"), s(q), F.lit("M"), s(k * 100), F.lit("N"), s(q + 1), F.lit("M"))
    flag = F.when(F.col("l_returnflag") == "R", 4).when(F.col("l_linestatus") == "O", 16).otherwise(0)
    seq = F.repeat(F.lit("ACGT"), 40)
    return line.select(
        F.concat(F.lit("o"), s(F.col("l_orderkey"))).alias("qname"), flag.alias("flag"), F.when(flag == 4, "*").otherwise(F.col("p_brand")).alias("rname"), F.when(flag == 4, 0).otherwise(F.col("l_partkey").cast("int") + 1).alias("pos"),
        F.when(F.col("l_tax") < 0.05, 255).otherwise(3).alias("mapq"), F.when(flag == 4, "*").otherwise(cigar).alias("cigar"), F.substr(seq, F.lit(1), k + q + q + 1).alias("seq"), F.repeat(F.lit("F"), k + q + q + 1).alias("qual"),
        F.create_map(F.lit("CB"), s(F.col("l_suppkey")), F.lit("MI"), F.concat(F.lit("u"), s(F.col("l_linenumber"))), F.lit("NH"), s(F.lit(1))).alias("tags"), "l_orderkey", "l_linenumber",
    )


ALIGNED_SQL = f"""SELECT 'o' || l_orderkey AS qname, f AS flag, CASE WHEN f = 4 THEN '*' ELSE p_brand END AS rname, CASE WHEN f = 4 THEN 0 ELSE l_partkey + 1 END AS pos, CASE WHEN l_tax < 0.05 THEN 255 ELSE 3 END AS mapq,
  CASE WHEN f = 4 THEN '*' ELSE {CIGAR_SQL} END AS cigar, substr(repeat('ACGT', 40), 1, l_linenumber + 2 * l_quantity::INTEGER + 1) AS seq, l_suppkey::VARCHAR AS cb, 'u' || l_linenumber AS mi, l_orderkey, l_linenumber
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 4 WHEN l_linestatus = 'O' THEN 16 ELSE 0 END AS f FROM lineitem) JOIN part ON l_partkey = p_partkey"""


@query(f"SELECT qname, flag, rname, pos, mapq, cigar, seq, cb, mi, 1 AS nh FROM ({ALIGNED_SQL})")
def sam_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alignment_rows(spark, sf_dir)
    fields = [F.col(c).cast("string") for c in ("qname", "flag", "rname", "pos", "mapq", "cigar")] + [F.lit("*"), F.lit("0"), F.lit("0"), F.col("seq"), F.col("qual")]
    tags = [F.concat(F.lit("CB:Z:"), F.col("tags")["CB"]), F.concat(F.lit("MI:Z:"), F.col("tags")["MI"]), F.lit("NH:i:1")]
    path = text(a, F.concat_ws("\t", *fields, *tags), "sam")
    return sequences.read_sam(spark, path).select("qname", "flag", "rname", "pos", "mapq", "cigar", "seq", F.col("CB").alias("cb"), F.col("MI").alias("mi"), F.col("NH").alias("nh"))


@query(f"SELECT qname, flag, rname, pos, mapq, cigar, seq, length(seq)::INTEGER AS n_qual, cb, mi, '1' AS nh FROM ({ALIGNED_SQL})")
def bam_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as a BAM file and read back."""
    a = alignment_rows(spark, sf_dir)
    refs = {r[0]: 1_000_000 for r in a.filter("rname <> '*'").select("rname").distinct().orderBy("rname").collect()}  # brands
    path = new_path(spark, "aligned") + ".bam"
    bam.write_bam(a, path, refs)
    t = F.col("tags")
    return bam.read_bam(spark, path).select("qname", "flag", "rname", "pos", "mapq", "cigar", "seq", F.length("qual").alias("n_qual"), t["CB"].alias("cb"), t["MI"].alias("mi"), t["NH"].alias("nh"))


@query("SELECT 'SQ' AS kind, n_name AS name, (n_nationkey * 1000)::VARCHAR AS length FROM nation UNION ALL SELECT 'CO', NULL, NULL UNION ALL SELECT 'HD', NULL, NULL")
def sam_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    path = text(n, F.concat(F.lit("@SQ\tSN:"), "n_name", F.lit("\tLN:"), (F.col("n_nationkey") * 1000).cast("string")), "header", "n_nationkey", first=["@HD\tVN:1.6\tSO:unsorted", "@CO\tfree\ttext"])
    return sequences.read_sam_header(spark, path).select("kind", F.col("fields")["SN"].alias("name"), F.col("fields")["LN"].alias("length"))


@query("""
SELECT 'q' || c_custkey || chr(9) || '4' || chr(9) || '*' || chr(9) || '0' || chr(9) || '0' || chr(9) || '*' || chr(9) || '*' || chr(9) || '0' || chr(9) || '0' || chr(9) || c_mktsegment || chr(9) || repeat('I', length(c_mktsegment)) || chr(9) || 'CB:Z:' || c_name
  || CASE WHEN c_custkey % 3 = 0 THEN chr(9) || 'A3:Z:Q,polyA' || chr(9) || 'T3:Z:2,' || c_custkey ELSE '' END || chr(9) || 'RG:Z:g' AS value FROM customer
""")
def sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    some = F.col("c_custkey") % 3 == 0
    rows = c.select(
        F.concat(F.lit("q"), F.col("c_custkey").cast("string")).alias("qname"), F.col("c_mktsegment").alias("r2"), F.repeat(F.lit("I"), F.length("c_mktsegment")).alias("q2"), F.col("c_name").alias("CB"),
        F.when(some, F.array(F.lit("Q"), F.lit("polyA"))).otherwise(F.array().cast("array<string>")).alias("a3"), F.when(some, F.array(F.lit(2), F.col("c_custkey").cast("int"))).otherwise(F.array().cast("array<int>")).alias("t3"),
    )
    return sequences.render_sam(rows, group="g")


@query("""
WITH a AS (SELECT n_nationkey AS i, 'tool' || (n_nationkey % 4) AS id FROM nation), r AS (SELECT i, id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS again FROM a), n AS (SELECT i, id || CASE WHEN again > 0 THEN '.' || again ELSE '' END AS id FROM r)
SELECT i::BIGINT AS i, id, lag(id) OVER (ORDER BY i) AS previous FROM n
""")
def repaired_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of programs with repeated names, none of which says what it follows."""
    n = sorted(r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect())
    chain = headers.repaired([{"ID": f"tool{k % 4}"} for k in n])[1]
    return spark.createDataFrame([(i, p["ID"], p.get("PP")) for i, p in enumerate(chain)], "i long, id string, previous string")


# ---- annotation, barcodes, matrices, logs ----


@query("""
SELECT DISTINCT o_orderpriority AS chrom, CASE WHEN o_orderkey % 3 = 0 THEN 'exon' WHEN o_orderkey % 3 = 1 THEN 'CDS' ELSE 'UTR' END AS feature, (o_orderkey % 1000)::INTEGER AS "start", (o_orderkey % 1000 + o_custkey)::INTEGER AS "end",
  CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand, 'g' || o_custkey AS gene_id, 't' AS gene_type, 'n ' || o_custkey AS gene_name FROM orders
""".replace("'n ' ||", "'n' ||"))
def gtf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    feature = F.when(k % 3 == 0, "exon").when(k % 3 == 1, "CDS").otherwise("UTR")
    more = F.concat(F.lit('gene_id "g'), c, F.lit('"; gene_type "t"; level 2; gene_name "n'), c, F.lit('";'))
    start = k % 1000
    line = F.concat_ws("\t", "o_orderpriority", F.lit("src"), feature, (start + 1).cast("string"), (start + F.col("o_custkey")).cast("string"), F.lit("."), F.when(F.col("o_orderstatus") == "F", "-").otherwise("+"), F.lit("."), more)
    other = F.concat_ws("\t", "o_orderpriority", F.lit("src"), F.lit("transcript"), F.lit("1"), F.lit("2"), F.lit("."), F.lit("+"), F.lit("."), more)
    path = text(o, F.concat_ws("\n", line, other), "gtf", "o_orderkey", first=["#!version 1", "a line of too\tfew fields"])
    return tables.read_gtf(spark, path)


@query("""
WITH m AS (SELECT user_id AS cell, event_type AS gene, count(*) AS n FROM events GROUP BY ALL)
SELECT cell::VARCHAR AS cell, gene, n::INTEGER AS umis FROM m UNION ALL SELECT NULL, 'mt-missing', 0
""")
def dge_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense text matrix, a cell a column."""
    m = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("gene"), F.col("user_id").alias("cell")).agg(F.count("*").alias("n"))
    lines = tables.dense_lines(m, "gene", "cell", "n")
    path = new_path(spark, "dge")
    lines.repartition(1).sortWithinPartitions("head", "gene").select("value").write.text(path)
    return tables.read_dge_text(spark, path)


@query("SELECT user_id::VARCHAR AS cell, event_type AS gene, count(*) AS umis FROM events GROUP BY ALL")
def external_matrix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("cell"), F.col("event_type").alias("gene")).agg(F.count("*").cast("double").alias("umis"))
    zeros = m.select("cell", F.lit("none").alias("gene"), F.lit(0.0).alias("umis"))
    path = new_path(spark, "external")
    m.unionByName(zeros).write.parquet(path)
    return tables.read_matrix(spark, path)


@query("SELECT 'B' || c_custkey AS cell_bc, (c_custkey % 100 * 1000)::BIGINT AS n_reads, (c_custkey % 100)::BIGINT AS n_umi, (c_custkey % 7)::BIGINT AS n_genes FROM customer")
def dge_summary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    path = text(c, F.concat_ws("\t", F.concat(F.lit("B"), k.cast("string")), (k % 100 * 1000).cast("string"), (k % 100).cast("string"), (k % 7).cast("string")), "summary", "c_custkey", first=["# preamble"] * 6 + ["CELL\tREADS\tUMI\tGENES"])
    return tables.read_dge_summary(spark, path)


@query("""
WITH b AS (SELECT c_custkey, 'B' || (c_custkey // 2) AS cell_bc, c_custkey * 1.5 AS x_pos, c_nationkey * 2.0 AS y_pos, c_mktsegment FROM customer),
  f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY cell_bc ORDER BY c_custkey) = 1)
SELECT cell_bc, x_pos, y_pos, 'L1a_tile_2104' AS puck_id FROM f UNION ALL SELECT cell_bc, x_pos, y_pos, c_mktsegment FROM f UNION ALL SELECT cell_bc, x_pos, y_pos, 'given' FROM f
""")
def barcode_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The puck's id from the file's name, from a column, and from the caller; the first of equal barcodes stays."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    rows = [F.concat(F.lit("B"), F.floor(k / 2).cast("string")), (k * 1.5).cast("string"), (F.col("c_nationkey") * 2.0).cast("string"), "c_mktsegment"]
    named = text(c, F.concat_ws("\t", *rows), "L1a_tile_2104", "c_custkey", first=["barcodes\txcoord\tycoord\tsegment"])
    comma = text(c, F.concat_ws(",", *rows), "tiles", "c_custkey", first=["cell_bc,x_pos,y_pos,segment"])
    by_name = tables.read_barcodes(spark, named, pattern=r"(L[1-4][ab]_tile_[0-9]+)")
    return by_name.unionByName(tables.read_barcodes(spark, comma, puck_column="segment")).unionByName(tables.read_barcodes(spark, comma, puck_id="given"))


@query("SELECT n_name AS puck_id, (n_nationkey * 10)::BIGINT AS x_offset, (n_regionkey * -5)::BIGINT AS y_offset, 0::BIGINT AS z_offset FROM nation")
def coordinate_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    line = lambda x: F.concat_ws(",", "n_name", (F.col("n_nationkey") * x).cast("string"), (F.col("n_regionkey") * -5).cast("string"))
    path = text(n, F.concat_ws("\n", line(10), line(99)), "system", "n_nationkey", first=["puck_id,x_offset,y_offset"])
    return tables.read_coordinate_system(spark, path)


@query("SELECT 'p' || c_nationkey AS project_id, 's' || c_custkey AS sample_id, c_mktsegment AS demux_index, replace(lower(c_mktsegment), '_', '') AS species, 'me' AS investigator, '2024-01-02' AS sequencing_date FROM customer")
def sample_sheet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    s = lambda n: F.col(n).cast("string")
    line = F.concat_ws(",", F.concat(F.lit("s"), s("c_custkey")), "c_mktsegment", F.concat(F.lit("p"), s("c_nationkey")), F.concat(F.lit("tissue_x_"), F.lower("c_mktsegment")))
    path = text(c, line, "sheet", "c_custkey", first=["[Header]", "Investigator,me", "Date,2024-01-02", "[Data],,", "Sample_ID,index,Sample_Project,Description"])
    return tables.read_sample_sheet(spark, path)


@query("""
SELECT 'input_reads' AS metric, round_even(sum(l_orderkey) / 1e6, 2) AS value FROM lineitem UNION ALL SELECT 'uniq_mapped_reads', round_even(sum(l_partkey) / 1e6, 2) FROM lineitem
UNION ALL SELECT 'avg_mapped_length', round(avg(l_quantity), 4) FROM lineitem UNION ALL SELECT 'chimeric', NULL
""")
def star_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "lineitem").agg(F.sum("l_orderkey").alias("a"), F.sum("l_partkey").alias("b"), F.round(F.avg("l_quantity"), 4).alias("c"))
    s = lambda n: F.col(n).cast("string")
    rows = [F.concat(F.lit("              Number of input reads |\t"), s("a")), F.lit("        UNIQUE READS:"), F.concat(F.lit("   Uniquely mapped reads number |\t"), s("b")), F.lit("   Uniquely mapped reads % |\t81.2%"), F.concat(F.lit("  Average mapped length |\t"), s("c")), F.lit("  Number of chimeric reads |\tNA")]
    return tables.read_star_log(spark, text(one, F.concat_ws("\n", *rows), "star"))


@query("""
WITH p AS (SELECT count(*) AS n, count(*) FILTER (p_size < 10) AS a, count(*) FILTER (p_size BETWEEN 10 AND 20) AS b, count(*) FILTER (p_size > 20) AS c FROM part)
SELECT (2 * n)::BIGINT AS reads, (2 * a)::BIGINT AS unaligned, (2 * b)::BIGINT AS once, (2 * c)::BIGINT AS several, round((b + c) * 100.0 / n, 6) AS rate FROM p
""")
def bowtie_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two blocks of one log add up."""
    size = F.col("p_size")
    one = table(spark, sf_dir, "part").agg(F.count("*").alias("n"), F.count_if(size < 10).alias("a"), F.count_if(size.between(10, 20)).alias("b"), F.count_if(size > 20).alias("c"))
    s = lambda n: F.col(n).cast("string")
    block = F.concat_ws("\n", F.concat(s("n"), F.lit(" reads; of these:")), F.concat(F.lit("    "), s("a"), F.lit(" (1.00%) aligned 0 times")), F.concat(F.lit("    "), s("b"), F.lit(" (1.00%) aligned exactly 1 time")), F.concat(F.lit("    "), s("c"), F.lit(" (1.00%) aligned >1 times")), F.lit("9.00% overall alignment rate"))
    return tables.read_bowtie_log(spark, text(one, F.concat_ws("\n", block, block), "bowtie")).withColumn("rate", F.round("rate", 6))


@query("SELECT event_type AS name, count(*) * 1000 AS n, round_even(count(*) / 1e3, 2) AS millions FROM events GROUP BY 1")
def split_count_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("event_type").agg((F.count("*") * 1000).alias("n"))
    return tables.read_split_counts(spark, text(n, F.concat_ws("\t", "event_type", F.col("n").cast("string")), "splits"))


@query("SELECT 10 AS pct, user_id::INTEGER AS cell, count(*)::INTEGER AS n FROM events WHERE event_id % 10 = 0 GROUP BY ALL UNION ALL SELECT 100, user_id, count(*) FROM events GROUP BY ALL")
def downsampled_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of cells from a tenth and from all of the records."""
    e, paths = table(spark, sf_dir, "events"), {}
    for pct, rows in ((10, e.filter("event_id % 10 = 0")), (100, e)):
        paths[pct] = new_path(spark, "cells")
        rows.groupBy(F.col("user_id").alias("cell")).agg(F.count("*").alias("n")).write.csv(paths[pct], header=True)
    return tables.read_downsampled(spark, paths).select("pct", "cell", "n")


@query("SELECT event_type AS name, count(*)::INTEGER AS value FROM events GROUP BY 1")
def stats_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("value"))
    path = new_path(spark, "stats")
    tables.write_stats(n, path)
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True)


@query("WITH m AS (SELECT user_id AS cell, event_type AS gene, count(*) AS reads FROM events GROUP BY ALL) SELECT cell, count(*) AS n_genes, sum(reads)::BIGINT AS n_reads FROM m GROUP BY 1")
def matrix_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """counts, obs (its numbers alone) and var of a matrix, written and met again."""
    c = counts.molecule_counts(molecules(spark, sf_dir), "cell", "gene", "umi")
    obs = c.groupBy("cell").agg(F.sum("reads").alias("n_reads"), F.max("gene").alias("word"), F.max(F.struct("gene")).alias("other"))
    path = new_path(spark, "matrix")
    tables.write_matrix(path, c, tables.numeric_columns(obs, ("cell",)), counts.gene_metrics(c))
    got = spark.read.parquet(f"{path}/counts").groupBy("cell").agg(F.count("*").alias("n_genes"))
    return got.join(spark.read.parquet(f"{path}/obs"), "cell").select("cell", "n_genes", "n_reads")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def compiled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made on the first call, read on the second."""
    path = new_path(spark, "compiled")
    n = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    tables.compiled_or_make(spark, path, lambda: n)
    return tables.compiled_or_make(spark, path, lambda: n.limit(0))


@query("SELECT c_custkey, length(c_name)::INTEGER AS n, true AS known FROM customer")
def random_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Theoretical barcodes: as long as the names, of the four letters."""
    from tesserae.functions.sequence import random_barcode

    c = table(spark, sf_dir, "customer").withColumn("b", F.substr(random_barcode(18, F.col("c_custkey"), seed=7), F.lit(1), F.length("c_name")))
    return c.select("c_custkey", F.length("b").alias("n"), F.col("b").rlike("^[ACGT]+$").alias("known"))


@query("""
WITH n AS (SELECT doc_id, regexp_replace('lima.pb_' || source || '_' || lang || '_x.fq.bam', 'sts_|pb_|ds_|\\.fq|\\.bam|lima\\.', '', 'g') AS b FROM documents)
SELECT doc_id, CASE WHEN length(b) - length(replace(b, '_', '')) > 1 THEN array_to_string(string_split(b, '_')[1:2], '_') ELSE b END AS name FROM n
""")
def sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tesserae.functions.sequence import sample_name

    path = F.concat(F.lit("a/b/lima.pb_"), "source", F.lit("_"), "lang", F.lit("_x.fq.bam"))
    return table(spark, sf_dir, "documents").select("doc_id", sample_name(path).alias("name"))
