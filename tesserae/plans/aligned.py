"""Alignment rules and statistics: line items as alignments of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import sequence as sq
from tesserae.operators import alignments as al
from tesserae.plans.common import table
from tesserae.plans.files import ALIGNED_SQL, alignment_rows
from tesserae.registry import query


@query(f"SELECT status, count(*) AS n, count(DISTINCT qname) AS reads FROM (SELECT qname, 'mapped' AS status FROM ({ALIGNED_SQL}) WHERE flag & 4 = 0 UNION ALL SELECT qname, 'unmapped' FROM ({ALIGNED_SQL}) WHERE flag & 4 <> 0 UNION ALL SELECT qname, 'unique' FROM ({ALIGNED_SQL}) WHERE mapq >= 255 UNION ALL SELECT qname, 'reverse' FROM ({ALIGNED_SQL}) WHERE flag & 16 <> 0) GROUP BY 1")
def mapping_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alignment_rows(spark, sf_dir).select("qname", "flag", "mapq")
    parts = {"mapped": al.mapped(a), "unmapped": al.unmapped(a), "unique": al.unique_mappers(a), "reverse": a.filter(al.has_flag(F.col("flag"), al.REVERSE))}
    out = None
    for name, rows in parts.items():
        own = rows.select("qname", F.lit(name).alias("status"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("qname").alias("reads"))


@query("""
WITH m AS (SELECT p_brand, min(p_type) AS target FROM part GROUP BY 1 HAVING min(p_size) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(target, p_brand) AS gene FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN m USING (p_brand)
""")
def reference_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    names = part.groupBy(F.col("p_brand").alias("original")).agg(F.min("p_type").alias("target"), F.min("p_size").alias("s")).filter("s = 1")
    rows = table(spark, sf_dir, "lineitem").join(part.select("p_partkey", F.col("p_brand").alias("rname")), F.col("l_partkey") == F.col("p_partkey"))
    return al.gene_by_reference(rows, names).select("l_orderkey", "l_linenumber", "l_partkey", "gene")


@query("SELECT p_partkey, contains(p_name, 'small') AS name_has_small, contains(p_name, 'ring') AS name_has_ring, NOT contains(p_name, 'small') AS name_missing_small, NOT contains(p_name, 'ring') AS name_missing_ring FROM part")
def name_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = al.name_flags(F.col("p_name"), ["small", "ring"])
    return table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in flags.items()])


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments with adapter lists: a TSO at the head of every third part, a tail where the discount is high."""
    q, k = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    s = lambda c: c.cast("string")
    cigar = F.concat(s(k), F.lit("S"), s(q), F.lit("M"), s(k * 2), F.lit("S"))
    none = F.array().cast("array<string>")
    a5 = F.when(F.col("l_partkey") % 3 == 0, F.array(F.lit("SMART_TSO"))).otherwise(none)
    a3 = F.when(F.col("l_discount") > 0.03, F.array(F.lit("Q"), F.lit("polyA"))).otherwise(none)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", k.alias("k"), cigar.alias("cigar"), a5.alias("a5"), a3.alias("a3"), F.when(F.col("l_suppkey") % 5 == 0, "NA").otherwise("g").alias("gene"), F.when(F.col("l_returnflag") == "A", "junk").otherwise("x").alias("af"), (F.col("l_suppkey") % 2 == 0).alias("pool"), (F.col("l_suppkey") % 3 == 0).alias("gene_pool"))


TAGGED_SQL = "SELECT l_orderkey, l_partkey, l_linenumber AS k, l_quantity::INTEGER AS q, l_partkey % 3 = 0 AS tso, l_discount > 0.03 AS tail, CASE WHEN l_suppkey % 5 = 0 THEN 'NA' ELSE 'g' END AS gene, l_returnflag = 'A' AS junk, l_suppkey % 2 = 0 AS pool, l_suppkey % 3 = 0 AS gene_pool FROM lineitem"


@query(f"SELECT l_orderkey, l_partkey, k, q < 17 AS short, tso OR NOT tail AS primer, tso OR NOT tail AS targeted_primer, q >= 17 AND NOT tso AND tail AND gene <> 'NA' AS ligation_product, true AS everything FROM ({TAGGED_SQL})")
def counted_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = al.count_predicates(F.col("cigar"), F.col("a5"), F.col("a3"), F.col("gene"))
    return tagged(spark, sf_dir).select("l_orderkey", "l_partkey", "k", *[c.alias(n) for n, c in p.items()])


@query(f"""
SELECT l_orderkey, l_partkey, k, coalesce(nullif(array_to_string(list_filter([CASE WHEN tso THEN 'TSO' END, CASE WHEN tso AND pool THEN 'POOL' END, CASE WHEN tso AND NOT pool AND gene_pool THEN 'pool' END, CASE WHEN junk THEN 'junk' END,
  CASE WHEN NOT tail THEN 'no_polyA' END, CASE WHEN k <> 2 THEN 'no_lig_NN' END, CASE WHEN q < 17 THEN 'short_match' END, CASE WHEN k * 2 > 10 THEN 'too_much_clipped' END], lambda x: x IS NOT NULL), ','), ''), 'pass') AS verdict FROM ({TAGGED_SQL})
""")
def small_rna_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = al.small_rna_verdict(*map(F.col, ("cigar", "a5", "a3", "af", "pool", "gene_pool")))
    return tagged(spark, sf_dir).select("l_orderkey", "l_partkey", "k", v.alias("verdict"))


@query("""
WITH o AS (SELECT l_orderkey, CASE WHEN l_linestatus = 'O' AND l_quantity < 25 THEN 0 WHEN l_linestatus = 'O' THEN 1 WHEN l_quantity < 25 THEN 20 ELSE 30 END AS prio, 'g' || l_suppkey AS name, CASE WHEN l_quantity < 25 THEN 'CODING' ELSE 'INTRONIC' END || l_linenumber AS fn, l_linenumber, l_partkey, l_suppkey FROM lineitem),
  t AS (SELECT * FROM o QUALIFY prio = min(prio) OVER (PARTITION BY l_orderkey))
SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT name)), ',') AS names, last(fn ORDER BY l_linenumber, l_partkey, l_suppkey, fn, name) AS function FROM t GROUP BY 1
""")
def best_overlapping_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fn = F.concat(F.when(F.col("l_quantity") < 25, "CODING").otherwise("INTRONIC"), F.col("l_linenumber").cast("string"))
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", fn.alias("function"), F.concat(F.lit("g"), F.col("l_suppkey").cast("string")).alias("name"), (F.col("l_linestatus") == "O").alias("sense"), (F.col("l_quantity") < 25).alias("exonic"))
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("g"))
    return g.select("l_orderkey", al.best_genes(F.col("g")).alias("b")).select("l_orderkey", "b.*")


@query("SELECT p_partkey, CASE WHEN n_nationkey IS NULL THEN 'NA' ELSE 'rRNA' || n_regionkey END AS af, coalesce(n_name, 'NA') AS an FROM part LEFT JOIN nation ON p_size = n_nationkey")
def abundant_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("ref"), F.concat(F.lit("rRNA"), F.col("n_regionkey").cast("string")).alias("af"), F.col("n_name").alias("an"))
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("rname"))
    return al.abundant_rna(p, n).select("p_partkey", "af", "an")


GENES_SQL = "SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN 'minus' ELSE 'plus' END AS strand, list(DISTINCT l_linestatus) AS gs, list(DISTINCT l_returnflag) AS gf FROM lineitem GROUP BY 1"


@query(f"""
SELECT l_orderkey, strand || '_' || CASE WHEN len(gs) = 1 THEN CASE gs[1] WHEN 'O' THEN 'plus' ELSE 'minus' END ELSE 'AMB' END AS strand_type,
  CASE WHEN len(gs) <> 1 THEN 'INTERGENIC' WHEN len(gf) = 1 THEN gf[1] ELSE 'AMB' END AS read_type, CASE WHEN len(gf) = 1 THEN gf[1] ELSE 'AMB' END AS collapsed FROM ({GENES_SQL})
""")
def strand_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("l_linestatus") == "O", "+").otherwise("-")).alias("gs"), F.collect_list("l_returnflag").alias("gf"))
    c = al.strand_and_type(F.col("gs"), F.col("gf"), F.when(F.col("l_orderkey") % 2 == 0, 16).otherwise(0))
    return g.select("l_orderkey", *[x.alias(n) for n, x in c.items()], al.collapsed(F.col("gf")).alias("collapsed"))


STATISTICS_SQL = f"""a AS (SELECT *, length(seq)::VARCHAR AS l, flag & 4 <> 0 AS up, mapq = 255 AS uniq, flag & 16 <> 0 AS rev, (length(seq) - l_linenumber)::VARCHAR AS m,
    CASE WHEN mapq = 255 THEN 'unique' ELSE 'multimapper' END AS status, CASE WHEN l_linenumber % 2 = 0 THEN 'CODING' ELSE 'UTR' END AS tag FROM ({ALIGNED_SQL})),
  x AS (SELECT 'aln_types' AS measure, '' AS kind, 'N_reads' AS key FROM a UNION ALL SELECT 'read_lengths', 'all', l FROM a UNION ALL SELECT 'aln_types', '', 'unmapped' FROM a WHERE up UNION ALL SELECT 'read_lengths', 'unmapped', l FROM a WHERE up
    UNION ALL SELECT 'aln_types', '', 'mapped' FROM a WHERE NOT up UNION ALL SELECT 'aln_types', '', status FROM a WHERE NOT up UNION ALL SELECT 'read_lengths', 'mapped', l FROM a WHERE NOT up UNION ALL SELECT 'read_lengths', status, l FROM a WHERE NOT up
    UNION ALL SELECT 'tag_types', '', tag FROM a WHERE NOT up UNION ALL SELECT 'cigar_types', '', 'SM' FROM a WHERE NOT up UNION ALL SELECT 'match_len_by_cigar', unnest(['SM', 'all']), m FROM a WHERE NOT up UNION ALL SELECT 'match_len_by_tag', unnest([tag, 'all']), m FROM a WHERE NOT up
    UNION ALL SELECT 'uniq_tag_types', '', tag FROM a WHERE NOT up AND uniq UNION ALL SELECT 'match_len_by_utag', unnest([tag, 'all']), m FROM a WHERE NOT up AND uniq
    UNION ALL SELECT 'sc_lengths', CASE WHEN rev THEN '3''' ELSE '5''' END, l_linenumber::VARCHAR FROM a WHERE NOT up UNION ALL SELECT 'sc_seq', CASE WHEN rev THEN '3''' ELSE '5''' END, substr(seq, 1, l_linenumber) FROM a WHERE NOT up),
  s AS (SELECT measure, kind, key, count(*) AS n FROM x GROUP BY ALL)"""


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alignment_rows(spark, sf_dir).withColumn("gf", F.when(F.col("l_linenumber") % 2 == 0, F.array(F.lit("INTRONIC"), F.lit("CODING"))).otherwise(F.array(F.lit("UTR"))))
    return al.alignment_statistics(a)


@query(f"WITH {STATISTICS_SQL} SELECT * FROM s")
def alignment_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counters, soft clips by end and sequence among them."""
    return statistics(spark, sf_dir)


@query(f"WITH {STATISTICS_SQL} SELECT measure, kind, round(sum(key::DOUBLE * n) / sum(n), 6) AS mean_length FROM s WHERE measure IN ('read_lengths', 'match_len_by_tag') GROUP BY ALL")
def mean_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = statistics(spark, sf_dir).filter(F.col("measure").isin("read_lengths", "match_len_by_tag"))
    return al.mean_length(own).withColumn("mean_length", F.round("mean_length", 6))


@query(f"WITH {STATISTICS_SQL} SELECT kind, key AS tag, n FROM s WHERE measure = 'sc_seq' QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, key) <= 3")
def top_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent soft-clipped sequences of either end."""
    from tesserae.operators.qc import top_per_group

    own = statistics(spark, sf_dir).filter("measure = 'sc_seq'")
    return top_per_group(own, ["kind"], [F.desc("n"), F.col("key")], 3).select("kind", F.col("key").alias("tag"), "n")


@query(f"""
WITH x AS (SELECT qname, flag, l_linenumber, l_partkey, count(*) OVER (PARTITION BY qname) AS nh, count(*) FILTER (l_returnflag = 'A') OVER (PARTITION BY qname) AS k, l_returnflag FROM ({ALIGNED_SQL.replace("l_orderkey, l_linenumber", "l_orderkey, l_linenumber, l_partkey, l_returnflag")}))
SELECT qname, l_linenumber, l_partkey, flag & ~256 AS flag FROM (SELECT qname, l_linenumber, l_partkey, l_returnflag, nh, k, flag | 256 AS flag FROM x) WHERE nh = 1 OR (k = 1 AND l_returnflag = 'A')
""")
def primary_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a read's several alignments, the only exonic one, no longer secondary."""
    from pyspark.sql import Window

    line = table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_returnflag") == "R", 4).when(F.col("l_linestatus") == "O", 16).otherwise(0).bitwiseOR(F.lit(256))
    rows = line.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("qname"), "l_linenumber", "l_partkey", flag.alias("flag"), F.when(F.col("l_returnflag") == "A", "UTR").otherwise("INTRONIC").alias("XF"))
    rows = rows.withColumn("NH", F.count("*").over(Window.partitionBy("qname")))
    return al.resolved_multi_mappers(rows).select("qname", "l_linenumber", "l_partkey", "flag")


@query("""
WITH t AS (SELECT p_brand, count(*) FILTER (p_size < 25 AND p_retailprice < 1300) + 1 AS a, count(*) FILTER (p_size < 25 AND p_retailprice >= 1300) + 1 AS b, count(*) FILTER (p_size >= 25 AND p_retailprice < 1300) + 1 AS c, count(*) FILTER (p_size >= 25 AND p_retailprice >= 1300) + 1 AS d FROM part GROUP BY 1),
  m AS (SELECT *, a + b AS r, a + c AS s, a + b + c + d AS n FROM t), k AS (SELECT *, unnest(range(greatest(0, r + s - n), least(r, s) + 1)) AS k FROM m),
  l AS (SELECT *, lgamma(r + 1) + lgamma(n - r + 1) + lgamma(s + 1) + lgamma(n - s + 1) - lgamma(n + 1) - lgamma(k + 1) - lgamma(r - k + 1) - lgamma(s - k + 1) - lgamma(n - r - s + k + 1) AS x FROM k),
  h AS (SELECT p_brand, x AS here FROM l WHERE k = a)
SELECT p_brand, round(any_value(a * d / (b * c)), 6) AS odds_ratio, round(least(1.0, sum(exp(x)) FILTER (x <= here + 1e-7)), 6) AS p_value FROM l JOIN h USING (p_brand) GROUP BY 1 HAVING least(1.0, sum(exp(x)) FILTER (x <= here + 1e-7)) < 2
""")
def exact_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    small, cheap = F.col("p_size") < 25, F.col("p_retailprice") < 1300
    t = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count_if(small & cheap).alias("a"), F.count_if(small & ~cheap).alias("b"), F.count_if(~small & cheap).alias("c"), F.count_if(~small & ~cheap).alias("d"))
    return al.fisher_exact(t, "a", "b", "c", "d", alpha=2.0).select("p_brand", F.round("odds_ratio", 6).alias("odds_ratio"), F.round("p_value", 6).alias("p_value"))


# ---- column functions ----


@query("SELECT doc_id, translate(reverse(coalesce(text, '')), 'ACGTUNRYSWKMBDHVacgtunryswkmbdhv', 'TGCAANYRSWMKVHDBtgcaanyrswmkvhdb') AS back, translate(coalesce(text, ''), 'ACGTUNRYSWKMBDHVacgtunryswkmbdhv', 'TGCAANYRSWMKVHDBtgcaanyrswmkvhdb') AS across FROM documents")
def complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All letters of nucleotide codes, in whole texts; other characters stay."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", sq.reverse_complement(t).alias("back"), sq.complement(t).alias("across"))


@query("""
SELECT c_custkey, round(c_acctbal / nullif(c_custkey % 7, 0), 6) IS NULL AS undefined, round(coalesce(c_acctbal / nullif(c_custkey % 7, 0), 0), 6) AS ratio,
  CASE WHEN c_custkey * 2500 >= 1000000 THEN printf('%.1fM', c_custkey * 2500 / 1e6) WHEN c_custkey * 2500 >= 1000 THEN printf('%.1fk', c_custkey * 2500 / 1e3) ELSE (c_custkey * 2500)::VARCHAR END AS short,
  CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'NA' END AS tag, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_mktsegment || '_RC' END AS partner FROM customer
""")
def small_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    even = k % 2 == 0
    tags = F.when(even, F.create_map(F.lit("CB"), "c_name")).otherwise(F.create_map(F.lit("XX"), "c_name"))
    name = F.when(even, F.concat("c_mktsegment", F.lit("_RC"))).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", (k % 7 == 0).alias("undefined"), F.round(sq.safe_divide(F.col("c_acctbal"), (k % 7).cast("double")), 6).alias("ratio"), sq.short_number(k * 2500).alias("short"), sq.tag(tags, "CB").alias("tag"), sq.oligo_partner(name).alias("partner"))


@query("""
WITH c AS (SELECT l_orderkey, string_agg(CASE WHEN l_returnflag = 'A' THEN 'MI' WHEN l_returnflag = 'N' THEN 'MDM' ELSE 'MSM' END, '' ORDER BY l_linenumber, l_returnflag) AS ops FROM lineitem GROUP BY 1)
SELECT l_orderkey, ops, regexp_replace(ops, 'M([IDN]M)+', 'M', 'g') AS coarse FROM c
""")
def coarse_cigars(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("l_returnflag") == "A", "MI").when(F.col("l_returnflag") == "N", "MDM").otherwise("MSM")
    c = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", op.alias("o")))), lambda x: x["o"]), "").alias("ops"))
    return c.select("l_orderkey", "ops", sq.coarse_cigar(F.col("ops")).alias("coarse"))
