"""Quality-control tables: per-user records as cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import qc, reads
from tesserae.plans.common import MOLECULES_SQL, molecules, table
from tesserae.registry import query

CELLS_SQL = f"SELECT cell AS cell_bc, cell % 4 AS mode, count(*) AS n_reads, count(DISTINCT umi) AS total_counts, count(DISTINCT gene) AS n_genes_by_counts, count(*) / count(DISTINCT umi) AS reads_per_counts FROM ({MOLECULES_SQL}) GROUP BY ALL"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = molecules(spark, sf_dir).groupBy(F.col("cell").alias("cell_bc"), (F.col("cell") % 4).alias("mode"))
    out = g.agg(F.count("*").alias("n_reads"), F.countDistinct("umi").alias("total_counts"), F.countDistinct("gene").alias("n_genes_by_counts"))
    return out.withColumn("reads_per_counts", F.col("n_reads") / F.col("total_counts"))


@query(f"WITH c AS ({CELLS_SQL}) SELECT cell_bc, mode, n_reads, row_number() OVER w AS rank, sum(n_reads) OVER w::BIGINT AS cumulative FROM c WINDOW w AS (PARTITION BY mode ORDER BY n_reads DESC, cell_bc ROWS UNBOUNDED PRECEDING)")
def knee_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.knee(cells(spark, sf_dir), ["mode"]).select("cell_bc", "mode", "n_reads", "rank", "cumulative")


@query(f"""
WITH c AS ({CELLS_SQL}), k AS (SELECT *, sum(n_reads) OVER (PARTITION BY mode ORDER BY n_reads DESC, cell_bc ROWS UNBOUNDED PRECEDING) AS cum, sum(n_reads) OVER (PARTITION BY mode) AS total FROM c),
  d AS (SELECT *, floor(cum / (total / 10)) + 1 AS decile FROM k), m AS (SELECT mode, decile::INTEGER AS decile, median(n_reads)::DOUBLE AS n_reads, median(total_counts)::DOUBLE AS total_counts, count(*)::DOUBLE AS cell_count FROM d WHERE decile < 11 GROUP BY ALL)
SELECT mode, decile, observation, round(value, 6) AS value FROM m UNPIVOT (value FOR observation IN (n_reads, total_counts, cell_count))
""")
def decile_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.decile_medians(cells(spark, sf_dir), ["mode"], ["n_reads", "total_counts"]).withColumn("value", F.round("value", 6))


@query("""
WITH c AS (SELECT c_mktsegment AS seg, 'B' || (c_custkey * 7919 % 65536) AS cell_bc, c_custkey % 50 + 1 AS total_counts FROM customer), k AS (SELECT *, sum(total_counts) OVER (PARTITION BY seg ORDER BY total_counts DESC, cell_bc ROWS UNBOUNDED PRECEDING) AS cum FROM c),
  q AS (SELECT *, min(cum) OVER (PARTITION BY seg) AS lo, max(cum) OVER (PARTITION BY seg) AS hi FROM k),
  p AS (SELECT seg, cell_bc, CASE WHEN cum = lo THEN 1 ELSE greatest(1, least(4, ceil((cum - lo) * 4 / (hi - lo)))) END::INTEGER AS quartile FROM q)
SELECT seg, quartile, i::INTEGER AS position, substr(cell_bc, i::INTEGER + 1, 1) AS nucleotide, count(*) AS n FROM (SELECT *, unnest(range(0, length(cell_bc))) AS i FROM p) GROUP BY ALL
""")
def nucleotide_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("seg"), F.concat(F.lit("B"), (F.col("c_custkey") * 7919 % 65536).cast("string")).alias("cell_bc"), (F.col("c_custkey") % 50 + 1).alias("total_counts"))
    return qc.nucleotides(c, ["seg"], "total_counts")


@query("""
WITH c AS (SELECT l_suppkey, count(*) AS n_reads, sum(l_quantity) AS total_counts FROM lineitem GROUP BY 1), t AS (SELECT unnest(range(10, 20000, 10)) AS cutoff)
SELECT cutoff, count(*) AS n_cells, round(median(n_reads), 6) AS median_n_reads FROM t JOIN c ON total_counts > cutoff GROUP BY 1
""")
def cutoff_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n_reads"), F.sum("l_quantity").alias("total_counts"))
    return qc.cutoff_curve(c, ["n_reads"]).withColumn("median_n_reads", F.round("median_n_reads", 6))


@query("SELECT least(floor((l_extendedprice - 0) / 1500.0), 99)::INTEGER AS bin, round(bin * 1500.0, 6) AS low, round((bin + 1) * 1500.0, 6) AS high, count(*) AS n FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 150000 GROUP BY ALL")
def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 100, 0.0, 150000.0).withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query(f"""
WITH c AS ({CELLS_SQL}), v AS (SELECT mode, log10(n_reads) AS v FROM c WHERE n_reads > 0), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v), x AS (SELECT lo + i * ((hi - lo) / 19) AS x FROM e, range(20) t(i))
SELECT mode, round(x, 6) AS x, round(sum(exp(-((x - v) / 0.1) * ((x - v) / 0.1) / 2)) / (count(*) * 0.1 * sqrt(2 * pi())), 6) AS density FROM v, x GROUP BY mode, x
""")
def read_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.density(cells(spark, sf_dir), "n_reads", ["mode"], 0.1, 20, 0).select("mode", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


@query(f"WITH c AS ({CELLS_SQL}) SELECT mode, cutoff, round(median(n_reads), 6) AS median FROM c, (VALUES (1), (5), (10), (20)) t(cutoff) WHERE total_counts > cutoff GROUP BY ALL")
def medians_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.medians_above(cells(spark, sf_dir), ["mode"], "n_reads", [1, 5, 10, 20]).withColumn("median", F.round("median", 6))


@query(f"""
WITH c AS ({CELLS_SQL}) SELECT mode, count(*) AS n_beads, round_even(sum(n_reads) / 1e6, 3) AS sum_reads, round_even(median(n_genes_by_counts), 3) AS median_genes, round_even(median(reads_per_counts), 3) AS median_pcr, round_even(median(n_reads), 3) AS median_reads, round_even(median(total_counts), 3) AS median_umis FROM c GROUP BY mode
""")
def run_mode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.run_mode_summary(cells(spark, sf_dir), ["mode"])


@query(f"""WITH c AS ({CELLS_SQL}), g AS (SELECT count(DISTINCT gene) AS n_genes FROM ({MOLECULES_SQL}) WHERE cell IN (SELECT cell_bc FROM c WHERE total_counts > 3))
SELECT (SELECT n_genes FROM g) AS n_genes, count(*) AS n_spots, median(total_counts) AS median_umis, median(n_genes_by_counts) AS median_genes FROM c WHERE total_counts > 3""")
def sample_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.sample_metrics(cells(spark, sf_dir), molecules(spark, sf_dir).select("cell", "gene"), 3)


@query("""
WITH c AS (SELECT p_brand, p_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY p_brand) AS total FROM part GROUP BY p_brand, p_type)
SELECT p_brand, CASE WHEN n / total < 0.05 THEN 'misc' ELSE p_type END AS name, sum(n)::BIGINT AS n, round(sum(n) / max(total), 6) AS fraction FROM c GROUP BY ALL
""")
def collapsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return qc.collapsed_counts(c, ["p_brand"], "p_type", "n", 0.05).withColumn("fraction", F.round("fraction", 6))


@query("""
WITH s AS (SELECT l_suppkey % 10 AS sample, l_returnflag AS name, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT sample, sum(n)::BIGINT AS n_total FROM s GROUP BY 1)
SELECT sample, n_total, round(coalesce(sum(n) FILTER (name = 'A'), 0) * 100.0 / n_total, 6) AS A, round(coalesce(sum(n) FILTER (name = 'N'), 0) * 100.0 / n_total, 6) AS N, round(coalesce(sum(n) FILTER (name = 'R'), 0) * 100.0 / n_total, 6) AS R FROM s JOIN t USING (sample) GROUP BY sample, n_total
""")
def sample_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("sample"), F.col("l_returnflag").alias("name")).agg(F.count("*").alias("n"))
    long = s.unionByName(s.groupBy("sample").agg(F.lit("n_total").alias("name"), F.sum("n").alias("n")))
    return qc.overview(long, "sample", "name", "n", ["A", "N", "R"], "n_total").withColumns({c: F.round(c, 6) for c in "ANR"})


@query("SELECT sum(l_quantity) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice, round(avg(l_discount), 6) AS l_discount FROM lineitem")
def merged_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = qc.merged_mapping_logs(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], "l_discount")
    return out.select("l_quantity", F.round("l_extendedprice", 2).alias("l_extendedprice"), F.round("l_discount", 6).alias("l_discount"))


@query("""
WITH x AS (SELECT l_returnflag, count(*) AS total, count(*) FILTER (l_quantity < 17) AS short FROM lineitem GROUP BY 1) SELECT l_returnflag, total, printf('%d (%.1f%%)', short, short * 100.0 / total) AS short FROM x
""")
def mapping_percents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("total"), F.count(F.when(F.col("l_quantity") < 17, 1)).alias("short"))
    return qc.mapping_table(s, "total", ["short"])


@query("SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events QUALIFY rank <= 5")
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.top_per_group(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], [F.desc("value"), F.col("event_id")], 5)


@query("SELECT least(floor((log10(o_totalprice) - 2) / 0.1), 39)::INTEGER AS bin, round(pow(10.0, 2 + bin * 0.1), 4) AS low, round(pow(10.0, 2 + (bin + 1) * 0.1), 4) AS high, count(*) AS n FROM orders WHERE log10(o_totalprice) BETWEEN 2 AND 6 GROUP BY ALL")
def log_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = qc.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 40, 2.0, 6.0, log=True)
    return h.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query("SELECT p_brand, p_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY p_brand), 6) AS fraction FROM part GROUP BY p_brand, p_type")
def normalised_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return qc.normalised_histogram(c, ["p_brand"]).withColumn("fraction", F.round("fraction", 6))


@query("SELECT regexp_matches(p_type, '^(ECONOMY|SMALL)') AS matches, count(*) AS n FROM part GROUP BY 1")
def regrouped_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("name")).agg(F.count("*").alias("n"))
    return qc.regrouped(c, "^(ECONOMY|SMALL)")


@query("""
WITH c AS (SELECT l_linenumber AS position, l_returnflag AS name, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT e.position, e.name, coalesce(n, 0) AS n FROM (SELECT DISTINCT c.position, d.name FROM c, (VALUES ('A'), ('N'), ('R'), ('X')) d(name)) e LEFT JOIN c ON e.position = c.position AND e.name = c.name
""")
def zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("position"), F.col("l_returnflag").alias("name")).agg(F.count("*").alias("n"))
    return qc.zero_filled(c, "position", "name", ["A", "N", "R", "X"])


@query("""
WITH s AS (SELECT l_suppkey AS sample, CASE WHEN l_quantity >= 49 AND l_discount >= 0.1 THEN 'rare' ELSE l_returnflag END AS name, count(*) AS value FROM lineitem GROUP BY ALL)
SELECT s_suppkey AS sample, value FROM supplier LEFT JOIN (SELECT * FROM s WHERE name = 'rare') ON s_suppkey = sample
""")
def attributes_by_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when((F.col("l_quantity") >= 49) & (F.col("l_discount") >= 0.1), "rare").otherwise(F.col("l_returnflag"))
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("sample"), name.alias("name")).agg(F.count("*").alias("value")).withColumn("kind", F.lit("reads"))
    samples = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample"))
    return qc.attribute_by_sample(s, samples, "sample", "reads", "rare")


@query("""
WITH c AS (SELECT n_name AS a, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation),
  d AS (SELECT min(list_sum(list_transform(range(1, least(length(a.a), length(b.a)) + 1), lambda i: CASE WHEN substr(a.a, i, 1) = substr(b.a, i, 1) THEN 0 ELSE 1 END))) AS d FROM c a JOIN c b ON a.i < b.i)
SELECT least(3, ceil(d / 2) - 1)::BIGINT AS bound FROM d
""")
def mismatch_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = qc.mismatch_bound(table(spark, sf_dir, "nation").select(F.col("n_name").alias("barcode")))
    return spark.createDataFrame([(n,)], "bound long")


SAMPLES_SQL = """e AS (SELECT event_id, user_id, event_type, event_id * 7919 % 100 AS own FROM events), p AS (SELECT unnest(range(10, 101, 10)) AS pct)"""


@query(f"""
WITH {SAMPLES_SQL}, m AS (SELECT pct, user_id, count(DISTINCT event_type) AS genes, count(*) AS n_reads FROM e JOIN p ON own < pct GROUP BY ALL)
SELECT pct, count(*) AS n_cells, round(median(n_reads), 6) AS median_reads, round(median(genes), 6) AS median_genes FROM m GROUP BY 1
""")
def saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested samples: a record is in every sample above its own number modulo 100."""
    e = reads.in_samples(table(spark, sf_dir, "events"), F.col("event_id") * 7919 % 100, 10)
    m = e.groupBy("pct", "user_id").agg(F.countDistinct("event_type").alias("genes"), F.count("*").alias("n_reads"))
    return m.groupBy("pct").agg(F.count("*").alias("n_cells"), F.round(F.median("n_reads"), 6).alias("median_reads"), F.round(F.median("genes"), 6).alias("median_genes"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def hash_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested samples by a hash of the name: what is new in each of them adds up to all records."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").cast("string").alias("qname"))
    out = None
    for low, high in ((0, 20), (20, 70), (70, 100)):
        own = reads.subsampled(e, high).join(reads.subsampled(e, low).select("qname"), "qname", "left_anti")
        out = own if out is None else out.unionByName(own)
    return out.groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT row_number() OVER (ORDER BY count(*) DESC, event_type)::INTEGER AS place, event_type AS name, count(*) AS n FROM events GROUP BY event_type")
def ordered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n"))
    return qc.ordered_counts(c)


@query("""
WITH c AS (SELECT l_returnflag AS f, count(*)::BIGINT AS n, count(*) FILTER (l_quantity < 17)::BIGINT AS short FROM lineitem GROUP BY 1)
SELECT 'n' AS key, max(n) FILTER (f = 'A') AS A, max(n) FILTER (f = 'N') AS N, max(n) FILTER (f = 'R') AS R FROM c UNION ALL SELECT 'short', max(short) FILTER (f = 'A'), max(short) FILTER (f = 'N'), max(short) FILTER (f = 'R') FROM c
""")
def transposed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") < 17).alias("short"))
    return qc.transposed(c, "l_returnflag")


@query("""
SELECT n, count(*) AS samples FROM (SELECT l_suppkey, count(*) AS n, NULL AS x FROM lineitem GROUP BY 1) GROUP BY n
""")
def merged_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by return flag, put together again by name."""
    line = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("qname"), "l_returnflag")
    parts = [line.filter(F.col("l_returnflag") == f) for f in "AN"] + [line.filter(F.col("l_returnflag") == "R").drop("l_returnflag")]
    return reads.merged_samples(parts).groupBy("qname").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("samples"))


@query(f"""
WITH c AS ({CELLS_SQL}), v AS (SELECT mode, log10(n_reads) AS v FROM c WHERE n_reads > 0), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v), x AS (SELECT lo + i * ((hi - lo) / 19) AS x FROM e, range(20) t(i)),
  b AS (SELECT mode, lo + (least(floor((v - lo) / ((hi - lo) / 50)), 49) + 0.5) * ((hi - lo) / 50) AS v FROM v, e)
SELECT mode, round(x, 6) AS x, round(sum(exp(-((x - v) / 0.1) * ((x - v) / 0.1) / 2)) / (count(*) * 0.1 * sqrt(2 * pi())), 5) AS density FROM b, x GROUP BY mode, x
""")
def binned_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities from values counted in fine bins first, whose number bounds the work."""
    return qc.density(cells(spark, sf_dir), "n_reads", ["mode"], 0.1, 20, 50).select("mode", F.round("x", 6).alias("x"), F.round("density", 5).alias("density"))
