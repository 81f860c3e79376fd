"""Count matrices, margins, histograms, whitelists, cascades, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import counts, matrix, reads, tiles
from tesserae.operators.alignments import gene_of, resolved_multi_mappers, tag_statistics, top_function
from tesserae.operators.strategy import cascade
from tesserae.plans.common import MOLECULES_SQL, molecules, table
from tesserae.registry import query


@query(f"""
WITH m AS ({MOLECULES_SQL}), c AS (SELECT cell, gene, count(DISTINCT umi) AS umis, count(*) AS reads FROM m GROUP BY ALL)
SELECT cell, sum(umis)::BIGINT AS total_counts, count(*) FILTER (umis > 0) AS n_genes_by_counts, coalesce(sum(umis) FILTER (regexp_matches(gene, '^c')), 0)::BIGINT AS total_counts_mt,
       sum(reads)::BIGINT AS n_reads, round(100.0 * coalesce(sum(umis) FILTER (regexp_matches(gene, '^c')), 0) / sum(umis), 6) AS pct_counts_mt, round(sum(reads) / sum(umis), 6) AS reads_per_counts
FROM c GROUP BY cell HAVING sum(umis) > 10
""")
def dge_cell_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = counts.molecule_counts(molecules(spark, sf_dir), "cell", "gene", "umi")
    m = counts.above_cutoff(counts.cell_metrics(c, "^c"), 10)
    return m.withColumns({n: F.round(n, 6) for n in ("pct_counts_mt", "reads_per_counts")})


@query("""
WITH l AS (SELECT l_suppkey AS cell, p_brand AS gene, l_orderkey AS umi, l_quantity < 17 AS short, l_linestatus = 'O' AS reverse FROM lineitem JOIN part ON l_partkey = p_partkey),
  x AS (SELECT cell, gene, umi, 'count' AS channel FROM l UNION ALL SELECT cell, gene, umi, 'short' FROM l WHERE short UNION ALL SELECT cell, gene, umi, 'reverse' FROM l WHERE reverse)
SELECT cell, gene, channel, count(DISTINCT umi) AS umis, count(*) AS reads FROM x GROUP BY ALL
""")
def dge_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return counts.molecule_counts(line, "l_suppkey", "p_brand", "l_orderkey", {"count": F.lit(True), "short": F.col("l_quantity") < 17, "reverse": F.col("l_linestatus") == "O"})


@query("""
WITH m AS (SELECT l_suppkey AS cell, l_returnflag AS gene, l_orderkey AS umi, count(*) AS reads FROM lineitem GROUP BY ALL),
  b AS (SELECT cell, gene, count(umi) AS umis, sum(reads)::BIGINT AS reads FROM m GROUP BY ALL)
SELECT cell, gene, CASE WHEN grouping(gene) = 1 THEN 'cell' WHEN grouping(cell) = 1 THEN 'gene' ELSE 'both' END AS level,
       sum(umis)::BIGINT AS umis, sum(reads)::BIGINT AS reads, count(*) AS partners
FROM b GROUP BY GROUPING SETS ((cell), (gene), (cell, gene))
""")
def dge_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.margins(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_returnflag", "l_orderkey")


@query("""
SELECT cell, gene, count(DISTINCT umi) AS n FROM (SELECT l_suppkey AS cell, l_orderkey AS umi, l_returnflag AS gene, CASE WHEN l_quantity < 15 THEN 'CODING' WHEN l_quantity < 25 THEN 'UTR' WHEN l_quantity < 40 THEN 'INTRONIC' ELSE 'INTERGENIC' END AS gf,
  CASE WHEN l_tax < 0.05 THEN 255 ELSE 3 END AS mapq FROM lineitem) WHERE gf IN ('CODING', 'UTR', 'INTRONIC') AND mapq >= 255 GROUP BY ALL
""")
def dge_flavor_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    gf = F.when(q < 15, "CODING").when(q < 25, "UTR").when(q < 40, "INTRONIC").otherwise("INTERGENIC")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("CB"), F.col("l_orderkey").alias("MI"), F.col("l_returnflag").alias("gn"), gf.alias("gf"), F.when(F.col("l_tax") < 0.05, 255).otherwise(3).alias("mapq"))
    return counts.dge(rows, "all")


@query("SELECT user_id AS tag, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 10")
def tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.tag_histogram(table(spark, sf_dir, "events"), "user_id", 10)


@query("SELECT l_partkey AS tag, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, tag DESC LIMIT 100")
def top_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.most_frequent(counts.tag_histogram(table(spark, sf_dir, "lineitem"), "l_partkey"), 100)


@query("""
WITH w AS (SELECT l_suppkey AS k FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 20)
SELECT l_suppkey AS cell, l_returnflag AS gene, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT k FROM w) GROUP BY ALL
""")
def whitelisted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    top = counts.most_frequent(counts.tag_histogram(line, "l_suppkey"), 20)
    return counts.whitelisted(line, "l_suppkey", top, "tag").groupBy(F.col("l_suppkey").alias("cell"), F.col("l_returnflag").alias("gene")).agg(F.count("*").alias("n"))


@query("""
WITH d(measure, value) AS (VALUES ('l_returnflag', 'A'), ('l_returnflag', 'N'), ('l_returnflag', 'X'), ('l_returnflag', 'OTHER'), ('l_linestatus', 'O'), ('l_linestatus', 'F'), ('l_linestatus', 'OTHER')),
  x AS (SELECT 'l_returnflag' AS measure, CASE WHEN l_returnflag IN ('A', 'N', 'X') THEN l_returnflag ELSE 'OTHER' END AS value FROM lineitem
        UNION ALL SELECT 'l_linestatus', CASE WHEN l_linestatus IN ('O', 'F') THEN l_linestatus ELSE 'OTHER' END FROM lineitem)
SELECT measure, value, count(x.measure) AS n FROM d LEFT JOIN x USING (measure, value) GROUP BY ALL
""")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.domain_counts(table(spark, sf_dir, "lineitem"), {"l_returnflag": ["A", "N", "X"], "l_linestatus": ["O", "F"]})


@query("""
WITH c AS (SELECT cell, gene, count(DISTINCT umi) AS umis, count(*) AS reads FROM (SELECT l_suppkey AS cell, l_partkey AS gene, l_orderkey AS umi FROM lineitem) GROUP BY ALL),
  s AS (SELECT * FROM c WHERE cell IN (SELECT cell FROM c GROUP BY 1 HAVING count(DISTINCT gene) >= 2))
SELECT cell, gene, umis, reads FROM s WHERE gene IN (SELECT gene FROM s GROUP BY 1 HAVING count(DISTINCT cell) >= 3)
""")
def filtered_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = counts.molecule_counts(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey", "l_orderkey")
    return counts.filtered_matrix(c, 2, 3).select("cell", "gene", "umis", "reads")


@query("""
SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_first FROM events
""")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.first_seen(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""
WITH f AS (SELECT event_type, user_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_first FROM events),
  x AS (SELECT 'reads' AS scope, event_type AS value FROM f UNION ALL SELECT 'umis', event_type FROM f WHERE is_first)
SELECT scope, value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY scope), 6) AS percent FROM x GROUP BY scope, value
""")
def duplicate_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = reads.first_seen(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return tag_statistics(flagged, "event_type").withColumn("percent", F.round("percent", 6))


@query("""
WITH x AS (SELECT *, count(*) FILTER (l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS k, count(*) OVER (PARTITION BY l_orderkey) AS nh FROM lineitem)
SELECT l_orderkey, l_linenumber, l_returnflag FROM x WHERE nh = 1 OR (k = 1 AND l_returnflag = 'R')
""")
def multi_mappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").withColumn("NH", F.count("*").over(Window.partitionBy("l_orderkey")))
    return resolved_multi_mappers(line, "l_orderkey", "NH", "l_returnflag", ("R",)).drop("NH")


@query("""
WITH g AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_returnflag, l_linestatus) AS gn, list(l_linestatus ORDER BY l_linenumber, l_returnflag, l_linestatus) AS gf FROM lineitem GROUP BY 1),
  c AS (SELECT l_orderkey, gn, gf, list_distinct(list_transform(list_filter(list_zip(gn, gf), lambda z: z[2] <> 'O'), lambda z: z[1])) AS u FROM g)
SELECT l_orderkey, CASE WHEN len(u) = 1 THEN u[1] ELSE 'multi_mapper' END AS gene,
  CASE WHEN len(list_distinct(gf)) = 1 THEN gf[1] ELSE array_to_string(gf, ',') END AS function FROM c
""")
def gene_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus")))
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(p.alias("p")).select("l_orderkey", F.col("p.l_returnflag").alias("gn"), F.col("p.l_linestatus").alias("gf"))
    return g.select("l_orderkey", gene_of(F.col("gn"), F.col("gf"), ("O",)).alias("gene"), top_function(F.col("gf")).alias("function"))


@query("""
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small.bowtie2' WHEN p_retailprice > 1200 THEN 'dear.STAR' ELSE 'not_dear.STAR' END AS output FROM part
""")
def mapping_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"small": F.col("p_size") < 10, "dear": F.col("p_retailprice") > 1200}
    run = lambda df, r: df.filter(rules[r.reference])
    made = cascade(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), "bowtie2:small->STAR:dear:final", {"bowtie2": run, "STAR": run}, "p_partkey")
    out = [made[n].select("p_partkey", F.lit(n).alias("output")) for n in ("small.bowtie2", "dear.STAR", "not_dear.STAR")]
    return out[0].union(out[1]).union(out[2])


@query("SELECT doc_id, source FROM documents WHERE doc_id % 10 = 0")
def skimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.every_nth(table(spark, sf_dir, "documents").select("doc_id", "source"), 10, "doc_id")


@query("""
WITH a AS (SELECT DISTINCT l_partkey AS gene FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R')
SELECT gene FROM a INTERSECT SELECT l_partkey FROM b
""")
def shared_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("gene"), "l_returnflag")
    return matrix.shared_genes(line.filter("l_returnflag = 'A'"), line.filter("l_returnflag = 'R'"))


@query("""
WITH t AS (SELECT l_returnflag AS tile, l_partkey AS gene, count(*) AS n FROM lineitem GROUP BY ALL), g AS (SELECT gene FROM t GROUP BY 1 HAVING count(DISTINCT tile) = 3)
SELECT gene, sum(n)::BIGINT AS n FROM t WHERE gene IN (SELECT gene FROM g) GROUP BY 1
""")
def joined_tiles_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_partkey").alias("gene"))
    parts = [line.filter(F.col("l_returnflag") == f).groupBy("gene").agg(F.count("*").alias("n")) for f in "ANR"]
    return tiles.joined_counts(parts, "inner").groupBy("gene").agg(F.sum("n").alias("n"))


@query("""
WITH c AS (SELECT l_suppkey AS cell, p_brand AS gene, count(DISTINCT l_orderkey) AS umis FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  t AS (SELECT cell, sum(umis) AS total FROM c GROUP BY 1), x AS (SELECT gene, log2(1 + umis * 1000.0 / total) AS x FROM c JOIN t USING (cell)), n AS (SELECT count(*) AS n FROM t)
SELECT gene, round(sum(x) / n, 6) AS mean, round((sum(x * x) - n * (sum(x) / n) * (sum(x) / n)) / (n - 1), 6) AS var FROM x, n GROUP BY gene, n
""")
def gene_variability(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    c = counts.molecule_counts(line, "l_suppkey", "p_brand", "l_orderkey")
    return matrix.gene_dispersion(matrix.normalised(c, 1000.0)).select("gene", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


FLAVORED_SQL = """SELECT l_suppkey AS cell, l_orderkey AS umi, l_returnflag AS gene, CASE WHEN l_quantity < 15 THEN 'CODING' WHEN l_quantity < 25 THEN 'UTR' WHEN l_quantity < 40 THEN 'INTRONIC' ELSE 'INTERGENIC' END AS gf, CASE WHEN l_tax < 0.05 THEN 255 ELSE 3 END AS mapq FROM lineitem"""


@query(f"""
WITH r AS ({FLAVORED_SQL}), f AS (SELECT * FROM (VALUES ('exon', ['CODING', 'UTR']), ('intron', ['INTRONIC']), ('all', ['CODING', 'UTR', 'INTRONIC'])) t(flavor, gfs)),
  x AS (SELECT flavor, multi, cell, gene, count(DISTINCT umi) AS umis, count(*) AS reads FROM r, f, (VALUES (false), (true)) m(multi) WHERE list_contains(gfs, gf) AND (multi OR mapq >= 255) GROUP BY ALL)
SELECT flavor, multi, false AS reads, cell, gene, umis AS n FROM x UNION ALL SELECT flavor, multi, true, cell, gene, reads FROM x
""")
def dge_flavors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flavour: exon, intron, all; unique or several mappings; molecules or reads."""
    q = F.col("l_quantity")
    gf = F.when(q < 15, "CODING").when(q < 25, "UTR").when(q < 40, "INTRONIC").otherwise("INTERGENIC")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("CB"), F.col("l_orderkey").alias("MI"), F.col("l_returnflag").alias("gn"), gf.alias("gf"), F.when(F.col("l_tax") < 0.05, 255).otherwise(3).alias("mapq"))
    out = None
    for flavor in counts.FLAVORS:
        for multi in (False, True):
            for in_reads in (False, True):
                own = counts.dge(rows, flavor, in_reads, multi).select(F.lit(flavor).alias("flavor"), F.lit(multi).alias("multi"), F.lit(in_reads).alias("reads"), "cell", "gene", "n")
                out = own if out is None else out.unionByName(own)
    return out


@query(f"WITH m AS ({MOLECULES_SQL}), c AS (SELECT cell, gene, count(DISTINCT umi) AS umis FROM m GROUP BY ALL) SELECT gene, sum(umis)::BIGINT AS total_counts, count(*) FILTER (umis > 0) AS n_cells_by_counts FROM c GROUP BY 1")
def gene_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.gene_metrics(counts.molecule_counts(molecules(spark, sf_dir), "cell", "gene", "umi"))


@query("SELECT p_brand AS gene, count(*) FILTER (l_quantity >= 10 AND l_tax < 0.07) AS counted, count(*) FILTER (l_quantity < 10 OR l_tax >= 0.07) AS discarded FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def bulk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return counts.bulk_counts(line, "p_brand", F.when(F.col("l_quantity") < 10, "short").when(F.col("l_tax") >= 0.07, "multi"))


@query("""
WITH c AS (SELECT l_suppkey AS cell, l_returnflag AS gene, count(DISTINCT l_orderkey) AS umis FROM lineitem GROUP BY ALL)
SELECT cell, gene, umis, (dense_rank() OVER (ORDER BY cell) - 1)::INTEGER AS i, (dense_rank() OVER (ORDER BY gene) - 1)::INTEGER AS j FROM c
""")
def sorted_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = counts.molecule_counts(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_returnflag", "l_orderkey").select("cell", "gene", "umis")
    return counts.sorted_axes(c).select("cell", "gene", "umis", "i", "j")


@query("SELECT l_partkey AS gene, l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY ALL")
def joined_tiles_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tile's genes, whether others have them or not."""
    line = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_partkey").alias("gene"))
    parts = [line.filter(F.col("l_returnflag") == f).groupBy("gene").agg(F.first("l_returnflag").alias("flag"), F.count("*").alias("n")) for f in "ANR"]
    return tiles.joined_counts(parts, "outer")


VALUES_SQL = """c AS (SELECT l_suppkey AS cell, p_brand AS gene, count(DISTINCT l_orderkey) AS umis FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  t AS (SELECT cell, sum(umis) AS total FROM c GROUP BY 1), x AS (SELECT cell, gene, log2(1 + umis * 1000.0 / total) AS x FROM c JOIN t USING (cell)), n AS (SELECT count(*) AS n FROM t),
  g AS (SELECT gene, sum(x) / n AS mean, (sum(x * x) - n * (sum(x) / n) * (sum(x) / n)) / (n - 1) AS var FROM x, n GROUP BY gene, n)"""


def brand_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return matrix.normalised(counts.molecule_counts(line, "l_suppkey", "p_brand", "l_orderkey"), 1000.0)


@query(f"""
WITH {VALUES_SQL}, b AS (SELECT gene, mean, var / mean AS d, ntile(4) OVER (ORDER BY mean, gene) AS b FROM g),
  z AS (SELECT gene, coalesce((d - avg(d) OVER (PARTITION BY b)) / nullif(stddev_samp(d) OVER (PARTITION BY b), 0), 0) AS z FROM b)
SELECT gene, round(z, 6) AS z FROM z ORDER BY z.z DESC, gene LIMIT 10
""")
def variable_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten that stand out most among genes of similar mean (a top-k report)."""
    return matrix.variable_genes(brand_values(spark, sf_dir), None, 10, 4).select("gene", F.round("z", 6).alias("z"))


@query(f"""
WITH {VALUES_SQL}, k AS (SELECT cell % 3 AS cluster, cell FROM t), s AS (SELECT cluster, count(*) AS n FROM k GROUP BY 1), a AS (SELECT sum(n) AS n FROM s),
  m AS (SELECT cluster, gene, sum(x) AS s, sum(x * x) AS q, count(*) FILTER (x > 0) AS p FROM x JOIN k USING (cell) GROUP BY ALL),
  w AS (SELECT m.*, s.n, a.n - s.n AS r, sum(m.s) OVER g - m.s AS os, sum(m.q) OVER g - m.q AS oq, sum(m.p) OVER g - m.p AS op FROM m JOIN s USING (cluster), a WINDOW g AS (PARTITION BY gene)),
  v AS (SELECT cluster, gene, s / n - os / r AS diff, (q - n * (s / n) * (s / n)) / greatest(n - 1, 1) AS va, (oq - r * (os / r) * (os / r)) / greatest(r - 1, 1) AS vr, n, r, p / n AS pts, op / r AS pts_rest FROM w)
SELECT cluster, gene, round(coalesce(diff / nullif(sqrt(greatest(va / n + vr / r, 0)), 0), 0), 5) AS score, round(diff, 6) AS logfoldchange, round(pts, 6) AS pts, round(pts_rest, 6) AS pts_rest FROM v
""")
def cluster_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = brand_values(spark, sf_dir)
    clusters = v.select("cell").distinct().withColumn("cluster", F.col("cell") % 3)
    out = matrix.markers(v, clusters)
    return out.select("cluster", "gene", F.round("score", 5).alias("score"), *[F.round(c, 6).alias(c) for c in ("logfoldchange", "pts", "pts_rest")])


@query("""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, neighbour, round(distance, 5) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) <= 5
""")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector, exact."""
    out = matrix.neighbours_by_vector(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 5)
    return out.withColumn("distance", F.round("distance", 5))


@query("""
WITH m AS (SELECT l_suppkey AS location, l_returnflag AS cluster, median(l_quantity) AS w FROM lineitem GROUP BY ALL) SELECT location, arg_max(cluster, {'w': w, 'c': cluster}) AS cluster FROM m GROUP BY 1
""")
def clusters_of_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("location"), F.col("l_returnflag").alias("cluster"), F.col("l_quantity").alias("weight"))
    return matrix.cluster_of_location(t)


@query("""
WITH d AS (SELECT DISTINCT c_custkey::VARCHAR AS bc FROM customer), k AS (SELECT DISTINCT o_custkey::VARCHAR AS bc FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT count(*) AS n_detected, count(*) FILTER (bc IN (SELECT bc FROM k)) AS n_known, count(*) FILTER (reverse(bc) IN (SELECT bc FROM k)) AS n_reversed FROM d
""")
def known_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cell_bc"))
    k = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").cast("string").alias("cell_bc"))
    return tiles.known_barcodes(d, k)


@query(f"""
WITH {VALUES_SQL}, k AS (SELECT cell % 3 AS cluster, cell FROM t), s AS (SELECT cluster, count(*) AS n FROM k GROUP BY 1), m AS (SELECT cluster, gene, sum(x) AS total, count(*) FILTER (x > 0) AS p FROM x JOIN k USING (cell) GROUP BY ALL)
SELECT cluster, gene, round(total, 6) AS total, round(p / n, 6) AS pts FROM m JOIN s USING (cluster)
""")
def marker_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking's rows with the shares of cells looked up by gene and cluster."""
    v = brand_values(spark, sf_dir)
    clusters = v.select("cell").distinct().withColumn("cluster", F.col("cell") % 3)
    ranked = v.join(clusters, "cell").groupBy("cluster", "gene").agg(F.round(F.sum("x"), 6).alias("total"))
    return matrix.marker_table(ranked, matrix.markers(v, clusters)).select("cluster", "gene", "total", F.round("pts", 6).alias("pts"))


@query("""
WITH c AS (SELECT l_suppkey AS cell, p_brand AS gene, count(DISTINCT l_orderkey) AS umis FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  t AS (SELECT cell, sum(umis) AS total FROM c GROUP BY 1), m AS (SELECT median(total) AS m FROM t)
SELECT cell, round(sum(log2(1 + umis * m / total)), 5) AS x FROM c JOIN t USING (cell), m GROUP BY 1
""")
def median_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell scaled to the median total."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    v = matrix.normalised(counts.molecule_counts(line, "l_suppkey", "p_brand", "l_orderkey"))
    return v.groupBy("cell").agg(F.round(F.sum("x"), 5).alias("x"))


@query(f"""
WITH m AS ({MOLECULES_SQL}), c AS (SELECT cell, gene, count(DISTINCT umi) AS umis FROM m GROUP BY ALL), r AS (SELECT user_id AS cell, count(*) * 3 AS n_reads FROM events WHERE value > 1 GROUP BY 1)
SELECT cell, sum(umis)::BIGINT AS total_counts, any_value(n_reads) AS n_reads, round(any_value(n_reads) / sum(umis), 6) AS reads_per_counts FROM c JOIN r USING (cell) GROUP BY 1
""")
def metrics_with_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of a cell come from a summary; cells that it lacks go."""
    c = counts.molecule_counts(molecules(spark, sf_dir), "cell", "gene", "umi")
    summary = table(spark, sf_dir, "events").filter("value > 1").groupBy(F.col("user_id").alias("cell")).agg((F.count("*") * 3).alias("n_reads"))
    out = counts.cell_metrics(c, "^c", summary)
    return out.select("cell", "total_counts", "n_reads", F.round("reads_per_counts", 6).alias("reads_per_counts"))


CATALOG_SQL = """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'm.h5' END AS dge, c_custkey % 3 = 0 AS has_r2, CASE WHEN c_custkey % 5 = 0 THEN 'l.fq' END AS longreads, CASE WHEN c_custkey % 7 = 0 THEN 'b' END AS basecalls, c_custkey % 11 = 0 AS is_merged, c_mktsegment AS puck, c_custkey % 2 = 0 AS has_files FROM customer"""


@query(f"""
SELECT c_custkey, dge IS NOT NULL AND NOT has_r2 AND longreads IS NULL AND basecalls IS NULL AS external, dge IS NOT NULL OR has_r2 OR basecalls IS NOT NULL OR is_merged AS matrix, puck IN ('BUILDING', 'MACHINERY') OR has_files AS spatial FROM ({CATALOG_SQL})
""")
def catalog_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What samples of a catalog have."""
    from tesserae.operators import catalog

    k = F.col("c_custkey")
    some = lambda test, name: F.when(test, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 4 == 0, "m.h5").alias("dge"), some(k % 3 == 0, "r.fq").alias("r2"), F.when(k % 5 == 0, "l.fq").alias("longreads"), F.when(k % 7 == 0, "b").alias("basecalls"),
        (k % 11 == 0).alias("is_merged"), F.col("c_mktsegment").alias("puck"), some(k % 2 == 0, "p.txt").alias("puck_files"),
    )
    return c.select("c_custkey", catalog.is_external().alias("external"), catalog.has_dge().alias("matrix"), catalog.is_spatial(["BUILDING", "MACHINERY"]).alias("spatial"))
