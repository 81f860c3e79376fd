"""Long-read signatures: a user's events of a day, in order, as the parts of a read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.operators import longread, qc
from tesserae.plans.common import table
from tesserae.registry import query

READS_SQL = """
e AS (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS qname, event_type, ts, event_id, value FROM events),
  k AS (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY ts, event_id) AS i FROM e),
  r AS (SELECT qname, list(event_type ORDER BY i) AS sig FROM k GROUP BY 1)"""


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("qname", F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")))
    k = e.withColumn("i", F.row_number().over(Window.partitionBy("qname").orderBy("ts", "event_id")))
    parts = F.array_sort(F.collect_list(F.struct((F.col("i") * 10).alias("start"), (F.col("i") * 10 + 5).alias("end"), F.col("event_type").alias("oligo"), F.col("value").alias("score"))))
    return k.groupBy("qname").agg((F.max("i") * 10 + 20).alias("L"), parts.alias("parts")).withColumn("signature", F.transform("parts", lambda p: p["oligo"]))


@query(f"""
WITH {READS_SQL.replace("list(event_type ORDER BY i) AS sig", "list(event_type || CASE WHEN event_id % 2 = 0 THEN '' ELSE '_RC' END ORDER BY i) AS sig")},
  t AS (SELECT sig, len(sig) > 1 AND CASE WHEN sig[1] LIKE '%_RC' THEN left(sig[1], length(sig[1]) - 3) ELSE sig[1] || '_RC' END = sig[-1] AS re FROM r)
SELECT 'reprimed' AS kind, replace(sig[1], '_RC', '') AS part, count(*) AS n FROM t WHERE re GROUP BY ALL UNION ALL
SELECT 'with view_RC and no error', '', count(*) FROM t WHERE contains(array_to_string(sig, ','), 'view_RC') AND NOT contains(array_to_string(sig, ','), 'error')
""")
def reprimed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of either strand: reads that end in the reverse of their start, and reads by what their signature holds."""
    s = stranded(spark, sf_dir)
    held = longread.with_signatures(s, "view_RC", "error").agg(F.lit("with view_RC and no error").alias("kind"), F.lit("").alias("part"), F.count("*").alias("n"))
    return longread.repriming_counts(s.filter(F.size("signature") > 1)).select(F.lit("reprimed").alias("kind"), "part", "n").unionByName(held)


def stranded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads whose parts from records of odd numbers are reversed."""
    e = table(spark, sf_dir, "events").withColumn("qname", F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")))
    name = F.concat("event_type", F.when(F.col("event_id") % 2 == 0, "").otherwise("_RC"))
    parts = F.array_sort(F.collect_list(F.struct("ts", "event_id", name.alias("oligo"))))
    return e.groupBy("qname").agg(F.transform(parts, lambda p: p["oligo"]).alias("signature"))


@query(f"""
WITH {READS_SQL.replace("list(event_type ORDER BY i) AS sig", "list(event_type || CASE WHEN event_id % 2 = 0 THEN '' ELSE '_RC' END ORDER BY i) AS sig")},
  a AS (SELECT qname, unnest(sig) AS part, generate_subscripts(sig, 1) AS i, sig FROM r), b AS (SELECT *, CASE WHEN i > 1 AND part = sig[i - 1] THEN 1 ELSE 0 END AS again FROM a),
  rep AS (SELECT qname, part, count(*) AS n, min(i) AS first FROM b WHERE again = 1 GROUP BY ALL), top AS (SELECT qname, part FROM rep QUALIFY row_number() OVER (PARTITION BY qname ORDER BY n DESC, first) = 1)
SELECT CASE WHEN top.part IS NULL THEN array_to_string(sig, ',') ELSE '?' || replace(top.part, '_RC', '') || '+' END AS signature, count(*) AS n,
  count(*) FILTER (len(sig) > 1 AND CASE WHEN sig[1] LIKE '%_RC' THEN left(sig[1], length(sig[1]) - 3) ELSE sig[1] || '_RC' END = sig[-1]) AS reprimed, top.part IS NOT NULL AS concatemer FROM r LEFT JOIN top USING (qname) GROUP BY ALL
""")
def stranded_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longread.signature_counts(stranded(spark, sf_dir))


@query(f"""
WITH {READS_SQL}, a AS (SELECT qname, unnest(sig) AS part, generate_subscripts(sig, 1) AS i, sig FROM r), rep AS (SELECT qname, part, count(*) AS n, min(i) AS first FROM a WHERE i > 1 AND part = sig[i - 1] GROUP BY ALL),
  top AS (SELECT qname, part FROM rep QUALIFY row_number() OVER (PARTITION BY qname ORDER BY n DESC, first) = 1)
SELECT '?' || part || '+' AS part, count(*) AS n FROM top GROUP BY ALL
""")
def concatenated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longread.concatenation_counts(longread.signature_counts(signatures(spark, sf_dir)))


@query(f"WITH {READS_SQL}, p AS (SELECT event_type AS oligo, i, value FROM k), a AS (SELECT oligo, unnest(['start', 'end', 'len', 'score']) AS attr, unnest([i * 10.0, i * 10.0 + 5, 5.0, value]) AS value FROM p) SELECT oligo, attr, value, count(*) AS n FROM a GROUP BY ALL")
def part_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, end, length and score of every part."""
    return longread.part_histograms(signatures(spark, sf_dir)).groupBy("oligo", "attr", "value").agg(F.sum("freq").alias("n"))


@query(f"""
WITH {READS_SQL}, m AS (SELECT event_type, value FROM events), f AS (SELECT * FROM (VALUES ('view', 2.0 * 30 * 0.4), ('click', 2.0 * 50 * 0.4)) t(event_type, floor))
SELECT event_type AS oligo, count(*) AS n, round(min(value), 6) AS least FROM m LEFT JOIN f USING (event_type) WHERE value > coalesce(floor, 22) AND event_type IN ('view', 'click', 'purchase') GROUP BY 1
""")
def relevant_oligos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches above their oligo's floor, of relevant oligos."""
    m = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("qname"), F.col("event_type").alias("oligo"), F.col("value").alias("score"))
    out = longread.relevant_matches(m, {"view": "A" * 30, "click": "C" * 50}, relevant=["view", "click", "purchase"])
    return out.groupBy("oligo").agg(F.count("*").alias("n"), F.round(F.min("score"), 6).alias("least"))


@query(f"""
WITH {READS_SQL}, x AS (SELECT qname, CASE WHEN list_bool_or(list_transform(range(2, len(sig) + 1), lambda i: sig[i] = sig[i - 1])) THEN 'again' ELSE array_to_string(sig, ',') END AS signature FROM r)
SELECT qname, signature FROM x WHERE signature <> 'again' QUALIFY row_number() OVER (PARTITION BY signature ORDER BY qname) <= 3
""")
def signature_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three reads of every signature without repeats (a top-k report)."""
    s = signatures(spark, sf_dir).withColumn("seq", F.lit("A"))
    return longread.examples(s, n=3).filter(~F.col("signature").contains("+")).select("qname", "signature")


@query("SELECT s_suppkey::BIGINT AS sample, row_number() OVER (ORDER BY nullif(s_nationkey, 3) NULLS LAST, s_name) AS place FROM supplier")
def ordered_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by the priority of their signature, those without one last."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sample"), "s_name", F.nullif("s_nationkey", F.lit(3)).alias("prio"))
    rows = longread.sample_order(s, "s_name").collect()
    return spark.createDataFrame([(r["sample"], i) for i, r in enumerate(rows, 1)], "sample long, place long")


@query(f"""
WITH {READS_SQL}, a AS (SELECT qname, unnest(sig) AS part, generate_subscripts(sig, 1) AS i, sig FROM r),
  b AS (SELECT *, CASE WHEN i > 1 AND part = sig[i - 1] THEN 1 ELSE 0 END AS again FROM a),
  rep AS (SELECT qname, part, count(*) AS n, min(i) AS first FROM b WHERE again = 1 GROUP BY ALL), top AS (SELECT qname, part FROM rep QUALIFY row_number() OVER (PARTITION BY qname ORDER BY n DESC, first) = 1)
SELECT CASE WHEN top.part IS NULL THEN array_to_string(sig, ',') ELSE '?' || top.part || '+' END AS signature, count(*) AS n, 0::BIGINT AS reprimed, top.part IS NOT NULL AS concatemer FROM r LEFT JOIN top USING (qname) GROUP BY ALL
""")
def signature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longread.signature_counts(signatures(spark, sf_dir))


INTACT = ["view", "click", "purchase"]


@query(f"""
WITH {READS_SQL} SELECT CASE WHEN contains(s, 'view,click,purchase') THEN 'view,click,purchase' WHEN contains(s, 'view,click') THEN 'view,click' WHEN contains(s, 'view') THEN 'view' ELSE '' END AS prefix, count(*) AS n FROM (SELECT array_to_string(sig, ',') AS s FROM r) GROUP BY 1
""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longread.completeness(signatures(spark, sf_dir), INTACT)


@query(f"""
WITH {READS_SQL}, p AS (SELECT qname, i, event_type AS a, lead(event_type) OVER (PARTITION BY qname ORDER BY i) AS b FROM k),
  h AS (SELECT qname, min(i) AS i FROM p WHERE a = 'view' AND b = 'click' GROUP BY 1)
SELECT r.qname, h.i * 10 + 5 AS gap_start, h.i * 10 + 10 AS gap_end FROM r LEFT JOIN h USING (qname)
""")
def pair_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longread.between(signatures(spark, sf_dir), "view", "click").select("qname", F.col("gap_start").cast("long").alias("gap_start"), F.col("gap_end").cast("long").alias("gap_end"))


@query(f"""
WITH {READS_SQL}, f AS (SELECT qname, event_type AS oligo, i FROM k)
SELECT qname, min(i) * 10 AS "start", min(i) * 10 + 5 AS "end" FROM f WHERE oligo = 'purchase' GROUP BY 1
""")
def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longread.first_occurrence(signatures(spark, sf_dir), "purchase").select("qname", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query(f"""
WITH {READS_SQL}, s AS (SELECT array_to_string(sig, ',') AS s, list_distinct(sig) AS u FROM r),
  x AS (SELECT s, list_sort(list_filter(['click', 'purchase', 'view'], lambda c: list_contains(u, c))) AS there, list_sort(list_filter(['click', 'purchase', 'view'], lambda c: NOT list_contains(u, c))) AS missing, list_sort(list_filter(u, lambda c: NOT list_contains(['click', 'purchase', 'view'], c))) AS extra FROM s)
SELECT CASE WHEN s = 'view,click,purchase' THEN 'complete' ELSE CASE WHEN len(missing) <= len(there) THEN 'missing_' || array_to_string(missing, ',') ELSE 'only_' || array_to_string(there, ',') END || CASE WHEN len(extra) > 0 THEN '_extra_' || array_to_string(extra, ',') ELSE '' END END AS name, count(*) AS n FROM x GROUP BY 1
""")
def relative_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = signatures(spark, sf_dir).select(qc.relative_name(F.array_join("signature", ","), INTACT).alias("name"))
    return s.groupBy("name").agg(F.count("*").alias("n"))


@query(f"""
WITH {READS_SQL}, f AS (SELECT qname, CASE WHEN contains(s, 'view') THEN 1 ELSE 0 END AS v, s FROM (SELECT qname, array_to_string(sig, ',') AS s FROM r)),
  c AS (SELECT CASE WHEN contains(s, 'view,click,purchase') THEN 3 WHEN contains(s, 'view,click') THEN 2 WHEN contains(s, 'view') THEN 1 ELSE 0 END AS d FROM f), n AS (SELECT p AS parts, count(*) AS n FROM c, range(1, 4) t(p) WHERE d >= p GROUP BY 1)
SELECT parts, n, round(coalesce(n / lag(n) OVER (ORDER BY parts), 1), 6) AS rate FROM n
""")
def synthesis_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = longread.completeness(signatures(spark, sf_dir), INTACT).filter("prefix <> ''")
    up = F.transform(F.sequence(F.lit(1), F.size(F.split("prefix", ","))), lambda i: F.array_join(F.slice(F.split("prefix", ","), F.lit(1), i), ","))
    found = c.select(F.explode(up).alias("name"), "n").groupBy("name").agg(F.sum("n").alias("n"))
    return longread.synthesis_rates(found).select(F.col("parts").cast("long").alias("parts"), "n", F.round("rate", 6).alias("rate"))


@query(f"WITH {READS_SQL} SELECT event_type AS oligo, i * 10.0 AS value, count(*) AS n FROM k GROUP BY ALL")
def part_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = longread.part_histograms(signatures(spark, sf_dir)).filter("attr = 'start'")
    return h.groupBy("oligo", "value").agg(F.sum("freq").alias("n"))

