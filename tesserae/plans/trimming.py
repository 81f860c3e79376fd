"""Preprocessing of reads: turns of conversations as reads, their letters as bases and a quality for every base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.operators import reads
from tesserae.plans.common import table
from tesserae.plans.reads import BASES_FROM, BASES_TO
from tesserae.registry import query

#: What quality a base has, as its character: 40, 20, 2, 10 and 0.
QUALITY_FROM, QUALITY_TO = "ACGTN", "I5#+!"
READS_SQL = f"""SELECT conv_id * 1000 + turn AS id, seq, translate(seq, '{QUALITY_FROM}', '{QUALITY_TO}') AS qual
  FROM (SELECT conv_id, turn, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '{BASES_FROM}', '{BASES_TO}') AS seq FROM conversations)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    seq = F.translate(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", ""), BASES_FROM, BASES_TO)
    own = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), seq.alias("r2"))
    return own.select("id", F.col("id").alias("record_no"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("qname"), F.substring("r2", 1, 28).alias("r1"), F.translate(F.substring("r2", 1, 28), QUALITY_FROM, QUALITY_TO).alias("q1"), "r2", F.translate("r2", QUALITY_FROM, QUALITY_TO).alias("q2"))


def cut_sql(value: str) -> str:
    """Bases cut from the end: where the running sum of value (of b: base, p: quality score) is largest, first of equals, before it falls below 0."""
    return f"""
  c AS (SELECT id, unnest(range(1, length(seq) + 1)) AS j, string_split(reverse(seq), '') AS bs, string_split(reverse(qual), '') AS qs FROM r),
  x AS (SELECT id, j, bs[j] AS b, ord(qs[j]) - 33 AS p FROM c), s AS (SELECT id, j, sum({value}) OVER (PARTITION BY id ORDER BY j) AS s FROM x),
  v AS (SELECT *, min(s) OVER (PARTITION BY id ORDER BY j) AS low FROM s),
  cut AS (SELECT id, first(j ORDER BY s DESC, j) AS n FROM v WHERE s > 0 AND low >= 0 GROUP BY 1)"""


#: Tails of A: 1 for it and -2 for others, at most a fifth others, three bases at least.
TAIL_SQL = """
  c AS (SELECT id, unnest(range(1, length(seq) + 1)) AS j, string_split(reverse(seq), '') AS bs FROM r), x AS (SELECT id, j, CASE WHEN bs[j] = 'A' THEN 0 ELSE 1 END AS o FROM c),
  v AS (SELECT id, j, sum(1 - 3 * o) OVER w AS s, sum(o) OVER w AS others FROM x WINDOW w AS (PARTITION BY id ORDER BY j)),
  cut AS (SELECT id, first(j ORDER BY s DESC, j) AS n FROM v WHERE s > 0 AND others * 5 <= j GROUP BY 1 HAVING first(j ORDER BY s DESC, j) >= 3)"""


def trimmed(df: DataFrame) -> DataFrame:
    return df.select("id", "r2", F.length("q2").alias("n_qual"), F.array_join("a5", ",").alias("a5"), F.array_join(F.col("t5").cast("array<string>"), ",").alias("t5"), F.array_join("a3", ",").alias("a3"), F.array_join(F.col("t3").cast("array<string>"), ",").alias("t3"))


def end_sql(name: str) -> str:
    return f"""SELECT r.id, substr(seq, 1, length(seq) - coalesce(n, 0)) AS r2, (length(seq) - coalesce(n, 0))::INTEGER AS n_qual, '' AS a5, '' AS t5,
  CASE WHEN n > 0 THEN '{name}' ELSE '' END AS a3, CASE WHEN n > 0 THEN n::VARCHAR ELSE '' END AS t3 FROM r LEFT JOIN cut ON r.id = cut.id"""


@query(f"WITH r AS ({READS_SQL}), {cut_sql('25 - p')} {end_sql('Q')}")
def quality_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trimmed(reads.quality(right=25)(turns(spark, sf_dir)))


@query(f"WITH r AS ({READS_SQL}), {cut_sql('CASE WHEN b = chr(71) THEN 1 ELSE 30 - p END')} {end_sql('NextQ')}")
def nextseq_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trimmed(reads.nextseq_quality(30)(turns(spark, sf_dir)))


@query(f"WITH r AS ({READS_SQL}), {TAIL_SQL} {end_sql('polyA')}")
def poly_a_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trimmed(reads.poly_a()(turns(spark, sf_dir)))


@query(f"""WITH r AS (SELECT id, seq || repeat('A', id % 30) || CASE WHEN id % 2 = 0 THEN 'G' ELSE '' END AS seq FROM ({READS_SQL})), {TAIL_SQL} {end_sql('polyA')}""")
def long_tails_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with tails of known lengths, some with another base behind."""
    tail = F.concat(F.repeat(F.lit("A"), (F.col("id") % 30).cast("int")), F.when(F.col("id") % 2 == 0, "G").otherwise(""))
    own = turns(spark, sf_dir).withColumns({"r2": F.concat("r2", tail), "q2": F.concat("q2", F.regexp_replace(tail, ".", "I"))})
    return trimmed(reads.poly_a()(own))


ADAPTER = "NCNAT"


def adapter_sql(found: str, head: bool) -> str:
    """found: bases to cut. A match of the whole adapter, or of three or more of its bases at the read's end."""
    kept = "substr(seq, n + 1)" if head else "substr(seq, 1, length(seq) - n)"
    a5, a3 = ("'X'", "''") if head else ("''", "'X'")
    t5, t3 = ("n::VARCHAR", "''") if head else ("''", "n::VARCHAR")
    return f"""SELECT id, {kept} AS r2, (length(seq) - n)::INTEGER AS n_qual, CASE WHEN n > 0 THEN {a5} ELSE '' END AS a5, CASE WHEN n > 0 THEN {t5} ELSE '' END AS t5, CASE WHEN n > 0 THEN {a3} ELSE '' END AS a3, CASE WHEN n > 0 THEN {t3} ELSE '' END AS t3
  FROM (SELECT *, {found} AS n FROM ({READS_SQL}))"""


@query(adapter_sql(f"CASE WHEN contains(seq, '{ADAPTER}') THEN length(seq) - instr(seq, '{ADAPTER}') + 1 WHEN right(seq, 4) = '{ADAPTER[:4]}' THEN 4 WHEN right(seq, 3) = '{ADAPTER[:3]}' THEN 3 ELSE 0 END", False))
def adapter_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trimmed(reads.adapter("X", ADAPTER, max_errors=0.0)(turns(spark, sf_dir)))


@query(adapter_sql(f"CASE WHEN contains(seq, '{ADAPTER}') THEN length(seq) - instr(reverse(seq), reverse('{ADAPTER}')) + 1 WHEN left(seq, 4) = '{ADAPTER[1:]}' THEN 4 WHEN left(seq, 3) = '{ADAPTER[2:]}' THEN 3 ELSE 0 END", True))
def head_adapter_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trimmed(reads.adapter("X", ADAPTER, "left", max_errors=0.0)(turns(spark, sf_dir)))


@query(f"SELECT id, substr(seq, 4, greatest(length(seq) - 5, 0)) AS r2, substr(qual, 4, greatest(length(seq) - 5, 0)) AS q2 FROM ({READS_SQL})")
def clipped_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.clip(3, 2)(turns(spark, sf_dir)).select("id", "r2", "q2")


@query(f"SELECT id, 'r' || id AS qname, translate(qual, 'I5#+!', 'I5!+!') AS q2 FROM ({READS_SQL})")
def renamed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by record, qualities in steps of ten."""
    return reads.preprocessed(turns(spark, sf_dir), "simple_name:prefix=r;qquant").select("id", "qname", "q2")


@query(f"SELECT id, seq FROM ({READS_SQL}) WHERE length(seq) >= 300")
def long_enough_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.long_enough(turns(spark, sf_dir), 300).select("id", F.col("r2").alias("seq"))


PIPELINE_SQL = f"""r AS (SELECT id, substr(seq, 4) AS seq, substr(qual, 4) AS qual, substr(seq, 1, 28) AS r1 FROM ({READS_SQL})), {TAIL_SQL}"""


@query(f"WITH {PIPELINE_SQL} SELECT r.id, substr(seq, 1, length(seq) - coalesce(n, 0)) AS r2, substr(r1, 1, 12) AS cb, substr(r1, 13, 8) AS mi FROM r LEFT JOIN cut ON r.id = cut.id")
def preprocessed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flavour's steps: clip, tails, and barcodes last."""
    out = reads.preprocessed(turns(spark, sf_dir), [("clip", {"left": 3}), ("polyA", {})])
    return out.select("id", "r2", F.col("CB").alias("cb"), F.col("MI").alias("mi"))


@query(f"""WITH {PIPELINE_SQL}, m AS (SELECT r.id, length(seq) AS l, coalesce(n, 0) AS n FROM r LEFT JOIN cut ON r.id = cut.id), o AS (SELECT length(seq) AS l FROM ({READS_SQL})),
  y AS (SELECT 'reads' AS measure, 'N' AS name, 'input' AS value, count(*) AS c FROM m UNION ALL SELECT 'reads', 'N', 'output', count(*) FILTER (l - n >= 18) FROM m UNION ALL SELECT 'bases', 'L_in', l::VARCHAR, count(*) FROM o GROUP BY l
    UNION ALL SELECT 'bases', 'L_out', (l - n)::VARCHAR, count(*) FROM m GROUP BY l - n UNION ALL SELECT 'reads', 'A3', 'polyA', count(*) FROM m WHERE n > 0 UNION ALL SELECT 'bases', 'polyA', n::VARCHAR, count(*) FROM m WHERE n > 0 GROUP BY n
    UNION ALL SELECT 'bases', 'polyA', 'A3_total', sum(n)::BIGINT FROM m WHERE n > 0)
SELECT 's' AS sample, measure, name, value, c AS count FROM y WHERE c > 0""")
def preprocessing_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = turns(spark, sf_dir)
    after = reads.preprocessed(before, [("clip", {"left": 3}), ("polyA", {})])
    return reads.preprocessing_stats(before, after, "s", reads.long_enough(after))
