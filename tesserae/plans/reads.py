"""Read-level expressions over texts and part names standing for reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import sequence as sq
from tesserae.functions.slices import parse_slices
from tesserae.operators import catalog, qc
from tesserae.plans.common import table
from tesserae.registry import query

#: A text of letters of a document as a read: what isn't a letter goes, the rest is mapped to bases.
BASES_FROM, BASES_TO = "abcdefghijklmnopqrstuvwxyz", "ACGTNACGTNACGTNACGTNACGTNA"
BASES_SQL = f"SELECT doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{BASES_FROM}', '{BASES_TO}') AS seq FROM documents"


def bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return table(spark, sf_dir, "documents").select("doc_id", F.translate(letters, BASES_FROM, BASES_TO).alias("seq"))


@query(f"""
WITH b AS ({BASES_SQL}) SELECT doc_id, substr(seq, 1, 12) AS cb, substr(seq, 13, 8) AS mi, reverse(substr(seq, 9, 12)) AS legacy, substr(seq, 1, 8) || substr(seq, 32, 8) AS joined, substr(seq, greatest(length(seq) - 4, 1), 5) AS tail FROM b
""")
def barcode_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    r1 = {"r1": F.col("seq")}
    x = {"cb": "r1[:12]", "mi": "r1[12:20]", "legacy": "r1[8:20][::-1]", "joined": "r1[0:8]+r1[31:39]", "tail": "r1[-5:]"}
    return bases(spark, sf_dir).select("doc_id", *[parse_slices(e, r1).alias(n) for n, e in x.items()])


#: The letters of whole texts with their places.
LETTERS_SQL = f"""b AS (SELECT doc_id, seq AS s FROM ({BASES_SQL}) WHERE length(seq) > 0), c AS (SELECT doc_id, unnest(string_split(s, '')) AS ch, generate_subscripts(string_split(s, ''), 1) AS i FROM b)"""


@query(f"""
WITH {LETTERS_SQL}, n AS (SELECT doc_id, ch, count(*) AS n FROM c GROUP BY ALL), t AS (SELECT doc_id, sum(n) AS total FROM n GROUP BY 1),
  e AS (SELECT doc_id, -sum(n / total::DOUBLE * log2(n / total::DOUBLE)) AS h FROM n JOIN t USING (doc_id) GROUP BY 1)
SELECT doc_id, round(h, 2) + 0.0 AS entropy, translate(reverse(s), 'ACGTN', 'TGCAN') AS reverse_complement FROM e JOIN b USING (doc_id)
""")
def barcode_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    return bases(spark, sf_dir).filter(F.length("seq") > 0).select("doc_id", sq.shannon_entropy(s).alias("entropy"), sq.reverse_complement(s).alias("reverse_complement"))


@query(f"""
WITH {LETTERS_SQL}, g AS (SELECT doc_id, i, CASE WHEN ch = lag(ch) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS start FROM c),
  r AS (SELECT doc_id, sum(start) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g), n AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL)
SELECT doc_id, sum(1 + length(n::VARCHAR))::BIGINT AS compressed, count(*) AS runs FROM n GROUP BY 1
""")
def barcode_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("seq")
    return bases(spark, sf_dir).filter(F.length("seq") > 0).select("doc_id", sq.compressed_length(s).cast("long").alias("compressed"), F.size(sq.runs(s)).cast("long").alias("runs"))


@query(f"""
WITH {LETTERS_SQL}, k AS (SELECT i, ch || lead(ch) OVER w || lead(ch, 2) OVER w AS kmer FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY i))
SELECT (i - 1)::BIGINT AS position, kmer, count(*) AS n FROM k WHERE kmer IS NOT NULL GROUP BY ALL
""")
def kmer_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.kmer_positions(bases(spark, sf_dir), "seq", 3).withColumn("position", F.col("position").cast("long"))


@query("""
WITH p AS (SELECT p_partkey, p_size % 41 AS q FROM part) SELECT p_partkey, q, ord(chr((33 + round_even(q / 10.0, 0) * 10)::INTEGER)) - 33 AS binned FROM p
""")
def quantized_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 41).alias("q"))
    return p.select("p_partkey", "q", (F.ascii(sq.quantize_quality(F.char((F.col("q") + 33).cast("long")))) - 33).alias("binned"))


@query("""
SELECT a.n_name AS a, b.n_name AS b, list_sum(list_transform(range(1, least(length(a.n_name), length(b.n_name)) + 1), lambda i: CASE WHEN substr(a.n_name, i, 1) = substr(b.n_name, i, 1) THEN 0 ELSE 1 END))::BIGINT AS distance
FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey
""")
def hamming_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    b = n.select(F.col("n_name").alias("b"), F.col("n_nationkey").alias("kb"), "n_regionkey")
    met = n.select(F.col("n_name").alias("a"), "n_nationkey", "n_regionkey").join(b, "n_regionkey").filter("n_nationkey < kb")
    return met.select("a", "b", sq.hamming(F.col("a"), F.col("b")).cast("long").alias("distance"))


CIGAR_SHAPES = ("{k}S{q}M{k}N{r}M", "{q}M{k}I{r}M{k}S", "{k}S{q}M", "{q}M{k}D{r}M", "{k}H{k}S{r}M{k}S{k}H", "{q}M")


def _cigar_sql() -> str:
    parts = {"k": "l_linenumber", "q": "l_quantity::INTEGER", "r": "(l_quantity::INTEGER + l_partkey % 9)"}
    cases = []
    for i, shape in enumerate(CIGAR_SHAPES):
        text = shape
        for n, v in parts.items():
            text = text.replace("{" + n + "}", f"' || {v} || '")
        cases.append(f"WHEN {i} THEN '{text}'")
    return f"CASE l_suppkey % {len(CIGAR_SHAPES)} {' '.join(cases)} END"


@query(f"""
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, {_cigar_sql()} AS cigar FROM lineitem), o AS (SELECT *, regexp_extract_all(cigar, '[0-9]+[A-Z]') AS parts FROM c),
  p AS (SELECT *, list_transform(parts, lambda x: right(x, 1)) AS ops, list_transform(parts, lambda x: left(x, length(x) - 1)::INTEGER) AS ns FROM o),
  m AS (SELECT *, list_filter(list_transform(range(1, len(ops) + 1), lambda i: CASE WHEN ops[i] = 'M' THEN ns[i] END), lambda x: x IS NOT NULL) AS ms, list_filter(list_transform(range(2, len(ops) + 1), lambda i: CASE WHEN ops[i] = 'S' THEN ns[i] END), lambda x: x IS NOT NULL) AS later FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(ops, '') AS ops, list_max(ms) AS n_match, list_sum(ms)::INTEGER AS total_match, CASE WHEN ops[1] = 'S' THEN ns[1] ELSE 0 END AS clip5, coalesce(later[-1], 0) AS clip3 FROM m
""")
def cigar_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments of six shapes."""
    s = lambda c: c.cast("string")
    values = {"k": s(F.col("l_linenumber")), "q": s(F.col("l_quantity").cast("int")), "r": s(F.col("l_quantity").cast("int") + F.col("l_partkey") % 9)}
    cigar = F.lit("")
    for i, shape in enumerate(CIGAR_SHAPES):
        text = F.lit(shape)
        for n, v in values.items():
            text = F.replace(text, F.lit("{" + n + "}"), v)
        cigar = F.when(F.col("l_suppkey") % len(CIGAR_SHAPES) == i, text).otherwise(cigar)
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", cigar.alias("cigar"))
    ops = F.array_join(F.transform(sq.cigar_ops(F.col("cigar")), lambda o: o["op"]), "")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", ops.alias("ops"), sq.cigar_summary(F.col("cigar")).alias("s")).select("l_orderkey", "l_linenumber", "l_partkey", "ops", *[F.col(f"s.{c}").alias(c) for c in ("n_match", "total_match", "clip5", "clip3")])


@query("""
WITH x AS (SELECT c_nationkey, c_mktsegment FROM customer), n AS (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1),
  m AS (SELECT n_regionkey, c_mktsegment AS mode, count(DISTINCT n_nationkey) AS k FROM nation JOIN x ON n_nationkey = c_nationkey GROUP BY ALL)
SELECT n_regionkey, list(mode ORDER BY mode)::VARCHAR AS run_modes FROM m JOIN n USING (n_regionkey) WHERE k = n GROUP BY 1
""")
def shared_run_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.collect_set("c_mktsegment").alias("run_modes"))
    samples = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").join(seg, "n_nationkey", "left").withColumn("run_modes", F.coalesce("run_modes", F.array().cast("array<string>")))
    out = catalog.shared_run_modes(samples, ["n_regionkey"])
    return out.select("n_regionkey", F.concat(F.lit("["), F.array_join("run_modes", ", "), F.lit("]")).alias("run_modes"))


@query("SELECT source, lang, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY ALL")
def united_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    part = F.coalesce(F.pmod("doc_id", F.lit(3)), F.lit(0))
    every = docs.filter(part == 0).unionByName(docs.filter(part == 1)).unionByName(docs.filter(part == 2))
    return every.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))
