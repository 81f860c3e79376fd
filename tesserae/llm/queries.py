"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import table
from tesserae.llm.exact_dedup import arrivals, exact_groups
from tesserae.llm.html_text import extracted, learn_weights
from tesserae.llm.lookup_sketch import fingerprints
from tesserae.llm.mixing import mixture
from tesserae.llm.packing import pack
from tesserae.llm.quality import quality_scores, train
from tesserae.llm.secrets import learned_words, secret_spans
from tesserae.llm.simhash import near_components
from tesserae.llm.substring_dedup import without_repeats
from tesserae.llm.token_count import token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3).drop("source")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1_mixing that SQL can express."""
    return op1_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def _filled(rounds: int) -> str:
    """Common table expressions: what a unit of weight gets, after so many rounds of filling the sources above their cap."""
    out = "u0 AS (SELECT sum(w) / sum(weight) AS u FROM src)"
    for i in range(rounds):
        out += f",\n  u{i + 1} AS (SELECT coalesce((sum(w) - coalesce(sum(cap) FILTER (cap <= u * weight), 0)) / sum(weight) FILTER (cap > u * weight), 'inf'::DOUBLE) AS u FROM src, u{i} GROUP BY u)"
    return out


MIXING_SQL = f"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
  own AS (SELECT source, sum(size) AS w, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM docs GROUP BY 1),
  src AS (SELECT *, [5, 2, 1][(i % 3 + 1)::INTEGER]::DOUBLE AS weight, 3.0 * w AS cap FROM own),
  {_filled(12)}
SELECT doc_id, size, w::BIGINT AS source_size, round(least(cap, u * weight), 3) AS target FROM docs JOIN src ON docs.source IS NOT DISTINCT FROM src.source, u12
"""


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, learn_weights(pages))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    docs = table(spark, sf_dir, "documents")
    found = F.col("found")
    of = {k: F.size(F.filter(found, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")}  # noqa: B023
    base = F.filter(found, lambda s: s["kind"] != "novel")
    return secret_spans(docs, learned=learned_words(docs)).select("doc_id", *of.values(), F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"))


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op4_secrets that SQL can express."""
    return op4_secrets(spark, sf_dir).drop("spans")


def _marked(kind: str, order: int, pattern: str, test: str) -> str:
    """Spans of a pattern: matches are put between control characters, and lengths of what is before add up."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, {order} AS o, s, s + e AS e, m FROM (
    SELECT doc_id, i, p, (sum(length(p) - CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) - length(p) + 1)::BIGINT AS s, instr(p, chr(2)) - 1 AS e, substr(p, 1, instr(p, chr(2)) - 1) AS m
    FROM (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '{pattern}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS ps FROM documents WHERE text IS NOT NULL)))
  WHERE i > 1 AND {test}"""


ASSIGN_SQL = """((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRETS_SQL = f"""
WITH spans AS ({_marked("assign", 0, ASSIGN_SQL, f"length(regexp_extract(m, '{ASSIGN_SQL}', 2)) >= 8")}
  UNION ALL {_marked("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 16")}
  UNION ALL {_marked("hex", 2, "[0-9a-f]{32,}", "true")}),
  per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS b FROM spans GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256 FROM documents LEFT JOIN per USING (doc_id)
"""


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), window=1024)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), window=50)


OP8_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  placed AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50),
  win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s FROM placed),
  seen AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
  hit AS (SELECT doc_id, i FROM win JOIN seen USING (s) WHERE first < doc_id),
  gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(50)) AS k FROM hit)),
  word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
  kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the id range stands for the immutable snapshot, the other rows for the batch that comes in."""
    return exact_groups(*arrivals(table(spark, sf_dir, "documents")))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1_mixing,
        "mixing_targets": mixing_targets,
        "op2_html_text": op2_html_text,
        "op3_fingerprints": op3_fingerprints,
        "op4_secrets": op4_secrets,
        "secrets_base": secrets_base,
        "op5_simhash": op5_simhash,
        "op6_quality": op6_quality,
        "op7_packing": op7_packing,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_exact_dedup": op10_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"mixing_targets": MIXING_SQL, "secrets_base": SECRETS_SQL, "op8_substring_dedup": OP8_SQL, "op10_exact_dedup": OP10_SQL}
