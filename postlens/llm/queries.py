"""The registered queries of this package and the SQL that checks them.

Each query applies its operator to its whole table and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bm25, bpe, hard_negatives, html_extract, mixing, pii, quality, runs, secret_scan, simhash, toxicity,
               url_filter)
from .common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to source shares proportional to the root of their size, over one epoch."""
    return mixing.mix(table(spark, sf_dir, "documents"))


#: The key of the checked query and pipeline, no secret; real corpora bring their own.
PII_KEY = "postlens"


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data pseudonymised."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


URL_RULES = [url_filter.Rule("net/", False), url_filter.Rule("example.net/en/", True),
             url_filter.Rule("example.com/de/", False), url_filter.Rule("org/fr/", True)]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url; the templates learn from the urls that the rules decide."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other documents for each document whose id is divisible by 100."""
    return bm25.search(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector; every seventh row gets the next label, as the contract has it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, a tenth of them with the repetition that the contract plants."""
    docs = table(spark, sf_dir, "documents")
    return runs.digests(runs.find_runs(docs.select("doc_id", runs.planted(F.col("text"), F.col("doc_id")).alias("text"))))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the kinds of the contract and well-known key formats."""
    return secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mix_sources, op2_pii, op3_url_filter, op4_ann, op5_simhash, op6_html, op7_bm25, op8_quality,
                            op9_bpe, op10_toxicity, op11_hard_negatives, op12_periodic_runs, op13_secret_scan)
}

_OP1 = """
WITH RECURSIVE units AS (
  SELECT source, sum(coalesce(length(text), 0) + 1) AS units FROM documents GROUP BY source),
totals AS (SELECT sum(units)::DOUBLE AS t, sum(pow(units::DOUBLE, 0.5)) AS s FROM units),
rates AS (SELECT source, round(pow(units::DOUBLE, 0.5) / s * t / units, 9) AS rate FROM units, totals),
dist AS (SELECT source, ceil(rate / 32)::INT AS parts, rate / greatest(ceil(rate / 32)::INT, 1) AS mean FROM rates),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM dist
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < 120),
cdfs AS (SELECT source, list(c ORDER BY k) AS c FROM cdf GROUP BY source),
keyed AS (
  SELECT d.*, coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) AS digest FROM documents d),
drawn AS (
  SELECT doc_id, text, lang, source, n_chars, digest,
         ('0x' || substr(md5('42|' || i || '|' || digest), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM keyed JOIN dist USING (source), unnest(range(1, parts + 1)) AS r(i)),
counts AS (
  SELECT doc_id, text, lang, source, n_chars, digest, sum(len(list_filter(c, lambda x: x < u)))::INT AS n
  FROM drawn JOIN cdfs USING (source) GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, r.copy::INT AS copy,
       md5('42:order|' || r.copy || '|' || digest) AS shuffle_key
FROM counts, unnest(range(1, n + 1)) AS r(copy)
"""

_OP7 = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT d.doc_id, coalesce(sum(tf), 0)::DOUBLE AS len FROM documents d LEFT JOIN tf USING (doc_id) GROUP BY ALL),
totals AS (SELECT count(*)::DOUBLE AS n, avg(len) AS mean FROM len),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY term),
scores AS (
  SELECT q.doc_id AS query_id, t.doc_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS score
  FROM tf q JOIN tf t USING (term) JOIN df USING (term) JOIN len ON len.doc_id = t.doc_id, totals
  WHERE q.doc_id % 100 = 0 AND t.doc_id <> q.doc_id GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores QUALIFY rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op1_mix_sources": _OP1, "op7_bm25": _OP7}
