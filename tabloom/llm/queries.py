"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (ann, divergence, exact_dedup, license_scan, lm, mixing, near_dedup, packing,
                         pii, quality, set_join, url_filter, whiten)
from tabloom.llm.common import LOWER, UPPER, WORD_PATTERN_SQL, table

# The rules of the URL contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block")]

# The registered query's key; a caller passes a secret of their own.
PII_KEY = b"registered query"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op1_lm_score")
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, and its unigram base."""
    return lm.score(table(spark, sf_dir, "documents"))


@register("op2_exact_dedup", f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision on every document: which of equal texts stays."""
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


@register("op3_pii_surrogates")
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    return pii.replace_entities(table(spark, sf_dir, "documents"), PII_KEY)


_URL_SQL = """
WITH a AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages),
b AS (
  SELECT page_id, u, CASE WHEN strpos(u, '://') > 0
         THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM a),
c AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
d AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '')
         || regexp_replace(path, '/+$', '') END AS canon FROM c),
l AS (
  SELECT DISTINCT canon FROM d WHERE canon IS NOT NULL AND strpos(u, 'utm_source=') > 0),
e AS (
  SELECT d.*, l.canon IS NOT NULL AS listed,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
           THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/')
           THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM d LEFT JOIN l ON d.canon = l.canon)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM e""".format(upper=UPPER, lower=LOWER)


@register("op4_url_filter", _URL_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page.  The list: URLs that the table shows with a
    campaign tag (``utm_source``), in canonical form."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.select("url").where(F.contains(F.col("url"), F.lit("utm_source=")))
    return url_filter.judge_urls(pages, URL_RULES, listed)


_MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN_SQL}'))::BIGINT AS size
  FROM documents),
o AS (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
             greatest(length(bin(size)) - 1, 0) AS octave FROM d),
b AS (SELECT *, CASE WHEN size < 2 THEN size
             ELSE octave * 4 + (size * 2) // (1::BIGINT << octave) END AS band FROM o),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]
             ::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total,
        coalesce(sum(cap) OVER w, 0) AS full_before, coalesce(sum(weight) OVER w, 0) AS weight_before,
        sum(weight) OVER () AS weight_all FROM r
      WINDOW w AS (ORDER BY cap / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (total - full_before) / (weight_all - weight_before) AS level FROM f),
h AS (SELECT level AS lvl FROM g WHERE weight * level < cap ORDER BY cap / weight LIMIT 1),
t AS (SELECT source, source_size,
        least(cap, weight * coalesce((SELECT lvl FROM h), 1e300::DOUBLE))::DOUBLE AS target FROM g),
p AS (SELECT b.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY b.source ORDER BY band, k, doc_id) AS i,
        ('0x' || substr(md5('0:' || coalesce(b.source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
      FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(u + i * rate) - floor(u + (i - 1) * rate))::BIGINT * size)::BIGINT AS taken,
  (floor(u + i * rate) - floor(u + (i - 1) * rate))::BIGINT AS copies, source
FROM p"""


@register("op5_mixing", _MIX_SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies and words that the mix takes of every document."""
    return mixing.copies(table(spark, sf_dir, "documents"))


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document, with coverage and spans."""
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


@register("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@register("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under shingle similarity of 0.85."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, threshold and decision of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_DIVERGENCE_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
t AS (SELECT lang, source, r, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term)
      GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c FROM g JOIN k ON k.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
n AS (SELECT lang, source, sum(c) AS n FROM f GROUP BY lang, source),
p AS (SELECT f.lang, f.source, f.term, f.c,
             1 + (1000000000::HUGEINT * (f.c + 2)) // (n.n + 2 * v.v) AS p
      FROM f JOIN n ON n.lang = f.lang AND n.source = f.source JOIN v ON v.lang = f.lang),
w AS (SELECT lang, term, sum(c) AS c FROM f GROUP BY lang, term),
wn AS (SELECT lang, sum(c) AS n FROM w GROUP BY lang),
q AS (SELECT w.lang, w.term, 1 + (1000000000::HUGEINT * (w.c + 2)) // (wn.n + 2 * v.v) AS q
      FROM w JOIN wn ON wn.lang = w.lang JOIN v ON v.lang = w.lang),
ps AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS s
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
       GROUP BY a.lang, a.source, b.source),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(ps.s, 0) AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN ps ON ps.lang = a.lang AND ps.source = a.source AND ps.item = b.source),
tm AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item,
              ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS value
       FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p.p > q.q),
u AS (SELECT * FROM pr UNION ALL SELECT * FROM tm),
x AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM x
WHERE part = 'pair' OR rank <= 10"""


@register("op11_divergence", _DIVERGENCE_SQL)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of a language's sources, and the terms that set each apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight principal axes, whitened."""
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_jaccard_join")
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and links of every document under shingle similarity of 0.8."""
    return set_join.join_groups(table(spark, sf_dir, "documents"))
