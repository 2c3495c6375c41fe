"""The registered queries of this subpackage, opN_<name>, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, jaccard, line_dedup, packing, pii, quality, secret_scan, substring, token_counts, url_filter
from .common import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_words=50)
    return out.select("doc_id", "n_lines", "n_removed", "longest_run", "lcp_lines", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.i AS i, u.x AS x, regexp_matches(u.x, '[^\x20\x09-\x0D]') AS w
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {'i': i, 'x': x})) AS u FROM documents)
), numbered AS (
  SELECT *, sum(w::INT) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM lines
), seq AS (
  SELECT doc_id, list(x ORDER BY i) AS ls FROM numbered WHERE w GROUP BY doc_id
), suffixes AS (
  SELECT doc_id, p, ls[p:] AS s FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM seq)
), sorted AS (
  SELECT doc_id, s, lag(s) OVER (ORDER BY s, doc_id, p) AS prev, row_number() OVER (ORDER BY s, doc_id, p) AS rk FROM suffixes
), neighbours AS (
  SELECT doc_id, rk, coalesce(list_position(list_transform(list_zip(s, coalesce(prev, [])), lambda x: x[1] IS DISTINCT FROM x[2]), true) - 1, len(s)) AS c FROM sorted
), lcp AS (
  SELECT doc_id, max(greatest(c, n)) AS lcp_lines FROM (SELECT doc_id, c, coalesce(lead(c) OVER (ORDER BY rk), 0) AS n FROM neighbours) GROUP BY doc_id
), later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s[1], s[2] ORDER BY doc_id, p) AS r FROM suffixes WHERE len(s) >= 2
  ) WHERE r > 1
), lone AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY s[1] ORDER BY doc_id, p) AS r FROM suffixes WHERE len(regexp_extract_all(s[1], '[^\x20\x09-\x0D]+')) >= 50
  ) WHERE r > 1
), gone AS (
  SELECT doc_id, p + o AS p FROM later, (SELECT unnest([0, 1]) AS o) UNION SELECT doc_id, p FROM lone
), islands AS (
  SELECT doc_id, max(c) AS longest_run, sum(c) AS n_removed FROM (
    SELECT doc_id, count(*) AS c FROM (SELECT doc_id, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone) GROUP BY doc_id, g
  ) GROUP BY doc_id
), kept AS (
  SELECT a.doc_id, count(*) FILTER (WHERE w) AS n_lines, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT (w AND g.p IS NOT NULL)), '') AS t
  FROM numbered a LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.p = a.p GROUP BY a.doc_id
)
SELECT d.doc_id, k.n_lines, coalesce(s.n_removed, 0)::BIGINT AS n_removed, coalesce(s.longest_run, 0)::BIGINT AS longest_run,
  coalesce(c.lcp_lines, 0)::BIGINT AS lcp_lines, CASE WHEN d.text IS NOT NULL THEN md5(k.t) END AS kept_md5
FROM documents d JOIN kept k USING (doc_id) LEFT JOIN islands s USING (doc_id) LEFT JOIN lcp c USING (doc_id)
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM docs)
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_repeat_words FROM repeated, (SELECT unnest(range(8)) AS o) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS x FROM docs
), worded AS (
  SELECT doc_id, host, t, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w,
    trim(regexp_replace(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS n
  FROM lines WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines FROM worded GROUP BY doc_id
), hosts AS (
  SELECT host, count(DISTINCT t) AS host_docs FROM docs GROUP BY host
), frequent AS (
  SELECT host, n FROM (SELECT host, n, count(DISTINCT t) AS c FROM worded GROUP BY host, n) JOIN hosts USING (host) WHERE c > 20 AND c > 0.05 * host_docs
), gone AS (
  SELECT doc_id, sum(w) AS g FROM worded JOIN frequent USING (host, n) GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(g, 0)::BIGINT AS n_frequent_words
  FROM docs LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_frequent_words >= 10 AND n_words - n_frequent_words >= 0.5 * n_words AS kept
FROM counted
"""

#: The rules of the URL contract, as text.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs that a feed link (utm_source=) was seen for; every other form of them is a hit too."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, pages.select("url").where(F.col("url").contains("utm_source=")), URL_RULES)


OP10_SQL = r"""
WITH a AS (
  SELECT page_id, url, strpos(url, '://') > 0 AS has, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM a
), c AS (
  SELECT *, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*\?([^#]*)', 1) AS q FROM b
), d AS (
  SELECT *, regexp_replace(regexp_replace(q, '(?:^|&)(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') AS q2 FROM c
), e AS (
  SELECT *, CASE WHEN has THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '(\.html?)?/?$', '') || CASE WHEN q2 <> '' THEN '?' || q2 ELSE '' END END AS canon FROM d
), rules(rule, rh, rp, v) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), listed AS (
  SELECT DISTINCT canon FROM e WHERE url LIKE '%utm_source=%' AND canon IS NOT NULL
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
  (SELECT arg_max(rule, length(rule)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
  coalesce((SELECT arg_max(v, length(rule)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
    CASE WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM e
"""


def model_file(name: str) -> str:
    """A file of the installed tokenizer package, which every executor has."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model_file("piece_bpe_32k.model"), 4096)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), 4, 85, 100)


OP2_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, least(len(w), 4) AS k, array_to_string(w[p:p + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM docs WHERE len(w) > 0)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) r ON r.x = d.doc_id
"""


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(table(spark, sf_dir, "documents"), 20, digest=True)


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM docs)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM windows) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, p + o AS i FROM later, (SELECT unnest(range(20)) AS o)
), words AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM docs
), kept AS (
  SELECT a.doc_id, count(g.i) AS n, string_agg(x, ' ' ORDER BY a.i) FILTER (WHERE g.i IS NULL) AS t FROM words a LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.i = a.i GROUP BY a.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs d LEFT JOIN kept USING (doc_id)
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP6_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS s FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs JOIN sizes ON n <= len(w))
), hits AS (
  SELECT doc_id, n, p, item FROM doc_windows JOIN item_windows USING (n, s)
), covered AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM hits, (SELECT unnest(range(10)) AS o) WHERE o < n GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.by_document(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), model_file("word_bpe_49k.json"), 4096, 1)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"), digest=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_secret_scan": op7_secret_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_pii": op9_pii,
    "op10_url_filters": op10_url_filters,
}
SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op2_ngram_jaccard": OP2_SQL,
    "op4_quality_rules": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_decontamination": OP6_SQL,
    "op10_url_filters": OP10_SQL,
}
