"""URL filters: longest-rule verdicts, then a blocked Bloom filter of listed canonical URLs before an exact join.

The filter is a table: a block is eight 64-bit words, a URL sets one bit in each word of one block.  Pages are looked
up by block; those with all eight bits go to an exact join by canonical URL, which removes the false positives.  No
Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom, join_hot, maybe_in, named, staged
from .quality import LOWER, UPPER

TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """host, path, and query (without ? and fragment); empty where the URL is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw_host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw_host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    query = F.regexp_extract(after, r"^[^?#]*\?([^#]*)", 1)
    return F.translate(raw_host, UPPER, LOWER), path, query


def canonical(url: Column) -> Column:
    """host without www., path without .html and a last slash, query without tracking parameters; null without ://."""
    host, path, query = parts(url)
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(path, r"(\.html?)?/?$", "")
    query = F.regexp_replace(F.regexp_replace(query, rf"(?:^|&){TRACKING}", ""), "^&", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest fitting rule (host/path, verdict), null where none fits."""
    out = None
    for text, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        got = F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, got) if out is None else out.when(fits, got)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """id_col, host, path, rule, verdict for every row of pages: the longest rule's, else block for a listed URL.

    rules: (host/path, allow or block), a short list of the policy.  listed: URLs in any form, repeats and nulls
    allowed.  A null URL and one without :// have an empty host and path, no rule and are allowed.  One row comes back
    for each row of pages, repeated ids and all; other columns are not read.
    """
    known = staged(listed.select(canonical(named(listed_col)).alias("c")).where("c IS NOT NULL").distinct(), "urls-listed")
    table, blocks = bloom(known, "c", known.count())
    url = named(url_col)
    host, path, _ = parts(url)
    seen = pages.select(named(id_col).alias("k"), host.alias("host"), path.alias("path"), canonical(url).alias("c"), rule_of(host, path, rules).alias("r"))
    seen = seen.select("k", "host", "path", "c", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("ruled"))
    # only URLs without a rule are looked up; those that are null have no key and stay out of every join
    open_ = seen.where("ruled IS NULL AND c IS NOT NULL")
    settled = seen.where("NOT (ruled IS NULL AND c IS NOT NULL)").select("k", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    looked = staged(maybe_in(open_, "c", table, blocks, "maybe").select("k", "host", "path", "rule", "c", "maybe"), "urls-looked")
    clear = looked.where("NOT maybe").select("k", "host", "path", "rule", F.lit("allow").alias("verdict"))
    maybe = looked.where("maybe")
    sure = maybe.groupBy("c").agg(F.count(F.lit(1)).alias("n")).join(known.withColumn("in_list", F.lit(True)), "c", "left")
    exact = join_hot(maybe, staged(sure, "urls-sure"), ["c"], "n", maybe.count())
    exact = exact.select("k", "host", "path", "rule", F.when(F.col("in_list"), "block").otherwise("allow").alias("verdict"))
    return settled.unionByName(clear).unionByName(exact).withColumnRenamed("k", id_col)
