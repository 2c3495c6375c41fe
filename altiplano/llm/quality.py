"""Quality rules: in-document counts, and lines that many documents of a host share.  No Python on the executors.

The cross-document rule hashes each normalised line (A-Z lowered, digit runs as 0, white space collapsed), counts the
distinct documents of its host that have it (exact copies of a text count once), removes lines above both limits, and
rejects documents left with too few words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, join_hot, let, named, staged, words_col

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 8
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside an 8-word window that the text has twice or more."""

    def heavy(names: Column) -> Column:
        def flagged(s: Column) -> Column:
            same = lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])
            return F.filter(F.transform(s, lambda e, j: F.when(F.coalesce(same(e, j), F.get(s, j + 1)["h"] == e["h"], F.get(s, j - 1)["h"] == e["h"], F.lit(False)), e["i"])), lambda x: x.isNotNull())

        at = F.array_sort(let(F.array_sort(F.transform(names, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), flagged))
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, zero, lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")))["n"]

    def double(h: Column, k: int) -> Column:
        """Names of windows of 2k words from those of k."""
        rest = lambda x: F.greatest(F.size(x) - k, F.lit(0))
        return let(h, lambda x: F.zip_with(F.slice(x, F.lit(1), rest(x)), F.slice(x, F.lit(k + 1), rest(x)), lambda a, b: F.xxhash64(a, b)))

    names = double(double(double(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)
    return let(names, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(heavy(v)))


def _worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def counts(text: Column) -> Column:
    """struct of COUNTS, all long; a null text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    by_word = let(words_col(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    by_line = let(_worded_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return let(by_word, lambda w: F.struct(*[c.cast("long").alias(n) for n, c in zip(COUNTS, (w["n"], chars, symbols, by_line, w["r"]), strict=True)]))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def normal_line(line: Column) -> Column:
    lowered = F.translate(line, UPPER, LOWER)
    return F.trim(F.regexp_replace(F.regexp_replace(lowered, "[0-9]+", "0"), SPACE, " "))


def frequent_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str, max_docs: int, max_share: float) -> DataFrame:
    """k, t (hash of the text), i, w: number and words of every line above the limits, by document."""
    text = F.coalesce(named(text_col), F.lit(""))
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    worded = F.filter(lines, lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    hashed = F.transform(worded, lambda s: let(normal_line(s["x"]), lambda n: F.struct(s["i"].alias("i"), F.xxhash64(n).alias("a"), F.xxhash64(F.lit(7), n).alias("b"), F.size(F.split(n, " ")).alias("w"))))
    host = F.coalesce(named(host_col).cast("string"), F.lit(""))
    rows = docs.select(named(id_col).cast("long").alias("k"), host.alias("host"), F.xxhash64(text).alias("t"), F.explode(hashed).alias("s")).select("k", "host", "t", "s.i", "s.a", "s.b", "s.w")
    rows = staged(rows, "quality-lines")
    total = rows.count()
    hosts = docs.select(host.alias("host"), F.xxhash64(text).alias("t")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    # distinct (line, text) rows first, so that a line of a great many documents is dealt out by text
    by_text = rows.groupBy("host", "a", "b", "t").agg(F.count(F.lit(1)).alias("n"))
    by_line = by_text.groupBy("host", "a", "b").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n")).where(F.col("n_docs") > max_docs)
    above = staged(by_line.join(hosts, "host").where(F.col("n_docs") > max_share * F.col("host_docs")).select("host", "a", "b", "n"), "quality-frequent")
    return join_hot(rows, above, ["host", "a", "b"], "n", total).select("k", "t", "i", "w")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = 20, max_share: float = 0.05, min_words: int = 10, min_left: float = 0.5, with_text: bool = False) -> DataFrame:
    """Every document with its counts, base_failed, n_frequent_words and kept.

    A line is removed where more than max_docs distinct texts of its host, and more than max_share of them, have it.
    kept: the base holds, and at least min_words words and a share of min_left are left.  min_words is half of the
    base's 20: a text that the base lets through may lose half of itself to frequent lines, by either limit, no more.
    with_text: the text comes back without the removed lines (null stays null), beside every other column of docs
    under any name; else only the id does.

    Null and empty texts have no words and fail the base.  A null host is a host of its own (as the empty one).  Rows
    that repeat an id are judged each by their own text.  A row with a null id has its own counts, and its lines count
    among its host's, but none is removed from it.  No rows: no rows.
    """
    gone = frequent_lines(docs, id_col, text_col, host_col, max_docs, max_share).where("k IS NOT NULL")
    lost = gone.groupBy("k", "t").agg(F.collect_set(F.struct("i", "w")).alias("g"))
    if not with_text:
        lost = lost.select("k", "t", F.aggregate("g", F.lit(0).cast("long"), lambda n, s: n + s["w"]).alias("gone"))
    else:
        lost = lost.select("k", "t", F.aggregate("g", F.lit(0).cast("long"), lambda n, s: n + s["w"]).alias("gone"), F.transform("g", lambda s: s["i"]).alias("g"))
    added = (*COUNTS, "n_frequent_words", "base_failed", "kept")
    keep = [c for c in docs.columns if c not in added] if with_text else [id_col]
    text = named(text_col)
    rows = docs.select(F.struct(*[named(c) for c in keep]).alias("r"), named(id_col).cast("long").alias("k"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"), *([text.alias("x")] if with_text else []), counts(text).alias("c"))
    known = rows.where("k IS NOT NULL").join(lost, ["k", "t"], "left").drop("k", "t")
    odd = rows.where("k IS NULL").select(*[F.lit(None).cast(known.schema[c].dataType).alias(c) if c in ("g", "gone") else F.col(c) for c in known.columns])
    out = known.unionByName(odd)
    n_words, gone_words = F.col("c.n_words"), F.coalesce("gone", F.lit(0).cast("long"))
    left = n_words - gone_words
    failed = base_failed(n_words, F.col("c.n_repeat_words"))
    # one condition on both sides of the join: a filter on it does not go below the counts, to evaluate them again
    verdict = F.when(failed, F.lit(False)).otherwise((left >= min_words) & (left >= min_left * n_words))
    rest = F.lit(None)
    if with_text:
        lines = F.split(F.col("x"), "\n", -1)
        rest = let(F.struct(lines.alias("x"), F.col("g").alias("g")), lambda s: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(s["x"]) - 1), s["g"]), lambda i: F.get(s["x"], i)), "\n"))
        rest = F.when(F.col("g").isNotNull() & F.col("x").isNotNull(), rest).otherwise(F.col("x"))
    own = [rest.alias(c) if with_text and c == text_col else F.col("r").getField(c).alias(c) for c in keep]
    return out.select(*own, *[F.col("c").getField(c).alias(c) for c in COUNTS], gone_words.alias("n_frequent_words"), failed.alias("base_failed"), verdict.alias("kept"))
