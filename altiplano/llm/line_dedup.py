"""Line dedup: a suffix array over line-id sequences, by distributed prefix doubling, without Python on the executors.

A document is the sequence of its lines (split at ``\\n``) that have a word; a line's id is a 128-bit hash of its exact
text.  A line that no other place has is in no repeated run, so sequences are cut there, and a suffix is a place in
such a segment, up to the segment's end.

1. Ranks at length 1: the shared line ids are sorted by range and numbered in that order.
2. Ranks at min_lines, and then at four times the length L, two doublings a round, for suffixes that share their rank at
   L and do not end within it: the rank at L with the ranks (at all lengths up to L) of the suffixes L, 2L and 3L places
   on are grouped, sorted by range and numbered.  A suffix keeps its list of ranks; one that is alone with its last
   rank, or that has ended, gets no more.  Lists in order are suffixes in order, so the rounds end after
   log4(longest repeated run) and work on repeated text alone.
3. The suffix array is the sorted lists, numbered without gaps.  The longest common prefix of neighbours is exact: the
   last rank that both lists share gives most of it, and the suffixes that far on give the rest.
4. Suffixes with the same rank at ``min_lines`` are one interval of the array with common prefixes of at least that
   many lines.  Its smallest (id, place) is the first copy, the rest are later ones, whose first ``min_lines`` lines are
   deleted; the union of these is every maximal repeated run.  With ``min_words``, so are later copies of single lines
   of at least that many words, by the intervals of rank 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, join_hot, let, named, staged, words_col

WORD = r"[^\x20\x09-\x0D]"
#: A document is known by its id and a hash of its text, as rows can repeat an id.
DOC = ["k", "t"]


def _lines(text: Column) -> Column:
    """(place, whether it has a word, line) of every line."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x, i: F.struct(i.alias("i"), x.rlike(WORD).alias("w"), x.alias("x")))


def _places(docs: DataFrame, id_col: str, text_col: str, min_words: int | None) -> DataFrame:
    """k, t, p (place among the lines with a word), a, b (hash), long (of at least min_words words)."""
    text = named(text_col)
    worded = F.filter(_lines(text), lambda s: s["w"])

    def row(s: Column, p: Column) -> Column:
        x = s["x"]
        long = (F.length(x) >= 2 * min_words - 1) & (F.size(words_col(x)) >= min_words) if min_words else F.lit(False)
        return F.struct(p.alias("p"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), long.alias("long"))

    return docs.where(named(id_col).isNotNull() & text.isNotNull()).select(named(id_col).cast("long").alias("k"), F.hash(text).alias("t"), F.inline(F.transform(worded, row)))


def _ranked(names: DataFrame, by: list[str], tag: str) -> DataFrame:
    """names with `rank`, a number that grows in the order of `by` (distinct); written, so that it stays the same."""
    return staged(names.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), tag)


def suffixes(places: DataFrame, total: int, min_lines: int) -> tuple[DataFrame, list[int]]:
    """k, t, p, e (the segment's end), long, a (ranks) of every place whose line is shared, and the ranks' lengths."""
    names = _ranked(places.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), ["a", "b"], "lines-ranks")
    shared = join_hot(places, names, ["a", "b"], "n", total).select(*DOC, "p", "long", "rank")
    # rows that repeat a document are one; its places in a row are a segment from s to e
    numbered = shared.repartition(*DOC).dropDuplicates([*DOC, "p"]).withColumn("run", F.col("p") - F.row_number().over(Window.partitionBy(*DOC).orderBy("p")))
    whole = Window.partitionBy(*DOC, "run")
    left = staged(numbered.select(*DOC, "p", F.min("p").over(whole).alias("s"), (F.max("p").over(whole) + 1).alias("e"), "long", F.array("rank").alias("a"), F.lit(True).alias("open")), "lines-suffixes")
    used, done, lengths = [names, left], [], [1]
    while True:
        length = lengths[-1]
        more = 4 * length if len(lengths) > 1 or min_lines == 1 else min_lines
        # a short segment has no longer runs; in others every suffix may be the far part of one
        done.append(left.where(F.col("e") - F.col("s") <= length))
        here = left.where(F.col("e") - F.col("s") > length)
        active = F.col("open") & (F.col("e") - F.col("p") > length)
        along = Window.partitionBy(*DOC, "s").orderBy("p")
        far = F.array(*[F.lead("a", at).over(along) for at in range(length, more, length)])
        runs = staged(here.withColumn("y", far).where(active).withColumn("r", F.element_at("a", -1)), "lines-runs")
        names = _ranked(runs.groupBy("r", "y").agg(F.count(F.lit(1)).alias("n")), ["r", "y"], "lines-ranks")
        used += [runs, names]
        if names.isEmpty():
            done.append(here)
            break
        new = join_hot(runs, names, ["r", "y"], "n", total).select(*DOC, "p", "s", "e", "long", F.concat("a", F.array("rank")).alias("a"), (F.col("n") > 1).alias("open"))
        left = staged(new.unionByName(here.where(~active)), "lines-suffixes")
        lengths.append(more)
        used.append(left)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = staged(out.select(*DOC, "p", "e", "long", "a"), "lines-found")
    dropped(places.sparkSession, [x.staged_at for x in used])
    return out, lengths


def _common(a: Column, b: Column) -> Column:
    """How many leading entries two arrays share."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    return F.when(differs > 0, differs - 1).otherwise(F.size(a))


def common_prefixes(found: DataFrame, lengths: list[int]) -> DataFrame:
    """k, t, p, lcp of every suffix: its longest common prefix with a neighbour in the suffix array, in lines."""
    by = ["a", *DOC, "p"]
    order = _ranked(found.select(*by, "e"), by, "lines-array")
    part, within = F.shiftright("rank", 33), F.col("rank").bitwiseAND((1 << 33) - 1)
    # numbers without gaps: one offset for each partition
    sizes = order.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    order = order.withColumn("part", part).join(F.broadcast(sizes.select("part", before.alias("before"))), "part").select(*by, "e", (F.col("before") + within).alias("at"))
    one, two = (order.select(*[F.col(c).alias(f"{c}{i}") for c in (*DOC, "p", "e", "a")], (F.col("at") + i - 1).alias("at")) for i in (1, 2))
    keys = [f"{c}{i}" for i in (1, 2) for c in (*DOC, "p")]
    met = one.join(two, "at").withColumn("least", F.least(F.col("e1") - F.col("p1"), F.col("e2") - F.col("p2"))).withColumn("lcp", F.lit(0))

    by_rank = F.array(*[F.lit(n) for n in lengths])
    # one line alike and the next not, where the second rank is at two
    one_line = F.col("c") == 1 if len(lengths) > 1 and lengths[1] == 2 else F.lit(False)

    def further(met: DataFrame) -> DataFrame:
        """Pairs with the lines that a1 and a2 share added to lcp, and whether that is all (`sure`)."""
        c = _common(F.col("a1"), F.col("a2"))
        # equal lists are equal up to the segments' ends
        got = F.when(F.col("a1") == F.col("a2"), F.col("least")).when(F.col("c") > 0, F.least(F.col("least"), F.col("lcp") + F.get(by_rank, F.col("c") - 1))).otherwise(F.col("lcp"))
        known = met.withColumn("c", c).withColumn("lcp", got)
        return staged(known.select(*keys, "least", "lcp", ((F.col("c") == 0) | one_line | (F.col("lcp") >= F.col("least"))).alias("sure")), "lines-neighbours")

    pairs = further(met)
    done = [pairs.where("sure")]
    ranks = found.select(*DOC, F.col("p").alias("q"), "a")
    while not (open_ := pairs.where("NOT sure")).isEmpty():
        for i in (1, 2):
            there = ranks.select(*[F.col(c).alias(f"{c}{i}") for c in (*DOC, "q", "a")])
            open_ = open_.withColumn(f"q{i}", F.col(f"p{i}") + F.col("lcp")).join(there, [f"{c}{i}" for c in (*DOC, "q")])
        pairs = further(open_)
        done.append(pairs.where("sure"))
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    ends = F.explode(F.array(*[F.struct(*[F.col(f"{c}{i}").alias(c) for c in (*DOC, "p")]) for i in (1, 2)]))
    return every.select(ends.alias("x"), "lcp").groupBy("x").agg(F.max("lcp").alias("lcp")).select("x.*", "lcp")


def _later(found: DataFrame, rank: Column, total: int) -> DataFrame:
    """k, t, p of suffixes that are not the first of their interval."""
    at = found.select(*DOC, "p", rank.alias("rank"))
    intervals = staged(at.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*DOC, "p")).alias("f")).where("n > 1"), "lines-intervals")
    first = (F.col("f.k") == F.col("k")) & (F.col("f.t") == F.col("t")) & (F.col("f.p") == F.col("p"))
    return join_hot(at, intervals, ["rank"], "n", total).where(~first).select(*DOC, "p")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """k, t, gone, lcp: for each document with a shared line, the places of its lines that are later copies (sorted),
    and the longest run of lines, exactly, that it shares with another place."""
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    places = staged(_places(docs, id_col, text_col, min_words), "lines-places")
    total = max(1, places.count())
    found, lengths = suffixes(places, total, min_lines)
    level = int(min_lines > 1)
    whole = found.where((F.size("a") > level) & (F.col("e") - F.col("p") >= min_lines))
    gone = _later(whole, F.get("a", F.lit(level)), total).select(*DOC, F.explode(F.sequence(F.col("p"), F.col("p") + (min_lines - 1))).alias("p"))
    if min_words:
        gone = gone.unionByName(_later(found.where("long"), F.get("a", F.lit(0)), total))
    gone = gone.groupBy(*DOC).agg(F.array_sort(F.collect_set("p")).alias("gone"))
    deep = common_prefixes(found, lengths).groupBy(*DOC).agg(F.max("lcp").alias("lcp"))
    return deep.join(gone, DOC, "left")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2, min_words: int | None = None) -> DataFrame:
    """docs with text_col less its later copies, and columns n_lines, n_removed, longest_run, lcp_lines.

    Later copies are runs of at least min_lines lines and, with min_words, single lines of at least
    that many words.  lcp_lines is the longest run of lines that the document shares with another place, first copies
    among them.

    The order "earlier" is (id, place).  A line without a word is in no run and stays.  A null text has no lines and
    stays null; an empty one stays empty; a row with a null id stays as it is and is nobody's copy.  Rows that repeat
    an id and text count as one document; those that repeat an id with another text are documents of their own, in the
    order of a hash.  Other columns pass through under any name; the four added ones are replaced if present.
    """
    added = ("n_lines", "n_removed", "longest_run", "lcp_lines")
    base = docs.drop(*added)
    seen = repeated_runs(base, id_col, text_col, min_lines, min_words)
    text = F.col("x")
    rows = base.select(F.struct(*[named(c) for c in base.columns]).alias("r"), named(id_col).cast("long").alias("k"), F.hash(named(text_col)).alias("t"), named(text_col).alias("x"))
    known, odd = rows.where("k IS NOT NULL AND x IS NOT NULL"), rows.where("k IS NULL OR x IS NULL")
    met = known.join(seen, DOC, "left").select("r", "x", "gone", "lcp")
    met = met.unionByName(odd.select("r", "x", F.lit(None).cast("array<int>").alias("gone"), F.lit(None).cast("int").alias("lcp")))

    def keep(both: Column) -> Column:
        """Lines that stay, in order: of those with a word, those whose number is not gone."""
        lines, with_word = both["lines"], F.filter(both["lines"], lambda x: x["w"])
        gone_at = let(with_word, lambda ws: F.transform(both["gone"], lambda p: F.get(ws, p)["i"]))
        return F.transform(F.array_except(F.transform(lines, lambda x: x["i"]), gone_at), lambda i: F.get(lines, i)["x"])

    def longest(gone: Column) -> Column:
        start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

        def step(s: Column, p: Column) -> Column:
            run = F.when(s["last"] + 1 == p, s["run"] + 1).otherwise(1)
            return F.struct(p.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

        return F.aggregate(gone, start, step)["best"]

    lines = _lines(text)
    rest = F.array_join(let(F.struct(lines.alias("lines"), F.col("gone").alias("gone")), keep), "\n")
    hit = F.col("gone").isNotNull()
    return met.select(
        *[F.when(hit, rest).otherwise(text).alias(c) if c == text_col else F.col("r").getField(c).alias(c) for c in base.columns],
        F.size(F.filter(lines, lambda x: x["w"])).cast("long").alias("n_lines"),
        F.when(hit, F.size("gone")).otherwise(0).cast("long").alias("n_removed"),
        F.when(hit, longest(F.col("gone"))).otherwise(0).cast("long").alias("longest_run"),
        F.coalesce("lcp", F.lit(0)).cast("long").alias("lcp_lines"),
    )
