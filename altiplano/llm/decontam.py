"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

The automaton accepts every run of words of every item.  A document's words are streamed through it; the state and
the length of the longest run that ends at the word are known at each step.  A word run of `width` words inside it is
an item's window; the state of that run (an ancestor by suffix links) holds the items that have it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, giving_back, known_id, named, prepare, raw, staged

#: Item words in one automaton, which bounds what is broadcast; more items take more passes over the documents.
ITEM_WORDS = 500_000
#: A-Z lowered; every ASCII byte but digits and letters a blank.  Longer code points are letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def fold(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """States are numbers; state 0 is the empty run."""

    def __init__(self, width: int):
        self.width = width
        self.step: list[dict] = [{}]
        self.link, self.size = [-1], [0]
        self.items: dict[int, set] = {}  # by the state of a window of `width` words
        self.short: dict[int, list] = {}  # by the state of a whole shorter item: (words, item)

    def _state(self, size: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state for p's run and the word, cut from q, which also holds longer runs."""
        if self.size[p] + 1 == self.size[q]:
            return q
        c = self._state(self.size[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = c
            p = self.link[p]
        return c

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            q = self.step[last].get(word)
            if q is not None:
                last = self._split(last, word, q)
                continue
            new, p = self._state(self.size[last] + 1, {}, 0), last
            while p >= 0 and word not in self.step[p]:
                self.step[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word, self.step[p][word])
            last = new

    def label(self, item: str | None, words: list[bytes]) -> None:
        """After all add()s: note the item at the states of its windows; without a name they are hits all the same."""
        name = set() if item is None else {item}
        s = 0
        for n, word in enumerate(words, 1):
            s = self.step[s][word]
            if n >= self.width:
                while self.size[self.link[s]] >= self.width:
                    s = self.link[s]
                self.items.setdefault(s, set()).update(name)
        if 0 < len(words) < self.width:
            self.short.setdefault(s, []).append((len(words), item))

    def close(self) -> None:
        """For every state its window's state (-1: shorter), and the short items that end where it ends."""
        order = np.argsort(self.size, kind="stable").tolist()
        self.window = [-1] * len(order)
        ends: dict[int, list] = {}
        for s in order[1:]:
            up = self.link[s]
            if self.size[s] >= self.width:
                self.window[s] = self.window[up] if self.size[up] >= self.width else s
            if got := ends.get(up, []) + self.short.get(s, []):
                ends[s] = got
        self.short = ends

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans [from, to) of word places, in order of their ends, and the items found."""
        step, link, size, window, short, width = self.step, self.link, self.size, self.window, self.short, self.width
        spans, found, s, n = [], set(), 0, 0
        for i, word in enumerate(words):
            t = step[s].get(word)
            if t is None:
                while s:
                    s = link[s]
                    t = step[s].get(word)
                    if t is not None:
                        n = size[s]
                        break
                else:
                    n = 0
                    continue
            s = t
            n += 1
            if n >= width:
                spans.append((i + 1 - n, i + 1))
                found |= self.items[window[s]]
            if s in short:
                for m, item in short[s]:
                    if m <= n:
                        spans.append((i + 1 - m, i + 1))
                        if item is not None:
                            found.add(item)
        return spans, found


def build(items: list[tuple[str | None, bytes]], width: int) -> Automaton:
    out, words = Automaton(width), [(item, fold(text)) for item, text in items]
    for _, w in words:
        out.add(w)
    for item, w in words:
        out.label(item, w)
    out.close()
    return out


def automata(bench: DataFrame, width: int, item_col: str, text_col: str, max_words: int) -> Iterator[Automaton]:
    """Automata of at most about max_words item words each (one item is never cut)."""
    held, n = [], 0
    rows = bench.select(named(item_col).cast("string"), F.coalesce(named(text_col), F.lit("")).cast("binary"))
    for item, text in rows.toLocalIterator():
        held.append((item, bytes(text)))
        n += len(fold(held[-1][1]))
        if n >= max_words:
            yield build(held, width)
            held, n = [], 0
    if held:
        yield build(held, width)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _find(automaton):
    def run(batches) -> Iterator[dict]:
        machine = automaton.value
        for batch in batches:
            out = {"r": [], "n_words": [], "spans": [], "items": []}
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = fold(text)
                spans, found = machine.stream(words)
                out["r"].append(k)
                out["n_words"].append(len(words))
                out["spans"].append([x for ab in merge(spans) for x in ab])
                out["items"].append(sorted(found))
            if out["r"]:
                yield out

    return run


def _passes(spark: SparkSession, machines: Iterator[Automaton], rows: DataFrame, first: DataFrame | None = None) -> Iterator[DataFrame]:
    """Staged finds (r, n_words, spans, items) of the rows (r, b) that each automaton hits, one automaton at a time.

    first: staged rows that stand for the first automaton's.
    """
    for n, machine in enumerate(machines):
        if n == 0 and first is not None:
            yield first.where(F.size("spans") > 0).select("r", "n_words", "spans", "items")
            continue
        shared = spark.sparkContext.broadcast(machine)
        yield staged(arrow_map(rows.select("r", "b"), _find(shared), _FOUND).where(F.size("spans") > 0), "decontam-found")
        shared.destroy()


def _united(found: list[DataFrame]) -> DataFrame:
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return every


_FOUND = "r long, n_words long, spans array<int>, items array<string>"


def find_items(docs: DataFrame, bench: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_words: int = ITEM_WORDS) -> DataFrame:
    """id_col, n_words, n_hit, spans (flat from, to, from, to ... of hit words), items (sorted strings), by row of docs.

    A window is `width` consecutive words of an item, or all of a shorter one.  Items beyond max_words words take
    another pass over the documents, whose finds are joined by row, so the result is that of one pass.  Null texts have
    no words; items without words are never found; those with a null id are hits without a name; no items: nothing is
    hit.  Every row has its own finds, whatever its id; a null id comes back null; other columns are not read.
    """
    spark = docs.sparkSession
    rows = raw(docs, id_col, text_col)
    machines = automata(bench, width, item_col, item_text_col, max_words)
    first = next(machines, None) or build([], width)
    second = next(machines, None)
    if second is None:
        out = arrow_map(rows, _find(spark.sparkContext.broadcast(first)), _FOUND).withColumnRenamed("r", "k")
    else:
        rows = staged(rows.withColumn("r", F.monotonically_increasing_id()), "decontam-rows")
        shared = spark.sparkContext.broadcast(first)
        one = staged(arrow_map(rows.select("r", "b"), _find(shared), _FOUND), "decontam-found")
        shared.destroy()
        every = _united(list(_passes(spark, chain([first, second], machines), rows, one)))
        every = every.groupBy("r").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        hits = arrow_map(every, _joined, _FOUND).drop("n_words")
        none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
        out = rows.select("r", "k").join(one.select("r", "n_words"), "r").join(hits, "r", "left").select("k", "n_words", none("spans", "int"), none("items", "string"))
    n_hit = F.expr("aggregate(sequence(1, size(spans), 2), 0L, (n, i) -> n + spans[i] - spans[i - 1])")
    return out.select(known_id().alias(id_col), "n_words", F.when(F.size("spans") > 0, n_hit).otherwise(F.lit(0).cast("long")).alias("n_hit"), "spans", "items")


def _joined(batches) -> Iterator[dict]:
    for batch in batches:
        r, n, spans, items = [c.to_pylist() for c in batch.columns]
        if r:
            yield {"r": r, "n_words": n, "spans": [[x for ab in merge(list(zip(s[::2], s[1::2], strict=True))) for x in ab] for s in spans], "items": items}


def decontaminate(docs: DataFrame, bench: DataFrame, width: int = 10, max_cover: float = 0.5, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_words: int = ITEM_WORDS) -> DataFrame:
    """docs with the hit spans cut from text_col, without documents of which they cover more than max_cover.

    Other columns pass through under any name, and rows are judged each on their own.  Null texts stay null.  Cutting
    can bring words together that make a new window, so the text is cut again until nothing is hit.  Items beyond
    max_words words take more passes, whose spans are joined before each cut, so that the result is the same.
    """
    from pyspark.sql import types as T

    spark = prepare(docs.sparkSession)
    machines = automata(bench, width, item_col, item_text_col, max_words)
    first, second = next(machines, None), next(machines, None)
    if first is None:
        return docs
    if second is not None:
        return _cut_by_all(docs, lambda: automata(bench, width, item_col, item_text_col, max_words), max_cover, text_col)
    keep = [c for c in docs.columns if c != text_col]
    packed = docs.select(named(text_col).cast("binary").alias("__b"), F.struct(*[named(c) for c in keep]).alias("__rest") if keep else F.struct(F.lit(0)).alias("__rest"))
    schema = T.StructType([T.StructField("__rest", packed.schema["__rest"].dataType), T.StructField("__b", T.BinaryType())])
    done = packed.mapInArrow(giving_back(_cutter(spark.sparkContext.broadcast(first), max_cover)), schema)
    return done.select(*[F.col("__rest").getField(c).alias(c) if c != text_col else F.col("__b").cast("string").alias(c) for c in docs.columns])


def _cut_by_all(docs: DataFrame, machines: Callable[[], Iterator[Automaton]], max_cover: float, text_col: str) -> DataFrame:
    """decontaminate() with several automata: each round cuts what any of them hits, until none does."""
    spark = docs.sparkSession
    rows = staged(docs.select(F.monotonically_increasing_id().alias("r"), F.struct(*[named(c) for c in docs.columns]).alias("rest")), "decontam-rows")
    text = F.col("rest").getField(text_col)
    now, rounds = rows.where(text.isNotNull()).select("r", text.cast("binary").alias("b"), F.lit(-1).cast("long").alias("total"), F.lit(0).cast("long").alias("gone")), []
    while True:
        every = _united(list(_passes(spark, machines(), now))).groupBy("r").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        done = staged(arrow_map(now.join(every, "r").select("r", "b", "total", "gone", "spans"), _cut_spans, "r long, b binary, total long, gone long"), "decontam-cut")
        if done.isEmpty():
            break
        rounds.append(done.withColumn("round", F.lit(len(rounds))))
        now = done.where(F.col("gone") <= max_cover * F.col("total"))
    if not rounds:
        return rows.select(*[F.col("rest").getField(c).alias(c) for c in docs.columns])
    cut = _united(rounds).groupBy("r").agg(F.max_by(F.struct("b", "total", "gone"), "round").alias("cut"))
    out = rows.join(cut, "r", "left").where(F.col("cut").isNull() | (F.col("cut.gone") <= max_cover * F.col("cut.total")))
    return out.select(*[F.when(F.col("cut").isNotNull(), F.col("cut.b").cast("string")).otherwise(text).alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])


def _cut_spans(batches) -> Iterator[dict]:
    """Texts less the union of their spans; total stays the words of the first round, gone adds up."""
    for batch in batches:
        out = {"r": [], "b": [], "total": [], "gone": []}
        for k, text, total, gone, flat in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            spans = merge(list(zip(flat[::2], flat[1::2], strict=True)))
            out["r"].append(k)
            out["b"].append(_without(text, spans))
            out["total"].append(len(fold(text)) if total < 0 else total)
            out["gone"].append(gone + sum(b - a for a, b in spans))
        if out["r"]:
            yield out


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text less the words of merged spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    parts, last = [], 0
    for a, b in spans:
        parts.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join(parts) + text[last:]


def _cutter(machine, max_cover: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, rest = batch.column(0).to_pylist(), batch.column(1)
            keep, out, whole = [], [], machine.value
            for i, text in enumerate(texts):
                total, gone, now = None, 0, text
                while now:
                    words = fold(now)
                    total = len(words) if total is None else total
                    spans = merge(whole.stream(words)[0])
                    if not spans:
                        break
                    gone += sum(b - a for a, b in spans)
                    now = _without(now, spans)
                if gone <= max_cover * (total or 0):
                    keep.append(i)
                    out.append(now)
            yield pa.RecordBatch.from_arrays([rest.take(pa.array(keep, pa.int64())), pa.array(out, pa.binary())], names=["__rest", "__b"])

    return run
