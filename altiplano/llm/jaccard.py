"""N-gram Jaccard join: count vectors in an R-tree bound the overlap, exact sets verify what survives.

A document's set is its distinct word n-grams (as 64-bit hashes).  Hashing them into groups gives a vector of counts;
two sets share at most the sum of the coordinates' minima, so a pair whose sum is below the overlap that the threshold
needs is out, and so is a pair of R-tree nodes whose coordinate-wise maxima sum below it.  One tree over a whole corpus
would not prune (unrelated documents all lie equally far apart in many dimensions, so the boxes of any two leaves
overlap), so trees are built inside partitions that lose no pair: two sets above the threshold share one of their
first (1 - t) * n + 1 hashes in any order that is the same for all, and a partition is the documents that have one such
hash.  The order is by value, with frequent hashes last: a phrase that a share of the corpus has would make partitions
that grow with it, and pairs with its square.

1. A pass writes size, fingerprint, vector and smallest hashes of every document, and what hashes it saw repeatedly.
2. Equal sets become one, with a number of its own (by fingerprint); one document stands for each.
3. The frequent hashes go last; a document of which the pass kept too few others is read again.  Partitions with two members or more, without repetitions, get their members' vectors, and a tree joins each.  A
   partition of many members is dealt out as pairs of blocks by size.
4. The pairs that survive the bound make candidate groups, by connected components.
5. Each group's texts meet in one task; pairs not yet connected are bounded and then counted exactly.  A large group
   meets in blocks, each with the group's first document.  What that leaves unconnected meets, by pairs of blocks,
   itself and the rest, so that no task has more than two blocks.
6. Components of the verified links and of ids that several sets have; the smallest id of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BLOCKS, NO_ID, arrow_map, bloom, components, hash_words, join_hot, known_id, maybe_in, mix, named, raw, rolling, runs, staged
from .token_counts import squeeze, unsqueeze

#: Members of a partition's block, and documents of a block that is verified; two blocks meet in one task.
LIST_BLOCK, BLOCK = 600, 500
#: Frequent hashes at most (they go by broadcast), and hashes that a task counts at once.
FREQUENT, COUNTED = 200_000, 1_000_000
GRAMS = 10_000_000
LEAF = 32
_POSTING = np.dtype([("h", "<u8"), ("k", "<i8"), ("n", "<i4")])
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of every text's n-grams, one after the other, and where each text's end."""
    words, sizes = [], []
    for t in texts:
        w = t.translate(_LOWER).split()
        words += w
        sizes.append(len(w))
    sizes = np.array(sizes, np.int64)
    ends = np.cumsum(sizes)
    one = hash_words(words)
    h = rolling(one, width)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(h)]
    ok = np.flatnonzero(np.arange(len(h)) + width <= ends[doc]) if len(h) else np.empty(0, np.int64)
    h, doc = h[ok], doc[ok]
    for i in np.flatnonzero((sizes > 0) & (sizes < width)):  # fewer words: all of them as one
        whole = rolling(one[ends[i] - sizes[i] : ends[i]], int(sizes[i])) ^ np.uint64(sizes[i])
        h, doc = np.r_[h, mix(whole)], np.r_[doc, i]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
        h, doc = h[new], doc[new]
    return h, np.cumsum(np.bincount(doc, minlength=len(sizes)))


def n_groups(n: int) -> int:
    """Groups for a set of n: a power of two, about a group to eight n-grams."""
    return 1 << min(12, max(4, (max(n, 1) // 8).bit_length()))


def vector(h: np.ndarray) -> np.ndarray:
    g = n_groups(len(h))
    return np.bincount((h >> np.uint64(20)).astype(np.int64) & (g - 1), minlength=g).astype(np.int32)


def fold(v: np.ndarray, g: int) -> np.ndarray:
    """The vectors (rows) at fewer groups."""
    return v.reshape(len(v), -1, g).sum(1)


def least_overlap(a, b, num: int, den: int):
    """The smallest shared count at which den * shared >= num * union."""
    return -((-num * (a + b)) // (den + num))


class CountTree:
    """An R-tree of count vectors: boxes keep coordinate-wise maxima and the least and largest set size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.v, self.n = vectors, sizes
        self.nodes: list[tuple] = []  # (maxima, least size, largest size, children or None, members)
        self.root = self._load(np.arange(len(sizes)))

    def _load(self, members: np.ndarray) -> int:
        v = self.v[members]
        children = None
        if len(members) > LEAF:
            # the size first, as it bounds best, then the coordinate with the widest spread
            n = self.n[members]
            by = n if n.max() * 3 > n.min() * 4 else v[:, int(v.var(0).argmax())]
            order = members[np.argsort(by, kind="stable")]
            half = len(order) // 2
            children = (self._load(order[:half]), self._load(order[half:]))
        self.nodes.append((v.max(0), int(self.n[members].min()), int(self.n[members].max()), children, members))
        return len(self.nodes) - 1

    def pairs(self, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, bound) of the pairs that survive, leaf pair by leaf pair."""
        todo = [(self.root, self.root)]
        while todo:
            a, b = todo.pop()
            (ma, la, ha, ca, ia), (mb, lb, hb, cb, ib) = self.nodes[a], self.nodes[b]
            if a != b:
                if la * num > hb * den or lb * num > ha * den:
                    continue
                if np.minimum(ma, mb).sum() < least_overlap(la, lb, num, den):
                    continue
            if ca and cb:
                todo += [(ca[0], ca[0]), (ca[0], ca[1]), (ca[1], ca[1])] if a == b else [(x, y) for x in ca for y in cb]
            elif ca:
                todo += [(x, b) for x in ca]
            elif cb:
                todo += [(a, y) for y in cb]
            else:
                bound = np.minimum(self.v[ia][:, None, :], self.v[ib][None, :, :]).sum(2)
                ok = bound >= least_overlap(self.n[ia][:, None], self.n[ib][None, :], num, den)
                if a == b:
                    ok &= ia[:, None] < ib[None, :]
                x, y = np.nonzero(ok)
                if len(x):
                    yield ia[x], ib[y], bound[x, y]


class Links:
    """Union-find of places."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def bounded_pairs(vectors: list[np.ndarray], sizes: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs that survive the bound.  Vectors of a class meet those of the next larger one, folded to their groups."""
    groups = np.array([len(v) for v in vectors])
    for g in np.unique(groups):
        own = np.flatnonzero(groups == g)
        most = sizes[own].max()
        near = np.flatnonzero((groups > g) & (sizes * num <= most * den))
        at = np.r_[own, near]
        if len(at) < 2:
            continue
        rows = [np.stack([vectors[i] for i in own])] + [fold(vectors[i][None], g) for i in near]
        for i, j, bound in CountTree(np.concatenate(rows), sizes[at]).pairs(num, den):
            yield at[i], at[j], bound


def needed(n, num: int, den: int):
    """Of a set of n: how many first hashes hold one that it shares with any set above the threshold."""
    return n + (-num * n) // den + 1


def first_hashes(h: np.ndarray, n: int, frequent: np.ndarray, num: int, den: int) -> np.ndarray | None:
    """The first hashes of a set of n, frequent ones (sorted) last, from its smallest; None if these are too few."""
    p = needed(n, num, den)
    last = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h if len(frequent) else np.zeros(len(h), bool)
    if len(h) < n and len(h) - last.sum() < p:
        return None
    return np.r_[h[~last], h[last]][:p]


def _profiles(width: int, num: int, den: int):
    """A row for each text, and rows without k: a hash (f1) and how many different sets of a chunk have it (f2)."""

    def run(batches) -> Iterator[dict]:
        held, size, seen = [], 0, set()

        def counted() -> dict:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            h, c = h[c > 1].view(np.int64), c[c > 1]
            none = [None] * len(h)
            return {"k": none, "t": none, "n": none, "f1": h, "f2": c, "vector": none, "prefix": none}

        for batch in batches:
            h, ends = shingle_sets(batch.column(1).to_pylist(), width)
            ks = batch.column(0).to_pylist()
            out = {"k": ks, "t": batch.column(2).to_pylist(), "n": [], "f1": [], "f2": [], "vector": [], "prefix": []}
            start = 0
            m1, m2 = mix(h), mix(h ^ np.uint64(0xA0761D6478BD642F))
            for end in ends.tolist():
                own, n = h[start:end], end - start
                mark = (n, int(m1[start:end].sum().view(np.int64)), int(m2[start:end].sum().view(np.int64))) if n else (0, 0, 0)
                for name, value in zip(("n", "f1", "f2"), mark, strict=True):
                    out[name].append(value)
                # half as many again as needed, as frequent ones go last
                p = needed(n, num, den)
                first = own[: p + p // 2 + 4]
                out["vector"].append(vector(own).astype("<u2").tobytes() if n else b"")
                out["prefix"].append(first.tobytes())
                if n and mark not in seen:
                    seen.add(mark)
                    held.append(first.copy())
                    size += len(first)
                start = end
            if ks:
                yield out
            if size >= COUNTED:
                yield counted()
                held, size, seen = [], 0, set()
        if size:
            yield counted()

    return run


def _short(frequent: np.ndarray, num: int, den: int):
    """k, t of the documents (k, t, n, prefix) whose smallest hashes are too few."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            k, t, n, prefix = (c.to_pylist() for c in batch.columns)
            at = [i for i, p in enumerate(prefix) if first_hashes(np.frombuffer(p, "<u8"), n[i], frequent, num, den) is None]
            yield {"k": [k[i] for i in at], "t": [t[i] for i in at]}

    return run


def _first(width: int, frequent: np.ndarray, num: int, den: int):
    """u, n, prefix of texts (u, b): all of the set's first hashes."""

    def run(batches) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                h, ends = shingle_sets(batch.column(1).to_pylist(), width)
                sets = np.split(h, ends[:-1])
                yield {"u": batch.column(0).to_pylist(), "n": [len(s) for s in sets], "prefix": [first_hashes(s, len(s), frequent, num, den).tobytes() for s in sets]}

    return run


def _postings(n_buckets: int, frequent: np.ndarray, num: int, den: int):
    """Lists, packed by bucket, of the first hashes of documents (k, n, prefix, whole: they are the first already)."""

    def run(batches) -> Iterator[dict]:
        held, size = [], 0

        def flush() -> dict:
            got = np.concatenate(held)
            # the middle bits choose: the smallest hashes are alike in their first ones
            bucket = (mix(got["h"]) % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((got["h"], bucket))
            got, bucket = got[order], bucket[order]
            a, b = runs(bucket)
            return {"bucket": bucket[a].tolist(), "data": [squeeze(b"".join(np.ascontiguousarray(got[f][i:j]).tobytes() for f in _POSTING.names)) for i, j in zip(a, b, strict=True)]}

        for batch in batches:
            given = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            none = np.empty(0, "<u8")  # what is read again comes in a row of its own
            prefix = [h if whole else first_hashes(h, n, frequent, num, den) for n, h, whole in ((n, np.frombuffer(p, "<u8"), whole) for n, p, whole in given)]
            prefix = [none if p is None else p for p in prefix]
            if not prefix:
                continue
            each = np.array([len(p) for p in prefix])
            rec = np.empty(int(each.sum()), _POSTING)
            rec["h"] = np.concatenate(prefix)
            rec["k"], rec["n"] = np.repeat(batch.column(0).to_numpy(), each), np.repeat(batch.column(1).to_numpy(), each)
            held.append(rec)
            size += len(rec)
            if size >= 2_000_000:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _members(num: int, den: int):
    """The partitions of two and more, as (name, ids): the same members make one; large ones, blocks by size in pairs."""

    def run(batches) -> Iterator[dict]:
        import xxhash

        now, held = None, []

        def close() -> Iterator[dict]:
            got = np.concatenate(held)
            got = got[np.lexsort((got["k"], got["n"], got["h"]))]
            a, b = runs(got["h"])
            seen: set[bytes] = set()
            out: dict[str, list] = {"name": [], "us": []}
            for i, j in zip(a[b - a > 1], b[b - a > 1], strict=True):
                k, n = got["k"][i:j], got["n"][i:j]
                size = j - i
                blocks = [(x, min(x + LIST_BLOCK, size)) for x in range(0, size, LIST_BLOCK)]
                for p, (a0, a1) in enumerate(blocks):
                    for b0, b1 in blocks[p + 1 :] or ([(a0, a1)] if len(blocks) == 1 else []):
                        if int(n[b0]) * num > int(n[a1 - 1]) * den:
                            break
                        ks = np.unique(k[a0:a1] if a0 == b0 else np.r_[k[a0:a1], k[b0:b1]])
                        name = xxhash.xxh3_128_digest(ks.tobytes())
                        if len(ks) > 1 and name not in seen:
                            seen.add(name)
                            out["name"].append(name)
                            out["us"].append(ks)
                    if len(blocks) > 1:  # a block with itself, if no pair had it
                        ks = np.unique(k[a0:a1])
                        name = xxhash.xxh3_128_digest(ks.tobytes())
                        if len(ks) > 1 and name not in seen:
                            seen.add(name)
                            out["name"].append(name)
                            out["us"].append(ks)
            if out["name"]:
                yield out

        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now and held:
                    yield from close()
                    held = []
                now, data = bucket, unsqueeze(data)
                n = len(data) // _POSTING.itemsize
                rec, at = np.empty(n, _POSTING), 0
                for f in _POSTING.names:
                    rec[f] = np.frombuffer(data, _POSTING[f], n, at)
                    at += n * _POSTING[f].itemsize
                held.append(rec)
        if held:
            yield from close()

    return run


def _grouped(batches, n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows sorted by their first n_keys columns, by key."""
    now, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:n_keys] != now:
                if held:
                    yield now, held
                now, held = row[:n_keys], []
            held.append(row[n_keys:])
    if held:
        yield now, held


def _emit(found: Iterator[tuple[int, int]]) -> Iterator[dict]:
    a, b = [], []
    for x, y in found:
        a.append(x)
        b.append(y)
        if len(a) >= 50_000:
            yield {"a": a, "b": b}
            a, b = [], []
    if a:
        yield {"a": a, "b": b}


def _bound(num: int, den: int):
    def forest(batches) -> Iterator[tuple[int, int]]:
        for _, rows in _grouped(batches, 1):
            ks = [r[0] for r in rows]
            vectors = [np.frombuffer(r[2], "<u2").astype(np.int32) for r in rows]
            links = Links(len(ks))
            for i, j, _ in bounded_pairs(vectors, np.array([r[1] for r in rows], np.int64), num, den):
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    links.join(x, y)
            for i, k in enumerate(ks):
                if (r := links.root(i)) != i and ks[r] != k:
                    yield ks[r], k

    return lambda batches: _emit(forest(batches))


def _verify(width: int, num: int, den: int):
    """Links among the documents (node, text, side) of a part (root, i, j): all pairs of one block, or those across two."""

    def forest(batches) -> Iterator[tuple[int, int]]:
        for (_, first, second), rows in _grouped(batches, 3):
            ks, side = [r[0] for r in rows], np.array([r[2] for r in rows])
            h, ends = shingle_sets([r[1] for r in rows], width)
            sets = np.split(h, ends[:-1])
            sizes = np.array([len(s) for s in sets], np.int64)
            links = Links(len(ks))
            for i, j, bound in bounded_pairs([vector(s) for s in sets], sizes, num, den):
                if first != second:
                    across = side[i] != side[j]
                    i, j, bound = i[across], j[across], bound[across]
                order = np.argsort(-bound, kind="stable")  # the likeliest first: they connect, and spare the others
                for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
                    if links.root(x) != links.root(y):
                        shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                        if den * shared >= num * (sizes[x] + sizes[y] - shared):
                            links.join(x, y)
            for i, k in enumerate(ks):
                if (r := links.root(i)) != i and ks[r] != k:
                    yield ks[r], k

    return lambda batches: _emit(forest(batches))


def _texts(rows: DataFrame, some: DataFrame, n: int) -> DataFrame:
    """The n rows of `some` (k, t and others) with their text b, once each, from rows (k, b, t)."""
    table, size = bloom(some, "t", n, BROADCAST_BLOCKS)
    near = maybe_in(rows, "t", table, size, "near").where("near").select("k", "t", "b").dropDuplicates(["k", "t"])
    return near.join(some, ["k", "t"])


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id for every row of docs: the smallest id reachable by links, itself included.

    Two documents link when den * shared >= num * union of their distinct n-grams of `width` words (A-Z lowered, split
    at ASCII white space).  A text of fewer words is one n-gram; null, empty and blank texts have none and link with
    nothing.  A null id comes back null with its own component null and links with nothing.  Rows that repeat an id
    are one document: each text links by its own set, and all share a component.  No rows: no rows.
    """
    known = docs.where(named(id_col).isNotNull())
    # a document is known by its id and a hash of its text, as rows can repeat an id
    rows = raw(known, id_col, text_col).withColumn("t", F.xxhash64("b"))
    written = staged(arrow_map(rows, _profiles(width, num, den), "k long, t long, n long, f1 long, f2 long, vector binary, prefix binary"), "jaccard-profiles")
    profiles = written.where("k IS NOT NULL")
    same, some = ["n", "f1", "f2"], profiles.where("n > 0")
    sets = some.groupBy(*same).agg(F.min(F.struct("k", "t")).alias("f"), F.count(F.lit(1)).alias("copies"))
    # written, so that the numbers stay the same
    sets = staged(sets.select(*same, F.col("f.k").alias("k"), F.col("f.t").alias("t"), "copies", F.monotonically_increasing_id().alias("u")), "jaccard-sets")
    one = lambda col: some.select("k", "t", *same, col).join(sets.select("k", "t", *same, "u"), ["k", "t", *same]).select("u", "n", col)
    total, n_sets = profiles.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_postings = (total or 0) * (den - num) // den
    n_buckets = int(min(1 << 20, max(16, n_postings // 250_000)))
    # counts by chunk miss some, which changes the order and no result
    often = written.where("k IS NULL").groupBy("f1").agg(F.sum("f2").alias("c")).where(F.col("c") > max(LIST_BLOCK, 2 * n_postings // FREQUENT))
    frequent = np.sort(np.array([r[0] for r in often.select("f1").collect()], np.int64).view(np.uint64))
    first = one("prefix").withColumn("whole", F.lit(False))
    if len(frequent):
        short = arrow_map(some.select("k", "t", "n", "prefix"), _short(frequent, num, den), "k long, t long").distinct().join(sets.select("k", "t", "u"), ["k", "t"])
        short = staged(short, "jaccard-short")
        if n_short := short.count():
            again = arrow_map(_texts(rows, short, n_short).select("u", "b"), _first(width, frequent, num, den), "u long, n long, prefix binary")
            # written, as two Arrow passes in one task would be two workers
            first = first.unionByName(staged(again, "jaccard-again").withColumn("whole", F.lit(True)))
    postings = arrow_map(first, _postings(n_buckets, frequent, num, den), "bucket int, data binary")
    lists = arrow_map(postings.repartition("bucket").sortWithinPartitions("bucket"), _members(num, den), "name binary, us array<long>")
    members = staged(lists.dropDuplicates(["name"]).select("name", F.explode("us").alias("u")), "jaccard-members")
    met = members.join(one("vector").dropDuplicates(["u"]), "u").select("name", "u", "n", "vector")
    maybe = arrow_map(met.repartition("name").sortWithinPartitions("name", "u"), _bound(num, den), "a long, b long")
    candidates = components(maybe, tag="jaccard-candidates")
    # blocks by members and by n-grams, as texts can be long
    weighed = candidates.join(sets.select(F.col("u").alias("node"), "n", "k", "t"), "node")
    sizes = weighed.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(BLOCK)), F.ceil(F.col("grams") / F.lit(GRAMS))).cast("int")
    placed = staged(join_hot(weighed, staged(sizes, "jaccard-sizes"), ["root"], "size", max(1, n_sets)).select("root", "node", "n", "k", "t", blocks.alias("blocks")), "jaccard-groups")

    def verified(dealt: DataFrame) -> DataFrame:
        """Links between documents (root, node, k, t, parts) that meet in one of their parts."""
        texts = _texts(rows, dealt, dealt.count()).select("root", F.inline("parts"), "node", "b").select("root", "i", "j", "node", "b", "side")
        return arrow_map(texts.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "node"), _verify(width, num, den), "a long, b long")

    # a part is a pair of blocks, and which of them a document is in; here a block with itself, and the group's first
    # document is in all of them
    block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    part = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: part(i, i, F.lit(0)))
    own = part(block(F.col("blocks")), block(F.col("blocks")), F.lit(0))
    edges = staged(verified(placed.withColumn("parts", F.when(F.col("node") == F.col("root"), every).otherwise(F.array(own)))), "jaccard-verified")
    links = components(edges, tag="jaccard-links")
    large = placed.where("blocks > 1").join(links.withColumnRenamed("root", "found"), "node", "left").withColumn("loose", F.coalesce("found", "node") != F.col("root"))
    large = staged(large, "jaccard-large")
    if not large.where("loose").isEmpty():
        # what is not connected with the first document meets itself and the rest, by pairs of blocks; two that are
        # connected need not meet
        count = large.groupBy("root").agg(*[F.greatest(F.ceil(F.count_if(c) / F.lit(BLOCK)), F.ceil(F.sum(F.when(c, F.col("n")).otherwise(0)) / F.lit(GRAMS))).cast("int").alias(a) for a, c in (("loose_blocks", F.col("loose")), ("fast_blocks", ~F.col("loose")))], F.count(F.lit(1)).alias("size"))
        open_ = join_hot(large, staged(count.where("loose_blocks > 0"), "jaccard-open"), ["root"], "size", max(1, n_sets))
        upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        i = block(F.col("loose_blocks"))
        loose = F.concat(F.transform(upto("loose_blocks"), lambda j: part(F.least(i, j), F.greatest(i, j), i > j)), F.transform(upto("fast_blocks"), lambda j: part(i, -1 - j, F.lit(0))))
        fast = F.transform(upto("loose_blocks"), lambda x: part(x, -1 - block(F.col("fast_blocks")), F.lit(1)))
        dealt = open_.where("loose").withColumn("parts", loose).unionByName(open_.where("NOT loose").withColumn("parts", fast))
        edges = edges.unionByName(verified(dealt))
    # ids that several sets have link them
    placed_ids = join_hot(profiles.select("k", *same), sets.select(*same, "copies", "u"), same, "copies", max(1, n_sets)).select("k", "n", "u")
    placed_ids = staged(placed_ids, "jaccard-ids")
    shared = placed_ids.groupBy("k").agg(F.min("u").alias("a"), F.max("u").alias("z")).where("a < z").select("k", "a")
    edges = edges.unionByName(placed_ids.join(shared, "k").where("u > a").select("a", F.col("u").alias("b")))
    links = components(edges, tag="jaccard-links")
    roots = sets.select("u", "k").join(links.withColumnRenamed("node", "u"), "u", "left").select("u", F.coalesce("root", "u").alias("root"), "k")
    # the smallest id of a component, partial by task before it is joined; a large component is a hot key
    least = staged(roots.groupBy("root").agg(F.min("k").alias("component_id"), F.count(F.lit(1)).alias("size")), "jaccard-least")
    named_sets = join_hot(roots, least, ["root"], "size", max(1, n_sets)).select("u", "component_id")
    copies = staged(named_sets.join(sets.select("u", "copies"), "u"), "jaccard-named")
    found = join_hot(placed_ids, copies, ["u"], "copies", max(1, n_sets)).select("k", "n", "component_id")
    alone = profiles.where("n = 0").select("k", "n", F.lit(None).cast("long").alias("component_id"))
    # a blank row of an id that has a text elsewhere belongs to it
    linked = shared_with_blank(alone, found)
    lost = docs.where(named(id_col).isNull()).select(F.lit(NO_ID).cast("long").alias("k"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("component_id"))
    out = found.unionByName(linked).unionByName(lost)
    return out.select(known_id().alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def shared_with_blank(blank: DataFrame, found: DataFrame) -> DataFrame:
    """Rows without a set (k, n, component_id), with the component of their id's other rows, else with their own."""
    own = found.select("k", F.col("component_id").alias("c")).join(blank.select("k").distinct(), "k", "left_semi").distinct()
    return blank.join(own, "k", "left").select("k", "n", F.coalesce("c", "k").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those whose component has a smaller id; rows that repeat an id stay or go together."""
    found = near_duplicates(docs, width, num, den, id_col, text_col)
    gone = found.where(F.col("component_id") != named(id_col)).select(named(id_col).alias("k")).distinct()
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("r"), named(id_col).cast("long").alias("k"))
    return rows.join(gone, "k", "left_anti").select(*[F.col("r").getField(c).alias(c) for c in docs.columns])
