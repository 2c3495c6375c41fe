"""Substring dedup: windows of words found before are removed, behind a count-min prefilter.

Pass one hashes every window into a count-min sketch: each task adds its windows to two rows of counters (sparse, in
segments), segments are merged, and a bit says which counter was reached at least twice.  Counters never underestimate,
so a window that occurs twice has both its bits set.  Pass two looks every window up and groups only those with both
bits, exactly, by a 96-bit hash of their words, so nothing repeated is lost.  The bits are broadcast: at most
2 * 2**MAX_BITS bits (64 MiB) whatever the input.  Beyond some 10**9 windows the filter lets more unique windows pass,
up to all, which the second pass then shuffles; results stay exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BLOCKS, arrow_map, bloom, hash_words, known_id, maybe_in, mix, raw, rolling, runs, staged
from .token_counts import pack_sorted, squeeze, unpack_sorted, unsqueeze

MAX_BITS, SEGMENT_BITS = 28, 18
#: Windows held by a task before it hands over what it has.
FLUSH = 1_500_000
_ROW = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_RECORD = np.dtype([("a", "<u8"), ("b", "<u4"), ("k", "<i8"), ("s", "<i4")])


def _windows(batch, width: int, second: bool = False) -> tuple[np.ndarray, ...]:
    """hash, id and start of each window of a batch, none across two documents; second: a further 64 bits of hash."""
    words, sizes = [], []
    for text in batch.column(1).to_pylist():
        w = text.split()
        words += w
        sizes.append(len(w))
    sizes = np.array(sizes, np.int64)
    ends = np.cumsum(sizes)
    one = hash_words(words)
    h = rolling(one, width)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(h)]
    ok = np.flatnonzero(np.arange(len(h)) + width <= ends[doc]) if len(h) else np.empty(0, np.int64)
    doc = doc[ok]
    found = h[ok], batch.column(0).to_numpy()[doc], (ok - (ends - sizes)[doc]).astype(np.int32)
    return (*found, rolling(mix(one ^ np.uint64(0xA0761D6478BD642F)), width, 0xE7037ED1A0B428DB)[ok]) if second else found


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(h ^ _ROW[row]) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(width: int, bits: int):
    seg_bits = min(bits, SEGMENT_BITS)

    def run(batches) -> Iterator[dict]:
        held, n = [], 0

        def flush() -> Iterator[dict]:
            h = np.concatenate(held)
            for row in range(2):
                cells = np.sort(_cells(h, row, bits))
                start, end = runs(cells)
                once, many = cells[start], cells[start[end - start > 1]]
                edges = np.arange(0, (1 << bits) + 1, 1 << seg_bits)
                i, j = np.searchsorted(once, edges), np.searchsorted(many, edges)
                out = {"part": [], "once": [], "many": []}
                for s in np.flatnonzero(np.diff(i)):
                    out["part"].append((row << 20) + int(s))
                    out["once"].append(pack_sorted(once[i[s] : i[s + 1]] - edges[s]))
                    out["many"].append(pack_sorted(many[j[s] : j[s + 1]] - edges[s]))
                yield out

        for batch in batches:
            h, _, _ = _windows(batch, width)
            held.append(h)
            n += len(h)
            if n >= FLUSH:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return run


def _merge(bits: int):
    size = 1 << min(bits, SEGMENT_BITS)

    def run(batches) -> Iterator[dict]:
        now, total = None, None
        for batch in batches:
            for part, once, many in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part != now:
                    if now is not None:
                        yield {"part": [now], "bits": [np.packbits(total > 1).tobytes()]}
                    now, total = part, np.zeros(size, np.uint8)
                for blob in (once, many):  # saturating: only 0, 1 and more matter
                    at = unpack_sorted(blob)
                    total[at] = np.minimum(total[at] + 1, 2)
        if now is not None:
            yield {"part": [now], "bits": [np.packbits(total > 1).tobytes()]}

    return run


def repeated_bits(rows: DataFrame, width: int, n_windows: int, max_bits: int = MAX_BITS) -> tuple[int, list[np.ndarray]]:
    """Bits a row, and for both rows the packed bits of counters that were reached twice."""
    bits = min(max_bits, max(10, int(2 * n_windows).bit_length()))
    seg_bits = min(bits, SEGMENT_BITS)
    partial = arrow_map(rows, _sketch(width, bits), "part int, once binary, many binary")
    merged = arrow_map(partial.repartition("part").sortWithinPartitions("part"), _merge(bits), "part int, bits binary")
    table = [np.zeros(max(1, (1 << bits) // 8), np.uint8) for _ in range(2)]
    step = max(1, (1 << seg_bits) // 8)
    for r in merged.toLocalIterator():  # bounded: at most 2 * 2**max_bits bits
        at = (r["part"] & ((1 << 20) - 1)) * step
        table[r["part"] >> 20][at : at + step] = np.frombuffer(r["bits"], np.uint8)
    return bits, table


def _lookup(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (table[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1


def _candidates(width: int, bits: int, tables, n_buckets: int, n_docs: int):
    """Windows with both bits: a task's first of each goes to its bucket, and the rest are later for certain."""

    def run(batches) -> Iterator[dict]:
        table = tables.value
        held, n = [], 0

        def flush() -> Iterator[dict]:
            got = np.concatenate(held)
            got = got[np.lexsort((got["s"], got["k"], got["b"], got["a"]))]
            new = np.r_[True, (got["a"][1:] != got["a"][:-1]) | (got["b"][1:] != got["b"][:-1])]
            same = np.r_[False, ~new[1:] & (got["k"][1:] == got["k"][:-1]) & (got["s"][1:] == got["s"][:-1])]
            # a repeat of the very same place (a repeated row) is no later copy
            first_of = np.maximum.accumulate(np.where(new, np.arange(len(got)), 0))
            own = ~new & (got["k"] == got["k"][first_of]) & (got["s"] == got["s"][first_of])
            yield from _places(got[~new & ~own & ~same], n_docs)
            first = got[new]
            bucket = (first["a"] % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, bucket = first[order], bucket[order]
            a, b = runs(bucket)
            # column by column, so that the compression finds the like bytes
            data = [squeeze(b"".join(np.ascontiguousarray(first[f][i:j]).tobytes() for f in _RECORD.names)) for i, j in zip(a, b, strict=True)]
            yield {"bucket": bucket[a].tolist(), "data": data}

        for batch in batches:
            h, k, s, b = _windows(batch, width, second=True)
            hit = _lookup(table[0], _cells(h, 0, bits))
            hit[hit] = _lookup(table[1], _cells(h[hit], 1, bits))
            rec = np.empty(int(hit.sum()), _RECORD)
            rec["a"], rec["b"], rec["k"], rec["s"] = h[hit], b[hit] >> np.uint64(32), k[hit], s[hit]
            held.append(rec)
            n += len(rec)
            if n >= FLUSH // 3:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return run


def doc_bucket(k: np.ndarray, n: int) -> np.ndarray:
    return (mix(k.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int64)


def _places(rec: np.ndarray, n_docs: int) -> Iterator[dict]:
    """Rows (bucket, data) of later windows: the ids and starts of a bucket of documents, which is -1 - bucket."""
    if len(rec):
        bucket = doc_bucket(rec["k"], n_docs)
        order = np.lexsort((rec["s"], rec["k"], bucket))
        rec, bucket = rec[order], bucket[order]
        a, b = runs(bucket)
        yield {"bucket": (-1 - bucket[a]).tolist(), "data": [squeeze(rec["k"][i:j].tobytes() + rec["s"][i:j].tobytes()) for i, j in zip(a, b, strict=True)]}


def _exact(n_docs: int):
    """Buckets, one after the other: of each window's occurrences all but the first are later."""

    def run(batches) -> Iterator[dict]:
        now, held, found, n = None, [], [], 0

        def close() -> np.ndarray:
            got = np.concatenate(held)
            got = got[np.lexsort((got["s"], got["k"], got["b"], got["a"]))]
            new = np.r_[True, (got["a"][1:] != got["a"][:-1]) | (got["b"][1:] != got["b"][:-1])]
            first_of = np.maximum.accumulate(np.where(new, np.arange(len(got)), 0))
            return got[~new & ((got["k"] != got["k"][first_of]) | (got["s"] != got["s"][first_of]))]

        for batch in batches:
            passed: dict[str, list] = {"bucket": [], "data": []}
            for bucket, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket < 0:
                    passed["bucket"].append(bucket)
                    passed["data"].append(data)
                    continue
                if bucket != now and held:
                    found.append(close())
                    n += len(found[-1])
                    held = []
                    if n >= FLUSH:
                        yield from _places(np.concatenate(found), n_docs)
                        found, n = [], 0
                now, data = bucket, unsqueeze(data)
                size = len(data) // _RECORD.itemsize
                rec, at = np.empty(size, _RECORD), 0
                for f in _RECORD.names:
                    rec[f] = np.frombuffer(data, _RECORD[f], size, at)
                    at += size * _RECORD[f].itemsize
                held.append(rec)
            if passed["bucket"]:
                yield passed
        if held:
            found.append(close())
        if found:
            yield from _places(np.concatenate(found), n_docs)

    return run


def _unplace(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = unsqueeze(data)
    n = len(data) // 12
    return np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i4", n, 8 * n)


def _ids(batches) -> Iterator[dict]:
    """The distinct ids of a task's places."""
    held, n = [], 0
    for batch in batches:
        new = [np.unique(_unplace(d)[0]) for d in batch.column(0).to_pylist()]
        held += new
        n += sum(map(len, new))
        if n > 8 * FLUSH:
            held = [np.unique(np.concatenate(held))]
            if len(held[0]) > FLUSH:
                yield {"k": held.pop()}
            n = 0
    if held:
        yield {"k": np.unique(np.concatenate(held))}


def later_windows(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """(bucket, data) with the places of windows that also start earlier, packed by bucket of documents, and the
    number of those buckets."""
    rows = raw(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_windows = size // 6 + 1  # a guess, for the sizes only
    bits, table = repeated_bits(rows, width, n_windows, max_bits)
    n_buckets, n_docs = (int(min(1 << 20, max(16, n_windows // each))) for each in (250_000, 2_000_000))
    spread = arrow_map(rows, _candidates(width, bits, docs.sparkSession.sparkContext.broadcast(table), n_buckets, n_docs), "bucket int, data binary")
    later = arrow_map(spread.repartition("bucket").sortWithinPartitions("bucket"), _exact(n_docs), "bucket int, data binary")
    return later.select((-1 - F.col("bucket")).alias("bucket"), "data"), n_docs


def covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Whether each word is inside a window that begins at one of the starts."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.unique(starts)
    edge[at] += 1
    edge[np.minimum(at + width, n_words)] -= 1
    return np.cumsum(edge)[:n_words] > 0


def _rest(width: int, digest: bool):
    """Rows (bucket, k, data, b): of each bucket first the places (no text), then the texts."""

    def run(batches) -> Iterator[dict]:
        now, places = None, []
        ids = starts = np.empty(0, np.int64)
        for batch in batches:
            out = {"k": [], "n_words": [], "n_removed": [], "kept": []}
            for bucket, k, data, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now:
                    now, places = bucket, []
                    ids = starts = np.empty(0, np.int64)
                if data is not None:
                    places.append(_unplace(data))
                    continue
                if places:
                    ids, starts = (np.concatenate(x) for x in zip(*places, strict=True))
                    order = np.argsort(ids, kind="stable")
                    ids, starts, places = ids[order], starts[order], []
                words = text.split()
                n, gone = len(words), 0
                i, j = np.searchsorted(ids, k, "left"), np.searchsorted(ids, k, "right")
                if j > i:
                    hit = covered(n, starts[i:j], width)
                    gone = int(hit.sum())
                    words = [w for w, x in zip(words, hit.tolist(), strict=True) if not x]
                kept = b" ".join(words)
                out["k"].append(k)
                out["n_words"].append(n)
                out["n_removed"].append(gone)
                out["kept"].append(hashlib.sha256(kept).hexdigest() if digest else kept)
            if out["k"]:
                yield out

    return run


def dedup_substrings(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, max_bits: int = MAX_BITS) -> DataFrame:
    """id_col, n_words, n_removed, kept: the words left, joined by one space (digest: their SHA-256 as kept_sha256).

    A window is `width` consecutive words of a document; a word is removed when a window over it has the words of one
    that starts earlier, by smaller id or by smaller start within the document.  Judged on the input.  A null text has
    no words.  Rows with a null id come first, in the order of a hash of their texts, and come back with null.  Rows that
    repeat an id (or have none, and the same text) are that document again, at the same places, so they are no copies
    of each other.  Texts shorter than a window lose nothing; other columns are not read; no rows: no rows.
    """
    later, n_docs = later_windows(docs, width, id_col, text_col, max_bits)
    # by bucket, so that a document's places are in one file
    later = staged(later.repartition("bucket"), "substring-later")
    ids = arrow_map(later.select("data"), _ids, "k long").distinct()
    # only texts that may have one are shuffled to their places
    table, blocks = bloom(ids, "k", ids.count(), BROADCAST_BLOCKS)
    rows = maybe_in(raw(docs, id_col, text_col), "k", table, blocks, "near")
    near = arrow_map(rows.where("near").select("k", "b"), _dealt(n_docs), "bucket int, k long, data binary, b binary")
    met = near.unionByName(later.select("bucket", F.lit(None).cast("long").alias("k"), "data", F.lit(None).cast("binary").alias("b")))
    met = met.repartition("bucket").sortWithinPartitions("bucket", F.col("data").isNull())
    far = rows.where("NOT near").select(F.lit(0).alias("bucket"), "k", F.lit(None).cast("binary").alias("data"), "b")
    schema = f"k long, n_words long, n_removed long, kept {'string' if digest else 'binary'}"
    out = arrow_map(met, _rest(width, digest), schema).unionByName(arrow_map(far, _rest(width, digest), schema))
    out = out.withColumnRenamed("kept", "kept_sha256") if digest else out.withColumn("kept", F.col("kept").cast("string"))
    return out.withColumn("k", known_id()).withColumnRenamed("k", id_col)


def _dealt(n_docs: int):
    def run(batches) -> Iterator[dict]:
        for batch in batches:
            k = batch.column(0).to_numpy()
            if len(k):
                yield {"bucket": doc_bucket(k, n_docs), "k": k, "data": [None] * len(k), "b": batch.column(1).to_pylist()}

    return run
