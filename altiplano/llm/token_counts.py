"""Token counts of a sentencepiece model without materialising ids.

A pre-token is a run of spaces with the word after it, or a newline with the word after it: no piece of the vocabulary
has a space after another character, or a newline beside one, so no merge crosses a pre-token's edge and a text's count
is the sum over its pre-tokens.  One pass turns blocks of documents into the block's distinct pre-tokens, dealt into
buckets by hash, and each document's frequencies as packed numbers into the block's list.  A bucket counts the pieces
of each distinct pre-token once; the counts go back to the blocks and are joined to the frequencies there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hash_words, known_id, raw, runs, staged

SPACE_MARK = "▁".encode()
#: A block is closed beyond this many bytes of text; a bucket is meant to hold about this many bytes of pre-tokens.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 4 << 20
_RUN = re.compile(rb"( *)([^ ]*)")


def pretokens(text: bytes) -> list[bytes]:
    """A word stands for itself with one space before it; more spaces are kept less one; a newline is kept."""
    if not text:
        return []
    if SPACE_MARK in text:
        text = text.replace(SPACE_MARK, b" ")
    if b"  " not in text and text[:1] != b" ":
        return text.replace(b"\n", b" \n").split(b" ")
    out = []
    for i, line in enumerate(text.split(b"\n")):
        if i == 0:
            line = b" " + line
        elif line[:1] in (b" ", b""):
            out.append(b"\n")
        for spaces, word in _RUN.findall(line):
            if spaces:
                out.append(spaces[1:] + word)
            elif word:
                out.append(b"\n" + word)
    return out


def piece_counts(model, tokens: list[bytes]) -> list[int]:
    """Pieces of each pre-token.  The library puts a space before what it is given; before a newline that is one piece
    more than there is, and of nothing it makes no piece where a lone space is one."""
    got = model.encode([t.decode("utf-8", "replace") for t in tokens], num_threads=1)
    return [1 if not t else len(g) - (t[:1] == b"\n") for t, g in zip(tokens, got, strict=True)]


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending integers as their differences, a byte each, with 255 for 255 more."""
    d = np.diff(values, prepend=0)
    q = d // 255
    ends = np.cumsum(q + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 255, np.uint8)
    out[ends] = d - 255 * q
    return out.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    b = np.frombuffer(blob, np.uint8)
    return np.cumsum(b, dtype=np.int64)[b != 255]


class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else data


def _documents(rows: list[tuple[int, int, bytes]]) -> bytes:
    """A block's documents as one blob: their number, ids, sizes, lengths of the frequencies, and the frequencies."""
    head = np.array([[k, n, len(f)] for k, n, f in rows], "<i8").T
    return np.int64(len(rows)).tobytes() + head.tobytes() + b"".join(f for _, _, f in rows)


def _undocuments(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    k, sizes, lengths = np.frombuffer(data, "<i8", 3 * n, 8).reshape(3, n)
    at = 8 + 24 * n
    for x, size, length in zip(k.tolist(), sizes.tolist(), lengths.tolist(), strict=True):
        yield x, size, data[at : at + length]
        at += length


def _blocks(n_buckets: int):
    def run(batches) -> Iterator[dict]:
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        seq, numbers, size, rows = 0, _Numbers(), 0, []

        def close() -> dict:
            block = base + seq
            tokens = list(numbers)
            bucket = (hash_words(tokens) % np.uint64(n_buckets)).astype(np.uint32)
            order = np.argsort(bucket, kind="stable")
            sorted_buckets = bucket[order]
            starts, ends = runs(sorted_buckets)
            out = [(2, block, -1, squeeze(bucket.tobytes()))]
            for a, b in zip(starts, ends, strict=True):
                out.append((0, block, int(sorted_buckets[a]), squeeze(b"\xff".join([tokens[i] for i in order[a:b]]))))
            out.append((1, block, -1, squeeze(_documents(rows))))
            return dict(zip(("kind", "block", "bucket", "data"), map(list, zip(*out, strict=True)), strict=True))

        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                toks = pretokens(text)
                ids = np.sort(np.fromiter(map(numbers.__getitem__, toks), np.int64, len(toks)))
                rows.append((k, len(text), pack_sorted(ids)))
                size += len(text)
                if size > BLOCK_BYTES:
                    yield close()
                    seq, numbers, size, rows = seq + 1, _Numbers(), 0, []
        if rows:
            yield close()

    return run


def _count(model_file: str):
    def run(batches) -> Iterator[dict]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        bucket, known = None, {}
        for batch in batches:
            out = []
            for block, b, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if b != bucket:
                    bucket, known = b, {}
                tokens = unsqueeze(data).split(b"\xff")
                new = [t for t in dict.fromkeys(tokens) if t not in known]
                known.update(zip(new, piece_counts(model, new), strict=True))
                out.append((block, b, squeeze(np.fromiter(map(known.__getitem__, tokens), np.uint32, len(tokens)).tobytes())))
            if out:
                yield dict(zip(("block", "bucket", "data"), map(list, zip(*out, strict=True)), strict=True))

    return run


def _sum(batches) -> Iterator[dict]:
    """Rows come by block: first the block's bucket numbers, then the counts by bucket, then the documents."""
    now, buckets, replies = None, None, {}
    for batch in batches:
        ks, sizes, sums = [], [], []
        for kind, block, bucket, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if block != now:
                now, buckets, replies = block, None, {}
            if kind == 0:
                buckets = np.frombuffer(unsqueeze(data), np.uint32)
            elif kind == 1:
                replies[bucket] = np.frombuffer(unsqueeze(data), np.uint32)
            else:
                counts = np.zeros(len(buckets), np.int64)
                if replies:
                    counts[np.argsort(buckets, kind="stable")] = np.concatenate([replies[b] for b in sorted(replies)])
                for k, n_bytes, ids in _undocuments(unsqueeze(data)):
                    ks.append(k)
                    sizes.append(n_bytes)
                    sums.append(int(counts[unpack_sorted(ids)].sum()))
        if ks:
            yield {"k": ks, "n_bytes": sizes, "n_tokens": sums}


def count_tokens(docs: DataFrame, model_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes, n_tokens, over_limit for every row of docs.

    model_file is read by the executors: a file of an installed package, or one sent with addFile.  A null text counts
    as empty and has no tokens; a null id comes back null; repeated rows come back as often; no rows give none.
    """
    rows = raw(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = int(min(1 << 20, max(16, size // 5 // BUCKET_BYTES)))
    cols = "kind int, block long, bucket int, data binary"
    blocks = staged(arrow_map(rows, _blocks(n_buckets), cols), "tokens-blocks")
    asked = blocks.where("kind = 0").select("block", "bucket", "data").repartition("bucket").sortWithinPartitions("bucket")
    replies = arrow_map(asked, _count(model_file), "block long, bucket int, data binary")
    back = blocks.where("kind = 2").withColumn("kind", F.lit(0)).unionByName(replies.select(F.lit(1).alias("kind"), "block", "bucket", "data")).unionByName(blocks.where("kind = 1").withColumn("kind", F.lit(2)))
    out = arrow_map(back.repartition("block").sortWithinPartitions("block", "kind", "bucket"), _sum, "k long, n_bytes long, n_tokens long")
    return out.select(known_id().alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
