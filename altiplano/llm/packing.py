"""Best-fit packing of documents into sequences: vector best-fit over tokens, documents and attention cost.

One pass tokenises and cuts documents into pieces (a table of lengths and checksums, no ids).  Pieces are dealt into
groups of about GROUP_BINS sequences' tokens by hash, and each group is packed alone, largest first: of the open
sequences whose residual capacities hold the piece in every dimension, the one with the best score takes it.  A group
leaves its last few sequences part empty, some 1 in GROUP_BINS.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, known_id, raw, staged

GROUP_BINS, GROUP_PIECES = 2000, 60_000
#: Text handled at once, word forms that a worker remembers (forgetting only costs time), and the longest of them.
CHUNK_BYTES, KNOWN_FORMS, KNOWN_CHARS = 8 << 20, 400_000, 60
#: Word forms that are tokenised in one text.
JOINED = 64


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs [start, start + size) of flat, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class WordIds:
    """Ids of texts word by word: words are split, lowered and numbered in Arrow, and only new forms are tokenised.

    The tokenizer drops white space, never merges across it, and lowers; so a text's ids are those of its words in
    turn, and ASCII letters may be lowered before.  A word's form is the word less a last . or , after an ASCII letter
    or digit, as that is a token run of its own.  Texts that may hold a special token are tokenised whole.  New forms are
    tokenised some at a time, with a full stop after each, whose id ends it; those that hold one, or a special token's
    first characters, are tokenised alone.
    """

    def __init__(self, model_file: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(model_file)
        self.plain = Tokenizer.from_file(model_file)
        self.plain.normalizer = None  # lower-case ASCII letters and digits are normal already
        self.tails = [self.model.encode(x, add_special_tokens=False).ids for x in ("", ".", ",")]
        if any(len(t) != 1 for t in self.tails[1:]):
            raise ValueError("the tokenizer has no single ids for . and ,")
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat, self.starts = array("I"), array("q", [0])

    def _encode(self, model, forms: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the forms, one after the other, and how many each has; joined: none holds a full stop or <|."""
        if joined:
            texts = [" . ".join([*forms[i : i + JOINED], ""]) for i in range(0, len(forms), JOINED)]
            ids = np.fromiter(chain.from_iterable([g.ids for g in model.encode_batch_fast(texts, add_special_tokens=False)]), np.uint32)
            stop = ids == self.tails[1][0]
            ends = np.flatnonzero(stop)
            if len(ends) == len(forms):
                return ids[~stop], np.diff(ends, prepend=-1) - 1
        each = [g.ids for g in model.encode_batch_fast(forms, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(each), np.uint32), np.array([len(x) for x in each], np.int64)

    def _learn(self, distinct: pa.Array) -> np.ndarray:
        """Rows of the forms in the store."""
        forms = distinct.to_pylist()
        rows = np.fromiter(map(self.rows.get, forms, repeat(-1)), np.int64, len(forms))
        new = rows < 0
        plain = pc.ascii_is_alnum(distinct).to_numpy(zero_copy_only=False)
        alone = pc.match_substring_regex(distinct, r"\.|<\|").to_numpy(zero_copy_only=False)
        for model, some, joined in ((self.plain, new & plain, True), (self.model, new & ~plain & ~alone, True), (self.model, new & alone, False)):
            at = np.flatnonzero(some)
            own = [forms[i] for i in at.tolist()]
            ids, sizes = self._encode(model, own, joined)
            first = len(self.starts) - 1
            ends = self.starts[-1] + np.cumsum(sizes)
            self.flat.frombytes(ids.tobytes())
            self.starts.frombytes(ends.astype(np.int64).tobytes())
            rows[at] = np.arange(first, first + len(own))
            self.rows.update((f, first + j) for j, f in enumerate(own) if len(f) <= KNOWN_CHARS)
        return rows

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's end."""
        if len(self.rows) > KNOWN_FORMS or len(self.flat) > 16 * KNOWN_FORMS:
            self.forget()
        whole = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = parts.flatten().dictionary_encode()
        tailed = pc.match_substring_regex(words.dictionary, r"[a-z0-9][.,]\z")
        tail = np.where(tailed.to_numpy(zero_copy_only=False), np.where(pc.ends_with(words.dictionary, ".").to_numpy(zero_copy_only=False), 1, 2), 0)
        forms = pc.if_else(tailed, pc.utf8_slice_codeunits(words.dictionary, 0, -1), words.dictionary).dictionary_encode()
        rows = self._learn(forms.dictionary)[forms.indices.to_numpy()]
        starts, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat, np.uint32) if len(self.flat) else np.empty(0, np.uint32)
        # each distinct word's ids, with room for its tail
        size = starts[rows + 1] - starts[rows]
        each = size + (tail > 0)
        begin = np.cumsum(each) - each
        own = np.empty(int(each.sum()), np.uint32)
        own[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = gather(flat, starts[rows], size)
        last = begin + size
        for k in (1, 2):
            own[last[tail == k]] = self.tails[k][0]
        del starts, flat  # the store can grow again
        own_ids = pa.ListArray.from_arrays(pa.array(np.r_[begin, len(own)], pa.int32()), pa.array(own))
        taken = own_ids.take(words.indices)
        ids = taken.flatten().to_numpy()
        ends = (taken.offsets.to_numpy() - taken.offsets[0].as_py())[parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()]
        if len(whole):
            pieces = np.split(ids, ends[:-1])
            for i in whole.tolist():
                pieces[i] = np.array(self.model.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            ids, ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        return ids, ends


_IDS: dict[str, WordIds] = {}


def as_text(column: pa.Array) -> pa.Array:
    """UTF-8 bytes as text; what is not valid is replaced."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in column.to_pylist()], pa.string())


def _pieces(model_file: str, end_id: int, size: int):
    """k, piece, start, length, crc of every piece of every document."""

    def run(batches) -> Iterator[dict]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if model_file not in _IDS:  # a worker keeps what it has learnt for its next task
            _IDS[model_file] = WordIds(model_file)
        end = np.uint32(end_id).tobytes()

        def cut(held: list) -> dict:
            ids, ends = _IDS[model_file].of(pa.concat_arrays([as_text(b.column(1)) for b in held]))
            data, at = ids.astype("<u4").tobytes(), 0
            out = {"k": [], "piece": [], "start": [], "length": [], "crc": []}
            for k, stop in zip(np.concatenate([b.column(0).to_numpy() for b in held]).tolist(), ends.tolist(), strict=True):
                own, at = data[4 * at : 4 * stop] + end, stop
                for p, begin in enumerate(range(0, len(own), 4 * size)):
                    part = own[begin : begin + 4 * size]
                    out["k"].append(k)
                    out["piece"].append(p)
                    out["start"].append(begin // 4)
                    out["length"].append(len(part) // 4)
                    out["crc"].append(zlib.crc32(part))
            return out

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.column(1).nbytes
            if n > CHUNK_BYTES:
                yield cut(held)
                held, n = [], 0
        if held:
            yield cut(held)

    return run


def vector_best_fit(demand: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """The bin of each item.  demand: items x dimensions; capacity: of one bin, by dimension.

    Items go largest first (by weighted share of the capacity).  Among the open bins that hold an item in every
    dimension, rule "norm" takes the least weighted norm of what would be left, "dot" the largest weighted product of
    demand and residual.  An item that no open bin holds opens one; one beyond an empty bin's capacity raises.
    """
    n = len(demand)
    share = demand / capacity
    if n and (share > 1).any():
        raise ValueError("an item exceeds a bin")
    out = np.full(n, -1, np.int64)
    order = np.argsort(-(share * weights).sum(1), kind="stable")
    least = np.minimum.accumulate(share[order][::-1], axis=0)[::-1] if n else share  # what any later item needs at least
    free, names, opened, bins = np.empty((64, share.shape[1])), np.empty(64, np.int64), 0, 0
    for rank, i in enumerate(order):
        need = share[i]
        left = free[:opened] - need
        fits = (left >= -1e-12).all(1)
        at = -1
        if fits.any():
            score = (left * left) @ weights if rule == "norm" else -(free[:opened] * need) @ weights
            at = int(np.where(fits, score, np.inf).argmin())
            free[at] = left[at]
        else:
            if opened == len(free):
                free, names = np.concatenate([free, np.empty_like(free)]), np.concatenate([names, np.empty_like(names)])
            at, free[opened], names[opened] = opened, 1 - need, bins
            opened, bins = opened + 1, bins + 1
        out[i] = names[at]
        if rank + 1 < n and (free[at] < least[rank + 1] - 1e-12).any():  # full for all that is to come
            opened -= 1
            free[at], names[at] = free[opened], names[opened]
    return out


def _pack(capacity: list[float], weights: list[float], rule: str):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "k", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        size = part["length"].to_numpy(np.float64)
        # whole sequences need no search
        full = size >= capacity[0]
        bins = np.arange(len(part), dtype=np.int64)
        rest = np.column_stack([size, np.ones(len(size)), size * size])[~full]
        bins[~full] = full.sum() + vector_best_fit(rest, np.array(capacity), np.array(weights), rule)
        part["sequence_id"] = part["g"].to_numpy(np.int64) * (1 << 32) + bins
        part["offset"] = part.groupby("sequence_id")["length"].cumsum() - part["length"]
        return part[["k", "piece", "start", "length", "crc", "sequence_id", "offset"]]

    return run


def pack(docs: DataFrame, model_file: str, size: int = 4096, end_id: int = 1, max_docs: int | None = None, max_attention: float | None = None, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.01, 0.01), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id, offset, one row for each piece.

    A sequence holds at most `size` tokens, max_docs pieces (default: no more than tokens) and max_attention summed
    squared lengths (default: that of one whole piece).  Documents longer than a sequence are cut into whole pieces
    and a rest.  A null text is empty: only the end id.  Null ids come back null; repeated rows are packed each on
    their own; no rows give none.  max_attention below size * size makes whole pieces impossible and raises.
    """
    schema = "k long, piece int, start long, length long, crc long"
    pieces = arrow_map(raw(docs, id_col, text_col), _pieces(model_file, end_id, size), schema)
    # the row number deals out pieces that are alike; written, so that it stays the same
    pieces = staged(pieces.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    tokens, n = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = int(max(1, (tokens or 0) // (size * GROUP_BINS), n // GROUP_PIECES))
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).drop("row")
    if groups == 1:
        dealt = dealt.repartition(1, "g")
    capacity = [float(size), float(max_docs or size), float(max_attention or size * size)]
    out = dealt.groupBy("g").applyInPandas(_pack(capacity, list(weights), rule), "k long, piece int, start long, length long, crc long, sequence_id long, offset long")
    return out.select(known_id().alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")
