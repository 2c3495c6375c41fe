"""What the operators of this subpackage share: Arrow passes, word hashing and Bloom filters, beside ..stage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..stage import components, dropped, join_hot, prepare, shared_dir, staged

__all__ = ["components", "dropped", "join_hot", "prepare", "shared_dir", "staged"]

#: ASCII white space, as the contracts list it; the same bytes that ``bytes.split()`` splits at.
SPACE = r"[\x20\x09-\x0D]+"
#: Ids below LOW stand for null ones: each such row is known by a hash of its text.
NO_ID, LOW = -(2**63), -(2**62)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once even where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def named(col: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + col.replace("`", "``") + "`")


def words_col(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def raw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, b): the id and the text's UTF-8 bytes (null: none), and no other column.

    A null id becomes a number below LOW by its text, so that rows without an id are no single hot key; rows without an
    id and with the same text are one document.  An id that is itself below LOW raises.
    """
    given, text = named(id_col).cast("long"), F.coalesce(named(text_col), F.lit(""))
    unnamed = F.lit(NO_ID) + F.xxhash64(text).bitwiseAND(F.lit(2**62 - 1))
    k = F.when(given.isNull(), unnamed).when(given < LOW, F.raise_error(F.lit("an id is too small")).cast("long")).otherwise(given)
    return docs.select(k.alias("k"), text.cast("binary").alias("b"))


def known_id(col: str = "k") -> Column:
    return F.when(F.col(col) >= LOW, F.col(col))


def give_back() -> None:
    """Return to the system what this process has freed: Arrow's pool and the C library keep it else.

    A worker waits up to a minute for its next task, beside stages without Python whose executor needs the memory.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """run, a function from batches to batches, with give_back() after the last one."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return through


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """fn(iterator of dict of columns) -> iterator of dict of columns, over Arrow batches; a task ends with give_back()."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            n = len(next(iter(out.values())))
            for at in range(0, n, 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name][at : at + 100_000], type=f.type) for f in target], schema=target)

    return df.mapInArrow(giving_back(run), schema)


class WordHash(dict):
    """64-bit hash of each word, remembered; emptied where it grows large (that only costs time)."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_HASH = WordHash()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (fixed multipliers, public domain finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(h: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each run of width values, by doubling: a run of a+b is made of a run of a and one of b."""
    if len(h) < width:
        return h[:0]
    done, have, n, power, out_power = None, 0, 1, base, 1
    run, m = h, width
    mask = (1 << 64) - 1
    with np.errstate(over="ignore"):
        while m:
            if m & 1:
                if done is None:
                    done, have, out_power = run, n, power
                else:
                    size = min(len(done), len(run) - have)
                    done = done[:size] * np.uint64(power) + run[have : have + size]
                    have, out_power = have + n, out_power * power & mask
            m >>= 1
            if m:
                run = run[: len(run) - n] * np.uint64(power) + run[n:]
                power, n = power * power & mask, 2 * n
        return mix(done[: len(h) - width + 1])


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal keys."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return at, np.r_[at[1:], len(sorted_keys)]


#: Blocks of a Bloom filter that go by broadcast (64 bytes each: 16 MiB); more are joined by block in a shuffle.
BROADCAST_BLOCKS = 1 << 18
KEYS_PER_BLOCK = 32


def _bloom_bits(key: Column) -> list[Column]:
    h = F.xxhash64(F.lit(11), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(8)]


def _bloom_block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(blocks - 1)


def bloom(keys: DataFrame, col: str, n: int, most: int | None = None) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of n keys as a table (block, w0..w7), and its blocks, a power of two, at most `most`."""
    blocks = 1
    while blocks * KEYS_PER_BLOCK < n and (most is None or blocks < most):
        blocks *= 2
    words = keys.select(_bloom_block(F.col(col), blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(_bloom_bits(F.col(col)))])
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)]), blocks


def maybe_in(df: DataFrame, col: str, table: DataFrame, blocks: int, name: str) -> DataFrame:
    """df with a boolean column: false where the key is in no row that the filter was made of (or null).

    Up to BROADCAST_BLOCKS the filter goes by broadcast.  Beyond, rows are joined by block: null keys have a place of
    their own outside the join, and a key that many rows have is split by its block's number of rows.
    """
    hit = F.lit(True)
    for i, bit in enumerate(_bloom_bits(F.col("__key"))):
        hit = hit & (F.col(f"__w{i}").bitwiseAND(bit) != 0)
    table = table.select(F.col("block").alias("__block"), *[F.col(f"w{i}").alias(f"__w{i}") for i in range(8)])
    rows = df.select(F.struct(*[named(c) for c in df.columns]).alias("__row"), named(col).alias("__key"))
    some = rows.where("__key IS NOT NULL").withColumn("__block", _bloom_block(F.col("__key"), blocks))
    if blocks <= BROADCAST_BLOCKS:
        met = some.join(F.broadcast(table), "__block", "left")
    else:
        load = staged(some.groupBy("__block").agg(F.count(F.lit(1)).alias("__n")).join(table, "__block", "left"), "bloom-load")
        met = join_hot(some, load, ["__block"], "__n", load.agg(F.sum("__n")).first()[0] or 0)
    out = met.select("__row", F.coalesce(hit, F.lit(False)).alias("__hit")).unionByName(rows.where("__key IS NULL").select("__row", F.lit(False).alias("__hit")))
    return out.select(*[F.col("__row").getField(c).alias(c) for c in df.columns], F.col("__hit").alias(name))
