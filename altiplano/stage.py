"""Staged tables, joins with hot keys, and connected components: what operators over large tables share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[1])


#: Rows and bytes of an Arrow batch that goes to a Python worker, where the session has no value of its own.
BATCH_ROWS, BATCH_BYTES = "1024", str(16 << 20)
#: What a session has that sets neither.
BATCH_DEFAULTS = ("10000", str(64 << 20))
#: Folders of staged tables by session, for release().
_STAGED: dict[int, list[str]] = {}
#: Edges that one task turns into a forest at once.
FOREST_EDGES = 1_000_000
#: Edges of a graph that one task settles, however many tasks found them.
FEW_EDGES = 50_000


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and bound an Arrow batch by rows and bytes (values can be long).

    A bound that the session has set itself stays as it is.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")) if x)
    for key, unset, value in (("maxRecordsPerBatch", BATCH_DEFAULTS[0], BATCH_ROWS), ("maxBytesPerBatch", BATCH_DEFAULTS[1], BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("b") == unset:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; unset, an own one, on a local master only."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        sc = spark.sparkContext
        if not sc.getCheckpointDir():
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="altiplano-"))
        at = sc.getCheckpointDir()
    return at.rstrip("/")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """df, written once to the shared folder and read back: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.setdefault(id(spark.sparkContext), []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of staged tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)
    kept = _STAGED.get(id(spark.sparkContext), [])
    _STAGED[id(spark.sparkContext)] = [p for p in kept if p not in set(paths)]


def mark(spark: SparkSession) -> set[str]:
    """The folders staged so far, for release()."""
    return set(_STAGED.get(id(spark.sparkContext), []))


def release(spark: SparkSession, since: set[str] = frozenset()) -> None:
    """Delete every table staged so far, or since a mark.  DataFrames that operators gave must have been written or
    collected."""
    dropped(spark, [p for p in _STAGED.get(id(spark.sparkContext), []) if p not in since])


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int, parts: int = 2000) -> DataFrame:
    """Inner join of left with right, which has one row for each key and the key's number of left rows in `count`.

    Keys with at least total / parts left rows are fewer than `parts`, so they go by broadcast; what is left for the
    shuffle has no key with more than total / parts rows.
    """
    least = max(1, -(-total // parts))
    hot, cold = right.where(F.col(count) >= least), right.where(F.col(count) < least)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys))


def least_names(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For places 0..n-1 linked by pairs (a, b): the least place that each reaches, by hooking and pointer jumping."""
    up = np.arange(n)
    while True:
        x, y = up[a], up[b]
        open_ = x != y
        if not open_.any():
            return up
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up != up[up]).any():
            up = up[up]


def _forest(batches):
    """Edges (u, v), some at a time, as stars: each node with the least one that it reaches by those edges."""
    import pyarrow as pa

    held, n = [], 0

    def stars() -> pa.RecordBatch:
        u, v = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = least_names(at[: len(u)], at[len(u) :], len(names))
        far = root != np.arange(len(names))
        return pa.RecordBatch.from_arrays([pa.array(names[root[far]]), pa.array(names[far])], names=["u", "v"])

    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy() for c in batch.columns])
            n += batch.num_rows
        if n >= FOREST_EDGES:
            yield stars()
            held, n = [], 0
    if held:
        yield stars()


def components(edges: DataFrame, a: str = "a", b: str = "b", tag: str = "cc") -> DataFrame:
    """(node, root): the smallest node reachable, for every node (a long) of the edges.

    Alternating star contraction; before each round every task makes stars of the edges it has, so that a graph that
    fits one task takes one round and a larger one few.  What is left below FEW_EDGES goes to one task.  Each round writes its edges to the shared folder and drops
    those of the round before; rounds end when nothing changes.  Rows are pre-aggregated by node, so a node with many
    edges is a few partial rows, and hot nodes are joined by broadcast.
    """
    spark = prepare(edges.sparkSession)

    def stars(linked: DataFrame) -> DataFrame:
        return staged(linked.mapInArrow(_forest, "u long, v long"), tag)

    def round_of(linked: DataFrame) -> DataFrame:
        return stars(linked.where("u < v").distinct())

    def settled(cur: DataFrame) -> DataFrame:
        return cur.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(cur.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())

    cur = round_of(edges.select(F.least(a, b).cast("long").alias("u"), F.greatest(a, b).cast("long").alias("v")))
    while True:
        if cur.count() < min(FEW_EDGES, FOREST_EDGES):
            few = stars(cur.coalesce(1))
            dropped(spark, [cur.staged_at])
            return settled(few)
        # every node's smallest known neighbour or itself, how often it is an edge's end, its larger end, its smaller end
        ends = cur.select(F.col("v").alias("x"), F.col("u").alias("m"), F.lit(1).alias("c")).unionByName(cur.select(F.col("u").alias("x"), F.col("u").alias("m"), F.lit(0).alias("c")))
        low = staged(ends.groupBy("x").agg(F.min("m").alias("m"), F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")), tag)
        # settled: every node has one edge, to a node that is nobody's child
        total, loose = low.agg(F.sum("c"), F.bool_or((F.col("c") > 1) | ((F.col("c") > 0) & (F.col("n") > F.col("c"))))).first()
        if not loose:
            dropped(spark, [low.staged_at])
            return settled(cur)
        # each edge's ends are hooked to the smallest of both
        right = low.select(F.col("x").alias("v"), F.col("m").alias("mv"), F.col("n").alias("nv"))
        left = low.select(F.col("x").alias("u"), F.col("m").alias("mu"), F.col("n").alias("nu"))
        both = join_hot(join_hot(cur, left, ["u"], "nu", 2 * total), right, ["v"], "nv", 2 * total)
        root = F.least("mu", "mv")
        linked = both.select(F.explode(F.array(*[F.struct(root.alias("u"), F.col(x).alias("v")) for x in ("u", "v", "mu", "mv")])).alias("e")).select("e.u", "e.v")
        old, cur = cur, round_of(linked)
        dropped(spark, [old.staged_at, low.staged_at])
