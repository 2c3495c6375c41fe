"""An elevation model that grows as tiles of points arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import dsm


class GrowingGrid:
    """Sums and counts by cell, kept as one table a batch.

    A batch writes to the folder of its number, so a batch that is run again replaces what it wrote.  The stream's
    checkpoint lies beside the table and is the same at every start, so a restarted stream goes on with its numbers
    and each point counts once.  Another stream needs another path.
    """

    def __init__(self, path: str, step: float, values: list[str] | None = None):
        self.path, self.step, self.values = path.rstrip("/"), step, values or ["z"]

    def add(self, batch: DataFrame, number: int) -> None:
        dsm.partial(batch, self.step, self.values).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self, spark: SparkSession) -> DataFrame:
        """cx, cy, n and the mean of each value so far."""
        own = spark.read.parquet(self.path)
        sums = own.groupBy("cx", "cy").agg(F.sum("n").alias("n"), *[F.sum(v).alias(v) for v in self.values])
        return sums.select("cx", "cy", "n", *[(F.col(v) / F.col("n")).alias(v) for v in self.values])

    def start(self, stream: DataFrame, checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
        where = checkpoint or self.path + "-checkpoint"
        writer = stream.writeStream.foreachBatch(self.add).option("checkpointLocation", where)
        return (writer.trigger(availableNow=True) if once else writer).start()
