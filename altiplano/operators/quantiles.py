"""Exact order statistics by key without a key's values in one place: a sketch brackets, counts place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places that the sketch may err by: n / ACCURACY; keys of fewer than SMALL values are bracketed by their extremes.
ACCURACY, SMALL = 10_000, 50_000


def order_statistics(df: DataFrame, v: str, keys: list[str], share: float, places: dict[str, Column]) -> DataFrame:
    """keys, n, and by name the value at each place (from 0, a column of n near share * n) of the sorted values of v.

    1. One aggregation by key counts the values and brackets the places by approximate percentiles.
    2. Values below the bracket are counted, those inside (some 0.4 % of a large key) are grouped by value, and the
       running count in that group finds the places.
    Nulls are no values; a key with none has no row.  The brackets are one row a key.
    """
    v_ = F.col(v).cast("double")
    rows = df.where(v_.isNotNull()).select(*keys, v_.alias("_v"))
    near = [min(max(share + d, 0.0), 1.0) for d in (-20 / ACCURACY, 20 / ACCURACY)]
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"), F.percentile_approx("_v", near, ACCURACY).alias("_p"))
    small = F.col("n") < SMALL
    box = found.select(*keys, "n", F.when(small | F.lit(near[0] == 0), F.col("_a")).otherwise(F.col("_p")[0]).alias("_lo"), F.when(small | F.lit(near[1] == 1), F.col("_b")).otherwise(F.col("_p")[1]).alias("_hi"))
    met = rows.join(box, keys) if keys else rows.crossJoin(F.broadcast(box))
    inside = met.where(F.col("_v") <= F.col("_hi")).groupBy(*keys, "n", F.greatest("_v", "_lo").alias("_at"), (F.col("_v") >= F.col("_lo")).alias("_in")).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_at", "_in").rowsBetween(Window.unboundedPreceding, 0))
    placed = inside.withColumn("_to", upto).where("_in").withColumn("_from", F.col("_to") - F.col("_c"))
    value = lambda at: F.max(F.when((at >= F.col("_from")) & (at < F.col("_to")), F.col("_at")))
    out = placed.groupBy(*keys, "n").agg(*[value(at).alias(name) for name, at in places.items()])
    return out.select(*keys, "n", *[F.coalesce(F.col(name), F.raise_error(F.lit("a place is outside its bracket")).cast("double")).alias(name) for name in places])


def quantile(df: DataFrame, v: str, keys: list[str], share: float, name: str = "q") -> DataFrame:
    """keys, name: the value at share * (n - 1), between two places by straight line."""
    at = F.lit(float(share)) * (F.col("n") - 1)
    got = order_statistics(df, v, keys, share, {"_low": F.floor(at), "_high": F.ceil(at)})
    return got.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * (at - F.floor(at))).alias(name))


def upper_median(df: DataFrame, v: str, keys: list[str], name: str = "q") -> DataFrame:
    """keys, name: the value at place n div 2."""
    return order_statistics(df, v, keys, 0.5, {name: F.floor(F.col("n") / 2)}).select(*keys, name)
