"""Polygons of GeoJSON text: a collection's first feature, a feature, or a geometry; the outer ring only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GEOMETRY = "struct<type:string,coordinates:array<array<array<double>>>>"
SCHEMA = f"type string, coordinates array<array<array<double>>>, geometry {_GEOMETRY}, features array<struct<geometry:{_GEOMETRY}>>"


def ring(text: Column) -> Column:
    """array<struct<lon, lat>>, null where there is no polygon."""
    parsed = F.from_json(text, SCHEMA)
    outer = F.get(F.coalesce(F.get(parsed["features"], F.lit(0))["geometry"]["coordinates"], parsed["geometry"]["coordinates"], parsed["coordinates"]), F.lit(0))
    return F.transform(outer, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, ring of every file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), ring(F.col("value")).alias("ring"))
