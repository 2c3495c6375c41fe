"""Polygons of GML masks, in image coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"


def rings(content: Column) -> Column:
    """array of rings, each an array of struct<x, y>: every posList (with its dimension) or coordinates element.

    Rings of fewer than three points are left out; text without polygons has none.
    """
    found = F.regexp_extract_all(content, F.lit(r"(?s)(<(?:\w+:)?(?:posList|coordinates)\b[^>]*>[^<]*)<"), 1)

    def ring(text: Column) -> Column:
        head, body = F.regexp_extract(text, r"^<([^>]*)>", 1), F.regexp_replace(text, r"^<[^>]*>", "")
        n = F.transform(F.regexp_extract_all(body, F.lit(f"({_NUMBER})"), 1), lambda x: x.cast("double"))
        # a posList has two numbers a point unless it says otherwise; the tuples of coordinates say it by their commas
        stated = F.regexp_extract(head, r"srsDimension=[\"'](\d)", 1).try_cast("int")
        tuples = F.size(F.split(F.regexp_extract(body, r"^\s*(\S+)", 1), ","))
        step = F.coalesce(stated, F.when(tuples > 1, tuples), F.lit(2))
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / step).cast("int") - 1), lambda i: F.struct(F.get(n, i * step).alias("x"), F.get(n, i * step + 1).alias("y")))

    return F.filter(F.transform(F.filter(found, lambda t: t.rlike(r">[^<]*[0-9]")), ring), lambda r: F.size(r) >= 3)
