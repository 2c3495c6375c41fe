"""Camera files: text tags, two XML layouts, and metadata dumps, sniffed by content and read as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed names: the tag of each number in the text layout, and in the two XML layouts (plain and list).
TEXT_TAGS = {"LINE_OFF": "row_offset", "SAMP_OFF": "col_offset", "LAT_OFF": "lat_offset", "LONG_OFF": "lon_offset", "HEIGHT_OFF": "alt_offset", "LINE_SCALE": "row_scale", "SAMP_SCALE": "col_scale", "LAT_SCALE": "lat_scale", "LONG_SCALE": "lon_scale", "HEIGHT_SCALE": "alt_scale"}
TEXT_ARRAYS = {"LINE_NUM_COEFF": "row_num", "LINE_DEN_COEFF": "row_den", "SAMP_NUM_COEFF": "col_num", "SAMP_DEN_COEFF": "col_den"}
LIST_XML = {"LINEOFFSET": "row_offset", "SAMPOFFSET": "col_offset", "LATOFFSET": "lat_offset", "LONGOFFSET": "lon_offset", "HEIGHTOFFSET": "alt_offset", "LINESCALE": "row_scale", "SAMPSCALE": "col_scale", "LATSCALE": "lat_scale", "LONGSCALE": "lon_scale", "HEIGHTSCALE": "alt_scale", "LINENUMCOEF": "row_num", "LINEDENCOEF": "row_den", "SAMPNUMCOEF": "col_num", "SAMPDENCOEF": "col_den"}
PLAIN_XML = {"LINE_OFF": "row_offset", "SAMP_OFF": "col_offset", "LAT_OFF": "lat_offset", "LONG_OFF": "lon_offset", "HEIGHT_OFF": "alt_offset", "LINE_SCALE": "row_scale", "SAMP_SCALE": "col_scale", "LAT_SCALE": "lat_scale", "LONG_SCALE": "lon_scale", "HEIGHT_SCALE": "alt_scale"}


def sniff(content: Column) -> Column:
    """text, worldview or pleiades by the content's first marker that fits; null for none."""
    return (
        F.when(content.contains("LINE_OFF:"), "text")
        .when(content.contains("<SATID>") & content.contains("WV0"), "worldview")
        .when(content.contains("<METADATA_PROFILE>") & (content.contains("PHR_SENSOR") | content.contains("S6_SENSOR") | content.contains("S7_SENSOR")), "pleiades")
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """file, content, kind of camera files; whole files, as they are a few kilobytes each."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content")).withColumn("kind", sniff(F.col("content")))


def tag_lines(lines: DataFrame, text: str = "value", keys: list[str] = []) -> DataFrame:
    """keys, tag, number of the lines `TAG: number ...`; others are left out."""
    found = lines.select(*keys, F.regexp_extract(text, r"^\s*([A-Za-z_0-9]+)\s*[:=]", 1).alias("tag"), F.regexp_extract(text, r"[:=]\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)", 1).alias("n"))
    return found.where((F.col("tag") != "") & (F.col("n") != "")).select(*keys, "tag", F.col("n").cast("double").alias("number"))


def tag_slot(tag: Column) -> Column:
    """struct<name, slot>: the array and place (1-based names, clamped to 0..19) of a coefficient tag, slot -1 for a
    plain number; null for an unknown tag."""
    plain = F.create_map(*[x for k, v in TEXT_TAGS.items() for x in (F.lit(k), F.lit(v))])
    arrays = F.create_map(*[x for k, v in TEXT_ARRAYS.items() for x in (F.lit(k), F.lit(v))])
    stem, number = F.regexp_extract(tag, r"^(.*)_\d+$", 1), F.regexp_extract(tag, r"_(\d+)$", 1)
    slot = F.least(F.greatest(number.try_cast("int") - 1, F.lit(0)), F.lit(19))
    return F.when(plain[tag].isNotNull(), F.struct(plain[tag].alias("name"), F.lit(-1).alias("slot"))).when(arrays[stem].isNotNull(), F.struct(arrays[stem].alias("name"), slot.alias("slot")))


def cameras(tags: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rpc: one camera for each key from its tags (name, slot, number); incomplete arrays are null."""
    arrays, numbers = sorted(TEXT_ARRAYS.values()), sorted(TEXT_TAGS.values())
    both = tags.groupBy(*keys).agg(
        *[F.array_sort(F.collect_list(F.when(F.col("name") == a, F.struct("slot", "number")))).alias(a) for a in arrays],
        *[F.max(F.when(F.col("name") == n, F.col("number"))).alias(n) for n in numbers],
    )
    whole = [F.when(F.size(a) == 20, F.transform(a, lambda s: s["number"])).alias(a) for a in arrays]
    return both.select(*keys, F.struct(*whole, *numbers).alias("rpc"))


def parse_text(files: DataFrame, keys: list[str] = ["file"]) -> DataFrame:
    lines = files.where("kind = 'text'").select(*keys, F.explode(F.split("content", "\n")).alias("value"))
    tags = tag_lines(lines, "value", keys).withColumn("s", tag_slot(F.col("tag"))).where("s IS NOT NULL")
    return cameras(tags.select(*keys, "s.name", "s.slot", "number"), keys)


def parse_worldview(files: DataFrame, keys: list[str] = ["file"]) -> DataFrame:
    """keys, rpc of the layout whose coefficients are lists in one element; projection only."""
    get = lambda tag: F.regexp_extract("content", rf"<{tag}>\s*([^<]*?)\s*<", 1)
    fields = []
    for tag, name in LIST_XML.items():
        if name.endswith(("_num", "_den")):
            value = F.regexp_extract("content", rf"(?s)<{tag}List>.*?<{tag}>\s*([^<]*?)\s*<", 1)
            fields.append(F.transform(F.split(value, r"\s+"), lambda x: x.try_cast("double")).alias(name))
        else:
            fields.append(get(tag).try_cast("double").alias(name))
    return files.where("kind = 'worldview'").select(*keys, F.struct(*fields).alias("rpc"))


def parse_pleiades(files: DataFrame, keys: list[str] = ["file"]) -> DataFrame:
    """keys, rpc of the layout with one element a coefficient; the direct model stands before <Inverse_Model>.

    Pixels count from 1 there, so 1 is taken from both image offsets.
    """
    direct, inverse = F.regexp_extract("content", r"(?s)^(.*?)<Inverse_Model>", 1), F.regexp_extract("content", r"(?s)<Inverse_Model>(.*)$", 1)
    one = lambda text, tag: F.regexp_extract(text, rf"<{tag}>\s*([^<]*?)\s*</", 1).try_cast("double")
    many = lambda text, tag: F.array(*[one(text, f"{tag}_{i}") for i in range(1, 21)])
    fields = [one(F.col("content"), tag) - (1e0 if name in ("row_offset", "col_offset") else 0e0) for tag, name in PLAIN_XML.items()]
    arrays = {"row_num": many(inverse, "LINE_NUM_COEFF"), "row_den": many(inverse, "LINE_DEN_COEFF"), "col_num": many(inverse, "SAMP_NUM_COEFF"), "col_den": many(inverse, "SAMP_DEN_COEFF")}
    arrays |= {"lon_num": many(direct, "SAMP_NUM_COEFF"), "lon_den": many(direct, "SAMP_DEN_COEFF"), "lat_num": many(direct, "LINE_NUM_COEFF"), "lat_den": many(direct, "LINE_DEN_COEFF")}
    return files.where("kind = 'pleiades'").select(*keys, F.struct(*[c.alias(n) for c, n in zip(fields, PLAIN_XML.values(), strict=True)], *[v.alias(k) for k, v in arrays.items()]).alias("rpc"))


def metadata_lines(lines: DataFrame, text: str = "value", keys: list[str] = []) -> DataFrame:
    """keys, name, value of `NAME=values` metadata lines; a list of coefficients becomes NAME_1, NAME_2 and so on."""
    pairs = lines.select(*keys, F.regexp_extract(text, r"NITF_?([A-Z_]*)=|^\s*([A-Z_]+)=", 0).alias("_m"), F.trim(F.regexp_replace(text, r"^[^=]*=", "")).alias("_v")).where("_m != ''")
    named = pairs.withColumn("name", F.regexp_replace(F.regexp_replace("_m", r"=$", ""), r"^\s*(NITF_)?", "")).withColumn("_p", F.split("_v", r"\s+"))
    spread = named.select(*keys, "name", "_p", F.posexplode("_p").alias("i", "value"))
    return spread.select(*keys, F.when(F.size("_p") > 1, F.concat_ws("_", "name", F.col("i") + 1)).otherwise(F.col("name")).alias("name"), "value")


def matrix(text: Column, rows: int, cols: int) -> Column:
    """array<double> of a matrix written with any separators; null unless it has rows * cols numbers."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"), 1), lambda x: x.cast("double"))
    return F.when(F.size(found) == rows * cols, found)

