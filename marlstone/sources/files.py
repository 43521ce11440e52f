"""Strict readers. Files are landed first; a reader never follows a link."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..schemas import CROSSLINK, CURVE, OVERRIDE, POST, REGISTRY


def strict_json(df: DataFrame, text: str) -> DataFrame:
    """df with ok: whether a text is JSON without repeated keys and numbers beyond JSON."""
    return df.withColumn("ok", F.try_parse_json(F.col(text)).isNotNull())


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """Files that aren't strict JSON: (path)."""
    files = spark.read.format("text").option("wholetext", True).load(path).select(F.input_file_name().alias("path"), "value")
    return strict_json(files, "value").where("not ok").select("path")


def array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON array of objects per file; anything that doesn't fit the schema stops the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("allowNonNumericNumbers", False).json(path)


def unknown_keys(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path, key) of object keys that a schema lacks."""
    files = spark.read.format("text").option("wholetext", True).load(path).select(F.input_file_name().alias("path"), F.from_json("value", "array<string>").alias("rows"))
    keys = files.select("path", F.explode("rows").alias("r")).select("path", F.explode(F.json_object_keys("r")).alias("key"))
    return keys.where(~F.col("key").isin(*schema.fieldNames())).distinct()


def posts(spark: SparkSession, path: str) -> DataFrame:
    return array(spark, path, POST)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry records, the newest first."""
    return array(spark, path, REGISTRY).orderBy(F.desc("post_date"), "source_id")


def overrides(spark: SparkSession, path: str, crosslinks: bool = False) -> DataFrame:
    """The list under "overrides" of a versioned file."""
    kind = T.StructType([T.StructField("schema_version", T.IntegerType()), T.StructField("overrides", T.ArrayType(CROSSLINK if crosslinks else OVERRIDE))])
    return array(spark, path, kind).select(F.inline("overrides"))


def curve(spark: SparkSession, path: str) -> DataFrame:
    """Days of a curve file {observations: {day: {m3, y2, ...}}}, in rows."""
    row = T.StructType(CURVE.fields[1:])
    kind = T.StructType([T.StructField("observations", T.MapType(T.StringType(), row))])
    return spark.read.schema(kind).option("multiLine", True).json(path).select(F.explode("observations").alias("day", "r")).select("day", "r.*")


def _elements(spark: SparkSession, path: str, tag: str, fields: list[str]) -> DataFrame:
    """(pos, r) of elements of that name, whatever their prefix, in file order; r has the text of the named children, as an XML parser reads it: entities and CDATA undone, attributes and prefixes aside. Document types and entities are refused, and so is an element that isn't well formed."""
    text = spark.read.format("text").option("wholetext", True).load(path)
    checked = text.select(F.when(F.col("value").rlike("(?i)<!(DOCTYPE|ENTITY)"), F.raise_error(F.lit(f"document type in {tag}s"))).otherwise(F.col("value")).alias("value"))
    # an element ends at its end tag, but not at one that CDATA quotes
    whole = rf"(?s)<(?:\w+:)?{tag}\b(?:<!\[CDATA\[.*?\]\]>|(?!</(?:\w+:)?{tag}\s*>).)*+</(?:\w+:)?{tag}\s*>"
    each = checked.select(F.posexplode(F.regexp_extract_all("value", F.lit(whole), F.lit(0))).alias("pos", "e"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    return each.select("pos", F.from_xml("e", schema, {"ignoreNamespace": "true", "mode": "FAILFAST"}).alias("r"))


def curve_xml(spark: SparkSession, path: str) -> DataFrame:
    """Days of a yield feed; days that lack a tenor are left out. Tenors by their element names (fixed values)."""
    names = {"m3": "BC_3MONTH", "y2": "BC_2YEAR", "y5": "BC_5YEAR", "y10": "BC_10YEAR", "y30": "BC_30YEAR"}
    entries = _elements(spark, path, "properties", ["NEW_DATE", *names.values()])
    return entries.select(F.substring(F.trim("r.NEW_DATE"), 1, 10).alias("day"), *(F.trim(f"r.{x}").try_cast("double").alias(n) for n, x in names.items())).dropna()


def merge_curve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Days of both, new ones first in right."""
    return new.select(*old.columns).unionByName(old.join(new.select("day"), "day", "left_anti")).orderBy("day")


def feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files in file order: pos, guid, title, link, published, description; what an item lacks is empty."""
    items = _elements(spark, path, "item", ["guid", "title", "link", "pubDate", "description"])
    inner = lambda n: F.coalesce(F.col(f"r.{n}"), F.lit(""))
    return items.select("pos", inner("guid").alias("guid"), inner("title").alias("title"), inner("link").alias("link"), D.from_rfc2822(inner("pubDate")).alias("published"), inner("description").alias("description"))


def stable(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows by which two passes over a catalogue differ, place included; empty if the catalogue stood still."""
    signed = lambda df: df.select("pos", F.sha2(F.to_json(F.struct(*df.columns)), 256).alias("h"))
    return signed(first).exceptAll(signed(second)).unionByName(signed(second).exceptAll(signed(first)))


def markers(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with what marks them: title, ids in order of sight, names of meta elements, and the number of inline scripts."""
    found = lambda p: F.regexp_extract_all(F.col(html), F.lit(p), F.lit(1))
    return pages.withColumns({
        "title": F.trim(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)), "ids": F.array_distinct(found("(?i)<[a-z][^>]*\\sid=[\"']?([A-Za-z0-9_-]+)")), "metas": found("(?i)<meta\\s[^>]*name=[\"']?([A-Za-z0-9:_-]+)"),
        "inline_scripts": F.size(found("(?is)<script(?:\\s+(?!src)[^>]*)?>(.*?)</script>")),
    })
