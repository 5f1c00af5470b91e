"""Graph files as tables, by Spark's XML reader: a row for each vertex or edge, with the types that the file declares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Attribute types of the format, as Spark's.
KINDS = {"boolean": "boolean", "int": "int", "long": "bigint", "float": "float", "double": "double", "string": "string"}
_DATA = "data array<struct<_VALUE: string, _key: string>>"


def _elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements of one name; a large file is split. What isn't well-formed raises."""
    return spark.read.format("xml").option("rowTag", tag).option("ignoreSurroundingSpaces", False).option("mode", "FAILFAST").schema(schema).load(path)


def keys(spark: SparkSession, path: str) -> DataFrame:
    """(key, side, name, kind): the attributes that a graph file declares."""
    rows = _elements(spark, path, "key", "_id string, _for string, `_attr.name` string, `_attr.type` string")
    return rows.select(F.col("_id").alias("key"), F.col("_for").alias("side"), F.col("`_attr.name`").alias("name"), F.col("`_attr.type`").alias("kind"))


def _attributes(spark: SparkSession, path: str, side: str) -> list[Column]:
    """A column for each declared attribute, in the order of the file; a file declares as many as a table has columns."""
    found = F.map_from_entries(F.transform(F.coalesce("data", F.array().cast("array<struct<_VALUE: string, _key: string>>")), lambda x: F.struct(x["_key"], x["_VALUE"])))
    declared = keys(spark, path).where(F.col("side").isin(side, "all")).collect()
    return [found[k["key"]].cast(KINDS[k["kind"]]).alias(k["name"]) for k in declared]


def vertices(spark: SparkSession, path: str) -> DataFrame:
    """id (text) and the vertices' attributes; one that a vertex lacks is null."""
    return _elements(spark, path, "node", f"_id string, {_DATA}").select(F.col("_id").alias("id"), *_attributes(spark, path, "node"))


def edges(spark: SparkSession, path: str) -> DataFrame:
    """src, dst (texts) and the edges' attributes."""
    return _elements(spark, path, "edge", f"_source string, _target string, {_DATA}").select(F.col("_source").alias("src"), F.col("_target").alias("dst"), *_attributes(spark, path, "edge"))
