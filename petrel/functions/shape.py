"""Shaping tables: columns by name and place, rows by a given order, lookups in long tables, comparisons of sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a partition that ``dealt`` makes.
TASK_ROWS = 1_000_000


def dealt(df: DataFrame, count: int, *keys: str, rows: int = TASK_ROWS) -> DataFrame:
    """Dealt by keys into partitions of some ``rows`` of the ``count`` rows, which adaptive execution leaves as they are.

    It merges small partitions by their compressed bytes, so tasks that sort or count what they read would grow with the input.
    Tasks that deal to more partitions than spark.shuffle.sort.bypassMergeThreshold hold the rows of their split to sort them;
    up to twice that number, that many partitions take up to twice the rows instead.
    """
    spark = df.sparkSession
    parts, unsorted = -(-count // rows), int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    if unsorted < parts <= 2 * unsorted:
        parts = unsorted
    return df.repartition(max(spark.sparkContext.defaultParallelism, parts), *keys)


def without(df: DataFrame, columns: list[str]) -> DataFrame:
    """Without the columns that are there."""
    return df.select(*(f"`{c}`" for c in df.columns if c not in columns))


def any_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that are there, in the given order."""
    return df.select(*(f"`{c}`" for c in columns if c in df.columns))


def key_first(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *(f"`{c}`" for c in df.columns if c not in keys))


def placed(df: DataFrame, column: str, before: str | None = None, after: str | None = None) -> DataFrame:
    """With a column moved before or after another; without either, to the front."""
    rest = [c for c in df.columns if c != column]
    at = rest.index(before) if before else rest.index(after) + 1 if after else 0
    return df.select(*(f"`{c}`" for c in [*rest[:at], column, *rest[at:]]))


def in_order_of(df: DataFrame, column: str, values: list) -> DataFrame:
    """The rows whose value is listed, with its position from 1 on in the list."""
    place = F.array_position(F.array(*map(F.lit, values)), F.col(column))
    return df.withColumn("position", place.cast("int")).where("position > 0")


def numbers_first(text: Column) -> list[Column]:
    """Sort keys: numeric ids in ascending order, then the others as text."""
    return [text.try_cast("double").asc_nulls_last(), text]


def ranked_by_size(groups: DataFrame, size: str, partition: list[str] | None = None) -> DataFrame:
    """Adds module_rank, the competition rank from the largest."""
    return groups.withColumn("module_rank", F.rank().over(W.partitionBy(*(partition or [])).orderBy(F.desc(size))))


def looked_up(long: DataFrame, name: str, key: str = "metric", value: str = "value") -> Column | DataFrame:
    """One row with the value of a metric in a long table; null if it is absent."""
    return long.where(F.col(key) == name).agg(F.min(value).alias(name))


def attached(rows: DataFrame, attributes: DataFrame, key: str, columns: list[str], prefix: str = "") -> DataFrame:
    """Each row with its key's attributes, or nulls. A key with several rows of attributes is an error of its maker."""
    one = attributes.groupBy(key).agg(*(F.first(c).alias(f"{prefix}{c}") for c in columns), F.count(F.lit(1)).alias("n__"))
    sure = F.when(F.col("n__") > 1, F.raise_error(F.concat(F.lit("several rows of attributes for "), F.col(key).cast("string")))).otherwise(F.col(key))
    return rows.join(one.withColumn(key, sure.cast(dict(attributes.dtypes)[key])).drop("n__"), key, "left")


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(missing, extra): distinct rows of ``a`` that ``b`` lacks, and of ``b`` that ``a`` lacks; equal sets have neither."""
    count = lambda df, n: df.agg(F.count(F.lit(1)).alias(n))
    return count(a.subtract(b), "missing").join(F.broadcast(count(b.subtract(a), "extra")))  # one row each


def schema_difference(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """(expected columns that are missing, columns beyond them)."""
    return [c for c in expected if c not in df.columns], [c for c in df.columns if c not in expected]
