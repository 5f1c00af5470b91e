"""Ranks over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.operators.checkpoints import checkpointed

#: Rows up to which one window ranks a table; beyond, ranges of it are ranked side by side. Both give the same ranks.
ONE_TASK = 200_000


def with_rank(rows: DataFrame, name: str, order: list[Column], dense_order: bool = False, one_task: int = ONE_TASK, count: int | None = None) -> DataFrame:
    """Adds a competition rank by the order, or (``dense_order``) the place in it, which then must be total.

    Beyond ``one_task`` rows are dealt out by range of the order, so equal keys meet and every range ranks its own
    rows; the ranges' sizes, one number for each partition, make the offsets.
    """
    place = F.row_number() if dense_order else F.rank()
    if (rows.count() if count is None else count) <= one_task:
        return rows.withColumn(name, place.over(W.orderBy(*order)).cast("int"))
    dealt = checkpointed(rows.repartitionByRange(*order).withColumn("part__", F.spark_partition_id()))
    sizes = sorted((r["part__"], r["n"]) for r in dealt.groupBy("part__").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    known = rows.sparkSession.createDataFrame(offsets, "part__ int, offset__ long")
    own = place.over(W.partitionBy("part__").orderBy(*order))
    return dealt.withColumn("own__", own).join(F.broadcast(known), "part__").withColumn(name, (F.col("own__") + F.col("offset__")).cast("int")).drop("part__", "own__", "offset__")
