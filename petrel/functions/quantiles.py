"""Exact quantiles of whole columns without a buffer of their values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.operators.checkpoints import written


def by_ranges(rows: DataFrame, columns: dict[str, Column], chances: list[float]) -> dict[str, list[float | None]]:
    """Of each column the quantiles (interpolated between neighbours, R's type 7) of its non-null values; nulls if it has none.

    Equal values are counted first; distinct ones are dealt out by range of (column, value). The sizes of the ranges, a
    row for each range and column, tell in which range an order statistic lies; only those ranges are looked at again.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), x.cast("double").alias("x")) for c, x in columns.items()))).alias("p")
    counted = rows.select(pairs).select("p.*").where("x is not null").groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
    dealt = written(counted.repartitionByRange("c", "x").withColumn("part", F.spark_partition_id()))
    sizes = sorted((r["c"], r["part"], r["n"]) for r in dealt.groupBy("c", "part").agg(F.sum("n").alias("n")).collect())
    wanted, places = [], {}
    for c in columns:
        own = [(part, n) for name, part, n in sizes if name == c]
        total = sum(n for _, n in own)
        for q in chances if total else []:
            h = (total - 1) * q
            places[c, q] = (h, math.floor(h), math.ceil(h))
            for rank in {math.floor(h), math.ceil(h)}:
                before = 0
                for part, n in own:
                    if rank < before + n:
                        wanted.append((c, part, rank, rank - before))
                        break
                    before += n
    if not wanted:
        return {c: [None] * len(chances) for c in columns}
    asked = rows.sparkSession.createDataFrame(sorted(set(wanted)), "c string, part int, rank long, own long")  # two rows at most for each quantile
    parts = asked.select("c", "part").distinct()
    within = W.partitionBy("c", "part").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = dealt.join(F.broadcast(parts), ["c", "part"], "left_semi").withColumn("upto", F.sum("n").over(within))
    hit = summed.join(F.broadcast(asked), ["c", "part"]).where((F.col("own") < F.col("upto")) & (F.col("own") >= F.col("upto") - F.col("n")))
    value = {(r["c"], r["rank"]): r["x"] for r in hit.select("c", "rank", "x").collect()}

    def at(c: str, q: float) -> float | None:
        if (c, q) not in places:
            return None
        h, low, high = places[c, q]
        a, b = value[c, low], value[c, high]
        return a if low == high or a == b else (high - h) * a + (h - low) * b

    return {c: [at(c, q) for q in chances] for c in columns}
