"""Connected components by alternating large-star and small-star rounds; nothing is gathered on the driver but one checksum a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrel.operators.checkpoints import checkpointed


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    # a hub's edges meet its least neighbour in one partition; read from a checkpoint, both sides are plain exchanges,
    # whose skewed partitions adaptive execution splits (it doesn't where one side is an aggregate)
    least = checkpointed(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m")))
    return both.join(least, F.col("a") == F.col("u")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    joined = down.join(least, F.col("a") == F.col("u"))
    return joined.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node on an edge; the label is the component's least node. Loops and nulls are ignored."""
    now = checkpointed(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    before = _state(now)
    while before[0]:
        now = checkpointed(_small(_large(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    # every node points at its component's least node by now
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
