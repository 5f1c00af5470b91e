"""All-pairs measures in blocks of sources, and diameter and radius from few searches.

A block of sources has its shortest paths and dependencies computed and summed into a row for
each vertex before the next block begins, so no table of (source, vertex) pairs is larger
than a block's. Blocks are sized by the edges: a level of a search has at most a row for each
source and edge end of its component. Tables of a block are not read again once it is summed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrel.operators import graph
from petrel.operators.checkpoints import checkpointed, written

#: Rows that a level of a block may have.
BLOCK_ROWS = 200_000_000
#: Sources of one search of ``extremes``.
TOGETHER = 4


def blocks(n: int, m: int, rows: int = BLOCK_ROWS) -> int:
    """Blocks for n sources over m edges."""
    each = max(1, rows // max(1, 2 * m))
    return max(1, -(-n // each))


def needed(vertices: DataFrame, edges: DataFrame, rows: int = BLOCK_ROWS) -> int:
    """Blocks for all vertices as sources: a search stays in its component, so many small ones are no more work than their sum."""
    most = blocks(vertices.count(), edges.count(), rows)
    if most == 1:
        return 1
    member = checkpointed(graph.components(vertices, edges))
    ends = graph.degrees(vertices, edges).join(member, "id").groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("degree").alias("ends"))
    level = ends.agg(F.sum(F.col("n").cast("decimal(19,0)") * F.col("ends").cast("decimal(19,0)"))).first()[0]
    return min(most, max(1, -(-int(level) // rows)))


def in_blocks(vertices: DataFrame, edges: DataFrame, rows: int = BLOCK_ROWS) -> Iterator[DataFrame]:
    """The shortest paths of all vertices, a block of sources at a time."""
    count = needed(vertices, edges, rows)
    for b in range(count):
        sources = vertices if count == 1 else vertices.where(F.pmod(F.xxhash64("id"), F.lit(count)) == b)
        if count == 1 or not sources.isEmpty():
            yield graph.shortest_paths(vertices, edges, sources)


def all_pairs(vertices: DataFrame, edges: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """(s, t, d, sigma) of all sources. The levels of every block stay as tables, as they are the result."""
    vertices, edges = checkpointed(vertices.select("id")), checkpointed(edges)
    return reduce(DataFrame.union, in_blocks(vertices, edges, rows))


def reached(vertices: DataFrame, edges: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, reached, total, inverse, eccentricity) of all vertices as sources (``graph.reach``), each block summed before the next."""
    vertices, edges = checkpointed(vertices.select("id")), checkpointed(edges)
    return reduce(DataFrame.union, (written(graph.reach(found)) for found in in_blocks(vertices, edges, rows)))


def measures(vertices: DataFrame, edges: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, betweenness, stress, reached, total, inverse, eccentricity): sums over unordered pairs, and of distances from each vertex.

    The last four are null for a vertex that reaches none (``graph.reach``).
    """
    vertices, edges = checkpointed(vertices.select("id")), checkpointed(edges)
    central = far = None
    for found in in_blocks(vertices, edges, rows):
        part, reach = graph.dependencies(edges, found), written(graph.reach(found))
        central = written(part if central is None else central.union(part).groupBy("id").agg(F.sum("betweenness").alias("betweenness"), F.sum("stress").alias("stress")))
        far = reach if far is None else far.union(reach)
    return graph.halved(vertices, central).join(far, "id", "left")


@dataclass
class Extremes:
    diameter: int
    radius: int
    searches: int


def extremes(vertices: DataFrame, edges: DataFrame, together: int = TOGETHER) -> Extremes:
    """Diameter and radius of a connected graph: a search from s bounds every v by max(d, e(s) - d) <= e(v) <= e(s) + d.

    Searches start in turn where the upper bound is greatest and where the lower bound is least, ties to the higher
    degree, until no vertex can be further out than the furthest known nor more central than the most central known.
    """
    edges = checkpointed(edges)
    degree = graph.degrees(vertices.select("id"), edges)
    bounds = written(degree.select("id", "degree", F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"), F.lit(False).alias("done")))
    searches, far = 0, True
    while True:
        # unknown: a vertex whose bounds may still move the diameter or the radius
        known = bounds.agg(F.max("low").alias("diameter"), F.min("high").alias("radius")).first()
        if known["radius"] is None:
            open_ = bounds.where("not done")
        else:
            open_ = bounds.where((~F.col("done")) & ((F.col("high") > known["diameter"]) | (F.col("low") < known["radius"])) & (F.col("low") < F.col("high")))
        order = [F.desc_nulls_first("high"), F.desc("degree"), F.asc("id")] if far else [F.asc("low"), F.desc("degree"), F.asc("id")]
        chosen = open_.orderBy(*order).limit(together).select("id")
        picked = [r["id"] for r in chosen.collect()]
        if not picked:
            return Extremes(known["diameter"] or 0, known["radius"] or 0, searches)
        searches, far = searches + len(picked), not far
        found = graph.shortest_paths(vertices, edges, bounds.where(F.col("id").isin(picked)).select("id"))
        found = found.select("s", F.col("t").alias("id"), "d")
        reach = found.groupBy("s").agg(F.max("d").alias("e"))  # a row for each of the sources
        seen = found.join(F.broadcast(reach), "s").groupBy("id").agg(F.max(F.greatest("d", F.col("e") - F.col("d"))).alias("low_now"), F.min(F.col("e") + F.col("d")).alias("high_now"), F.max(F.col("d") == 0).alias("done_now"), F.max(F.when(F.col("d") == 0, F.col("e"))).alias("own"))
        moved = bounds.join(seen, "id", "left")
        bounds = written(moved.select("id", "degree", F.coalesce("own", F.greatest("low", "low_now"), "low").cast("int").alias("low"), F.coalesce("own", F.least("high", "high_now")).cast("int").alias("high"), (F.col("done") | F.coalesce("done_now", F.lit(False))).alias("done")))
