"""Louvain communities in rounds of joins, however large a component is.

A level starts with every vertex in a community of its own. In a round each vertex finds the
neighbouring community into which a move gains most (ties to the least label). Of all
proposals that touch a community the best one decides whether the community gives or takes
in this round, and all moves from giving into taking communities are made at once: no two
communities swap members, and at least the best move is made. Moves into one community may
together gain less than each alone; where modularity didn't rise, the round is taken back
and only moves that are the best for both their communities are made, whose gains add up
exactly. So modularity never falls. The weight inside communities comes with the next
round's proposals and costs no pass of its own. When nothing gains, communities become the
vertices of a weighted graph and the next level starts, until one makes no move.

Weights and strengths are whole numbers and gains are compared as such, so the result
depends on the graph alone, not on its partitions. The driver holds a row for each round.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrel.functions.ranks import with_rank
from petrel.operators import graph
from petrel.operators.checkpoints import written

#: A level ends when a round raises modularity by less.
LEAST_GAIN = 1e-7
#: Edges beyond which gains are decimals instead of longs.
LONG_EDGES = 1 << 29


@dataclass
class Found:
    """member: (id, c) by label; rounds: (level, round, moved, modularity), moved into the state that has the modularity;
    states: the labels after each round of the first level."""

    member: DataFrame
    rounds: list[tuple[int, int, str, float]] = field(default_factory=list)
    states: list[DataFrame] = field(default_factory=list)


def _wide(x: Column, m: int) -> Column:
    return x.cast("decimal(38,0)") if m > LONG_EDGES else x


def _proposals(step: DataFrame, node: DataFrame, m: int) -> DataFrame:
    """(id, k, loop, c, inside, target, gain) of each vertex: its weight inside its community, and its best move if it has neighbours elsewhere."""
    totals = node.groupBy("c").agg(F.sum("k").alias("total"))
    placed = node.join(totals, "c")
    there = placed.select(F.col("id").alias("b"), F.col("c").alias("to"), F.col("total").alias("to_total"))
    near = step.join(there, "b").groupBy(F.col("a").alias("id"), "to").agg(F.sum("w").alias("w"), F.first("to_total").alias("to_total"))
    rows = placed.join(near, "id", "left")
    other = F.col("to") != F.col("c")
    less = _wide(F.col("k"), m) * F.col("to_total") - _wide(F.lit(2 * m), m) * F.col("w")
    best = rows.groupBy("id", "k", "loop", "c", "total").agg(F.min(F.when(other, F.struct(less.alias("less"), "to"))).alias("best"), F.coalesce(F.sum(F.when(~other, F.col("w"))), F.lit(0)).alias("inside"))
    stay = _wide(F.col("k"), m) * (F.col("total") - F.col("k")) - _wide(F.lit(2 * m), m) * F.col("inside")
    return best.select("id", "k", "loop", "c", "inside", F.col("best.to").alias("target"), (stay - F.col("best.less")).alias("gain"))


def _modularity(offered: DataFrame, m: int) -> tuple[float, bool]:
    """Of the state that the proposals look at; and whether any move gains."""
    by = offered.groupBy("c").agg(F.sum("k").alias("k"), F.sum(F.col("inside") + 2 * F.col("loop")).alias("inside"), F.max("gain").alias("gain"))
    d = F.col("k").cast("decimal(19,0)")
    inside, squares, gain = by.agg(F.sum("inside"), F.sum(d * d), F.max("gain")).first()
    return float(inside) / (2 * m) - float(squares) / (2 * m) ** 2, gain is not None and gain > 0


def _moved(offered: DataFrame, alone: bool) -> DataFrame:
    """The state (id, k, loop, c) after the moves that may be made together; ``alone``: one at most for each community."""
    ready = offered.where("gain > 0").select("id", "c", "target", "gain")
    touched = ready.select("id", "gain", F.explode(F.array(F.struct(F.col("c").alias("of"), F.lit(False).alias("takes")), F.struct(F.col("target").alias("of"), F.lit(True).alias("takes")))).alias("x"))
    decided = touched.groupBy("x.of").agg(F.max(F.struct("gain", "id", "x.takes")).alias("best")).select("of", F.col("best.id").alias("by"), "best.takes")
    gives, takes = decided.where("not takes").select(F.col("of").alias("c"), F.col("by").alias("from_by")), decided.where("takes").select(F.col("of").alias("target"), F.col("by").alias("to_by"))
    going = ready.join(gives, "c").join(takes, "target")
    if alone:
        going = going.where("from_by = id and to_by = id")
    return offered.select("id", "k", "loop", "c").join(going.select("id", "target"), "id", "left").select("id", "k", "loop", F.coalesce("target", "c").alias("c"))


def _start(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weighted steps of the first level and its nodes (id, k, loop)."""
    step = written(graph.endpoints(edges).select(F.col("id").alias("a"), F.col("other").alias("b"), F.lit(1).cast("long").alias("w")))
    strength = step.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k"))
    return step, vertices.join(strength, "id", "left").select("id", F.coalesce("k", F.lit(0)).cast("long").alias("k"), F.lit(0).cast("long").alias("loop"))


def first_rounds(vertices: DataFrame, edges: DataFrame, rounds: int) -> list[DataFrame]:
    """The states (id, c) before and after each of the first rounds of moves made together, whether or not they gain.

    ``communities`` takes back a round that loses and ends a level that gains no more; here every round counts, and
    one in which nothing moves leaves its state as it was.
    """
    step, node = _start(vertices, edges)
    m, state = edges.count(), node.withColumn("c", F.col("id"))
    states = [state.select("id", "c")]
    for _ in range(rounds):
        state = written(_moved(_proposals(step, state, m), alone=False))
        states.append(state.select("id", "c"))
    return states


def communities(vertices: DataFrame, edges: DataFrame, least_gain: float = LEAST_GAIN, most_rounds: int | None = None) -> Found:
    """Labels of all vertices; ``most_rounds`` ends the first level, and so the search, after as many rounds."""
    m = edges.count()
    found = Found(vertices.select("id", F.col("id").alias("c")))
    if not m:
        return found
    step, node = _start(vertices, edges)
    level = 0
    while True:
        offered = written(_proposals(step, node.withColumn("c", F.col("id")), m))
        q, more = _modularity(offered, m)
        if not level:
            found.rounds.append((0, 0, "none", q))
            found.states.append(offered.select("id", "c"))
        rounds, moves = 0, "together"
        while more and (most_rounds is None or rounds < most_rounds):
            after = written(_proposals(step, _moved(offered, moves == "alone"), m))
            q_after, more_after = _modularity(after, m)
            if q_after <= q and moves == "together":
                moves = "alone"
                continue
            rounds += 1
            found.rounds.append((level, rounds, moves, q_after))
            if not level:
                found.states.append(after.select("id", "c"))
            gained, offered, q, more, moves = q_after - q, after, q_after, more_after, "together"
            if gained < least_gain:
                break
        if not rounds:
            return found
        labels = offered.select("id", "c")
        found.member = written(found.member.select(F.col("id").alias("vertex"), F.col("c").alias("id")).join(labels, "id").select(F.col("vertex").alias("id"), "c"))
        if most_rounds is not None:
            return found
        node = written(offered.groupBy(F.col("c").alias("id")).agg(F.sum("k").alias("k"), (F.sum("loop") + F.expr("sum(inside) div 2")).cast("long").alias("loop")))
        a, b = labels.select(F.col("id").alias("a"), F.col("c").alias("ca")), labels.select(F.col("id").alias("b"), F.col("c").alias("cb"))
        step = written(step.join(a, "a").join(b, "b").where("ca <> cb").groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w")))
        level += 1


def louvain(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, community) with communities numbered from 1 by size, then by their least vertex."""
    member = communities(vertices, edges).member
    size = member.groupBy("c").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    numbered = with_rank(size, "community", [F.desc("size"), F.asc("least")], dense_order=True)
    return member.join(numbered.select("c", "community"), "c").select("id", "community")
