"""The composite candidate score and the ranks that follow from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrel.functions.columns import finite, levels, with_minmax
from petrel.functions.ranks import ONE_TASK, with_rank
from petrel.operators.checkpoints import checkpointed

COMPONENTS = {"degree_component": "degree", "betweenness_component": "betweenness", "log_stress_component": "stress_centrality", "abs_logFC_component": "abs_logFC", "statistical_component": "neg_log10_pvalue"}


def scored(nodes: DataFrame, strict: bool = True) -> DataFrame:
    """Adds five min-max components, topology_component (mean of three) and candidate_score (mean of topology and the other two).

    A component that isn't finite is an error when ``strict``, else the score is null.
    """
    raw = {c: F.log1p(x) if c == "log_stress_component" else F.col(x) for c, x in COMPONENTS.items()}
    out = with_minmax(nodes, raw)
    parts = [F.col(c) for c in COMPONENTS]
    if strict:
        good = F.lit(True)
        for p in parts:
            good &= finite(p)
        check = lambda p: F.when(good, p).otherwise(F.raise_error(F.lit("a score component is not finite")).cast("double"))
        out = out.withColumns({c: check(F.col(c)) for c in list(COMPONENTS)[:1]})
    d, b, s, e, p = (F.col(c) for c in COMPONENTS)
    return out.withColumn("topology_component", (d + b + s) / 3).withColumn("candidate_score", (F.col("topology_component") + e + p) / 3)


def reconstructed(nodes: DataFrame) -> DataFrame:
    """Adds the score recomputed from its components and the absolute error."""
    d, b, s, e, p = (F.col(c) for c in COMPONENTS)
    again = ((d + b + s) / 3 + e + p) / 3
    return nodes.withColumn("score_reconstructed", again).withColumn("score_error", F.abs(again - F.col("candidate_score")))


def ranked(nodes: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """Adds the competition ranks and the dense candidate rank of the total order, in one task or by ranges of it."""
    out = checkpointed(nodes)  # counted, then read again
    n = out.count()
    by = {"degree_rank": "degree", "betweenness_rank": "betweenness", "stress_rank": "stress_centrality", "abs_logFC_rank": "abs_logFC", "statistical_rank": "neg_log10_pvalue"}
    for rank, column in by.items():
        out = with_rank(out, rank, [F.col(column).desc_nulls_last()], one_task=one_task, count=n).withColumn(rank, F.when(F.col(column).isNotNull(), F.col(rank)))
    total = [F.desc("candidate_score"), F.desc("degree"), F.desc("betweenness"), F.col("gene").asc(), F.col("id").asc()]
    return with_rank(out, "candidate_rank", total, dense_order=True, one_task=one_task, count=n)


def with_levels(nodes: DataFrame) -> DataFrame:
    return levels(nodes, {"degree_level": F.col("degree"), "betweenness_level": F.col("betweenness"), "stress_level": F.log1p("stress_centrality"), "expression_change_level": F.col("abs_logFC"), "statistical_evidence_level": F.col("neg_log10_pvalue")})


def priority_class(nodes: DataFrame, top_n: int = 30) -> DataFrame:
    topology = (F.col("degree_rank") <= 10) | (F.col("betweenness_rank") <= 10) | (F.col("stress_rank") <= 10)
    # The classes' names.
    return nodes.withColumn(
        "priority_class",
        F.when(F.col("candidate_rank") <= 10, F.lit("priority_candidate_top10_by_composite_score"))
        .when(F.col("candidate_rank") <= top_n, F.lit("extended_candidate_topN_by_composite_score"))
        .when(topology, F.lit("topological_support_candidate"))
        .otherwise(F.lit("network_background_protein")),
    )


def top(nodes: DataFrame, by: str, n: int = 30) -> DataFrame:
    return nodes.orderBy(F.desc(by), "gene", "id").limit(n)
