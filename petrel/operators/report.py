"""Report tables made of scored nodes and module decisions; all are small and end in a stated number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.functions.columns import direction, rounded

FINAL, MODULES, TERMS = 10, 5, 3


def warning(module_warning: Column, eligibility: Column, conflict: Column) -> Column:
    """Distinct warnings joined by '; ', or no_warning."""
    state = F.coalesce(F.nullif(F.trim(eligibility), F.lit("")), F.lit("eligibility_not_available"))
    parts = F.array_compact(F.array(
        F.when(~F.coalesce(F.trim(module_warning), F.lit("")).isin("", "no_warning"), F.trim(module_warning)),
        F.when(state != "review_ready_canonical", F.concat(F.lit("candidate_eligibility="), state)),
        F.when(F.coalesce(conflict, F.lit(False)), F.lit("module_conflict_detected")),
    ))
    return F.when(F.size(parts) == 0, F.lit("no_warning")).otherwise(F.array_join(F.array_distinct(parts), "; "))


def final_priorities(candidates: DataFrame, n: int = FINAL) -> DataFrame:
    """Canonical candidates of eligible biological modules, best first.

    candidates: ranked nodes with eligibility and their module's interpretation_class, priority_eligible, conflict_detected.
    """
    ready = (F.col("eligibility") == "review_ready_canonical") & (F.col("interpretation_class") == "biological") & F.coalesce("priority_eligible", F.lit(False)) & ~F.coalesce("conflict_detected", F.lit(False))
    best = candidates.where(ready).orderBy("candidate_rank", "gene", "id").limit(n)
    return best.withColumn("priority_rank", F.row_number().over(W.orderBy("candidate_rank", "gene", "id")))


def module_terms(terms: DataFrame, n: int = TERMS) -> DataFrame:
    """(module, primary_*, secondary_terms): the first distinct significant terms of each module."""
    key = ["source", "term_id", "description"]
    once = terms.withColumn("k", F.row_number().over(W.partitionBy("module", *key).orderBy(F.col("fdr").asc_nulls_last()))).where("k = 1")
    order = W.partitionBy("module").orderBy(F.col("fdr").asc_nulls_last(), "source", "description", "term_id")
    top = once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    first = lambda c: F.max(F.when(F.col("place") == 1, F.col(c)))
    rest = F.sort_array(F.collect_list(F.when(F.col("place") > 1, F.struct("place", "description"))))
    by = top.groupBy("module").agg(*(first(c).alias(f"primary_{c}") for c in ("description", "source", "term_id", "fdr", "supporting_genes")), rest.alias("rest"))
    return by.withColumn("secondary_terms", F.when(F.size("rest") == 0, F.lit("not_available")).otherwise(F.array_join(F.transform("rest", lambda x: x["description"]), " | "))).drop("rest")


def module_priorities(decisions: DataFrame, terms: DataFrame, network_nodes: int, n: int = MODULES) -> DataFrame:
    ready = decisions.where((F.col("interpretation_class") == "biological") & F.coalesce("priority_eligible", F.lit(False))).join(module_terms(terms), "module")
    order = [F.desc("module_size"), F.col("primary_fdr").asc_nulls_last(), F.col("module").cast("string").try_cast("double").asc_nulls_last(), F.col("module").cast("string")]
    best = ready.orderBy(*order).limit(n).withColumn("module_priority_rank", F.row_number().over(W.orderBy(*order)))
    return best.select("module_priority_rank", "module", "module_size", rounded(F.col("module_size") / network_nodes, 4).alias("network_fraction"), F.col("primary_description").alias("module_interpretation"), "primary_source", "primary_term_id", "primary_fdr", "primary_supporting_genes", "secondary_terms")


def candidate_evidence(candidates: DataFrame, final: DataFrame, top_n: int = 30) -> DataFrame:
    """Candidates within the first top_n or among the final ones, with their status."""
    flagged = candidates.join(final.select("id", F.lit(True).alias("final")), "id", "left").where((F.col("candidate_rank") <= top_n) | F.col("final"))
    status = F.when(F.col("final"), F.lit("final_priority")).when(F.col("eligibility") == "review_ready_canonical", F.lit("extended_review_ready")).otherwise(F.coalesce("eligibility", F.lit("eligibility_not_available")))
    return flagged.withColumn("priority_status", status).drop("final")


def hubs(candidates: DataFrame) -> DataFrame:
    """Nodes in the first ten by any topology rank."""
    ranks = ["degree_rank", "betweenness_rank", "stress_rank"]
    support = sum((F.when(F.col(r) <= 10, 1).otherwise(0) for r in ranks), F.lit(0))
    rows = candidates.withColumns({"support": support, "best_rank": F.least(*ranks)}).where("support > 0")
    return rows.withColumn("rank", F.row_number().over(W.orderBy(F.desc("support"), "best_rank", F.desc("candidate_score"), "gene", "id")))


def network_overview(summary: DataFrame, candidates: DataFrame, histogram: DataFrame) -> DataFrame:
    """(section, rank, item, value, details): metrics, hubs and the degree distribution under each other."""
    metric = summary.select(F.lit("network_metric").alias("section"), (F.col("position") + 1).alias("rank"), F.col("metric").alias("item"), F.col("value").cast("double").alias("value"), F.lit("").alias("details"))
    hub = hubs(candidates).select(F.lit("topological_hub").alias("section"), "rank", F.col("gene").alias("item"), F.col("candidate_score").cast("double").alias("value"), F.concat_ws("; ", *(F.concat(F.lit(f"{r}="), F.col(r).cast("string")) for r in ("degree_rank", "betweenness_rank", "stress_rank"))).alias("details"))
    degree = histogram.select(F.lit("degree_distribution").alias("section"), F.col("degree").cast("int").alias("rank"), F.concat(F.lit("degree_"), F.col("degree").cast("string")).alias("item"), F.col("n").cast("double").alias("value"), F.lit("").alias("details"))
    return metric.unionByName(hub).unionByName(degree)


def executive_summary(counts: dict[str, DataFrame]) -> DataFrame:
    """(position, item, value) from one-row, one-column frames in the given order."""
    out = None
    for i, (item, df) in enumerate(counts.items()):
        row = df.select(F.lit(i).alias("position"), F.lit(item).alias("item"), F.col(df.columns[0]).cast("double").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


#: Items of the executive summary in order.
SUMMARY = [
    "input_rows", "mapped_proteins", "unmapped_input_rows", "mapping_rate_percent", "network_nodes", "network_edges", "connected_components", "largest_component_nodes", "largest_component_fraction",
    "louvain_modules", "priority_eligible_modules", "technical_or_covariate_modules", "mixed_biological_modules", "unresolved_modules", "final_priority_candidates", "run_configuration",
]
#: What the summary takes from the network's metrics.
SIZES = ["nodes", "edges", "components", "largest_component_nodes", "largest_component_fraction"]


def summary_rows(mapping: DataFrame, network: DataFrame, decisions: DataFrame, final: DataFrame, configuration: str) -> DataFrame:
    """(position, item, value) of the sixteen items as text.

    mapping and network are long tables (metric, value); decisions has a row for each module, final for each priority.
    A module in conflict isn't eligible. The network's numbers are written without exponents and trailing zeros.
    """
    biological, mixed = F.col("interpretation_class") == "biological", F.col("interpretation_class") == "mixed_biological"
    eligible = biological & F.col("priority_eligible") & ~F.coalesce("conflict_detected", F.lit(False))
    plain = F.regexp_replace(F.col("value").try_cast("decimal(38,4)").cast("string"), "\\.?0+$", "")
    one = mapping.agg(*(F.max(F.when(F.col("metric") == m, F.col("value").cast("string"))).alias(m) for m in ("input_rows", "final_mapped", "nodes_in_network", "final_unmapped", "final_mapped_percent")))
    one = one.join(F.broadcast(network.agg(*(F.max(F.when(F.col("metric") == m, plain)).alias(f"n_{m}") for m in SIZES))))
    one = one.join(F.broadcast(decisions.agg(F.count(F.lit(1)).alias("modules"), F.count_if(eligible).alias("eligible"), F.count_if(F.col("interpretation_class") == "technical_or_covariate").alias("technical"), F.count_if(mixed).alias("mixed"), F.count_if(F.col("interpretation_class") == "unresolved").alias("open"))))
    one = one.join(F.broadcast(final.agg(F.count(F.lit(1)).alias("final"))))
    values = ["input_rows", "nodes_in_network", "final_unmapped", "final_mapped_percent", *(f"n_{m}" for m in SIZES), "modules", "eligible", "technical", "mixed", "open", "final"]
    rows = [F.struct(F.lit(i).alias("position"), F.lit(k).alias("item"), F.col(v).cast("string").alias("value")) for i, (k, v) in enumerate(zip(SUMMARY, values))]
    return one.select(F.explode(F.array(*rows, F.struct(F.lit(len(values)).alias("position"), F.lit(SUMMARY[-1]).alias("item"), F.lit(configuration).alias("value")))).alias("r")).select("r.*")


def readable_modules(modules: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Modules with rank, direction of change and a sentence on their database evidence.

    modules: community, module_size, median_logFC; enrichment: community, top_raw_terms, top_interpretable_terms, best_interpretable_fdr.
    """
    rows = modules.join(enrichment, "community", "left").withColumn("module_rank", F.rank().over(W.orderBy(F.desc("module_size"))))
    said = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    text = (
        F.when(said("top_interpretable_terms"), F.concat(F.lit("Specific STRING/database enrichment terms used for interpretation: "), "top_interpretable_terms", F.lit("; best FDR="), F.coalesce(F.col("best_interpretable_fdr").cast("string"), F.lit("NA")), F.lit(".")))
        .when(said("top_raw_terms"), F.concat(F.lit("Only generic/secondary enrichment terms were available for this module in the main filter; raw top terms retained for audit: "), "top_raw_terms", F.lit(".")))
        .otherwise(F.lit("No local STRING enrichment evidence available for this module."))
    )
    return rows.withColumns({"dominant_expression_direction": direction(F.col("median_logFC")), "database_evidence_summary": text})


def module_summary(nodes: DataFrame) -> DataFrame:
    """One row for each community: size, expression, best candidate and gene lists."""
    from petrel.functions.columns import only_finite, top_list

    fc, p = only_finite(F.col("logFC")), only_finite(F.col("pvalue"))
    return nodes.groupBy("community").agg(
        F.count(F.lit(1)).alias("module_size"),
        F.count_if("in_largest_component").alias("nodes_in_largest_component"),
        F.avg(fc).alias("mean_logFC"), F.percentile(fc, 0.5).alias("median_logFC"),
        F.min(p).alias("min_pvalue"), F.percentile(p, 0.5).alias("median_pvalue"),
        top_list(F.col("gene"), F.col("candidate_score"), 1).alias("top_candidate"),
        top_list(F.col("gene"), F.col("candidate_score"), 12).alias("top_genes_by_candidate_score"),
        top_list(F.col("gene"), F.col("degree"), 12).alias("top_genes_by_degree"),
        top_list(F.col("gene"), F.col("betweenness"), 12).alias("top_genes_by_betweenness"),
    )
