"""Canonical outputs: module attributes on nodes, the graph's attributes, and checks of the run's bundle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.functions.shape import attached
from petrel.sources.sinks import LEAST_EXPORTED, exported_pvalue

# Fields of the module and node tables, fields that older outputs had and what replaced them.
MODULE_FIELDS = [
    "interpretation_class", "interpretation_scope", "compartment", "lineage", "state", "process", "primary_interpretation", "secondary_themes", "confidence",
    "priority_eligible", "positive_marker_genes", "supportive_marker_genes", "term_supporting_genes", "significant_supporting_terms", "best_supporting_fdr",
    "conflict_detected", "warning", "evidence_rationale",
]
MEASURES = [
    "pvalue", "logFC", "abs_logFC", "neg_log10_pvalue", "degree", "betweenness", "closeness", "harmonic_closeness", "stress_centrality", "local_clustering",
    "component", "in_largest_component", "community_louvain", "candidate_score", "entity_class", "candidate_eligibility",
]
NODE_FIELDS = ["STRING_id", "gene", *MEASURES, *(f"module_{f}" for f in MODULE_FIELDS)]
PROVENANCE = ["rule_id", "curation_status", "rule_version", "rule_schema_version", "evidence_basis", "reference_count", "references"]
CURATION = ["legacy_unverified", "verified", "provisional", "deprecated"]
DEPRECATED = [
    ("module_direction", "module_primary_interpretation"),
    ("clean_module_label", "module_primary_interpretation"),
    ("marker_clean_label", "module_primary_interpretation"),
    ("marker_based_direction", "module_lineage/module_state/module_process"),
    ("marker_evidence_genes", "module_positive_marker_genes/module_supportive_marker_genes"),
    ("enrichment_evidence_terms", "module_significant_supporting_terms"),
    ("final_functional_label", "module_primary_interpretation"),
    ("putative_biological_program", "module_primary_interpretation"),
    ("specific_label_candidate", "module_interpretation_scope"),
    ("fallback_label", "module_interpretation_scope"),
    ("label_assignment_mode", "module_interpretation_class plus evidence fields"),
    ("label_source", "module_confidence plus explicit evidence fields"),
    ("label_evidence_score", "module_confidence"),
    ("label_confidence", "module_confidence"),
    ("label_warning", "module_warning"),
    ("biological_direction_rationale", "module_evidence_rationale"),
]
#: Versions of the tables that a run publishes.
SCHEMAS = {"input_contract": "1.0.0", "biological_evidence": "1.0.0", "graphml": "1.0.0", "analytical_workbook": "1.0.0", "output_provenance": "1.0.0", "pipeline_result": "1.0.0"}
SECTIONS = ["schema_versions", "output_dir", "network", "biological_evidence", "priorities", "reports", "mapping", "files", "compatibility", "provenance"]
#: The graph's attributes in order.
GRAPH_FIELDS = [
    "STRING_id", "gene", "annotation_schema_version", "graphml_schema_version", "pvalue", "pvalue_was_floored_for_graphml", "logFC", "abs_logFC", "neg_log10_pvalue",
    "degree", "betweenness", "stress_centrality", "closeness", "harmonic_closeness", "local_clustering", "component", "in_largest_component", "community_louvain",
    "louvain_module_id", "candidate_score", "network_candidate_rank", "degree_rank", "betweenness_rank", "stress_rank", "degree_component", "betweenness_component",
    "log_stress_component", "abs_logFC_component", "statistical_component", "entity_class", "candidate_eligibility", "candidate_priority_status",
    "module_interpretation_class", "module_interpretation_scope", "module_compartment", "module_lineage", "module_state", "module_process", "module_primary_interpretation",
    "module_secondary_themes", "module_confidence", "module_priority_eligible", "module_positive_marker_genes", "module_supportive_marker_genes", "module_term_supporting_genes",
    "module_significant_supporting_terms", "module_best_supporting_fdr", "module_conflict_detected", "module_warning", "module_evidence_rationale",
    "cytoscape_label", "cytoscape_module_label", "cytoscape_priority_class",
]


def deprecated_fields(spark: SparkSession) -> DataFrame:
    """(legacy_field, canonical_replacement, compatibility_status, decision_use)."""
    rows = [(old, new, "deprecated_compatibility_only", "forbidden_for_canonical_priority_and_graphml") for old, new in DEPRECATED]
    return spark.createDataFrame(rows, "legacy_field string, canonical_replacement string, compatibility_status string, decision_use string")


def schema_versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SCHEMAS.items()), "artifact string, version string")


def with_module_fields(nodes: DataFrame, modules: DataFrame, key: str = "community_louvain") -> DataFrame:
    """Nodes with the eighteen fields of their module, each named module_<field>."""
    return attached(nodes, modules, key, MODULE_FIELDS, "module_")


def matched(vertices: DataFrame, attributes: DataFrame, key: str = "STRING_id") -> DataFrame:
    """The attributes of every vertex. Either side's ids must be the other's; if not, the row that lacks its match raises."""
    both = vertices.select(F.col(key).alias("v__")).join(attributes, F.col("v__") == F.col(key), "full")
    lost = F.when(F.col("v__").isNull() | F.col(key).isNull(), F.raise_error(F.concat(F.lit("graph and attributes differ at "), F.coalesce(F.col("v__").cast("string"), F.col(key).cast("string"))))).otherwise(F.col(key))
    return both.withColumn(key, lost.cast(dict(attributes.dtypes)[key])).drop("v__")


def priority_status(final: Column, reported: Column, eligibility: Column) -> Column:
    """final: is in the final priorities; reported: status among the reported candidates, if there."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    state = F.coalesce(text(eligibility), F.lit("eligibility_not_available"))
    beyond = F.when(state == "review_ready_canonical", F.lit("not_in_reported_top_n")).otherwise(state)
    return F.when(final, F.lit("final_priority")).otherwise(F.coalesce(text(reported), beyond))


def graph_attributes(nodes: DataFrame, final: DataFrame, reported: DataFrame) -> DataFrame:
    """GRAPH_FIELDS of ranked nodes; final: STRING_id; reported: STRING_id, priority_status."""
    rows = nodes.join(final.select("STRING_id", F.lit(True).alias("f__")), "STRING_id", "left").join(reported.select("STRING_id", F.col("priority_status").alias("r__")), "STRING_id", "left")
    status = priority_status(F.coalesce("f__", F.lit(False)), F.col("r__"), F.col("candidate_eligibility"))
    p, text = F.col("pvalue"), lambda c: F.col(c).cast("string")
    made = {
        "annotation_schema_version": F.lit(SCHEMAS["biological_evidence"]), "graphml_schema_version": F.lit(SCHEMAS["graphml"]), "pvalue": exported_pvalue(p), "pvalue_was_floored_for_graphml": p < LEAST_EXPORTED,
        "community_louvain": text("community_louvain"), "louvain_module_id": text("community_louvain"), "component": F.col("component").cast("double"), "degree": F.col("degree").cast("double"), "candidate_priority_status": status,
        "cytoscape_label": F.col("gene"), "cytoscape_module_label": F.col("module_primary_interpretation"), "cytoscape_priority_class": status,
    }
    return rows.select(*(made.get(c, F.col(c)).alias(c) for c in GRAPH_FIELDS))


def _checks(one: DataFrame, checks: dict[str, Column]) -> DataFrame:
    status = lambda ok: F.when(F.coalesce(ok, F.lit(False)), F.lit("PASS")).otherwise(F.lit("FAIL"))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check_id"), status(v).alias("status")) for k, v in checks.items()))).alias("c")).select("c.*")


def _counts(df: DataFrame, **counts: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in counts.items()))


def graph_checks(attributes: DataFrame) -> DataFrame:
    """(check_id, status): the six invariants of the graph's attributes."""
    names = ["canonical_graphml_schema_complete", "legacy_annotation_fields_absent", "STRING_ids_are_unique", "graphml_pvalues_are_parser_safe", "graphml_schema_versions_are_pinned", "cytoscape_labels_use_canonical_interpretation"]
    complete, clean = attributes.columns == GRAPH_FIELDS, not {old for old, _ in DEPRECATED} & set(attributes.columns)
    if not complete:
        one = attributes.sparkSession.range(1)
        return _checks(one, dict(zip(names, [F.lit(complete), F.lit(clean), *[F.lit(False)] * 4])))
    p, ids = F.col("pvalue"), attributes.agg(F.count_distinct("STRING_id").alias("ids"))
    one = _counts(
        attributes,
        blank=F.coalesce(F.col("STRING_id").cast("string"), F.lit("")) == "",
        unsafe=p.isNotNull() & ~((p >= LEAST_EXPORTED) & (p <= 1)),
        unpinned=(F.col("annotation_schema_version") != SCHEMAS["biological_evidence"]) | (F.col("graphml_schema_version") != SCHEMAS["graphml"]),
        renamed=~F.col("cytoscape_module_label").eqNullSafe(F.col("module_primary_interpretation")),
    ).join(F.broadcast(ids))
    good = [F.lit(True), F.lit(clean), (F.col("ids") == F.col("rows")) & (F.col("blank") == 0), F.col("unsafe") == 0, F.col("unpinned") == 0, F.col("renamed") == 0]
    return _checks(one, dict(zip(names, good)))


def evidence_checks(bundle: dict[str, DataFrame]) -> DataFrame:
    """(check_id, status): the nine invariants of the evidence bundle."""
    needed = ["module_annotations", "module_rule_evidence", "significant_module_terms", "node_annotations", "validation"]
    spark = next(iter(bundle.values())).sparkSession
    have = lambda name, columns: name in bundle and set(columns) <= set(bundle[name].columns)
    module_ok, rule_ok, node_ok = have("module_annotations", ["community_louvain", "module_id", "module_size", *MODULE_FIELDS]), have("module_rule_evidence", PROVENANCE), have("node_annotations", NODE_FIELDS)
    legacy = {old for old, _ in DEPRECATED} & set(bundle["node_annotations"].columns if "node_annotations" in bundle else [])
    one = spark.range(1).select(F.lit(1).alias("one"))
    unique = lambda df, c, n: df.agg((F.count(F.lit(1)) == F.count_distinct(c)).alias(n))
    for ok, name, c, n in ((module_ok, "module_annotations", "community_louvain", "modules"), (node_ok, "node_annotations", "STRING_id", "nodes")):
        one = one.join(F.broadcast(unique(bundle[name], c, n))) if ok else one.withColumn(n, F.lit(False))
    one = one.join(F.broadcast(bundle["validation"].agg((F.count_if(F.col("status") == "FAIL") == 0).alias("passed")))) if have("validation", ["check_id", "status"]) else one.withColumn("passed", F.lit(False))
    return _checks(one, {
        "evidence_object_is_list": F.lit(True), "required_evidence_objects_present": F.lit(set(needed) <= set(bundle)), "canonical_module_schema_present": F.lit(module_ok),
        "auxiliary_rule_evidence_provenance_present": F.lit(rule_ok), "canonical_node_schema_present": F.lit(node_ok), "deprecated_node_annotation_fields_absent": F.lit(not legacy),
        "upstream_evidence_validation_passes": F.col("passed"), "module_ids_are_unique": F.col("modules"), "node_STRING_ids_are_unique": F.col("nodes"),
    })


def result_checks(spark: SparkSession, result: dict) -> DataFrame:
    """(check_id, status): the six invariants of a result of sections by name."""
    complete = set(SECTIONS) <= set(result)
    inside = lambda section, names: complete and set(names) <= set(result[section])
    return _checks(spark.range(1), {k: F.lit(v) for k, v in {
        "canonical_result_top_level_complete": complete, "shadow_result_field_absent": "biological_evidence_shadow" not in result,
        "canonical_priorities_present": inside("priorities", ["proteins", "modules", "candidate_evidence"]),
        "canonical_network_present": inside("network", ["graph", "node_annotations", "module_annotations", "graph_summary"]),
        "canonical_schema_versions_valid": complete and result["schema_versions"] == SCHEMAS, "output_provenance_present": complete and isinstance(result["provenance"], dict),
    }.items()})


def provenance_consistent(rule_evidence: DataFrame) -> DataFrame:
    """(rule_id, consistent): whether all rows of a rule tell the same of it."""
    key = F.struct(*(F.col(c) for c in PROVENANCE[1:]))
    return rule_evidence.groupBy("rule_id").agg((F.count_distinct(F.to_json(key)) <= 1).alias("consistent"))


def pipeline_checks(modules: DataFrame, rule_evidence: DataFrame, terms: DataFrame, nodes: DataFrame, fdr: float = 0.05) -> DataFrame:
    """(check_id, status): the seven invariants of module decisions, their rules, terms and nodes."""
    said = F.lower(F.concat_ws(" ", "primary_interpretation", "warning", "evidence_rationale"))
    a = _counts(modules, technical=(F.col("interpretation_class") == "technical_or_covariate") & F.col("priority_eligible"), unsupported=F.col("priority_eligible") & ~F.coalesce(F.col("best_supporting_fdr") <= fdr, F.lit(False)), claims=said.rlike("cell fraction|deconvolution"))
    a = a.join(F.broadcast(modules.agg(F.count_distinct("community_louvain").alias("ids"))))
    a = a.join(F.broadcast(terms.agg(F.count_if(~F.coalesce(F.col("fdr") <= fdr, F.lit(False))).alias("beyond"))))
    a = a.join(F.broadcast(nodes.join(modules.select("community_louvain"), "community_louvain", "left_anti").agg(F.count(F.lit(1)).alias("lost"))))
    empty = reduce(lambda x, y: x | y, (F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in PROVENANCE[:5]))
    n = F.col("reference_count")
    bad = empty | ~F.col("curation_status").isin(CURATION) | n.isNull() | (n < 0) | ((F.col("curation_status") == "verified") & ((n == 0) | (F.coalesce(F.trim("references"), F.lit("")) == "")))
    a = a.join(F.broadcast(rule_evidence.agg(F.count_if(F.coalesce(bad, F.lit(True))).alias("bad_rules"))))
    a = a.join(F.broadcast(provenance_consistent(rule_evidence).agg(F.count_if(~F.col("consistent")).alias("torn"))))
    return _checks(a, {
        "unique_module_rows": F.col("ids") == F.col("rows"), "all_nodes_receive_module_annotations": F.col("lost") == 0, "significant_terms_respect_fdr_threshold": F.col("beyond") == 0,
        "technical_modules_are_not_priority": F.col("technical") == 0, "priority_requires_significant_database_evidence": F.col("unsupported") == 0,
        "no_cell_fraction_or_deconvolution_claims": F.col("claims") == 0, "rule_evidence_has_explicit_provenance": (F.col("bad_rules") == 0) & (F.col("torn") == 0),
    })
