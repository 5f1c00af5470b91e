"""A full run: gene table and resources to scored, annotated and published results."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import petrel
from petrel.functions import columns as C
from petrel.operators import canonical, enrich, evidence, graph, louvain, mapping, paths, provenance, report, score
from petrel.operators import texts as row_texts
from petrel.operators.checkpoints import checkpointed
from petrel.plans import sheets as forms
from petrel.sources import contract, labels, rules, sinks
from petrel.sources.resources import Resources


@dataclass(frozen=True)
class Config:
    top_n: int = 30
    fdr: float = 0.05
    enrichment: bool = True
    rulebook: tuple = ()
    contract: tuple = ()
    major_modules: int = 5
    least_module: int = 5

    def __post_init__(self) -> None:
        contract.check_parameters(400, self.top_n, self.enrichment)


@dataclass
class Result:
    """The run's tables by name, and its numbers."""

    tables: dict[str, DataFrame]
    counts: dict[str, float] = field(default_factory=dict)
    checks: DataFrame | None = None


def mapped_genes(genes: DataFrame, res: Resources) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(initial, corrections, final, selected) mappings of the genes."""
    names = mapping.unique_names(res.proteins.select("protein_id", "name"), res.aliases.select("protein_id", "alias"))
    initial = checkpointed(mapping.mapped(genes, names))
    fixes = checkpointed(mapping.alias_corrections(initial.where("protein_id is null"), res.proteins.select("protein_id", "name"), res.aliases))
    final = checkpointed(mapping.mapped(mapping.corrected(genes, fixes), names))
    return initial, fixes, final, checkpointed(mapping.resolved(final))


def network(selected: DataFrame, res: Resources) -> dict[str, DataFrame]:
    """Vertices, edges and every measure of the selected proteins' network."""
    vertices, edges = graph.induced(res.links, selected.select(F.col("protein_id").alias("id")), res.threshold)
    vertices, edges = checkpointed(vertices), checkpointed(edges)
    graph.require_edges(vertices, edges)
    n = vertices.count()
    member = checkpointed(graph.largest_component(graph.components(vertices, edges)))
    measured = checkpointed(paths.measures(vertices, edges))
    degree = checkpointed(graph.degrees(vertices, edges))
    clustered = checkpointed(graph.clustering(degree, graph.triangles(edges, degree)))
    central = checkpointed(graph.normalised_betweenness(measured.select("id", "betweenness", "stress"), n))
    community = checkpointed(louvain.louvain(vertices, edges))
    annotation = selected.select(F.col("protein_id").alias("id"), "gene", "pvalue", "logFC")
    nodes = graph.node_metrics(annotation, member, clustered, central, graph.normalised_distances(measured, n), community)
    scored = checkpointed(score.priority_class(score.with_levels(score.ranked(score.scored(nodes)))))
    summary = graph.graph_summary(vertices, edges, member, clustered, graph.summed_distances(member, measured), graph.modularity(edges, community), res.threshold)
    return {"vertices": vertices, "edges": edges, "nodes": scored, "summary": checkpointed(summary), "histogram": graph.degree_histogram(degree)}


def query_sets(nodes: DataFrame, cfg: Config) -> DataFrame:
    """(query_name, id): all nodes, the top candidates, and each major module."""
    everything = nodes.select(F.lit("all_nodes").alias("query_name"), "id")
    top = nodes.where(F.col("candidate_rank") <= cfg.top_n).select(F.lit("top_candidates").alias("query_name"), "id")
    big = nodes.groupBy("community").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cfg.least_module).orderBy(F.desc("n"), "community").limit(cfg.major_modules)
    modules = nodes.join(F.broadcast(big.select("community")), "community").select(F.concat(F.lit("module_"), F.col("community").cast("string")).alias("query_name"), "id")
    return everything.union(top).union(modules)


def enrichments(nodes: DataFrame, selected: DataFrame, terms: DataFrame, cfg: Config) -> DataFrame:
    """Terms of all nodes against the annotated species, and of the top nodes and each major module against the mapped genes."""
    names = selected.select(F.col("protein_id").alias("id"), "gene")
    sets = query_sets(nodes, cfg)
    everything = enrich.enriched(terms, sets.where("query_name = 'all_nodes'"), terms.select("id").distinct(), names)
    return checkpointed(everything.unionByName(enrich.enriched(terms, sets.where("query_name <> 'all_nodes'"), names.select("id"), names)))


def module_labels(members: DataFrame, found: DataFrame) -> DataFrame:
    """Marker overlap, the label of the best set, the label by terms, the best label rule and its themes."""
    spark = members.sparkSession
    overlap = evidence.marker_overlap(members, rules.marker_sets(spark, labels.MARKERS))
    size = members.groupBy("module").agg(F.count(F.lit(1)).cast("int").alias("module_size"))
    text = enrich.collapsed(found, "module").select("module", F.col("top_interpretable_terms").alias("term_text"), F.col("best_interpretable_fdr").alias("best_fdr"))
    rows = overlap.join(size, "module").join(text, "module", "left").withColumn("counts", labels.counts_of(F.col("marker_summary")))
    best = evidence.label_rules(rows, rules.label_rules(spark, labels.RULES))
    themes = labels.supporting_themes(rows.join(best.select("module", "label_id"), "module"), rules.label_rules(spark, labels.RULES))
    by_set = rows.withColumns({"marker_label": labels.set_label(F.col("best_set")), "term_label": labels.label_from_terms(F.col("term_text"), labels.set_label(F.col("best_set")))})
    return by_set.select("module", "module_size", "marker_summary", "evidence", "marker_label", "term_label").join(best.select("module", "final_label", "score", "confidence"), "module").join(themes, "module")


def module_table(decided: DataFrame) -> DataFrame:
    """Decisions on modules under their canonical names; what a decision doesn't tell is not_available."""
    known = {
        "interpretation_class": F.col("interpretation_class"), "primary_interpretation": F.col("primary_interpretation"), "secondary_themes": F.col("secondary_interpretations"), "confidence": F.col("confidence"),
        "priority_eligible": F.col("priority_eligible"), "term_supporting_genes": F.col("term_supporting_genes"), "best_supporting_fdr": F.col("best_fdr"), "conflict_detected": F.col("conflict_detected"), "warning": F.lit("no_warning"),
        "interpretation_scope": F.lit("module"), "evidence_rationale": F.concat(F.lit("Class "), "interpretation_class", F.lit(" with confidence "), "confidence", F.lit(".")),
    }
    key = F.col("module").alias("community_louvain")
    return decided.select(key, F.col("module").cast("string").alias("module_id"), "module_size", *(known.get(f, F.lit("not_available")).alias(f) for f in canonical.MODULE_FIELDS))


def node_table(full: DataFrame, modules: DataFrame) -> DataFrame:
    """Nodes under their canonical names with the fields of their modules; components are numbered from 1 on."""
    full = full.withColumn("component", F.dense_rank().over(W.orderBy("component")))
    named = {"STRING_id": "id", "community_louvain": "community", "candidate_eligibility": "eligibility"}
    return canonical.with_module_fields(full.select(*(F.col(named.get(c, c)).alias(c) for c in ["STRING_id", "gene", *canonical.MEASURES])), modules).select(*canonical.NODE_FIELDS)


def canonical_result(result: Result, folder: str, manifest: dict) -> dict:
    """The result's ten sections, checked."""
    t = result.tables
    out = {
        "schema_versions": canonical.SCHEMAS, "output_dir": folder,
        "network": {"graph": t["edges"], "node_annotations": t["Node annotations"], "module_annotations": t["Module annotations"], "graph_summary": t["Network summary"]},
        "biological_evidence": {"module_annotations": t["Module annotations"], "module_rule_evidence": t["Rule provenance"], "significant_module_terms": t["Significant terms"], "node_annotations": t["Node annotations"], "validation": t["Validation"]},
        "priorities": {"proteins": t["Final priorities"], "modules": t["Module priorities"], "candidate_evidence": t["Candidate evidence"]},
        "reports": {"analytical": forms.COLUMNS, "technical": forms.TECHNICAL}, "mapping": t["Mapping summary"], "files": manifest["outputs"], "compatibility": canonical.DEPRECATED, "provenance": manifest,
    }
    evidence.require_passed(canonical.result_checks(t["edges"].sparkSession, out), "result")
    return out


def run(genes: DataFrame, res: Resources, cfg: Config = Config(), approved: DataFrame | None = None) -> Result:
    """genes: input_row, gene, logFC, pvalue, valid under the contract; approved: symbol, approved, if symbols are to be normalised."""
    spark = genes.sparkSession
    given = genes
    if approved is not None:
        genes = mapping.normalised_symbols(genes, approved)
    else:
        genes = genes.withColumns({"input_gene": F.col("gene"), "changed": F.lit(False)})
    genes = checkpointed(genes)
    initial, fixes, final, selected = mapped_genes(genes, res)
    if selected.count() < 2:
        raise ValueError("fewer than two genes were mapped to proteins")
    net = network(selected, res)
    nodes = net["nodes"]
    t: dict[str, DataFrame] = {
        "Mapping summary": mapping.summary(initial, final, list(cfg.contract)).orderBy("position").select("metric", "value"), "Collisions": mapping.collision_audit(final), "Alias corrections": fixes, "Unmapped genes": mapping.unmapped_genes(final),
        "Gene status": mapping.gene_status(genes, initial, fixes, final), "Symbol normalisation": genes.select("input_gene", "gene", "changed"), "Session info": forms.session_info(spark), "Network summary": net["summary"].select("metric", "value"),
        "Modules": report.module_summary(nodes).orderBy(F.desc("module_size"), "community"), "Links": mapping.network_links(selected, res.threshold),
    }
    members = nodes.select(F.col("community").alias("module"), "gene")
    genes_by = evidence.module_genes(members)
    none = spark.createDataFrame([], "module int, category string, term string, description string, pvalue double, fdr double, preferred_names string")
    found = none
    if cfg.enrichment and res.terms is not None:
        rows = enrichments(nodes, selected, res.terms, cfg)
        t |= {"Enrichment": rows, "Top enrichment": enrich.selected(rows, ["query_name"])}
        found = rows.where(F.col("query_name").startswith("module_")).withColumn("module", F.substring("query_name", 8, 20).cast("int"))
        t["Module terms"] = enrich.collapsed(found, "module")
    terms = checkpointed(evidence.significant_terms(evidence.prepared_terms(found, "module", cfg.fdr)))
    decided = checkpointed(evidence.module_decisions(genes_by, terms, evidence.technical(genes_by)))
    t |= {"Significant terms": terms, "Module annotations": decided}
    t["Module labels"] = module_labels(members, found)
    if cfg.rulebook:
        t["Rule evidence"] = checkpointed(evidence.rule_evidence(genes_by, terms, rules.frame(spark, list(cfg.rulebook))))
    entity = C.entity_class(F.col("gene"))
    full = nodes.withColumn("entity_class", entity).withColumn("eligibility", C.eligibility(F.col("entity_class"))).join(decided.select(F.col("module").alias("community"), F.col("confidence").alias("module_confidence"), "interpretation_class", "priority_eligible", "conflict_detected", F.col("primary_interpretation").alias("biological_context")), "community")
    full = checkpointed(full.withColumn("warning", report.warning(F.lit("no_warning"), F.col("eligibility"), F.col("conflict_detected"))))
    best = checkpointed(report.final_priorities(full))
    n = net["vertices"].count()
    mapped_summary, config = mapping.summary(initial, final), f"threshold={res.threshold}; top_n={cfg.top_n}; enrichment={cfg.enrichment}; fdr={cfg.fdr}"
    canonical_modules = evidence.annotations(genes_by, terms, t["Rule evidence"], evidence.technical(genes_by)) if cfg.rulebook else module_table(decided)
    canonical_nodes = checkpointed(node_table(full, canonical_modules))
    reported = report.candidate_evidence(full, best, cfg.top_n).select(F.col("id").alias("STRING_id"), "priority_status")
    ranks = full.select(F.col("id").alias("STRING_id"), F.col("candidate_rank").alias("network_candidate_rank"), "degree_rank", "betweenness_rank", "stress_rank", *score.COMPONENTS)
    attributes = checkpointed(canonical.graph_attributes(canonical_nodes.join(ranks, "STRING_id"), best.select(F.col("id").alias("STRING_id")), reported))
    evidence.require_passed(canonical.graph_checks(attributes), "graph attributes")
    texts = enrich.collapsed(found, "module").select(F.col("module").alias("community"), "top_raw_terms", "top_interpretable_terms", "best_interpretable_fdr")
    readable = report.readable_modules(report.module_summary(nodes), texts)
    told = decided.select(F.col("module").alias("community"), F.col("primary_interpretation").alias("interpretation"), "confidence")
    readable = row_texts.module_texts(readable.join(told, "community", "left")).drop("interpretation", "confidence")
    t["Row texts"] = row_texts.node_texts(full, F.col("biological_context")).select("id", "gene", "candidate_rank", "topology_support", "expression_support", "matrix_rationale")
    by_kind = {"Module": F.col("query_name").startswith("module_"), "Network": F.col("query_name") == "all_nodes", "Candidate": F.col("query_name") == "top_candidates"}
    if "Enrichment" in t:
        for kind, mine in by_kind.items():
            t |= {f"{kind} enrichment": t["Enrichment"].where(mine), f"Top {kind.lower()} enrichment": enrich.selected(t["Enrichment"].where(mine), ["query_name"], 10 if kind == "Module" else 25)}
    t |= {
        "Genes used": selected, "Readable modules": readable.orderBy("module_rank", "community"), "Major modules": readable.orderBy(F.desc("module_size"), "community").limit(cfg.major_modules),
        "Node annotations": canonical_nodes, "Graph attributes": attributes,
    }
    counts = {"input_rows": given.count(), "top_n": cfg.top_n, "mapped_proteins": selected.count(), "network_nodes": n, "network_edges": net["edges"].count(), "final_priority_candidates": best.count()}
    t |= {
        "Node metrics": full, "Final priorities": best, "Module priorities": report.module_priorities(decided, terms, n), "Candidate evidence": report.candidate_evidence(full, best, cfg.top_n),
        "Network overview": report.network_overview(net["summary"], full, net["histogram"]), "Executive summary": report.summary_rows(mapped_summary, net["summary"].select("metric", "value"), decided, best, config),
    }
    checks = evidence.validation(decided, members)
    evidence.require_passed(checks, "module annotations")
    rule_rows = rules.with_provenance(t["Rule evidence"], rules.curation(spark, list(cfg.rulebook))) if cfg.rulebook else spark.createDataFrame([], f"module int, {rules.CURATED}")
    bundle = {"module_annotations": checkpointed(canonical_modules), "module_rule_evidence": checkpointed(rule_rows), "significant_module_terms": terms, "node_annotations": canonical_nodes, "validation": checks}
    # the bundle's nine invariants, and the seven of what it says
    evidence.require_passed(canonical.evidence_checks(bundle), "evidence bundle")
    evidence.require_passed(canonical.pipeline_checks(*(bundle[k] for k in ("module_annotations", "module_rule_evidence", "significant_module_terms", "node_annotations")), cfg.fdr), "module evidence")
    t["Rule provenance"] = bundle["module_rule_evidence"].select(*canonical.PROVENANCE).distinct()
    worst = score.reconstructed(nodes).agg(F.max("score_error")).first()[0]
    if worst > 1e-12:
        raise ValueError(f"a score differs from its components by {worst}")
    t["Validation"] = checks
    return Result(t | {"vertices": net["vertices"], "edges": net["edges"]}, counts, checks)


ANALYTICAL = ["Executive summary", "Final priorities", "Module priorities", "Candidate evidence", "Network overview"]


def publish(result: Result, target: str, case: str, twins: bool = False) -> str:
    """Two workbooks, the graph, a manifest and checksums, in one rename."""
    contract.case_id(case)
    tables = result.tables
    folder = os.path.join(target, case)

    def write(staging: str) -> None:
        sheets = {k: v for k, v in tables.items() if k not in ("vertices", "edges", "Graph attributes")}
        analytical = {k: checkpointed(v) for k, v in forms.shaped(tables).items()}
        if bad := [k for k, v in forms.checks(analytical) if v == "FAIL"]:
            raise ValueError(f"analytical sheets: failed checks: {', '.join(bad)}")
        sinks.write_workbook(f"{staging}/analytical.xlsx", analytical)
        sinks.write_workbook(f"{staging}/technical.xlsx", forms.technical(tables))
        vertices = canonical.matched(tables["vertices"].select(F.col("id").alias("STRING_id")), tables["Graph attributes"])
        sinks.write_graphml(f"{staging}/network.graphml", vertices.withColumn("id", F.col("STRING_id")), tables["edges"])
        links = tables["Links"].collect()
        with open(f"{staging}/network_links.txt", "w", encoding="utf-8") as f:
            f.writelines(f"{r['name']}\t{r['url']}\n" for r in links)
        if twins:
            sinks.parquet_twins(f"{staging}/tables", sheets)
        files = sorted(x for x in os.listdir(staging) if os.path.isfile(f"{staging}/{x}"))
        roles = {"analytical_report": "analytical.xlsx", "technical_report": "technical.xlsx", "string_links": "network_links.txt", "graphml": "network.graphml"}
        outputs = provenance.file_metadata({role: f"{staging}/{name}" for role, name in roles.items()})
        root = os.path.dirname(os.path.dirname(os.path.abspath(petrel.__file__)))
        manifest = provenance.build("petrel", petrel.__version__, root, case, {"top_n": result.counts.get("top_n", 0)}, result.counts, outputs)
        canonical_result(result, folder, manifest)
        provenance.write(f"{staging}/manifest.json", manifest | {"schema_version": "1.0.0", "counts": result.counts, "files": [{"name": x, "size": os.path.getsize(f"{staging}/{x}"), "sha256": sinks.sha256(f"{staging}/{x}")} for x in files]})
        sinks.write_checksums(f"{staging}/checksums.sha256", [f"{staging}/{x}" for x in [*files, "manifest.json"]])

    sinks.published(folder, write)
    return folder


def main(argv: list[str] | None = None) -> int:
    import argparse

    p = argparse.ArgumentParser(description="Ranked, audited interaction network of a gene table.")
    p.add_argument("--input", required=True)
    p.add_argument("--resources", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--case")
    p.add_argument("--threshold", type=int, default=400)
    p.add_argument("--top-n", type=int, default=30)
    p.add_argument("--rules")
    p.add_argument("--no-enrichment", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("petrel").getOrCreate()
    book: tuple = ()
    if a.rules:
        import json

        with open(a.rules, encoding="utf-8") as f:
            book = tuple(rules.checked(json.load(f)))
    genes, agreed = contract.read_genes(spark, a.input)
    res = Resources.open(spark, a.resources, a.threshold, not a.no_enrichment)
    result = run(genes, res, Config(top_n=a.top_n, enrichment=not a.no_enrichment, rulebook=book, contract=tuple(agreed.rows())))
    print(publish(result, a.output, a.case or contract.case_from_path(a.input)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
