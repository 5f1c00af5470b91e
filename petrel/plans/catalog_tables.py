"""The registered queries of table shaping, joins of a run, canonical outputs, labels and audits."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrel.functions import columns as C
from petrel.functions import shape
from petrel.operators import audit, canonical, diff, enrich, evidence, graph, mapping, paths, report, score, texts
from petrel.operators.checkpoints import checkpointed, shared_folder, written
from petrel.plans import fixtures, sheets
from petrel.plans.catalog import _MM, _MORE, _candidates, _mapped, _sql, query
from petrel.plans.catalog_evidence import _decisions, _evidence, _full, _modules, _significant
from petrel.plans.fixtures import THRESHOLD, Tables
from petrel.sources import contract, discovery, graphml, labels, rules, sinks


def _texts(values: dict[str, str], k: str, v: str) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return "SELECT * FROM (VALUES " + ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in values.items()) + f") v({k}, {v})"


def _list(values) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in values) + "]"


# ---------------------------------------------------------------- shaping


@query(_sql("SELECT id, gene, logFC FROM genes", "genes"))
def drop_fields(t: Tables) -> DataFrame:
    return shape.without(t.genes(), ["input_row", "module", "pvalue", "stress_centrality", "lines", "symbol", "not there"])


@query(_sql("SELECT symbol, id, gene, module FROM genes", "genes"))
def key_first(t: Tables) -> DataFrame:
    return shape.key_first(t.genes().select("id", "gene", "module", "symbol"), "symbol")


@query(_sql("SELECT gene, id FROM genes", "genes"))
def any_of_columns(t: Tables) -> DataFrame:
    return shape.any_of(t.genes(), ["absent", "gene", "id"])


@query("SELECT 1 AS place, 'gene' AS name UNION ALL SELECT 2, 'module' UNION ALL SELECT 3, 'id' UNION ALL SELECT 4, 'logFC'")
def place_column(t: Tables) -> DataFrame:
    df = shape.placed(shape.placed(t.genes().select("id", "gene", "logFC", "module"), "module", before="logFC"), "id", after="module")
    return t.spark.createDataFrame([(i + 1, c) for i, c in enumerate(df.columns)], "place int, name string")


@query("SELECT 'pvalue' AS missing, 'p_size' AS extra")
def schema_difference(t: Tables) -> DataFrame:
    missing, extra = shape.schema_difference(t.read("part").select("p_partkey", "p_size"), ["p_partkey", "pvalue"])
    return t.spark.createDataFrame([(",".join(missing), ",".join(extra))], "missing string, extra string")


@query("SELECT (SELECT count(*) FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem)) AS missing, (SELECT count(*) FROM (SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part)) AS extra")
def id_sets_equal(t: Tables) -> DataFrame:
    return shape.set_difference(t.read("part").select("p_partkey"), t.read("lineitem").select("l_partkey"))


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def anti_membership(t: Tables) -> DataFrame:
    return t.read("part").select("p_partkey").join(t.read("lineitem").where("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_anti")


@query("SELECT n_nationkey, CAST(list_position([7, 3, 11, 0], n_nationkey) AS INTEGER) AS position FROM nation WHERE n_nationkey IN (7, 3, 11, 0)")
def order_by_list(t: Tables) -> DataFrame:
    return shape.in_order_of(t.read("nation"), "n_nationkey", [7, 3, 11, 0]).orderBy("position").select("n_nationkey", "position")


@query("SELECT id, CAST(row_number() OVER (ORDER BY try_cast(id AS DOUBLE) NULLS LAST, id) AS INTEGER) AS position FROM (SELECT CASE WHEN n_nationkey % 4 = 0 THEN n_name ELSE CAST(n_nationkey AS VARCHAR) END AS id FROM nation)")
def module_order(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    ids = t.read("nation").select(F.when(F.col("n_nationkey") % 4 == 0, F.col("n_name")).otherwise(F.col("n_nationkey").cast("string")).alias("id"))
    return ids.withColumn("position", F.row_number().over(W.orderBy(*shape.numbers_first(F.col("id")))))


_MORE["sizes"] = ("SELECT module, count(*) AS module_size FROM genes GROUP BY 1", ["genes"])


def _sizes(t: Tables) -> DataFrame:
    return t.genes().groupBy("module").agg(F.count(F.lit(1)).alias("module_size"))


@query(_sql("SELECT module, module_size, CAST(rank() OVER (ORDER BY module_size DESC) AS INTEGER) AS module_rank FROM sizes", "sizes"))
def module_rank(t: Tables) -> DataFrame:
    return shape.ranked_by_size(_sizes(t), "module_size")


@query(_sql("SELECT module, module_size FROM sizes ORDER BY module_size DESC, module LIMIT 5", "sizes"))
def largest_modules(t: Tables) -> DataFrame:
    return _sizes(t).orderBy(F.desc("module_size"), "module").limit(5)


@query(_sql("SELECT module, CAST(row_number() OVER (ORDER BY list_position([4, 9, 2, 21], module)) AS INTEGER) AS major_module_rank FROM sizes WHERE module IN (4, 9, 2, 21)", "sizes"))
def major_module_rank(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    return shape.in_order_of(_sizes(t), "module", [4, 9, 2, 21]).select("module", F.row_number().over(W.orderBy("position")).alias("major_module_rank"))


@query(_sql("SELECT id, gene FROM cand ORDER BY betweenness DESC, gene, id LIMIT 30", "cand"))
def top_by_betweenness(t: Tables) -> DataFrame:
    return score.top(_candidates(t), "betweenness").select("id", "gene")


@query(_sql("SELECT id, gene FROM cand ORDER BY stress_centrality DESC, gene, id LIMIT 30", "cand"))
def top_by_stress(t: Tables) -> DataFrame:
    return score.top(_candidates(t), "stress_centrality").select("id", "gene")


@query("SELECT r_name || '; ' || n_name AS text, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey")
def combined_text(t: Tables) -> DataFrame:
    rows = t.read("nation").join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", C.joined_text("; ", F.col("r_name"), F.lit(None).cast("string"), F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")), F.lit(""), F.col("n_name")).alias("text"))


@query("SELECT p_partkey, list_filter(w, lambda x, i: list_position(w, x) = i) AS genes FROM (SELECT p_partkey, list_filter(list_transform(string_split_regex(p_name || ';, ' || p_brand || '|' || p_name, '[,;|/\\s]+'), lambda x: upper(trim(x))), lambda x: x <> '') AS w FROM part)")
def split_gene_text(t: Tables) -> DataFrame:
    return t.read("part").select("p_partkey", C.gene_list(F.concat("p_name", F.lit(";, "), "p_brand", F.lit("|"), "p_name")).alias("genes"))


@query(_sql("SELECT id, CASE WHEN logFC > 0 THEN 'predominantly_upregulated' WHEN logFC < 0 THEN 'predominantly_downregulated' ELSE 'mixed_or_not_available' END AS direction FROM genes", "genes"))
def dominant_direction(t: Tables) -> DataFrame:
    return t.genes().select("id", C.direction(F.col("logFC")).alias("direction"))


@query("SELECT l_orderkey, l_linenumber, least(CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR)) || '|' || greatest(CAST(l_suppkey AS VARCHAR), CAST(l_partkey AS VARCHAR)) AS pair FROM lineitem")
def pair_keys(t: Tables) -> DataFrame:
    return t.read("lineitem").select("l_orderkey", "l_linenumber", C.pair_key(F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("pair"))


_SAID = "list_extract(['yes', ' True ', 'N', '0', 'maybe', '1'], CAST(id % 6 + 1 AS BIGINT))"


@query(_sql(f"SELECT id, {_SAID} AS said, CASE WHEN lower(trim({_SAID})) IN ('1', 'true', 't', 'yes', 'y') THEN true WHEN lower(trim({_SAID})) IN ('0', 'false', 'f', 'no', 'n') THEN false END AS truth FROM genes", "genes"))
def truth_values(t: Tables) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ["yes", " True ", "N", "0", "maybe", "1"])), (F.col("id") % 6 + 1).cast("int"))
    return t.genes().select("id", said.alias("said"), C.truth(said).alias("truth"))


# ---------------------------------------------------------------- mapping and joins of a run

_MORE["approved"] = ("SELECT s_name AS symbol, 'SYM' || s_suppkey AS approved FROM supplier WHERE s_suppkey % 5 = 0", [])


def _approved(t: Tables) -> DataFrame:
    return t.read("supplier").where("s_suppkey % 5 = 0").select(F.col("s_name").alias("symbol"), F.concat(F.lit("SYM"), F.col("s_suppkey").cast("string")).alias("approved"))


@query(_sql("SELECT id, g.gene AS input_gene, coalesce(approved, g.gene) AS gene, approved IS NOT NULL AS changed FROM genes g LEFT JOIN approved a ON g.gene = a.symbol", "genes", "approved"))
def normalise_symbols(t: Tables) -> DataFrame:
    return mapping.normalised_symbols(t.genes().select("id", "gene"), _approved(t))


@query(_sql("SELECT DISTINCT g.gene AS original_gene, m.protein_id, coalesce(a.approved, p.name) AS corrected_gene FROM gene_rows g JOIN (SELECT upper(alias) AS k, min(protein_id) AS protein_id FROM aliases GROUP BY 1 HAVING count(DISTINCT protein_id) = 1) m ON upper(trim(g.gene)) = m.k JOIN proteins p ON p.protein_id = m.protein_id LEFT JOIN approved a ON a.symbol = p.name", "gene_rows", "aliases", "proteins", "approved"))
def alias_correction_normalised(t: Tables) -> DataFrame:
    return mapping.alias_corrections(t.gene_rows(), t.proteins(), t.aliases(), approved=_approved(t))


@query(_sql("SELECT protein_id, first(gene ORDER BY pvalue, input_row) AS gene, min(pvalue) AS pvalue, round(avg(logFC), 9) AS logFC FROM mapped WHERE protein_id IS NOT NULL GROUP BY 1", "mapped"))
def protein_annotation(t: Tables) -> DataFrame:
    return mapping.annotation(_mapped(t)).withColumn("logFC", F.round("logFC", 9))


_PERCENT = "CAST(CAST(round_even(100.0 * {m} / {n}, 1) AS DECIMAL(18, 1)) AS VARCHAR)"


@query(
    _sql(
        "SELECT * FROM (SELECT unnest(range(11)) AS position, unnest(['input_rows', 'initial_mapped', 'initial_unmapped', 'initial_mapped_percent', 'final_mapped', 'final_unmapped', 'final_mapped_percent', 'STRING_mapping_collision_proteins', 'STRING_mapping_collision_rows_dropped', 'STRING_mapping_collision_policy', 'nodes_in_network']) AS metric, "
        f"unnest([n::VARCHAR, m::VARCHAR, (n - m)::VARCHAR, {_PERCENT.format(m='m', n='n')}, m::VARCHAR, (n - m)::VARCHAR, {_PERCENT.format(m='m', n='n')}, pr::VARCHAR, dr::VARCHAR, '{mapping.POLICY}', nodes::VARCHAR]) AS value "
        "FROM (SELECT count(*) AS n, count(protein_id) AS m FROM mapped), (SELECT count(*) FILTER (choice = 1 AND candidates > 1) AS pr, count(*) FILTER (choice > 1) AS dr, count(*) FILTER (choice = 1) AS nodes FROM ranked))",
        "mapped", "ranked",
    )
)
def mapping_summary(t: Tables) -> DataFrame:
    rows = _mapped(t)
    return mapping.summary(rows, rows).withColumn("position", F.col("position").cast("long"))


_RULES = contract.Contract({}).rules | {"gene_source_column": "Gene Symbol", "logFC_source_column": "log2-FC", "pvalue_source_column": "P.Value", "zero_pvalue_rows": "3"}


@query(_texts({f"input_{k}": v for k, v in _RULES.items()}, "metric", "value"))
def contract_rows(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(contract.Contract({"gene": "Gene Symbol", "logFC": "log2-FC", "pvalue": "P.Value"}, zero_pvalue_rows=3).rows(), "metric string, value string")


_MORE["summ"] = ("SELECT module AS community, count(*) AS module_size, round(quantile_cont(logFC, 0.5), 6) AS median_logFC FROM genes GROUP BY 1", ["genes"])
_MORE["tops"] = ("SELECT module AS community, string_agg(description, '; ' ORDER BY n) AS top_terms FROM (SELECT module, description, row_number() OVER (PARTITION BY module ORDER BY fdr, term) AS n FROM (SELECT *, row_number() OVER (PARTITION BY module, description ORDER BY fdr, term) AS k FROM (SELECT module, term_id AS term, description, fdr FROM mterms)) WHERE k = 1) WHERE n <= 3 GROUP BY 1", ["mterms"])


def _summary(t: Tables) -> DataFrame:
    return t.genes().groupBy(F.col("module").alias("community")).agg(F.count(F.lit(1)).alias("module_size"), F.round(F.percentile("logFC", 0.5), 6).alias("median_logFC"))


def _tops(t: Tables) -> DataFrame:
    return enrich.top_terms(fixtures.module_terms(t).withColumn("pvalue", F.col("fdr")), "module").withColumnRenamed("module", "community")


@query(_sql("SELECT s.community, module_size, top_terms FROM summ s LEFT JOIN tops USING (community)", "summ", "tops"))
def modules_with_terms(t: Tables) -> DataFrame:
    return shape.attached(_summary(t).select("community", "module_size"), _tops(t), "community", ["top_terms"])


@query(_sql("SELECT id, community, module_size, median_logFC FROM (SELECT id, module AS community FROM genes) JOIN summ USING (community)", "genes", "summ"))
def nodes_with_modules(t: Tables) -> DataFrame:
    return shape.attached(t.genes().select("id", F.col("module").alias("community")), _summary(t), "community", ["module_size", "median_logFC"])


def _collapsed(t: Tables) -> DataFrame:
    return _tops(t).where("community % 3 > 0").select("community", F.col("top_terms").alias("top_raw_terms"), F.when(F.col("community") % 3 == 1, F.col("top_terms")).alias("top_interpretable_terms"), F.lit(0.5).alias("best_interpretable_fdr"))


_MORE["readable"] = (
    "SELECT s.*, CAST(rank() OVER (ORDER BY module_size DESC) AS INTEGER) AS module_rank, CASE WHEN median_logFC > 0 THEN 'predominantly_upregulated' WHEN median_logFC < 0 THEN 'predominantly_downregulated' ELSE 'mixed_or_not_available' END AS dominant_expression_direction, "
    "CASE WHEN top_terms IS NULL OR s.community % 3 = 0 THEN 'No local STRING enrichment evidence available for this module.' WHEN s.community % 3 = 1 THEN 'Specific STRING/database enrichment terms used for interpretation: ' || top_terms || '; best FDR=0.5.' "
    "ELSE 'Only generic/secondary enrichment terms were available for this module in the main filter; raw top terms retained for audit: ' || top_terms || '.' END AS database_evidence_summary FROM summ s LEFT JOIN tops USING (community)",
    ["summ", "tops"],
)


@query(_sql("SELECT community, top_terms AS top_raw_terms, module_size FROM summ JOIN (SELECT * FROM tops WHERE community % 3 > 0) USING (community) UNION ALL SELECT community, NULL, module_size FROM summ WHERE community % 3 = 0", "summ", "tops"))
def modules_with_enrichment(t: Tables) -> DataFrame:
    return shape.attached(_summary(t).select("community", "module_size"), _collapsed(t), "community", ["top_raw_terms"])


@query(_sql("SELECT community, module_size, module_rank, dominant_expression_direction, database_evidence_summary FROM readable", "readable"))
def readable_modules(t: Tables) -> DataFrame:
    return report.readable_modules(_summary(t), _collapsed(t)).select("community", "module_size", "module_rank", "dominant_expression_direction", "database_evidence_summary")


@query(_sql("SELECT id, community, module_rank, database_evidence_summary FROM (SELECT id, module AS community FROM genes) JOIN readable USING (community)", "genes", "readable"))
def readable_nodes(t: Tables) -> DataFrame:
    modules = report.readable_modules(_summary(t), _collapsed(t))
    return shape.attached(t.genes().select("id", F.col("module").alias("community")), modules, "community", ["module_rank", "database_evidence_summary"])


def _short(x: str, digits: int, scientific: bool = True) -> str:
    """A number of few digits in SQL: digits and power of the scientific form, put together in the shorter way."""
    scale = f"pow(10.0, {digits - 1} - floor(log10(abs({x}))))"
    e = f"format('{{:.{digits - 1}e}}', CAST(round_even({x} * {scale}, 0) / {scale} AS DOUBLE))"
    d, k = f"rtrim(replace(split_part(ltrim({e}, '-'), 'e', 1), '.', ''), '0')", f"CAST(split_part({e}, 'e', 2) AS INTEGER)"
    fixed = f"CASE WHEN {k} >= length({d}) - 1 THEN rpad({d}, {k} + 1, '0') WHEN {k} >= 0 THEN {d}[:{k} + 1] || '.' || {d}[{k} + 2:] ELSE '0.' || repeat('0', -{k} - 1) || {d} END"
    short = f"{d}[1] || CASE WHEN length({d}) > 1 THEN '.' || {d}[2:] ELSE '' END || 'e' || split_part({e}, 'e', 2)"
    text = f"CASE WHEN length({short}) < length({fixed}) THEN {short} ELSE {fixed} END" if scientific else f"({fixed})"
    return f"CASE WHEN {x} = 0 THEN '0' ELSE CASE WHEN {x} < 0 THEN '-' ELSE '' END || {text} END"


def _level(x: str) -> str:
    q = lambda p: f"(SELECT quantile_cont({x}, {p}) FROM candidates)"
    return f"CASE WHEN {x} >= {q(0.9)} THEN 'very_high_top_10_percent' WHEN {x} >= {q(0.75)} THEN 'high_top_25_percent' WHEN {x} >= {q(0.5)} THEN 'medium_above_median' ELSE 'low_below_median' END"


_COMPONENT_TEXTS = [f"({_short(f'round({c}, 9)', 4, False)})" for c in score.COMPONENTS]
_TOPOLOGY_SQL = f"'degree rank ' || degree_rank || ' (' || {_level('degree')} || '); betweenness rank ' || betweenness_rank || ' (' || {_level('betweenness')} || '); stress rank ' || stress_rank || ' (' || {_level('stress_centrality')} || ')'"


@query(
    _sql(
        f"SELECT id, {_TOPOLOGY_SQL} AS topology_support, 'logFC=' || ({_short('logFC', 4)}) || '; |logFC| rank ' || abs_logFC_rank || ' (' || {_level('abs_logFC')} || '); p=' || ({_short('pvalue', 4)}) || '; -log10(p) rank ' || statistical_rank || ' (' || {_level('neg_log10_pvalue')} || ')' AS expression_support, "
        f"'Composite rank ' || candidate_rank || ' combines normalized degree=' || {_COMPONENT_TEXTS[0]} || ', betweenness=' || {_COMPONENT_TEXTS[1]} || ', log-stress=' || {_COMPONENT_TEXTS[2]} || ', |logFC|=' || {_COMPONENT_TEXTS[3]} || ' and statistical evidence=' || {_COMPONENT_TEXTS[4]} "
        "|| '. Module context: ' || CASE WHEN module % 5 = 0 THEN 'unresolved' ELSE 'nation ' || module END || '. Eligibility: ' || eligibility || '.' AS matrix_rationale FROM candidates",
        "candidates",
    )
)
def node_texts(t: Tables) -> DataFrame:
    """Components are rounded first, as the engines' logarithms differ in their last bits."""
    rows = _candidates(t).withColumns({c: F.round(c, 9) for c in score.COMPONENTS})
    return texts.node_texts(rows, F.when(F.col("module") % 5 > 0, F.concat(F.lit("nation "), F.col("module").cast("string")))).select("id", "topology_support", "expression_support", "matrix_rationale")


@query(
    _sql(
        f"SELECT id, 'Topology support ' || su || ' of 3; best rank ' || least(degree_rank, betweenness_rank, stress_rank) || '; ' || topo || '.' AS hub_rationale "
        f"FROM (SELECT *, CAST(degree_rank <= 10 AS INTEGER) + CAST(betweenness_rank <= 10 AS INTEGER) + CAST(stress_rank <= 10 AS INTEGER) AS su, {_TOPOLOGY_SQL} AS topo FROM candidates) WHERE su > 0",
        "candidates",
    )
)
def hub_texts(t: Tables) -> DataFrame:
    return texts.hub_texts(report.hubs(texts.node_texts(_candidates(t), F.lit(None).cast("string")))).select("id", "hub_rationale")


# ---------------------------------------------------------------- network

_MORE["measured"] = (
    "SELECT g.id, gene, pvalue, logFC, abs(logFC) AS abs_logFC, -log10(pvalue) AS neg_log10_pvalue, degree, round(coalesce(b, 0), 9) / nullif((n - 1) * (n - 2) / 2, 0) AS betweenness, c AS closeness, coalesce(h / nullif(n - 1, 0), 0) AS harmonic_closeness, coalesce(st, 0) AS stress_centrality, local_clustering, component, component = (SELECT component FROM lcc_whole) AS in_largest_component, module AS community "
    "FROM genes g JOIN clus ON clus.id = g.id JOIN comp_whole comp ON comp.id = g.id LEFT JOIN (SELECT s, count(*) FILTER (d > 0) / nullif(sum(d), 0) AS c, sum(1.0 / nullif(d, 0)) AS h FROM sp_whole GROUP BY 1) f ON f.s = g.id LEFT JOIN central ON central.id = g.id CROSS JOIN (SELECT count(*) AS n FROM vertices)",
    ["genes", "clus", "comp_whole", "lcc_whole", "sp_whole", "central", "vertices"],
)
_LEVELS = " + ".join(_MM.format(x=x) for x in ("abs_logFC", "neg_log10_pvalue")) + " + (" + " + ".join(_MM.format(x=x) for x in ("degree", "betweenness", "ln(1 + stress_centrality)")) + ") / 3"


@query(
    _sql(
        "SELECT id, gene, pvalue, logFC, abs_logFC, round(neg_log10_pvalue, 9) AS neg_log10_pvalue, degree, betweenness, round(closeness, 9) AS closeness, round(harmonic_closeness, 9) AS harmonic_closeness, stress_centrality, round(local_clustering, 9) AS local_clustering, "
        f"component, in_largest_component, community, round(({_LEVELS}) / 3, 9) AS candidate_score FROM measured",
        "measured",
    )
)
def node_metrics(t: Tables) -> DataFrame:
    """All sixteen columns. Sums over pairs are rounded before they are scored: equal ones must not differ in their last bits, which a level from least to most would magnify."""
    v, e = t.graph()
    n = v.count()
    measured = written(paths.measures(v, e).withColumn("betweenness", F.round("betweenness", 9)))
    degree = graph.degrees(v, e)
    central = graph.normalised_betweenness(measured.select("id", "betweenness", "stress"), n)
    out = graph.node_metrics(t.genes().select("id", "gene", "pvalue", "logFC"), graph.largest_component(graph.components(v, e)), graph.clustering(degree, graph.triangles(e, degree)), central, graph.normalised_distances(measured, n), t.genes().select("id", F.col("module").alias("community")))
    out = score.scored(written(out), strict=False).select(*out.columns, "candidate_score")
    return out.withColumns({c: F.round(c, 9) for c in ("neg_log10_pvalue", "closeness", "harmonic_closeness", "local_clustering", "candidate_score")})


@query(_sql(f"SELECT (SELECT count(*) FROM edges WHERE src = dst) AS loops, (SELECT count(*) - count(DISTINCT (src, dst)) FROM edges) AS repeated, (SELECT count(*) FROM edges) AS edges, {THRESHOLD} AS threshold", "edges"))
def simple_graph_check(t: Tables) -> DataFrame:
    key = F.struct(F.least("src", "dst"), F.greatest("src", "dst"))
    return t.edges().agg(F.count_if(F.col("src") == F.col("dst")).alias("loops"), (F.count(F.lit(1)) - F.count_distinct(key)).alias("repeated"), F.count(F.lit(1)).alias("edges"), F.lit(THRESHOLD).alias("threshold"))


# ---------------------------------------------------------------- canonical outputs

_MODULE_SQL = (
    "SELECT n_nationkey AS community_louvain, 'm' || n_nationkey AS module_id, n_regionkey AS module_size, CASE n_nationkey % 3 WHEN 0 THEN 'biological' WHEN 1 THEN 'unresolved' ELSE 'technical_or_covariate' END AS interpretation_class, "
    "'module' AS interpretation_scope, 'immune' AS compartment, lower(n_name) AS lineage, '' AS state, 'p' AS process, n_name AS primary_interpretation, 'none' AS secondary_themes, 'moderate' AS confidence, n_nationkey % 3 = 0 AS priority_eligible, "
    "'A;B' AS positive_marker_genes, 'C' AS supportive_marker_genes, 'D' AS term_supporting_genes, 'T' AS significant_supporting_terms, CASE WHEN n_nationkey % 3 = 0 THEN 0.01 END AS best_supporting_fdr, false AS conflict_detected, 'no_warning' AS warning, 'because' AS evidence_rationale FROM nation"
)
_MORE["mods"] = (_MODULE_SQL, [])
_MORE["annot"] = (
    "SELECT '9606.' || id AS STRING_id, id, gene, pvalue, logFC, abs_logFC, neg_log10_pvalue, degree, betweenness, degree / 100.0 AS closeness, degree / 50.0 AS harmonic_closeness, stress_centrality, 0.25 AS local_clustering, id % 3 AS component, id % 2 = 0 AS in_largest_component, module AS community_louvain, "
    "round(candidate_score, 9) AS candidate_score, class AS entity_class, eligibility AS candidate_eligibility, candidate_rank AS network_candidate_rank, degree_rank, betweenness_rank, stress_rank, degree_component, betweenness_component, log_stress_component, abs_logFC_component, statistical_component, "
    + ", ".join(f"m.{f} AS module_{f}" for f in canonical.MODULE_FIELDS)
    + " FROM candidates LEFT JOIN mods m ON community_louvain = module",
    ["candidates", "mods"],
)


def _canonical_modules(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    kind = F.when(k % 3 == 0, F.lit("biological")).when(k % 3 == 1, F.lit("unresolved")).otherwise(F.lit("technical_or_covariate"))
    made = {
        "interpretation_class": kind, "interpretation_scope": F.lit("module"), "compartment": F.lit("immune"), "lineage": F.lower("n_name"), "state": F.lit(""), "process": F.lit("p"), "primary_interpretation": F.col("n_name"),
        "secondary_themes": F.lit("none"), "confidence": F.lit("moderate"), "priority_eligible": k % 3 == 0, "positive_marker_genes": F.lit("A;B"), "supportive_marker_genes": F.lit("C"), "term_supporting_genes": F.lit("D"),
        "significant_supporting_terms": F.lit("T"), "best_supporting_fdr": F.when(k % 3 == 0, F.lit(0.01)), "conflict_detected": F.lit(False), "warning": F.lit("no_warning"), "evidence_rationale": F.lit("because"),
    }
    return t.read("nation").select(k.alias("community_louvain"), F.concat(F.lit("m"), k.cast("string")).alias("module_id"), F.col("n_regionkey").alias("module_size"), *(made[f].alias(f) for f in canonical.MODULE_FIELDS))


def _canonical_nodes(t: Tables) -> DataFrame:
    rows = _candidates(t).select(
        F.concat(F.lit("9606."), F.col("id").cast("string")).alias("STRING_id"), "id", "gene", "pvalue", "logFC", "abs_logFC", "neg_log10_pvalue", "degree", "betweenness", (F.col("degree") / 100.0).alias("closeness"), (F.col("degree") / 50.0).alias("harmonic_closeness"),
        "stress_centrality", F.lit(0.25).alias("local_clustering"), (F.col("id") % 3).alias("component"), (F.col("id") % 2 == 0).alias("in_largest_component"), F.col("module").alias("community_louvain"), "candidate_score", F.col("class").alias("entity_class"),
        F.col("eligibility").alias("candidate_eligibility"), F.col("candidate_rank").alias("network_candidate_rank"), "degree_rank", "betweenness_rank", "stress_rank", *score.COMPONENTS,
    )
    return canonical.with_module_fields(rows, _canonical_modules(t))


@query(_sql("SELECT id, " + ", ".join(f"module_{f}" for f in canonical.MODULE_FIELDS) + " FROM annot", "annot"))
def module_fields_on_nodes(t: Tables) -> DataFrame:
    return _canonical_nodes(t).select("id", *(f"module_{f}" for f in canonical.MODULE_FIELDS))


_STATUS = "CASE WHEN id % 11 = 0 THEN 'final_priority' WHEN id % 4 = 0 THEN 'extended_review_ready' WHEN candidate_eligibility = 'review_ready_canonical' THEN 'not_in_reported_top_n' ELSE candidate_eligibility END"
_MORE["gstat"] = (f"SELECT *, {_STATUS} AS status FROM annot", ["annot"])
_GRAPH_SQL = {
    "annotation_schema_version": f"'{canonical.SCHEMAS['biological_evidence']}'", "graphml_schema_version": f"'{canonical.SCHEMAS['graphml']}'", "pvalue": "greatest(pvalue, 1e-300)", "pvalue_was_floored_for_graphml": "pvalue < 1e-300", "degree": "CAST(degree AS DOUBLE)",
    "component": "CAST(component AS DOUBLE)", "community_louvain": "CAST(community_louvain AS VARCHAR)", "louvain_module_id": "CAST(community_louvain AS VARCHAR)", "candidate_priority_status": "status", "cytoscape_label": "gene", "cytoscape_module_label": "module_primary_interpretation", "cytoscape_priority_class": "status",
} | {c: f"round({c}, 9)" for c in [*score.COMPONENTS, "neg_log10_pvalue"]}


def _graph_attributes(t: Tables) -> DataFrame:
    nodes = _canonical_nodes(t)
    return canonical.graph_attributes(nodes, nodes.where("id % 11 = 0"), nodes.where("id % 4 = 0").withColumn("priority_status", F.lit("extended_review_ready")))


@query(_sql("SELECT " + ", ".join(f"{_GRAPH_SQL.get(c, c)} AS {c}" for c in canonical.GRAPH_FIELDS) + " FROM gstat", "gstat"))
def graph_attributes(t: Tables) -> DataFrame:
    return _graph_attributes(t).withColumns({c: F.round(c, 9) for c in [*score.COMPONENTS, "neg_log10_pvalue"]})


@query(_sql("SELECT STRING_id, status FROM gstat", "gstat"))
def graph_priority_status(t: Tables) -> DataFrame:
    return _graph_attributes(t).select("STRING_id", F.col("candidate_priority_status").alias("status"))


# An edge to nowhere, one node less, two vertices too many in the manifest, and values changed by id.
_RELEASE = {
    "vertices_match_nodes": "count(*) FILTER (id = 5)", "candidate_score_agrees": "count(*) FILTER (id % 50 = 0 AND candidate_score <> 0)", "candidate_rank_agrees": "count(*) FILTER (id % 30 = 2)", "community_louvain_agrees": "count(*) FILTER (id % 40 = 1)",
    "final_set_agrees": "count(*) FILTER (id = 1)", "node_count_agrees": "max(2)", "module_count_agrees": "max(0)", "edge_count_agrees": "max(1)", "graph_is_simple": "max(0)", "edge_ends_known": "max(1)",
}


@query(_sql("SELECT check_id, different, CASE different WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS check_id, CAST({v} AS BIGINT) AS different FROM annot" for k, v in _RELEASE.items()) + ")", "annot"))
def release_checks(t: Tables) -> DataFrame:
    """A graph file, read back as tables, against nodes that differ from it by plan."""
    attributes = checkpointed(_graph_attributes(t))
    name = lambda c: F.concat(F.lit("9606."), F.col(c).cast("string"))
    links = checkpointed(t.edges().select(name("src").alias("src"), name("dst").alias("dst")))
    os.makedirs(root := shared_folder(t.spark).removeprefix("file://"), exist_ok=True)
    path = f"{root}/release-{uuid.uuid4().hex}.graphml"
    lost = t.spark.createDataFrame([("9606.1", "9606.none")], "src string, dst string")
    sinks.write_graphml(path, attributes.withColumn("id", F.col("STRING_id")), links.union(lost))
    n = F.substring_index("STRING_id", ".", -1).cast("long")
    nodes = attributes.where(n != 5).select(
        F.col("STRING_id").alias("id"), (F.col("candidate_score") * F.when(n % 50 == 0, 1.001).otherwise(1.0)).alias("candidate_score"),
        (F.col("network_candidate_rank") + F.when(n % 30 == 2, 1).otherwise(0)).alias("candidate_rank"), F.when(n % 40 == 1, "other").otherwise(F.col("community_louvain")).alias("community_louvain"),
    )
    final = attributes.where((n % 11 == 0) | (n == 1)).select(F.col("STRING_id").alias("id"))
    counts = {"nodes": attributes.count() + 2, "edges": links.count(), "modules": attributes.select("community_louvain").distinct().count()}
    found = graphml.vertices(t.spark, path).withColumnRenamed("network_candidate_rank", "candidate_rank")
    return audit.release(found, graphml.edges(t.spark, path), nodes, final, counts)


@query(_sql("SELECT STRING_id, gene FROM annot", "annot"))
def matched_vertices(t: Tables) -> DataFrame:
    vertices = t.vertices().select(F.concat(F.lit("9606."), F.col("id").cast("string")).alias("STRING_id"))
    return canonical.matched(vertices, _canonical_nodes(t).select("STRING_id", "gene"))


def _all_pass(names: str, failing: tuple[str, ...] = ()) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{'FAIL' if n in failing else 'PASS'}')" for n in names.split()) + ") v(check_id, status)"


@query(_all_pass("canonical_graphml_schema_complete legacy_annotation_fields_absent STRING_ids_are_unique graphml_pvalues_are_parser_safe graphml_schema_versions_are_pinned cytoscape_labels_use_canonical_interpretation", ("graphml_pvalues_are_parser_safe", "cytoscape_labels_use_canonical_interpretation")))
def graph_attribute_checks(t: Tables) -> DataFrame:
    """Of attributes in which two things were broken."""
    broken = _graph_attributes(t).withColumns({"pvalue": F.when(F.col("gene").endswith("7"), F.lit(0.0)).otherwise(F.col("pvalue")), "cytoscape_module_label": F.lit("old label")})
    return canonical.graph_checks(broken)


def _rule_rows(t: Tables) -> DataFrame:
    k = F.col("n_regionkey")
    return t.read("nation").select(
        F.concat(F.lit("rule_"), k.cast("string")).alias("rule_id"), F.col("n_nationkey").alias("module"), F.when(k == 0, F.lit("verified")).otherwise(F.lit("legacy_unverified")).alias("curation_status"), F.lit("1").alias("rule_version"), F.lit("1.0.0").alias("rule_schema_version"),
        F.lit("markers").alias("evidence_basis"), F.when(k == 0, F.lit(2)).otherwise(F.lit(0)).alias("reference_count"), F.when(k == 0, F.lit("a; b")).otherwise(F.lit("")).alias("references"),
    )


@query(_all_pass("evidence_object_is_list required_evidence_objects_present canonical_module_schema_present auxiliary_rule_evidence_provenance_present canonical_node_schema_present deprecated_node_annotation_fields_absent upstream_evidence_validation_passes module_ids_are_unique node_STRING_ids_are_unique", ("deprecated_node_annotation_fields_absent", "module_ids_are_unique")))
def evidence_bundle_checks(t: Tables) -> DataFrame:
    modules = _canonical_modules(t)
    bundle = {
        "module_annotations": modules.union(modules.where("community_louvain = 3")), "module_rule_evidence": _rule_rows(t), "significant_module_terms": fixtures.module_terms(t),
        "node_annotations": _canonical_nodes(t).withColumn("label_source", F.lit("old")), "validation": t.spark.createDataFrame([("x", "PASS")], "check_id string, status string"),
    }
    return canonical.evidence_checks(bundle)


@query(_all_pass("canonical_result_top_level_complete shadow_result_field_absent canonical_priorities_present canonical_network_present canonical_schema_versions_valid output_provenance_present", ("canonical_network_present",)))
def result_checks(t: Tables) -> DataFrame:
    parts = {s: {} for s in canonical.SECTIONS} | {"schema_versions": canonical.SCHEMAS, "priorities": {"proteins": 1, "modules": 2, "candidate_evidence": 3}, "network": {"graph": 1}}
    return canonical.result_checks(t.spark, parts)


@query(_all_pass("unique_module_rows all_nodes_receive_module_annotations significant_terms_respect_fdr_threshold technical_modules_are_not_priority priority_requires_significant_database_evidence no_cell_fraction_or_deconvolution_claims rule_evidence_has_explicit_provenance", ("no_cell_fraction_or_deconvolution_claims",)))
def pipeline_evidence_checks(t: Tables) -> DataFrame:
    modules = _canonical_modules(t).withColumn("evidence_rationale", F.when(F.col("community_louvain") == 2, F.lit("a Deconvolution")).otherwise(F.col("evidence_rationale")))
    terms = fixtures.module_terms(t).where("fdr <= 0.05")
    return canonical.pipeline_checks(modules, _rule_rows(t), terms, _canonical_nodes(t))


@query("SELECT 'rule_' || n_regionkey AS rule_id, count(DISTINCT CASE WHEN n_nationkey = 9 THEN 1 ELSE 0 END) = 1 AS consistent FROM nation GROUP BY n_regionkey")
def provenance_consistency(t: Tables) -> DataFrame:
    return canonical.provenance_consistent(_rule_rows(t).withColumn("rule_version", F.when(F.col("module") == 9, F.lit("2")).otherwise(F.col("rule_version"))))


@query("SELECT 'rule_' || n_regionkey AS rule_id, n_nationkey AS module, CASE WHEN n_regionkey = 0 THEN 'verified' ELSE 'legacy_unverified' END AS curation_status FROM nation")
def rule_provenance_attached(t: Tables) -> DataFrame:
    rows = _rule_rows(t)
    return rules.with_provenance(rows.select("rule_id", "module"), rows.select("rule_id", "curation_status").distinct())


@query("SELECT 'rule_' || r_regionkey AS rule_id, CASE WHEN r_regionkey < 3 THEN 'reviewed' ELSE 'unreviewed' END AS evidence_level, CASE WHEN r_regionkey < 3 THEN 'a; b;; ' || r_name ELSE '' END AS references, CASE WHEN r_regionkey < 3 THEN 3 ELSE 0 END AS reference_count FROM region")
def rule_provenance(t: Tables) -> DataFrame:
    r = t.read("region").select(F.concat(F.lit("rule_"), F.col("r_regionkey").cast("string")).alias("rule_id"), "r_regionkey", "r_name")
    known = r.where("r_regionkey < 3").select("rule_id", F.lit("reviewed").alias("evidence_level"), F.concat(F.lit("a; b;; "), "r_name").alias("references"))
    return rules.provenance(r.select("rule_id"), known)


@query("SELECT *, 'deprecated_compatibility_only' AS compatibility_status, 'forbidden_for_canonical_priority_and_graphml' AS decision_use FROM (" + _texts(dict(canonical.DEPRECATED), "legacy_field", "canonical_replacement") + ")")
def deprecated_fields(t: Tables) -> DataFrame:
    return canonical.deprecated_fields(t.spark)


@query(_texts(canonical.SCHEMAS, "artifact", "version"))
def schema_versions(t: Tables) -> DataFrame:
    return canonical.schema_versions(t.spark)


@query(
    _sql(
        "SELECT * FROM (SELECT unnest(range(16)) AS position, unnest(" + _list(report.SUMMARY) + ") AS item, unnest([n::VARCHAR, nodes::VARCHAR, (n - m)::VARCHAR, " + _PERCENT.format(m="m", n="n") + ", v::VARCHAR, e::VARCHAR, co::VARCHAR, la::VARCHAR, regexp_replace(CAST(CAST(round_even(la / v, 4) AS DECIMAL(18, 4)) AS VARCHAR), '\\.?0+$', ''), mo::VARCHAR, el::VARCHAR, te::VARCHAR, mi::VARCHAR, un::VARCHAR, fi::VARCHAR, " + f"'threshold={THRESHOLD}']) AS value "
        "FROM (SELECT count(*) AS n, count(protein_id) AS m FROM mapped), (SELECT count(*) FILTER (choice = 1) AS nodes FROM ranked), (SELECT count(*) AS v FROM vertices), (SELECT count(*) AS e FROM edges), "
        "(SELECT count(*) AS co, max(k) AS la FROM (SELECT count(*) AS k FROM comp_whole GROUP BY component)), "
        "(SELECT count(*) AS mo, count(*) FILTER (interpretation_class = 'biological' AND priority_eligible) AS el, count(*) FILTER (interpretation_class = 'technical_or_covariate') AS te, count(*) FILTER (interpretation_class = 'mixed_biological') AS mi, count(*) FILTER (interpretation_class = 'unresolved') AS un FROM decided), (SELECT count(*) AS fi FROM final))",
        "mapped", "ranked", "vertices", "edges", "comp_whole", "decided", "final",
    )
)
def executive_rows(t: Tables) -> DataFrame:
    rows = _mapped(t)
    v, e = t.graph()
    decided = checkpointed(_decisions(t))
    network = graph.sizes(v, e, graph.components(v, e)).selectExpr("stack(5, " + ", ".join(f"'{m}', cast({m} as string)" for m in report.SIZES) + ") AS (metric, value)")
    return report.summary_rows(mapping.summary(rows, rows), network, decided, report.final_priorities(_full(t, decided)), f"threshold={THRESHOLD}").withColumn("position", F.col("position").cast("long"))


@query(_sql("SELECT " + ", ".join(f"max(value) FILTER (metric = '{m}') AS {m}" for m in ("nodes", "absent")) + " FROM (SELECT 'nodes' AS metric, count(*) AS value FROM vertices)", "vertices"))
def metric_lookup(t: Tables) -> DataFrame:
    long = t.vertices().agg(F.count(F.lit(1)).alias("value")).select(F.lit("nodes").alias("metric"), "value")
    return shape.looked_up(long, "nodes").join(F.broadcast(shape.looked_up(long, "absent")))


@query("SELECT item, coalesce(m, '') AS meaning FROM (SELECT unnest(['density', 'nodes', 'nothing known']) AS item) LEFT JOIN (" + _texts(sheets.METRICS, "k", "m") + ") ON k = item")
def metric_meanings(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([("density",), ("nodes",), ("nothing known",)], "item string")
    return rows.select("item", sheets._meaning(F.col("item"), sheets.METRICS).alias("meaning"))


# ---------------------------------------------------------------- annotations of modules by their rules

_MORE["clash"] = ("SELECT module, rule_id, other FROM rivals WHERE place2 = 1 AND s1 >= 0.35 AND s2 >= 0.35 AND abs(s1 - s2) <= CASE WHEN anymo THEN 0.18 ELSE 0.08 END AND rule_id IN (SELECT rule_id FROM picked WHERE place = 1)", ["rivals", "picked"])
_MORE["chosen"] = ("SELECT module, rule_id, axis, display_label, round(sc, 9) AS sc, p, t, mo, false AS rival FROM picked WHERE place = 1 UNION ALL SELECT e.module, e.rule_id, e.axis, display_label, round(sc, 9), p, t, mo, true FROM evid e JOIN clash c ON e.module = c.module AND e.rule_id = c.other", ["picked", "evid", "clash"])
_MORE["notes"] = (
    "SELECT m.module, max(rule_id) FILTER (axis = 'lineage' AND NOT rival) AS lr, max(rule_id) FILTER (axis = 'process') AS pr, max(display_label) FILTER (axis = 'lineage' AND NOT rival) AS ll, max(display_label) FILTER (axis = 'process') AS pl, max(display_label) FILTER (rival) AS rl, "
    "max(sc) AS b, bool_or(p >= 2) AS mk, bool_or(t >= 1) AS tm, coalesce(bool_or(mo), false) AS alone, count(rule_id) > 0 AS any_rule, coalesce(bool_or(rival), false) AS torn FROM members m LEFT JOIN chosen c ON c.module = m.module GROUP BY 1",
    ["members", "chosen"],
)


@query(
    _sql(
        "SELECT module AS community_louvain, CASE WHEN torn THEN 'mixed_biological' WHEN any_rule THEN 'biological' ELSE 'unresolved' END AS interpretation_class, CASE WHEN torn THEN 'mixed_lineage' WHEN lr IS NOT NULL THEN 'lineage_supported' WHEN pr IS NOT NULL THEN 'process_supported_lineage_unresolved' ELSE 'unresolved' END AS interpretation_scope, "
        "CASE WHEN torn THEN 'mixed_lineage_associated' ELSE coalesce(lr, 'unresolved_lineage') END AS lineage, 'not_assigned' AS state, coalesce(pr, 'not_assigned') AS process, CASE WHEN any_rule THEN concat_ws(' / ', CASE WHEN torn THEN 'mixed-lineage-associated (' || ll || ' + ' || rl || ')' ELSE ll END, pl) ELSE 'unresolved biological context' END AS primary_interpretation, "
        "conf AS confidence, conf IN ('high', 'moderate') AND NOT torn AND any_rule AND coalesce(tm, false) AS priority_eligible, torn AS conflict_detected FROM (SELECT *, CASE WHEN b >= 0.72 AND mk AND tm AND NOT torn THEN 'high' WHEN b >= 0.5 AND (mk OR tm) AND NOT torn THEN 'moderate' WHEN b >= 0.35 THEN 'low' ELSE 'unresolved' END AS conf FROM notes)",
        "notes",
    )
)
def module_annotations(t: Tables) -> DataFrame:
    out = evidence.annotations(_modules(t), _significant(t), _evidence(t), evidence.technical(_modules(t)))
    return out.select("community_louvain", "interpretation_class", "interpretation_scope", "lineage", "state", "process", "primary_interpretation", "confidence", "priority_eligible", "conflict_detected")


# ---------------------------------------------------------------- columns by name


@query("SELECT 's_key' AS id_column, 's_synonym' AS alias_column, 'preferred_name' AS name_column, 'best_fdr' AS evidence_column")
def discovered_columns(t: Tables) -> DataFrame:
    s = t.read("supplier").select(F.col("s_suppkey").alias("n"), F.concat(F.lit("9606.ENSP"), F.col("s_suppkey").cast("string")).alias("s_key"), F.col("s_name").alias("preferred_name"), F.col("s_nationkey").cast("string").alias("s_synonym"))
    key = discovery.id_column(s)
    found = discovery.first_of(["term", "best_fdr", "FDR."], ["q_value", "Best FDR", "fdr"])
    return t.spark.createDataFrame([(key, discovery.alias_column(s, key), discovery.name_column(s), found)], "id_column string, alias_column string, name_column string, evidence_column string")


# ---------------------------------------------------------------- labels

_SET_NAMES = list(labels.MARKERS)
_MORE["lmods"] = (
    f"SELECT module, count(*)::INTEGER AS module_size, CASE WHEN module % 4 = 0 THEN 'no_marker_set_match' ELSE list_extract({_list(_SET_NAMES)}, CAST(module % {len(_SET_NAMES)} + 1 AS BIGINT)) || '(' || (module % 7 + 1) || '); another_set(1)' END AS marker_summary, "
    f"string_agg(DISTINCT {fixtures._words('id')}, '; ' ORDER BY {fixtures._words('id')}) AS term_text, min(pvalue) AS best_fdr FROM genes GROUP BY 1",
    ["genes"],
)
_MORE["lrules"] = ("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{r['label_id']}', '{r['fallback_label']}', {_list(r['marker_patterns'])}, {_list(r['core_term_patterns'])}, {_list(r['required_specific_patterns'])}, '{r['theme']}')" for i, r in enumerate(labels.RULES)) + ") v(position, label_id, fallback_label, mp, ct, rq, theme)", [])
_COUNT = "len(list_filter({p}, lambda p: regexp_matches(lower(coalesce(term_text, '')), p)))"
_MORE["lpairs"] = (
    "SELECT *, CASE WHEN m = 0 AND t = 0 AND r = 0 THEN 0 ELSE CAST(m >= 1 AS INTEGER) + CAST(m >= 3 AS INTEGER) + CAST(t >= 1 AS INTEGER) + CAST(t >= 3 AS INTEGER) + CAST(r >= 1 AS INTEGER) + CAST(best_fdr <= 0.05 AS INTEGER) + CAST(best_fdr <= 0.01 AS INTEGER) + CAST(module_size >= 10 AS INTEGER) + CASE WHEN m > 0 AND t > 0 THEN 2 ELSE 0 END END AS sc FROM "
    f"(SELECT *, coalesce(list_sum(list_transform(mp, lambda k: coalesce(try_cast(regexp_extract('; ' || marker_summary, '; ' || k || '\\(([0-9]+)\\)', 1) AS INTEGER), 0))), 0) AS m, {_COUNT.format(p='ct')} AS t, {_COUNT.format(p='rq')} AS r FROM lmods CROSS JOIN lrules)",
    ["lmods", "lrules"],
)
_MORE["lbest"] = ("SELECT *, CASE WHEN sc < 2 THEN 'unassigned_module' WHEN r > 0 OR m >= 3 THEN label_id ELSE fallback_label END AS final_label FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY sc DESC, m DESC, t DESC, r DESC, position) AS n FROM lpairs) WHERE n = 1", ["lpairs"])


def _label_modules(t: Tables) -> DataFrame:
    k = F.col("module")
    some = F.concat(F.element_at(F.array(*map(F.lit, _SET_NAMES)), (k % len(_SET_NAMES) + 1).cast("int")), F.lit("("), (k % 7 + 1).cast("string"), F.lit("); another_set(1)"))
    word = F.element_at(F.array(*map(F.lit, fixtures.TERM_WORDS)), (F.col("id") % len(fixtures.TERM_WORDS) + 1).cast("int"))
    rows = t.genes().groupBy("module").agg(F.count(F.lit(1)).cast("int").alias("module_size"), F.array_join(F.sort_array(F.collect_set(word)), "; ").alias("term_text"), F.min("pvalue").alias("best_fdr"))
    summary = F.when(k % 4 == 0, F.lit("no_marker_set_match")).otherwise(some)
    return rows.withColumn("marker_summary", summary).withColumn("counts", labels.counts_of(F.col("marker_summary")))


def _label_rules(t: Tables) -> DataFrame:
    return rules.label_rules(t.spark, labels.RULES)


@query(_sql("SELECT module, label_id, final_label, CAST(sc AS INTEGER) AS score, CAST(m AS INTEGER) AS marker, CAST(t AS INTEGER) AS term, CAST(r AS INTEGER) AS required FROM lbest", "lbest"))
def label_rule_choice(t: Tables) -> DataFrame:
    return evidence.label_rules(_label_modules(t), _label_rules(t)).select("module", "label_id", "final_label", "score", "marker", "term", "required")


_MORE["lthemes"] = (
    "SELECT p.module, theme, p.label_id = b.label_id AS own, row_number() OVER (PARTITION BY p.module, p.label_id = b.label_id ORDER BY s DESC, m DESC, t DESC, r DESC, position) AS place FROM (SELECT *, CAST(m >= 5 AS INTEGER) + CAST(t >= 2 AS INTEGER) + CAST(r >= 1 AS INTEGER) AS s FROM lpairs) p JOIN (SELECT module, label_id FROM lbest) b ON p.module = b.module "
    "WHERE CASE WHEN p.label_id = b.label_id THEN m > 0 OR t > 0 OR r > 0 ELSE s >= 2 END",
    ["lpairs", "lbest"],
)


@query(_sql("SELECT m.module, coalesce(x, 'not_available') AS themes FROM lmods m LEFT JOIN (SELECT module, string_agg(theme, '; ' ORDER BY own DESC, place) AS x FROM lthemes WHERE own OR place <= 2 GROUP BY 1) y ON m.module = y.module", "lmods", "lthemes"))
def supporting_themes(t: Tables) -> DataFrame:
    rows, book = _label_modules(t), _label_rules(t)
    best = evidence.label_rules(rows, book)
    return labels.supporting_themes(rows.join(best.select("module", "label_id"), "module"), book)


@query(_sql("SELECT label_id, fallback_label, CAST(position AS INTEGER) AS position, mp AS marker_patterns, ct AS core_term_patterns, rq AS required_specific_patterns, theme FROM lrules", "lrules"))
def label_rulebook(t: Tables) -> DataFrame:
    return _label_rules(t)


@query(_sql("SELECT module, CASE " + " ".join(f"WHEN regexp_matches(lower(term_text), '{words}') THEN '{label}'" for label, words in labels.TERM_LABELS) + " ELSE 'fallback' END AS label FROM lmods", "lmods"))
def label_from_terms(t: Tables) -> DataFrame:
    return _label_modules(t).select("module", labels.label_from_terms(F.col("term_text"), F.lit("fallback")).alias("label"))


@query(_sql("SELECT module, coalesce(list_max(list_transform(regexp_extract_all(marker_summary, '\\(([0-9]+)\\)', 1), lambda x: x::INTEGER)), 0) AS most FROM lmods", "lmods"))
def max_marker_overlap(t: Tables) -> DataFrame:
    return _label_modules(t).select("module", F.coalesce(F.array_max(evidence.marker_counts(F.col("marker_summary"))), F.lit(0)).alias("most"))


@query(_sql(f"SELECT module, CAST({_COUNT.format(p=_list(['response', 'lipid|binding', '^cell', 'absent']))} AS INTEGER) AS hits FROM lmods", "lmods"))
def pattern_hits(t: Tables) -> DataFrame:
    patterns = F.array(*map(F.lit, ["response", "lipid|binding", "^cell", "absent"]))
    return _label_modules(t).select("module", evidence.pattern_hits(F.col("term_text"), patterns).alias("hits"))


@query(_sql("SELECT id, CASE WHEN m AND t THEN 'curated_marker_overlap_plus_specific_STRING_enrichment' WHEN t THEN 'specific_STRING_enrichment_only' WHEN m THEN 'curated_marker_overlap_only' ELSE 'not_assigned' END AS source, id % 4 > 1 AS assigned FROM (SELECT id, id % 2 > 0 AS m, id % 3 > 0 AND pvalue <= 0.05 AS t FROM genes)", "genes"))
def label_sources(t: Tables) -> DataFrame:
    label = F.element_at(F.array(F.lit(""), F.lit("unassigned_module"), F.lit("a"), F.lit("b")), (F.col("id") % 4 + 1).cast("int"))
    return t.genes().select("id", evidence.label_source(F.col("id") % 2, F.col("id") % 3, F.col("pvalue")).alias("source"), evidence.assigned(label).alias("assigned"))


# ---------------------------------------------------------------- audits

_MORE["findings"] = ("SELECT CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'A' THEN 'REVIEW' ELSE 'PASS' END AS status FROM lineitem", [])


@query(_sql("SELECT s AS status, count(status) AS n FROM (SELECT unnest(['FAIL', 'REVIEW', 'INFO', 'PASS']) AS s) LEFT JOIN findings ON s = status GROUP BY 1", "findings"))
def severity_table(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return audit.severities(t.read("lineitem").select(F.when(flag == "R", F.lit("FAIL")).when(flag == "A", F.lit("REVIEW")).otherwise(F.lit("PASS")).alias("status")))


_ODD = "CASE id % 9 WHEN 0 THEN 0.0 WHEN 1 THEN 1e-305 WHEN 2 THEN 2.0 WHEN 3 THEN NULL ELSE pvalue END"


@query(_sql(f"SELECT unnest(['pvalue_present', 'pvalue_in_range', 'pvalue_zero', 'pvalue_underflow']) AS check_id, unnest([CASE WHEN a > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN b > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN c > 0 THEN 'REVIEW' ELSE 'PASS' END, CASE WHEN d > 0 THEN 'REVIEW' ELSE 'PASS' END]) AS status, unnest([a::VARCHAR, b::VARCHAR, c::VARCHAR, d::VARCHAR]) AS details FROM (SELECT count(*) FILTER (p IS NULL) AS a, count(*) FILTER (p > 1) AS b, count(*) FILTER (p = 0) AS c, count(*) FILTER (p > 0 AND p < 1e-300) AS d FROM (SELECT {_ODD} AS p FROM genes))", "genes"))
def pvalue_audit(t: Tables) -> DataFrame:
    k = F.col("id") % 9
    p = F.when(k == 0, F.lit(0.0)).when(k == 1, F.lit(1e-305)).when(k == 2, F.lit(2.0)).when(k != 3, F.col("pvalue"))
    return audit.pvalues(t.genes().select(p.alias("pvalue")))


@query(_sql(f"SELECT class AS entity_class, count(*) AS n FROM cand WHERE class <> '{C.CANONICAL}' GROUP BY 1", "cand"))
def special_entity_audit(t: Tables) -> DataFrame:
    return audit.special_entities(t.genes(), "symbol")


@query(_sql("SELECT module, count(*) FILTER (logFC > 0) AS up, count(*) FILTER (logFC < 0) AS down, (count(*) FILTER (logFC > 0) = 0) <> (count(*) FILTER (logFC < 0) = 0) AS one_sided FROM genes GROUP BY 1", "genes"))
def direction_audit(t: Tables) -> DataFrame:
    return audit.directions(t.genes(), "module")


@query(_sql("SELECT 'fdr_within_limit' AS check_id, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n::VARCHAR AS details FROM (SELECT count(*) FILTER (fdr > 0.05) AS n FROM mterms)", "mterms"))
def fdr_audit(t: Tables) -> DataFrame:
    return audit.insignificant(fixtures.module_terms(t))


@query("SELECT unnest(['technical_not_eligible', 'biological_eligible', 'unresolved_without_terms']) AS check_id, 'PASS' AS status, '0' AS details")
def module_semantics_audit(t: Tables) -> DataFrame:
    return audit.module_semantics(_decisions(t))


@query(_sql("SELECT round(1.0 - count(*) FILTER (id % 10 = 0) / (3.0 * count(*)), 9) AS identity FROM genes", "genes"))
def cell_identity(t: Tables) -> DataFrame:
    a = t.genes().select("id", "gene", "logFC", "pvalue")
    b = a.withColumn("pvalue", F.when(F.col("id") % 10 == 0, F.col("pvalue") + 0.5).otherwise(F.col("pvalue")))
    return t.spark.createDataFrame([(round(audit.cell_identity(a, b, ["id"]), 9),)], "identity double")


@query("SELECT 'nation' AS one, 'again' AS two")
def repeated_tables(t: Tables) -> DataFrame:
    n = t.read("nation")
    return t.spark.createDataFrame(audit.repeated_tables({"region": t.read("region"), "nation": n, "again": n.orderBy(F.desc("n_nationkey")), "less": n.where("n_nationkey > 1")}), "one string, two string")


@query("SELECT * FROM (VALUES ('same', 'identical'), ('other', 'different'), ('gone', 'missing'), ('more', 'extra')) v(sheet, status)")
def strict_scope(t: Tables) -> DataFrame:
    n, r = t.read("nation"), t.read("region")
    return t.spark.createDataFrame(diff.scope({"same": n, "other": n, "gone": r}, {"same": n.orderBy("n_name"), "other": n.where("n_nationkey > 0"), "more": r}), "sheet string, status string")


@query("SELECT md5(string_agg(r_regionkey || ',' || r_name, chr(10) ORDER BY r_name)) AS digest FROM region")
def ordered_table_digest(t: Tables) -> DataFrame:
    return diff.ordered_digest(t.read("region").select("r_regionkey", "r_name"), ["r_name"])


@query("SELECT 'nation' AS name, (SELECT count(*) FROM nation) AS rows, 4 AS columns, 0 AS repeated UNION ALL SELECT 'odd', (SELECT count(*) FROM region), 3, 1")
def table_inventory(t: Tables) -> DataFrame:
    odd = t.read("region").select(F.col("r_regionkey").alias("Key"), F.col("r_name").alias("r-name"), F.col("r_name").alias("R name"))
    return t.spark.createDataFrame(audit.inventory({"nation": t.read("nation").select("n_nationkey", "n_name", "n_regionkey", F.lit(1).alias("one")), "odd": odd}), "name string, rows long, columns int, repeated int")


_LOG = "SELECT CASE s_suppkey % 5 WHEN 0 THEN 'Mapped genes: ' || s_suppkey || '/' || (s_suppkey + 9) WHEN 1 THEN 'Network: ' || s_suppkey || ' nodes, 7 edges, 2 components' WHEN 2 THEN 'Error in step ' || s_suppkey WHEN 3 THEN 'Run completed' ELSE s_name END AS value, s_suppkey AS line_no FROM supplier"


def _log(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    text = lambda *x: F.concat(*(y if not isinstance(y, str) else F.lit(y) for y in x))
    n = k.cast("string")
    value = F.when(k % 5 == 0, text("Mapped genes: ", n, "/", (k + 9).cast("string"))).when(k % 5 == 1, text("Network: ", n, " nodes, 7 edges, 2 components")).when(k % 5 == 2, text("Error in step ", n)).when(k % 5 == 3, F.lit("Run completed")).otherwise(F.col("s_name"))
    return t.read("supplier").select(k.alias("line_no"), value.alias("value"))


@query(f"WITH l AS ({_LOG}) SELECT max(line_no) FILTER (line_no % 5 = 0) AS mapped, max(line_no) FILTER (line_no % 5 = 0) + 9 AS total, max(line_no) FILTER (line_no % 5 = 1) AS nodes, 7::BIGINT AS edges, 2::BIGINT AS components FROM l")
def run_log(t: Tables) -> DataFrame:
    return audit.run_log(_log(t))


@query(f"WITH l AS ({_LOG}) SELECT arg_max(value, line_no) AS last_line, count(*) FILTER (value LIKE 'Error%') AS errors, max(line_no) FILTER (value = 'Run completed') > max(line_no) FILTER (value LIKE 'Error%') AS completed FROM l")
def log_state(t: Tables) -> DataFrame:
    return audit.log_state(_log(t))


@query("SELECT count(*) + count(*) FILTER (s_suppkey % 3 = 0) AS n FROM supplier")
def xml_tags(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    line = F.concat(F.lit('<graph><node id="'), k.cast("string"), F.lit('"/>'), F.when(k % 3 == 0, F.lit("<node><nodes/></node>")).otherwise(F.lit("")))
    return audit.tags(t.read("supplier").select(line.alias("value")), "node")


@query("SELECT n_name AS path, CAST(length(c) AS BIGINT) AS size, CAST(length(c) - length(replace(c, chr(10), '')) AS BIGINT) AS lines, md5(c) AS md5, count(*) OVER (PARTITION BY c) > 1 AS repeated FROM (SELECT n_name, 'region' || chr(10) || CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey::VARCHAR ELSE n_name || chr(10) END AS c FROM nation)")
def captured_files(t: Tables) -> DataFrame:
    text = F.concat(F.lit("region\n"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey").cast("string")).otherwise(F.concat("n_name", F.lit("\n"))))
    return audit.captured(t.read("nation").select(F.col("n_name").alias("path"), text.cast("binary").alias("content")))
