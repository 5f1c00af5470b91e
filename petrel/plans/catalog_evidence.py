"""The registered queries of evidence, reports, sinks and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from petrel.functions import columns as C
from petrel.operators import diff, evidence, graph, report
from petrel.operators.checkpoints import checkpointed
from petrel.plans import fixtures
from petrel.plans.catalog import _MORE, _candidates, _r, _sql, query
from petrel.plans.fixtures import THRESHOLD, Tables
from petrel.sources import contract, sinks

_G = evidence.GENERIC_TERMS
_MORE["sig"] = (f"SELECT * FROM mterms WHERE fdr <= 0.05 AND NOT regexp_matches(lower(description), '{_G}')", ["mterms"])
_HIT = "len(list_filter(ts, lambda t: len(list_filter({p}, lambda p: regexp_matches(lower(t.description), lower(p)))) > 0))"
_MORE["counted"] = (
    "SELECT module, rule_id, axis, display_label, compartment, priority, len(genes) AS g, mo_pos, mo_sup, "
    "len(list_intersect(genes, coalesce(pos, []))) AS p, len(list_intersect(genes, coalesce(sup, []))) AS s, len(list_intersect(genes, coalesce(exc, []))) AS x, "
    f"{_HIT.format(p='pats')} AS t, {_HIT.format(p='req')} AS r FROM (SELECT m.module, genes, coalesce(ts, []) AS ts FROM members m LEFT JOIN (SELECT module, list({{'description': description}}) AS ts FROM sig GROUP BY 1) q ON q.module = m.module) CROSS JOIN rules",
    ["members", "rules", "sig"],
)
_MORE["rscored"] = (
    "SELECT *, least(1.0, x / 2) AS e, greatest(0.0, least(1.0, 0.45 * least(1.0, p / 2) + 0.15 * least(1.0, s / 4) + 0.25 * least(1.0, t / 2) + 0.15 * least(1.0, (p + s) / greatest(3.0, least(8.0, sqrt(greatest(1, g)) + 1))) - 0.30 * least(1.0, x / 2))) AS sc FROM counted",
    ["counted"],
)
_MORE["evid"] = (
    "SELECT *, std, mo, (std AND sc >= 0.2) OR mo AS eligible FROM (SELECT *, p >= 1 OR (p >= 1 AND r >= 1 AND t >= 1) AS std, t = 0 AND (coalesce(p >= mo_pos, false) OR (p >= 1 AND coalesce(s >= mo_sup, false))) AND sc >= 0.2 AS mo FROM rscored)",
    ["rscored"],
)
_MORE["picked"] = ("SELECT *, row_number() OVER (PARTITION BY module, axis ORDER BY round(sc, 9) DESC, p DESC, t DESC, priority DESC, rule_id) AS place FROM evid WHERE eligible", ["evid"])


def _modules(t: Tables) -> DataFrame:
    return evidence.module_genes(fixtures.members(t))


def _significant(t: Tables) -> DataFrame:
    return evidence.significant_terms(evidence.prepared_terms(fixtures.module_terms(t), "module"))


def _evidence(t: Tables) -> DataFrame:
    out = evidence.rule_evidence(_modules(t), _significant(t), fixtures.rulebook(t))
    return out.withColumn("evidence_score", F.round("evidence_score", 9))


@query(_sql("SELECT module, source, term_id, description, fdr FROM sig", "sig"))
def significant_specific_terms(t: Tables) -> DataFrame:
    return _significant(t).select("module", "source", "term_id", "description", "fdr")


@query(_sql("SELECT module, rule_id, p AS positive_marker_count, s AS supportive_marker_count, x AS exclusion_marker_count, t AS significant_term_count, r AS required_term_count, round(sc, 9) AS evidence_score, std AS standard_eligible, mo AS marker_only_eligible, eligible FROM evid", "evid"))
def rule_cross_eval(t: Tables) -> DataFrame:
    return _evidence(t).select("module", "rule_id", "positive_marker_count", "supportive_marker_count", "exclusion_marker_count", "significant_term_count", "required_term_count", "evidence_score", "standard_eligible", "marker_only_eligible", "eligible")


@query(_sql("SELECT count(*) AS pairs, count(*) FILTER (contains(lower(description), lower(p))) AS evaluated FROM sig, (SELECT unnest(pats) AS p FROM rules)", "sig", "rules"))
def rule_pattern_gates(t: Tables) -> DataFrame:
    """Pairs of a term and a rule's pattern, and how many of them a literal lets through to the pattern."""
    return evidence.regex_evaluations(_significant(t), fixtures.rulebook(t))


@query(_sql("SELECT module, axis, rule_id, CAST(place AS INTEGER) AS place FROM picked", "picked"))
def axis_selection(t: Tables) -> DataFrame:
    return evidence.axis_ranked(_evidence(t)).select("module", "axis", "rule_id", "place")


_MORE["rivals"] = (
    "SELECT m.module, m.rule_id, o.rule_id AS other, least(1.0, round(m.sc, 9) + 0.3 * m.e) AS s1, least(1.0, round(o.sc, 9) + 0.3 * o.e) AS s2, m.mo OR o.mo AS anymo, row_number() OVER (PARTITION BY m.module ORDER BY least(1.0, round(o.sc, 9) + 0.3 * o.e) DESC, o.p DESC, o.t DESC, o.priority DESC, o.rule_id) AS place2 "
    "FROM picked m JOIN evid o ON o.module = m.module AND o.axis = 'lineage' AND o.rule_id <> m.rule_id AND o.p >= 2 AND (o.t >= 1 OR o.mo) WHERE m.axis = 'lineage' AND m.place = 1",
    ["picked", "evid"],
)


@query(_sql("SELECT m.module, m.rule_id, r.other, coalesce(s1 >= 0.35 AND s2 >= 0.35 AND abs(s1 - s2) <= CASE WHEN anymo THEN 0.18 ELSE 0.08 END, false) AS conflict FROM picked m LEFT JOIN (SELECT * FROM rivals WHERE place2 = 1) r ON r.module = m.module WHERE m.axis = 'lineage' AND m.place = 1", "picked", "rivals"))
def lineage_conflicts(t: Tables) -> DataFrame:
    return evidence.lineage_conflicts(_evidence(t))


@query(_sql("SELECT module, axis, rule_id FROM (SELECT *, row_number() OVER (PARTITION BY module, axis ORDER BY place) AS k2 FROM picked WHERE place > 1 AND round(sc, 9) >= 0.2) WHERE k2 <= 3", "picked"))
def secondary_evidence(t: Tables) -> DataFrame:
    return evidence.secondary(_evidence(t), least=0.2).select("module", "axis", "rule_id")


@query(_sql("SELECT module, CASE WHEN b >= 0.72 AND mk AND tm THEN 'high' WHEN b >= 0.5 AND (mk OR tm) THEN 'moderate' WHEN b >= 0.35 THEN 'low' ELSE 'unresolved' END AS confidence FROM (SELECT module, max(round(sc, 9)) AS b, bool_or(p >= 2) AS mk, bool_or(t >= 1) AS tm FROM picked WHERE place = 1 GROUP BY 1)", "picked"))
def evidence_confidence(t: Tables) -> DataFrame:
    chosen = evidence.axis_ranked(_evidence(t)).where("place = 1").withColumns({"conflict": F.lit(False), "technical": F.lit(False)})
    return evidence.confidence(chosen)


@query(_sql("SELECT module, coalesce(max(compartment) FILTER (axis = 'lineage'), CASE WHEN count(DISTINCT compartment) = 1 THEN min(compartment) ELSE 'multi-compartment' END) AS compartment FROM picked WHERE place = 1 GROUP BY 1", "picked"))
def selected_compartment(t: Tables) -> DataFrame:
    return evidence.compartments(evidence.axis_ranked(_evidence(t)).where("place = 1"))


_SIGNATURE = "CASE " + " ".join(f"WHEN h{i} >= {least} AND h{i} >= {share} * size" + (f" AND len(list_intersect(genes, {core!r})) < 2" if core else "") + f" THEN '{name}'" for i, (name, _, _, least, share, core) in enumerate(evidence.SIGNATURES)) + " END"
_HITS = ", ".join(f"len(list_filter(genes, lambda g: regexp_matches(g, '{p}'))) AS h{i}" for i, (_, _, p, *_) in enumerate(evidence.SIGNATURES))
#: Modules by symbol prefix have signatures; those by nation have none.
_MORE["prefixed"] = ("SELECT CAST(id % 16 AS INTEGER) AS module, list_sort(list(DISTINCT upper(symbol))) AS genes, len(list(DISTINCT symbol)) AS size FROM genes GROUP BY 1", ["genes"])


def _by_prefix(t: Tables) -> DataFrame:
    return evidence.module_genes(t.genes().select((F.col("id") % 16).cast("int").alias("module"), F.col("symbol").alias("gene")))


@query(_sql(f"SELECT module, s IS NOT NULL AS detected, s AS signature_id FROM (SELECT module, {_SIGNATURE} AS s FROM (SELECT *, {_HITS} FROM prefixed))", "prefixed"))
def technical_signature(t: Tables) -> DataFrame:
    return evidence.technical(_by_prefix(t)).select("module", "detected", "signature_id")


_MORE["decided"] = (
    "SELECT m.module, len(genes) AS module_size, coalesce(ds[1], 'unresolved biological context') AS primary_interpretation, array_to_string(ds[2:3], ' | ') AS secondary_interpretations, CASE WHEN ds IS NULL THEN 'unresolved' ELSE 'biological' END AS interpretation_class, ds IS NOT NULL AS priority_eligible, best_fdr "
    "FROM members m LEFT JOIN (SELECT module, list(description ORDER BY fdr, source, description, term_id) AS ds, min(fdr) AS best_fdr FROM sig GROUP BY 1) q ON q.module = m.module",
    ["members", "sig"],
)


def _decisions(t: Tables) -> DataFrame:
    return evidence.module_decisions(_modules(t), _significant(t), evidence.technical(_modules(t)))


@query(_sql("SELECT module, module_size, primary_interpretation, coalesce(secondary_interpretations, '') AS secondary_interpretations, interpretation_class, priority_eligible, best_fdr FROM decided", "decided"))
def module_decision(t: Tables) -> DataFrame:
    return _decisions(t).select("module", "module_size", "primary_interpretation", "secondary_interpretations", "interpretation_class", "priority_eligible", "best_fdr")


_SETS = {"even": 2, "third": 3, "fifth": 5}
_MORE["marked"] = ("SELECT module, set_name, position, count(*) AS c FROM (SELECT DISTINCT module, id FROM genes) JOIN (VALUES " + ", ".join(f"('{k}', {i}, {v})" for i, (k, v) in enumerate(_SETS.items())) + ") v(set_name, position, m) ON id % m = 0 AND id < 60 GROUP BY 1, 2, 3", ["genes"])


def _marker_sets(t: Tables) -> DataFrame:
    g = t.genes().where("id < 60").select("id", F.upper("symbol").alias("gene"))
    sets = F.explode(F.array(*(F.struct(F.lit(k).alias("set_name"), F.lit(i).alias("position"), F.lit(v).alias("m")) for i, (k, v) in enumerate(_SETS.items()))))
    return g.select("id", "gene", sets.alias("s")).where(F.col("id") % F.col("s.m") == 0).select("s.set_name", "s.position", "gene")


@query(_sql("SELECT module, coalesce(ms, 'no_marker_set_match') AS marker_summary FROM members LEFT JOIN (SELECT module, string_agg(set_name || '(' || c || ')', '; ' ORDER BY c DESC, position) AS ms FROM marked GROUP BY 1) USING (module)", "members", "marked"))
def marker_overlap(t: Tables) -> DataFrame:
    return evidence.marker_overlap(fixtures.members(t), _marker_sets(t)).select("module", "marker_summary")


@query(_sql("SELECT module, coalesce(max(c), 0) AS most FROM members LEFT JOIN marked USING (module) GROUP BY 1", "members", "marked"))
def marker_counts(t: Tables) -> DataFrame:
    rows = evidence.marker_overlap(fixtures.members(t), _marker_sets(t))
    return rows.select("module", F.coalesce(F.array_max(evidence.marker_counts(F.col("marker_summary"))), F.lit(0)).cast("long").alias("most"))


@query(_sql("SELECT id, CAST(m >= 1 AS INTEGER) + CAST(m >= 3 AS INTEGER) + CAST(degree >= 1 AS INTEGER) + CAST(degree >= 3 AS INTEGER) + CAST(pvalue <= 0.05 AS INTEGER) + CAST(pvalue <= 0.01 AS INTEGER) + CAST(degree >= 10 AS INTEGER) + CASE WHEN m > 0 AND degree > 0 THEN 2 ELSE 0 END AS points FROM (SELECT id, id % 5 AS m, degree, pvalue FROM nodes)", "nodes"))
def label_evidence_score(t: Tables) -> DataFrame:
    m = F.col("id") % 5
    return t.nodes().select("id", evidence.label_score(m, F.col("degree"), F.lit(0), F.col("pvalue"), F.col("degree")).alias("points"))


# ---------------------------------------------------------------- reports

_MORE["full"] = ("SELECT c.*, interpretation_class, priority_eligible FROM candidates c JOIN decided d ON d.module = c.module", ["candidates", "decided"])
_MORE["final"] = ("SELECT *, row_number() OVER (ORDER BY candidate_rank) AS priority_rank FROM full_ WHERE eligibility = 'review_ready_canonical' AND interpretation_class = 'biological' AND priority_eligible ORDER BY candidate_rank LIMIT 10", ["full_"])
_MORE["full_"] = _MORE.pop("full")


def _full(t: Tables, decisions: DataFrame | None = None) -> DataFrame:
    return _candidates(t).join((decisions or _decisions(t)).select("module", "interpretation_class", "priority_eligible", "conflict_detected"), "module")


@query(_sql("SELECT CAST(priority_rank AS INTEGER) AS priority_rank, id, gene, candidate_rank FROM final", "final"))
def final_priorities(t: Tables) -> DataFrame:
    return report.final_priorities(_full(t)).select("priority_rank", "id", "gene", "candidate_rank")


@query(_sql("SELECT module, max(description) FILTER (pl = 1) AS primary_description, max(term_id) FILTER (pl = 1) AS primary_term_id, coalesce(string_agg(description, ' | ' ORDER BY pl) FILTER (pl > 1), 'not_available') AS secondary_terms FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY fdr, source, description, term_id) AS pl FROM sig) WHERE pl <= 3 GROUP BY 1", "sig"))
def term_dedupe_top3(t: Tables) -> DataFrame:
    terms = _significant(t)
    return report.module_terms(terms.union(terms)).select("module", "primary_description", "primary_term_id", "secondary_terms")


@query(_sql("SELECT CAST(row_number() OVER (ORDER BY module_size DESC, best_fdr, module) AS INTEGER) AS module_priority_rank, module, module_size, round_even(module_size / (SELECT count(*) FROM vertices), 4) AS network_fraction, primary_interpretation AS module_interpretation FROM decided WHERE priority_eligible ORDER BY module_size DESC, best_fdr, module LIMIT 5", "decided", "vertices"))
def module_priorities(t: Tables) -> DataFrame:
    return report.module_priorities(_decisions(t), _significant(t), t.vertices().count()).select("module_priority_rank", "module", "module_size", "network_fraction", "module_interpretation")


@query(_sql("SELECT id, candidate_rank, CASE WHEN id IN (SELECT id FROM final) THEN 'final_priority' WHEN eligibility = 'review_ready_canonical' THEN 'extended_review_ready' ELSE eligibility END AS priority_status FROM full_ WHERE candidate_rank <= 30 OR id IN (SELECT id FROM final)", "full_", "final"))
def candidate_evidence(t: Tables) -> DataFrame:
    rows = _full(t)
    return report.candidate_evidence(rows, report.final_priorities(rows)).select("id", "candidate_rank", "priority_status")


@query(_sql("SELECT CAST(row_number() OVER (ORDER BY su DESC, be, round(candidate_score, 9) DESC, gene, id) AS INTEGER) AS rank, id, su AS support, be AS best_rank FROM (SELECT *, CAST(degree_rank <= 10 AS INTEGER) + CAST(betweenness_rank <= 10 AS INTEGER) + CAST(stress_rank <= 10 AS INTEGER) AS su, least(degree_rank, betweenness_rank, stress_rank) AS be FROM cand) WHERE su > 0", "cand"))
def topological_hubs(t: Tables) -> DataFrame:
    return report.hubs(_candidates(t)).select("rank", "id", "support", "best_rank")


@query(
    _sql(
        "SELECT 'network_metric' AS section, 'nodes' AS item, count(*)::DOUBLE AS value FROM vertices UNION ALL SELECT 'network_metric', 'edges', count(*) FROM edges UNION ALL SELECT 'topological_hub', gene, round(candidate_score, 9) FROM cand WHERE least(degree_rank, betweenness_rank, stress_rank) <= 10 UNION ALL SELECT 'degree_distribution', 'degree_' || degree, count(*) FROM degrees WHERE degree > 0 GROUP BY degree",
        "vertices", "edges", "cand", "degrees",
    )
)
def network_overview(t: Tables) -> DataFrame:
    v, e = t.graph()
    one = lambda i, name, df: df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit(i).alias("position"), F.lit(name).alias("metric"), "value")
    summary = one(0, "nodes", v).union(one(1, "edges", e))
    return report.network_overview(summary, _candidates(t), graph.degree_histogram(graph.degrees(v, e))).select("section", "item", "value")


@query(_sql("SELECT * FROM (SELECT 0 AS position, 'network_nodes' AS item, count(*)::DOUBLE AS value FROM vertices UNION ALL SELECT 1, 'network_edges', count(*) FROM edges UNION ALL SELECT 2, 'priority_eligible_modules', count(*) FROM decided WHERE priority_eligible UNION ALL SELECT 3, 'unresolved_modules', count(*) FROM decided WHERE interpretation_class = 'unresolved' UNION ALL SELECT 4, 'final_priority_candidates', count(*) FROM final)", "vertices", "edges", "decided", "final"))
def executive_summary(t: Tables) -> DataFrame:
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    v, e = t.graph()
    d = checkpointed(_decisions(t))
    return report.executive_summary({"network_nodes": n(v), "network_edges": n(e), "priority_eligible_modules": n(d.where("priority_eligible")), "unresolved_modules": n(d.where("interpretation_class = 'unresolved'")), "final_priority_candidates": n(report.final_priorities(_full(t, d)))})


@query(_sql("SELECT id, CASE WHEN eligibility = 'review_ready_canonical' AND id % 7 > 0 THEN 'no_warning' ELSE array_to_string(list_filter([CASE WHEN id % 7 = 0 THEN 'low_support' END, CASE WHEN eligibility <> 'review_ready_canonical' THEN 'candidate_eligibility=' || eligibility END], lambda x: x IS NOT NULL), '; ') END AS warning FROM candidates", "candidates"))
def candidate_warnings(t: Tables) -> DataFrame:
    own = F.when(F.col("id") % 7 == 0, F.lit("low_support")).otherwise(F.lit("no_warning"))
    return _candidates(t).select("id", report.warning(own, F.col("eligibility"), F.lit(False)).alias("warning"))


# ---------------------------------------------------------------- sinks and audits


@query(_sql("SELECT id, greatest(p, 1e-300) AS exported, p < 1e-300 AS floored FROM (SELECT id, CASE WHEN id % 10 = 0 THEN 0.0 ELSE pvalue END AS p FROM genes)", "genes"))
def graphml_pvalue_floor(t: Tables) -> DataFrame:
    rows = t.genes().select("id", F.when(F.col("id") % 10 == 0, F.lit(0.0)).otherwise(F.col("pvalue")).alias("p"))
    return rows.select("id", sinks.exported_pvalue(F.col("p")).alias("exported"), (F.col("p") < sinks.LEAST_EXPORTED).alias("floored"))


_COLUMNS = ["gene", "logFC", "pvalue"]


@query(_sql("SELECT * FROM (VALUES ('gene', (SELECT count(*) FROM genes), 0), ('logFC', (SELECT count(*) FROM genes), 0), ('pvalue', (SELECT count(*) FROM genes), (SELECT count(*) FROM genes WHERE id % 10 = 0)), ('<rows missing>', (SELECT count(*) FROM genes), 0), ('<rows extra>', (SELECT count(*) FROM genes), 0)) v(\"column\", compared, different)", "genes"))
def frame_diff(t: Tables) -> DataFrame:
    a = t.genes().select("id", *_COLUMNS)
    b = a.withColumn("logFC", F.col("logFC") + 1e-14).withColumn("pvalue", F.when(F.col("id") % 10 == 0, F.col("pvalue") + 0.5).otherwise(F.col("pvalue")))
    return diff.compare_frames(a, b, ["id"])


@query("SELECT 'l_orderkey' AS one, 'copy' AS two")
def equivalent_columns(t: Tables) -> DataFrame:
    rows = t.read("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_orderkey").alias("copy"))
    return diff.equivalent_columns(rows)


@query("SELECT l_suppkey, l_linenumber, l_returnflag, count(*) AS copies FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_rows(t: Tables) -> DataFrame:
    return diff.duplicate_rows(t.read("lineitem").select("l_suppkey", "l_linenumber", "l_returnflag"))


@query(_sql("SELECT 'empty_gene' AS rule, (SELECT count(*) FROM genes WHERE id % 20 = 0) AS rows_failing UNION ALL SELECT 'logFC_not_finite', (SELECT count(*) FROM genes WHERE id % 20 = 1) UNION ALL SELECT 'pvalue_not_finite', (SELECT count(*) FROM genes WHERE id % 20 = 2) UNION ALL SELECT 'pvalue_out_of_range', (SELECT count(*) FROM genes WHERE id % 20 = 3) UNION ALL SELECT 'duplicate_gene', (SELECT count(*) FROM genes WHERE id % 20 = 4) + 1", "genes"))
def input_contract_violations(t: Tables) -> DataFrame:
    kind = F.col("id") % 20
    rows = t.genes().select(
        "input_row",
        F.when(kind == 0, F.lit(" ")).when(kind == 4, F.lit("Twin")).when(F.col("id") == 5, F.lit("tWIN")).otherwise(F.col("gene")).alias("gene"),
        F.when(kind == 1, F.lit("x")).otherwise(F.replace(F.col("logFC").cast("string"), F.lit("."), F.lit(","))).alias("logFC"),
        F.when(kind == 2, F.lit("NA")).when(kind == 3, F.lit("1.5")).otherwise(F.col("pvalue").cast("string")).alias("pvalue"),
    )
    return contract.violations(contract.typed(rows))
