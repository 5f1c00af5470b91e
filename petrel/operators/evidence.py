"""Rule evidence, technical signatures, axis selection, module decisions and label rules.

A rulebook is a DataFrame (``petrel.sources.rules`` reads one): rule_id, axis, display_label,
compartment, positive_markers, supportive_markers, exclusion_markers, term_patterns,
required_term_patterns, min_positive, min_score, marker_only_min_positive,
marker_only_min_supportive, marker_only_min_score, priority. Rules are tens and are
broadcast beside modules, which are hundreds; nothing here grows with raw inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.functions.columns import finite, trimmed
from petrel.operators.checkpoints import checkpointed

# Generic terms of the evidence rules, and marker lists of technical signatures.
GENERIC_TERMS = (
    "^signaling$|^signal transduction$|^cell communication$|^biological process$|^cellular process$|^cellular metabolic process$|"
    "^immune system process$|^immune response$|^metabolic process$|^regulation of biological process$|^response to stimulus$|"
    "^gene expression$|^transport of small molecules$|^mixed, incl\\.|^mostly uncharacterized|uncharacterized|"
    "the function of this family is unknown|family consists of several"
)
Y_LINKED = ["RPS4Y1", "EIF1AY", "KDM5D", "ZFY", "DDX3Y", "UTY", "USP9Y", "TMSB4Y", "NLGN4Y", "PRKY"]
PLASMA_CORE = ["MZB1", "JCHAIN", "TNFRSF17", "SDC1", "PRDM1", "XBP1", "DERL3"]
T_CORE = ["CD3D", "CD3E", "CD3G", "TRAC", "CD2", "CD247", "LCK"]
#: (signature, label, pattern of its genes, least genes, least share, genes of which fewer than two may be there)
SIGNATURES = [
    ("Y_chromosome_associated_signature", "Y-chromosome-associated technical/covariate signature", "^(" + "|".join(Y_LINKED) + ")$", 3, 0.30, None),
    ("mitochondrial_dominant_signature", "mitochondrial-dominant technical signature", "^MT-", 5, 0.50, None),
    ("ribosomal_translation_dominant_signature", "ribosomal/translation-dominant technical signature", "^RP[SL][0-9]", 8, 0.50, None),
    ("immunoglobulin_locus_dominant_signature", "immunoglobulin-locus-dominant technical/covariate signature", "^(IGH|IGK|IGL)", 5, 0.60, PLASMA_CORE),
    ("TCR_locus_dominant_signature", "T-cell-receptor-locus-dominant technical/covariate signature", "^TR[ABDG][CVJ]", 5, 0.60, T_CORE),
]
UNRESOLVED = "unresolved biological context"
CONFLICT_DELTA, MARKER_DELTA, SUPPORT_FLOOR = 0.08, 0.18, 0.35


def is_generic_term(description: Column) -> Column:
    d = F.coalesce(F.lower(trimmed(description)), F.lit(""))
    return (d == "") | d.rlike(GENERIC_TERMS)


def prepared_terms(enrichment: DataFrame, module: str, fdr: float = 0.05) -> DataFrame:
    """(module, source, term_id, description, fdr, supporting_genes, is_significant, is_generic)."""
    return enrichment.select(
        F.col(module).alias("module"), F.col("category").alias("source"), F.col("term").alias("term_id"), trimmed(F.col("description")).alias("description"), "fdr",
        F.col("preferred_names").alias("supporting_genes"), (finite(F.col("fdr")) & (F.col("fdr") <= fdr)).alias("is_significant"), is_generic_term(F.col("description")).alias("is_generic"),
    )


def significant_terms(terms: DataFrame) -> DataFrame:
    return terms.where(F.col("is_significant") & ~F.col("is_generic") & (F.coalesce("description", F.lit("")) != ""))


def module_genes(members: DataFrame) -> DataFrame:
    """(module, genes): distinct upper-case symbols of (module, gene)."""
    clean = members.select("module", F.upper(trimmed(F.col("gene"))).alias("gene")).where("gene <> ''").distinct()
    return clean.groupBy("module").agg(F.sort_array(F.collect_list("gene")).alias("genes"))


def _like(genes: str, pattern: str) -> Column:
    return F.filter(genes, lambda g: g.rlike(pattern))


def technical(modules: DataFrame) -> DataFrame:
    """(module, detected, signature_id, display_label, supporting_genes, evidence_fraction); the first signature that fits."""
    size = F.size("genes")
    out = modules.select("module", "genes")
    found = None
    for name, label, pattern, least, share, core in SIGNATURES:
        hits = _like("genes", pattern)
        fits = (F.size(hits) >= least) & (F.size(hits) >= share * size)
        if core is not None:
            fits &= F.size(F.array_intersect("genes", F.array(*map(F.lit, core)))) < 2
        value = F.struct(F.lit(name).alias("signature_id"), F.lit(label).alias("display_label"), hits.alias("supporting_genes"), (F.size(hits) / size).alias("evidence_fraction"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return out.withColumn("s", found).select("module", F.col("s").isNotNull().alias("detected"), "s.signature_id", "s.display_label", F.array_join(F.coalesce("s.supporting_genes", F.array().cast("array<string>")), ";").alias("supporting_genes"), F.coalesce("s.evidence_fraction", F.lit(0.0)).alias("evidence_fraction"))


def gates(pattern: Column) -> Column:
    """Literals of which a text must hold one if the lower-case pattern is to match it.

    Of each alternative the longest run of plain characters; an empty literal, which every text holds, where the
    pattern groups, repeats from none on, escapes or has classes.
    """
    plain = ~pattern.rlike(r"[?*{}\[\]()\\]")
    longest = lambda a: F.aggregate(F.split(a, r"[.^$+]+"), F.lit(""), lambda x, y: F.when(F.length(y) > F.length(x), y).otherwise(x))
    return F.when(plain, F.transform(F.split(pattern, r"\|"), longest)).otherwise(F.array(F.lit("")))


def gated(patterns: Column) -> Column:
    """(pattern, literals) of each, in lower case."""
    return F.transform(patterns, lambda p: F.struct(F.lower(p).alias("pattern"), gates(F.lower(p)).alias("literals")))


def _open(text: Column, g: Column) -> Column:
    return F.exists(g["literals"], lambda x: F.contains(text, x))


def regex_evaluations(terms: DataFrame, rules: DataFrame, patterns: str = "term_patterns") -> DataFrame:
    """(pairs, evaluated): pairs of a module's term and a rule's pattern, and those whose literals let the pattern run."""
    listed = rules.select(F.explode(gated(F.col(patterns))).alias("g"))
    both = terms.select(F.lower("description").alias("d")).crossJoin(F.broadcast(listed))  # as many as the rulebook has patterns
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.count_if(_open(F.col("d"), F.col("g"))).alias("evaluated"))


def rule_evidence(modules: DataFrame, terms: DataFrame, rules: DataFrame) -> DataFrame:
    """Every module against every rule. terms: significant ones, (module, description, ...).

    A pattern runs only on descriptions that hold one of its literals: a search for a literal costs little, while
    patterns that differ from row to row are compiled each time.
    """
    rules = rules.withColumns({"term_gates": gated(F.col("term_patterns")), "required_gates": gated(F.col("required_term_patterns"))})
    listed = terms.groupBy("module").agg(F.collect_list(F.struct("fdr", "source", "description", "term_id", "supporting_genes")).alias("terms"))
    both = modules.select("module", "genes").join(listed, "module", "left").crossJoin(F.broadcast(rules)).withColumn("terms", F.array_sort(F.coalesce("terms", F.array().cast("array<struct<fdr:double,source:string,description:string,term_id:string,supporting_genes:string>>"))))
    both = both.withColumn("lowered", F.transform("terms", lambda t: F.struct(F.lower(t["description"]).alias("d"), t.alias("t"))))
    matching = lambda patterns: F.transform(F.filter("lowered", lambda t: F.exists(patterns, lambda g: _open(t["d"], g) & F.rlike(t["d"], g["pattern"]))), lambda t: t["t"])
    hits = lambda markers: F.array_intersect("genes", F.transform(markers, lambda g: F.upper(trimmed(g))))
    out = both.withColumns({"positive": hits(F.col("positive_markers")), "supportive": hits(F.col("supportive_markers")), "exclusion": hits(F.col("exclusion_markers")), "matched": matching(F.col("term_gates")), "required": F.size(matching(F.col("required_gates")))})
    out = out.withColumns({"p": F.size("positive"), "s": F.size("supportive"), "x": F.size("exclusion"), "t": F.size("matched")})
    p, s, x, t = (F.col(c) for c in "psxt")
    one = F.lit(1.0)
    spread = F.greatest(F.lit(3.0), F.least(F.lit(8.0), F.sqrt(F.greatest(F.size("genes"), F.lit(1))) + 1))
    penalty = F.least(one, x / 2)
    score = 0.45 * F.least(one, p / F.greatest(F.lit(1), F.col("min_positive") + 1)) + 0.15 * F.least(one, s / 4) + 0.25 * F.least(one, t / 2) + 0.15 * F.least(one, (p + s) / spread) - 0.30 * penalty
    out = out.withColumns({"exclusion_penalty": penalty, "evidence_score": F.greatest(F.lit(0.0), F.least(one, score))})
    standard = (p >= F.col("min_positive")) | ((p >= 1) & (F.col("required") >= 1) & (t >= 1))
    enough = F.coalesce(p >= F.col("marker_only_min_positive"), F.lit(False)) | ((p >= F.col("min_positive")) & F.coalesce(s >= F.col("marker_only_min_supportive"), F.lit(False)))
    alone = (t == 0) & enough & (F.col("evidence_score") >= F.coalesce("marker_only_min_score", "min_score"))
    out = out.withColumns({"standard_eligible": standard, "marker_only_eligible": alone, "eligible": (standard & (F.col("evidence_score") >= F.col("min_score"))) | alone})
    term_genes = F.array_distinct(F.filter(F.flatten(F.transform("matched", lambda m: F.split(F.upper(F.coalesce(m["supporting_genes"], F.lit(""))), "[,;|/\\s]+"))), lambda g: g != ""))
    return out.select(
        "module", "rule_id", "axis", "display_label", "compartment", "priority",
        p.alias("positive_marker_count"), s.alias("supportive_marker_count"), x.alias("exclusion_marker_count"),
        t.alias("significant_term_count"), F.col("required").alias("required_term_count"),
        F.array_join("positive", ";").alias("positive_marker_genes"), F.array_join("supportive", ";").alias("supportive_marker_genes"), F.array_join("exclusion", ";").alias("exclusion_marker_genes"),
        F.array_join(F.transform("matched", lambda m: m["description"]), " | ").alias("significant_terms"),
        F.array_join(F.transform(F.filter("matched", lambda m: m["term_id"] != ""), lambda m: m["term_id"]), ";").alias("significant_term_ids"),
        F.array_join(term_genes, ";").alias("term_supporting_genes"), F.array_min(F.transform("matched", lambda m: m["fdr"])).alias("best_fdr"),
        "exclusion_penalty", "evidence_score", "standard_eligible", "marker_only_eligible", "eligible",
    )




def _by(first: str) -> list[Column]:
    return [F.desc(first), F.desc("positive_marker_count"), F.desc("significant_term_count"), F.desc("priority"), F.asc("rule_id")]


def axis_ranked(evidence: DataFrame) -> DataFrame:
    """Eligible rows with their place within module and axis; place 1 is selected."""
    return evidence.where("eligible").withColumn("place", F.row_number().over(W.partitionBy("module", "axis").orderBy(*_by("evidence_score"))))


def lineage_conflicts(evidence: DataFrame, delta: float = CONFLICT_DELTA, axis: str = "lineage") -> DataFrame:
    """(module, rule_id, other, conflict): the selected lineage and its strongest competitor, eligible or not."""
    support = F.least(F.lit(1.0), F.col("evidence_score") + 0.30 * F.col("exclusion_penalty"))
    rows = evidence.where(F.col("axis") == axis).withColumn("support", support)
    mine = axis_ranked(rows).where("place = 1").select("module", F.col("rule_id").alias("selected"), F.col("support").alias("s1"), F.col("marker_only_eligible").alias("m1"))
    rivals = rows.join(mine, "module").where((F.col("rule_id") != F.col("selected")) & (F.col("positive_marker_count") >= 2) & ((F.col("significant_term_count") >= 1) | F.col("marker_only_eligible")))
    best = rivals.withColumn("n", F.row_number().over(W.partitionBy("module").orderBy(*_by("support")))).where("n = 1")
    allowed = F.when(F.col("m1") | F.col("marker_only_eligible"), F.lit(max(delta, MARKER_DELTA))).otherwise(F.lit(delta))
    clash = (F.col("s1") >= SUPPORT_FLOOR) & (F.col("support") >= SUPPORT_FLOOR) & (F.abs(F.col("s1") - F.col("support")) <= allowed)
    found = best.select("module", F.col("rule_id").alias("other"), clash.alias("conflict"))
    return mine.select("module", F.col("selected").alias("rule_id")).join(found, "module", "left").withColumn("conflict", F.coalesce("conflict", F.lit(False)))


def secondary(evidence: DataFrame, least: float = 0.40, most: int = 3) -> DataFrame:
    """Up to three further eligible rows of each module and axis with enough score."""
    after = axis_ranked(evidence).where((F.col("place") > 1) & (F.col("evidence_score") >= least))
    return after.withColumn("n", F.row_number().over(W.partitionBy("module", "axis").orderBy("place"))).where(F.col("n") <= most).drop("n")


def confidence(selected: DataFrame) -> DataFrame:
    """(module, confidence) of selected rows with columns conflict and technical."""
    best = selected.groupBy("module").agg(F.max("evidence_score").alias("best"), F.max(F.col("positive_marker_count") >= 2).alias("marker"), F.max(F.col("significant_term_count") >= 1).alias("term"), F.max("conflict").alias("conflict"), F.max("technical").alias("technical"))
    clear = ~F.coalesce("conflict", F.lit(False))
    ladder = (
        F.when(F.col("technical"), F.lit("technical_or_covariate"))
        .when((F.col("best") >= 0.72) & F.col("marker") & F.col("term") & clear, F.lit("high"))
        .when((F.col("best") >= 0.50) & (F.col("marker") | F.col("term")) & clear, F.lit("moderate"))
        .when(F.col("best") >= 0.35, F.lit("low"))
        .otherwise(F.lit("unresolved"))
    )
    return best.select("module", ladder.alias("confidence"))


def compartments(selected: DataFrame) -> DataFrame:
    """(module, compartment): the selected lineage's, else the only one of the selected rows, else multi-compartment."""
    real = F.when((trimmed(F.col("compartment")) != "") & (F.col("compartment") != "multi-compartment"), trimmed(F.col("compartment")))
    by = selected.groupBy("module").agg(F.max(F.when(F.col("axis") == "lineage", F.col("compartment"))).alias("lineage"), F.collect_set(real).alias("others"))
    return by.select("module", F.coalesce("lineage", F.when(F.size("others") == 1, F.get("others", 0)).otherwise(F.lit("multi-compartment"))).alias("compartment"))


def annotations(modules: DataFrame, terms: DataFrame, evidence: DataFrame, signatures: DataFrame) -> DataFrame:
    """One row for each module: what its rules, significant terms and technical signature say of it together.

    evidence: rows of ``rule_evidence``; the best eligible rule of each axis is selected, and a lineage that a rival
    contests is mixed, with both as its evidence.
    """
    evidence = checkpointed(evidence)  # read by every part below
    chosen = axis_ranked(evidence).where("place = 1").withColumn("rival", F.lit(False))
    contested = None
    for axis in ("lineage", "state", "process"):
        one = lineage_conflicts(evidence, axis=axis).where("conflict").select("module", F.lit(axis).alias("c_axis"), F.col("other").alias("c_rule"))
        contested = one if contested is None else contested.union(one)
    rivals = evidence.join(contested.where("c_axis = 'lineage'").select("module", F.col("c_rule").alias("rule_id")), ["module", "rule_id"]).withColumns({"place": F.lit(1), "rival": F.lit(True)}).select(chosen.columns)
    selected = chosen.unionByName(rivals)
    of = lambda axis, c, rival=False: F.max(F.when((F.col("axis") == axis) & (F.col("rival") == rival), F.col(c)))
    genes = lambda c: F.array_join(F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list(F.split(F.upper(F.coalesce(c, F.lit(""))), "[,;|/\\s]+"))), lambda g: g != ""))), ";")
    place = F.when(F.col("axis") == "lineage", F.when(F.col("rival"), 1).otherwise(0)).when(F.col("axis") == "state", 2).otherwise(3)
    said = F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(F.coalesce("significant_terms", F.lit("")) != "", F.struct(place.alias("o"), F.col("significant_terms").alias("t"))))), lambda x: x["t"])), " | ")
    by = selected.groupBy("module").agg(
        *(of(a, "display_label").alias(f"{a}_label") for a in ("lineage", "state", "process")), *(of(a, "rule_id").alias(f"{a}_rule") for a in ("lineage", "state", "process")), of("lineage", "display_label", True).alias("rival_label"),
        genes("positive_marker_genes").alias("positive"), genes("supportive_marker_genes").alias("supportive"), genes("term_supporting_genes").alias("by_terms"), said.alias("said"), F.min("best_fdr").alias("best"),
        F.max("marker_only_eligible").alias("alone"), F.max(F.col("significant_term_count") >= 1).alias("told"),
    )
    later = secondary(evidence).where("axis <> 'lineage'").groupBy("module").agg(F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct((F.col("axis") != "state").alias("o"), "place", "display_label"))), lambda x: x["display_label"])), "; ").alias("later"))
    clash = contested.groupBy("module").agg(F.collect_set("c_axis").alias("clashes"))
    has = terms.select("module").distinct().withColumn("any_terms", F.lit(True))
    rows = modules.select("module", F.size("genes").alias("module_size")).join(by, "module", "left").join(later, "module", "left").join(clash, "module", "left").join(has, "module", "left")
    rows = rows.join(signatures.select("module", "detected", F.col("display_label").alias("signature"), F.col("supporting_genes").alias("signature_genes")), "module", "left")
    level = confidence(selected.join(clash, "module", "left").join(signatures.select("module", "detected"), "module", "left").withColumns({"conflict": F.coalesce(F.size("clashes") > 0, F.lit(False)), "technical": F.coalesce("detected", F.lit(False))}))
    rows = rows.join(level, "module", "left").join(compartments(chosen).withColumnRenamed("compartment", "where"), "module", "left")
    tech, some = F.coalesce("detected", F.lit(False)), F.col("alone").isNotNull()
    torn = lambda axis: F.coalesce(F.array_contains("clashes", axis), F.lit(False))
    conflict = torn("lineage") | torn("state") | torn("process")
    mixed = F.concat(F.lit("mixed-lineage-associated ("), "lineage_label", F.lit(" + "), "rival_label", F.lit(")"))
    # Classes, scopes, labels and warnings of modules.
    named = F.concat_ws(" / ", F.when(torn("lineage"), mixed).otherwise(F.col("lineage_label")), "state_label", "process_label")
    scope = (
        F.when(tech, F.lit("technical_or_covariate")).when(torn("lineage"), F.lit("mixed_lineage")).when(F.col("lineage_rule").isNotNull(), F.lit("lineage_supported"))
        .when(F.col("state_rule").isNotNull() & F.col("process_rule").isNotNull(), F.lit("state_and_process_supported_lineage_unresolved")).when(F.col("state_rule").isNotNull(), F.lit("state_supported_lineage_unresolved"))
        .when(F.col("process_rule").isNotNull(), F.lit("process_supported_lineage_unresolved")).otherwise(F.lit("unresolved"))
    )
    told, alone = F.coalesce("told", F.lit(False)), F.coalesce("alone", F.lit(False))
    warnings = F.array_compact(F.array(
        F.when(tech, F.lit("technical_or_covariate_signature_not_eligible_for_automatic_biological_priority")), F.when(torn("lineage"), F.lit("conflicting_lineage_evidence_label_broadened_to_mixed_lineage")),
        F.when(torn("state"), F.lit("conflicting_state_evidence")), F.when(torn("process"), F.lit("conflicting_process_evidence")), F.when(~tech & some & F.col("lineage_rule").isNull(), F.lit("lineage_not_resolved_state_or_process_evidence_only")),
        F.when(~tech & some & alone & ~told, F.lit("marker_only_interpretation_not_eligible_for_automatic_priority")), F.when(~tech & ~some, F.lit("insufficient_specific_marker_and_significant_enrichment_evidence")),
        F.when(F.col("any_terms").isNull(), F.lit("no_significant_specific_enrichment_terms_available")),
    ))
    sure = F.when(tech, F.lit("technical_or_covariate")).otherwise(F.coalesce("confidence", F.lit("unresolved")))
    text = lambda c: F.coalesce(c, F.lit(""))
    why = F.when(tech, F.concat("signature", F.lit(", borne by "), text("signature_genes"), F.lit("; not promoted by itself."))).when(some, F.concat(F.lit("Interpretation: "), named, F.lit("; markers: "), text("positive"), F.lit("; supportive: "), text("supportive"), F.lit("; terms: "), text("said"), F.lit("."))).otherwise(F.lit("No specific evidence; unresolved."))
    return rows.select(
        F.col("module").alias("community_louvain"), F.col("module").cast("string").alias("module_id"), "module_size",
        F.when(tech, F.lit("technical_or_covariate")).when(torn("lineage"), F.lit("mixed_biological")).when(some, F.lit("biological")).otherwise(F.lit("unresolved")).alias("interpretation_class"), scope.alias("interpretation_scope"),
        F.when(tech, F.lit("not_applicable")).otherwise(F.coalesce("where", F.lit("multi-compartment"))).alias("compartment"),
        F.when(tech, F.lit("not_applicable")).when(torn("lineage"), F.lit("mixed_lineage_associated")).otherwise(F.coalesce("lineage_rule", F.lit("unresolved_lineage"))).alias("lineage"),
        F.when(tech, F.lit("not_assigned")).otherwise(F.coalesce("state_rule", F.lit("not_assigned"))).alias("state"), F.when(tech, F.lit("not_assigned")).otherwise(F.coalesce("process_rule", F.lit("not_assigned"))).alias("process"),
        F.when(tech, F.col("signature")).when(some, named).otherwise(F.lit(UNRESOLVED)).alias("primary_interpretation"), text("later").alias("secondary_themes"), sure.alias("confidence"),
        (~tech & sure.isin("high", "moderate") & ~conflict & some & told).alias("priority_eligible"), text("positive").alias("positive_marker_genes"), text("supportive").alias("supportive_marker_genes"), text("by_terms").alias("term_supporting_genes"),
        text("said").alias("significant_supporting_terms"), F.col("best").alias("best_supporting_fdr"), conflict.alias("conflict_detected"), F.coalesce(F.nullif(F.array_join(warnings, "; "), F.lit("")), F.lit("no_warning")).alias("warning"), why.alias("evidence_rationale"),
    )


def module_decisions(modules: DataFrame, terms: DataFrame, signatures: DataFrame, fdr_col: str = "fdr") -> DataFrame:
    """The canonical decision: a technical signature, else the first significant terms, else unresolved.

    terms: the significant ones; ordered by rate (non-finite last), source and description.
    """
    order = F.struct((~finite(F.col(fdr_col))).alias("a"), F.col(fdr_col).alias("b"), F.col("source").alias("c"), F.col("description").alias("d"), F.col("term_id").alias("e"), F.col("supporting_genes").alias("g"))
    by = terms.groupBy("module").agg(F.sort_array(F.collect_list(order)).alias("t"), F.min(F.when(finite(F.col(fdr_col)), F.col(fdr_col))).alias("best_fdr"))
    rows = modules.select("module", F.size("genes").alias("module_size")).join(by, "module", "left").join(signatures.select("module", "detected", "display_label"), "module", "left")
    top = F.slice(F.coalesce("t", F.array().cast("array<struct<a:boolean,b:double,c:string,d:string,e:string,g:string>>")), 1, 3)
    names = F.transform(top, lambda t: t["d"])
    genes = F.array_distinct(F.filter(F.flatten(F.transform(top, lambda t: F.transform(F.split(F.coalesce(t["g"], F.lit("")), "[;,|]"), lambda g: F.upper(trimmed(g))))), lambda g: g != ""))
    tech, has = F.coalesce("detected", F.lit(False)), F.col("t").isNotNull()
    pick = lambda a, b, c: F.when(tech, a).when(has, b).otherwise(c)
    return rows.select(
        "module", "module_size",
        pick(F.col("display_label"), F.get(names, F.lit(0)), F.lit(UNRESOLVED)).alias("primary_interpretation"),
        F.array_join(F.slice(names, 2, 2), " | ").alias("secondary_interpretations"),
        pick(F.lit("technical_or_covariate"), F.lit("biological"), F.lit("unresolved")).alias("interpretation_class"),
        pick(F.lit("not_applicable"), F.lit("moderate"), F.lit("unresolved")).alias("confidence"),
        (~tech & has).alias("priority_eligible"),
        F.array_join(genes, ";").alias("term_supporting_genes"),
        "best_fdr",
        F.lit(False).alias("conflict_detected"),
    )


def marker_overlap(members: DataFrame, markers: DataFrame, most: int = 3, genes: int = 8) -> DataFrame:
    """(module, marker_summary, best_set, evidence) of the marker sets (set_name, position, gene) that overlap most."""
    own = members.select("module", F.upper(trimmed(F.col("gene"))).alias("gene")).distinct()
    hits = own.join(F.broadcast(markers), "gene").groupBy("module", "set_name").agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("n"), F.slice(F.sort_array(F.collect_list("gene")), 1, genes).alias("genes"))
    best = hits.withColumn("place", F.row_number().over(W.partitionBy("module").orderBy(F.desc("n"), "position", "set_name"))).where(F.col("place") <= most)
    text = best.groupBy("module").agg(F.sort_array(F.collect_list(F.struct("place", F.concat(F.col("set_name"), F.lit("("), F.col("n").cast("string"), F.lit(")")).alias("s"), F.array_join("genes", ",").alias("e"), "set_name"))).alias("b"))
    named = text.select("module", F.array_join(F.transform("b", lambda x: x["s"]), "; ").alias("s"), F.get("b", F.lit(0))["set_name"].alias("best_set"), F.array_join(F.transform("b", lambda x: x["e"]), " | ").alias("evidence"))
    return members.select("module").distinct().join(named, "module", "left").select("module", F.coalesce("s", F.lit("no_marker_set_match")).alias("marker_summary"), "best_set", "evidence")


def marker_counts(summary: Column) -> Column:
    """The numbers in parentheses of a marker summary."""
    return F.transform(F.regexp_extract_all(summary, F.lit("\\(([0-9]+)\\)"), F.lit(1)), lambda n: n.cast("int"))


def label_score(marker: Column, term: Column, required: Column, fdr: Column, size: Column) -> Column:
    """0 to 10 points for markers, terms, required terms, significance and size."""
    point = lambda c: F.when(F.coalesce(c, F.lit(False)), F.lit(1)).otherwise(F.lit(0))
    return point(marker >= 1) + point(marker >= 3) + point(term >= 1) + point(term >= 3) + point(required >= 1) + point(fdr <= 0.05) + point(fdr <= 0.01) + point(size >= 10) + 2 * point((marker > 0) & (term > 0))


def label_confidence(score: Column, marker: Column, term: Column, fdr: Column, assigned: Column) -> Column:
    # The confidence classes.
    strong = F.coalesce((fdr <= 0.05) & (term > 0), F.lit(False))
    return (
        F.when(~assigned, F.lit("low_unassigned_or_insufficient_evidence"))
        .when((score >= 7) & (marker > 0) & strong, F.lit("high_concordant_marker_and_specific_STRING_evidence"))
        .when((score >= 5) & strong, F.lit("medium_high_specific_STRING_evidence"))
        .when((score >= 4) & (marker > 0), F.lit("medium_marker_supported"))
        .when(score >= 2, F.lit("medium_low_limited_support"))
        .otherwise(F.lit("low_unassigned_or_insufficient_evidence"))
    )


def assigned(label: Column) -> Column:
    return F.coalesce((label != "") & (label != "unassigned_module"), F.lit(False))


def label_source(marker: Column, term: Column, fdr: Column) -> Column:
    # Where a label comes from.
    by_marker, by_term = F.coalesce(marker > 0, F.lit(False)), F.coalesce((term > 0) & (fdr <= 0.05), F.lit(False))
    return F.when(by_marker & by_term, F.lit("curated_marker_overlap_plus_specific_STRING_enrichment")).when(by_term, F.lit("specific_STRING_enrichment_only")).when(by_marker, F.lit("curated_marker_overlap_only")).otherwise(F.lit("not_assigned"))


def pattern_hits(text: Column, patterns: Column) -> Column:
    """How many of the patterns hit the lower-case text."""
    return F.size(F.filter(patterns, lambda p: F.rlike(F.lower(F.coalesce(text, F.lit(""))), p)))


def label_rules(modules: DataFrame, rules: DataFrame) -> DataFrame:
    """The best label rule of each module.

    modules: module, module_size, counts map<set, int>, term_text, best_fdr; rules: label_id, fallback_label, position,
    marker_patterns, core_term_patterns, required_specific_patterns. Patterns count once however often they hit.
    """
    text = F.lower(F.coalesce("term_text", F.lit("")))
    counting = lambda patterns: F.size(F.filter(patterns, lambda p: F.rlike(text, p)))
    markers = F.aggregate("marker_patterns", F.lit(0), lambda a, k: a + F.coalesce(F.try_element_at("counts", k), F.lit(0)))
    both = modules.crossJoin(F.broadcast(rules)).withColumns({"marker": markers, "term": counting(F.col("core_term_patterns")), "required": counting(F.col("required_specific_patterns"))})
    both = both.withColumn("score", label_score(F.col("marker"), F.col("term"), F.col("required"), F.col("best_fdr"), F.col("module_size")))
    # size and significance alone support no label
    both = both.withColumn("score", F.when((F.col("marker") == 0) & (F.col("term") == 0) & (F.col("required") == 0), F.lit(0)).otherwise(F.col("score")))
    best = both.withColumn("n", F.row_number().over(W.partitionBy("module").orderBy(F.desc("score"), F.desc("marker"), F.desc("term"), F.desc("required"), "position"))).where("n = 1")
    specific = (F.col("required") > 0) | (F.col("marker") >= 3)
    label = F.when(F.col("score") < 2, F.lit("unassigned_module")).when(specific, F.col("label_id")).otherwise(F.col("fallback_label"))
    out = best.withColumn("final_label", label)
    return out.select("module", "final_label", "label_id", "score", "marker", "term", "required", label_confidence(F.col("score"), F.col("marker"), F.col("term"), F.col("best_fdr"), F.col("final_label") != "unassigned_module").alias("confidence"))


def validation(annotations: DataFrame, members: DataFrame) -> DataFrame:
    """(check_id, status): the bundle's invariants."""
    a = annotations.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("module").alias("ids"), F.count_if(F.coalesce(F.col("primary_interpretation"), F.lit("")) == "").alias("blank"), F.count_if(F.col("priority_eligible") & (F.col("interpretation_class") != "biological")).alias("wrong"), F.count_if(F.col("conflict_detected")).alias("conflicts"))
    lost = members.join(annotations, "module", "left_anti").agg(F.count(F.lit(1)).alias("lost"))
    one = a.join(F.broadcast(lost))
    checks = {"module_ids_unique": F.col("rows") == F.col("ids"), "interpretations_present": F.col("blank") == 0, "eligibility_consistent": F.col("wrong") == 0, "nodes_annotated": F.col("lost") == 0, "conflicts_absent": F.col("conflicts") == 0}
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check_id"), F.when(v, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status")) for k, v in checks.items()))).alias("c")).select("c.*")


def require_passed(checks: DataFrame, context: str) -> None:
    failed = [r["check_id"] for r in checks.where("status = 'FAIL'").limit(20).collect()]
    if failed:
        raise ValueError(f"{context}: failed checks: {', '.join(failed)}")
