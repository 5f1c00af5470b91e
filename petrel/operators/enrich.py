"""Over-representation of terms in many queries at once, and the tables made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.functions.columns import finite, first_distinct, trimmed, truncated
from petrel.functions.stats import benjamini_hochberg, hypergeometric_tail

LEAST_HITS, LEAST_TERM, MOST_TERM, LEAST_BACKGROUND = 2, 3, 500, 10
FDR = 0.05

# Categories in order of preference, secondary ones, and words that make a term specific or generic.
PREFERRED = ["Biological Process (Gene Ontology)", "Reactome Pathways", "WikiPathways", "KEGG Pathways", "Local Network Cluster (STRING)", "Annotated Keywords (UniProt)", "Molecular Function (Gene Ontology)", "Cellular Component (Gene Ontology)"]
SECONDARY = ["Human Phenotype (Monarch)", "Tissue expression (TISSUES)", "Disease-gene associations (DISEASES)", "Subcellular localization (COMPARTMENTS)", "Protein Domains and Features (InterPro)", "Protein Domains (SMART)", "Protein Domains (Pfam)"]
SPECIFIC = (
    "immune|immun|leukocyte|lymphocyte|myeloid|macrophage|monocyte|neutrophil|t cell|b cell|natural killer|cytotoxic|"
    "antigen|mhc|major histocompatibility|hla|peptide presentation|chemokine|cytokine|interferon|interleukin|tnf|chemotaxis|"
    "migration|complement|c1q|fc receptor|phagocyt|extracellular matrix|ecm|collagen|matrix organization|stromal|"
    "focal adhesion|angiogenesis|endothelial|vascular|cell cycle|mitotic|mitosis|chromosome segregation|dna replication|"
    "lipid|fatty acid|cholesterol|oxidative phosphorylation|respiratory chain|apoptosis|inflammasome|antiviral"
)
GENERIC = [
    "signaling", "signal transduction", "cell communication", "cellular response to stimulus", "response to stimulus",
    "response to stress", "biological regulation", "regulation of biological process", "regulation of molecular function",
    "regulation of cellular process", "cellular process", "metabolic process", "organic substance metabolic process",
    "primary metabolic process", "cellular metabolic process", "localization", "binding", "protein binding",
    "catalytic activity", "molecular function", "cellular anatomical entity", "intracellular anatomical structure",
    "cellular component", "anatomical structure development", "developmental process",
]


def enriched(terms: DataFrame, queries: DataFrame, background: DataFrame, names: DataFrame | None = None, least_hits: int = LEAST_HITS, least_term: int = LEAST_TERM, most_term: int = MOST_TERM, least_background: int = LEAST_BACKGROUND) -> DataFrame:
    """Every term of every query with its hits, p-value and false-discovery rate.

    terms: id, category, term, description; queries: query_name, id; background: id, and query_name if it differs by
    query. Sizes count annotated members only. Adjustment covers all terms of a query within the size bounds, before
    those with too few hits go.
    """
    per_query = "query_name" in background.columns
    universe = background.select(*(["query_name"] if per_query else []), "id").distinct()
    term_map = terms.select("id", "category", "term", "description").distinct()
    on = ["query_name", "id"] if per_query else ["id"]
    # every side but one-row ones grows with the input, and a file's size tells too little of it: none is broadcast
    members = universe.join(term_map.hint("merge"), "id")
    annotated = members.select(*on).distinct()
    query = queries.select("query_name", "id").distinct().join(annotated.hint("merge"), on, "left_semi")
    term = ["category", "term", "description"]
    by = ["query_name"] if per_query else []
    population = annotated.groupBy(*by).agg(F.count(F.lit(1)).alias("background_size"))
    sizes = members.groupBy(*by, *term).agg(F.count(F.lit(1)).alias("number_of_genes_in_background")).where(F.col("number_of_genes_in_background").between(least_term, most_term))
    drawn = query.groupBy("query_name").agg(F.count(F.lit(1)).alias("query_size")).where("query_size >= 2")
    # terms out of bounds go before members are listed
    size = "number_of_genes_in_background"
    pairs = query.join(term_map.hint("merge"), "id").join(sizes.hint("merge"), [*by, *term]) if by else query.join(term_map.join(sizes.hint("merge"), term).hint("merge"), "id")
    hits = pairs.groupBy("query_name", *term, size).agg(F.count(F.lit(1)).alias("number_of_genes"), F.sort_array(F.collect_list("id")).alias("ids"))
    # a term that a query doesn't hit has p = 1: it counts as a test and needs no row, so queries are never crossed with terms
    n_tests = sizes.groupBy(*by).agg(F.count(F.lit(1)).alias("n_tests"))
    tests = hits.join(drawn.hint("merge"), "query_name")
    tests = tests.join(population.hint("merge"), by).join(n_tests.hint("merge"), by) if by else tests.join(F.broadcast(population)).join(F.broadcast(n_tests))  # one row each
    tests = tests.where(F.col("background_size") >= least_background)
    p = hypergeometric_tail("number_of_genes", "number_of_genes_in_background", "background_size", "query_size")
    tested = tests.withColumn("pvalue", p)
    adjusted = benjamini_hochberg(F.col("pvalue"), ["query_name"], [F.col(c) for c in term], F.col("n_tests"))
    out = tested.withColumn("fdr", adjusted).where(F.col("number_of_genes") >= least_hits).drop("n_tests")
    if names is not None:
        listed = out.select("query_name", *term, F.explode("ids").alias("id")).join(names.select("id", "gene").hint("merge"), "id", "left").groupBy("query_name", *term).agg(F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("gene", "id").alias("g")))), lambda x: x["g"])), ";").alias("preferred_names"))
        out = out.join(listed.hint("merge"), ["query_name", *term])
    else:
        out = out.withColumn("preferred_names", F.array_join("ids", ";"))
    return out.withColumn("protein_ids", F.array_join("ids", ";")).drop("ids")


def is_generic(description: Column) -> Column:
    d = F.coalesce(F.lower(trimmed(description)), F.lit(""))
    vague = d.rlike("^(positive |negative )?regulation of |^response to ") & ~d.rlike(SPECIFIC)
    return d.isin(GENERIC) | vague


def prioritised(rows: DataFrame) -> DataFrame:
    lowered = F.lower("description")
    order = F.array_position(F.array(*map(F.lit, PREFERRED)), F.col("category"))
    return rows.withColumns({
        "category_priority": F.when(order > 0, order).otherwise(F.lit(99)).cast("int"),
        "is_preferred_category": F.col("category").isin(PREFERRED),
        "is_secondary_category": F.col("category").isin(SECONDARY),
        "is_generic_term": is_generic(F.col("description")),
        "has_specific_keyword": F.coalesce(lowered.rlike(SPECIFIC), F.lit(False)),
        "is_significant_fdr": finite(F.col("fdr")) & (F.col("fdr") <= FDR),
    }).withColumn("is_specific_interpretable", F.col("is_preferred_category") & ~F.col("is_generic_term") & F.col("has_specific_keyword"))


def _note() -> Column:
    # The notes.
    return (
        F.when(F.col("is_specific_interpretable"), F.lit("specific_interpretable_term_used_in_report"))
        .when(F.col("is_generic_term"), F.lit("generic_term_retained_for_audit_only"))
        .when(F.col("is_secondary_category"), F.lit("secondary_category_retained_for_audit_only"))
        .otherwise(F.lit("not_primary_for_human_report"))
    )


def selected(rows: DataFrame, groups: list[str], n: int = 10, specific_only: bool = True) -> DataFrame:
    """The best n terms of each group; if any term at all is specific, only such ones."""
    out = prioritised(rows)
    if specific_only:
        any_specific = out.agg(F.coalesce(F.max("is_specific_interpretable"), F.lit(False)).alias("any__"))
        out = out.join(F.broadcast(any_specific)).where(~F.col("any__") | F.col("is_specific_interpretable")).drop("any__")
    order = W.partitionBy(*groups).orderBy("category_priority", F.col("fdr").asc_nulls_last(), F.col("pvalue").asc_nulls_last(), "category", "term", "description")
    best = out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    return best.withColumns({"preferred_names": truncated(F.col("preferred_names"), 350), "description": truncated(F.col("description"), 250), "term_filter_note": _note()}).select(*groups, "place", "category", "term", "description", "term_filter_note", "number_of_genes", "number_of_genes_in_background", "pvalue", "fdr", "preferred_names")


def collapsed(rows: DataFrame, group: str, n: int = 6) -> DataFrame:
    """One row for each group: its first terms, and those that are specific and significant."""
    out = prioritised(rows)
    order = [F.col("category_priority"), F.col("fdr"), F.col("pvalue"), F.col("term")]
    raw = out.groupBy(group).agg(first_distinct(F.col("description"), order, n).alias("top_raw_terms"), F.count(F.lit(1)).alias("total_enrichment_terms"))
    good = out.where("is_specific_interpretable and is_significant_fdr").groupBy(group).agg(
        first_distinct(F.col("description"), order, n).alias("top_interpretable_terms"),
        first_distinct(F.col("category"), order, n).alias("top_interpretable_sources"),
        F.min("fdr").alias("best_interpretable_fdr"),
        truncated(first_distinct(F.col("preferred_names"), order, 3, " | "), 700).alias("enrichment_support_genes"),
        F.count(F.lit(1)).alias("specific_interpretable_terms_n"),
    )
    joined = raw.join(good, group, "left")
    return joined.withColumn("specific_interpretable_terms_n", F.coalesce("specific_interpretable_terms_n", F.lit(0)))


def top_terms(rows: DataFrame, group: str, n: int = 3) -> DataFrame:
    order = [F.col("fdr"), F.col("pvalue"), F.col("term")]
    return rows.groupBy(group).agg(first_distinct(F.col("description"), order, n).alias("top_terms"), first_distinct(F.col("category"), order, n).alias("top_categories"), F.min("pvalue").alias("best_pvalue"), F.min("fdr").alias("best_fdr"))
