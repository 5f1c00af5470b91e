"""Marker sets and label rules of the module labels, and themes that support a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Marker sets, in order.
MARKERS = {
    "antigen_presentation": ["HLA-DRA", "HLA-DRB1", "HLA-DRB5", "HLA-DPA1", "HLA-DPB1", "HLA-DQA1", "HLA-DQB1", "HLA-DQB2", "HLA-DOA", "CD74", "B2M"],
    "T_cell_cytotoxic": ["CD3D", "CD3E", "CD3G", "CD2", "CD4", "CD8A", "CD8B", "GZMA", "GZMB", "GZMH", "GZMK", "PRF1", "NKG7", "IFNG", "TBX21", "CTLA4", "ICOS", "CD28"],
    "myeloid_macrophage": ["TYROBP", "CD163", "TREM2", "MRC1", "FCGR1A", "FCGR2A", "FCGR3A", "FCGR3B", "LILRB1", "LILRB2", "LILRB4", "SPI1", "IRF8", "AIF1", "FOLR2", "MARCO", "MS4A4A", "MS4A6A", "MS4A7"],
    "chemokine_cytokine": ["TNF", "CCL2", "CCL3", "CCL4", "CCL5", "CCL18", "CCL19", "CCL21", "CCR1", "CCR5", "CXCL1", "CXCL9", "CXCL10", "CXCL11", "CXCL12", "CXCL13", "CXCL14", "CXCR4"],
    "complement_C1q": ["C1QA", "C1QB", "C1QC", "C1R", "C1S", "C2", "C3", "C4A", "C4B", "SERPING1"],
    "extracellular_matrix_stromal": ["COL1A1", "COL1A2", "COL3A1", "COL5A1", "COL5A2", "COL5A3", "COL6A1", "COL6A2", "COL6A3", "POSTN", "MMP2", "MMP9", "TIMP3", "LAMA4", "VWF", "PECAM1", "CD34", "PDGFRA", "SPARCL1", "VCAM1", "MGP"],
    "cell_cycle_mitotic": ["CDK1", "TOP2A", "CDC20", "CCNB1", "AURKB", "BIRC5", "MKI67", "UBE2C", "KIF11", "KIF2C", "KIFC1", "PLK1", "FOXM1", "MCM2", "MCM7", "TYMS"],
    "lipid_metabolic": ["FABP4", "LEP", "ADIPOQ", "LPL", "LIPE", "PLIN1", "DGAT2", "CIDEA", "CIDEC", "PCK1", "MLXIPL", "AQP7"],
    "interferon_response": ["IDO1", "GBP4", "GBP5", "CXCL9", "CXCL10", "CXCL11", "EPSTI1", "IFITM2", "MX2", "ZBP1", "TRIM22", "CASP1", "CASP4"],
}

# The label of each marker set.
SET_LABELS = {
    "antigen_presentation": "MHC_class_II_antigen_presentation_module",
    "T_cell_cytotoxic": "T_cell_cytotoxic_module",
    "myeloid_macrophage": "myeloid_macrophage_module",
    "chemokine_cytokine": "chemokine_cytokine_signaling_module",
    "complement_C1q": "C1q_complement_macrophage_module",
    "extracellular_matrix_stromal": "stromal_ECM_remodeling_module",
    "cell_cycle_mitotic": "cell_cycle_mitotic_module",
    "lipid_metabolic": "lipid_metabolic_module",
    "interferon_response": "interferon_response_module",
}

# Labels by words of the terms, the first that fits.
TERM_LABELS = [
    ("MHC_class_II_antigen_presentation_module", "mhc|antigen processing|antigen presentation|class ii"),
    ("chemokine_cytokine_signaling_module", "chemokine|cytokine|ccr|cxcr|cell chemotaxis|leukocyte migration"),
    ("C1q_complement_macrophage_module", "complement|c1q|classical pathway"),
    ("stromal_ECM_remodeling_module", "extracellular matrix|collagen|ecm|stromal|matrix organization|cell adhesion"),
    ("interferon_response_module", "interferon|antiviral|defense response to virus|response to virus"),
    ("T_cell_cytotoxic_module", "t cell mediated cytotoxicity|cytotoxic|granzyme|natural killer"),
    ("T_cell_adaptive_immune_module", "t cell activation|adaptive immunity|adaptive immune|lymphocyte activation"),
    ("myeloid_leukocyte_signaling_module", "myeloid|macrophage|phagocyt|monocyte|fc receptor|rho gtpase|leukocyte activation"),
    ("cell_cycle_mitotic_module", "mitotic|cell cycle|chromosome segregation|dna replication"),
    ("metabolic_module", "lipid|fatty acid|organic acid|small molecule metabolic|metabolic process"),
]


# Label rules, in order.
RULES = [
    {
        "label_id": "MHC_class_II_antigen_presentation_module",
        "fallback_label": "immune_antigen_presentation_associated_module",
        "marker_patterns": ["antigen_presentation"],
        "core_term_patterns": ["antigen processing", "antigen presentation", "mhc", "major histocompatibility", "hla", "peptide antigen", "peptide presentation", "class ii"],
        "required_specific_patterns": ["antigen", "mhc", "major histocompatibility", "hla", "peptide"],
        "theme": "antigen presentation / MHC biology",
    },
    {
        "label_id": "chemokine_cytokine_signaling_module",
        "fallback_label": "inflammatory_immune_signaling_module",
        "marker_patterns": ["chemokine_cytokine", "interferon_response"],
        "core_term_patterns": ["chemokine", "cytokine", "interleukin", "tnf", "chemotaxis", "leukocyte migration", "response to chemokine", "response to cytokine", "cellular response to chemokine", "cellular response to cytokine"],
        "required_specific_patterns": ["chemokine", "cytokine", "interleukin", "tnf", "chemotaxis"],
        "theme": "chemokine/cytokine inflammatory signaling",
    },
    {
        "label_id": "C1q_complement_macrophage_module",
        "fallback_label": "phagocytic_immune_cell_signaling_module",
        "marker_patterns": ["complement_C1q", "myeloid_macrophage"],
        "core_term_patterns": ["complement activation", "classical complement", "c1q", "macrophage activation", "macrophage", "fc receptor", "phagocytosis", "phagocytic"],
        "required_specific_patterns": ["complement", "c1q", "classical complement", "macrophage", "fc receptor"],
        "theme": "C1q/complement/macrophage or Fc-receptor biology",
    },
    {
        "label_id": "myeloid_phagocytic_immune_signaling_module",
        "fallback_label": "myeloid_innate_immune_signaling_module",
        "marker_patterns": ["myeloid_macrophage"],
        "core_term_patterns": ["myeloid", "innate immune", "neutrophil degranulation", "immune receptor", "phagocytic cup", "phagocytosis", "phagocytic", "cdc42", "actin dynamics", "actin cytoskeleton", "cytoskeleton organization"],
        "required_specific_patterns": ["myeloid", "innate immune", "neutrophil", "phagocyt", "cdc42", "actin"],
        "theme": "myeloid/phagocytic immune signaling; phagocytic actin/cytoskeleton remodeling",
    },
    {
        "label_id": "T_cell_adaptive_immune_module",
        "fallback_label": "adaptive_immune_cell_module",
        "marker_patterns": ["T_cell_cytotoxic"],
        "core_term_patterns": ["t cell", "adaptive immune", "lymphocyte activation", "cytotoxic", "natural killer", "granzyme", "perforin", "lymphocyte mediated"],
        "required_specific_patterns": ["t cell", "adaptive immune", "lymphocyte", "cytotoxic", "natural killer", "granzyme", "perforin"],
        "theme": "T-cell/adaptive cytotoxic immunity",
    },
    {
        "label_id": "myeloid_leukocyte_signaling_module",
        "fallback_label": "leukocyte_immune_signaling_module",
        "marker_patterns": ["myeloid_macrophage"],
        "core_term_patterns": ["myeloid", "leukocyte activation", "immune receptor", "leukocyte mediated", "hematopoietic", "innate immune", "immune effector"],
        "required_specific_patterns": ["myeloid", "leukocyte", "immune receptor", "hematopoietic", "innate immune"],
        "theme": "myeloid/leukocyte immune signaling",
    },
    {
        "label_id": "stromal_ECM_remodeling_module",
        "fallback_label": "stromal_matrix_associated_module",
        "marker_patterns": ["extracellular_matrix_stromal"],
        "core_term_patterns": ["extracellular matrix", "ecm", "collagen", "matrix organization", "stromal", "focal adhesion", "cell-substrate adhesion", "cell adhesion"],
        "required_specific_patterns": ["extracellular matrix", "ecm", "collagen", "matrix", "stromal", "adhesion"],
        "theme": "stromal/extracellular-matrix remodeling",
    },
    {
        "label_id": "interferon_response_module",
        "fallback_label": "antiviral_inflammatory_response_module",
        "marker_patterns": ["interferon_response"],
        "core_term_patterns": ["interferon", "antiviral", "response to virus", "viral process", "type i interferon"],
        "required_specific_patterns": ["interferon", "antiviral", "virus", "viral"],
        "theme": "interferon/antiviral response",
    },
    {
        "label_id": "cell_cycle_mitotic_module",
        "fallback_label": "proliferation_associated_module",
        "marker_patterns": ["cell_cycle_mitotic"],
        "core_term_patterns": ["cell cycle", "mitotic", "mitosis", "chromosome segregation", "dna replication", "spindle", "cyclin"],
        "required_specific_patterns": ["cell cycle", "mitotic", "mitosis", "chromosome", "dna replication", "spindle"],
        "theme": "cell-cycle/mitotic proliferation",
    },
    {
        "label_id": "lipid_metabolic_module",
        "fallback_label": "metabolic_lipid_associated_module",
        "marker_patterns": ["lipid_metabolic"],
        "core_term_patterns": ["lipid", "fatty acid", "cholesterol", "lipoprotein", "triglyceride"],
        "required_specific_patterns": ["lipid", "fatty acid", "cholesterol", "lipoprotein", "triglyceride"],
        "theme": "lipid/fatty-acid metabolism",
    },
]


def label_from_terms(terms: Column, fallback: Column) -> Column:
    """The first label whose words occur in the terms; else the fallback, else unassigned_module."""
    text = F.lower(F.coalesce(terms, F.lit("")))
    out = F.when(F.lit(False), F.lit(""))
    for label, words in TERM_LABELS:
        out = out.when(text.rlike(words), F.lit(label))
    return out.otherwise(F.coalesce(F.nullif(fallback, F.lit("")), F.lit("unassigned_module")))


def set_label(best_set: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in SET_LABELS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, best_set), F.lit("unassigned_module"))


def counts_of(summary: Column) -> Column:
    """map<set, count> of a marker summary 'a(3); b(1)'."""
    parts = F.filter(F.split(F.coalesce(summary, F.lit("")), ";\\s*"), lambda p: p.rlike("^[A-Za-z0-9_]+\\([0-9]+\\)"))
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(F.regexp_extract(p, "^([A-Za-z0-9_]+)", 1), F.regexp_extract(p, "\\(([0-9]+)\\)", 1).cast("int"))))


def supporting_themes(modules: DataFrame, rules: DataFrame, most: int = 2) -> DataFrame:
    """(module, themes): the chosen label's theme and up to two others with strong support of their own.

    modules: module, label_id, counts, term_text; rules: label_id, theme, position and the pattern lists.
    """
    text = F.lower(F.coalesce("term_text", F.lit("")))
    hits = lambda patterns: F.size(F.filter(patterns, lambda p: F.rlike(text, p)))
    markers = F.aggregate("marker_patterns", F.lit(0), lambda a, k: a + F.coalesce(F.try_element_at("counts", k), F.lit(0)))
    both = modules.select("module", F.col("label_id").alias("chosen"), "counts", "term_text").crossJoin(F.broadcast(rules)).withColumns({"m": markers, "t": hits(F.col("core_term_patterns")), "r": hits(F.col("required_specific_patterns"))})
    one = lambda c: F.when(c, 1).otherwise(0)
    own = F.coalesce(F.col("label_id") == F.col("chosen"), F.lit(False))
    both = both.withColumns({"own": own, "support": one(F.col("m") >= 5) + one(F.col("t") >= 2) + one(F.col("r") >= 1)})
    good = both.where(F.when(F.col("own"), (F.col("m") > 0) | (F.col("t") > 0) | (F.col("r") > 0)).otherwise(F.col("support") >= 2))
    place = F.row_number().over(W.partitionBy("module", "own").orderBy(F.desc("support"), F.desc("m"), F.desc("t"), F.desc("r"), "position"))
    kept = good.withColumn("place", place).where(F.col("own") | (F.col("place") <= most))
    listed = kept.groupBy("module").agg(F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct((~F.col("own")).alias("other"), "place", "theme"))), lambda x: x["theme"])), "; ").alias("themes"))
    return modules.select("module").join(listed, "module", "left").select("module", F.coalesce("themes", F.lit("not_available")).alias("themes"))
