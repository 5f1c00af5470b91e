"""Rulebooks and marker sets as data: JSON files or Python lists, checked and made DataFrames.

Rules are a parameter of a run. ``EXAMPLE`` shows the form; a site's own rulebook is a JSON list of
such objects. Provenance of unknown rules takes conservative values.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "rule_id string, axis string, display_label string, compartment string, positive_markers array<string>, supportive_markers array<string>, exclusion_markers array<string>, "
    "term_patterns array<string>, required_term_patterns array<string>, min_positive int, min_score double, marker_only_min_positive int, marker_only_min_supportive int, marker_only_min_score double, priority int"
)
AXES = ("lineage", "state", "process")
_LISTS = ("positive_markers", "supportive_markers", "exclusion_markers", "term_patterns", "required_term_patterns")

EXAMPLE = [
    {
        "rule_id": "example_proliferation", "axis": "process", "display_label": "proliferation", "compartment": "multi-compartment",
        "positive_markers": ["MKI67", "TOP2A", "CDK1"], "supportive_markers": ["CCNB1"], "exclusion_markers": [],
        "term_patterns": ["cell cycle", "mitotic"], "required_term_patterns": ["cell cycle"], "min_positive": 2, "min_score": 0.4, "priority": 1,
    },
]


CURATED = "rule_id string, curation_status string, rule_version string, rule_schema_version string, evidence_basis string, reference_count int, references string"


def checked(rules: list[dict]) -> list[dict]:
    ids = [r.get("rule_id") for r in rules]
    if len(set(ids)) != len(ids) or not all(ids):
        raise ValueError("rule ids must be given and unique")
    for r in rules:
        if r.get("axis") not in AXES:
            raise ValueError(f"{r['rule_id']}: the axis is one of {', '.join(AXES)}")
        if any(not isinstance(r.get(k, []), list) for k in _LISTS) or not r.get("positive_markers"):
            raise ValueError(f"{r['rule_id']}: markers and patterns are lists, and positive markers are needed")
        if not 0 <= float(r.get("min_score", -1)) <= 1 or int(r.get("min_positive", 0)) < 1:
            raise ValueError(f"{r['rule_id']}: min_score lies in [0, 1], min_positive is 1 or more")
    return rules


def frame(spark: SparkSession, rules: list[dict]) -> DataFrame:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows = [tuple(r.get(n, [] if n in _LISTS else None) for n in names) for r in checked(rules)]
    return spark.createDataFrame(rows, SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    with open(path, encoding="utf-8") as f:
        return frame(spark, json.load(f))


def provenance(rules: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule_id, evidence_level, references, reference_count): what is known of a rule, or that nothing is."""
    base = rules.select("rule_id")
    out = base.join(known, "rule_id", "left") if known is not None else base.withColumns({"evidence_level": F.lit(None).cast("string"), "references": F.lit(None).cast("string")})
    refs = F.coalesce("references", F.lit(""))
    return out.select("rule_id", F.coalesce("evidence_level", F.lit("unreviewed")).alias("evidence_level"), refs.alias("references"), F.size(F.filter(F.split(refs, ";"), lambda x: F.trim(x) != "")).alias("reference_count"))


#: What holds of a rule that doesn't say otherwise.
UNCURATED = {"curation_status": "legacy_unverified", "rule_version": "1.0.0", "rule_schema_version": "1.0.0", "evidence_basis": "marker genes and term patterns", "references": ""}


def curation(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """(rule_id, curation_status, rule_version, rule_schema_version, evidence_basis, reference_count, references) as the rules' own entries tell."""
    rows = []
    for r in checked(rules):
        own = UNCURATED | {k: r[k] for k in UNCURATED if r.get(k)}
        refs = [x.strip() for x in own["references"].split(";") if x.strip()]
        rows.append((r["rule_id"], *(own[k] for k in ("curation_status", "rule_version", "rule_schema_version", "evidence_basis")), len(refs), "; ".join(refs)))
    return spark.createDataFrame(rows, CURATED)


def with_provenance(evidence: DataFrame, known: DataFrame) -> DataFrame:
    """Rule evidence with what is known of each rule; a rule of which nothing is known is an error."""
    columns = [c for c in known.columns if c != "rule_id"]
    out = evidence.join(known.withColumn("known__", F.lit(True)), "rule_id", "left")
    sure = F.when(F.col("known__").isNull(), F.raise_error(F.concat(F.lit("no provenance of rule "), F.col("rule_id")))).otherwise(F.col("rule_id"))
    return out.select(sure.cast("string").alias("rule_id"), *(c for c in evidence.columns if c != "rule_id"), *columns)


def marker_sets(spark: SparkSession, sets: dict[str, list[str]]) -> DataFrame:
    """(set_name, position, gene)."""
    rows = [(name, i, g.strip().upper()) for i, (name, genes) in enumerate(sets.items()) for g in dict.fromkeys(genes)]
    return spark.createDataFrame(rows, "set_name string, position int, gene string")


def label_rules(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """Label rules for ``evidence.label_rules``, in order."""
    rows = [(r["label_id"], r["fallback_label"], i, r["marker_patterns"], r["core_term_patterns"], r["required_specific_patterns"], r.get("theme", "")) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "label_id string, fallback_label string, position int, marker_patterns array<string>, core_term_patterns array<string>, required_specific_patterns array<string>, theme string")
