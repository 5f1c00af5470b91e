"""Row texts of nodes and modules: numbers as short texts, put into templates as columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrel.functions.columns import finite, significant, truncated
from petrel.operators import score

# Formats of the row texts; a name in braces is a column, with the digits of a number after a colon.
TOPOLOGY = "degree rank {degree_rank} ({degree_level}); betweenness rank {betweenness_rank} ({betweenness_level}); stress rank {stress_rank} ({stress_level})"
EXPRESSION = "logFC={logFC:4}; |logFC| rank {abs_logFC_rank} ({expression_change_level}); p={pvalue:4}; -log10(p) rank {statistical_rank} ({statistical_evidence_level})"
MATRIX = (
    "Composite rank {candidate_rank} combines normalized degree={degree_component:4}, betweenness={betweenness_component:4}, log-stress={log_stress_component:4}, "
    "|logFC|={abs_logFC_component:4} and statistical evidence={statistical_component:4}. Module context: {context}. Eligibility: {eligibility}."
)
HUB = "Topology support {support} of 3; best rank {best_rank}; {topology_support}."
MODULE = "Interpretation: {interpretation} with confidence {confidence}. Size: {module_size}. Direction: {dominant_expression_direction}. Database evidence: {database_evidence_summary} Lead proteins by candidate score: {top_genes_by_candidate_score}."
LIMITS = {"matrix_rationale": 1400, "module_rationale": 1800}


def number(x: Column, digits: int, scientific: bool = True, missing: str = "NA") -> Column:
    """A number to so many significant digits without idle zeros, in the shorter of fixed and scientific form.

    Equal lengths are fixed, as is everything if not ``scientific``. Null, NaN and infinities are ``missing``. Ties go to even.
    """
    value = x.cast("double")
    # the scale of a number near the least double would overflow
    near = F.when(F.abs(value) > 1e-290, significant(value, digits)).otherwise(value)
    # each step is bound once: written out, the expression would hold the first some forty times
    text = _bound(F.format_string(f"%.{digits - 1}e", near), lambda shown: _bound(_pieces(shown), lambda p: F.concat(p["sign"], _put(p["d"], p["e"], scientific))))
    return F.when(finite(value), text).otherwise(F.lit(missing))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once."""
    return F.get(F.transform(F.array(x), lambda v: f(v)), F.lit(0))


def _pieces(shown: Column) -> Column:
    """Sign, digits without the last zeros, and power of a number in scientific form."""
    part = lambda k: F.regexp_extract(shown, r"^(-?)([0-9])\.?([0-9]*)e([+-][0-9]+)$", k)
    return F.struct(part(1).alias("sign"), F.regexp_replace(F.concat(part(2), part(3)), "(?<=.)0+$", "").alias("d"), part(4).try_cast("int").alias("e"))


def _put(d: Column, e: Column, scientific: bool) -> Column:
    """The digits with a point or a power."""
    n = F.length(d)
    fixed = (
        F.when(e >= n - 1, F.rpad(d, e + 1, F.lit("0")))
        .when(e >= 0, F.concat(F.substring(d, F.lit(1), e + 1), F.lit("."), F.substring(d, e + 2, n)))
        .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d))
    )
    power = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(e).cast("string"))
    short = F.concat(F.substring(d, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(F.lit("")), power)
    return F.when(F.length(short) < F.length(fixed), short).otherwise(fixed) if scientific else fixed


def filled(template: str, missing: dict[str, str] | None = None, scientific: bool = True) -> Column:
    """A template's text with columns in place of its names; a null is the text that ``missing`` has for it, else NA."""
    parts = []
    for k, piece in enumerate(re.split(r"\{([^}]+)\}", template)):
        name, _, digits = piece.partition(":")
        absent = (missing or {}).get(name, "NA")
        if k % 2 == 0:
            parts.append(F.lit(piece))
        elif digits:
            parts.append(number(F.col(name), int(digits), scientific, absent))
        else:
            parts.append(F.coalesce(F.nullif(F.trim(F.col(name).cast("string")), F.lit("")), F.lit(absent)))
    return F.concat(*parts)


def node_texts(nodes: DataFrame, context: Column) -> DataFrame:
    """Adds topology_support, expression_support and matrix_rationale to ranked nodes with components and eligibility.

    context: what the node's module is about; a node of a module without one is unresolved.
    """
    out = score.with_levels(nodes).withColumn("context", context)
    matrix = filled(MATRIX, {"context": "unresolved", "eligibility": "not_available"} | dict.fromkeys(score.COMPONENTS, "not_available"), scientific=False)
    out = out.withColumns({"topology_support": filled(TOPOLOGY), "expression_support": filled(EXPRESSION), "matrix_rationale": truncated(matrix, LIMITS["matrix_rationale"])})
    return out.drop("context")


def hub_texts(hubs: DataFrame) -> DataFrame:
    """Adds hub_rationale to hubs (rank, support, best_rank) that have their topology_support."""
    return hubs.withColumn("hub_rationale", filled(HUB))


def module_texts(modules: DataFrame) -> DataFrame:
    """Adds module_rationale to readable modules with interpretation and confidence."""
    text = filled(MODULE, {"interpretation": "unresolved", "confidence": "not_available", "top_genes_by_candidate_score": "not_available"})
    return modules.withColumn("module_rationale", truncated(text, LIMITS["module_rationale"]))
