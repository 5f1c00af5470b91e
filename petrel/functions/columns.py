"""Scalar, text and ranking expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.functions import quantiles

#: -log10 takes p-values from the smallest normal double on.
LEAST_P = 2.2250738585072014e-308


def finite(x: Column) -> Column:
    """True for a number that is neither null nor NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def only_finite(x: Column) -> Column:
    return F.when(finite(x), x)


def as_number(text: Column) -> Column:
    """Text with a decimal comma or point to double; null if it is no number."""
    return F.replace(trimmed(text), F.lit(","), F.lit(".")).try_cast("double")


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, "^[ \\t\\r\\n]+|[ \\t\\r\\n]+$", "")


def clean_name(text: Column) -> Column:
    """A header name without byte-order mark, case, spaces and punctuation."""
    return F.regexp_replace(F.lower(F.regexp_replace(text, "^\\uFEFF", "")), "[^a-z0-9]+", "")


def minmax(x: Column, partition: list[str] | None = None) -> Column:
    """Finite values scaled to [0, 1]; a constant is 1; others are null."""
    over = W.partitionBy(*(partition or []))
    low, high = F.min(only_finite(x)).over(over), F.max(only_finite(x)).over(over)
    return F.when(finite(x), F.when(low == high, F.lit(1.0)).otherwise((x - low) / (high - low)))


def with_minmax(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds min-max scaled columns from one aggregate, without moving all rows to one task as a window would."""
    rows = rows.withColumns({f"{c}__raw": x.cast("double") for c, x in columns.items()})
    bounds = rows.agg(*(f(only_finite(F.col(f"{c}__raw"))).alias(f"{c}__{n}") for c in columns for n, f in (("low", F.min), ("high", F.max))))
    out = rows.join(F.broadcast(bounds))  # one row
    for c in columns:
        x, low, high = F.col(f"{c}__raw"), F.col(f"{c}__low"), F.col(f"{c}__high")
        out = out.withColumn(c, F.when(finite(x), F.when(low == high, F.lit(1.0)).otherwise((x - low) / (high - low))))
    return out.drop(*(f"{c}__{n}" for c in columns for n in ("raw", "low", "high")))


def rank_desc(x: Column, partition: list[str] | None = None) -> Column:
    """Competition rank from the greatest; nulls have none."""
    over = W.partitionBy(*(partition or [])).orderBy(x.desc_nulls_last())
    return F.when(x.isNotNull(), F.rank().over(over)).cast("int")


#: Rows up to which one aggregate takes the quantiles of ``levels``; beyond, they are found by ranges. Both give the same.
ONE_BUFFER = 200_000


def levels(rows: DataFrame, columns: dict[str, Column], one_buffer: int = ONE_BUFFER, count: int | None = None) -> DataFrame:
    """Adds a level by the 0.90, 0.75 and 0.50 quantiles of the finite values; others have none."""
    rows = rows.withColumns({f"{c}__raw": x.cast("double") for c, x in columns.items()})
    chances, of = [0.5, 0.75, 0.9], lambda c: only_finite(F.col(f"{c}__raw"))
    if (rows.count() if count is None else count) <= one_buffer:
        cuts = rows.agg(*(F.percentile(of(c), F.array(*map(F.lit, chances))).alias(f"{c}__cuts") for c in columns))
        out = rows.join(F.broadcast(cuts))  # one row
    else:
        found = quantiles.by_ranges(rows, {c: of(c) for c in columns}, chances)
        out = rows.withColumns({f"{c}__cuts": F.array(*(F.lit(q).cast("double") for q in found[c])) for c in columns})
    for c in columns:
        x, q = F.col(f"{c}__raw"), F.col(f"{c}__cuts")
        out = out.withColumn(c, F.when(~finite(x), F.lit(None)).when(x >= q[2], F.lit("very_high_top_10_percent")).when(x >= q[1], F.lit("high_top_25_percent")).when(x >= q[0], F.lit("medium_above_median")).otherwise(F.lit("low_below_median")))
    return out.drop(*(f"{c}__{n}" for c in columns for n in ("raw", "cuts")))


def truncated(text: Column, n: int) -> Column:
    """At most n characters, the last three dots if something is cut; null is empty."""
    return F.when(text.isNull(), F.lit("")).when(F.length(text) > n, F.concat(F.substring(text, 1, n - 3), F.lit("..."))).otherwise(text)


def top_list(value: Column, order: Column, n: int, ties: Column | None = None) -> Column:
    """An aggregate: values by descending order (nulls last, then ties), the first n, of these the distinct ones, joined by ';'."""
    key = F.struct(order.isNull().alias("absent"), (-F.coalesce(order.cast("double"), F.lit(0.0))).alias("o"), (ties if ties is not None else value).alias("t"), value.alias("v"))
    listed = F.transform(F.slice(F.sort_array(F.collect_list(key)), 1, n), lambda x: x["v"])
    return F.array_join(F.array_distinct(listed), ";")


def first_distinct(value: Column, order: list[Column], n: int, sep: str = "; ") -> Column:
    """An aggregate: the first n distinct values in the given order, joined."""
    key = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), value.alias("v"))
    return F.array_join(F.slice(F.array_distinct(F.transform(F.sort_array(F.collect_list(key)), lambda x: x["v"])), 1, n), sep)


def gene_list(text: Column, separators: str = "[,;|/\\s]+") -> Column:
    """Distinct upper-case symbols of a delimited text, in order of appearance."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), separators), lambda g: F.upper(trimmed(g)))
    return F.array_distinct(F.filter(parts, lambda g: g != ""))


def joined_text(sep: str, *values: Column) -> Column:
    """Trimmed distinct non-empty values in order, joined."""
    parts = F.filter(F.transform(F.array(*values), lambda v: trimmed(v)), lambda v: v.isNotNull() & (v != ""))
    return F.array_join(F.array_distinct(parts), sep)


def rounded(x: Column, digits: int) -> Column:
    """Half-even rounding."""
    return F.bround(x, digits)


def significant(x: Column, digits: int) -> Column:
    """x to so many significant digits."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def direction(median: Column) -> Column:
    # Directions of a module's median change.
    up, down = finite(median) & (median > 0), finite(median) & (median < 0)
    return F.when(up, F.lit("predominantly_upregulated")).when(down, F.lit("predominantly_downregulated")).otherwise(F.lit("mixed_or_not_available"))


def truth(text: Column) -> Column:
    """True, false or null of a text that says so."""
    plain = F.lower(trimmed(text))
    return F.when(plain.isin("1", "true", "t", "yes", "y"), F.lit(True)).when(plain.isin("0", "false", "f", "no", "n"), F.lit(False))


def pair_key(a: Column, b: Column, sep: str = "|") -> Column:
    """One key for a pair, whichever comes first."""
    return F.array_join(F.array_sort(F.array(a, b)), sep)


def humanised(label: Column) -> Column:
    named = F.when(label.isNull() | (label == ""), F.lit("unassigned_module")).otherwise(label)
    return F.replace(F.regexp_replace(named, "_module$", ""), F.lit("_"), F.lit(" "))


# Classes of gene symbols and their patterns.
SYMBOL_CLASSES = [
    ("immunoglobulin_locus", "^(IGH|IGK|IGL)"),
    ("t_cell_receptor_locus", "^(TRA|TRB|TRG|TRD)"),
    ("HLA_gene", "^HLA-"),
    ("non_coding_or_predicted_locus", "^(LINC|MIR|MIRLET|SNORD|SNORA|SCARNA|RNU|RNA|LOC|AC[0-9]|AL[0-9])"),
    ("antisense_locus", "(^|[-.])AS[0-9]*$|ANTISENSE"),
    ("pseudogene_like_symbol", "P[0-9]+$"),
]
ENTITY_CLASSES = [
    ("predicted_LOC", "^LOC[0-9]+$"),
    ("immunoglobulin_locus", "^(IGH|IGK|IGL)"),
    ("T_cell_receptor_locus", "^TR[ABDG][CVJ]"),
    ("mitochondrial", "^MT-"),
    ("Y_chromosome_associated", "^(RPS4Y1|EIF1AY|KDM5D|ZFY|DDX3Y|UTY|USP9Y|TMSB4Y|NLGN4Y|PRKY)$"),
    ("ribosomal", "^RP[SL][0-9]"),
    ("pseudogene_or_pseudogene_like", "P[0-9]+$|PSEUDOGENE"),
    ("lncRNA_or_antisense", "-AS[0-9]*$|^LINC[0-9]+$"),
]
CANONICAL = "canonical_or_unclassified_protein_coding"
NETWORK_ONLY = ["immunoglobulin_locus", "T_cell_receptor_locus", "predicted_LOC", "pseudogene_or_pseudogene_like", "lncRNA_or_antisense"]
EXCLUDED = ["mitochondrial", "ribosomal", "Y_chromosome_associated"]


def _first_match(text: Column, classes: list[tuple[str, str]], otherwise: str, empty: str) -> Column:
    out = F.when(text.isNull() | (text == ""), F.lit(empty))
    for name, pattern in classes:
        out = out.when(text.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit(otherwise))


def symbol_class(symbol: Column) -> Column:
    return _first_match(F.upper(trimmed(symbol)), SYMBOL_CLASSES, "standard_gene_symbol", "empty_symbol")


def entity_class(symbol: Column) -> Column:
    return _first_match(F.upper(trimmed(symbol)), ENTITY_CLASSES, CANONICAL, "unknown")


def eligibility(entity: Column) -> Column:
    return F.when(entity == CANONICAL, F.lit("review_ready_canonical")).when(entity.isin(NETWORK_ONLY), F.lit("network_evidence_only")).when(entity.isin(EXCLUDED), F.lit("excluded_from_automatic_priority")).otherwise(F.lit("manual_review_required"))


def mapping_status(initially: Column, after_alias: Column, symbol: Column) -> Column:
    """symbol: its symbol_class."""
    # One status for each class of unmapped symbols.
    named = {
        "immunoglobulin_locus": "not_mapped_immunoglobulin_locus",
        "t_cell_receptor_locus": "not_mapped_T_cell_receptor_locus",
        "non_coding_or_predicted_locus": "not_mapped_non_coding_or_predicted_locus",
        "antisense_locus": "not_mapped_antisense_locus",
        "pseudogene_like_symbol": "not_mapped_pseudogene_like_symbol",
        "HLA_gene": "not_mapped_HLA_gene",
        "empty_symbol": "not_mapped_empty_symbol",
    }
    out = F.when(F.coalesce(initially, F.lit(False)), F.lit("mapped_to_STRING")).when(F.coalesce(after_alias, F.lit(False)), F.lit("mapped_after_unambiguous_STRING_alias"))
    for name, status in named.items():
        out = out.when(symbol == name, F.lit(status))
    return out.otherwise(F.lit("not_mapped_no_unique_STRING_protein_identifier"))


def symbol_category(in_network: Column, status: Column, symbol: Column) -> Column:
    # Report categories of mapped and unmapped symbols.
    out = F.when(in_network & (status == "mapped_after_unambiguous_STRING_alias"), F.lit("STRING_mapped_after_unambiguous_alias_correction"))
    for name, category in (("HLA_gene", "STRING_mapped_HLA_protein"), ("immunoglobulin_locus", "STRING_mapped_immunoglobulin_locus"), ("t_cell_receptor_locus", "STRING_mapped_T_cell_receptor_locus")):
        out = out.when(in_network & (symbol == name), F.lit(category))
    return out.when(in_network, F.lit("STRING_mapped_standard_protein")).when(status == "not_mapped_antisense_locus", F.lit("not_mapped_antisense_or_lncRNA_like_symbol")).otherwise(status)
