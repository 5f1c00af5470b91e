"""The input contract of gene tables: separators, headers, values, and every violation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.functions.columns import as_number, finite, trimmed

# Accepted header names once cleaned, and names that stand for adjusted p-values.
ALIASES = {
    "gene": ["gene", "genesymbol", "symbol", "hgncsymbol"],
    "logFC": ["logfc", "log2fc", "logfoldchange", "log2foldchange"],
    "pvalue": ["pvalue", "pval", "rawpvalue", "rawpval"],
}
ADJUSTED = ["padj", "adjpvalue", "adjustedpvalue", "fdr", "qvalue"]
SEPARATORS = [";", "\t", ","]
SCHEMA_VERSION = "1.0.0"


class ContractError(ValueError):
    """The input breaks the contract."""


@dataclass
class Contract:
    """What was read and under which rules."""

    source_columns: dict[str, str]
    input_rows: int = 0
    zero_pvalue_rows: int = 0
    rules: dict[str, str] = field(default_factory=lambda: {
        # What the contract says of an input.
        "contract_schema_version": SCHEMA_VERSION, "gene_identifier": "HGNC_gene_symbol", "logFC_scale": "log2_fold_change", "contrast_numerator": "tumor_specimen", "contrast_denominator": "reference_condition",
        "positive_logFC_interpretation": "higher_expression_in_tumor_specimen_relative_to_reference", "pvalue_type": "raw_differential_expression_p_value", "pvalue_range": "closed_interval_0_to_1",
        "missing_value_policy": "error", "duplicate_gene_policy": "error_before_HGNC_normalization", "positional_column_fallback": "FALSE",
    })

    def rows(self) -> list[tuple[str, str]]:
        out = [(f"input_{k}", v) for k, v in self.rules.items()]
        out += [(f"input_{k}_source_column", v) for k, v in self.source_columns.items()]
        return [*out, ("input_zero_pvalue_rows", str(self.zero_pvalue_rows))]


def separator(first_line: str) -> str:
    """The most frequent of ';', tab and ',' (ties in that order)."""
    counts = [first_line.count(s) for s in SEPARATORS]
    if not any(counts):
        raise ContractError("the header has no separator")
    return SEPARATORS[counts.index(max(counts))]


def separator_of(line: Column) -> Column:
    """The same of a column of header lines; null without any."""
    n = lambda s: F.length(line) - F.length(F.replace(line, F.lit(s), F.lit("")))
    most = F.greatest(*map(n, SEPARATORS))
    return F.when(most > 0, F.coalesce(*(F.when(n(s) == most, F.lit(s)) for s in SEPARATORS)))


def cleaned(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "", name.lstrip("﻿").lower())


def source_columns(header: list[str]) -> dict[str, str]:
    """Canonical name to header name; one match each, no fallback by position."""
    found = {}
    names = [cleaned(h) for h in header]
    for canonical, aliases in ALIASES.items():
        hits = [h for h, n in zip(header, names) if n in aliases]
        if len(hits) > 1:
            raise ContractError(f"several columns for {canonical}: {', '.join(hits)}")
        if hits:
            found[canonical] = hits[0]
    missing = [c for c in ALIASES if c not in found]
    if missing == ["pvalue"] and any(n in ADJUSTED for n in names):
        raise ContractError("only adjusted p-values are given; raw p-values are needed")
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return found


def typed(rows: DataFrame, *by: str) -> DataFrame:
    """input_row, gene, logFC, pvalue of text columns, after the columns ``by``; what is no number is null."""
    return rows.select(*by, F.col("input_row").cast("int").alias("input_row"), trimmed(F.col("gene")).alias("gene"), as_number(F.col("logFC").cast("string")).alias("logFC"), as_number(F.col("pvalue").cast("string")).alias("pvalue"))


def checks(rows: DataFrame, *by: str) -> DataFrame:
    """(rule, input_row, gene) of every violation, for each table that ``by`` names; rules are in the order in which they are reported."""
    empty = F.coalesce(F.col("gene"), F.lit("")) == ""
    twins = rows.where(~empty).groupBy(*by, F.upper("gene").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = F.array_compact(F.array(
        F.when(empty, F.lit("1:empty_gene")), F.when(~finite(F.col("logFC")), F.lit("2:logFC_not_finite")),
        F.when(~finite(F.col("pvalue")), F.lit("3:pvalue_not_finite")), F.when(finite(F.col("pvalue")) & ~F.col("pvalue").between(0, 1), F.lit("4:pvalue_out_of_range")),
    ))
    single = rows.select(*by, "input_row", "gene", F.explode(found).alias("rule"))
    repeated = rows.withColumn("key", F.upper("gene")).join(twins, [*by, "key"], "left_semi").select(*by, "input_row", "gene", F.lit("5:duplicate_gene").alias("rule"))
    return single.union(repeated).select(*by, F.substring("rule", 3, 40).alias("rule"), F.substring("rule", 1, 1).cast("int").alias("position"), "input_row", "gene")


def violations(rows: DataFrame) -> DataFrame:
    """(rule, rows_failing)."""
    return checks(rows).groupBy("rule").agg(F.count(F.lit(1)).alias("rows_failing"))


def require_valid(rows: DataFrame) -> None:
    """Raise for the first rule that fails, naming its first rows."""
    bad = checks(rows).orderBy("position", "input_row").limit(21).collect()
    if bad:
        same = [r for r in bad if r["rule"] == bad[0]["rule"]]
        listed = ", ".join(str(r["input_row"]) for r in same[:20])
        raise ContractError(f"{same[0]['rule']}: rows {listed}{', ...' if len(same) > 20 else ''}")


def read_genes(spark: SparkSession, path: str) -> tuple[DataFrame, Contract]:
    """A delimited gene table, validated. Rows are numbered in the order of the file's lines.

    Case tables are some hundred lines; the file is read as lines with their numbers by one scan.
    """
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.transform(F.split("value", "\r?\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line")))).alias("l")).select("l.*").where("line <> ''")
    first = lines.orderBy("i").first()
    if first is None:
        raise ContractError("the input is empty")
    sep = separator(first["line"])
    unquoted = lambda x: x.strip().strip('"').lstrip("﻿")
    header = [unquoted(h) for h in first["line"].lstrip("﻿").split(sep)]
    columns = source_columns(header)
    at = {c: header.index(h) for c, h in columns.items()}
    schema = ", ".join(f"c{k} string" for k in range(len(header)))
    body = lines.where(F.col("i") > first["i"]).withColumn("v", F.from_csv("line", schema, {"sep": sep, "quote": '"'}))
    raw = body.select(F.col("i").alias("input_row"), *(F.col(f"v.c{k}").alias(c) for c, k in at.items()))
    rows = typed(raw)
    if rows.isEmpty():
        raise ContractError("the input has no rows")
    require_valid(rows)
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pvalue") == 0).alias("z")).first()
    return rows, Contract(columns, n["n"], n["z"])


#: Names that no case may have, and the form of those that it may.
CASE_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}")
RESERVED = {"con", "prn", "aux", "nul", *(f"{d}{n}" for d in ("com", "lpt") for n in range(1, 10))}


def case_id(name: str) -> str:
    if not CASE_NAME.fullmatch(name) or name.endswith(".") or name.split(".")[0].lower() in RESERVED:
        raise ContractError(f"not a case name: {name!r}")
    return name


def is_case_id(name: Column) -> Column:
    """Whether a column's texts are case names."""
    device = F.lower(F.substring_index(name, ".", 1)).isin(*sorted(RESERVED))
    return name.rlike(f"^(?:{CASE_NAME.pattern})$") & ~name.endswith(".") & ~device


def case_of(path: Column) -> Column:
    """The case name that a path suggests: its last part without extension, other characters replaced."""
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"\.[^.]*$", ""), "[^A-Za-z0-9._-]", "_")


def output_folder(root: str, case: str, legacy: bool = False) -> str:
    """The case's folder below a root: the root itself if it has the case's name; ``legacy``: a variant of it below a results folder."""
    plain = re.sub(r"/+$", "", root.replace("\\", "/"))
    parent, _, base = plain.rpartition("/")
    if base == case:
        return root
    # Names of results folders, the third misspelt in old runs.
    if legacy and base.startswith(f"{case}_") and parent.rpartition("/")[2] in ("results", "result", "reults"):
        return f"{parent}/{case}"
    return f"{plain}/{case}"


def check_parameters(threshold: object, top_n: object, enrichment: object) -> None:
    """Raise for the first parameter that is none."""
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool)
    if not whole(threshold) or not 1 <= threshold <= 1000:
        raise ContractError("the score threshold is a whole number from 1 to 1000")
    if not whole(top_n) or top_n < 1:
        raise ContractError("top_n is a whole number, 1 or more")
    if not isinstance(enrichment, bool):
        raise ContractError("enrichment is on or off")


def case_from_path(path: str) -> str:
    base = re.sub(r"\.[^.]*$", "", re.split(r"[/\\]", path)[-1])
    return case_id(re.sub(r"[^A-Za-z0-9._-]", "_", base))


