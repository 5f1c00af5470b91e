"""From gene symbols to protein identifiers: normalisation, unique maps, alias correction, collisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.functions.columns import mapping_status, only_finite, symbol_category, symbol_class, trimmed

#: Fixed value: identifiers of the supported species.
SPECIES = "^9606\\."


def normalised_symbols(genes: DataFrame, approved: DataFrame, gene_col: str = "gene") -> DataFrame:
    """Adds input_gene and changed; approved: symbol, approved. Unknown symbols stay, empty ones go."""
    lookup = first_match(approved.select(F.col("symbol").alias("s__"), F.col("approved").alias("a__")), ["s__"], ["a__"])
    out = genes.withColumn("input_gene", F.col(gene_col)).join(lookup, F.col(gene_col) == F.col("s__"), "left")
    fixed = F.coalesce("a__", F.col(gene_col))
    return out.withColumn(gene_col, fixed).withColumn("changed", F.col("input_gene") != F.col(gene_col)).drop("s__", "a__").where(F.coalesce(trimmed(F.col(gene_col)), F.lit("")) != "")


def first_match(build: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key, the first in the order, so that a left join with it never multiplies rows."""
    return build.withColumn("n__", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("n__ = 1").drop("n__")


def unique_names(proteins: DataFrame, aliases: DataFrame, species: str = SPECIES) -> DataFrame:
    """(name, protein_id) of upper-case names that stand for one protein alone; proteins: protein_id, name; aliases: protein_id, alias."""
    names = proteins.select("protein_id", "name").union(aliases.select("protein_id", "alias"))
    keyed = names.select("protein_id", F.upper(trimmed(F.col("name"))).alias("name")).where((F.col("name") != "") & F.col("protein_id").rlike(species))
    return keyed.groupBy("name").agg(F.min("protein_id").alias("protein_id"), F.max("protein_id").alias("other")).where("protein_id = other").drop("other")


def mapped(genes: DataFrame, names: DataFrame, gene_col: str = "gene", keep_unmapped: bool = True) -> DataFrame:
    """Adds protein_id."""
    return genes.join(names.withColumnRenamed("name", "name__"), F.upper(trimmed(F.col(gene_col))) == F.col("name__"), "left" if keep_unmapped else "inner").drop("name__")


def alias_corrections(unmapped: DataFrame, proteins: DataFrame, aliases: DataFrame, species: str = SPECIES, approved: DataFrame | None = None) -> DataFrame:
    """(original_gene, protein_id, corrected_gene) of unmapped genes whose alias names one protein.

    approved (symbol, approved): the corrected gene is the approved form of the protein's name, where there is one.
    """
    genes = unmapped.select(F.col("gene").alias("original_gene"), F.upper(trimmed(F.col("gene"))).alias("key")).distinct()
    alias = aliases.select(F.upper(trimmed(F.col("alias"))).alias("key"), "protein_id").where(F.col("protein_id").rlike(species))
    hits = genes.join(alias, "key").groupBy("original_gene").agg(F.min("protein_id").alias("protein_id"), F.max("protein_id").alias("other")).where("protein_id = other").drop("other")
    named = hits.join(proteins.select("protein_id", F.col("name").alias("corrected_gene")), "protein_id", "left")
    if approved is not None:
        lookup = first_match(approved.select(F.col("symbol").alias("s__"), F.col("approved").alias("a__")), ["s__"], ["a__"])
        named = named.join(lookup, F.col("corrected_gene") == F.col("s__"), "left").withColumn("corrected_gene", F.coalesce("a__", "corrected_gene"))
    return named.select("original_gene", "protein_id", "corrected_gene")


def corrected(genes: DataFrame, corrections: DataFrame) -> DataFrame:
    """Genes with their corrected names, where there is one."""
    out = genes.join(corrections.select("original_gene", "corrected_gene"), F.col("gene") == F.col("original_gene"), "left")
    return out.withColumn("gene", F.coalesce("corrected_gene", "gene")).drop("original_gene", "corrected_gene")


def _ranked(rows: DataFrame, species: str) -> DataFrame:
    order = W.partitionBy("protein_id").orderBy(F.col("pvalue").asc_nulls_last(), F.abs("logFC").desc_nulls_last(), "input_row")
    return rows.where(F.col("protein_id").rlike(species)).withColumns({"choice": F.row_number().over(order), "candidates": F.count(F.lit(1)).over(W.partitionBy("protein_id"))})


def resolved(rows: DataFrame, species: str = SPECIES) -> DataFrame:
    """Of the rows of a protein the one of least p-value, then greatest change, then first row."""
    return _ranked(rows, species).where("choice = 1").drop("choice", "candidates")


def annotation(rows: DataFrame) -> DataFrame:
    """(protein_id, gene, pvalue, logFC): of the rows of a protein the gene of least p-value, the least p and the mean change, of finite numbers."""
    p, change = only_finite(F.col("pvalue")), only_finite(F.col("logFC"))
    return rows.where("protein_id is not null").groupBy("protein_id").agg(F.min_by("gene", F.struct(F.col("pvalue").isNull(), "pvalue", "input_row")).alias("gene"), F.min(p).alias("pvalue"), F.avg(change).alias("logFC"))


#: How several rows of a protein become one.
POLICY = "minimum_pvalue_then_maximum_abs_logFC_then_input_row"


def summary(initial: DataFrame, final: DataFrame, contract: list[tuple[str, str]] | None = None, species: str = SPECIES) -> DataFrame:
    """(position, metric, value): eleven rows of the mapping, then those of the input contract. initial, final: mapped rows."""
    one = counters(initial).select(*(F.col(c).alias(f"i_{c}") for c in ("total", "mapped", "unmapped", "percent"))).join(F.broadcast(counters(final))).join(F.broadcast(collision_counts(final, species)))
    one = one.join(F.broadcast(resolved(final, species).agg(F.count(F.lit(1)).alias("nodes"))))
    # The metrics' names.
    rows = {
        "input_rows": "i_total", "initial_mapped": "i_mapped", "initial_unmapped": "i_unmapped", "initial_mapped_percent": "i_percent", "final_mapped": "mapped", "final_unmapped": "unmapped", "final_mapped_percent": "percent",
        "STRING_mapping_collision_proteins": "proteins", "STRING_mapping_collision_rows_dropped": "dropped", "STRING_mapping_collision_policy": None, "nodes_in_network": "nodes",
    }
    listed = [(m, F.col(c).cast("string") if c else F.lit(POLICY)) for m, c in rows.items()] + [(m, F.lit(v)) for m, v in contract or []]
    return one.select(F.explode(F.array(*(F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), v.alias("value")) for i, (m, v) in enumerate(listed)))).alias("r")).select("r.*")


def collision_audit(rows: DataFrame, species: str = SPECIES) -> DataFrame:
    """All rows of proteins that several rows map to, and which one was selected."""
    return _ranked(rows, species).where("candidates > 1").withColumn("selected", F.col("choice") == 1).drop("choice")


def collision_counts(rows: DataFrame, species: str = SPECIES) -> DataFrame:
    return _ranked(rows, species).agg(F.count_if((F.col("choice") == 1) & (F.col("candidates") > 1)).alias("proteins"), F.count_if(F.col("choice") > 1).alias("dropped"))


def counters(rows: DataFrame) -> DataFrame:
    """(total, mapped, unmapped, percent)."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count("protein_id").alias("mapped")).select("total", "mapped", (F.col("total") - F.col("mapped")).alias("unmapped"), F.bround(100 * F.col("mapped") / F.col("total"), 1).alias("percent"))


def gene_status(genes: DataFrame, initial: DataFrame, corrections: DataFrame, final: DataFrame) -> DataFrame:
    """One row for each (input_gene, gene): how it was mapped. initial, final: gene, protein_id."""
    first = initial.where("protein_id is not null").select("gene").distinct().withColumn("i__", F.lit(True))
    last = final.where("protein_id is not null").select(F.col("gene").alias("c__")).distinct().withColumn("f__", F.lit(True))
    fixes = first_match(corrections.select(F.col("original_gene").alias("o__"), F.col("corrected_gene").alias("corrected_to")), ["o__"], ["corrected_to"])
    out = genes.select("input_gene", "gene").distinct().join(first, "gene", "left").join(fixes, F.col("gene") == F.col("o__"), "left").join(last, F.col("corrected_to") == F.col("c__"), "left")
    out = out.withColumns({"symbol_category_raw": symbol_class(F.col("gene")), "mapped_initially": F.coalesce("i__", F.lit(False)), "mapped_after_alias": F.coalesce("f__", F.lit(False))})
    out = out.withColumn("final_in_network", F.col("mapped_initially") | F.col("mapped_after_alias")).withColumn("gene_status", mapping_status(F.col("mapped_initially"), F.col("mapped_after_alias"), F.col("symbol_category_raw")))
    hgnc = F.when(F.col("input_gene") != F.col("gene"), F.lit("updated_by_HGNChelper")).otherwise(F.lit("unchanged_after_HGNChelper"))
    return out.select("input_gene", "gene", hgnc.alias("hgnc_status"), symbol_category(F.col("final_in_network"), F.col("gene_status"), F.col("symbol_category_raw")).alias("symbol_category"), "symbol_category_raw", "mapped_initially", "corrected_to", "mapped_after_alias", "final_in_network", "gene_status")


def unmapped_genes(rows: DataFrame) -> DataFrame:
    return rows.where("protein_id is null").select("gene").distinct().orderBy("gene")


def network_links(rows: DataFrame, threshold: int, limit: int = 300) -> DataFrame:
    """(name, url) of the network's pages for the first ids in row order. A report of ``limit`` ids, fixed by the service."""
    first = rows.groupBy("protein_id").agg(F.min("input_row").alias("at")).orderBy("at").limit(limit)
    ids = first.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "protein_id"))), lambda x: x["protein_id"]), "%0d").alias("ids"))
    # Addresses and parameters of the service.
    query = F.concat(F.lit("?identifiers="), F.col("ids"), F.lit(f"&species=9606&required_score={threshold}&network_flavor=evidence"))
    hosts = {"current": "https://string-db.org/cgi/network", "pinned_v12": "https://version-12-0.stringdb.org/cgi/network"}
    return ids.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.concat(F.lit(h), query).alias("url")) for n, h in hosts.items()))).alias("x")).select("x.*")
