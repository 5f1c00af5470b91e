"""Keep a case's gene table current as measurement lines arrive.

    python -m jobs.case_table --lines L --genes G --groups M --output OUT [--config jobs/case_table.json]

The engine starts from a table of genes with a log fold change and a raw p-value. This job
makes one from lines that each count one observation of a gene (``l_suppkey``) under the
case or the control condition (``l_returnflag``), numbered by a key that only grows
(``l_orderkey``). A run takes the lines beyond the high-water mark, sums them by gene, and
adds the sums to those of earlier runs; the lines before the mark are never read again (the
key's filter reaches the scan). From all sums it makes log2((case + 1) / (control + 1)), the
hypergeometric tail of the gene's case lines among all lines, its Benjamini-Hochberg value,
the gene's entity class and eligibility, checks the input contract, and publishes the genes
partitioned by module and a row for each module.

Below OUT: ``sums`` (partition ``after``: the mark from which a run went on), ``marks`` (the
same partitions: the key a run came to and the lines it took), ``genes``, ``modules`` and
``published`` (the mark that these two hold). A run writes its sums, then its mark, then what
it publishes. If it is cut off before the mark, the next run goes on from the same mark and
replaces the same partition; if after it, the next run publishes what is due. Sums without a
mark are not counted. Lines of null key, gene or condition, or of another condition, count
nowhere; genes without any line have no row. Lines must not arrive with keys at or below a
mark that has been taken.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import found, main, replace_partitions
from petrel.functions import columns as C
from petrel.functions import stats
from petrel.sources import contract

log = logging.getLogger(__name__)

DEFAULTS = {"case": ["R"], "control": ["A"], "fdr": 0.05, "top_genes": 12}

SUMS = "gene_id long, case long, control long, after long"
MARKS = "upto long, lines long, after long"
GENES = "gene_id long, gene string, case long, control long, logFC double, pvalue double, fdr double, entity_class string, eligibility string, module string"
MODULES = "module string, genes long, significant_up long, significant_down long, mean_logFC double, direction string, top_genes string"


def take_new(spark: SparkSession, lines: str, output: str, settings: dict) -> int | None:
    """Sum the lines beyond the mark by gene; returns the mark by now, null if there never was a line."""
    mark = found(spark, f"{output}/marks", MARKS).agg(F.max("upto")).first()[0]
    after = -(1 << 63) if mark is None else mark
    new = spark.read.parquet(lines).where(F.col("l_orderkey") > after)
    seen = new.agg(F.max("l_orderkey").alias("upto"), F.count(F.lit(1)).alias("lines")).first()
    if seen["upto"] is None:
        log.info("%s: no line beyond %s", lines, mark)
        return mark
    flag = F.col("l_returnflag")
    counted = new.where((F.col("l_orderkey") <= seen["upto"]) & F.col("l_suppkey").isNotNull() & flag.isin(*settings["case"], *settings["control"]))
    sums = counted.groupBy(F.col("l_suppkey").cast("long").alias("gene_id")).agg(F.count_if(flag.isin(*settings["case"])).alias("case"), F.count_if(flag.isin(*settings["control"])).alias("control"))
    replace_partitions(sums.withColumn("after", F.lit(after)), f"{output}/sums", "after")
    replace_partitions(spark.createDataFrame([(seen["upto"], seen["lines"], after)], MARKS), f"{output}/marks", "after")
    log.info("%s: %d lines beyond %s, up to %d", lines, seen["lines"], mark, seen["upto"])
    return seen["upto"]


def gene_table(sums: DataFrame, genes: DataFrame, groups: DataFrame) -> DataFrame:
    """GENES of (gene_id, case, control) sums, one row for each gene that has any."""
    all_lines = sums.agg(F.sum("case").alias("all_case"), F.sum(F.col("case") + F.col("control")).alias("all_lines"))
    named = genes.select(F.col("s_suppkey").cast("long").alias("gene_id"), F.col("s_name").alias("gene"), F.col("s_nationkey").alias("n_nationkey"))
    module = groups.select("n_nationkey", F.col("n_name").alias("module"))
    rows = sums.join(named, "gene_id").join(module, "n_nationkey", "left").join(F.broadcast(all_lines))  # one row
    tested = rows.select(
        "gene_id", "gene", "case", "control", "module",
        F.round(F.log2((F.col("case") + 1.0) / (F.col("control") + 1.0)), 9).alias("logFC"),
        F.round(stats.hypergeometric_tail("`case`", "all_case", "all_lines", "`case` + control"), 9).alias("pvalue"),
    )
    adjusted = stats.adjusted(tested, "pvalue", "fdr").withColumn("fdr", F.round("fdr", 9))
    return adjusted.withColumn("entity_class", C.entity_class(F.col("gene"))).withColumn("eligibility", C.eligibility(F.col("entity_class")))


def module_table(genes: DataFrame, settings: dict) -> DataFrame:
    sure = F.col("fdr") <= settings["fdr"]
    by = genes.groupBy("module").agg(
        F.count(F.lit(1)).alias("genes"), F.count_if(sure & (F.col("logFC") > 0)).alias("significant_up"), F.count_if(sure & (F.col("logFC") < 0)).alias("significant_down"),
        F.round(F.avg("logFC"), 6).alias("mean_logFC"), C.top_list(F.col("gene"), F.col("logFC"), settings["top_genes"]).alias("top_genes"),
    )
    return by.withColumn("direction", C.direction(F.col("mean_logFC")))


def publish(spark: SparkSession, genes: str, groups: str, output: str, settings: dict) -> None:
    done = found(spark, f"{output}/marks", MARKS).select("after")
    sums = found(spark, f"{output}/sums", SUMS).join(F.broadcast(done), "after", "left_semi")  # a row for each run
    total = sums.groupBy("gene_id").agg(F.sum("case").alias("case"), F.sum("control").alias("control"))
    table = gene_table(total, spark.read.parquet(genes), spark.read.parquet(groups)).select(*(f.split()[0] for f in GENES.split(", ")))
    table.write.mode("overwrite").partitionBy("module").parquet(f"{output}/genes")
    written = spark.read.schema(GENES).parquet(f"{output}/genes")
    contract.require_valid(written.select(F.col("gene_id").alias("input_row"), "gene", "logFC", "pvalue"))
    modules = module_table(written, settings).select(*(f.split()[0] for f in MODULES.split(", ")))
    modules.coalesce(1).write.mode("overwrite").parquet(f"{output}/modules")  # a row for each module
    log.info("%s: %d genes in %d modules", output, written.count(), spark.read.parquet(f"{output}/modules").count())


def run(spark: SparkSession, lines: str, genes: str, groups: str, output: str, settings: dict | None = None) -> None:
    """Take what is new and publish it, if anything is due."""
    settings = DEFAULTS | (settings or {})
    mark = take_new(spark, lines, output, settings)
    held = found(spark, f"{output}/published", "upto long").agg(F.max("upto")).first()[0]
    if mark is not None and mark == held:
        log.info("%s holds all up to %s", output, mark)
        return
    publish(spark, genes, groups, output, settings)
    spark.createDataFrame([(mark,)], "upto long").coalesce(1).write.mode("overwrite").parquet(f"{output}/published")


if __name__ == "__main__":
    main(run, "Keep a gene table current as measurement lines arrive.", {"lines": "measurement lines", "genes": "genes with their module's key", "groups": "modules' names", "output": "folder of the tables"}, DEFAULTS, "case_table.json")
