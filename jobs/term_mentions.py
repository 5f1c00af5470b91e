"""Stream new texts and keep count of which curated terms they mention.

    python -m jobs.term_mentions --documents D --terms T --output OUT --checkpoint CP [--config jobs/term_mentions.json]

A module's interpretation rests on specific terms; a term that many texts mention says
little. This job reads the texts (``documents``: text, lang, source) as a stream of files,
takes what its checkpoint hasn't seen, and ends when nothing is left. The terms are the
words of curated statements (``terms``: text) with enough letters that the engine's list of
generic terms doesn't hold. Each micro-batch is counted by language, source and term:
texts that mention it, and mentions. From all batches it publishes, partitioned by language,
a row for each term and language with its share of the language's texts; beyond the generic
share a term is marked as too common to be evidence.

Below OUT: ``vocabulary`` (written by the first run and kept, so that all texts are counted
against the same terms; other terms need another OUT and CP), ``counts`` and ``batches``
(partition ``batch``), ``mentions`` and ``published`` (the last batch that it holds). A batch
that is repeated after a failure replaces its own partitions. Null texts are texts without
words; a null language or source is a group of its own.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import found, main, replace_partitions
from petrel.operators.evidence import GENERIC_TERMS as GENERIC
from petrel.operators.evidence import is_generic_term

log = logging.getLogger(__name__)

DEFAULTS = {"least_letters": 6, "generic_share": 0.05, "files_per_batch": 64, "broadcast_terms": 200_000}

VOCABULARY = "term string, statements long"
COUNTS = "source string, term string, documents long, mentions long, lang string, batch long"
BATCHES = "lang string, documents long, batch long"
MENTIONS = "term string, statements long, documents long, mentions long, sources long, share double, too_common boolean, lang string"


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), 0)


def vocabulary(terms: DataFrame, least: int) -> DataFrame:
    """(term, statements that hold it)"""
    each = terms.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return each.where((F.length("term") >= least) & ~is_generic_term(F.col("term"))).groupBy("term").agg(F.count(F.lit(1)).alias("statements"))


def counted(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, term, documents, mentions): mentions are counted by text first, so a text counts once for a term."""
    # rows are numbered before their words become rows
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), "lang", "source", "text")
    each = numbered.select("row", "lang", "source", F.explode(words(F.col("text"))).alias("term"))
    by_text = each.join(terms.select("term"), "term", "left_semi").groupBy("row", "lang", "source", "term").agg(F.count(F.lit(1)).alias("n"))
    return by_text.groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("mentions"))


def exactly(path: str) -> str:
    """A pattern that only this path matches: a stream of files takes a single file, not a folder, only by a pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def publish(spark: SparkSession, output: str, settings: dict) -> None:
    total = found(spark, f"{output}/counts", COUNTS).groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("mentions").alias("mentions"), F.count_distinct("source").alias("named"), F.max(F.col("source").isNull().cast("int")).alias("unnamed"))
    texts = found(spark, f"{output}/batches", BATCHES).groupBy("lang").agg(F.sum("documents").alias("all"))  # a row for each language
    rows = total.join(spark.read.schema(VOCABULARY).parquet(f"{output}/vocabulary"), "term").join(F.broadcast(texts.withColumnRenamed("lang", "of")), F.col("lang").eqNullSafe(F.col("of")))
    share = F.col("documents") / F.col("all")
    out = rows.select("term", "statements", "documents", "mentions", (F.col("named") + F.col("unnamed")).alias("sources"), F.round(share, 9).alias("share"), (share > settings["generic_share"]).alias("too_common"), "lang")
    out.write.mode("overwrite").partitionBy("lang").parquet(f"{output}/mentions")
    log.info("%s: %d rows of terms by language", output, spark.read.schema(MENTIONS).parquet(f"{output}/mentions").count())


def run(spark: SparkSession, documents: str, terms: str, output: str, checkpoint: str, settings: dict | None = None) -> None:
    """Count the texts that are new, then publish, if anything is due."""
    settings = DEFAULTS | (settings or {})
    schema = spark.read.parquet(documents).select("text", "lang", "source").schema
    if found(spark, f"{output}/vocabulary", VOCABULARY).isEmpty():
        vocabulary(spark.read.parquet(terms), settings["least_letters"]).write.mode("overwrite").parquet(f"{output}/vocabulary")
    known = spark.read.schema(VOCABULARY).parquet(f"{output}/vocabulary")
    size = known.count()
    log.info("%s: %d terms", terms, size)
    known = F.broadcast(known) if size <= settings["broadcast_terms"] else known

    def count(batch: DataFrame, number: int) -> None:
        number_of = F.lit(number).cast("long").alias("batch")
        replace_partitions(counted(batch, known).select("*", number_of), f"{output}/counts", "batch")
        replace_partitions(batch.groupBy("lang").agg(F.count(F.lit(1)).alias("documents")).select("*", number_of), f"{output}/batches", "batch")
        log.info("%s: batch %d has %d texts", documents, number, spark.read.schema(BATCHES).parquet(f"{output}/batches").where(F.col("batch") == number).agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0])

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings["files_per_batch"]).parquet(exactly(documents))
    stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    last = found(spark, f"{output}/batches", BATCHES).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
    held = found(spark, f"{output}/published", "batch long").agg(F.max("batch")).first()[0]
    if held == last:
        log.info("%s holds all batches up to %d", output, last)
        return
    publish(spark, output, settings)
    spark.createDataFrame([(last,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{output}/published")


if __name__ == "__main__":
    main(run, "Stream new texts and count which curated terms they mention.", {"documents": "texts", "terms": "curated statements", "output": "folder of the tables", "checkpoint": "folder of the stream's checkpoint"}, DEFAULTS, "term_mentions.json")
