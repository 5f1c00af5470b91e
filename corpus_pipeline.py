"""A training-data pipeline over ``documents``: five stages of the subpackage's operators.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the
columns of ``documents`` (n_chars counts what a stage has changed anew); the last returns
token ids. Null texts pass. A row is known by a 128-bit digest of its id and text, so rows that
share an id are compared like others, and so are rows of null id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm import bpe, decontaminate, jaccard, pii, toxicity
from petrel.llm.common import checkpointed, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows and spans up to which a side of a join is broadcast; beyond, the join shuffles.
BROADCAST_ROWS, BROADCAST_SPANS = 500_000, 1_000_000


def _row_key():
    """Of a row's id and text; a null differs from an empty value."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(F.col("text").isNull(), "-").otherwise("+"), F.coalesce("text", F.lit(""))))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the cut; the model is trained on these documents' labelled rows."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select(*COLUMNS), model, score_col="score__").where(F.col("score__") < toxicity.CUT).select(*COLUMNS)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document of least id, a null id last; of rows that repeat id and text one."""
    keyed = docs.select(*COLUMNS, F.unhex(_row_key()).alias("key__"))
    linked = jaccard.near_duplicates(keyed.select("key__", "text"), id_col="key__").select("key__", "class_id").distinct()
    ids = keyed.select("key__", "doc_id").distinct()
    first = linked.join(ids, "key__").groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key__")).alias("first")).select("first.key__")
    # copies of a row meet map-side, so no key is hot when the rest is joined
    once = keyed.groupBy("key__").agg(F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("row"))
    return once.join(first, "key__", "left_semi").select("row.*").select(*COLUMNS)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; rows of null id are documents of their own, told apart by their texts."""
    keyed = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), _row_key())).alias("key__"))
    leaks = checkpointed(decontaminate.contained(keyed, table(spark, sf_dir, "benchmark"), id_col="key__").select("key__").distinct())
    return keyed.join(F.broadcast(leaks) if leaks.count() <= BROADCAST_ROWS else leaks, "key__", "left_anti").select(*COLUMNS)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, and terms that disclose it generalised or removed."""
    keyed = docs.select(*COLUMNS, _row_key().alias("key__"))
    found = checkpointed(pii.find(keyed.select("key__", "text"), id_col="key__").where(F.size("spans") > 0).select("key__", "spans").dropDuplicates(["key__"]))
    size = found.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    rows = keyed.join(F.broadcast(found) if size <= BROADCAST_SPANS else found, "key__", "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(pii.sanitised(F.col("text"), F.col("spans")))
    changed = rows.select("doc_id", text.alias("text"), "lang", "source", F.col("n_chars").alias("was"), "spans")
    return changed.select("doc_id", "text", "lang", "source", F.when(F.col("spans").isNull(), F.col("was")).otherwise(F.length("text")).cast("long").alias("n_chars"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of each document."""
    return bpe.encode_texts(docs, *bpe.vocabulary(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("pii", sanitise),
    ("bpe", encode),
]

#: Trained trees, connected components and BPE have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
