"""Operator 3: chat formatting of reply trees. [native]

Messages point to their parents. Jump tables (a message's ancestor 2**k steps up, with the
sum of scores passed) come from iterative self-joins, so a tree of depth d takes log2(d)
rounds. They give each leaf its path's score; leaves are ranked within their tree, and the
chosen leaves' paths are enumerated by the same tables, from the highest power down. Each
chosen path becomes one conversation.

The template is ``<turn role>\\n text </turn>\\n``. Inside roles and texts ``&`` and ``<``
are written ``&amp;`` and ``&lt;``, so no text can hold a control string, and reading back
undoes it. Loss falls on the texts of the trained role alone.

Nulls: a null text or role is empty; a message of null or unknown parent is a root; a null
tree is a tree of its own; null scores are 0. Messages that share an id, or lie on a cycle
without a root, are an error of the data: ids must be unique and parents acyclic (``linear``
makes such ids for turn tables, where repeated rows and tied turns follow each other in the
order of role and text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.llm.common import checkpointed, table

OPEN, CLOSE = "<turn ", "</turn>\n"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def turn(role: Column, text: Column) -> Column:
    """One formatted turn; an end of line in a role is written &#10;, so the role ends at the first one."""
    return F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit("\n"), F.lit("&#10;")), F.lit("\n"), escaped(text), F.lit(CLOSE))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    turns = F.filter(F.split(formatted, "</turn>\n", -1), lambda t: t != "")

    def parse(t: Column) -> Column:
        cut = F.locate("\n", t)
        role = F.substring(t, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        return F.struct(unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n"))).alias("role"), unescaped(F.substring(t, cut + 1, F.length(t))).alias("text"))

    return F.transform(turns, parse)


def linear(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A turn table as reply trees: each turn answers the one before it.

    Ids are (conversation, place) packed as text, so they need no global numbering.
    """
    order = W.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    named = turns.select(turns[conv_col].alias("tree"), turns[turn_col].alias("turn"), turns[role_col].cast("string").alias("role"), turns[text_col].cast("string").alias("text"))
    placed = named.withColumn("place", F.row_number().over(order)).drop("turn")
    name = lambda p: F.concat_ws(":", F.coalesce(F.col("tree").cast("string"), F.lit("null")), p.cast("string"))
    return placed.select("tree", name(F.col("place")).alias("id"), F.when(F.col("place") > 1, name(F.col("place") - 1)).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables (id, up, gain): the ancestor 2**k steps up, and the scores from there down to, not with, the node."""
    known = nodes.select(F.col("id").alias("up"))
    first = nodes.where("parent is not null").select("id", F.col("parent").alias("up"), "score").join(known, "up", "left_semi").select("id", "up", F.col("score").alias("gain"))
    tables = [checkpointed(first)]
    while not tables[-1].isEmpty():
        if len(tables) > 40:
            raise ValueError("parents form a cycle")
        a, b = tables[-1].alias("a"), tables[-1].alias("b")
        tables.append(checkpointed(a.join(b, F.col("a.up") == F.col("b.id")).select("a.id", F.col("b.up").alias("up"), (F.col("a.gain") + F.col("b.gain")).alias("gain"))))
    return tables[:-1]


def branches(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(leaf, tree, rank, path_score, turns array<struct<depth, role, text>>) of each tree's best root-to-leaf paths.

    ``messages``: tree, id, parent, role, text, score. ``keep=None`` keeps all branches. A path's score is the
    sum of its messages' scores; ties go to the smaller leaf id.
    """
    nodes = messages.select("tree", "id", "parent", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))
    ids = checkpointed(nodes.select("tree", "id", "parent", "score"))
    jumps = _jumps(ids)
    parents = ids.where("parent is not null").select(F.col("parent").alias("id")).distinct()
    leaves = ids.join(parents, "id", "left_anti").select("tree", F.col("id").alias("leaf"), F.col("id").alias("at"), F.lit(0).alias("depth"), F.col("score").alias("sum"), F.lit(0.0).alias("gain"))
    # climb from each leaf: at the end of the descent over powers its root is reached
    top = leaves
    for k in reversed(range(len(jumps))):
        j = jumps[k].select(F.col("id").alias("jid"), "up", F.col("gain").alias("jgain"))
        top = top.join(j, F.col("at") == F.col("jid"), "left").select("tree", "leaf", F.coalesce("up", "at").alias("at"), (F.col("depth") + F.when(F.col("up").isNotNull(), F.lit(2**k)).otherwise(F.lit(0))).alias("depth"), (F.col("gain") + F.coalesce("jgain", F.lit(0.0))).alias("gain"))
    root = ids.select(F.col("id").alias("rid"), F.col("score").alias("rscore"))
    scored = top.join(root, F.col("at") == F.col("rid")).select("tree", "leaf", "depth", (F.col("gain") + F.col("rscore")).alias("path_score"))
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(F.col("path_score").desc(), "leaf")))
    chosen = checkpointed(ranked if keep is None else ranked.where(F.col("rank") <= keep))
    # every offset up to the depth is a sum of powers: each table adds, beside a member, the one so far above it
    members = chosen.select("leaf", F.struct(F.col("leaf").alias("at"), F.lit(0).alias("off")).alias("m"))
    for k, table_k in reversed(list(enumerate(jumps))):
        j = table_k.select(F.col("id").alias("jid"), "up")
        above = F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("at"), (F.col("m.off") + 2**k).alias("off")))
        members = members.join(j, F.col("m.at") == F.col("jid"), "left").select("leaf", F.explode(F.array_compact(F.array("m", above))).alias("m"))
    members = members.select("leaf", "m.at", "m.off")
    texts = nodes.select(F.col("id").alias("nid"), "role", "text")
    filled = members.join(texts, F.col("at") == F.col("nid")).groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct((-F.col("off")).alias("depth"), "role", "text"))).alias("turns"))
    return chosen.select("leaf", "tree", "rank", "path_score").join(filled, "leaf")


def formatted(paths: DataFrame) -> DataFrame:
    """Adds ``formatted``: the turns in the template, joined."""
    return paths.withColumn("formatted", F.array_join(F.transform("turns", lambda t: turn(t["role"], t["text"])), ""))


def loss_text(turns: Column, trained: str = TRAINED) -> Column:
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == trained), lambda t: t["text"]), "")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(probe).alias("text"))
    out = formatted(branches(linear(turns.unionByName(extra))))
    back = out.select(F.col("tree").alias("conv_id"), "formatted", read_back(F.col("formatted")).alias("t"))
    loss = loss_text(F.col("t"))
    return back.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
