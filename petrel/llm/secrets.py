"""Operator 5: secret scans over an incremental blob ledger.

Every historical version of a path is addressed by its content (SHA-256). The ledger, a
table that outlives the run, keeps for each blob which rule versions have scanned it and
what they found. A run loads it, scans only blob and rule-version pairs that it lacks,
each distinct blob once however many paths and versions carry it, appends what it found,
and joins the table's findings back to all paths.

A null text is an empty one (its blob is that of no bytes). Null or repeated path ids
are paths like others, a repeated one with a version in each row: one row out for each
row in. Letters "in either case" are ASCII letters only. An append that is repeated
after a failure repeats rows, which changes nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import mapped, table
from petrel.operators.checkpoints import shared_folder


@dataclass(frozen=True)
class Rule:
    """``gate``: one of these must occur in the text (lower-cased if ``fold``), or the pattern isn't tried."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    gate: tuple[str, ...] = ()
    fold: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(word: str) -> str:
    """A pattern of the word's ASCII letters in either case; a flag would let in two letters beyond ASCII."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])

#: In the order in which kinds sort at equal starts; the first three are the base.
RULES = (
    Rule("assign", 1, rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1, ("passw", "secret", "token", "api"), True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 20, 0, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", 0, 0, ("PRIVATE KEY",)),
    Rule("forge_token", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 0, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat_token", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, ("xox",)),
    Rule("web_token", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{5,}", 0, 0, ("eyJ",)),
    Rule("maps_key", 1, r"\bAIza[0-9A-Za-z_-]{35}", 0, 0, ("AIza",)),
    Rule("payment_key", 1, r"\b[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", 0, 0, ("k_live_", "k_test_")),
)
BASE = 3

SPANS = "array<struct<start:int,rank:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))


def scanner(rules: tuple[Rule, ...]) -> Callable[[str, set[str]], list[dict]]:
    """A function of (text, keys of the rules to try) to spans, leftmost and non-overlapping per kind."""
    compiled = [(r, re.compile(r.pattern)) for r in rules]

    def scan(text: str, todo: set[str]) -> list[dict]:
        folded, out = None, []
        for rank, (rule, pattern) in enumerate(compiled):
            if rule.key not in todo:
                continue
            if rule.gate:
                if rule.fold and folded is None:
                    folded = text.lower()
                where = folded if rule.fold else text
                if not any(g in where for g in rule.gate):
                    continue
            out += [{"start": m.start(), "rank": rank, "end": m.end()} for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return out

    return scan


def versions(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob, text): content addresses of every row."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[path_col].alias("path"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"), text.alias("text"))


def scan_unseen(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, scanned array<string>, spans) for the pairs that the ledger lacks.

    Copies are dropped before the shuffle as far as a task sees them, then after it, so a blob that a third
    of all paths carry reaches its task once from each map task.
    """
    blobs = paths.select("blob", "text").dropDuplicates(["blob"])
    keys = [r.key for r in rules]
    todo = F.array(*map(F.lit, keys))
    if ledger is None:
        blobs = blobs.select("blob", "text", todo.alias("todo"))
    else:
        seen = ledger.select("blob", F.explode("scanned").alias("key")).groupBy("blob").agg(F.collect_set("key").alias("seen"))
        blobs = blobs.join(seen, "blob", "left").select("blob", "text", F.array_except(todo, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        scan = scanner(rules)
        spans = [scan(t.as_py(), set(k.as_py())) for t, k in zip(b.column(1), b.column(2))]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(2).cast(pa.list_(pa.string())), pa.array(spans, _SPANS)], ["blob", "scanned", "spans"])

    return mapped(blobs, run, f"blob binary, scanned array<string>, spans {SPANS}")


def findings(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """(path, spans) for every path: what any run found in its blob."""
    if "spans" not in ledger.columns:
        raise ValueError("a ledger has columns blob, scanned and spans")
    found = ledger.where(F.size("spans") > 0).select(F.col("blob").alias("b"), F.explode("spans").alias("span")).groupBy("b").agg(F.sort_array(F.collect_set("span")).alias("spans"))
    return paths.select("path", "blob").join(found, F.col("blob") == F.col("b"), "left").select("path", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


LEDGER = f"blob binary, scanned array<string>, spans {SPANS}"


def load(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger table at a path; None if it is not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(LEDGER).parquet(path)


def scan(paths: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, spans) for every path, after the ledger at ``path`` has got what it lacked of these blobs and rules."""
    spark = paths.sparkSession
    scan_unseen(paths, load(spark, path), rules).write.mode("append").parquet(path)
    return findings(paths, load(spark, path))


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, rank: int) -> Column:
    """Spans of one kind. A lambda with a second parameter, be it a default, would get the index."""
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a ledger of this run's own: what another run has scanned would hide the work from whoever measures it
    found = scan(versions(table(spark, sf_dir, "documents")), f"{shared_folder(spark)}/blob_ledger/{uuid.uuid4().hex}")
    kinds = [r.kind for r in RULES]
    base = F.filter("spans", lambda s: s["rank"] < BASE)
    return found.select(
        F.col("path").alias("doc_id"),
        *(counted("spans", k).alias(f"n_{RULES[k].kind}") for k in range(BASE)),
        F.sha2(joined(base, kinds).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans"), kinds).alias("spans"),
    )
