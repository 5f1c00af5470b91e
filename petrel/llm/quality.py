"""Operator 4: quality rules whose thresholds are learned for each language and source.

Each text is measured once. A mergeable quantile sketch of every measure is kept for
each language and source: a table of counts by logarithmic bucket (32 buckets for each
power of two, so a quantile is right to about 3 %). Sketches merge by adding counts;
they depend neither on the order nor on the partitions of the rows. The fence of a
measure lies some spreads beyond a quantile of its group, the spread being the distance
between two quantiles, or, where the usual texts are all alike, what one event more (a
symbol, a line, a window, a hundredth of a character) makes in a text of the group's
median size. No fixed cutoff takes part. A join applies the fences to the rows.

Null texts are empty (no word: they fail the base rules). Null languages and sources
form groups of their own. A group with too few rows takes the fences of its language,
else those of all rows. Empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from petrel.llm.common import SPACED, Words, checkpointed, mapped, sliced, table

#: Base rules: least words; most percent of words in repeated 5-word windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Rows from which a group has fences of its own.
LEAST_ROWS = 50


@dataclass(frozen=True)
class Fence:
    """``part`` of ``whole``, in units of 1 / ``scale``; rejected beyond the quantile ``high`` by ``reach`` spreads.

    The spread is the distance from the quantile ``middle`` to ``high``, or what ``event`` parts more make in a
    text of median size. ``below``: also rejected as far beneath ``middle``.
    """

    part: str
    whole: str
    scale: int
    event: int
    middle: float
    high: float
    reach: int
    below: bool = False


#: Shares are mostly zero, with a tail: that of symbols is made by other texts, which quartiles don't see; those of
#: repeats are usual at times, so their fences start far up.
FENCES = {
    "symbol_share": Fence("n_symbols", "word_chars", 10_000, 1, 0.25, 0.75, 6),
    "dup_line_share": Fence("n_dup_lines", "n_lines", 10_000, 1, 0.5, 0.99, 2),
    "repeat_share": Fence("n_repeat_words", "n_words", 10_000, 5, 0.5, 0.99, 2),
    "word_len": Fence("word_chars", "n_words", 100, 1, 0.25, 0.75, 8, True),
}
SIZES = ["n_words", "n_lines", "word_chars"]
MEASURES = [*FENCES, *SIZES]

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def repeated_words(words: Words, n: int = 5) -> np.ndarray:
    """Which words lie in a window of n words that its text holds twice or more."""
    at, h = words.windows(n)
    doc = words.doc[at]
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16) if len(words.first) <= 1 << 16 else doc[order], kind="stable")]
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    size = len(words.hash) + 1
    return np.cumsum(np.bincount(at[twice], minlength=size) - np.bincount(at[twice] + n, minlength=size))[:-1] > 0


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word; those equal to an earlier one."""
    if not text or "\n" not in text:
        return int(bool(text and text.strip(" \t\n\x0b\x0c\r"))), 0
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, lang, source, counts) of every whole text."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        column, counts = b.column(3), []
        for i, j, raw, bounds in sliced(column):
            words = Words(raw, bounds, SPACED)
            lines = [_lines(column[d].as_py()) for d in range(i, j)]
            covered = np.concatenate([[0], np.cumsum(repeated_words(words), dtype=np.int64)])
            counts.append(
                np.column_stack(
                    [
                        np.diff(words.first),
                        _per_text(((raw & 0xC0) != 0x80) & (SPACED[raw] != 0), bounds),
                        _per_text(_SYMBOLS[raw], bounds),
                        [x for x, _ in lines],
                        [x for _, x in lines],
                        np.diff(covered[words.first]),
                    ]
                ).astype(np.int64)
            )
        all_counts = np.concatenate(counts) if counts else np.zeros((0, len(_COUNTS)), np.int64)
        return pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(all_counts[:, k]) for k in range(len(_COUNTS)))], [id_col, "lang", "source", *_COUNTS])

    src = docs.select(docs[id_col], docs[lang_col].cast("string").alias("lang"), docs[source_col].cast("string").alias("source"), docs[text_col].cast("string").alias("text"))
    return mapped(src, run, f"`{id_col}` {dict(src.dtypes)[id_col]}, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS))


def _share(part: str, whole: str, scale: int) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"({part} * {scale}) div {whole}")).otherwise(F.lit(0)).cast("long")


def with_measures(counts: DataFrame) -> DataFrame:
    return counts.withColumns({m: _share(f.part, f.whole, f.scale) for m, f in FENCES.items()})


def bucket_of(value: Column) -> Column:
    """Bucket of a whole number from 0 on: exact below 64, then 32 buckets for each power of two."""
    e = F.greatest(F.lit(0), F.length(F.bin(value)) - 6)
    return (e * 64 + F.call_function("shiftright", value, e)).cast("int")


def bucket_floor(bucket: Column) -> Column:
    return F.call_function("shiftleft", (bucket % 64).cast("long"), F.floor(bucket / 64).cast("int"))


def sketch(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """(keys, measure, bucket, n): partial counts meet, so a hot key costs a row for each bucket and map task."""
    stacked = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket_of(F.col(m)).alias("bucket")) for m in measures)))
    return rows.select(*keys, stacked.alias("x")).select(*keys, "x.*").groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups (or of several runs) as the sums of finer ones."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """(keys, measure, total, one column for each name of ``at``); quantiles are whole hundredths."""
    # a sketch has a few hundred buckets at most, whatever it has counted
    one = W.partitionBy(*keys, "measure")
    upto = sketches.withColumns({"upto__": F.sum("n").over(one.orderBy("bucket")), "total": F.sum("n").over(one)})
    least = lambda q: bucket_floor(F.min(F.when(F.col("upto__") * 100 >= F.col("total") * round(100 * q), F.col("bucket"))))
    return upto.groupBy(*keys, "measure").agg(F.max("total").alias("total"), *(least(q).alias(name) for name, q in at.items()))


def thresholds(sketches: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row for each language and source: <measure>_hi and, for measures with a lower fence, <measure>_lo."""
    at = {f"q{round(100 * q)}": q for q in sorted({0.5, *(q for f in FENCES.values() for q in (f.middle, f.high))})}
    levels = []
    for keys in (["lang", "source"], ["lang"], []):
        q = quantiles(merged(sketches, keys), keys, at)
        wide = [F.max("total").alias(f"rows_{len(keys)}")]
        for m, f in FENCES.items():
            of = lambda c, m=m: F.max(F.when(F.col("measure") == m, F.col(c)))
            high, middle = of(f"q{round(100 * f.high)}"), of(f"q{round(100 * f.middle)}")
            step = F.floor(F.lit(f.event * f.scale) / F.greatest(of("q50", f.whole), F.lit(1)))
            spread = F.greatest(high - middle, step, F.lit(1))
            wide.append((high + f.reach * spread).alias(f"{m}_hi_{len(keys)}"))
            if f.below:
                wide.append((middle - f.reach * spread).alias(f"{m}_lo_{len(keys)}"))
        levels.append(q.groupBy(*(F.col(k).alias(f"{k}_{len(keys)}") for k in keys)).agg(*wide))
    fine, by_lang, everything = levels
    both = fine.join(by_lang, F.col("lang_2").eqNullSafe(F.col("lang_1")), "left").join(F.broadcast(everything))
    names = [f"{m}_hi" for m in FENCES] + [f"{m}_lo" for m, f in FENCES.items() if f.below]
    pick = lambda c: F.when(F.col("rows_2") >= least_rows, F.col(f"{c}_2")).when(F.col("rows_1") >= least_rows, F.col(f"{c}_1")).otherwise(F.col(f"{c}_0"))
    return both.select(F.col("lang_2").alias("t_lang"), F.col("source_2").alias("t_source"), *(pick(c).alias(c) for c in names))


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds base_failed and kept. A hot source is a skewed key of the join only if the limits are too many to broadcast."""
    out = rows.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_lang", "t_source")
    passes = F.lit(True)
    for m, f in FENCES.items():
        passes &= F.col(m) <= F.col(f"{m}_hi")
        if f.below:
            passes &= F.col(m) >= F.col(f"{m}_lo")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(passes, F.lit(True)))


def quality(docs: DataFrame, least_rows: int = LEAST_ROWS, **columns: str) -> DataFrame:
    """(id, lang, source, counts, measures, base_failed, kept) of every row."""
    rows = with_measures(checkpointed(measured(docs, **columns)))
    # rows that fail the base rules don't shape what is usual
    usual = rows.where(f"n_words >= {LEAST_WORDS} and 100 * n_repeat_words <= {MOST_REPEATED} * n_words")
    # the sketches are read for three levels of groups
    return judged(rows, thresholds(checkpointed(sketch(usual, ["lang", "source"], MEASURES)), least_rows))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
