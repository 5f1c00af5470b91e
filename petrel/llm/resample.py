"""Operator 12: target-distribution importance resampling over hashed n-grams.

Words of a slice of a partition become numbers (equal where the words are equal), and the
slice a suffix array: places sorted by the next ``order`` words, a text's end before any
word. Where neighbours in it share k words or more, the same k-gram repeats, so the runs of
the common-prefix array enumerate the distinct k-grams; each run is hashed once (CRC-32 of
its words joined by one space, modulo the buckets) and its bucket goes back to every place
in the run. Counts by bucket over the raw and the target table give each bucket's gain, the
scaled logarithm of the ratio of smoothed shares; a text weighs the sum over its features.
Adding a Gumbel noise that hangs on the id alone and taking the greatest scores draws
without replacement in proportion to exp(weight / 1000).

Counts leave a task as one sum for each bucket, so what is shuffled and what the driver
holds is bounded by ``buckets``, a parameter. Ranks are those of a sort by range: no window
or task holds all rows.

A null text has no words and no features. A row of null id is counted as part of the raw
table and weighed, but has neither score nor rank and isn't one of the N. Rows that share
an id are rows like others; equal scores go by id, then by features. Without raw or target
texts the gains follow from the smoothing alone. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from petrel.llm.common import PLAIN, Words, checkpointed, mapped, sliced, table
from petrel.operators.shipping import shipped

ORDER, BUCKETS, SEED, PERCENT, LEAST_WORDS = 1, 10_000, 2024, 10, 20
#: Bytes of text that share a suffix array; a longer text is one of its own.
SLICE_BYTES = 4 << 20


def suffixes(number: np.ndarray, end: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The places sorted by their next ``order`` words (``end``: where a place's text ends), and how many of
    these each has in common with the place before it in that array."""
    n = len(number)
    place, rank, k = np.arange(n), number + 1, 1
    while k < order:
        step = min(k, order - k)
        there = place + step
        second = np.where(there < end, rank[np.minimum(there, n - 1)], 0)
        rank = np.unique(rank * (second.max() + 1) + second, return_inverse=True)[1] + 1
        k += step
    array = np.argsort(rank, kind="stable")
    common, same = np.zeros(n, dtype=np.int64), np.ones(max(n - 1, 0), dtype=bool)
    for k in range(order):
        a, b = array[1:] + k, array[:-1] + k
        same &= (a < end[array[1:]]) & (b < end[array[:-1]])
        same[same] = number[a[same]] == number[b[same]]
        common[1:] += same
    return array, common


def scattered(words: Words, order: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each k up to ``order``: (places, buckets) of all k-grams of a slice, each distinct one hashed once."""
    number, known = words.numbered()
    if not len(number):
        return
    end = words.first[1:][words.doc]
    array, common = suffixes(number, end, order)
    known, crc = known.to_pylist(), zlib.crc32
    for k in range(1, order + 1):
        fits = np.flatnonzero(array + k <= end[array])
        starts = np.flatnonzero(common[fits] < k)
        at = array[fits[starts]]
        if k == 1:
            hashed = [crc(known[i]) for i in number[at].tolist()]
        else:
            hashed = [crc(b" ".join([known[i] for i in number[a : a + k].tolist()])) for a in at.tolist()]
        bucket = np.array(hashed, dtype=np.int64) % buckets
        yield array[fits], np.repeat(bucket, np.diff(np.append(starts, len(fits))))


def bucket_counts(docs: DataFrame, text_col: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, _, raw, bounds in sliced(b.column("text"), SLICE_BYTES):
                for _, bucket in scattered(Words(raw, bounds, PLAIN, hashed=False), order, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])
        pa.default_memory_pool().release_unused()

    shipped(docs.sparkSession)
    return docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, from two tables of counts."""
    s, t = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for into, counts in ((s, raw), (t, target)):
        for r in counts.collect():  # at most a row for each bucket
            into[r["bucket"]] = r["n"]
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(id, n_words, n_features, weight) of each row."""

    def weigh(b: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_features, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, _, raw, bounds in sliced(b.column("text"), SLICE_BYTES):
            words = Words(raw, bounds, PLAIN, hashed=False)
            gained = np.zeros(len(words.start), dtype=np.int64)
            for place, bucket in scattered(words, order, len(gain)):
                gained[place] += gain[bucket]
            total = np.concatenate([[0], np.cumsum(gained)])
            size = np.diff(words.first)
            n_words.append(size)
            n_features.append(sum(np.maximum(size - k, 0) for k in range(order)))
            weight.append(total[words.first[1:]] - total[words.first[:-1]])
        return pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(np.concatenate(x)) for x in (n_words, n_features, weight))], ["id", "n_words", "n_features", "weight"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return mapped(rows, weigh, "id long, n_words long, n_features long, weight long")


def gumbel(id_col: str = "id", seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u between 0 and 1 from the SHA-256 of ``seed:id``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column], percent: int) -> DataFrame:
    """The rows with ``rank``: 1, 2, 3, ... of the first ``percent`` in the order, null for the others.

    Ranges of the order are sorted side by side; a row's place in its range and the sizes of the ranges before give the rank.
    """
    placed = checkpointed(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at__", F.monotonically_increasing_id()))
    part, own = F.shiftright("at__", 33), F.col("at__").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["part__"], r["n"]) for r in placed.groupBy(part.alias("part__")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row for each partition
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    drawn = percent * total // 100
    offsets = rows.sparkSession.createDataFrame(before, "part__ long, before__ long")
    rank = F.col("before__") + F.col("own__") + 1
    return placed.withColumns({"part__": part, "own__": own}).join(F.broadcast(offsets), "part__").withColumn("rank", F.when(rank <= drawn, rank)).drop("part__", "own__", "at__", "before__")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, n_features, weight, score, rank) of each row; those with a rank are drawn."""
    if order < 1 or not 1 <= buckets <= 1 << 20:
        raise ValueError("one word or more a feature, and at most 2**20 buckets")
    gain = gains(bucket_counts(docs, text_col, order, buckets), bucket_counts(target, "text", order, buckets), buckets)
    scored = checkpointed(weighed(docs, gain, id_col, text_col, order).withColumn("score", F.col("weight") + gumbel("id", seed)))
    fit = F.col("id").isNotNull() & (F.col("n_words") >= least_words)
    drawn = ranked(scored.where(fit), [F.desc("score"), F.asc("id"), F.asc("n_features"), F.asc("weight")], percent)
    out = drawn.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
