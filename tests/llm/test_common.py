"""Word and window hashes against the words themselves; groups read as a stream."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from petrel.llm.common import PLAIN, SPACED, Words, by_group, sliced
from tests.llm import brute, data


def thue_morse(n: int) -> tuple[str, str]:
    """Two words of n letters whose letters' sums over any odd base agree modulo 2**64 from 1,024 on."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def words_of(texts, table):
    (part,) = sliced(pa.array(texts), 1 << 30)
    return Words(part[2], part[3], table)


@pytest.mark.parametrize("table,find", [(SPACED, lambda t: brute.SPACED.findall(t or "")), (PLAIN, brute.plain)])
def test_words_and_windows(table, find):
    rng = random.Random(3)
    texts = [r[1] for r in data.rows()] + [x for k in (64, 1024, 4096) for x in thue_morse(k)] + [" ".join(rng.choice("ab") * rng.randrange(1, 40) for _ in range(90)) for _ in range(20)]
    words = words_of(texts, table)
    flat, doc = [], []
    for d, t in enumerate(texts):
        flat += find(t)
        doc += [d] * len(find(t))
    assert words.doc.tolist() == doc
    by_hash = {}
    for w, h in zip(flat, words.hash.tolist()):
        assert by_hash.setdefault(h, w) == w
    assert len(by_hash) == len(set(flat))
    assert [words.joined(d).decode() for d in range(len(texts))] == [" ".join(find(t)).replace("\0", "\xff") for t in texts]
    for n in (1, 2, 3, 5, 7, 13, 26):
        at, h = words.windows(n)
        assert at.tolist() == [i for i in range(len(flat) - n + 1) if doc[i] == doc[i + n - 1]]
        seen = defaultdict(set)
        for i, x in zip(at.tolist(), h.tolist()):
            seen[x].add(tuple(flat[i : i + n]))
        assert all(len(v) == 1 for v in seen.values()) and len(seen) == len({tuple(flat[i : i + n]) for i in at.tolist()})


def test_order_of_words_counts():
    """Long arrangements of two words that any sum over powers of an odd base would take for equal."""
    a, b = (" ".join(x) for x in thue_morse(4096))
    words = words_of([a, b], SPACED)
    for n in (1024, 2048, 4096):
        at, h = words.windows(n)
        flat = (a + " " + b).split()
        assert len(set(h.tolist())) == len({tuple(flat[i : i + n]) for i in at.tolist()})


def test_prefixes():
    words = words_of(["alpha alphabet alp", "alphas"], PLAIN)
    at, h = words.prefixes(5)
    assert at.tolist() == [1, 3] and h[0] == h[1]


def test_groups_are_whole_whatever_the_batches(spark):
    rows = [(k, i) for k, n in enumerate([1, 40, 3, 0, 90, 7]) for i in range(n)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:

        def count(t: pa.Table) -> pa.Table:
            k, n = np.unique(t.column("k").to_numpy(), return_counts=True)
            return pa.table({"k": k, "n": n.astype(np.int64)})

        got = by_group(spark.createDataFrame(rows, "k long, i long"), "k", count, "k long, n long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(map(tuple, got)) == [(0, 1), (1, 40), (2, 3), (4, 90), (5, 7)]
