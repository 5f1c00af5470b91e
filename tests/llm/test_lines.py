"""Line deduplication and importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from petrel.llm import lines, resample
from petrel.llm.common import PLAIN, Words
from tests.llm import brute, data

ROWS = data.rows()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---------------------------------------------------------------- lines


def kept_lines(rows, least=10):
    key = lambda x: x.strip(" \t\n\v\f\r").translate(brute.LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= least:
                    holders[key(x)].add(i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if i is None or len(h := holders.get(key(x), ())) < 2 or i == min(h)]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def got_lines(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect())


def awkward_lines() -> list[tuple]:
    rng = random.Random(5)
    common = [data.prose(rng, n) for n in (1, 2, 3, 9, 40)]
    odd = ["", " ", "\t", "short", "ten chars!", "TEN CHARS!", " \x0bten Chars!\x0c ", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "ééééééééé", "x\x85 unicode blank  ", "a\x00b\x00c\x00d\x00e\x00f", "  " + "z" * 3000]
    rows = []
    for i in range(60):
        rows.append((i // 2 * 2 if i % 7 == 0 else i, "\n".join(rng.choice(common + odd) for _ in range(rng.randrange(12)))))
    rows += [(None, "\n".join(odd)), (None, None), (70, None), (71, ""), (72, "\n\n\n"), (-5, "ten chars!\n" * 400), (-5, "ten chars!"), (3, rows[3][1]), (3, rows[3][1]), (90, common[4] + "\r\n" + common[4])]
    return rows


@pytest.mark.parametrize("rows", [awkward_lines(), [r[:2] for r in ROWS]], ids=["lines", "texts"])
@pytest.mark.parametrize("group_bytes", [500, 8 << 20])
def test_lines(spark, rows, group_bytes, monkeypatch):
    monkeypatch.setattr(lines, "GROUP_BYTES", group_bytes)
    assert got_lines(lines.deduplicated(frame(spark, rows).repartition(3))) == kept_lines(rows)


def test_lines_clashing_columns_and_empty_table(spark):
    clash = data.docs(spark).withColumns({n: F.lit("x") for n in ("shard", "grp", "first", "n", "keeper", "count", "n_lines")})
    assert got_lines(lines.deduplicated(clash, least=3)) == kept_lines([r[:2] for r in ROWS], 3)
    assert lines.deduplicated(data.empty(spark)).count() == 0
    assert lines.line_index(data.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        lines.deduplicated(data.empty(spark), least=0)


def test_a_hot_line_is_an_entry_a_group(spark, monkeypatch):
    monkeypatch.setattr(lines, "GROUP_BYTES", 2000)
    rng = random.Random(1)
    rows = [(i, "the one line of them all\n" + data.prose(rng, 6) if i % 3 else "the one line of them all") for i in range(3000)]
    dealt = lines._Dealt(frame(spark, rows), "doc_id", "text", lines.LEAST)
    groups = dealt.rows.select("grp").distinct().count()
    sent = dealt.sent.agg(F.sum("n")).first()[0]
    assert groups > 50 and sent <= groups + len({t for _, t in rows})
    assert got_lines(lines.deduplicated(frame(spark, rows))) == kept_lines(rows)


def test_index_is_minimal_and_counts(spark):
    rows = awkward_lines()
    key = lambda x: x.strip(" \t\n\v\f\r").translate(brute.LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 10:
                holders[key(x)].add(i)
    index = lines.line_index(frame(spark, rows)).collect()
    assert sum(r["n"] for r in index) == len(holders)
    keepers = [int(x) for r in index for x in np.frombuffer(r["keeper"], np.int64)]
    assert sorted(keepers) == sorted(min(h) for h in holders.values() if len(h) > 1)
    assert all(len(r["count"]) == r["n"] and len(r["fingerprint"]) == 4 * r["n"] for r in index)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h, h2 = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 1 << 32, n).astype(np.uint32)
    h[: n // 2] = 7  # half of the keys agree in 64 bits
    keys = np.unique(np.stack([h, h2.astype(np.uint64)]), axis=1)
    h, h2 = keys[0], keys[1].astype(np.uint32)
    made = lines.PerfectHash.of(h, h2)
    again = lines.PerfectHash(made.sizes, made.bits)
    assert sorted(again.numbers(h, h2).tolist()) == list(range(len(h)))
    assert sum(made.sizes) <= 64 * 40 + 5 * n


# ---------------------------------------------------------------- resampling


def features(text, order):
    w = brute.plain(text)
    return [" ".join(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]


def drawn(rows, target, order, buckets, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(bucket, features(x, order)))
    for x in target:
        t.update(map(bucket, features(x, order)))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t)))
    out, fit = [], []
    for i, x in rows:
        f = features(x, order)
        weight = sum(gain(bucket(y)) for y in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(brute.plain(x)) >= least:
                fit.append((-score, i, len(f), weight))
        out.append([i, len(f), weight, score, None])
    chosen = {}
    for k, x in enumerate(sorted(fit)[: percent * len(fit) // 100], 1):
        chosen.setdefault(x, []).append(k)
    for o in out:
        if o[3] is not None and chosen.get(x := (-o[3], o[0], o[1], o[2])):
            o[4] = chosen[x].pop(0)
    return Counter(map(tuple, out))


TARGET = [ROWS[9][1], None, "", "alpha1 beta2 beta2 unseen words", ROWS[13][1]]


@pytest.mark.parametrize(("order", "buckets"), [(1, 10_000), (2, 97), (3, 1000), (5, 64)])
def test_resampling(spark, order, buckets, monkeypatch):
    monkeypatch.setattr(resample, "SLICE_BYTES", 3000)
    rng = random.Random(order)
    rows = [r[:2] for r in ROWS if r[0] is None or len(brute.plain(r[1])) >= 20] + [(1000 + i, data.prose(rng, rng.randrange(20, 60))) for i in range(60)]
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    got = resample.resampled(frame(spark, rows).repartition(3), target, order=order, buckets=buckets, percent=30)
    have = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect())
    assert have == drawn(rows, TARGET, order, buckets, 30)


def test_resampling_leaves_short_and_unnamed_rows_undrawn(spark):
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    clash = data.docs(spark).withColumns({n: F.lit("x") for n in ("bucket", "n", "weight", "score", "rank", "n_words")})
    got = resample.resampled(clash, target, percent=100).collect()
    assert len(got) == len(ROWS)
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 1 + sum(i is not None and len(brute.plain(t)) >= 20 for i, t, *_ in ROWS)))
    assert all(r["score"] is None and r["rank"] is None for r in got if r["doc_id"] is None)
    assert resample.resampled(data.empty(spark), target).count() == 0
    alone = resample.resampled(data.docs(spark), target.limit(0)).collect()
    assert len(alone) == len(ROWS)
    with pytest.raises(ValueError):
        resample.resampled(data.empty(spark), target, order=0)


@pytest.mark.parametrize("order", [1, 2, 3, 4, 6])
def test_suffix_array_by_sorting(order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("ab cc d e".split()) for _ in range(rng.randrange(30))) for _ in range(12)] + ["", "ab " * 50]
    raw = "".join(texts).encode()
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = Words(np.frombuffer(raw, np.uint8), bounds, PLAIN, hashed=False)
    number, known = words.numbered()
    flat = [w for t in texts for w in re.findall("[a-z]+", t)]
    assert [known[i].as_py().decode() for i in number.tolist()] == flat
    end = words.first[1:][words.doc]
    array, common = resample.suffixes(number, end, order)
    suffix = [tuple(number[i : min(i + order, end[i])].tolist()) for i in range(len(number))]
    assert [suffix[i] for i in array] == sorted(suffix)
    shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert common.tolist()[1:] == [shared(suffix[a], suffix[b]) for a, b in zip(array, array[1:])]
