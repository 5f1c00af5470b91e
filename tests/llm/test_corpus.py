"""Operators that compare documents, against brute force: awkward rows, hot groups, empty tables, clashing columns."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from petrel.llm import chat, decontaminate, jaccard, substrings
from petrel.operators.components import components
from tests.llm import brute, data

ROWS = data.rows()
PAIRS = [(r[0], r[1]) for r in ROWS]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def hot(seed: int) -> list[tuple[int, str]]:
    """A third exact copies of one text, a family of near copies, and a passage that many share."""
    rng = random.Random(seed)
    one, two, passage = data.prose(rng, 50).split(), data.prose(rng, 120).split(), data.prose(rng, 30)
    rows = [" ".join(one)] * 40
    for _ in range(40):
        w = two[:]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(999)}"
        rows.append(" ".join(w))
    rows += [f"{data.prose(rng, 40)} {passage} {data.prose(rng, 30)}" for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("window", [3, 5, 13])
def test_substrings(spark, window):
    got = substrings.deduplicated(data.docs(spark), window=window)
    have = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect())
    assert have == Counter(brute.deduplicated(PAIRS, window))
    assert substrings.deduplicated(data.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_substrings_of_hot_groups(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP_BYTES", 4000)  # so that there are some dozen groups
    rows = hot(seed)
    got = substrings.deduplicated(frame(spark, rows).repartition(5))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()) == Counter(brute.deduplicated(rows))


def test_levels_double_until_nothing_survives(spark):
    rng = random.Random(11)
    shared, passage = data.prose(rng, 160), data.prose(rng, 900)
    rows = [(1, shared), (2, "start " + shared + " end"), (3, data.prose(rng, 50)), (4, " ".join(shared.split()[:20]) + " other"), (5, passage), (6, passage), (7, f"{data.prose(rng, 3)} {passage}")]
    got = {r["doc_id"]: r["longest"] for r in substrings.deduplicated(frame(spark, rows)).collect()}
    assert got == {1: 104, 2: 104, 3: 0, 4: 13, 5: 832, 6: 832, 7: 832}


def test_every_place_is_looked_at_without_anchors(spark):
    """A passage of a length beyond the first is found wherever its anchor lies."""
    rng = random.Random(21)
    rows, want = [], {}
    for k in range(30):
        n = rng.choice([20, 25, 26, 27, 40, 51, 52, 60])
        passage = " ".join(f"k{k}w{rng.randrange(10**6)}" for _ in range(n))
        for i in (2 * k, 2 * k + 1):
            rows.append((i, f"{data.prose(rng, 9)} a{i} {passage} b{i} {data.prose(rng, 9)}"))
            want[i] = 13 if n < 26 else 26 if n < 52 else 52
    got = {r["doc_id"]: r["longest"] for r in substrings.deduplicated(frame(spark, rows), anchored=False).collect()}
    assert got == want
    anchored = {r["doc_id"]: r["longest"] for r in substrings.deduplicated(frame(spark, rows)).collect()}
    assert all(anchored[i] <= want[i] for i in want) and anchored != want


def test_removal_compares_words(spark):
    """Words, and arrangements of words, whose letters' sums agree are kept apart."""
    from tests.llm.test_common import thue_morse

    rng = random.Random(3)
    shared = data.prose(rng, 12)
    rows = [(1, f"{shared} {thue_morse(1024)[0]}"), (2, f"{shared} {thue_morse(1024)[1]}"), (3, " ".join(thue_morse(2048)[0])), (4, " ".join(thue_morse(2048)[1]))]
    for window in (13, 40):
        got = substrings.deduplicated(frame(spark, rows), window=window)
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()) == Counter(brute.deduplicated(rows, window))


@pytest.mark.parametrize("rows", [PAIRS, hot(1), hot(2)], ids=["awkward", "hot1", "hot2"])
def test_jaccard(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)  # so that subtrees and families are split
    got = jaccard.near_duplicates(frame(spark, rows))
    have = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got.collect())
    assert have == Counter((i, *x) for (i, _), x in zip(rows, brute.near(rows)))


def test_jaccard_without_broadcast_and_on_nothing(spark):
    rows = hot(3)
    got = jaccard.near_duplicates(frame(spark, rows), broadcast_rows=0)
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got.collect()) == Counter((i, *x) for (i, _), x in zip(rows, brute.near(rows)))
    assert jaccard.near_duplicates(data.empty(spark)).count() == 0
    assert jaccard.near_duplicates(data.docs(spark)).count() == len(ROWS)


def test_prefixes_are_shortened_to_the_recall():
    assert jaccard.least_depth(0.8, 0.5) == jaccard.DEPTH
    for recall in (0.9, 0.999, 0.99999):
        d = jaccard.least_depth(0.8, recall)
        assert 1 - (1 - 0.8**d) ** jaccard.TREES >= recall
        assert d == jaccard.DEPTH or 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES < recall


def test_recall_by_band_of_similarity(spark):
    """All links of some thousand pairs between 0.8 and 1, most of them near the threshold; close copies meet deeper than distant ones."""
    rng = random.Random(12)
    rows, pairs = [], []
    for k in range(900):
        w = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 160))]
        other = w[:]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            other[rng.randrange(len(w))] = "edited"
        cut = rng.randrange(0, max(1, len(w) // 6))
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(other[cut:]))]
        a, b = brute.shingles(rows[-2][1]), brute.shingles(rows[-1][1])
        pairs.append(len(a & b) / len(a | b))
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    bands, depths = defaultdict(list), defaultdict(list)
    for k, x in enumerate(pairs):
        if x >= 0.8:
            bands[int(x * 20 + 1e-9)].append(got[2 * k]["n_links"] == 1 and got[2 * k]["class_id"] == got[2 * k + 1]["class_id"])
            if x < 1:  # equal texts are one node
                depths[x > 0.9].append(got[2 * k]["depth"])
        else:
            assert got[2 * k]["n_links"] == 0
    assert all(len(v) >= 20 for k, v in bands.items() if k < 20) and sum(map(len, bands.values())) > 300
    assert {k: sum(v) / len(v) for k, v in bands.items()} == dict.fromkeys(bands, 1.0)
    assert sum(depths[True]) / len(depths[True]) > sum(depths[False]) / len(depths[False])


def test_links_compare_words(spark):
    """Long words and periodic texts whose letters' and words' sums agree: no hash decides a link."""
    from tests.llm.test_common import thue_morse

    rng = random.Random(2)
    a, b = thue_morse(1024)
    x, y = (" ".join(z) for z in thue_morse(2048))
    rest = data.prose(rng, 3)
    rows = list(enumerate([f"{a} {rest} {a}", f"{b} {rest} {b}", x, y, " ".join([a] * 40), " ".join([b] * 40), " ".join([a] * 41)]))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == brute.near(rows)
    assert [len(x) for x in jaccard._numbered([b"a b a b a b a", b"", b"x", b"b a b a b"], 5)] == [2, 0, 0, 1]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 60)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["label"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def items_of(rng):
    return [(k, data.prose(rng, n)) for k, n in enumerate([3, 5, 6, 9, 16, 31, 59])] + [(None, data.prose(rng, 20)), (50, None), (51, "")]


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_containment(spark, broadcast_rows):
    rng = random.Random(6)
    items = items_of(rng)
    docs = list(PAIRS)
    for k, (_, t) in enumerate(items):
        w = (t or "").split()
        for cut in (0, 1, 3):
            if cut:
                w = w[:-1] + ["broken"] if len(w) > 6 else w
            docs.append((500 + 10 * k + cut, f"{data.prose(rng, 300)} {' '.join(w)} {data.prose(rng, 300)}"))
    docs += [(900, "!".join((items[4][1] + " " + items[6][1]).upper().split()))]
    got = decontaminate.contained(frame(spark, docs).withColumn("item_id", F.lit("clash")), frame(spark, items).withColumnRenamed("doc_id", "item_id"), broadcast_rows=broadcast_rows)
    have = {(r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in got.collect()}
    assert have == brute.leaks(docs, items) and len(have) > 10


def test_containment_of_nothing(spark):
    items = frame(spark, items_of(random.Random(6))).withColumnRenamed("doc_id", "item_id")
    assert decontaminate.contained(data.empty(spark), items).count() == 0
    assert decontaminate.contained(data.docs(spark), items.limit(0)).count() == 0


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a < b & c </turn>\n <turn user>\n"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 5, "assistant", "\\### Assistant: &lt; &amp;lt;"), (2, 5, "assistant", "tie"), (2, 5, "assistant", "tie"), (2, None, "user", "first"),
    (None, 1, "user", "no conversation"), (3, 1, None, "no role"), (3, 2, "assistant", "😀 é"), (4, 1, "role\nof two lines", "x"),
]


def test_chat_round_trip(spark):
    long = [(9, k, ["user", "assistant"][k % 2], f"turn {k}") for k in range(70)]
    turns = spark.createDataFrame(TURNS + long, "conv_id long, turn long, role string, text string").withColumns({"tree": F.lit(1), "id": F.lit(2), "place": F.lit(3), "up": F.lit(4)})
    out = chat.formatted(chat.branches(chat.linear(turns)))
    back = {r["tree"]: [(x["role"], x["text"]) for x in r["t"]] for r in out.select("tree", chat.read_back(F.col("formatted")).alias("t")).collect()}
    want = defaultdict(list)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for r in sorted(TURNS + long, key=order):
        want[r[0]].append((r[2] or "", r[3] or ""))
    assert back == dict(want)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.branches(chat.linear(none)).count() == 0


def test_chat_trees_rank_branches(spark):
    rng = random.Random(8)
    rows, parent = [], {}
    for t in range(3):
        for k in range(30):
            i = f"{t}:{k}"
            parent[i] = None if k == 0 else f"{t}:{rng.randrange(k)}"
            rows.append((t, i, parent[i], ["user", "assistant"][k % 2], f"text {i}", None if k == 4 else float(rng.randrange(5))))
    rows.append((7, "x", "unknown", "user", "orphan", 1.0))
    score = {r[1]: r[5] or 0.0 for r in rows}
    text = {r[1]: r[4] for r in rows}
    inner = {p for p in parent.values() if p}
    want = defaultdict(list)
    for tree, i, *_ in rows:
        if i not in inner:
            path, x = [], i
            while x in text:
                path.append(x)
                x = parent.get(x)
            want[tree].append((-sum(score[p] for p in path), i, [text[p] for p in reversed(path)]))
    messages = spark.createDataFrame(rows, "tree int, id string, parent string, role string, text string, score double")
    for keep in (1, 2, None):
        got = defaultdict(list)
        for r in chat.branches(messages, keep).collect():
            got[r["tree"]].append((-r["path_score"], r["leaf"], [x["text"] for x in r["turns"]]))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:keep] for k, v in want.items()}
