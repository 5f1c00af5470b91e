"""The pipeline's stages against brute force, on awkward rows and on a small table of the driver's."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from petrel.llm import bpe, pii, toxicity
from petrel.llm.queries import QUERIES
from tests.llm import brute, data

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = data.docs(spark, extra=False)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, data.rows()[11][1]), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_keep_the_columns(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == before.dtypes, name
            assert docs.count() <= before.count()
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_empty_tables_and_clashing_columns(spark, folder, stage):
    name, run = corpus_pipeline.STAGES[stage]
    assert run(spark, data.empty(spark), folder).count() == 0
    plain, clashing = (run(spark, data.docs(spark, extra=extra), folder) for extra in (False, True))
    assert clashing.dtypes == plain.dtypes
    assert sorted(map(str, clashing.collect())) == sorted(map(str, plain.collect()))


def test_near_duplicates_keep_one_of_each_class(spark, folder):
    rows = [(i, t) for i, t, *_ in data.rows()]
    classes = brute.near(rows)
    kept = corpus_pipeline.remove_near_duplicates(spark, data.docs(spark, extra=False), folder).collect()
    ids = {r["doc_id"] for r in kept}
    assert ids == {i for (i, _), (c, _) in zip(rows, classes) if i == c} | {None}
    assert len({(r["doc_id"], r["text"]) for r in kept}) == len(kept)
    # of the two rows of null id one is a copy
    assert [r["text"] for r in kept if r["doc_id"] is None] == [None]


def test_near_copies_that_share_an_id_go(spark, folder):
    """Of a repeated id only the row goes that is a near copy, be it of another document or of a row of the same id."""
    rng = random.Random(4)
    a, b, c, d = (data.prose(rng, 80) for _ in range(4))
    rows = [(3, a), (9, a + " tail"), (9, b), (7, c), (7, c + " tail"), (7, d), (7, d), (8, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s1", len(t or "")) for i, t in rows], data.SCHEMA)
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.remove_near_duplicates(spark, docs, folder).collect()), key=str)
    assert len(kept) == 6 and {(3, a), (9, b), (7, d), (8, None), (8, "")} < set(kept) and ((7, c) in kept) != ((7, c + " tail") in kept)


def test_rows_without_id_are_compared(spark, tmp_path):
    """Copies, near copies and leaks go whether or not they have an id; repeats of one row leave one."""
    rng = random.Random(9)
    a, b, c, item = (data.prose(rng, 80) for _ in range(4))
    rows = [(None, a), (None, a + " tail"), (5, a), (None, b), (None, b), (None, b + " end"), (None, c), (6, f"{c} {item}"), (None, f"{b} {c} {item}"), (None, None), (None, None), (None, ""), (None, item), (8, item)]
    docs = spark.createDataFrame([(i, t, "en", "s1", len(t or "")) for i, t in rows], data.SCHEMA)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.remove_near_duplicates(spark, docs, "").collect()]
    assert len(kept) == 8 and (5, a) in kept and (8, item) in kept and (None, None) in kept and (None, "") in kept
    assert sum(t in (b, b + " end") for _, t in kept) == 1
    d = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    clean = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.remove_benchmark_leaks(spark, docs, d).collect()), key=str)
    assert clean == sorted((r for r in rows if item not in (r[1] or "")), key=str)


def test_leaks_go(spark, folder):
    rows = [(i, t) for i, t, *_ in data.rows()]
    leaks = {d for d, *_ in brute.leaks(rows, [(1, data.rows()[11][1]), (2, None)])}
    kept = corpus_pipeline.remove_benchmark_leaks(spark, data.docs(spark, extra=False), folder).collect()
    unnamed = {t for k, (_, t) in enumerate(rows) if rows[k][0] is None and brute.leaks([(1, t)], [(1, data.rows()[11][1]), (2, None)])}
    assert leaks and sorted(str(r["doc_id"]) for r in kept) == sorted(str(i) for i, t in rows if i not in leaks and (i is not None or t not in unnamed))


def test_personal_data_goes(spark, folder):
    out = corpus_pipeline.sanitise(spark, data.docs(spark, extra=False), folder)
    assert out.count() == len(data.rows())
    for r in out.collect():
        if r["text"] is not None:
            assert not any(k == 0 for _, k, _, _ in brute.personal(r["text"])) and (r["n_chars"] == len(r["text"]) or "[" not in r["text"])


def test_toxic_documents_go(spark, folder):
    docs = data.docs(spark, extra=False)
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = toxicity.scored(docs, model).where(F.col("score") < toxicity.CUT).count()
    assert corpus_pipeline.remove_toxic(spark, docs, folder).count() == want


def test_run_against_brute_force(spark, tmp_path):
    """The whole chain in plain Python: scores of the trained model, classes by all pairs, exact containment, spans replaced one by one, ids of whole texts."""
    import pyarrow as pa

    from tests.llm.test_corpus import hot

    rng = random.Random(21)
    rows = [(i, t) for i, t in hot(5)]
    item = data.prose(rng, 40)
    rows += [(200, f"{data.prose(rng, 60)} {item} {data.prose(rng, 60)}"), (201, item.upper()), (202, f"{data.prose(rng, 30)} write to a.b@corp.example or +1 (499) 555-6503 {data.prose(rng, 30)}"), (203, ""), (204, None), (205, "4111 1111 1111 1111")]
    rows += [(300 + i, f"{data.prose(rng, 30)} {'you blorgish idiot ' if i % 3 == 0 else ''}{data.prose(rng, 30)}") for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], data.SCHEMA)
    labels = spark.createDataFrame([(300 + i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    model = toxicity.train(docs, labels)
    scores = model.score(pa.array([t for _, t in rows], pa.string()))
    kept = [r for r, x in zip(rows, scores) if x < toxicity.CUT]
    assert 30 <= len(rows) - len(kept) <= 45
    kept = [(i, t) for (i, t), (c, _) in zip(kept, brute.near(kept)) if i == c]
    leaks = {x for x, *_ in brute.leaks(kept, [(1, item)])}
    kept = [(i, t) for i, t in kept if i not in leaks]
    assert leaks == {200, 201}

    def clean(text):
        out, done = [], 0
        for a, k, _, b in brute.personal(text):
            if a >= done:
                out += [text[done:a], f"[{pii.KINDS[k].upper()}]"]
            done = max(done, b)
        return "".join(out) + text[done:]

    codec = bpe.Codec.get(*bpe.vocabulary())
    want = {i: codec.encoding.encode_ordinary(clean(t or "")) for i, t in kept}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, d).collect()}
    assert got == want and len(got) > 100


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
def test_run_is_its_stages(spark):
    docs = corpus_pipeline.table(spark, SMALL, "documents")
    texts = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        texts = stage(spark, texts, SMALL)
    codec = bpe.Codec.get(*bpe.vocabulary())
    want = {r["doc_id"]: codec.encoding.encode_ordinary(r["text"] or "") for r in texts.collect()}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == want and 0 < len(got) < docs.count()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_with_stable_columns(spark, name):
    out = QUERIES[name](spark, SMALL)
    n = out.count()
    assert n > 0 and "doc_id" in out.columns or "conv_id" in out.columns
    if name not in ("op3_chat_format", "op7_benchmark_decontamination"):
        assert n == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_sanitised_overlaps(spark):
    df = spark.createDataFrame([("abcdefgh", [(0, 0, 3), (2, 4, 5), (6, 5, 8)]), ("x", []), ("Zoë k4 75011 zoë", [(0, 4, 3), (4, 4, 6), (7, 4, 12), (13, 4, 16)])], f"t string, s {pii.SPANS}")
    assert [r[0] for r in df.select(pii.sanitised(F.col("t"), F.col("s"))).collect()] == ["[EMAIL]f", "x", "[PROPER NOUN] [CODE] [NUMBER] [WORD]"]
