"""The jobs over growing input, cut off and run again; on copies of small tables."""

from __future__ import annotations

import json
import math
import os
import re
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobs import case_table, common, term_mentions

GENES, GROUPS = "s_suppkey long, s_name string, s_nationkey long", "n_nationkey long, n_name string"
LINES = "l_orderkey long, l_suppkey long, l_returnflag string"


def more_lines(spark, folder, rows):
    spark.createDataFrame(rows, LINES).coalesce(1).write.mode("append").parquet(f"{folder}/lines")


@pytest.fixture
def case(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(i, f"GENE{i}" if i % 3 else f"RPS{i}", i % 2 if i != 4 else None) for i in range(6)], GENES).write.parquet(f"{d}/genes")
    spark.createDataFrame([(0, "one"), (1, "two")], GROUPS).write.parquet(f"{d}/groups")
    more_lines(spark, d, [(k, k % 5, "RANO"[k % 4]) for k in range(200)] + [(None, 1, "R"), (7, None, "R"), (8, 2, None)])
    return d


def run_case(spark, d, **settings):
    case_table.run(spark, f"{d}/lines", f"{d}/genes", f"{d}/groups", f"{d}/out", settings)
    return genes_of(spark, d)


def genes_of(spark, d):
    return {r["gene_id"]: r.asDict() for r in spark.read.schema(case_table.GENES).parquet(f"{d}/out/genes").collect()}


def counts_of(spark, d):
    rows = spark.read.parquet(f"{d}/lines").where("l_orderkey is not null and l_suppkey is not null").collect()
    return Counter((r["l_suppkey"], r["l_returnflag"]) for r in rows)


def holds_all(spark, d, genes):
    counts = counts_of(spark, d)
    assert {g: (r["case"], r["control"]) for g, r in genes.items()} == {g: (counts[g, "R"], counts[g, "A"]) for g in {g for g, f in counts if f in ("R", "A")}}


def test_case_table_takes_only_what_is_new(spark, case):
    first = run_case(spark, case)
    holds_all(spark, case, first)
    files = {f for _, _, names in os.walk(f"{case}/out") for f in names}
    assert run_case(spark, case) == first and {f for _, _, names in os.walk(f"{case}/out") for f in names} == files
    more_lines(spark, case, [(k, k % 5, "R") for k in range(200, 260)])
    second = run_case(spark, case)
    holds_all(spark, case, second)
    marks = sorted((r["after"], r["upto"], r["lines"]) for r in spark.read.parquet(f"{case}/out/marks").collect())
    assert marks == [(-(1 << 63), 199, 202), (199, 259, 60)]
    one = second[1]
    assert one["logFC"] == round(math.log2((one["case"] + 1) / (one["control"] + 1)), 9) and one["module"] == "two" and second[4]["module"] is None
    assert second[3]["entity_class"] == "ribosomal" and second[3]["eligibility"] == "excluded_from_automatic_priority"


def test_case_table_after_being_cut_off(spark, case, monkeypatch):
    """Before its mark, a run leaves sums that count nowhere; after it, what is due is published by the next."""
    run_case(spark, case)
    more_lines(spark, case, [(300, 1, "R"), (301, 2, "A")])

    def cut(*a, **b):
        raise RuntimeError("cut off")

    real = case_table.replace_partitions
    monkeypatch.setattr(case_table, "replace_partitions", lambda rows, path, *by: real(rows, path, *by) if path.endswith("sums") else cut())
    with pytest.raises(RuntimeError):
        run_case(spark, case)
    monkeypatch.undo()
    more_lines(spark, case, [(302, 1, "R")])
    monkeypatch.setattr(case_table, "publish", cut)
    with pytest.raises(RuntimeError):
        run_case(spark, case)
    monkeypatch.undo()
    holds_all(spark, case, run_case(spark, case))


def test_case_table_of_nothing_and_of_bad_genes(spark, case):
    d = f"{case}/empty"
    spark.createDataFrame([], LINES).write.parquet(f"{d}/lines")
    case_table.run(spark, f"{d}/lines", f"{case}/genes", f"{case}/groups", f"{d}/out")
    assert genes_of(spark, d) == {}
    spark.createDataFrame([(i, "same", 0) for i in range(6)], GENES).write.parquet(f"{d}/genes")
    with pytest.raises(Exception, match="duplicate_gene"):
        case_table.run(spark, f"{case}/lines", f"{d}/genes", f"{case}/groups", f"{case}/out2")
    out = run_case(spark, case, case=["N"], control=["O"], fdr=1.0, top_genes=1)
    assert {r["case"] for r in out.values()} and all(len(r["top_genes"].split(";")) == 1 for r in spark.read.parquet(f"{case}/out/modules").collect())


TEXTS = "doc_id long, text string, lang string, source string"
STATEMENTS = ["Leukocyte migration, collagen", "collagen matrix; signaling", None, "Éléments collagènes short"]


def more_texts(spark, folder, rows):
    spark.createDataFrame(rows, TEXTS).coalesce(1).write.mode("append").parquet(f"{folder}/texts")


def mentions(rows, share):
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    known = Counter(w for s in STATEMENTS for w in set(words(s)) if len(w) >= 6 and w != "signaling")
    docs, count, sources = Counter(), Counter(), {}
    for _, t, lang, source in rows:
        w = words(t)
        for x in set(w) & set(known):
            docs[x, lang] += 1
            count[x, lang] += w.count(x)
            sources.setdefault((x, lang), set()).add(source)
    texts = Counter(r[2] for r in rows)
    return {(x, lang): (known[x], n, count[x, lang], len(sources[x, lang]), round(n / texts[lang], 9), n / texts[lang] > share) for (x, lang), n in docs.items()}


def run_terms(spark, d, **settings):
    term_mentions.run(spark, f"{d}/texts", f"{d}/terms", f"{d}/out", f"{d}/checkpoint", settings)
    rows = spark.read.schema(term_mentions.MENTIONS).parquet(f"{d}/out/mentions").collect()
    assert len({(r["term"], r["lang"]) for r in rows}) == len(rows)
    return {(r["term"], r["lang"]): (r["statements"], r["documents"], r["mentions"], r["sources"], r["share"], r["too_common"]) for r in rows}


@pytest.fixture
def corpus(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(s,) for s in STATEMENTS], "text string").write.parquet(f"{d}/terms")
    return d


ROWS = [(1, "Collagen and collagen; MIGRATION", "en", "a"), (2, "collagen", "en", None), (3, None, "en", "a"), (4, "", None, "b"), (5, "matrix collagènes éléments", "fr", "b"), (6, "matrix", None, None), (7, "signaling short", "en", "a")]
MORE = [(8, "leukocyte collagen", "en", "c"), (9, "matrix matrix", "de", "c")]


def test_term_mentions_stream_only_new_files(spark, corpus):
    more_texts(spark, corpus, ROWS)
    spark.createDataFrame(MORE, TEXTS).write.parquet(f"{corpus}/texts-of-others")
    first = run_terms(spark, corpus)
    assert first == mentions(ROWS, 0.05) and len(first) >= 5
    assert run_terms(spark, corpus) == first
    assert spark.read.parquet(f"{corpus}/out/batches").select("batch").distinct().count() == 1
    more_texts(spark, corpus, MORE)
    more_texts(spark, corpus, ROWS[:1])  # a file of repeated rows is new texts
    assert run_terms(spark, corpus, files_per_batch=1) == mentions(ROWS + MORE + ROWS[:1], 0.05)
    assert spark.read.parquet(f"{corpus}/out/batches").select("batch").distinct().count() == 3


def test_term_mentions_after_being_cut_off(spark, corpus, monkeypatch):
    """A batch that failed between its two writes is repeated and replaces its partitions."""
    more_texts(spark, corpus, ROWS)
    run_terms(spark, corpus, generic_share=0.3)
    more_texts(spark, corpus, MORE)
    real, calls = term_mentions.replace_partitions, []

    def cut(rows, path, *by):
        if path.endswith("batches"):
            raise RuntimeError("cut off")
        calls.append(path)
        real(rows, path, *by)

    monkeypatch.setattr(term_mentions, "replace_partitions", cut)
    with pytest.raises(Exception, match="cut off"):
        run_terms(spark, corpus, generic_share=0.3)
    monkeypatch.undo()
    assert calls and run_terms(spark, corpus, generic_share=0.3, broadcast_terms=0) == mentions(ROWS + MORE, 0.3)


def test_term_mentions_read_one_file_and_no_rows(spark, corpus):
    import glob

    more_texts(spark, corpus, ROWS)
    (file,) = glob.glob(f"{corpus}/texts/*.parquet")
    term_mentions.run(spark, file, f"{corpus}/terms", f"{corpus}/one", f"{corpus}/one-checkpoint")
    assert spark.read.parquet(f"{corpus}/one/mentions").count() == len(mentions(ROWS, 0.05))
    spark.createDataFrame([], TEXTS).write.parquet(f"{corpus}/none/texts")
    term_mentions.run(spark, f"{corpus}/none/texts", f"{corpus}/terms", f"{corpus}/none/out", f"{corpus}/none/checkpoint")
    assert spark.read.schema(term_mentions.MENTIONS).parquet(f"{corpus}/none/out/mentions").count() == 0


def test_configuration(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"fdr": 0.1}))
    assert common.configuration(case_table.DEFAULTS, str(path)) == case_table.DEFAULTS | {"fdr": 0.1}
    path.write_text(json.dumps({"fdrs": 0.1}))
    with pytest.raises(ValueError, match="fdrs"):
        common.configuration(case_table.DEFAULTS, str(path))
    for job in (case_table, term_mentions):
        name = job.__name__.split(".")[1]
        assert common.configuration(job.DEFAULTS, f"{os.path.dirname(job.__file__)}/{name}.json") == job.DEFAULTS


def test_jobs_import_nothing_of_the_training_data_operators():
    told = subprocess.run([sys.executable, "-c", "import sys, jobs.queries; print([m for m in sys.modules if m.startswith('petrel.llm') or m == 'corpus_pipeline'])"], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert told.stdout.strip() == "[]"


@pytest.mark.parametrize("by_partition", [False, True])
def test_settings_of_the_session_stay(spark, case, by_partition):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    common.replace_partitions(spark.range(3).select("id", F.lit(1).alias("after")), f"{case}/p", "after")
    if by_partition:
        common.replace_partitions(spark.range(2).select("id", F.lit(2).alias("after")), f"{case}/p", "after")
    assert spark.read.parquet(f"{case}/p").count() == (5 if by_partition else 3)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
