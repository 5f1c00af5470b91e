"""Column expressions and the input contract on literal values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from petrel.functions import columns as C
from petrel.functions import quantiles, stats
from petrel.operators import diff, enrich, evidence, mapping, score, texts
from petrel.sources import contract, sinks


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_ranks_by_ranges_equal_those_of_one_window(spark):
    import random

    from petrel.operators import score

    rng = random.Random(1)
    rows = [(i, f"g{i % 7}", float(rng.randrange(9)), float(rng.randrange(30)), rng.choice([None, 1.0, 2.0, 5.0]), rng.random(), float(rng.randrange(5)), rng.randrange(4) / 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, gene string, degree double, betweenness double, stress_centrality double, abs_logFC double, neg_log10_pvalue double, candidate_score double")
    one, many = (sorted(map(tuple, score.ranked(df, one_task=n).collect())) for n in (10_000, 10))
    assert one == many and sorted(r[-1] for r in one) == list(range(1, 401))


def test_numbers_and_names(spark):
    got = values(spark, [("1,5",), (" -2.0",), ("bad",), (None,)], "x string", C.as_number(F.col("x")))
    assert [g[0] for g in got] == [1.5, -2.0, None, None]
    got = values(spark, [("﻿ Gene Symbol ",), ("log2-FC",), ("P.Value",)], "x string", C.clean_name(F.col("x")))
    assert [g[0] for g in got] == ["genesymbol", "log2fc", "pvalue"]


@pytest.mark.parametrize(("x", "want"), [([5.0, 10.0, 15.0, None], [0, 0.5, 1, None]), ([2.0, 2.0, None], [1, 1, None]), ([None, float("nan"), float("inf")], [None, None, None])])
def test_minmax(spark, x, want):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double")
    assert [r[0] for r in C.with_minmax(df, {"m": F.col("x")}).orderBy("i").select("m").collect()] == want
    assert [r[0] for r in df.withColumn("m", C.minmax(F.col("x"))).orderBy("i").select("m").collect()] == want


def test_ranks_and_levels(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3.0, 1.0, 3.0, None, 2.0])], "i int, x double")
    assert [r[0] for r in df.withColumn("r", C.rank_desc(F.col("x"))).orderBy("i").select("r").collect()] == [1, 4, 1, None, 3]
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 10)], "x double")
    got = {r["x"]: r["l"] for r in C.levels(df, {"l": F.col("x")}).collect()}
    assert got == {1: "low_below_median", 2: "low_below_median", 4: "medium_above_median", 10: "very_high_top_10_percent"}


def test_lists_and_text(spark):
    df = spark.createDataFrame([("B", 1), ("A", 4), ("A", 3), ("C", 2)], "g string, s int")
    assert df.agg(C.top_list(F.col("g"), F.col("s"), 3)).first()[0] == "A;C"
    assert values(spark, [("abcdefghijklmnopqrstuvwxyz",), ("short",), (None,)], "x string", C.truncated(F.col("x"), 10)) == [("abcdefg...",), ("short",), ("",)]
    assert values(spark, [(" tp53, EGFR|tp53/x ",)], "x string", C.gene_list(F.col("x"))) == [(["TP53", "EGFR", "X"],)]
    assert values(spark, [(123456.0,), (0.00123456,), (0.0,)], "x double", C.significant(F.col("x"), 4)) == [(123500.0,), (0.001235,), (0.0,)]


@pytest.mark.parametrize(
    ("symbol", "entity", "ready"),
    [("LOC102723407", "predicted_LOC", "network_evidence_only"), ("IGLL5", "immunoglobulin_locus", "network_evidence_only"), ("TRBC1", "T_cell_receptor_locus", "network_evidence_only"), ("RPS4Y1", "Y_chromosome_associated", "excluded_from_automatic_priority"), ("RPS6", "ribosomal", "excluded_from_automatic_priority"), (" cd34", C.CANONICAL, "review_ready_canonical"), ("", "unknown", "manual_review_required")],
)
def test_entities(spark, symbol, entity, ready):
    assert values(spark, [(symbol,)], "x string", C.entity_class(F.col("x")), C.eligibility(C.entity_class(F.col("x")))) == [(entity, ready)]


def test_symbols(spark):
    want = {"": "empty_symbol", "TRAF2": "t_cell_receptor_locus", "HLA-DRP1": "HLA_gene", "LINC01": "non_coding_or_predicted_locus", "ABC-AS1": "antisense_locus", "GENEP2": "pseudogene_like_symbol", "EGFR": "standard_gene_symbol", None: "empty_symbol"}
    got = values(spark, [(k,) for k in want], "x string", C.symbol_class(F.col("x")))
    assert [g[0] for g in got] == list(want.values())


def test_hypergeometric_and_adjustment(spark):
    rng = random.Random(4)
    cases = [(3, 5, 10, 3), (0, 5, 10, 3), (4, 3, 10, 3), (9, 9, 9, 9)]
    for _ in range(60):
        n = rng.randrange(10, 3000)
        k, d = rng.randrange(n + 1), rng.randrange(n + 1)
        cases.append((rng.randrange(min(k, d) + 1), k, n, d))
    got = values(spark, cases, "x long, k long, n long, d long", stats.hypergeometric_tail("x", "k", "n", "d"))
    for (x, k, n, d), (p,) in zip(cases, got):
        true = sum(math.comb(k, i) * math.comb(n - k, d - i) for i in range(x, min(k, d) + 1) if d - i <= n - k) / math.comb(n, d)
        assert p == pytest.approx(true, rel=1e-12, abs=1e-300)
    p = [0.01, 0.04, 0.03, 0.5, 0.03]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(p)], "g int, i int, p double")
    got = [r[0] for r in df.withColumn("a", stats.benjamini_hochberg(F.col("p"), ["g"], [F.col("i")])).orderBy("i").select("a").collect()]
    order = sorted(range(5), key=lambda i: -p[i])
    want, low = [0.0] * 5, 1.0
    for rank, i in zip(range(5, 0, -1), order):
        low = min(low, p[i] * 5 / rank)
        want[i] = low
    assert got == pytest.approx(want)


def test_hypergeometric_tails_of_a_large_background(spark):
    """Against exact rationals, from far in the upper tail to below the mean."""
    from fractions import Fraction

    n, cases, true = 20_000, [], []
    for k, d in ((300, 500), (5000, 9000), (10_000, 10_000), (19_900, 40), (3, 19_000), (12_000, 15_000)):
        mean, low, top = d * k // n, max(0, d + k - n), min(k, d)
        deviation = math.isqrt(d * k * (n - k) // (n * n)) + 1
        places = sorted({x for x in (mean - 6 * deviation, mean - 1, mean, mean + 1, mean + deviation, mean + 5 * deviation, mean + 20 * deviation, top) if low < x <= top})
        whole = math.comb(n, d)
        term, tail, by_place = math.comb(k, top) * math.comb(n - k, d - top), 0, {}
        for i in range(top, min(places) - 1, -1):  # neighbours' ratio, in whole numbers
            tail += term
            by_place[i] = tail
            if i > low:
                term = term * i * (n - k - d + i) // ((k - i + 1) * (d - i + 1))
        for x in places:
            cases.append((x, k, n, d))
            true.append(float(Fraction(by_place[x], whole)))
    got = values(spark, cases, "x long, k long, n long, d long", stats.hypergeometric_tail("x", "k", "n", "d"))
    assert len(cases) > 30
    for c, (p,), t in zip(cases, got, true):
        assert p == pytest.approx(t, rel=1e-12, abs=1e-300), c


@pytest.mark.parametrize("tests", [None, "m"])
def test_adjustment_by_ranges(spark, tests):
    """The same as by windows, with ties that many rows share, null p-values, null families and more ranges than values in some."""
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0.0, 1.0, 0.25, *(rng.randrange(1, 2000) / 2000 for _ in range(9))]), 5000) for _ in range(1500)] + [("c", 0.5, 5000), ("d", None, 5000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, g string, p double, m long")
    read = lambda family, limit: {r["i"]: r["a"] for r in stats.adjusted(df, "p", "a", family, tests, one_task=limit).collect()}
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for family in ([], ["g"]):
            ranges, windows = read(family, 0), read(family, 10**9)
            assert ranges == windows and len(ranges) == len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)


def test_enrichment_counts_annotated_members_only(spark):
    ids = [f"P{i}" for i in range(1, 12)]
    terms = spark.createDataFrame([(i, "c", "t1", "leukocyte migration") for i in ids[:5]] + [(i, "c", "t2", "unrelated process") for i in ids[5:10]], "id string, category string, term string, description string")
    ask = lambda *q: enrich.enriched(terms, spark.createDataFrame([("q", i) for i in q], "query_name string, id string"), spark.createDataFrame([(i,) for i in ids], "id string")).collect()
    (r,) = ask("P1", "P2", "P3")
    assert (r["number_of_genes"], r["background_size"]) == (3, 10) and r["pvalue"] == pytest.approx(1 / 12) and r["fdr"] == pytest.approx(1 / 6)
    assert [(r["query_size"], r["background_size"]) for r in ask("P1", "P2", "P11")] == [(2, 10)]
    assert ask("P1", "P11") == []


@pytest.mark.parametrize("per_query", [False, True])
def test_enrichment_broadcasts_single_rows_only(spark, per_query):
    """Sides that grow with the input are never sent to the driver, however small a file's size makes them look; terms out of bounds have no row."""
    terms = spark.range(15).selectExpr("concat('P', id % 12) AS id", "'c' AS category", "if(id < 12, 'many', 'few') AS term", "'d' AS description")
    queries = spark.range(4).selectExpr("'q' AS query_name", "concat('P', id) AS id")
    background = terms.select("id").distinct()
    background = background.withColumn("query_name", F.lit("q")) if per_query else background
    out = enrich.enriched(terms, queries, background, most_term=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    (r,) = out.collect()
    assert (r["term"], r["number_of_genes"], r["query_size"], r["background_size"], r["protein_ids"]) == ("few", 3, 4, 12, "P0;P1;P2")


def test_candidate_score(spark):
    rows = [(1, 1.0, 0.1, 0.0, 0.5, 1.0), (2, 2.0, 0.2, 3.0, 1.0, 2.0), (3, 4.0, 0.5, 8.0, 2.0, 4.0)]
    df = spark.createDataFrame(rows, "id int, degree double, betweenness double, stress_centrality double, abs_logFC double, neg_log10_pvalue double")
    got = {r["id"]: r["candidate_score"] for r in score.scored(df).collect()}
    topology = (1 / 3 + 0.25 + math.log(4) / math.log(9)) / 3
    assert got == {1: 0, 2: pytest.approx((topology + 1 / 3 + 1 / 3) / 3), 3: 1}
    with pytest.raises(Exception, match="not finite"):
        score.scored(df.withColumn("stress_centrality", F.when(F.col("id") != 2, F.col("stress_centrality")))).collect()


@pytest.mark.parametrize("reverse", [False, True])
def test_collisions(spark, reverse):
    rows = [(7, "9606.P1", 0.01, 1.5), (3, "9606.P1", 0.01, -3.0), (5, "9606.P2", 0.2, 2.0), (9, None, 0.5, 1.0), (8, "9606.P3", 0.01, 2.0), (2, "9606.P3", 0.01, -2.0)]
    df = spark.createDataFrame(rows[::-1] if reverse else rows, "input_row int, protein_id string, pvalue double, logFC double")
    assert sorted(r["input_row"] for r in mapping.resolved(df).collect()) == [2, 3, 5]
    assert tuple(mapping.collision_counts(df).first()) == (2, 2)
    assert {(r["input_row"], r["selected"]) for r in mapping.collision_audit(df).collect()} == {(3, True), (7, False), (2, True), (8, False)}


def test_contract():
    assert contract.separator("a;b,c;d") == ";" and contract.separator("a\tb") == "\t"
    assert contract.source_columns(["﻿Gene Symbol", "log2-FC", "P.Value"])["gene"].endswith("Gene Symbol")
    for header in (["gene", "symbol", "logfc", "pvalue"], ["gene", "logfc", "padj"], ["gene"]):
        with pytest.raises(contract.ContractError):
            contract.source_columns(header)
    for name in ("", "a b", "con", "x.", "-x", "a" * 65):
        with pytest.raises(contract.ContractError):
            contract.case_id(name)
    assert contract.case_from_path("/in/my case.csv") == "my_case"


@pytest.mark.parametrize(("rows", "rule"), [([(1, "A", "1", "0"), (2, " ", "1", "0")], "empty_gene"), ([(1, "A", "x", "0")], "logFC"), ([(1, "A", "1", "NaN")], "pvalue_not"), ([(1, "A", "1", "1.1")], "out_of"), ([(1, "A", "1", "0"), (2, "a", "1", "0")], "duplicate_gene: rows 1, 2")])
def test_contract_violations(spark, rows, rule):
    df = contract.typed(spark.createDataFrame(rows, "input_row int, gene string, logFC string, pvalue string"))
    with pytest.raises(contract.ContractError, match=rule):
        contract.require_valid(df)


def test_signatures(spark):
    y = ["RPS4Y1", "EIF1AY", "KDM5D", "ZFY", "DDX3Y", "UTY", "USP9Y"]
    mods = spark.createDataFrame([(1, y), (2, y[:2] + ["A", "B", "C"]), (3, [f"MT-{i}" for i in range(5)]), (4, [f"IGH{i}" for i in range(5)] + ["MZB1", "JCHAIN"]), (5, [f"TRBV{i}" for i in range(6)])], "module int, genes array<string>")
    got = {r["module"]: r["signature_id"] for r in evidence.technical(mods).collect()}
    assert got == {1: "Y_chromosome_associated_signature", 2: None, 3: "mitochondrial_dominant_signature", 4: None, 5: "TCR_locus_dominant_signature"}


def test_label_score(spark):
    assert values(spark, [(3, 1, 1, 0.01, 20), (0, 0, 0, None, 5)], "m int, t int, r int, f double, s int", evidence.label_score(*(F.col(c) for c in "mtrfs"))) == [(9,), (0,)]


def test_label_rules_choose_the_best(spark):
    from petrel.sources import rules

    book = rules.label_rules(spark, [{"label_id": "a_module", "fallback_label": "a_like", "marker_patterns": ["a"], "core_term_patterns": ["alpha", "apex"], "required_specific_patterns": ["alpha"]}, {"label_id": "b_module", "fallback_label": "b_like", "marker_patterns": ["b"], "core_term_patterns": ["beta"], "required_specific_patterns": ["beta"]}])
    mods = spark.createDataFrame([(1, 20, {"a": 3}, "alpha things", 0.001), (2, 5, {"b": 1}, "none", None), (3, 50, {}, None, None), (4, 12, {"b": 2}, "apex", 0.2)], "module int, module_size int, counts map<string,int>, term_text string, best_fdr double")
    got = {r["module"]: (r["final_label"], r["confidence"]) for r in evidence.label_rules(mods, book).collect()}
    assert got[1] == ("a_module", "high_concordant_marker_and_specific_STRING_evidence") and got[3][0] == "unassigned_module"
    assert got[2][0] == "unassigned_module" and got[4][0] in ("b_like", "a_like")


def test_frames(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, None), (3, 3.0, "z")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-13, "x"), (2, 2.1, None), (4, 3.0, "z")], "k int, v double, s string")
    got = {r["column"]: (r["compared"], r["different"]) for r in diff.compare_frames(a, b, ["k"]).collect()}
    assert got == {"v": (2, 1), "s": (2, 0), "<rows missing>": (2, 1), "<rows extra>": (2, 1)}
    assert diff.identical(a, a.repartition(3)) and not diff.identical(a, b)
    assert diff.table_digest(a, a.columns).first() == diff.table_digest(a.repartition(3), a.columns).first()


def test_sheet_names():
    assert sinks.sheet_names(["a/b", "A_b", "x" * 40]) == ["a_b", "A_b_2", "x" * 31]


def test_exported_pvalues(spark):
    assert values(spark, [(0.0,), (0.5,)], "p double", sinks.exported_pvalue(F.col("p"))) == [(1e-300,), (0.5,)]
    with pytest.raises(Exception, match="not a number"):
        values(spark, [(1.5,)], "p double", sinks.exported_pvalue(F.col("p")))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 400])
def test_quantiles_by_ranges(spark, n):
    """Equal to the aggregate's, with ties over many rows, nulls and a column without values; levels likewise."""
    rng = random.Random(n)
    rows = [(i, rng.choice([None, 1.0, 1.0, float("nan"), float("inf"), rng.random() * 9]), rng.randrange(5), None) for i in range(n)]
    df = spark.createDataFrame(rows, "i int, x double, k int, none double").repartition(3)
    chances = [0.0, 0.1, 0.5, 0.75, 0.9, 1.0]
    columns = {"x": C.only_finite(F.col("x")), "k": F.col("k"), "none": F.col("none")}
    want = df.agg(*(F.percentile(c.cast("double"), F.array(*map(F.lit, chances))).alias(name) for name, c in columns.items())).first()
    got = quantiles.by_ranges(df, columns, chances)
    assert got == {name: list(want[name] or [None] * 6) for name in columns}
    levels = lambda limit: sorted(map(str, C.levels(df, {"a": F.col("x"), "b": F.col("k")}, one_buffer=limit).collect()))
    assert levels(-1) == levels(10**6)


def test_pattern_gates(spark):
    patterns = ["immune response", "^T cell", "kinase|phosphat.*ase", "a(b|c)d", "x?yz", "chemo.+taxis$", "[ab]c", "\\bword", "cyto.ine|^b", "a|"]
    got = values(spark, [(p,) for p in patterns], "p string", evidence.gates(F.lower("p")))
    assert [g[0] for g in got] == [["immune response"], ["t cell"], [""], [""], [""], ["chemo"], [""], [""], ["cyto", "b"], ["a", ""]]
    texts = ["immune response", "a t cell", "t cell", "phosphatase", "abd", "yz", "chemotaxis", "chemo x taxis", "bc", "some word", "cytokine", "bad", "", "KINASE"]
    df = spark.createDataFrame([(t, p) for t in texts for p in patterns], "t string, p string")
    closed = F.exists(evidence.gates(F.lower("p")), lambda x: F.contains(F.lower("t"), x))
    assert df.where(F.rlike(F.lower("t"), F.lower("p")) & ~closed).count() == 0
    assert df.where(closed).count() < df.count()


def test_numbers_as_short_texts(spark):
    given = [0.00012346, 0.000012346, 100000.0, 123456.0, 0.5, 1e-300, 5e-324, -2.5, 0.0, 1.0, 12345.6, 0.15625, 3e22, -0.00099996, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(x,) for x in given], "x double")
    got = [tuple(r) for r in df.select(texts.number(F.col("x"), 4), texts.number(F.col("x"), 4, scientific=False, missing="none")).collect()]
    assert [g[0] for g in got] == ["0.0001235", "1.235e-05", "1e+05", "123500", "0.5", "1e-300", "4.9e-324", "-2.5", "0", "1", "12350", "0.1562", "3e+22", "-0.001", "NA", "NA", "NA"]
    assert [g[1] for g in got[1:4]] == ["0.00001235", "100000", "123500"] and [g[1] for g in got[-3:]] == ["none"] * 3
    row = spark.createDataFrame([(1, None, " ", 0.25)], "a int, b string, c string, d double")
    assert row.select(texts.filled("{a}: {b}, {c}, {d:2}.", {"c": "nothing"})).first()[0] == "1: NA, nothing, 0.25."
    modules = spark.createDataFrame([(7, None, None, "mixed_or_not_available", "x" * 2000, "A;B")], "module_size int, interpretation string, confidence string, dominant_expression_direction string, database_evidence_summary string, top_genes_by_candidate_score string")
    text = texts.module_texts(modules).first()["module_rationale"]
    assert text.startswith("Interpretation: unresolved with confidence not_available. Size: 7.") and len(text) == 1800 and text.endswith("...")
