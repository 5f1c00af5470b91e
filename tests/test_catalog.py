"""Registered queries on small order tables whose graphs are given by their edges."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from petrel.functions.shape import dealt
from petrel.operators import graph, louvain, report
from petrel.operators import paths as path_measures
from petrel.plans import catalog
from petrel.plans.fixtures import Tables
from petrel.sources import tables


def orders(spark, folder, n, pairs):
    """Tables in which each pair of n suppliers met once, so that every edge has the greatest score."""
    spark.createDataFrame([(k, s) for k, pair in enumerate(pairs) for s in (*pair, pair[0])], "l_orderkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(n).select(F.col("id").alias("s_suppkey")).write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def by_sql(folder, name):
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet/*.parquet'")
    return sorted(con.execute(catalog.oracles()[name]).fetchall())


HUBS = [(h, 10 + 40 * h + i) for h in range(4) for i in range(40)] + [(a, b) for a in range(4) for b in range(a + 1, 4)] + [(10 + i, 50 + i) for i in range(40)] + [(90 + i, 91 + i) for i in range(39)]


@pytest.mark.parametrize("n, pairs", [(200, HUBS), (3, [(0, 1)])], ids=["rounds that lose", "nothing left to move"])
def test_louvain_rounds_equal_sql(spark, tmp_path, n, pairs):
    folder = orders(spark, tmp_path, n, pairs)
    got = sorted(tuple(r) for r in catalog.queries()["louvain_rounds"](spark, folder).collect())
    assert len(got) == catalog.ROUNDS + 1 and got == [(r, c, pytest.approx(q, abs=1e-9)) for r, c, q in by_sql(folder, "louvain_rounds")]


def test_first_rounds_follow_the_search_while_it_gains(spark):
    v, e = spark.range(60), spark.range(59).selectExpr("id AS src", "id + 1 AS dst")
    search = louvain.communities(v, e, most_rounds=2)
    assert [r[2] for r in search.rounds] == ["none", "together", "together"]
    for a, b in zip(search.states, louvain.first_rounds(v, e, 2), strict=True):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_paths_of_more_vertices_than_one_block_was_allowed(spark):
    v = spark.range(20_001)
    e = spark.createDataFrame([(0, 1), (1, 2), (20_000, 3)], "src long, dst long").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    paths = graph.shortest_paths(v, e)
    assert paths.groupBy("d").count().orderBy("d").collect() == [(0, 20_001), (1, 6), (2, 2)]


@pytest.mark.parametrize("rows", [1, 60, 10**6])
def test_blocks_take_each_source_once(spark, rows):
    """Ten paths of three vertices: a source meets its own component's four edge ends, so 120 rows, not 30 times 40."""
    v, e = spark.range(31), spark.range(10).selectExpr("explode(array(struct(3 * id AS src, 3 * id + 1 AS dst), struct(3 * id + 1 AS src, 3 * id + 2 AS dst))) AS e").select("e.*")
    assert path_measures.needed(v, e, rows) == {1: 31, 60: 2, 10**6: 1}[rows]
    got = path_measures.all_pairs(v, e, rows)
    assert sorted(map(tuple, got.groupBy("d").count().collect())) == [(0, 31), (1, 40), (2, 20)] and got.select("s", "t").distinct().count() == 91
    far = {r["id"]: (r["reached"], r["total"], r["eccentricity"]) for r in path_measures.reached(v, e, rows).collect()}
    assert far == {i: (2, 2, 1) if i % 3 == 1 else (2, 3, 2) for i in range(30)}


def test_links_are_counted_in_tasks_of_bounded_size(spark, tmp_path):
    lines = [(1, 5), (1, 3), (1, 5), (2, 3), (2, 5), (2, 9), (3, 9), (3, 3), (4, 7), (None, 3), (None, 5), (5, None), (5, 3)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    links = Tables(spark, str(tmp_path)).links()
    assert sorted(map(tuple, links.collect())) == [(3, 5, 1000), (3, 9, 1000), (5, 9, 500)]
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "SortMergeJoin" not in plan
    parts = dealt(spark.range(10_000), 10_000, "id", rows=500).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 1_000


def test_rows_are_dealt_without_sorting_a_split_up_to_twice_the_threshold(spark):
    """Beyond 200 partitions a task that deals holds its whole split; two million rows in a task hold less."""
    parts = lambda rows: dealt(spark.range(10_000), 10_000, "id", rows=rows).rdd.getNumPartitions()
    assert [parts(n) for n in (50, 46, 25, 24)] == [200, 200, 200, 417]
    assert dealt(spark.range(10_000), 10_000, "id", rows=46).distinct().count() == 10_000


def test_records_of_many_tables_are_put_together_once(spark, tmp_path):
    """Quoted line ends need sorted windows: neither headers nor rows compute them anew."""
    (tmp_path / "a.csv").write_text('gene,logFC,pvalue,note\nA,1,0.5,"x\ny"\nB,2,0.25,z\n')
    rows = tables.read_tables(spark, [str(tmp_path)])
    assert "Window" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["input_row"], r["gene"], r["logFC"]) for r in rows.collect()) == [(1, "A", 1.0), (3, "B", 2.0)]


def test_pairs_of_links_are_exchanged_once(spark, tmp_path):
    """Edges read the pairs and their greatest count: both come from one exchange of pairs."""
    folder = orders(spark, tmp_path, 6, [(0, 1), (0, 1), (1, 2), (3, 4)])
    edges = Tables(spark, folder).edges()
    assert sorted(map(tuple, edges.collect())) == [(0, 1)]
    plan = edges._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("partial_collect_set") == 1 and plan.count("ReusedExchange") == 1


def test_edges_are_derived_once_for_a_query_that_reads_them_again(spark, tmp_path):
    t = Tables(spark, orders(spark, tmp_path, 6, [(0, 1), (1, 2)]))
    v, e = t.graph()
    assert e.sameSemantics(t.edges()) and "collect_set" not in graph.degrees(v, t.edges())._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, t.edges().collect())) == [(0, 1), (1, 2)]


def test_edges_are_read_back_from_a_table_of_their_size(spark, tmp_path):
    """Searches read the edges in every round: a table is read in few tasks, a checkpoint in as many as derived it."""
    _, e = Tables(spark, orders(spark, tmp_path, 6, [(0, 1), (1, 2)])).graph()
    assert e.inputFiles() and sorted(map(tuple, e.collect())) == [(0, 1), (1, 2)]


def test_components_search_derived_edges(spark, tmp_path, monkeypatch):
    """The search filters loops, so edges that are not derived yet would have their pairs exchanged twice."""
    seen = []
    monkeypatch.setattr(graph, "components", lambda v, e: seen.append(e) or v)
    catalog.queries()["connected_components"](spark, orders(spark, tmp_path, 6, [(0, 1), (1, 2)]))
    assert len(seen) == 1 and "collect_set" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def named(spark, folder, n, pairs):
    """The same with all columns that genes and their names are made of."""
    rows = [(k, s, "RAN"[s % 3]) for k, pair in enumerate(pairs) for s in pair]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(n).selectExpr("id AS s_suppkey", "concat('Supplier#', lpad(cast(id AS string), 9, '0')) AS s_name", "cast(id % 4 AS int) AS s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


#: A path deeper than the nine levels of the SQL of paths, a pair, and one more vertex.
DEEP = [*((i, i + 1) for i in range(11)), (12, 13)]


def test_executive_rows_count_the_networks_components(spark, tmp_path):
    folder = named(spark, tmp_path, 15, DEEP)
    got = sorted(tuple(r) for r in catalog.queries()["executive_rows"](spark, folder).collect())
    assert got == by_sql(folder, "executive_rows")
    assert [r[2] for r in got[4:9]] == ["15", "12", "3", "12", "0.8"]


def test_summary_leaves_out_modules_in_conflict_and_writes_plain_numbers(spark):
    metrics = spark.createDataFrame([("nodes", 120000.0), ("edges", 1e7), ("components", 40000.0), ("largest_component_nodes", 60.0), ("largest_component_fraction", 0.0005), ("density", float("nan"))], "metric string, value double")
    decided = spark.createDataFrame([("biological", True, False), ("biological", True, None), ("biological", True, True), ("mixed_biological", False, True)], "interpretation_class string, priority_eligible boolean, conflict_detected boolean")
    got = {r["item"]: r["value"] for r in report.summary_rows(spark.createDataFrame([("input_rows", "9")], "metric string, value string"), metrics, decided, spark.range(2), "x").collect()}
    assert [got[k] for k in ("network_nodes", "network_edges", "connected_components", "largest_component_nodes", "largest_component_fraction")] == ["120000", "10000000", "40000", "60", "0.0005"]
    assert [got[k] for k in ("input_rows", "louvain_modules", "priority_eligible_modules", "mixed_biological_modules", "final_priority_candidates", "run_configuration")] == ["9", "4", "2", "1", "2", "x"]


@pytest.mark.parametrize("n, pairs", [(15, DEEP), (2, [(0, 1)])], ids=["deep", "no pairs to lie between"])
def test_node_metrics_have_paths_and_scores(spark, tmp_path, n, pairs):
    folder = named(spark, tmp_path, n, pairs)
    df = catalog.queries()["node_metrics"](spark, folder)
    rows = sorted(df.collect())
    assert len(df.columns) == 16 and [tuple(r) for r in rows] == by_sql(folder, "node_metrics")
    if n == 2:
        assert [(r["betweenness"], r["stress_centrality"], r["candidate_score"]) for r in rows] == [(None, 0, None)] * 2
        return
    between = [i * (11 - i) if i < 12 else 0 for i in range(n)]
    assert [r["stress_centrality"] for r in rows] == between and [r["betweenness"] for r in rows] == [b / 91 for b in between]
    assert {r["component"] for r in rows[:12]} == {0} and rows[0]["closeness"] == pytest.approx(1 / 6)
    level = lambda xs: [(x - min(xs)) / (max(xs) - min(xs)) for x in xs]
    parts = [level([f(r) for r in rows]) for f in (lambda r: r["degree"], lambda r: r["betweenness"], lambda r: math.log1p(r["stress_centrality"]), lambda r: r["abs_logFC"], lambda r: -math.log10(r["pvalue"]))]
    assert [r["candidate_score"] for r in rows] == [pytest.approx(((d + b + s) / 3 + e + p) / 3, abs=1e-9) for d, b, s, e, p in zip(*parts, strict=True)]
