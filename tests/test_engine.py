"""The twelve-protein network end to end: two six-cliques, a bridge, and an alias row that wins a collision."""

from __future__ import annotations

import gzip
import itertools
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from petrel.operators import audit, canonical, graph, louvain, provenance
from petrel.operators import paths as path_measures
from petrel.plans import engine, sheets
from petrel.sources import contract, graphml, resources, rules, sinks, tables

GENES = ["AURKA", "CCNB1", "TOP2A", "CDC20", "BIRC5", "CDK1", "PTPRC", "TYROBP", "HLA-DRA", "CD74", "C1QA", "C1QB"]
IDS = [f"9606.P{i:04d}" for i in range(1, 13)]


def packed(path, header, rows, sep):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join([header, *(sep.join(map(str, r)) for r in rows)]) + "\n")


@pytest.fixture(scope="module")
def cache(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("cache"))
    links = [(a, b) for g in (IDS[:6], IDS[6:]) for a, b in itertools.combinations(g, 2)] + [(IDS[0], IDS[6])]
    packed(f"{d}/{resources.filename('protein_info')}", resources.HEADERS["protein_info"], [(i, g, 100, "x") for i, g in zip(IDS, GENES)], "\t")
    packed(f"{d}/{resources.filename('protein_aliases')}", resources.HEADERS["protein_aliases"], [(IDS[5], "CDKALIAS", "test"), (IDS[0], "SHARED", "test"), (IDS[1], "SHARED", "test")], "\t")
    packed(f"{d}/{resources.filename('protein_links')}", resources.HEADERS["protein_links"], [(a, b, 900) for a, b in links] + [(b, a, 900) for a, b in links] + [(IDS[1], IDS[8], 200)], " ")
    terms = [(i, "Reactome Pathways", "T1", "mitotic cell cycle") for i in IDS[:6]] + [(i, "Reactome Pathways", "T2", "immune response") for i in IDS[6:]]
    packed(f"{d}/{resources.filename('enrichment_terms')}", resources.HEADERS["enrichment_terms"], terms, "\t")
    return d


@pytest.fixture(scope="module")
def genes(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "case one.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("Gene Symbol;log2-FC;P.Value\n")
        f.writelines(f" {g} ;{(12 - k) / 4:.2f};{0.001 * (k + 1)}\n".replace(".", ",") for k, g in enumerate(GENES))
        f.write("CDKALIAS;3,0;1e-8\n")
    return path


@pytest.fixture(scope="module")
def result(spark, cache, genes):
    rows, seen = contract.read_genes(spark, genes)
    assert seen.source_columns == {"gene": "Gene Symbol", "logFC": "log2-FC", "pvalue": "P.Value"} and seen.input_rows == 13
    return engine.run(rows, resources.Resources.open(spark, cache), engine.Config(top_n=5, rulebook=tuple(rules.EXAMPLE)))


def test_mapping_and_collision(result):
    assert result.counts["input_rows"] == 13 and result.counts["mapped_proteins"] == 12
    audit = {(r["gene"], r["selected"]) for r in result.tables["Collisions"].collect()}
    assert audit == {("CDK1", False), ("CDKALIAS", True)}


def test_topology(result):
    nodes = {r["id"]: r for r in result.tables["Node metrics"].collect()}
    assert len(nodes) == 12
    for i, r in nodes.items():
        hub = i in (IDS[0], IDS[6])
        assert r["degree"] == (6 if hub else 5)
        assert r["betweenness"] == pytest.approx(30 / 55 if hub else 0)
        assert r["stress_centrality"] == (30 if hub else 0)
        assert r["closeness"] == pytest.approx(0.6875 if hub else 0.5)
        assert r["harmonic_closeness"] == pytest.approx(0.772727 if hub else 0.651515, abs=1e-6)
        assert r["local_clustering"] == pytest.approx(2 / 3 if hub else 1)
    assert len({nodes[i]["community"] for i in IDS[:6]}) == len({nodes[i]["community"] for i in IDS[6:]}) == 1
    assert nodes[IDS[5]]["pvalue"] == 1e-8 and nodes[IDS[5]]["logFC"] == 3
    got = {r["metric"]: r["value"] for r in result.tables["Network summary"].collect()}
    want = {"nodes": 12, "edges": 31, "components": 1, "density": 0.469697, "global_clustering": 0.923077, "average_shortest_path_lcc": 1.909091, "diameter_lcc": 3, "radius_lcc": 2, "louvain_communities": 2, "louvain_modularity": 0.467742}
    assert {k: pytest.approx(v, abs=1e-6) for k, v in want.items()} == {k: got[k] for k in want}


def test_evidence_bundle_is_checked(spark, result):
    """A rule's own curation goes with its rows; rules without it are unverified; wrong curation stops the run's check."""
    (r,) = result.tables["Rule provenance"].collect()
    assert r["rule_id"] == rules.EXAMPLE[0]["rule_id"] and (r["curation_status"], r["reference_count"]) == ("legacy_unverified", 0)
    said = [rules.EXAMPLE[0] | {"curation_status": "verified", "references": "doi:1; doi:2 ;"}, rules.EXAMPLE[0] | {"rule_id": "other", "curation_status": "verified"}]
    rows = rules.curation(spark, said)
    assert [(r["reference_count"], r["references"]) for r in rows.orderBy("rule_id").collect() if r["rule_id"] != "other"] == [(2, "doi:1; doi:2")]
    modules = result.tables["Node annotations"].select("community_louvain").distinct()
    decided = modules.select("community_louvain", *(F.lit(v).alias(c) for c, v in {"primary_interpretation": "x", "warning": "", "evidence_rationale": "", "interpretation_class": "biological", "priority_eligible": False, "best_supporting_fdr": 0.5}.items()))
    checks = {r["check_id"]: r["status"] for r in canonical.pipeline_checks(decided, rows, result.tables["Significant terms"], result.tables["Node annotations"]).collect()}
    assert {k for k, v in checks.items() if v == "FAIL"} == {"rule_evidence_has_explicit_provenance"}


def test_enrichment_and_decisions(result):
    rows = {(r["query_name"], r["term"]): r for r in result.tables["Enrichment"].collect()}
    modules = [r for (q, t), r in rows.items() if q.startswith("module_") and t == "T1"]
    assert modules and modules[0]["pvalue"] == pytest.approx(1 / 924) and modules[0]["fdr"] == pytest.approx(2 / 924)
    decided = {r["primary_interpretation"]: r for r in result.tables["Module annotations"].collect()}
    assert decided["mitotic cell cycle"]["priority_eligible"] and decided["unresolved biological context"]["interpretation_class"] == "unresolved"
    final = result.tables["Final priorities"].collect()
    assert {r["id"] for r in final} == set(IDS[:6]) and [r["priority_rank"] for r in final] == list(range(1, 7))
    assert all(r["status"] == "PASS" for r in result.checks.collect())


def test_publication(result, tmp_path):
    folder = engine.publish(result, str(tmp_path), "case1")
    assert not sinks.tampered(folder, f"{folder}/checksums.sha256")
    nodes, edges = sinks.read_graphml(f"{folder}/network.graphml")
    said = {r["candidate_rank"]: r for r in result.tables["Row texts"].collect()}
    assert len(said) == 12 and said[1]["matrix_rationale"].startswith("Composite rank 1 combines normalized degree=") and said[1]["topology_support"].startswith("degree rank ")
    assert all(r["module_rationale"].startswith("Interpretation: ") for r in result.tables["Readable modules"].collect())
    assert len(nodes) == 12 and len(edges) == 31 and float(nodes[IDS[5]]["pvalue"]) == 1e-8
    with zipfile.ZipFile(f"{folder}/technical.xlsx") as z:
        assert z.testzip() is None
    assert list(sinks.read_workbook(f"{folder}/technical.xlsx")) == list(sheets.TECHNICAL)
    assert list(nodes[IDS[0]])[:3] == ["STRING_id", "gene", "annotation_schema_version"] and nodes[IDS[0]]["cytoscape_priority_class"]
    with open(f"{folder}/manifest.json") as f:
        manifest = json.load(f)
    assert manifest["counts"]["network_edges"] == 31 and set(provenance.SECTIONS) <= set(manifest)
    assert {k: v for k, v in provenance.checks(manifest, folder) if v != "PASS"} == {} and len(provenance.checks(manifest, folder)) == 16
    broken = manifest | {"input": {"case_id": "x", "case_id_source": "guessed", "file": "/home/x"}}
    assert {k for k, v in provenance.checks(broken, folder) if v == "FAIL"} == {"no_absolute_paths", "input_file_name_privacy_is_valid", "case_id_privacy_is_valid"}
    assert {k: v for k, v in audit.publication(folder) if v != "PASS"} == {}
    spark, path, name = result.tables["vertices"].sparkSession, f"{folder}/network.graphml", {"network_candidate_rank": "candidate_rank"}
    found = graphml.vertices(spark, path)
    assert {r["id"]: r["pvalue"] for r in found.collect()}[IDS[5]] == 1e-8 and dict(found.dtypes)["degree"] == "double"
    written = result.tables["Graph attributes"].withColumn("id", F.col("STRING_id")).withColumnsRenamed(name)
    checked = audit.release(found.withColumnsRenamed(name), graphml.edges(spark, path), written, result.tables["Final priorities"], {"nodes": 12, "edges": 31, "modules": found.select("community_louvain").distinct().count()})
    assert {r["check_id"] for r in checked.where("status = 'FAIL'").collect()} == set() and checked.count() == 10
    book = sinks.read_workbook(f"{folder}/analytical.xlsx")
    assert {k: v[0] for k, v in book.items()} == sheets.COLUMNS and list(book) == list(sheets.COLUMNS)
    assert book["Executive summary"][1][:2] == ["input_rows", "13"] and len(book["Executive summary"]) == 17 and book["Final priorities"][1][15].startswith("Network rank 1 ")
    assert "cell_cycle_mitotic(" in str(result.tables["Module labels"].collect())
    with open(f"{folder}/network_links.txt", "a") as f:
        f.write("x")
    assert sinks.tampered(folder, f"{folder}/checksums.sha256") == ["network_links.txt"]
    assert dict(audit.publication(folder))["digests_agree"] == "FAIL"
    with pytest.raises(FileExistsError):
        engine.publish(result, str(tmp_path), "case1")
    assert [x for x in os.listdir(tmp_path) if x.startswith(".")] == []


def test_failed_publication_leaves_nothing(tmp_path):
    def fail(_):
        raise OSError("disk")

    with pytest.raises(OSError):
        sinks.published(str(tmp_path / "out"), fail)
    assert os.listdir(tmp_path) == []


def test_resources_fail_closed(cache, tmp_path, spark):
    path = f"{cache}/{resources.filename('enrichment_terms')}"
    cut = tmp_path / "cut.txt.gz"
    with open(path, "rb") as f:
        cut.write_bytes(f.read()[:-8])
    assert resources.valid(path, "enrichment_terms", complete=True)
    assert not resources.valid(str(cut), "enrichment_terms", complete=True)
    assert not resources.valid(path, "protein_links")
    assert {r["valid"] for r in resources.manifest(spark, cache).collect()} == {True}
    listed = {r["role"]: (r["species"], r["version"], r["url"]) for r in resources.manifest(spark, cache, base="https://mirror.example").collect()}
    assert listed["protein_links"] == (9606, "12.0", "https://mirror.example/protein.links.v12.0/9606.protein.links.v12.0.txt.gz")
    with pytest.raises(resources.ResourceError):
        resources.manifest(spark, cache, species=10090)
    with pytest.raises(resources.ResourceError):
        resources.ensure(str(tmp_path), ["protein_links"])
    fetched = resources.ensure(str(tmp_path / "new"), ["enrichment_terms"], lambda role, target: os.link(path, target) if not os.path.exists(target) else open(target, "wb").write(open(path, "rb").read()))
    assert resources.valid(fetched["enrichment_terms"], "enrichment_terms")


def test_louvain_is_deterministic(spark):
    pairs = [(a, b) for g in (range(6), range(6, 12)) for a, b in itertools.combinations(g, 2)] + [(0, 6), (20, 21)]
    v, e = spark.range(25), spark.createDataFrame(pairs, "src long, dst long")
    runs = [sorted(map(tuple, louvain.louvain(v, e.repartition(n)).collect())) for n in (1, 5)]
    assert runs[0] == runs[1]
    label = dict(runs[0])
    assert len({label[i] for i in range(6)}) == len({label[i] for i in range(6, 12)}) == 1
    assert len(set(label.values())) == 2 + 1 + 11  # the cliques, the pair and the isolated ones
    q = graph.modularity(e.where("src < 12"), louvain.louvain(v.where("id < 12"), e.where("src < 12"))).first()
    assert q["communities"] == 2 and q["modularity"] == pytest.approx(0.467742, abs=1e-6)


def test_louvain_finds_planted_groups_in_one_component(spark):
    """Six groups in one component, whatever the partitions and names; modularity never falls and is that of the labels."""
    import random

    rng = random.Random(3)
    pairs = [(a, b) for a in range(180) for b in range(a + 1, 180) if rng.random() < (0.4 if a // 30 == b // 30 else 0.01)]
    v, e = spark.range(180), spark.createDataFrame(pairs, "src long, dst long")
    runs = []
    for n in (1, 7):
        found = louvain.communities(v.repartition(n), e.repartition(n))
        q = [r[3] for r in found.rounds]
        assert q == sorted(q) and q[-1] > 0.6
        assert q[-1] == pytest.approx(graph.modularity(e, found.member.withColumnRenamed("c", "community")).first()["modularity"], abs=1e-12)
        runs.append((found.rounds, sorted(map(tuple, found.member.collect()))))
        first = [graph.modularity(e, x.withColumnRenamed("c", "community")).first()["modularity"] for x in found.states[:3]]
        assert first == pytest.approx(q[:3], abs=1e-12)
    assert runs[0] == runs[1]
    assert len({(i // 30, c) for i, c in runs[0][1]}) == len({c for _, c in runs[0][1]}) == 6


def test_louvain_takes_back_rounds_that_lose(spark):
    """Many leaves that move at once into hubs; a star, a path, pairs, loops of weight inside contracted vertices."""
    pairs = [(h, 10 + 40 * h + i) for h in range(4) for i in range(40)] + [(a, b) for a in range(4) for b in range(a + 1, 4)] + [(10 + i, 50 + i) for i in range(40)] + [(90 + i, 91 + i) for i in range(39)]
    v, e = spark.range(200), spark.createDataFrame(pairs, "src long, dst long")
    found = louvain.communities(v, e)
    q = [r[3] for r in found.rounds]
    assert q == sorted(q) and q[-1] == pytest.approx(graph.modularity(e, found.member.withColumnRenamed("c", "community")).first()["modularity"], abs=1e-12)
    assert louvain.communities(v, e.limit(0)).rounds == [] and louvain.louvain(v.limit(3), e.limit(0)).count() == 3


def test_paths_on_random_graphs(spark):
    import random
    from collections import deque

    rng = random.Random(5)
    n = 25
    pairs = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(40)})
    near = {i: [b if a == i else a for a, b in pairs if i in (a, b)] for i in range(n)}
    between, stress = dict.fromkeys(range(n), 0.0), dict.fromkeys(range(n), 0)
    dist = {}
    for s in range(n):
        d, sigma, queue = {s: 0}, {s: 1}, deque([s])
        while queue:
            x = queue.popleft()
            for y in near[x]:
                if y not in d:
                    d[y], sigma[y] = d[x] + 1, 0
                    queue.append(y)
                if d[y] == d[x] + 1:
                    sigma[y] += sigma[x]
        dist[s] = (d, sigma)
    for s, t in itertools.combinations(range(n), 2):
        if t in dist[s][0]:
            for v in range(n):
                if v not in (s, t) and v in dist[s][0] and dist[s][0][v] + dist[t][0][v] == dist[s][0][t]:
                    k = dist[s][1][v] * dist[t][1][v]
                    stress[v] += k
                    between[v] += k / dist[s][1][t]
    v, e = spark.range(n), spark.createDataFrame(pairs, "src long, dst long")
    paths = graph.shortest_paths(v, e)
    assert {(r["s"], r["t"]): (r["d"], r["sigma"]) for r in paths.collect()} == {(s, t): (d[t], g[t]) for s, (d, g) in dist.items() for t in d}
    got = {r["id"]: r for r in graph.centrality(v, e, paths).collect()}
    assert all(got[i]["stress"] == stress[i] and got[i]["betweenness"] == pytest.approx(between[i]) for i in range(n))
    # blocks of a few sources sum to the same
    assert path_measures.blocks(n, len(pairs), 800) == 3 and path_measures.blocks(10**6, 10**7, 10**9) == 20_000
    for r in path_measures.measures(v, e, 800).collect():
        d = dist[r["id"]][0]
        assert r["stress"] == stress[r["id"]] and r["betweenness"] == pytest.approx(between[r["id"]])
        assert (r["reached"] or 0, r["total"] or 0, r["eccentricity"] or 0) == (len(d) - 1, sum(d.values()), max(d.values()))
    member = graph.largest_component(graph.components(v, e))
    inside = {r["id"] for r in member.where("in_largest_component").collect()}
    got = path_measures.extremes(v.where(F.col("id").isin(*inside)), e.where(F.col("src").isin(*inside)), 2)
    far = [max(dist[i][0].values()) for i in inside]
    assert (got.diameter, got.radius) == (max(far), min(far)) and got.searches <= len(inside)
    three = {frozenset(x) for x in itertools.combinations(range(n), 3) if all(tuple(sorted(p)) in set(pairs) for p in itertools.combinations(x, 2))}
    for chunk in (1, 2, 4096):
        rows = [tuple(r) for r in graph.triangles(e, graph.degrees(v, e), chunk).collect()]
        assert len(rows) == len(three) and {frozenset(r) for r in rows} == three


def test_extremes_take_few_searches(spark):
    """A long grid with a tail: exact, from a twentieth of the vertices; one vertex has 0 for both."""
    w, h = 12, 3
    pairs = [(y * w + x, y * w + x + 1) for y in range(h) for x in range(w - 1)] + [(y * w + x, (y + 1) * w + x) for y in range(h - 1) for x in range(w)] + [(w - 1, w * h), (w * h, w * h + 1)]
    v, e = spark.range(w * h + 2), spark.createDataFrame(pairs, "src long, dst long")
    got = path_measures.extremes(v, e, 2)
    assert (got.diameter, got.radius) == (15, 8) and got.searches <= 8
    one = path_measures.extremes(spark.range(1), e.limit(0))
    assert (one.diameter, one.radius) == (0, 0)


def test_preflight(spark, genes, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("gene,padj,logFC\nA,0.1,1\n")
    got = {r["path"]: (r["status"], r["message"]) for r in tables.preflight(spark, [genes, str(bad)]).collect()}
    assert got[genes][0] == "PASS" and got[str(bad)][0] == "FAIL" and "raw p-values" in got[str(bad)][1]


def _by_hand(text: str) -> list[tuple[int, list[str]]]:
    """(line of a record's start, fields) by a walk over the characters."""
    sep = max(";\t,", key=text.split("\n")[0].count)
    out, cells, cell, quoted, line, start = [], [], "", False, 0, 0
    for ch in text + "\n":
        if ch == '"':
            quoted = not quoted
            cell += ch
        elif ch == "\n" and not quoted:
            out.append((start, [*cells, cell]))
            cells, cell, line = [], "", line + 1
            start = line
        elif ch == sep and not quoted:
            cells, cell = [*cells, cell], ""
        else:
            line += ch == "\n"
            cell += ch
    plain = lambda c: c[1:-1].replace('""', '"') if c.startswith('"') else c
    return [(i, [plain(c) for c in r]) for i, r in out if r != [""]]


@pytest.mark.parametrize("block", ["134217728", "97"])
def test_many_tables_in_one_scan(spark, tmp_path, block):
    """Blocks of 97 bytes cut records, quoted fields and headers; the rows are those of a walk over the whole file."""
    texts = {
        "plain.csv": "gene,logFC,pvalue\n" + "".join(f"G{k},{k - 20},0.{k:02}\n" for k in range(60)),
        "quoted.csv": '\ufeff"P.Value";note;"Gene Symbol";logFC\n' + "".join(f'0.5;"two\n\nlines; ""{k}""{"x" * (k * 9)}\n";"Q{k}";-1,{k}\n\n' for k in range(25)),
        "late.csv": "gene\tpvalue\tlogFC\textra\n" + "".join(f"L{k}\t0\t1\t\n" for k in range(30)) + 'L99\t1\t1\t"a' + "\n" * 120 + 'b"\nL100\t1\t2',
        "open.csv": 'gene,logFC,pvalue\nA,1,"0.5\nB,1,0.5\n',
    }
    for n, x in texts.items():
        (tmp_path / n).write_text(x)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {(r["file"].rsplit("/")[-1], r["input_row"]): (r["gene"], r["logFC"], r["pvalue"]) for r in tables.read_tables(spark, [str(tmp_path)]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {}
    for n, at in {"plain.csv": (0, 1, 2), "quoted.csv": (2, 3, 0), "late.csv": (0, 2, 1)}.items():
        for i, r in _by_hand(texts[n].lstrip("\ufeff"))[1:]:
            want[n, i] = (r[at[0]].strip(), float(r[at[1]].replace(",", ".")), float(r[at[2]]))
    assert got == want


def test_verdicts_of_many_tables(spark, tmp_path):
    head = "gene,logFC,pvalue\n"
    texts = {
        "a good.csv": head + "A,1,0.5\nB,2,1", "dup.csv": head + "a,1,1\nB,1,1\nA,2,1", "first.csv": head + ",x,7\nB,x,0.1", "range.csv": head + "".join(f"A{k},1,2\n" for k in range(25)),
        "short.csv": head + "A,1\nB,1,1", "two.csv": "gene,symbol,logFC,pvalue\nA,B,1,1", "none.csv": head, "empty.csv": "", "blank.csv": "\n\n", "sep.csv": "gene\nA", "missing.csv": "gene,other\nA,1", "open.csv": head + 'A,"1,1\n',
    }
    for n, x in texts.items():
        (tmp_path / n).write_text(x)
    paths = [str(tmp_path / n) for n in [*texts, "absent.csv"]]
    got = {r["path"].rsplit("/")[-1]: r["message"] for r in tables.preflight(spark, paths).collect()}
    assert got == {
        "a good.csv": "", "dup.csv": "duplicate_gene: rows 1, 3", "first.csv": "empty_gene: rows 1", "range.csv": f"pvalue_out_of_range: rows {', '.join(map(str, range(1, 21)))}, ...", "short.csv": "pvalue_not_finite: rows 1",
        "two.csv": "several columns for gene: gene, symbol", "none.csv": "the input has no rows", "empty.csv": "the input is empty", "blank.csv": "the input is empty", "sep.csv": "the header has no separator",
        "missing.csv": "missing columns: logFC, pvalue", "open.csv": "a quote is not closed", "absent.csv": "the input can't be read",
    }
    assert [tuple(r) for r in tables.preflight(spark, [str(tmp_path / "absent.csv")]).collect()] == [(str(tmp_path / "absent.csv"), "FAIL", "the input can't be read")]


def test_rulebook_is_checked(spark):
    frame = rules.frame(spark, rules.EXAMPLE)
    assert frame.count() == 1
    assert rules.provenance(frame).first()["evidence_level"] == "unreviewed"
    for change in ({"axis": "other"}, {"min_score": 2}, {"positive_markers": []}):
        with pytest.raises(ValueError):
            rules.checked([rules.EXAMPLE[0] | change])
    with pytest.raises(ValueError):
        rules.checked(rules.EXAMPLE * 2)


def test_symbols_are_normalised(spark, cache, genes):
    rows, _ = contract.read_genes(spark, genes)
    table = spark.createDataFrame([("CDKALIAS", "CDK1"), ("CDKALIAS", "ZZZ"), ("AURKA", None)], "symbol string, approved string")
    out = engine.run(rows, resources.Resources.open(spark, cache, enrichment=False), engine.Config(enrichment=False), approved=table)
    assert [tuple(r) for r in out.tables["Symbol normalisation"].where("changed").collect()] == [("CDKALIAS", "CDK1", True)]
    assert out.counts["mapped_proteins"] == 12 and out.tables["Alias corrections"].count() == 0
    assert out.tables["Module annotations"].where("interpretation_class <> 'unresolved'").count() == 0
    assert out.tables["Final priorities"].count() == 0
