"""Audits of published tables: one aggregate each, findings as rows (check_id, status, details)."""

from __future__ import annotations

import json
import os
import re
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrel.functions.columns import CANONICAL, entity_class, finite
from petrel.operators import diff


def _row(check: str, bad: Column, details: Column, level: str = "FAIL") -> Column:
    return F.struct(F.lit(check).alias("check_id"), F.when(bad > 0, F.lit(level)).otherwise(F.lit("PASS")).alias("status"), details.cast("string").alias("details"))


def _rows(one: DataFrame, *rows: Column) -> DataFrame:
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pvalues(df: DataFrame, column: str = "pvalue") -> DataFrame:
    """Missing, out-of-range, zero and underflowing p-values."""
    p = F.col(column)
    one = df.agg(F.count_if(~finite(p)).alias("missing"), F.count_if(finite(p) & ~p.between(0, 1)).alias("outside"), F.count_if(p == 0).alias("zero"), F.count_if((p > 0) & (p < 1e-300)).alias("tiny"))
    return _rows(one, _row("pvalue_present", F.col("missing"), F.col("missing")), _row("pvalue_in_range", F.col("outside"), F.col("outside")), _row("pvalue_zero", F.col("zero"), F.col("zero"), "REVIEW"), _row("pvalue_underflow", F.col("tiny"), F.col("tiny"), "REVIEW"))


def special_entities(df: DataFrame, gene: str = "gene") -> DataFrame:
    """(entity_class, n) of symbols that aren't plain protein-coding genes."""
    return df.groupBy(entity_class(F.col(gene)).alias("entity_class")).agg(F.count(F.lit(1)).alias("n")).where(F.col("entity_class") != CANONICAL)


def directions(df: DataFrame, group: str, change: str = "logFC") -> DataFrame:
    """(group, up, down, one_sided) of the signs of change in each group."""
    x = F.col(change)
    return df.groupBy(group).agg(F.count_if(x > 0).alias("up"), F.count_if(x < 0).alias("down")).withColumn("one_sided", (F.col("up") == 0) != (F.col("down") == 0))


def insignificant(df: DataFrame, limit: float = 0.05, column: str = "fdr") -> DataFrame:
    one = df.agg(F.count_if(~finite(F.col(column)) | (F.col(column) > limit)).alias("n"))
    return _rows(one, _row("fdr_within_limit", F.col("n"), F.col("n")))


def module_semantics(annotations: DataFrame) -> DataFrame:
    """Class, eligibility and wording of module decisions agree."""
    technical, biological = F.col("interpretation_class") == "technical_or_covariate", F.col("interpretation_class") == "biological"
    one = annotations.agg(
        F.count_if(technical & F.col("priority_eligible")).alias("a"),
        F.count_if(biological & ~F.col("priority_eligible")).alias("b"),
        F.count_if(~biological & ~technical & F.col("best_fdr").isNotNull()).alias("c"),
    )
    return _rows(one, _row("technical_not_eligible", F.col("a"), F.col("a")), _row("biological_eligible", F.col("b"), F.col("b")), _row("unresolved_without_terms", F.col("c"), F.col("c")))


def table(df: DataFrame, expected: set[tuple[str, str]] = frozenset()) -> list[tuple[str, str, str]]:
    """(check_id, status, details): repeated names, equal columns (INFO where expected), repeated rows."""
    plain = [re.sub(r"[^a-z0-9]", "", c.lower()) for c in df.columns]
    out = [("duplicate_names", "FAIL" if len(set(plain)) < len(plain) else "PASS", ", ".join(sorted({c for c in plain if plain.count(c) > 1})))]
    for r in diff.equivalent_columns(df).collect():
        pair = tuple(sorted((r["one"], r["two"])))
        out.append(("equal_columns", "INFO" if pair in {tuple(sorted(p)) for p in expected} else "REVIEW", " = ".join(pair)))
    n = diff.duplicate_rows(df).agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return [*out, ("duplicate_rows", "REVIEW" if n else "PASS", str(n))]


def cell_identity(expected: DataFrame, observed: DataFrame, keys: list[str]) -> float:
    """Share of equal cells over the shared columns of rows that both have; 1 without any."""
    rows = [r for r in diff.compare_frames(expected, observed, keys).collect() if not r["column"].startswith("<rows")]
    cells = sum(r["compared"] for r in rows)
    return 1.0 - sum(r["different"] for r in rows) / cells if cells else 1.0


def repeated_tables(tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """Pairs of tables of equal columns and content."""
    seen: dict[tuple, str] = {}
    out = []
    for name, df in tables.items():
        key = (tuple(df.columns), *diff.table_digest(df, df.columns).first())
        if key in seen:
            out.append((seen[key], name))
        seen.setdefault(key, name)
    return out


def severities(findings: DataFrame, levels: tuple[str, ...] = ("FAIL", "REVIEW", "INFO", "PASS")) -> DataFrame:
    """(status, n) of every level, also of those without findings."""
    one = findings.agg(*(F.count_if(F.col("status") == x).alias(x) for x in levels))
    return one.select(F.explode(F.array(*(F.struct(F.lit(x).alias("status"), F.col(x).alias("n")) for x in levels))).alias("r")).select("r.*")


def inventory(tables: dict[str, DataFrame]) -> list[tuple[str, int, int, int]]:
    """(table, rows, columns, header names that repeat once case and signs are gone)."""
    out = []
    for name, df in tables.items():
        plain = [re.sub(r"[^a-z0-9]", "", c.lower()) for c in df.columns]
        out.append((name, df.count(), len(plain), len(plain) - len(set(plain))))
    return out


def tags(text: DataFrame, tag: str, column: str = "value") -> DataFrame:
    """(n): how often an XML element of that name opens in lines of text."""
    return text.agg(F.sum(F.regexp_count(column, F.lit(f"<{tag}[ />]"))).alias("n"))


def captured(files: DataFrame) -> DataFrame:
    """(path, size, lines, md5, repeated) of binary files (path, content), and whether another has the same content."""
    lines = F.length("content") - F.length(F.replace(F.decode("content", "ISO-8859-1"), F.lit("\n"), F.lit("")))
    rows = files.select("path", F.length("content").cast("long").alias("size"), lines.cast("long").alias("lines"), F.md5("content").alias("md5"))
    twice = rows.groupBy("md5").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    return rows.join(twice, "md5").select("path", "size", "lines", "md5", "repeated")


def log_state(lines: DataFrame) -> DataFrame:
    """(last_line, errors, completed) of a run's log; lines: line_no, value."""
    error, done = F.col("value").rlike("(?i)^error|execution halted|traceback"), F.col("value").rlike("(?i)completed|finished")
    return lines.agg(F.max_by("value", "line_no").alias("last_line"), F.count_if(error).alias("errors"), (F.max(F.when(done, F.col("line_no"))) > F.coalesce(F.max(F.when(error, F.col("line_no"))), F.lit(-1))).alias("completed"))


def run_log(lines: DataFrame) -> DataFrame:
    """(mapped, total, nodes, edges, components) by the last lines that tell them; lines: line_no, value."""
    last = lambda pattern, k: F.max_by(F.regexp_extract("value", pattern, k), F.when(F.col("value").rlike(pattern), F.col("line_no"))).try_cast("long")
    genes, net = "Mapped genes: ([0-9]+)/([0-9]+)", "Network: ([0-9]+) nodes, ([0-9]+) edges, ([0-9]+) components"
    return lines.agg(last(genes, 1).alias("mapped"), last(genes, 2).alias("total"), last(net, 1).alias("nodes"), last(net, 2).alias("edges"), last(net, 3).alias("components"))


def workbook(path: str) -> list[tuple[str, str]]:
    """(check_id, status) of a workbook's parts: the archive, its relationships, its sheets and their headers."""
    from petrel.sources import sinks

    with zipfile.ZipFile(path) as z:
        parts = set(z.namelist())
        whole = z.testzip() is None
        targets = re.findall(r'Target="([^"]+)"', z.read("xl/_rels/workbook.xml.rels").decode())
        ids = re.findall(r'Id="([^"]+)"', z.read("xl/_rels/workbook.xml.rels").decode())
        used = re.findall(r'r:id="([^"]+)"', z.read("xl/workbook.xml").decode())
    sheets = sinks.read_workbook(path)
    plain = [[re.sub(r"[^a-z0-9]", "", str(c).lower()) for c in rows[0]] if rows else [] for rows in sheets.values()]
    found = {
        "archive_is_whole": whole, "relationship_targets_exist": all(f"xl/{t}" in parts for t in targets), "relationship_ids_are_unique": len(set(ids)) == len(ids), "sheets_have_relationships": set(used) <= set(ids),
        "sheets_have_headers": all(plain), "header_names_are_unique": all(len(set(p)) == len(p) for p in plain), "sheet_names_fit": all(0 < len(n) <= 31 for n in sheets),
    }
    return [(k, "PASS" if v else "FAIL") for k, v in found.items()]


def repeated_sheets(books: dict[str, str]) -> list[tuple[str, str, str]]:
    """(where, one, two): pairs of sheets of equal cells, inside a workbook or across them."""
    from petrel.sources import sinks

    seen: dict[str, str] = {}
    out = []
    for book, path in books.items():
        for sheet, rows in sinks.read_workbook(path).items():
            key, name = json.dumps(rows), f"{book}/{sheet}"
            if key in seen:
                out.append(("inside" if seen[key].split("/")[0] == book else "across", seen[key], name))
            seen.setdefault(key, name)
    return out


def release(vertices: DataFrame, edges: DataFrame, nodes: DataFrame, final: DataFrame, counts: dict[str, int], tolerance: float = 1e-12) -> DataFrame:
    """(check_id, different, status): a published graph against the tables and the manifest's counts.

    vertices, nodes: id, candidate_score, candidate_rank, community_louvain, vertices with candidate_priority_status; edges: src,
    dst; final: id; counts: nodes, edges, modules. ``different`` counts ids, or edges, that disagree. Values agree
    if both are null or within ``tolerance`` of the greater. All sides meet in one full join by id.
    """
    side = lambda df, name, *c: df.groupBy(F.col("id").cast("string").alias("id")).agg(F.count(F.lit(1)).alias(f"{name}_rows"), *(F.max(x).alias(f"{name}_{x}") for x in c))
    values = ["candidate_score", "candidate_rank", "community_louvain"]
    both = side(vertices, "g", *values, "candidate_priority_status").join(side(nodes, "t", *values), "id", "full").join(side(final, "f"), "id", "full")
    here, there = F.col("g_rows").isNotNull(), F.col("t_rows").isNotNull()
    shared, listed = here & there, F.coalesce(F.col("g_candidate_priority_status") == "final_priority", F.lit(False))

    def unlike(c: str) -> Column:
        g, t = F.col(f"g_{c}"), F.col(f"t_{c}")
        if c == "candidate_score":
            near = F.abs(g - t) <= tolerance * F.greatest(F.abs(g), F.abs(t))
            return shared & ~F.coalesce(near, g.isNull() & t.isNull())
        return shared & ~g.cast("string").eqNullSafe(t.cast("string"))

    tally = both.agg(
        F.count_if((here != there) | (F.coalesce("g_rows", F.lit(1)) > 1) | (F.coalesce("t_rows", F.lit(1)) > 1)).alias("vertices_match_nodes"), *(F.count_if(unlike(c)).alias(f"{c}_agrees") for c in values),
        F.count_if(listed != F.col("f_rows").isNotNull()).alias("final_set_agrees"), F.abs(F.coalesce(F.sum("g_rows"), F.lit(0)) - counts["nodes"]).alias("node_count_agrees"), F.abs(F.count_distinct("g_community_louvain") - counts["modules"]).alias("module_count_agrees"),
    )
    ends = edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    once = ends.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    known = vertices.select(F.col("id").cast("string").alias("end")).distinct().withColumn("known", F.lit(True))
    loose = ends.select(F.explode(F.array("src", "dst")).alias("end")).groupBy("end").agg(F.count(F.lit(1)).alias("n")).join(known, "end", "left")
    of_edges = once.agg(F.abs(F.coalesce(F.sum("n"), F.lit(0)) - counts["edges"]).alias("edge_count_agrees"), F.count_if((F.col("n") > 1) | (F.col("a") == F.col("b"))).alias("graph_is_simple"))
    of_ends = loose.agg(F.count_if(F.col("known").isNull()).alias("edge_ends_known"))
    one = tally.join(F.broadcast(of_edges)).join(F.broadcast(of_ends))  # a row each
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check_id"), F.col(c).cast("long").alias("different")) for c in one.columns))).alias("c")).select("c.*")
    return rows.withColumn("status", F.when(F.col("different") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))


def publication(folder: str) -> list[tuple[str, str]]:
    """(check_id, status) of a published folder: files, sizes, digests, parts of the workbooks, graph against manifest, no local paths."""
    from petrel.sources import sinks

    out: list[tuple[str, bool]] = []
    with open(f"{folder}/manifest.json", encoding="utf-8") as f:
        text = f.read()
    manifest = json.loads(text)
    files = manifest["files"]
    out.append(("files_exist", all(os.path.isfile(f"{folder}/{x['name']}") for x in files)))
    out.append(("files_not_empty", all(x["size"] > 0 for x in files)))
    out.append(("sizes_agree", all(os.path.isfile(f"{folder}/{x['name']}") and os.path.getsize(f"{folder}/{x['name']}") == x["size"] for x in files)))
    out.append(("digests_agree", all(os.path.isfile(f"{folder}/{x['name']}") and sinks.sha256(f"{folder}/{x['name']}") == x["sha256"] for x in files)))
    out.append(("checksums_agree", not sinks.tampered(folder, f"{folder}/checksums.sha256")))
    out.append(("no_local_paths", not re.search(r'"(/|[A-Za-z]:\\\\)[^"]*"', text)))
    out.append(("schema_version", manifest.get("schema_version") == "1.0.0"))
    nodes, edges = sinks.read_graphml(f"{folder}/network.graphml")
    out.append(("graph_counts_agree", (len(nodes), len(edges)) == (manifest["counts"]["network_nodes"], manifest["counts"]["network_edges"])))
    out.append(("graph_is_simple", len({frozenset(e) for e in edges}) == len(edges) and all(a != b for a, b in edges)))
    out.append(("graph_ends_known", all(a in nodes and b in nodes for a, b in edges)))
    for name in ("analytical.xlsx", "technical.xlsx"):
        with zipfile.ZipFile(f"{folder}/{name}") as z:
            parts = set(z.namelist())
            targets = re.findall(r'Target="([^"]+)"', z.read("xl/_rels/workbook.xml.rels").decode())
            out.append((f"{name.split('.')[0]}_parts", z.testzip() is None and all(f"xl/{t}" in parts for t in targets)))
    return [(k, "PASS" if v else "FAIL") for k, v in out]
