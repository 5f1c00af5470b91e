"""The registered queries of sources, sinks and input checks: what was written is read back and compared with its tables."""

from __future__ import annotations

import gzip
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from petrel.operators import audit, evidence, graph, provenance
from petrel.operators.checkpoints import shared_folder
from petrel.plans import sheets
from petrel.plans.catalog import _MORE, _candidates, _sql, query
from petrel.plans.fixtures import Tables
from petrel.sources import contract, discovery, resources, rules, sinks, tables


def _folder(t: Tables) -> str:
    """A new folder among the shared ones. Case files are hundreds of lines; the driver writes them, as it does in a run."""
    root = shared_folder(t.spark).removeprefix("file://")
    os.makedirs(root, exist_ok=True)
    return tempfile.mkdtemp(prefix="files-", dir=root)


def _lines(path: str, rows: list[str]) -> str:
    opened = gzip.open(path, "wt", encoding="utf-8") if path.endswith(".gz") else open(path, "w", encoding="utf-8")
    with opened as f:
        f.writelines(f"{r}\n" for r in rows)
    return path


# ---------------------------------------------------------------- input contract


@query(_sql("SELECT input_row, gene, logFC, pvalue FROM genes", "genes"))
def read_gene_table(t: Tables) -> DataFrame:
    """A semicolon-delimited file with a byte-order mark, quoted headers and decimal commas."""
    rows = t.genes().orderBy("input_row").select("gene", F.replace(F.col("logFC").cast("string"), F.lit("."), F.lit(",")).alias("fc"), "pvalue").collect()
    path = _lines(f"{_folder(t)}/genes.csv", ['\ufeff"Gene Symbol";note;log2-FC;P.Value', *(f'" {r["gene"]} ";x;{r["fc"]};{r["pvalue"]!r}' for r in rows)])
    return contract.read_genes(t.spark, path)[0]


_LINE = "CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', ';') WHEN 1 THEN replace(p_name, ' ', chr(9)) WHEN 2 THEN replace(p_name, ' ', ',') WHEN 3 THEN ',;' || p_brand ELSE replace(p_name, ' ', '') END"


@query(f"SELECT p_partkey, CASE WHEN greatest(a, b, c) = 0 THEN NULL WHEN a >= b AND a >= c THEN ';' WHEN b >= c THEN chr(9) ELSE ',' END AS separator FROM (SELECT p_partkey, length(l) - length(replace(l, ';', '')) AS a, length(l) - length(replace(l, chr(9), '')) AS b, length(l) - length(replace(l, ',', '')) AS c FROM (SELECT p_partkey, {_LINE} AS l FROM part))")
def guess_separator(t: Tables) -> DataFrame:
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    to = lambda x: F.replace(name, F.lit(" "), F.lit(x))
    line = F.when(k == 0, to(";")).when(k == 1, to("\t")).when(k == 2, to(",")).when(k == 3, F.concat(F.lit(",;"), "p_brand")).otherwise(to(""))
    return t.read("part").select("p_partkey", contract.separator_of(line).alias("separator"))


def _outcome(f) -> str:
    try:
        return f() or "ok"
    except ValueError as e:
        return str(e)


_HEADERS = {
    "plain": ["gene", "logFC", "pvalue"],
    "spelt otherwise": ["\ufeffGene Symbol", "log2-FC", "P.Value", "padj"],
    "two genes": ["gene", "Symbol", "logFC", "pvalue"],
    "adjusted only": ["gene", "logFC", "FDR"],
    "none": ["a", "b"],
}


@query("SELECT * FROM (VALUES ('plain', 'gene|logFC|pvalue'), ('spelt otherwise', chr(65279) || 'Gene Symbol|log2-FC|P.Value'), ('two genes', 'several columns for gene: gene, Symbol'), ('adjusted only', 'only adjusted p-values are given; raw p-values are needed'), ('none', 'missing columns: gene, logFC, pvalue')) v(name, outcome)")
def input_columns(t: Tables) -> DataFrame:
    rows = [(n, _outcome(lambda h=h: "|".join(contract.source_columns(h).values()))) for n, h in _HEADERS.items()]
    return t.spark.createDataFrame(rows, "name string, outcome string")


_NAME = "CASE s_suppkey % 6 WHEN 0 THEN s_name WHEN 1 THEN 'A' || s_suppkey WHEN 2 THEN 'con.' || s_suppkey WHEN 3 THEN 'x.' WHEN 4 THEN '_' || s_suppkey ELSE 'lpt' || (s_suppkey % 12) END"


def _names_of(k: Column, name: Column) -> Column:
    n = k.cast("string")
    return F.when(k % 6 == 0, name).when(k % 6 == 1, F.concat(F.lit("A"), n)).when(k % 6 == 2, F.concat(F.lit("con."), n)).when(k % 6 == 3, F.lit("x.")).when(k % 6 == 4, F.concat(F.lit("_"), n)).otherwise(F.concat(F.lit("lpt"), (k % 12).cast("string")))


@query(f"SELECT s_suppkey, name, regexp_full_match(name, '[A-Za-z0-9][A-Za-z0-9._-]{{0,63}}') AND NOT name LIKE '%.' AND NOT regexp_full_match(lower(string_split(name, '.')[1]), 'con|prn|aux|nul|com[1-9]|lpt[1-9]') AS valid FROM (SELECT s_suppkey, {_NAME} AS name FROM supplier)")
def case_names(t: Tables) -> DataFrame:
    name = _names_of(F.col("s_suppkey"), F.col("s_name"))
    return t.read("supplier").select("s_suppkey", name.alias("name"), contract.is_case_id(name).alias("valid"))


@query("SELECT s_suppkey, regexp_replace(s_name, '[^A-Za-z0-9._-]', '_', 'g') || '.v1' AS case_name FROM supplier")
def cases_from_paths(t: Tables) -> DataFrame:
    path = F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lit("in/a b/")).otherwise(F.lit("c:\\in\\")), "s_name", F.lit(".v1.csv"))
    return t.read("supplier").select("s_suppkey", contract.case_of(path).alias("case_name"))


_ROOTS = {"results": False, "results/A01": False, "results/A01_old": False, "reults/A01_old/": True, "results\\A01_b": True, "elsewhere/A01_b": True}


@query("SELECT * FROM (VALUES ('results', 'results/A01'), ('results/A01', 'results/A01'), ('results/A01_old', 'results/A01_old/A01'), ('reults/A01_old/', 'reults/A01'), ('results\\A01_b', 'results/A01'), ('elsewhere/A01_b', 'elsewhere/A01_b/A01')) v(root, folder)")
def output_folders(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(r, contract.output_folder(r, "A01", legacy)) for r, legacy in _ROOTS.items()], "root string, folder string")


@query("SELECT * FROM (VALUES (0, 'ok'), (1, 'the score threshold is a whole number from 1 to 1000'), (2, 'the score threshold is a whole number from 1 to 1000'), (3, 'top_n is a whole number, 1 or more'), (4, 'enrichment is on or off')) v(id, outcome)")
def parameter_checks(t: Tables) -> DataFrame:
    given = [(400, 30, True), (0, 30, True), (400.5, 30, True), (1000, 0, False), (1, 1, "yes")]
    return t.spark.createDataFrame([(i, _outcome(lambda g=g: contract.check_parameters(*g))) for i, g in enumerate(given)], "id int, outcome string")


@query("SELECT * FROM (VALUES ('', 'offline'), ('Local-Only', 'offline'), ('validate', 'online_validation'), ('cloud', 'not an enrichment mode: ''cloud''')) v(given, outcome)")
def enrichment_modes(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(x, _outcome(lambda x=x: discovery.enrichment_mode(x))) for x in ("", "Local-Only", "validate", "cloud")], "given string, outcome string")


@query("SELECT * FROM (VALUES ('bad.csv', 'FAIL'), ('empty.csv', 'FAIL'), ('good.csv', 'PASS')) v(file, status)")
def input_preflight(t: Tables) -> DataFrame:
    d = _folder(t)
    files = {"good.csv": ["gene,logFC,pvalue", "A,1,0.5"], "bad.csv": ["gene,logFC,pvalue", "A,x,0.5"], "empty.csv": []}
    out = tables.preflight(t.spark, [_lines(f"{d}/{n}", rows) for n, rows in files.items()])
    return out.select(F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "status")


def _case_files(t: Tables) -> str:
    """Gene tables of orders by line number and return flag, each one file: separators by line number, quoted line ends in
    lines 5 and 7, and faults in lines 1 (names repeat), 2 (p-values over 1), 3 (texts for numbers) and 6 (adjusted values only)."""
    line = F.col("l_linenumber")
    rows = t.read("lineitem").groupBy("l_linenumber", "l_returnflag", "l_orderkey").agg(F.min("l_discount").alias("d"), F.min("l_quantity").alias("q"))
    # a file is one task's, so what it sorts is narrow: texts are made after that
    narrow = rows.select(F.concat(F.lit("L"), line.cast("string"), "l_returnflag").alias("case"), "l_linenumber", "l_orderkey", "d", "q")
    texts = [
        "case",
        F.when(line == 1, F.concat(F.when(F.col("l_orderkey") % 2 == 0, F.lit("g")).otherwise(F.lit("G")), (F.col("l_orderkey") % 100).cast("string"))).otherwise(F.concat(F.lit("G"), F.col("l_orderkey").cast("string"))).alias("Gene Symbol"),
        F.when(line.isin(5, 7), F.lit('a "quoted"; text,\nof two lines')).otherwise(F.lit("plain")).alias("note"),
        F.when((line == 3) & (F.col("q") == 50), F.lit("x")).otherwise(F.replace((F.col("q") - 25).cast("string"), F.lit("."), F.when(line <= 3, F.lit(",")).otherwise(F.lit(".")))).alias("log2FC"),
        F.when(line == 2, F.col("d") * 20).otherwise(F.col("d")).alias("p.value"),
    ]
    folder = f"{shared_folder(t.spark)}/cases-{uuid.uuid4().hex}"
    for sep, lines in {";": [1, 2, 3], ",": [4, 5, 7], "\t": [6]}.items():
        part = narrow.where(line.isin(lines)).repartition("case").sortWithinPartitions("case", "l_orderkey").select(*texts)
        part = part.withColumnRenamed("p.value", "FDR") if lines == [6] else part
        part.write.mode("append").partitionBy("case").option("header", True).option("sep", sep).option("escape", '"').csv(folder)
    return folder


def _case() -> Column:
    return F.regexp_extract("file", "case=([^/]*)/", 1).alias("case")


_CASES = (
    "WITH o AS (SELECT l_linenumber AS n, l_returnflag AS f, l_orderkey AS k, min(l_discount) AS d, min(l_quantity) AS q FROM lineitem GROUP BY ALL), "
    "g AS (SELECT 'L' || n || f AS c, n, row_number() OVER (PARTITION BY n, f ORDER BY k) AS i, k, CASE n WHEN 1 THEN 'G' || k % 100 ELSE 'G' || k END AS gene, q - 25 AS fc, CASE n WHEN 2 THEN d * 20 ELSE d END AS p, n = 3 AND q = 50 AS bad FROM o), "
    "r AS (SELECT *, CASE WHEN n IN (5, 7) THEN 2 * i - 1 ELSE i END AS line FROM g) "
)


@query(
    _CASES + "SELECT c AS \"case\", count(*) AS rows, count(DISTINCT gene) AS genes, CAST(sum(CASE WHEN bad THEN 0 ELSE fc END) AS DOUBLE) AS fc, count(*) FILTER (bad) AS no_number, "
    "round(sum(p), 6) AS p, CAST(sum(line) AS BIGINT) AS lines, CAST(max(line) AS BIGINT) AS last_line FROM r WHERE n <> 6 GROUP BY c"
)
def gene_tables(t: Tables) -> DataFrame:
    """All case files in one scan; those without raw p-values have no rows."""
    rows = tables.read_tables(t.spark, [_case_files(t)])
    return rows.groupBy(_case()).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.upper("gene")).alias("genes"), F.sum(F.coalesce("logFC", F.lit(0.0))).alias("fc"), F.count_if(F.col("logFC").isNull()).alias("no_number"),
        F.round(F.sum("pvalue"), 6).alias("p"), F.sum("input_row").alias("lines"), F.max("input_row").cast("long").alias("last_line"),
    )


@query(
    _CASES + ", b AS (SELECT c, 2 AS pos, 'logFC_not_finite' AS rule, line FROM r WHERE bad UNION ALL SELECT c, 4, 'pvalue_out_of_range', line FROM r WHERE p > 1 "
    "UNION ALL SELECT c, 5, 'duplicate_gene', line FROM (SELECT c, line, count(*) OVER (PARTITION BY c, gene) AS m FROM r WHERE n <> 6) WHERE m > 1), "
    "w AS (SELECT *, min(pos) OVER (PARTITION BY c) AS least FROM b), x AS (SELECT c, rule, line, row_number() OVER (PARTITION BY c ORDER BY line) AS k, count(*) OVER (PARTITION BY c) AS m FROM w WHERE pos = least), "
    "v AS (SELECT c, any_value(rule) || ': rows ' || string_agg(CAST(line AS VARCHAR), ', ' ORDER BY line) FILTER (k <= 20) || CASE WHEN any_value(m) > 20 THEN ', ...' ELSE '' END AS fault FROM x GROUP BY c) "
    "SELECT a.c AS \"case\", CASE WHEN n = 6 THEN 0 ELSE a.m END AS rows, CASE WHEN n = 6 THEN 'only adjusted p-values are given; raw p-values are needed' ELSE fault END AS fault "
    "FROM (SELECT c, n, count(*) AS m FROM r GROUP BY c, n) a LEFT JOIN v ON a.c = v.c"
)
def gene_table_verdicts(t: Tables) -> DataFrame:
    """Every case file's first broken rule and the rows that break it."""
    return tables.verdicts(t.spark, [_case_files(t)]).select(_case(), "rows", "fault")


# ---------------------------------------------------------------- association resources


def _cache(t: Tables) -> str:
    """The four files of a cache, of suppliers as proteins; the links' one is cut short."""
    d = _folder(t)
    s = t.read("supplier").orderBy("s_suppkey").collect()
    rows = {
        "protein_info": [f"9606.{r['s_suppkey']}\t{r['s_name']}\t{r['s_nationkey']}\tnote {r['s_suppkey']}" for r in s],
        "protein_aliases": [f"9606.{r['s_suppkey']}\tSUP{r['s_suppkey']}\tmade up" for r in s],
        "enrichment_terms": [f"{9606 if r['s_suppkey'] % 5 else 10090}.{r['s_suppkey']}\tcat\tT{r['s_nationkey']}\tnation {r['s_nationkey']}" for r in s for _ in range(1 + r["s_suppkey"] % 2)],
        "protein_links": [f"9606.{r['s_suppkey']} 9606.{r['s_suppkey'] + 1} {r['s_nationkey'] * 40}" for r in s],
    }
    for role, lines in rows.items():
        _lines(f"{d}/{resources.filename(role)}", [resources.HEADERS[role], *lines])
    path = f"{d}/{resources.filename('protein_links')}"
    with open(path, "rb") as f:
        whole = f.read()
    with open(path, "wb") as f:
        f.write(whole[:-8])
    return d


def _path(cache: str, role: str) -> str:
    return f"{cache}/{resources.filename(role)}"


@query("SELECT '9606.' || s_suppkey AS protein_id, s_name AS name, CAST(s_nationkey AS INTEGER) AS protein_size, 'note ' || s_suppkey AS annotation FROM supplier")
def scan_protein_info(t: Tables) -> DataFrame:
    return resources.scan(t.spark, _path(_cache(t), "protein_info"), "protein_info")


@query("SELECT '9606.' || s_suppkey AS protein_id, 'SUP' || s_suppkey AS alias, 'made up' AS source FROM supplier")
def scan_aliases(t: Tables) -> DataFrame:
    return resources.scan(t.spark, _path(_cache(t), "protein_aliases"), "protein_aliases")


@query("SELECT '9606.' || s_suppkey AS id, 'cat' AS category, 'T' || s_nationkey AS term, 'nation ' || s_nationkey AS description FROM supplier WHERE s_suppkey % 5 > 0")
def scan_terms(t: Tables) -> DataFrame:
    """Repeated lines once, other species not at all."""
    return resources.terms(t.spark, _path(_cache(t), "enrichment_terms"))


@query("SELECT * FROM (VALUES ('protein_info', true, true, true), ('protein_aliases', true, true, true), ('protein_links', true, true, false), ('enrichment_terms', true, true, true)) v(role, header, found, complete)")
def resource_files(t: Tables) -> DataFrame:
    """Whether each file's header is right, whether it is found, and whether it is whole."""
    d = _cache(t)
    rows = [(r, resources.valid(_path(d, r), r), resources.find(d, r) is not None, resources.valid(_path(d, r), r, complete=True)) for r in resources.FILES]
    return t.spark.createDataFrame(rows, "role string, header boolean, found boolean, complete boolean")


@query("SELECT role, true AS exists, true AS valid FROM (VALUES ('protein_info'), ('protein_aliases'), ('protein_links'), ('enrichment_terms')) v(role)")
def resource_manifest(t: Tables) -> DataFrame:
    return resources.manifest(t.spark, _cache(t)).where("size > 0").select("role", "exists", "valid")


@query("SELECT * FROM (VALUES ('protein_aliases', 'fetched'), ('protein_info', 'protein_info is not in the cache and nothing is fetched')) v(role, outcome)")
def resource_fetch(t: Tables) -> DataFrame:
    """A missing file is fetched, validated and renamed; without a way to fetch it the run stops."""
    whole, d = _cache(t), _folder(t)

    def fetch(role: str, target: str) -> None:
        with open(_path(whole, role), "rb") as f, open(target, "wb") as g:
            g.write(f.read())

    def fetched() -> str:
        resources.ensure(d, ["protein_aliases"], fetch)
        return "fetched" if sorted(os.listdir(d)) == [resources.filename("protein_aliases")] else "leftovers"

    rows = [("protein_aliases", _outcome(fetched)), ("protein_info", _outcome(lambda: str(resources.ensure(d, ["protein_info"]))))]
    return t.spark.createDataFrame(rows, "role string, outcome string")


# ---------------------------------------------------------------- sinks


@query(_sql("SELECT CAST(id AS VARCHAR) AS id, gene, CAST(round(pvalue, 6) AS DOUBLE) AS pvalue FROM genes", "genes"))
def graphml_vertices(t: Tables) -> DataFrame:
    path = f"{_folder(t)}/network.graphml"
    sinks.write_graphml(path, t.genes().select("id", "gene", F.round("pvalue", 6).alias("pvalue")), t.edges())
    nodes, _ = sinks.read_graphml(path)
    return t.spark.createDataFrame([(k, a["gene"], float(a["pvalue"])) for k, a in nodes.items()], "id string, gene string, pvalue double")


@query(_sql("SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges", "edges"))
def graphml_edges(t: Tables) -> DataFrame:
    path = f"{_folder(t)}/network.graphml"
    sinks.write_graphml(path, t.vertices(), t.edges())
    return t.spark.createDataFrame(sinks.read_graphml(path)[1], "src string, dst string")


@query("SELECT 'nation' AS sheet, n_name AS name, CAST(n_regionkey AS DOUBLE) AS number, n_regionkey = 1 AS flag FROM nation UNION ALL SELECT 'a_very_long_name_of_a_sheet_tha', r_name, r_regionkey, false FROM region UNION ALL SELECT 'empty', 'no rows', NULL, NULL")
def workbook_round_trip(t: Tables) -> DataFrame:
    path = f"{_folder(t)}/book.xlsx"
    n = t.read("nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("number"), (F.col("n_regionkey") == 1).alias("flag"))
    r = t.read("region").select(F.array("r_name").alias("name"), F.col("r_regionkey").alias("number"), F.lit(False).alias("flag"))
    sinks.write_workbook(path, {"nation": n, "a_very_long_name_of_a_sheet_that_is_cut": r, "empty": n.limit(0)})
    rows = [(sheet, *(list(x) + [None, None])[:3]) for sheet, lines in sinks.read_workbook(path).items() for x in lines[1:]]
    return t.spark.createDataFrame([(a, b, None if c is None else float(c), d) for a, b, c, d in rows], "sheet string, name string, number double, flag boolean")


@query("SELECT unnest(range(1, 6)) AS position, unnest(['a_b', 'A_b_2', 'x', repeat('n', 31), repeat('n', 29) || '_2']) AS name")
def sheet_names(t: Tables) -> DataFrame:
    names = sinks.sheet_names(["a/b", "A:b", "x", "n" * 40, "n" * 33])
    return t.spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "position long, name string")


@query("SELECT n_name, CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_regionkey AS VARCHAR) END AS n_regionkey FROM nation")
def csv_report(t: Tables) -> DataFrame:
    path = f"{_folder(t)}/report.csv"
    sinks.write_csv(path, t.read("nation").select("n_name", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).alias("n_regionkey")))
    return t.spark.read.csv(path, header=True)


@query("SELECT n_name || '.txt' AS file, sha256(n_name || chr(10)) AS digest, n_nationkey = 3 AS tampered FROM nation")
def checksum_list(t: Tables) -> DataFrame:
    """Digests written, read back, and compared with files of which one has changed since."""
    d = _folder(t)
    names = [r["n_name"] for r in t.read("nation").orderBy("n_nationkey").collect()]
    sinks.write_checksums(f"{d}/list.sha256", [_lines(f"{d}/{n}.txt", [n]) for n in names])
    _lines(f"{d}/{names[3]}.txt", ["changed"])
    bad = sinks.tampered(d, f"{d}/list.sha256")
    return t.spark.createDataFrame([(k, v, k in bad) for k, v in sinks.read_checksums(f"{d}/list.sha256").items()], "file string, digest string, tampered boolean")


@query("SELECT r_regionkey, r_name, 1.5 * r_regionkey::DOUBLE AS number FROM region")
def json_manifest(t: Tables) -> DataFrame:
    import json

    path = f"{_folder(t)}/manifest.json"
    sinks.write_manifest(path, {"rows": [{"r_regionkey": r["r_regionkey"], "r_name": r["r_name"], "number": 1.5 * r["r_regionkey"]} for r in t.read("region").collect()]})
    with open(path, encoding="utf-8") as f:
        return t.spark.createDataFrame([(r["r_regionkey"], r["r_name"], r["number"]) for r in json.load(f)["rows"]], "r_regionkey long, r_name string, number double")


@query("SELECT * FROM (VALUES ('first', 'a.txt'), ('failed', ''), ('again', 'refused')) v(attempt, found)")
def staged_publication(t: Tables) -> DataFrame:
    """One rename; a failure leaves nothing; what is there is never overwritten."""
    d = _folder(t)

    def broken(staging: str) -> None:
        _lines(f"{staging}/half.txt", ["x"])
        raise ValueError("broken")

    def good(staging: str) -> None:
        _lines(f"{staging}/a.txt", ["x"])

    out = []
    _outcome(lambda: sinks.published(f"{d}/case", broken))
    out.append(("failed", ",".join(os.listdir(d))))
    sinks.published(f"{d}/case", good)
    out.append(("first", ",".join(os.listdir(f"{d}/case"))))
    try:
        sinks.published(f"{d}/case", good)
        out.append(("again", "overwritten"))
    except (OSError, ValueError):
        out.append(("again", "refused"))
    return t.spark.createDataFrame(out, "attempt string, found string")


@query("SELECT unnest(['archive_is_whole', 'relationship_targets_exist', 'relationship_ids_are_unique', 'sheets_have_relationships', 'sheets_have_headers', 'header_names_are_unique', 'sheet_names_fit']) AS check_id, unnest(['PASS', 'PASS', 'PASS', 'PASS', 'PASS', 'FAIL', 'PASS']) AS status")
def workbook_audit(t: Tables) -> DataFrame:
    path = f"{_folder(t)}/odd.xlsx"
    r = t.read("region")
    sinks.write_workbook(path, {"plain": r, "odd": r.select("r_regionkey", F.col("r_name").alias("r-name"), F.col("r_name").alias("R name"))})
    return t.spark.createDataFrame(audit.workbook(path), "check_id string, status string")


@query("SELECT * FROM (VALUES ('inside', 'a/one', 'a/two'), ('across', 'a/one', 'b/three')) v(place, one, two)")
def repeated_sheets(t: Tables) -> DataFrame:
    d, r, n = _folder(t), t.read("region").orderBy("r_regionkey"), t.read("nation").orderBy("n_nationkey")
    sinks.write_workbook(f"{d}/a.xlsx", {"one": r, "two": r})
    sinks.write_workbook(f"{d}/b.xlsx", {"three": r, "four": n})
    return t.spark.createDataFrame(audit.repeated_sheets({"a": f"{d}/a.xlsx", "b": f"{d}/b.xlsx"}), "place string, one string, two string")


@query("SELECT * FROM (VALUES ('protein_info', (SELECT count(*) FROM supplier)), ('protein_aliases', (SELECT count(*) FROM supplier)), ('enrichment_terms', (SELECT count(*) FROM supplier WHERE s_suppkey % 5 > 0)), ('threshold', 700)) v(item, n)")
def opened_resources(t: Tables) -> DataFrame:
    d = _cache(t)
    _lines(_path(d, "protein_links"), [resources.HEADERS["protein_links"], "9606.1 9606.2 900"])
    res = resources.Resources.open(t.spark, d, 700)
    return t.spark.createDataFrame([("protein_info", res.proteins.count()), ("protein_aliases", res.aliases.count()), ("enrichment_terms", res.terms.count()), ("threshold", res.threshold)], "item string, n long")


@query("SELECT * FROM (VALUES ('no edges', 'refused'), ('failed check', 'x: failed checks: b'), ('a p-value beyond 1', 'refused'), ('no provenance', 'refused')) v(guard, outcome)")
def guards(t: Tables) -> DataFrame:
    """What stops a run."""
    from pyspark.errors import PySparkException

    def refused(f) -> str:
        try:
            f()
        except (ValueError, PySparkException):
            return "refused"
        return "passed"

    spark = t.spark
    checks = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "check_id string, status string")
    rows = [
        ("no edges", refused(lambda: graph.require_edges(t.vertices(), t.edges().limit(0)))),
        ("failed check", _outcome(lambda: evidence.require_passed(checks, "x"))),
        ("a p-value beyond 1", refused(lambda: spark.range(1).select(sinks.exported_pvalue(F.lit(1.5))).collect())),
        ("no provenance", refused(lambda: rules.with_provenance(spark.createDataFrame([("r1",)], "rule_id string"), spark.createDataFrame([("r2", "x")], "rule_id string, note string")).collect())),
    ]
    return spark.createDataFrame(rows, "guard string, outcome string")


@query("SELECT unnest(['engine', 'python', 'spark', 'system']) AS item, true AS told")
def session_info(t: Tables) -> DataFrame:
    return sheets.session_info(t.spark).select("item", (F.length("version") > 0).alias("told"))


# ---------------------------------------------------------------- provenance


def _outputs(t: Tables) -> tuple[str, list[dict]]:
    d = _folder(t)
    roles = {"analytical_report": "a.xlsx", "technical_report": "t.xlsx", "string_links": "l.txt", "graphml": "n.graphml"}
    names = [r["r_name"] for r in t.read("region").orderBy("r_regionkey").collect()]
    return d, provenance.file_metadata({role: _lines(f"{d}/{f}", [n]) for (role, f), n in zip(roles.items(), names)})


@query("SELECT role, name, '1.0.0' AS schema_version, CAST(length(r_name) + 1 AS BIGINT) AS size, sha256(r_name || chr(10)) AS sha256 FROM (VALUES (0, 'analytical_report', 'a.xlsx'), (1, 'technical_report', 't.xlsx'), (2, 'string_links', 'l.txt'), (3, 'graphml', 'n.graphml')) v(k, role, name) JOIN region ON r_regionkey = k")
def output_file_metadata(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([tuple(x[c] for c in ("role", "name", "schema_version", "size", "sha256")) for x in _outputs(t)[1]], "role string, name string, schema_version string, size long, sha256 string")


@query("SELECT role, true AS available, true AS sized FROM (VALUES ('protein_info'), ('protein_aliases'), ('protein_links'), ('enrichment_terms')) v(role)")
def resource_sizes(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(x["role"], x["available"], x["size"] > 0) for x in provenance.resource_summary(_cache(t))], "role string, available boolean, sized boolean")


_CHECKS = [
    "manifest_sections_present", "manifest_schema_version_supported", "generated_at_is_utc", "software_version_is_semantic", "git_commit_is_valid", "schema_versions_are_pinned", "output_roles_are_unique", "output_names_are_base_names",
    "outputs_exist", "output_sizes_agree", "output_digests_agree", "output_schema_versions_agree", "no_absolute_paths", "input_file_name_privacy_is_valid", "case_id_privacy_is_valid", "privacy_is_declared",
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{'FAIL' if c in ('output_digests_agree', 'no_absolute_paths') else 'PASS'}')" for c in _CHECKS) + ") v(check_id, status)")
def provenance_checks(t: Tables) -> DataFrame:
    """Of a folder in which a byte was changed, and a manifest that tells a path."""
    d, outputs = _outputs(t)
    manifest = provenance.build("petrel", "0.1.0", d, "A01", {"cache": "/home/x"}, {}, outputs)
    with open(f"{d}/l.txt", "r+b") as f:
        f.write(b"#")
    return t.spark.createDataFrame(provenance.checks(manifest, d), "check_id string, status string")


@query("SELECT * FROM (VALUES ('good', 'written'), ('broken', 'provenance: failed checks: privacy_is_declared')) v(manifest, outcome)")
def provenance_written(t: Tables) -> DataFrame:
    d, outputs = _outputs(t)
    manifest = provenance.build("petrel", "0.1.0", d, "A01", {}, {}, outputs)

    def wrote(name: str, content: dict) -> str:
        provenance.write(f"{d}/{name}", content)
        return "written" if os.path.isfile(f"{d}/{name}") else "lost"

    rows = [("good", _outcome(lambda: wrote("manifest.json", manifest))), ("broken", _outcome(lambda: wrote("other.json", manifest | {"privacy": {}})))]
    return t.spark.createDataFrame(rows, "manifest string, outcome string")


@query("SELECT unnest(range(1, 22)) AS position, unnest([" + ", ".join(f"'{x}'" for x in sheets.TECHNICAL) + "]) AS sheet")
def technical_sheet_order(t: Tables) -> DataFrame:
    book = f"{_folder(t)}/technical.xlsx"
    sinks.write_workbook(book, sheets.technical({"Node metrics": t.read("nation"), "Gene status": t.read("region")}))
    return t.spark.createDataFrame([(i + 1, s) for i, s in enumerate(sinks.read_workbook(book))], "position long, sheet string")


# ---------------------------------------------------------------- enrichment of a run

#: Of the 25 modules the five largest, the first 30 candidates, and all nodes, each a query set over the parts' terms.
_MORE["runsets"] = (
    "SELECT 'all_nodes' AS query_name, id FROM cand UNION ALL SELECT 'top_candidates', id FROM cand WHERE candidate_rank <= 30 "
    "UNION ALL SELECT 'module_' || module, id FROM cand WHERE module IN (SELECT module FROM cand GROUP BY 1 HAVING count(*) >= 5 ORDER BY count(*) DESC, module LIMIT 5)",
    ["cand"],
)


@query(_sql("SELECT query_name, count(*) AS n FROM runsets GROUP BY 1", "runsets"))
def enrichment_query_sets(t: Tables) -> DataFrame:
    from petrel.plans import engine

    rows = _candidates(t).withColumn("community", F.col("module"))
    return engine.query_sets(rows, engine.Config()).groupBy("query_name").agg(F.count(F.lit(1)).alias("n"))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


@query("SELECT * FROM (VALUES " + ", ".join(f"({', '.join(map(_quoted, row))})" for row in sheets.METHODS) + ") v(section, item, description)")
def methods_sheet(t: Tables) -> DataFrame:
    return sheets.methods(t.spark)
