"""The jobs as registered queries: each run twice into one new folder below the shared one, and read back; with the SQL of the result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobs import case_table, term_mentions
from petrel.operators.checkpoints import shared_folder


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _fresh(spark, "case-table")
    for _ in range(2):
        case_table.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/supplier.parquet", f"{sf_dir}/nation.parquet", out)
    return spark.read.schema(case_table.GENES).parquet(f"{out}/genes")


def job2_term_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _fresh(spark, "term-mentions")
    for _ in range(2):
        term_mentions.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet", f"{out}/tables", f"{out}/checkpoint")
    return spark.read.schema(term_mentions.MENTIONS).parquet(f"{out}/tables/mentions")


_CLASSES = "CASE " + " ".join(f"WHEN regexp_matches(upper(trim(gene)), '{p}') THEN '{n}'" for n, p in case_table.C.ENTITY_CLASSES) + f" ELSE '{case_table.C.CANONICAL}' END"
_READY = "CASE WHEN c = '{}' THEN 'review_ready_canonical' WHEN c IN ({}) THEN 'network_evidence_only' WHEN c IN ({}) THEN 'excluded_from_automatic_priority' ELSE 'manual_review_required' END".format(case_table.C.CANONICAL, *(", ".join(f"'{x}'" for x in names) for names in (case_table.C.NETWORK_ONLY, case_table.C.EXCLUDED)))
_CHOOSE = "lgamma({0} + 1) - lgamma({1} + 1) - lgamma({0} - {1} + 1)"
_TERM = f"exp({_CHOOSE.format('k', 'i')} + {_CHOOSE.format('(n - k)', '(d - i)')} - ({_CHOOSE.format('n', 'd')}))"

CASE_TABLE = f"""
WITH s AS (SELECT l_suppkey AS gene_id, count(*) FILTER (l_returnflag = 'R') AS cases, count(*) FILTER (l_returnflag = 'A') AS controls FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1),
x AS (SELECT gene_id, s_name AS gene, cases, controls, n_name AS module, cases + controls AS d, sum(cases) OVER () AS k, sum(cases + controls) OVER () AS n FROM s JOIN supplier ON s_suppkey = gene_id LEFT JOIN nation ON n_nationkey = s_nationkey),
t AS (SELECT *, round(log2((cases + 1.0) / (controls + 1.0)), 9) AS lfc, CASE WHEN cases <= greatest(0, d + k - n) THEN 1.0 ELSE round(least(1, list_sum(list_transform(range(cases, CAST(least(k, d) AS BIGINT) + 1), lambda i: {_TERM}))), 9) END AS p FROM x),
r AS (SELECT *, p * count(*) OVER () / (rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1) AS raw FROM t),
a AS (SELECT *, round(least(1, min(raw) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) AS q, {_CLASSES} AS c FROM r)
SELECT gene_id, gene, cases AS "case", controls AS control, lfc AS "logFC", p AS pvalue, q AS fdr, c AS entity_class, {_READY} AS eligibility, module FROM a
"""

_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '\p{L}+')"
_SETTINGS = term_mentions.DEFAULTS

TERM_MENTIONS = f"""
WITH v AS (SELECT term, count(*) AS statements FROM (SELECT unnest(list_distinct({_WORDS})) AS term FROM benchmark) WHERE length(term) >= {_SETTINGS["least_letters"]} AND NOT regexp_matches(term, '{term_mentions.GENERIC}') GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, lang, source, {_WORDS} AS w FROM documents),
e AS (SELECT r, lang, source, unnest(w) AS term FROM d),
m AS (SELECT lang, term, count(DISTINCT r) AS documents, count(*) AS mentions, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS sources FROM e GROUP BY 1, 2),
n AS (SELECT lang AS of, count(*) AS texts FROM documents GROUP BY 1)
SELECT term, statements, documents, mentions, sources, round(documents / texts, 9) AS share, documents / texts > {_SETTINGS["generic_share"]} AS too_common, lang FROM m JOIN v USING (term) JOIN n ON lang IS NOT DISTINCT FROM of
"""

QUERIES = {"job1_case_table": job1_case_table, "job2_term_mentions": job2_term_mentions}
ORACLES = {"job1_case_table": CASE_TABLE, "job2_term_mentions": TERM_MENTIONS}
