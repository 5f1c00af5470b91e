"""Discovery, labels, logs, workbooks and audits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from petrel.operators import audit
from petrel.sources import discovery, labels, rules, sinks


def test_columns_are_found(spark):
    df = spark.createDataFrame([("x", "9606.ENSP1", "al")], "a string, b string, alias_name string")
    assert discovery.id_column(df) == "b" and discovery.alias_column(df, "b") == "alias_name"
    assert discovery.id_column(df.withColumnRenamed("a", "STRING_id")) == "STRING_id"
    assert discovery.name_column(df.withColumnRenamed("a", "preferred_name")) == "preferred_name"
    assert discovery.first_of(["Term ID", "fdr"], ["description", "term_id"]) == "Term ID"
    for f in (lambda: discovery.id_column(df.select("a")), lambda: discovery.name_column(df.select("b")), lambda: discovery.require(df, ["z"], "it")):
        with pytest.raises(ValueError):
            f()
    assert discovery.parse_bool(" Yes ") and not discovery.parse_bool("n") and discovery.is_bool("0") and not discovery.is_bool("2")
    assert discovery.enrichment_mode(None) == "offline" and discovery.enrichment_mode("online-validation") == "online_validation"
    with pytest.raises(ValueError):
        discovery.enrichment_mode("other")


def test_labels(spark):
    rows = [(1, "mhc class II", "x"), (2, "nothing", "given"), (3, None, None), (4, "mitotic cell cycle; collagen", "x")]
    df = spark.createDataFrame(rows, "i int, t string, f string")
    got = [r[0] for r in df.orderBy("i").select(labels.label_from_terms(F.col("t"), F.col("f"))).collect()]
    assert got == ["MHC_class_II_antigen_presentation_module", "given", "unassigned_module", "stromal_ECM_remodeling_module"]
    df = spark.createDataFrame([("a(3); b(1)",), ("no_marker_set_match",)], "s string")
    assert [r[0] for r in df.select(labels.counts_of(F.col("s"))).collect()] == [{"a": 3, "b": 1}, {}]
    assert len(labels.MARKERS) == len(labels.SET_LABELS) == 9 and len(labels.RULES) == 10
    mods = spark.createDataFrame([(1, "cell_cycle_mitotic_module", {"cell_cycle_mitotic": 4, "lipid_metabolic": 6}, "mitotic; lipid; cholesterol"), (2, None, {}, None)], "module int, label_id string, counts map<string,int>, term_text string")
    got = {r["module"]: r["themes"] for r in labels.supporting_themes(mods, rules.label_rules(spark, labels.RULES)).collect()}
    assert got == {1: "cell-cycle/mitotic proliferation; lipid/fatty-acid metabolism", 2: "not_available"}


def test_run_log(spark):
    lines = ["start", "Mapped genes: 3/9", "Network: 5 nodes, 7 edges, 1 components", "Mapped genes: 8/9"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no int, value string")
    assert tuple(audit.run_log(df).first()) == (8, 9, 5, 7, 1)
    assert tuple(audit.run_log(df.where("line_no = 0")).first()) == (None,) * 5


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a<&>b", 1.5, True, ["x", "y"]), (2, None, None, False, [])], "i int, s string, v double, b boolean, l array<string>")
    path = str(tmp_path / "w.xlsx")
    sinks.write_workbook(path, {"one": df, "none": df.limit(0)})
    got = sinks.read_workbook(path)
    assert got["one"] == [["i", "s", "v", "b", "l"], [1, "a<&>b", 1.5, True, "x;y"], [2, None, None, False, ""]]
    assert got["none"] == [["note"], ["no rows"]]
    with pytest.raises(FileExistsError):
        sinks.write_workbook(path, {})
    sinks.write_csv(str(tmp_path / "r.csv"), df)
    assert (tmp_path / "r.csv").read_text().splitlines() == ["i,s,v,b,l", "1,a<&>b,1.5,True,x;y", "2,,,False,"]


def test_audits(spark):
    df = spark.createDataFrame([("A", 0.0, 1.0, 1), ("MT-X", 1e-310, -1.0, 1), ("B", 2.0, 1.0, 2), ("C", None, 2.0, 2)], "gene string, pvalue double, logFC double, module int")
    got = {r["check_id"]: (r["status"], r["details"]) for r in audit.pvalues(df).collect()}
    assert got == {"pvalue_present": ("FAIL", "1"), "pvalue_in_range": ("FAIL", "1"), "pvalue_zero": ("REVIEW", "1"), "pvalue_underflow": ("REVIEW", "1")}
    assert [tuple(r) for r in audit.special_entities(df).collect()] == [("mitochondrial", 1)]
    assert {r["module"]: r["one_sided"] for r in audit.directions(df, "module").collect()} == {1: False, 2: True}
    assert audit.insignificant(df.withColumn("fdr", F.lit(0.01))).first()["status"] == "PASS"
    twin = df.select("gene", F.col("gene").alias("copy"), "module").union(df.select("gene", F.col("gene").alias("copy"), "module"))
    found = audit.table(twin, {("copy", "gene")})
    assert ("equal_columns", "INFO", "copy = gene") in found and ("duplicate_rows", "REVIEW", "8") in found
    assert audit.cell_identity(df, df.withColumn("logFC", F.col("logFC") + F.when(F.col("gene") == "A", 1).otherwise(0)), ["gene"]) == pytest.approx(11 / 12)
    assert audit.repeated_tables({"a": df, "b": df.repartition(3), "c": twin}) == [("a", "b")]


def test_module_semantics(spark):
    df = spark.createDataFrame([("technical_or_covariate", True, None), ("biological", True, 0.01), ("unresolved", False, 0.01)], "interpretation_class string, priority_eligible boolean, best_fdr double")
    assert {r["check_id"]: r["status"] for r in audit.module_semantics(df).collect()} == {"technical_not_eligible": "FAIL", "biological_eligible": "PASS", "unresolved_without_terms": "FAIL"}
