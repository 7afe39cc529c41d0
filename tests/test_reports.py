"""Lookups, scorecards, evaluation, normalisation and writers on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.__main__ import COMMANDS, main
from ledgerlens.operators import evaluation, gate, lookups, rules, scorecards
from ledgerlens.sources import normalise, sinks, tables, workbook


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_findings_of_a_subject_keep_the_first_of_each_message(spark):
    found = spark.createDataFrame([("a", "m1", 3, "error"), ("a", "m1", 1, "info"), ("a", "m2", 2, "error"), (None, "m1", 0, "error")], "subject string, message string, ordinal int, severity string")
    out = lookups.findings_by_subject(found, "subject", "message", ["ordinal"]).collect()
    assert [(r.subject, [(x.message, x.finding.severity) for x in r.findings]) for r in out] == [("a", [("m1", "info"), ("m2", "error")])]
    assert lookups.findings_by_subject(found.limit(0), "subject", "message", ["ordinal"]).count() == 0


def test_signals_without_a_metric_apply_to_all(spark):
    claims = spark.createDataFrame([("a", "rank"), ("a", "auv"), ("b", "auv")], "subject string, metric string")
    signals = spark.createDataFrame([("a", None, "s1"), ("a", "auv", "s2"), ("c", "auv", "s3")], "subject string, metric string, title string")
    assert rows(lookups.applicable_signals(claims, signals, "subject", "metric")) == [("a", "auv", "s1"), ("a", "auv", "s2"), ("a", "rank", "s1")]


def test_provenance_prefers_name_and_type_then_the_workbook(spark):
    p = spark.createDataFrame([("a", "x", "t", 0.1, None), ("a", "y", "workbook", 0.5, "2024"), ("a", "z", "u", 0.9, "2024"), (None, "x", "t", 1.0, None)], "subject string, source_name string, source_type string, confidence double, as_of_date string")
    claims = spark.createDataFrame([(1, "a", "x", "t"), (2, "a", "q", "t"), (3, "b", "x", "t")], "k int, subject string, source_name string, source_type string")
    out = lookups.pick_provenance(claims, p, "k", "subject").collect()
    assert {r.k: r.provenance.source_name for r in out} == {1: "x", 2: "y"}


def test_small_rules(spark):
    assert [lookups.status_filter(x) for x in ("all", "non_blocked", "blocked")] == [None, ["publishable", "advisory"], ["blocked"]]
    df = spark.createDataFrame([("{}", "Joe's stands out here", "", None), ('{"brand_name": "Al"}', "x", " u ", "y"), (None, None, None, None)], "d string, t string, n string, u string")
    assert [r[0] for r in df.select(lookups.signal_subject(F.col("d"), F.col("t"))).collect()] == ["Joe's", "Al", None]
    assert [r[0] for r in df.select(lookups.cited(F.col("n"), F.col("u"))).collect()] == [False, True, False]
    j = spark.createDataFrame([("q", "d", None, "relevant", "why"), ("q", None, None, "relevant", "why"), ("q", "d", None, "odd", "why"), ("q", "d", None, "relevant", " ")], "query_id string, doc_id string, chunk_id string, label string, rationale string")
    assert lookups.substantive(j).count() == 1
    kept, lost = lookups.only_subjects(df.select("n"), "n", spark.createDataFrame([(" u ",), ("zz",)], "n string"))
    assert kept.count() == 1 and rows(lost) == [("zz",)]


def test_operating_models(spark):
    made = [
        (1, "汉堡", "中央厨房", 3500.0, 25.0, 100.0, 22.0, 0.1), (2, "咖啡", "门店仅制作饮品", 900.0, 8.0, 3000.0, 15.0, 0.96), (3, "披萨", "外卖为主", 900.0, 30.0, 10.0, 5.0, 0.5), (4, "炸鸡", "组装 现炸", None, None, None, None, 0.75),
        (5, None, None, None, None, None, None, None), (6, "fast-casual", "预制组装", None, 10.0, None, None, 0.86),
    ]
    df = spark.createDataFrame(made, "k int, category string, supply string, auv double, fte double, stores double, margin double, share double")
    out = {r.k: [tuple(m) for m in r.models] for r in rules.operating_models(df, "category", "supply", "auv", "fte", "stores", "margin", "share").collect()}
    assert out[1] == [("premium_service", "high")]
    assert out[2] == [("beverage_ops", "high"), ("throughput_model", "medium"), ("franchise_standardized", "high"), ("assembly_automation", "medium")]
    assert out[3] == [("digital_delivery", "medium")] and out[4] == [("franchise_standardized", "low")] and out[5] == [("premium_service", "low")]
    assert out[6] == [("franchise_standardized", "medium"), ("assembly_automation", "high")]
    flags = spark.createDataFrame([("Drive-Thru burgers", None), ("x", "得来速"), (None, None)], "c string, s string")
    assert [r[0] for r in flags.select(rules.drive_thru(F.col("c"), F.col("s"))).collect()] == [True, True, False]


def test_checks_without_findings(spark):
    found = spark.createDataFrame([("a", "implied_auv_k", "error", 1), (None, "fte_range_order", "info", 2), (None, "margin_range_order", "error", 3)], "subject string, check_name string, severity string, ordinal int")
    out = {(r.subject, r.label): r.status for r in scorecards.invariant_results(spark.createDataFrame([("a",), ("b",)], "subject string"), found, "subject").collect()}
    assert out["a", "implied AUV consistency"] == "failed" and out["b", "implied AUV consistency"] == "passed"
    assert {out[s, "FTE range ordering"] for s in "ab"} == {"passed"} and {out[s, "margin range ordering"] for s in "ab"} == {"failed"}
    assert {out[s, "rank uniqueness"] for s in "ab"} == {"unknown"}


def test_runs_and_guards(spark):
    def broken():
        raise ImportError("no model here")

    good = spark.createDataFrame([("q1", "d1", 1, 2.0), ("q1", "d2", 2, 1.0)], "query_id string, doc_id string, rank int, score double")
    results, states = evaluation.run({"good": lambda: good, "broken": broken})
    assert [(s["retriever"], s["status"], s["reason"]) for s in states] == [("good", "ok", None), ("broken", "skipped", "no model here")]
    relevant = spark.createDataFrame([("q1", "d2", 1), ("q2", "d9", 1)], "query_id string, doc_id string, grade int")
    assert [(r.query_id, r.recall, r.mrr) for r in evaluation.metrics_by_retriever(results, relevant, 5).orderBy("query_id").collect()] == [("q1", 1.0, 0.5), ("q2", 0.0, 0.0)]
    same, why = evaluation.rerank(results, None, "query_id", "doc_id", 1)
    assert same.count() == 1 and why.startswith("skipped")
    turned, why = evaluation.rerank(results, lambda q, t: F.length(q) + F.when(t == "d2", 1).otherwise(0), "query_id", "doc_id", 1)
    assert why == "ok" and [r.doc_id for r in turned.collect()] == ["d2"]
    guard = lambda **k: evaluation.experiment_guard("chronos", **({"periods": 3, "enabled": True, "environment": {}, "available": lambda _: True} | k))
    assert guard()["status"] == "ready" and guard(environment={"CI": "true"})["reason"] == "continuous integration"
    assert guard(periods=2)["reason"] == "fewer than 3 periods" and "torch" in guard(available=lambda _: False)["reason"] and guard(enabled=False)["status"] == "skipped"
    assert evaluation.preferred_judgments("p", " Adjudicated ").endswith("adjudicated_judgments.csv") and evaluation.preferred_judgments("p", "draft") == "p/judgments.csv"
    assert evaluation.pack_metadata({"pack_id": " x ", "reviewers": ["b", "a", "b", " "]})["reviewers"] == ["a", "b"]


def test_normalised_rows_and_paths(spark, tmp_path):
    raw = spark.createDataFrame([(" M&N ", "1", "25-35", "18-20%", 0), ("nan", "x", "", None, 1)], "b string, r string, s string, m string, at int")
    out = normalise.core_metrics(raw, {"b": "brand_name", "r": "rank", "s": "store_daily_equivalent_fte_range", "m": "store_margin_range_pct"}, "core", "at").orderBy("row_number").collect()
    assert (out[0].brand_name, out[0]["rank"], out[0].fte_mid, out[0].margin_mid_pct, out[0].row_number) == ("M&N", 1, 30.0, 19.0, 2) and out[1]["rank"] is None and out[1].fte_mid is None
    assert normalise.strategy_registry(raw.where("at = 0"), {"b": "brand_name"}, "s", "at").count() == 1
    with pytest.raises(ValueError):
        normalise.with_lineage(raw, {"zz": "y"}, "s", "at")
    raw.write.parquet(f"{tmp_path}/corpus")
    assert normalise.corpus_path(spark, "corpus", [str(tmp_path)]) == f"{tmp_path}/corpus"
    with pytest.raises(FileNotFoundError):
        normalise.corpus_path(spark, "none", [str(tmp_path)])
    got = normalise.dashboard_tables(spark, {"a": f"{tmp_path}/corpus", "b": f"{tmp_path}/none"})
    shown = json.loads(sinks.dashboard_json(got))
    assert len(shown["a"]) == 2 and shown["b"] is None


def test_written_files(spark, tmp_path):
    t = f"{tmp_path}/t.parquet"
    spark.createDataFrame([(1, "é")], "k int, v string").write.parquet(t)
    path = sinks.write_manifest(spark, f"{tmp_path}/m", "gate", [t], {"rows": 1}, [])
    latest = json.load(open(f"{tmp_path}/m/gate/latest.json"))
    assert latest == json.load(open(path)) and all(len(x["sha256"]) == 64 for x in latest["outputs"][t])
    assert json.load(open(sinks.write_audit(spark, f"{tmp_path}/a", "gate", ValueError("x"))))["error"] == "ValueError"
    cards = spark.createDataFrame([("Ä & B", "passed", ["x"]), ("Ä & b", "failed", [])], "subject string, validation_status string, open_issues array<string>")
    names = sinks.write_reports(spark, f"{tmp_path}/r", cards, "subject", "# All\n")
    assert len(set(names)) == 2 and "Ä &amp; B" in open(f"{tmp_path}/r/{names[0]}.html", encoding="utf-8").read()
    with pytest.raises(ValueError):
        sinks.write_reports(spark, f"{tmp_path}/r", cards, "subject", "", limit=1)
    assert "| 1 | é |" in scorecards.render("T", [("one", spark.read.parquet(t))])


def test_new_commands(spark, tmp_path):
    raw = f"{tmp_path}/raw.parquet"
    spark.createDataFrame([("A", "1-3", 0), ("B", "2", 1)], "n string, s string, at int").write.parquet(raw)
    out = f"{tmp_path}/out.parquet"
    main(["ingest", "--table", raw, "--names", "n=brand_name,s=store_daily_equivalent_fte_range", "--sheet", "core", "--position", "at", "--out", out])
    assert sorted(r.fte_mid for r in spark.read.parquet(out).collect()) == [2.0, 2.0]
    scored = f"{tmp_path}/scored.parquet"
    spark.createDataFrame([("a", "rank", 50.0, "blocked", True), ("a", "auv", 80.0, "publishable", False)], "brand string, metric string, score double, status string, review boolean").write.parquet(scored)
    main(["score-credibility", "--table", scored, "--subject", "brand", "--key", "brand,metric", "--out", f"{tmp_path}/cred"])
    assert spark.read.parquet(f"{tmp_path}/cred/credibility.parquet").first().least_metric == "rank" and "blocked" in open(f"{tmp_path}/cred/credibility.md").read()
    main(["package", "--tables", f"scored={scored}", "--out", f"{tmp_path}/pack"])
    assert spark.read.parquet(f"{tmp_path}/pack/scored.parquet").count() == 2
    with pytest.raises(ValueError):
        wanted = f"{tmp_path}/wanted.parquet"
        spark.createDataFrame([("a",), ("zz",)], "brand string").write.parquet(wanted)
        main(["demo", "--table", scored, "--wanted", wanted, "--key", "brand", "--out", out])
    assert len(COMMANDS) >= 31


def test_flags_of_the_published_policy(spark):
    claims = spark.createDataFrame([("a", "auv"), ("a", "rank"), ("b", "auv"), ("b", "fte_mid")], "subject string, metric string")
    found = spark.createDataFrame([("a", "implied_auv_k", "error"), ("b", "implied_auv_k", "warning"), (None, "brand_alignment.missing_ai_brands", "warning"), (None, "fte_range_order", "error")], "subject string, check_name string, severity string")
    out = {(r.subject, r.metric): (r.hard_fail, r.finding) for r in gate.finding_flags(claims, found, gate.POLICY_V1, "subject").collect()}
    assert out == {("a", "auv"): (True, True), ("a", "rank"): (False, True), ("b", "auv"): (False, True), ("b", "fte_mid"): (True, True)}
    assert [m.metric for m in gate.POLICY_V1.metrics if m.advisory_only] == ["fte_mid", "margin_mid_pct"]


def write_workbook(path):
    import zipfile

    main, links = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>1</v></c></row><row r="2"/><row r="3"><c r="A3" t="inlineStr"><is><t>Joe</t></is></c><c r="D3"><v>2.5</v></c></row><row r="4"><c r="B4" t="b"><v>1</v></c></row>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {links}><sheets><sheet name="Core" sheetId="1" r:id="r1"/><sheet name="Notes" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>brand</t></si><si><r><t>va</t></r><r><t>lue</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {main}><sheetData><row><c t="str"><v>note</v></c></row></sheetData></worksheet>')


def test_workbooks(spark, tmp_path):
    write_workbook(f"{tmp_path}/book.xlsx")
    df = workbook.read_sheet(spark, f"{tmp_path}/book.xlsx")
    assert df.columns == ["brand", "value", "value_2", "_position"]
    assert sorted(map(tuple, df.collect()), key=str) == [("Joe", None, "2.5", 0), (None, "TRUE", None, 1)]
    assert tables.read(spark, f"{tmp_path}/book.xlsx").columns == df.columns
    assert workbook.read_sheet(spark, f"{tmp_path}/book.xlsx", "Notes").count() == 0
    with pytest.raises(ValueError):
        workbook.read_sheet(spark, f"{tmp_path}/book.xlsx", "None")
