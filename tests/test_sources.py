import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import quality
from ledgerlens.sources import sinks, tables
from ledgerlens.streaming import checks


def test_required_and_optional_tables(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/silver/a.parquet")
    assert tables.load_tables(spark, str(tmp_path), ["a"])["a"].count() == 3
    with pytest.raises(ValueError, match="b, c"):
        tables.load_tables(spark, str(tmp_path), ["c", "b"])
    got, warnings = tables.load_optional(spark, f"{tmp_path}/silver", {"a": T.StructType(), "z": T.StructType([T.StructField("x", T.LongType())])})
    assert got["z"].columns == ["x"] and warnings == ["z is missing"]
    with pytest.raises(ValueError, match="binary format"):
        tables.read(spark, "x.xls")


def test_templates_and_standard_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/ranking.csv").write_text("brand_name,store_count,extra\nCafé  X,\"1,200\",\n,5,\n")
    (tmp_path / "in/unknown.csv").write_text("a\n1\n")
    df, warnings = tables.load_templates(spark, str(tmp_path / "in"), {"ranking.csv": ["brand_name", "store_count"]})
    assert sorted(warnings) == ["ranking.csv: unexpected column extra", "unknown.csv is no known template"]
    out = tables.standardise(df, "ranking", {"stores": ["store_count"]}).collect()
    assert [(r.canonical_brand_name, r.stores) for r in out] == [("Cafe X", 1200.0)]
    with pytest.raises(ValueError, match="missing columns rank"):
        tables.load_templates(spark, str(tmp_path / "in"), {"ranking.csv": ["rank"]})


def test_snapshots_gate_and_manifest(spark, tmp_path):
    folder = str(tmp_path / "history")
    for day, n in (("2024-01-01", 2), ("2024-02-01", 3), ("2024-01-01", 5)):
        sinks.write_snapshot(spark.range(n), folder, day)
    assert [(str(r.as_of_date), r["rows"]) for r in sinks.snapshot_index(spark, folder).collect()] == [("2024-01-01", 5), ("2024-02-01", 3)]
    d = spark.createDataFrame([(1, "blocked", ["a"]), (2, "publishable", [])], "k int, status string, reasons array<string>")
    sinks.write_gate(d, str(tmp_path / "gold"))
    assert [r.k for r in sinks.read_gate(spark, str(tmp_path / "gold"), "blocked").collect()] == [1]
    sinks.write_table(d, f"{tmp_path}/t.parquet")
    assert {r.reasons for r in spark.read.parquet(f"{tmp_path}/t.parquet").collect()} == {'["a"]', "[]"}
    got = json.loads(sinks.manifest(spark, "gate", [f"{tmp_path}/t.parquet"], {"rows": 2}, []))
    assert all(len(f["sha256"]) == 64 for f in got["outputs"][f"{tmp_path}/t.parquet"])
    assert json.loads(sinks.audit_record("x", ValueError("no")))["error"] == "ValueError"


def test_guard_and_fixture():
    assert sinks.guard("artifacts/run/a", "artifacts", ["reports"]) == "artifacts/run/a"
    for path, root in (("reports/a", "artifacts"), ("artifacts/../x", "artifacts"), ("reports/x", "reports")):
        with pytest.raises(ValueError):
            sinks.guard(path, root, ["reports"])
    assert tables.load_query_fixture('{"queries": [{"q": 1}]}') == [{"q": 1}]
    with pytest.raises(ValueError):
        tables.load_query_fixture('"x"')
    assert sinks.redacted({"API_KEY": "x", "path": "y"}) == {"API_KEY": "***", "path": "y"}


def test_json_columns_and_corpus(spark):
    df = spark.createDataFrame([('{"a": 1}',), (" ",), ("bad",)], "j string")
    assert [r.j_parsed.a if r.j_parsed else None for r in tables.parse_json_columns(df, {"j": "a int"}).collect()] == [1, None, None]
    part = spark.createDataFrame([("X 1", "T", 3)], "doc_id string, title string, v int")
    r = tables.corpus({"notes": (part, ["v"])}).first()
    assert (r.doc_id, r.text) == ("notes:x-1", "T\nv: 3")


def test_stream_checks(spark, tmp_path):
    src = str(tmp_path / "events")
    rows = [(i, f"2024-01-0{1 + i % 3} 10:00:00", i - 3) for i in range(9)]
    spark.createDataFrame(rows, "id int, ts string, v int").withColumn("ts", F.to_timestamp("ts")).write.parquet(src)
    stream = spark.readStream.schema("id int, ts timestamp, v int").parquet(src)
    q = checks.windowed_violations(stream, "ts", [quality.in_range("v", 0)]).writeStream.format("memory").queryName("violations").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(violations) from violations").first()[0] == 3
    q = checks.each_batch(stream, lambda b: quality.duplicates(b, ["v"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 0
