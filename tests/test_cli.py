import json

import pytest

from ledgerlens.__main__ import COMMANDS, main


def test_commands_write_tables(spark, tmp_path, capsys):
    docs = str(tmp_path / "docs.parquet")
    spark.createDataFrame([(1, "apple pie"), (2, "plain text")], "doc_id int, text string").write.parquet(docs)
    out = str(tmp_path / "found.parquet")
    assert main(["search", "--table", docs, "--id", "doc_id", "--text", "text", "--query", "apple", "--out", out, "--k", "1"]) == 0
    assert [r.doc_id for r in spark.read.parquet(out).collect()] == [1]
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "success"
    rows = str(tmp_path / "rows.parquet")
    spark.createDataFrame([(float(i), i + 1, float(i)) for i in range(60)], "rev double, n long, actual double").write.parquet(rows)
    main(["validate", "--table", rows, "--amount", "rev", "--count", "n", "--actual", "actual", "--out", out])
    assert sum(r["rows"] for r in spark.read.parquet(out).collect()) == 60
    main(["signals", "--table", rows, "--fields", "actual", "--out", out])
    assert {r.signal_type for r in spark.read.parquet(out).collect()} == {"benford_first", "end_digit_heaping", "nice_numbers"}
    with pytest.raises(SystemExit):
        main(["search"])
    assert len(COMMANDS) >= 15
