import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from compare import norm

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parent.parent
NATIVE = [n for n in entry.oracle_sql() if n.startswith("q_")]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no driver tables here")
    c = duckdb.connect()
    for p in sorted(Path(SF).glob("*.parquet")):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NATIVE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted("|".join(norm(r[c]) for c in columns) for r in df.collect())
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    assert got == sorted("|".join(norm(r[names.index(c)]) for c in columns) for r in rel.fetchall())


def test_every_oracle_has_a_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(copy)})
    assert said.returncode == 0, said.stderr
    assert "q_implied_value" in said.stdout and "op5_simhash" not in said.stdout and "pipeline" not in said.stdout
