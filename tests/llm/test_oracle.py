"""Queries that SQL can express, against DuckDB on the smallest tables; the registered names; the guard of the entry module."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerfold.llm.queries import QUERIES, oracle_sql

SF = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(c) for c in columns]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


def test_entry_works_without_the_subpackage_but_hides_no_other_error(tmp_path):
    repo = Path(entry.__file__).parent
    (tmp_path / "ledgerfold").mkdir()
    for p in (repo / "ledgerfold").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "ledgerfold" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((repo / "__spark_entry__.py").read_text())
    run = lambda code: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    out = run("import __spark_entry__ as e; q = e.queries(); print('check_all' in q, any(n.startswith('op') for n in q), 'pipeline' in q, len(e.oracle_sql()) > 20)")
    assert out.stdout.split() == ["True", "False", "False", "True"], out.stderr
    (tmp_path / "ledgerfold/llm").mkdir()
    (tmp_path / "ledgerfold/llm/__init__.py").write_text("")
    (tmp_path / "ledgerfold/llm/queries.py").write_text("import no_such_library\n")
    assert "no_such_library" in run("import __spark_entry__").stderr
