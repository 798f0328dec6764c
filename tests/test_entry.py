"""The driver's contract: every query has SQL that agrees where SQL can express it, and the rest works without the optional part."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from quire.plans import catalog

ROOT, DATA = os.path.dirname(os.path.abspath(entry.__file__)), "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@needs_data
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    df = catalog.QUERIES[name](spark, DATA)
    want = con.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda rows: sorted(repr([plain(v) for v in r]) for r in rows)
    assert key(df.select(*columns).collect()) == key(want.fetchall())


def test_only_the_html_query_lacks_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"html_to_markdown"}


def test_works_without_the_optional_part(tmp_path):
    for name in ("quire", "__spark_entry__.py"):
        (shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy)(f"{ROOT}/{name}", tmp_path / name)
    shutil.rmtree(tmp_path / "quire/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'route_record' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


@needs_data
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "route", "pages", "vlm_pages", "confidence"] and df.count() == 200
