"""Every core query against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from lodestream.plans import queries as core

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(x):
        return round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else x if x is None else str(x)

    return Counter(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = core.QUERIES[name](spark, DATA)
    rel = duck.sql(core.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert core.QUERIES[name](spark, DATA).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_does_not_import_llm():
    import subprocess
    import sys

    code = "import sys; import lodestream.plans.queries; sys.exit(any(m.startswith('lodestream.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(__file__))).returncode == 0
