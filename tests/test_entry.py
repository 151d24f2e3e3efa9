"""Driver contract: entry() and every query against its DuckDB oracle at sf0.001."""

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from roadpulse.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "congestion_level" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, s_rows) == _rows(o_cols, res.fetchall())


BLOCKED = """
import importlib.abc, sys
sys.path.insert(0, {root!r})
class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name.startswith("roadpulse.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as E
print(len(E.queries()), len(E.oracle_sql()))
"""


def test_entry_without_the_optional_subpackage():
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", BLOCKED.format(root=root)], capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES))] * 2
