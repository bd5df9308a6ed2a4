"""The registered queries against their SQL on the smallest tables; `-m slow` runs those that take longer.

`python tools/check.py` does the same for all of them at any scale.
"""

import collections
import re

import duckdb
import pytest

import __spark_entry__ as se
from tools.check import TABLES, plain

FOLDER = "/root/testdata/sf0.001"
QUICK = [n for n in se.catalog.QUERIES if re.match(r"(prj|flt|jn_0[1-8]|ag|win|srt|set|idx|fn|ev_0)", n)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


REST = [n for n in se.catalog.QUERIES if n not in QUICK]


@pytest.mark.parametrize("name", [*QUICK, *[pytest.param(n, marks=pytest.mark.slow) for n in REST]])
def test_same_rows_as_sql(spark, duck, name):
    df = se.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(se.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    assert sorted(names) == cols
    assert got == collections.Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def test_registry():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert set(se.catalog.QUERIES) | set(se.CORPUS) == set(se.queries())


def test_entry(spark):
    assert se.entry(spark).columns == ["word", "n"]
