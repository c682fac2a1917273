"""Every registered query of the record engine against its SQL twin."""

import glob
import os

import duckdb
import pytest

from recordforge.plans import registry

DIR = os.environ.get("RECORDFORGE_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(registry.CASES))
def test_case_equals_its_statement(spark, duck, name):
    fn, sql = registry.CASES[name]
    df = fn(spark, DIR)
    cols = sorted(df.columns)
    want = duck.execute(f"select {', '.join(cols)} from ({sql})").fetchall()
    assert sorted([plain(r[c]) for c in cols] for r in df.collect()) == sorted([plain(v) for v in r] for r in want)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    rows = df.collect()
    if name not in registry.ORACLES:
        assert rows
        return
    cols = sorted(df.columns)
    want = duck.execute(f"select {', '.join(cols)} from ({registry.ORACLES[name]})").fetchall()
    assert sorted([plain(r[c]) for c in cols] for r in rows) == sorted([plain(v) for v in r] for r in want)


def test_flagship_is_registered():
    assert registry.FLAGSHIP in registry.QUERIES and registry.FLAGSHIP in registry.ORACLES
