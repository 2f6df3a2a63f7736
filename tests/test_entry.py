"""The driver contract: every query runs on the smallest tables and equals its SQL there."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from quern.plans import registry as plans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the driver's tables")


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in plans.ORACLE_SQL:
        duck.execute(plans.ORACLE_SQL[name])
        names = [d[0] for d in duck.description]
        want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in duck.fetchall()), key=repr)
        assert sorted(names) == columns and got == want


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "doc_id" in entry.entry(spark).columns
