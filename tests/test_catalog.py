"""Every registered query against its DuckDB SQL oracle (sf0.001), plus
the driver contract."""

import hashlib
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry_mod
from gaugeworks.sources.tables import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), len(lines)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sqls) <= set(qs)


SQLS = entry_mod.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(SQLS[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - set(SQLS)))
def test_query_without_oracle_gives_named_rows(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_query_reads_whole_tables(spark, name):
    plan = entry_mod.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # WindowGroupLimit is how the optimizer computes a rank filter, no limit on rows
    assert not re.search(r"\b(GlobalLimit|LocalLimit|Tail|Sample)\b", plan)
