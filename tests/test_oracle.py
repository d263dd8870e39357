"""Every registered query against its independent DuckDB oracle (sf0.001).

Row count, column names and the multiset of rows must be identical; doubles
are compared exactly (both sides sum money as decimals and round alike).
"""

import datetime
import decimal

import pytest

import __spark_entry__ as E

ORACLE = E.oracle_sql()
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER",
                 "double": "DOUBLE", "date": "DATE"}
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, float) and v != v:
        return "NaN"
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    missing = sorted(set(QUERIES) - set(ORACLE))
    # Only queries that are not SQL-expressible may lack an oracle.
    plain = [q for q in missing if not q.startswith("op") and q != "pipeline"]  # these have tests of their own
    assert plain == sorted(E.NO_ORACLE), plain


@pytest.mark.parametrize("name", sorted(q for q in ORACLE if not q.startswith("op")))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cols = df.columns
    rows = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    rel = duck.sql(ORACLE[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == otypes
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert len(rows) == len(orows)
    assert rows == orows


def test_entry_smoke(spark):
    out = E.entry(spark).collect()
    assert len(out) == 1
    assert out[0]["total_claims"] > 0
