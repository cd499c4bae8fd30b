"""Every query of the library against its SQL on the smallest tables; those without SQL must run."""

import datetime
import decimal

import duckdb
import pytest

from tidemark import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"m1_text_model", "m2_role_model", "m7_ablation", "a34_fold_metrics"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 5) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return repr(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    cur = duck.execute(catalog.oracle_sql()[name])
    names = sorted(d[0] for d in cur.description)
    place = [[d[0] for d in cur.description].index(n) for n in names]
    want = sorted([[plain(r[i]) for i in place] for r in cur.fetchall()], key=str)
    assert sorted(df.columns) == names
    got = sorted([[plain(r[n]) for n in names] for r in df.collect()], key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - SLOW))
def test_runs(spark, sf, name):
    df = catalog.queries()[name](spark, sf)
    assert df.columns and df.count() >= 0
