"""Every registered query of the feed operators against its SQL."""

import math

import duckdb
import pytest

from tickspark.plans import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "-"
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_rows(spark, sf, duck, name):
    got = Q.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = duck.execute(Q.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    rows = lambda it, pick: sorted(tuple(plain(r[i]) for i in pick) for r in it)
    assert rows(got.select(cols).collect(), range(len(cols))) == rows(want.fetchall(), at)


def test_all_ids_are_there():
    have = {n.split("_")[0] for n in Q.QUERIES}
    want = {f"{k}{i}" for k, n in {"a": 9, "b": 6, "c": 22, "d": 12, "e": 14, "f": 12, "h": 14, "i": 4, "j": 2}.items() for i in range(1, n + 1)}
    assert want <= have
