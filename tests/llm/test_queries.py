import duckdb
import pytest

from tickspark.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = Q.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(Q.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == cols
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(tuple(r[names.index(c)] for c in cols) for r in want.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))
