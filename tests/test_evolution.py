"""Directories of files with several schemas."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.sources import evolution as E
from tickspark.sources.shared import new_folder

SIMPLE = [T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.DateType(), T.NullType(), T.DecimalType(10, 2), T.DecimalType(20, 0), T.DecimalType(38, 10)]
kind = st.recursive(st.sampled_from(SIMPLE), lambda t: st.one_of(t.map(T.ArrayType), st.lists(t, min_size=1, max_size=2).map(lambda ts: T.StructType([T.StructField(f"f{i}", x) for i, x in enumerate(ts)]))), max_leaves=4)


@given(kind, kind)
def test_widest_is_symmetric_and_holds_both(a, b):
    w = E._plain(E.widest(a, b))
    assert w == E._plain(E.widest(b, a)) and E._plain(E.widest(w, a)) == w == E._plain(E.widest(w, b)) and E.widest(a, a) == a


def test_widest_types():
    assert E.widest(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert E.widest(T.DecimalType(10, 2), T.LongType()) == T.DecimalType(21, 2)
    assert E.widest(T.DecimalType(38, 10), T.DecimalType(38, 0)) == T.DoubleType()
    assert E.widest(T.BooleanType(), T.LongType()) == T.StringType()
    assert E.widest(T.DateType(), T.TimestampType()) == T.TimestampType()


def test_files_of_three_schemas_are_one_table(spark):
    path = new_folder(spark)
    spark.range(2).selectExpr("int(id) AS n", "named_struct('a', int(1)) AS s", "array(int(id)) AS l", "map('k', int(1)) AS m", "'x' AS `odd name`").write.mode("append").parquet(path)
    spark.range(2, 4).selectExpr("id + 0.5D AS N", "named_struct('a', 2.5D, 'b', 'new') AS s", "array('t') AS l", "map('k', 2L) AS m").write.mode("append").parquet(path)
    spark.range(4, 5).selectExpr("float(null) AS n", "cast(null AS struct<a: int>) AS s", "5 AS l").write.mode("append").parquet(path)
    got = E.read_evolved(spark, path)
    kinds = {f.name.lower(): f.dataType.simpleString() for f in got.schema}
    assert kinds == {"n": "double", "s": "struct<a:double,b:string>", "l": "string", "m": "map<string,bigint>", "odd name": "string"}
    rows = {r[0]: r for r in got.select("n", "s", "l", "m", "`odd name`").collect()}
    assert set(rows) == {0.0, 1.0, 2.5, 3.5, None}
    assert rows[1.0].s == (1.0, None) and rows[2.5].s == (2.5, "new") and rows[None].s is None
    assert (rows[1.0].l, rows[2.5].l, rows[None].l) == ("[1]", '["t"]', "5")
    assert rows[1.0].m == {"k": 1} and rows[None].m is None and rows[0.0]["odd name"] == "x" and rows[2.5]["odd name"] is None
    assert E.wide_schema(spark, path) == got.schema


def test_files_of_other_writers_and_unreadable_ones(spark):
    path = new_folder(spark)
    spark.range(1).selectExpr("id AS u").write.parquet(path)
    local = path.removeprefix("file:")
    pq.write_table(pa.table({"u": pa.array([2**64 - 1], pa.uint64()), "w": pa.array([7], pa.uint32())}), f"{local}/other.parquet")
    got = E.read_evolved(spark, path)
    assert {(int(r.u), r.w) for r in got.collect()} == {(0, None), (2**64 - 1, 7)}
    with open(f"{local}/bad.parquet", "wb") as f:
        f.write(b"PAR1nothing")
    with pytest.raises(ValueError, match="1 unreadable"):
        E.read_evolved(spark, path)
    assert E.read_evolved(spark, path, skip_unreadable=True).count() == 2
    assert E.file_schemas(spark, path).filter("error IS NOT NULL").count() == 1


def test_schema_is_checked_before_a_write(spark):
    path = new_folder(spark)
    E.append_checked(spark.range(2).selectExpr("id AS a", "1.5D AS b"), path, widen=False)
    E.append_checked(spark.range(2, 3).selectExpr("int(id) AS A"), path, widen=False)
    assert spark.read.parquet(path).count() == 3 and len(E._groups(spark, path, False)) == 1
    for more in ("'t' AS a", "id AS a, 1 AS c"):
        with pytest.raises(ValueError, match="grow"):
            E.append_checked(spark.range(1).selectExpr(*more.split(", ")), path, widen=False)
    assert E.read_evolved(spark, path).count() == 3
    E.append_checked(spark.range(1).selectExpr("'t' AS a"), path)
    assert sorted(r.a for r in E.read_evolved(spark, path).collect()) == ["0", "1", "2", "t"]


def test_columns_are_pruned_and_filters_pushed(spark):
    path = new_folder(spark)
    for more in ("1 AS c", "1L AS c", "'x' AS c"):
        spark.range(3).selectExpr("id AS a", "id AS b", more).write.mode("append").parquet(path)
    df = E.read_evolved(spark, path).filter(F.col("a") > 1).select("a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(a), GreaterThan(a,1)]") == 3 and "ReadSchema: struct<a:bigint>" in plan and "c:" not in plan
    assert df.count() == 3
    assert E.read_evolved(spark, new_folder_empty(spark)).count() == 0


def new_folder_empty(spark):
    path = new_folder(spark)
    spark.range(0).selectExpr("id AS a").write.parquet(path)
    return path
