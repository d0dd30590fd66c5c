"""Types, filters, paths, responses, plans and keyed tables: edges."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tickspark.functions import inference as I
from tickspark.functions import paths, predicates, responses
from tickspark.functions import variants as V
from tickspark.functions.predicates import Condition
from tickspark.operators import keyed, requestlog, sync
from tickspark.sources import manifests, sinks
from tickspark.sources.shared import new_folder


def variants(spark, values):
    df = spark.createDataFrame([(i, f'{{"v":{v}}}' if v is not None else "{}") for i, v in enumerate(values)], "i int, j string")
    return df.select("i", V.get(V.parse(F.col("j")), "$.v").alias("v"))


def test_infer_type(spark):
    cases = {
        "true": "Boolean", "1": "UInt64", "-1": "Int64", "18446744073709551615": "UInt64", "18446744073709551616": "Float64", "1.0": "Float64", "1e3": "Float64", "null": "String", "[1]": "String", '{"a":1}': "String",
        '"12"': "UInt64", '"+12"': "UInt64", '"-12"': "Int64", '"1.5"': "Float64", '"INF"': "Float64", '"nan"': "Float64", '" 5 "': "String", '"1d"': "String", '""': "String", '"."': "String", '"-9223372036854775809"': "Float64", '"x"': "String",
    }
    rows = variants(spark, cases).select("i", I.infer_type(F.col("v")).alias("t")).orderBy("i").collect()
    assert dict(zip(cases, (r.t for r in rows), strict=True)) == cases


def test_coerce(spark):
    values = ["100", '"100.5"', '"7"', "1.5", "true", "null", '{"a":1}', None, '"x"']
    df = variants(spark, values)
    out = {m: [tuple(r)[1:] for r in df.select("i", *[I.coerce(F.col("v"), t, m).alias(t) for t in (I.UINT64, I.FLOAT64, I.BOOLEAN, I.STRING)]).orderBy("i").collect()] for m in ("zero", "null")}
    assert [int(r[0]) if r[0] is not None else None for r in out["zero"]] == [100, 0, 7, 0, 0, 0, 0, None, 0]
    assert [int(r[0]) if r[0] is not None else None for r in out["null"]] == [100, None, 7, None, None, None, None, None, None]
    assert [r[1] for r in out["zero"]] == [100.0, 100.5, 7.0, 1.5, 0.0, 0.0, 0.0, None, 0.0]
    assert [r[2] for r in out["zero"]] == [False, False, False, False, True, False, False, None, False]
    assert [r[3] for r in out["zero"]] == ["100", "100.5", "7", "1.5", "true", None, '{"a":1}', None, "x"]


def test_first_row_schema(spark):
    df = spark.createDataFrame([(2, '{"b":"x","a":1.5}'), (1, '{"b":"7","c":true}')], "n int, j string").select("n", V.parse(F.col("j")).alias("row"))
    assert [tuple(r) for r in I.infer_schema(df, "row", [F.col("n")]).collect()] == [("b", "UInt64"), ("c", "Boolean")]
    assert [tuple(r) for r in I.infer_schema(df, "row", [F.col("n")], "all_rows").collect()] == [("a", "Float64"), ("b", "String"), ("c", "Boolean")]


OPERATORS = {"gt": lambda a, b: a > b, "lt": lambda a, b: a < b, "gte": lambda a, b: a >= b, "lte": lambda a, b: a <= b}


def expected(row, c):
    if c.field not in row:
        return False
    a, b = row[c.field], c.value
    kind = lambda x: "n" if isinstance(x, (int, float)) and not isinstance(x, bool) else type(x).__name__
    same = kind(a) == kind(b) and a == b and kind(a) not in ("list", "dict")
    if c.operator in ("eq", "ne"):
        return same == (c.operator == "eq")
    if c.operator == "contains":
        return isinstance(a, str) and isinstance(b, str) and b in a
    return kind(a) == kind(b) and kind(a) in ("n", "str") and OPERATORS[c.operator](a, b)


def test_raw_conditions(spark):
    rows = [{}, {"f": None}, {"f": 5}, {"f": 5.5}, {"f": "5"}, {"f": "abc"}, {"f": True}, {"f": [1]}, {"f": {"a": 1}}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, j string").withColumn("row", V.parse(F.col("j")))
    conditions = [Condition("f", op, v) for op in ("eq", "ne", "gt", "lt", "gte", "lte", "contains") for v in (5, 5.5, "5", "abc", "b", True, None)]
    got = df.select("i", *[predicates.raw(F.col("row"), c).alias(str(k)) for k, c in enumerate(conditions)]).orderBy("i").collect()
    for r, row in zip(got, rows, strict=True):
        for k, c in enumerate(conditions):
            assert r[str(k)] == expected(row, c), (row, c)


def test_typed_conditions(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (3, "ab")], "n int, s string")
    n = lambda *cs: predicates.filter_any(df, [Condition(*c) for c in cs]).count()
    assert n() == 3 and n(("x", "ne", 1)) == 0 and n(("n", "eq", None)) == 1 and n(("n", "ne", 1)) == 2 and n(("n", "ne", "1")) == 3
    assert n(("n", "gt", "0")) == 0 and n(("s", "contains", "b")) == 1 and n(("s", "gte", "ab"), ("n", "lt", 2)) == 2
    plan = predicates.filter_any(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), [Condition("l_quantity", "gt", 10)])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan


@pytest.mark.parametrize("names,want", [(["a.txt"], "a.txt"), (["tick-1.p", "tick-2.p"], "tick"), (["ab", "cd"], "data"), (["x_y_1", "x_y_2", "x_y_"], "x_y"), (["abc", "abd"], "ab"), ([], "data"), (["a", "a"], "a")])
def test_common_prefix(spark, names, want):
    assert paths.common_prefix(spark.createDataFrame([(n,) for n in names], "name string")).collect()[0][0] == want


def test_paths(spark):
    df = spark.createDataFrame([("bk/a/b.zst.zst",), ("bk/",), ("bk/c",), ("other/x.zst",)], "k string")
    assert [r[0] for r in df.select(paths.local_path(F.col("k"), "bk", True)).collect()] == ["a/b", None, None, None]
    assert [r[0] for r in df.select(paths.local_path(F.col("k"), "bk")).collect()] == ["a/b.zst.zst", None, "c", None]
    size = spark.createDataFrame([(0,), (5 * 1048576 + 1,), (20 * 1048576,), (10**12,)], "n long")
    assert [r[0] for r in size.select(paths.transfer_budget_s(F.col("n"))).collect()] == [10, 11, 40, 3600]
    names = spark.createDataFrame([("BTC-USDT",), ("plain",), ("a-b-c",)], "n string")
    assert [r[0] for r in names.select(paths.symbol_from_name(F.col("n"))).collect()] == ["USDT", "plain", "c"]
    out = spark.createDataFrame([("/x/.git/y",), ("a.tmp",), ("tmp/a",), ("keep",)], "p string")
    assert [r[0] for r in out.select(predicates.matches_path(F.col("p"), ["*.git*", "*.tmp", "tmp*"])).collect()] == [True, True, True, False]


def test_responses(spark):
    cases = [(200, '{"errors":[]}', True), (200, '{"errors":[1]}', False), (404, "{}", False), (None, "{}", False), (204, "", True), (200, "no json", True), (200, '{"errors":"x"}', True), (299, "[1]", True), (200, None, True)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s int, b string, w boolean")
    assert all(r[0] == r[1] for r in df.select("w", responses.is_success(F.col("s"), F.col("b"))).collect())
    row = df.limit(1).select(responses.content_class(F.lit(200), F.lit("a\nb\tc"), F.lit(None).cast("string")), responses.content_class(F.lit(None), F.lit(""), F.lit(None).cast("string")), responses.content_class(F.lit(1), F.lit("x"), F.lit("e" * 80))).first()
    mark = lambda b: df.limit(1).select(responses.content_class(F.lit(200), F.lit(b), F.lit(None).cast("string"))).first()[0].rsplit(" (#", 1)[1]
    assert mark("x" * 100 + "a") == mark("x" * 100 + "a") != mark("x" * 100 + "b") and len(mark("abc")) <= 5
    assert row[0].startswith("HTTP 200 - abc (#") and row[1] == "HTTP 0 Empty" and row[2] == "ERROR: " + "e" * 50


def test_request_log_edges(spark):
    empty = spark.createDataFrame([], "status int, success boolean, duration_ms long, error string, response_excerpt string, response_content_key string")
    assert tuple(requestlog.request_totals(empty).first()) == (0, 0, 0, 0.0)
    assert tuple(requestlog.latency_stats(empty).first()) == (0, 0, 0.0)
    for f in (requestlog.status_distribution, requestlog.error_distribution, requestlog.content_distribution, requestlog.latency_percentiles):
        assert f(empty).count() == 0
    log = spark.createDataFrame([(n,) for n in (4, 1, 3, 2)], "duration_ms long")
    assert {r.percent: r.ms for r in requestlog.latency_percentiles(log).collect()} == {50: 3, 90: 4, 95: 4, 99: 4}


def test_plans(spark):
    local = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", 4, "w"), ("skip.tmp", 1, "t")], "path string, size long, hash string")
    cache = spark.createDataFrame([("a", 1, "x", 100), ("b", 2, "old", 100), ("gone", 5, "g", 100)], "path string, size long, hash string, last_sync long")
    remote = spark.createDataFrame([("p/a", 1, 101), ("p/b", 9, 50), ("p/c", 3, 0), ("p/new", 7, 0)], "key string, size long, last_modified long")
    up = {r.path: (r.action, r.reason) for r in sync.plan_upload(local, cache, remote, "p/", exclude=["*.tmp"]).collect()}
    assert up == {"a": ("skip", "unchanged"), "b": ("upload", "changed"), "c": ("skip", "already_remote"), "d": ("upload", "new")}
    assert {r.reason for r in sync.plan_upload(local, cache, remote, "p", force=True, compress=True).collect()} == {"forced"}
    down = {r.path: (r.action, r.reason) for r in sync.plan_download(remote, local, cache, "p").collect()}
    assert down == {"a": ("download", "newer"), "b": ("download", "size"), "c": ("skip", "unchanged"), "new": ("download", "absent")}
    assert [r.path for r in sync.plan_delete(cache, local).collect()] == ["gone"]
    assert [tuple(r) for r in sync.verify_backup(local, remote, "p").collect()] == [("b", 2, 9)]
    files = spark.createDataFrame([("f", "m1"), ("g", "m2"), ("h", "m3"), ("i", "m4"), ("j", "m5")], "path string, md5 string")
    ledger = spark.createDataFrame([("m1", "completed"), ("m2", "failed"), ("m3", "uploading"), ("m4", "completed")], "md5 string, status string")
    there = files.filter("md5 = 'm1'").select("md5")
    assert [r.status for r in sync.plan_publish(files, ledger, there).orderBy("path").collect()] == ["ready", "pending", "wait", "pending", "pending"]
    assert {r.status for r in sync.plan_publish(files, ledger, there, force=True).collect()} == {"pending"}


def test_keyed(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    batch = spark.createDataFrame([("b", "x", 1), ("b", None, 2), ("c", "3", 1), (None, "n", 1)], "key string, value string, n int")
    assert sorted(map(tuple, keyed.upsert(table, batch, "key", "n").collect())) == [("a", "1"), ("b", None), ("c", "3")]
    new, old = keyed.insert_if_absent(table, batch.filter("n = 1 AND key IS NOT NULL").drop("n"), "key")
    assert sorted(r.key for r in new.collect()) == ["a", "b", "c"] and [r.key for r in old.collect()] == ["b"]
    left, gone = keyed.delete_keys(table, batch, "key")
    assert [r.key for r in left.collect()] == ["a"] and gone.first()[0] == 1
    assert [(r.key, r.found) for r in keyed.lookup_keys(batch.select("key").distinct(), table, "key").filter("key is not null").orderBy("key").collect()] == [("b", True), ("c", False)]


def test_merge_json(spark):
    table = spark.createDataFrame([("u", '{"name":"A","age":30,"email":"e"}'), ("n", "5"), ("k", '{"a":1}')], "key string, value string")
    changes = spark.createDataFrame([("u", '{"age":31,"city":null}'), ("n", '{"a":1}'), ("new", '{"z":1}')], "key string, value string")
    got = {r.key: json.loads(r.value) for r in keyed.merge_json(table, changes).collect()}
    assert got == {"u": {"name": "A", "age": 31, "email": "e", "city": None}, "n": {"a": 1}, "k": {"a": 1}, "new": {"z": 1}}


def test_files(spark):
    path = new_folder(spark, "files")
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS s")
    sinks.write_chunked(df.coalesce(1), path, 4)
    manifest = manifests.scan_manifest(spark, path)
    names = [r.path for r in manifest.filter("path LIKE '%.parquet'").collect()]
    for r in manifest.collect():
        with open(f"{path.removeprefix('file:')}/{r.path}", "rb") as f:
            assert r.hash == hashlib.sha256(f.read()).hexdigest()
    assert len(names) == 3 and sorted(n.split("/")[0] for n in names) == [f"sequence={i:06}" for i in (1, 2, 3)]
    assert sinks.check_schema_drift(spark, path, df.schema).count() == 0
    listing = spark.createDataFrame([("d/x", 1), ("d/e/y", 2), ("z", 3), ("d/e/w", 4)], "path string, size long")
    assert [tuple(r) for r in manifests.list_dir(listing, "d").collect()] == [("e", True, 0), ("x", False, 1)]
    assert [tuple(r) for r in manifests.list_dir(listing).collect()] == [("d", True, 0), ("z", False, 3)]
    assert [r.path for r in manifests.list_prefix(listing, "d/", 2).collect()] == ["d/e/w", "d/e/y"]
    target = new_folder(spark, "compact")
    sinks.compact_parquet(spark, path, target, "id", descending=True)
    assert [r.id for r in spark.read.parquet(target).collect()] == list(range(9, -1, -1))


def test_drift_and_unreadable(spark):
    path = new_folder(spark, "drift")
    spark.range(1).selectExpr("id AS a", "'x' AS b").coalesce(1).write.parquet(path)
    want = spark.range(1).selectExpr("cast(id AS int) AS a", "'x' AS c", "1.0D AS d").schema
    got = {(r.field, r.status) for r in sinks.check_schema_drift(spark, path, want).collect()}
    assert got == {("a", "type"), ("c", "name"), ("d", "missing")}
