"""One registered query for each operator, with its SQL where SQL can express it.

Names begin with the operator's id. Every query reads the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions import inference, paths, predicates, responses
from tickspark.functions import messages as M
from tickspark.functions import variants as V
from tickspark.functions.predicates import Condition
from tickspark.operators import fill, keyed, ledger, merge, requestlog, sync
from tickspark.plans import daily, late
from tickspark.plans import fixtures as X
from tickspark.sources import evolution, feeds, manifests, sinks
from tickspark.sources.shared import new_folder, stored
from tickspark.streaming import flush, ingest, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
DAY = date.fromisoformat(X.DAY)
A = fill.day_start(DAY)
Z = A + fill.DAY - 1
TEXT = "*.txt*"  # Spark's text writer names its files so
EV = f"WITH {X.EVENTS}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def event_lines(e: DataFrame) -> DataFrame:
    return e.select(F.to_json(F.struct("event_id", "symbol", "ms")).alias("value"))


def from_lines(lines: DataFrame, *more: str) -> DataFrame:
    row = F.from_json("line", "event_id long, symbol string, ms long")
    return lines.select(row.alias("r"), *more).select("r.*", *more)


# sources


@query("a1_scan_jsonl_day", f"{EV} SELECT event_id, symbol, ms FROM ev")
def a1(spark, d):
    base = new_folder(spark, "feed")
    event_lines(X.events(spark, d)).write.text(feeds.day_path(base, DAY))
    return from_lines(feeds.scan_jsonl_day(spark, base + "/", DAY, pattern=TEXT))


def source_bases(spark: SparkSession, lines: DataFrame) -> list[str]:
    """(source, value) written to three bases, one day."""
    bases = [new_folder(spark, f"source{k}") for k in range(3)]
    for k, base in enumerate(bases):
        lines.filter(F.col("source") == k).select("value").write.text(feeds.day_path(base, DAY))
    return bases


@query("a2_scan_multi_source", f"{EV} SELECT event_id, symbol, ms, source AS source_priority FROM ev")
def a2(spark, d):
    e = X.events(spark, d)
    lines = e.select("source", F.to_json(F.struct("event_id", "symbol", "ms")).alias("value"))
    return from_lines(feeds.scan_sources(spark, source_bases(spark, lines), DAY, TEXT), "source_priority").withColumn("source_priority", F.col("source_priority").cast("long"))


@query("a3_scan_compressed", f"{EV} SELECT event_id, symbol, ms, source AS source_priority, CAST(NULL AS VARCHAR) AS error FROM ev UNION ALL SELECT NULL, NULL, NULL, 3, 'unreadable' FROM (SELECT 1 FROM events LIMIT 1)")
def a3(spark, d):
    """Plain, gzip and zstd files, all named .jsonl; of one more source the only file is cut off. Ids that are negative or null have sources of their own."""
    e = X.events(spark, d)
    found = sorted((r.source for r in e.select("source").distinct().collect()), key=lambda k: (k is None, k))

    def scanned(k: int | None, priority: int | None, codec: str, cut: int = 0) -> DataFrame:
        base = new_folder(spark, f"source{priority}")
        lines = event_lines(e.filter(F.col("source").eqNullSafe(k)))
        X.write_coded(lines.coalesce(1) if cut else lines, feeds.day_path(base, DAY), codec, cut=cut)
        return feeds.scan_jsonl_day(spark, base, DAY, priority)

    whole = [scanned(k, k, ("plain", "gzip", "zstd")[(k or 0) % 3]) for k in found]
    broken = scanned(found[0] if found else 0, 3, "gzip", cut=20)
    rows = from_lines(reduce(DataFrame.unionByName, [*whole, broken]), "source_priority", "error")
    return rows.select("event_id", "symbol", "ms", F.col("source_priority").cast("long").alias("source_priority"), F.when(F.col("error").isNotNull(), "unreadable").alias("error"))


def tick_lines(spark: SparkSession, d: str) -> DataFrame:
    return X.events(spark, d).select("event_id", "source", X.mark_price_line().alias("line"))


BLANK = "event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 = 0"
OBJECT = "event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0"


@query("a4_parse_lines", f"{EV} SELECT event_id, event_id % 97 <> 0 AS parsed, {OBJECT} AS is_object FROM ev WHERE NOT ({BLANK})")
def a4(spark, d):
    return feeds.parse_lines(tick_lines(spark, d)).select("event_id", F.col("row").isNotNull().alias("parsed"), V.is_object(F.col("row")).alias("is_object"))


@query("a5_scan_parquet_dir", f"{EV} SELECT event_id, cents FROM ev")
def a5(spark, d):
    path = new_folder(spark)
    X.events(spark, d).select("event_id", "cents").write.parquet(path)
    return feeds.scan_parquet_dir(spark, path)


@query("a6_scan_manifest", f"{EV} SELECT symbol, 'block=' || event_id // 1000 AS folder, CAST(sum(len(event_id || '') + 1) AS BIGINT) AS size, sha256(string_agg(event_id || chr(10), '' ORDER BY event_id)) AS hash, true AS dated FROM ev GROUP BY ALL")
def a6(spark, d):
    path = new_folder(spark, "files")
    lines = X.events(spark, d).select(F.col("event_id").cast("string").alias("value"), "event_id", "symbol", F.floor(F.col("event_id") / 1000).alias("block"))
    lines.repartition("symbol", "block").sortWithinPartitions("symbol", "block", "event_id").drop("event_id").write.partitionBy("symbol", "block").text(path)
    found = manifests.scan_manifest(spark, path).filter(F.col("path").endswith(".txt"))
    parts = F.split("path", "/")
    return found.select(F.substring_index(parts[0], "=", -1).alias("symbol"), parts[1].alias("folder"), "size", "hash", (F.col("modified_time") > 1_700_000_000).alias("dated"))


@query("a7_list_dir", f"WITH {X.FILES} SELECT DISTINCT split_part(path, '/', 1) AS name, true AS is_dir, CAST(0 AS BIGINT) AS size FROM loc")
def a7(spark, d):
    return manifests.list_dir(X.manifests(spark, d)[0])


@query("a8_list_prefix", f"WITH {X.FILES} SELECT key FROM rem WHERE starts_with(key, 'bk/src1')")
def a8(spark, d):
    return manifests.list_prefix(X.manifests(spark, d)[2], "bk/src1", column="key")


def landing(spark: SparkSession, lines: DataFrame) -> str:
    path = new_folder(spark, "landing")
    lines.write.text(path)
    return path


@query("a9_stream_landing", f"{EV} SELECT event_id, symbol, ms FROM ev")
def a9(spark, d):
    out = new_folder(spark, "sink")
    stream = feeds.stream_landing(spark, landing(spark, event_lines(X.events(spark, d))), 4)
    ingest.write_stream(stream, out, new_folder(spark, "progress")).awaitTermination()
    return from_lines(spark.read.schema("value string").parquet(out).withColumnRenamed("value", "line"))


# sinks


@query("b1_write_day", f"{EV} SELECT event_id, year(t) AS year, month(t) AS month, day(t) AS day FROM (SELECT event_id, make_timestamp(ms * 1000) AS t FROM ev)")
def b1(spark, d):
    path = new_folder(spark)
    e = X.events(spark, d)
    sinks.write_day(e.select("event_id", "sec").withColumn("at", paths.day_of(F.col("sec"))), path, F.col("at"))
    return spark.read.parquet(path).select("event_id", *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")])


@query("b2_write_per_symbol", f"{EV}, f AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY symbol, sec ORDER BY source, event_id) = 1) SELECT symbol, sec, event_id, CAST(CAST(make_timestamp(ms * 1000) AS DATE) AS VARCHAR) AS date FROM f")
def b2(spark, d):
    path = new_folder(spark)
    ticks = e2_rows(spark, d).withColumn("timestamp", F.col("sec") * 1000).withColumn("date", paths.day_of(F.col("sec")))
    sinks.write_per_symbol(ticks, path)
    return spark.read.parquet(path).select("symbol", "sec", "event_id", F.col("date").cast("string").alias("date"))


@query("b3_write_chunked", f"""{EV}, c AS (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY sec, event_id) - 1) // 250 + 1 AS n FROM ev)
  SELECT event_id, cents, symbol, printf('%06d', n) AS sequence, count(*) OVER (PARTITION BY symbol, n) AS in_file, 1 AS files FROM c""")
def b3(spark, d):
    path = new_folder(spark)
    sinks.write_chunked(X.events(spark, d).select("event_id", "cents", "symbol", "sec"), path, 250, ["symbol"], ["sec", "event_id"])
    rows = spark.read.schema("event_id long, cents long, sec long, symbol string, sequence string").parquet(path).withColumn("file", F.col("_metadata.file_path"))
    files = rows.groupBy("symbol", "sequence", "file").agg(F.count(F.lit(1)).alias("n")).groupBy("symbol", "sequence").agg(F.max("n").alias("in_file"), F.count(F.lit(1)).alias("files"))
    return rows.join(files, ["symbol", "sequence"]).select("event_id", "cents", "symbol", "sequence", "in_file", "files")


@query("b4_append_jsonl_day", f"{EV} SELECT event_id, symbol, ms, CAST(CAST(make_timestamp(ms * 1000) AS DATE) AS VARCHAR) AS date FROM ev")
def b4(spark, d):
    path = new_folder(spark)
    e = X.events(spark, d).select("event_id", "symbol", "ms", "sec")
    for part in (e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1")):
        sinks.append_jsonl_day(part, path, paths.day_of(F.col("sec")))
    return from_lines(spark.read.text(path).withColumnRenamed("value", "line").withColumn("date", F.col("date").cast("string")), "date")


@query("b5_compact_parquet", f"{EV} SELECT event_id, cents FROM ev")
def b5(spark, d):
    source, target = new_folder(spark), new_folder(spark)
    X.events(spark, d).select("event_id", "cents").write.parquet(source)
    sinks.compact_parquet(spark, source, target, "cents", descending=True)
    return spark.read.parquet(target)


@query("b6_check_schema_drift", "SELECT DISTINCT 'cents' AS field, 'bigint' AS expected, 'string' AS actual, 'type' AS status FROM events WHERE event_id % 2 = 1")
def b6(spark, d):
    path = new_folder(spark)
    e = X.events(spark, d).select("event_id", "cents")
    e.filter("event_id % 2 = 0").write.parquet(path)
    e.filter("event_id % 2 = 1").withColumn("cents", F.col("cents").cast("string")).write.mode("append").parquet(path)
    return sinks.check_schema_drift(spark, path, e.schema).select("field", "expected", "actual", "status").distinct()


@query("b7_schema_evolution", f"""{EV} SELECT event_id, CASE WHEN event_id % 3 = 1 THEN cents + 0.5 ELSE cents END::DOUBLE AS cents,
  CASE event_id % 3 WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 2 THEN CAST(user_id AS VARCHAR) END AS mark, CASE WHEN event_id % 3 > 0 THEN symbol END AS symbol FROM ev""")
def b7(spark, d):
    """Files of three schemas that have drifted: a field that is whole, then a fraction; a flag, then a number; a new one."""
    path, e = new_folder(spark), X.events(spark, d)
    part = lambda k, *columns: evolution.append_checked(e.filter(f"event_id % 3 = {k}").select("event_id", *columns), path)
    part(0, F.col("cents").cast("int").alias("cents"), (F.col("event_id") % 2 == 0).alias("mark"))
    part(1, (F.col("cents") + 0.5).alias("cents"), "symbol")
    part(2, F.col("cents").cast("long").alias("cents"), F.col("user_id").cast("long").alias("mark"), "symbol")
    return evolution.read_evolved(spark, path)


# messages and scalar functions


def messages(spark: SparkSession, d: str) -> DataFrame:
    return X.events(spark, d).select("event_id", X.message_line().alias("value"))


@query("c1_unwrap_envelope", f"{EV} SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 1 WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 5 < 3 THEN 3 ELSE 1 END AS n FROM ev")
def c1(spark, d):
    values = M.unwrap_envelope(V.parse(F.col("value")))
    return messages(spark, d).select("event_id", F.when(values.isNotNull(), F.size(values)).alias("n"))


C2_SQL = f"{EV}, o AS (SELECT * FROM ev WHERE {OBJECT}) SELECT event_id, event_id AS id FROM o UNION ALL SELECT event_id, -event_id FROM o WHERE event_id % 5 < 3"


@query("c2_explode_rows", C2_SQL)
def c2(spark, d):
    return feeds.explode_messages(messages(spark, d)).select("event_id", V.get(F.col("row"), "$.id", "long").alias("id"))


def objects(spark: SparkSession, d: str) -> DataFrame:
    return feeds.object_rows(feeds.parse_lines(tick_lines(spark, d)))


def both_names(spark: SparkSession, d: str) -> DataFrame:
    """Lines of which some have the symbol under both names."""
    return feeds.object_rows(feeds.parse_lines(X.events(spark, d).select("event_id", X.mark_price_line(twice=True).alias("line"))))


SYMBOL = "CASE WHEN event_id % 19 = 0 AND event_id % 2 = 1 THEN 'SHORT' WHEN event_id % 13 <> 0 THEN symbol WHEN event_id % 19 = 0 THEN 'LONG' END"


@query("c3_rename_short_fields", f"{EV} SELECT event_id, {SYMBOL} AS symbol, CAST(cents AS VARCHAR) AS mark_price, CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 7 AS VARCHAR) END AS funding_rate FROM ev WHERE {OBJECT}")
def c3(spark, d):
    return both_names(spark, d).select("event_id", *[V.text_of(M.field(F.col("row"), n)).alias(n) for n in ("symbol", "mark_price", "funding_rate")])


@query("c4_extract_symbol", f"{EV} SELECT event_id, {SYMBOL} AS symbol FROM ev WHERE {OBJECT}")
def c4(spark, d):
    return both_names(spark, d).select("event_id", M.symbol_of(F.col("row")).alias("symbol"))


@query("c5_extract_event_ms", f"{EV} SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN ms END AS event_ms FROM ev WHERE {OBJECT}")
def c5(spark, d):
    return objects(spark, d).select("event_id", M.event_ms(F.col("row")).alias("event_ms"))


@query("c6_second_key", f"{EV} SELECT event_id, sec, CAST(trunc((cents - 5000) / 1000.0) AS BIGINT) AS signed FROM ev")
def c6(spark, d):
    return X.events(spark, d).select("event_id", M.second_of(F.col("ms")).alias("sec"), M.second_of(F.col("cents") - 5000).alias("signed"))


@query("c7_align_event_time", f"{EV} SELECT event_id, sec * 1000 AS E FROM ev")
def c7(spark, d):
    return X.events(spark, d).select("event_id", M.aligned_ms(F.col("sec")).alias("E"))


@query("c8_add_timestamp", f"{EV} SELECT event_id, ms AS event_time, sec * 1000 AS timestamp FROM ev")
def c8(spark, d):
    return X.events(spark, d).select("event_id", F.col("ms").alias("event_time"), M.aligned_ms(F.col("sec")).alias("timestamp"))


def mixed(spark: SparkSession, d: str) -> DataFrame:
    """Values of every kind as ``v``."""
    i, n = F.col("event_id"), F.col("cents").cast("string")
    value = (
        F.when(i % 8 == 0, n)
        .when(i % 8 == 1, F.concat(F.lit('"'), n, F.lit('"')))
        .when(i % 8 == 2, F.concat(n, F.lit(".5")))
        .when(i % 8 == 3, F.concat(F.lit('"'), n, F.lit('.5"')))
        .when(i % 8 == 4, F.lit("true"))
        .when(i % 8 == 5, F.lit("null"))
        .when(i % 8 == 6, F.concat(F.lit('" '), n, F.lit('"')))
    )
    line = F.when(value.isNull(), F.lit("{}")).otherwise(F.concat(F.lit('{"v":'), value, F.lit("}")))
    return X.events(spark, d).select("event_id", "cents", V.get(V.parse(line), "$.v").alias("v"))


INT = "CASE WHEN cents < 0 THEN 'Int64' ELSE 'UInt64' END"


@query("c9_infer_type", f"{EV} SELECT event_id, CASE event_id % 8 WHEN 0 THEN {INT} WHEN 1 THEN {INT} WHEN 2 THEN 'Float64' WHEN 3 THEN 'Float64' WHEN 4 THEN 'Boolean' ELSE 'String' END AS type FROM ev WHERE event_id % 8 <> 7")
def c9(spark, d):
    return mixed(spark, d).filter("v is not null").select("event_id", inference.infer_type(F.col("v")).alias("type"))


@query("c10_infer_schema", f"{EV} SELECT unnest(['cents', 'name', 'odd', 'price']) AS name, unnest([CASE WHEN min(cents) < 0 THEN 'Int64' ELSE 'UInt64' END, 'String', 'Boolean', 'Float64']) AS type FROM ev")
def c10(spark, d):
    e = X.events(spark, d)
    line = F.to_json(F.struct(F.col("cents"), F.col("symbol").alias("name"), (F.col("event_id") % 2 == 1).alias("odd"), F.concat(F.col("cents").cast("string"), F.lit(".25")).alias("price")))
    return inference.infer_schema(e.select("event_id", V.parse(line).alias("row")), "row", [F.col("event_id")], "all_rows")


@query("c11_coerce_row", f"""{EV} SELECT event_id, CASE WHEN event_id % 8 IN (0, 1) THEN cents WHEN event_id % 8 <> 7 THEN 0 END AS as_int,
  CASE WHEN event_id % 8 IN (0, 1) THEN CAST(cents AS DOUBLE) WHEN event_id % 8 IN (2, 3) THEN CAST(cents || '.5' AS DOUBLE) END AS as_double, CASE WHEN event_id % 8 = 4 THEN true WHEN event_id % 8 <> 7 THEN false END AS as_bool,
  CASE event_id % 8 WHEN 0 THEN '' || cents WHEN 1 THEN '' || cents WHEN 2 THEN cents || '.5' WHEN 3 THEN cents || '.5' WHEN 4 THEN 'true' WHEN 6 THEN ' ' || cents END AS as_text FROM ev""")
def c11(spark, d):
    v = F.col("v")
    return mixed(spark, d).select(
        "event_id", inference.coerce(v, inference.INT64, "zero").alias("as_int"), inference.coerce(v, inference.FLOAT64).alias("as_double"),
        inference.coerce(v, inference.BOOLEAN, "zero").alias("as_bool"), inference.coerce(v, inference.STRING).alias("as_text"),
    )


@query("c12_symbol_from_name", "SELECT o_orderkey, list_extract(string_split(o_orderpriority, '-'), -1) AS symbol FROM orders")
def c12(spark, d):
    return X.table(spark, d, "orders").select("o_orderkey", paths.symbol_from_name(F.col("o_orderpriority")).alias("symbol"))


@query("c13_date_parts", "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day FROM orders")
def c13(spark, d):
    return X.table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in paths.date_parts(F.to_date("o_orderdate")).items()])


@query("c14_transfer_budget_s", "SELECT doc_id, CAST(least(greatest(ceil(n_chars * 100000 * 2 / 1048576.0), 10), 3600) AS BIGINT) AS seconds FROM documents")
def c14(spark, d):
    return X.table(spark, d, "documents").select("doc_id", paths.transfer_budget_s(F.col("n_chars") * 100_000).alias("seconds"))


@query("c15_content_key", "SELECT doc_id, md5(text) || '.zstd' AS key FROM documents")
def c15(spark, d):
    return X.table(spark, d, "documents").select("doc_id", paths.content_key(F.col("text"), True).alias("key"))


@query("c16_remote_and_local_path", f"WITH {X.FILES} SELECT id, 'bk/' || path || '.zst' AS key, path AS back FROM f")
def c16(spark, d):
    docs = X.table(spark, d, "documents")
    i = F.col("doc_id")
    path = F.concat("source", F.lit("/"), i.cast("string"), F.when(i % 9 == 0, ".log").otherwise(".txt"))
    keys = docs.select(i.alias("id"), paths.remote_key(path, "bk/", True).alias("key"))
    return keys.withColumn("back", paths.local_path(F.col("key"), "bk", True))


@query("c17_common_prefix", "SELECT 'tick-2024' AS prefix FROM events GROUP BY 1")
def c17(spark, d):
    return paths.common_prefix(X.events(spark, d).select(F.concat(F.lit("tick-2024_"), "symbol").alias("name")))


LG = f"WITH {X.LOG}"


def log(spark: SparkSession, d: str) -> DataFrame:
    rows = X.request_log(spark, d)
    key = F.regexp_replace(responses.content_class(F.col("status"), F.col("response_excerpt"), F.col("error")), r" \(#[0-9a-f]+\)$", "")
    return rows.withColumn("success", responses.is_success(F.col("status"), F.col("response_excerpt"))).withColumn("response_content_key", key)


@query("c18_is_success", f"{LG} SELECT event_id, success FROM rq")
def c18(spark, d):
    return log(spark, d).select("event_id", "success")


BUSINESS = "CASE k WHEN 1 THEN 'GraphQL Error: boom' WHEN 2 THEN 'GraphQL Error: Unknown' WHEN 3 THEN 'GraphQL Error: Unknown' WHEN 4 THEN 'API Error: bad' WHEN 6 THEN 'Message: no' ELSE 'HTTP 200 Business Logic Error' END"


@query("c19_business_error", f"{LG} SELECT event_id, {BUSINESS} AS business_error FROM rq")
def c19(spark, d):
    return log(spark, d).select("event_id", responses.business_error(F.col("response_excerpt")).alias("business_error"))


EXCERPT = """CASE k WHEN 1 THEN '{"errors":[{"message":"boom"}]}' WHEN 2 THEN '{"errors":[]}' WHEN 3 THEN '{"errors":[{}]}' WHEN 4 THEN '{"error":"bad"}' WHEN 6 THEN '{"message":"no"}' WHEN 8 THEN '' WHEN 9 THEN 'not json' ELSE props END"""
CLASS = f"CASE WHEN error IS NOT NULL THEN 'ERROR: ' || error WHEN k = 8 THEN 'HTTP ' || coalesce(status, 0) || ' Empty' ELSE 'HTTP ' || coalesce(status, 0) || ' - ' || {EXCERPT} END"


@query("c20_content_class", f"{LG} SELECT event_id, {CLASS} AS content_class FROM rq")
def c20(spark, d):
    return log(spark, d).select("event_id", F.col("response_content_key").alias("content_class"))


LABEL = "CASE WHEN status IS NULL THEN 'Network Error' ELSE status || ' ' || CASE status WHEN 200 THEN 'OK' WHEN 201 THEN 'Created' WHEN 404 THEN 'Not Found' WHEN 500 THEN 'Internal Server Error' ELSE 'Other' END END"


@query("c21_status_label", f"{LG} SELECT event_id, {LABEL} AS status_label FROM rq")
def c21(spark, d):
    return log(spark, d).select("event_id", responses.status_label(F.col("status")).alias("status_label"))


@query("c22_graphql_unwrap", f"{EV} SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '{{\"id\":' || event_id || '}}' END AS data, CASE event_id % 4 WHEN 1 THEN 'a, b' || event_id WHEN 2 THEN '' WHEN 3 THEN 'no data' END AS error FROM ev")
def c22(spark, d):
    i = F.col("event_id").cast("string")
    body = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"data":{"id":'), i, F.lit("}}")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"data":1,"errors":[{"message":"a"},{"message":"b'), i, F.lit('"}]}')))
        .when(F.col("event_id") % 4 == 2, F.lit('{"data":1,"errors":[]}'))
        .otherwise(F.lit('{"data":null}'))
    )
    data, error = responses.unwrap_response(body)
    return X.events(spark, d).select("event_id", data.alias("data"), error.alias("error"))


# predicates

for _name, _condition, _where in (
    ("d1_eq", Condition("l_returnflag", "eq", "R"), "l_returnflag = 'R'"),
    ("d2_ne", Condition("l_quantity", "ne", 10), "l_quantity <> 10"),
    ("d3_gt", Condition("l_quantity", "gt", 25.5), "l_quantity > 25.5"),
    ("d4_lt", Condition("l_discount", "lt", 0.03), "l_discount < 0.03"),
    ("d5_gte", Condition("l_linestatus", "gte", "G"), "l_linestatus >= 'G'"),
    ("d6_lte", Condition("l_quantity", "lte", 7), "l_quantity <= 7"),
):

    @query(_name, f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {_where}")
    def _compare(spark, d, c=_condition):
        return predicates.filter_any(X.table(spark, d, "lineitem"), [c]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("d7_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 're')")
def d7(spark, d):
    return predicates.filter_any(X.table(spark, d, "part"), [Condition("p_name", "contains", "re")]).select("p_partkey", "p_name")


@query("d8_any_of", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_totalprice > 300000")
def d8(spark, d):
    conditions = [Condition("o_orderstatus", "eq", "F"), Condition("o_totalprice", "gt", 300_000), Condition("o_totalprice", "gt", "1"), Condition("nowhere", "ne", 1)]
    return predicates.filter_any(X.table(spark, d, "orders"), conditions).select("o_orderkey")


@query("d9_valid_mark_price", f"{EV} SELECT event_id, event_id % 11 <> 0 AS valid FROM ev WHERE {OBJECT}")
def d9(spark, d):
    return objects(spark, d).select("event_id", M.is_valid_mark_price(F.col("row")).alias("valid"))


@query("d10_has_required_keys", f"""{EV} SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'bad_json' WHEN event_id % 89 = 0 THEN 'not_object' WHEN event_id % 13 = 0 THEN 'missing_symbol' WHEN event_id % 17 = 0 THEN 'missing_time' WHEN event_id % 11 = 0 THEN 'invalid' END AS reason FROM ev WHERE NOT ({BLANK})""")
def d10(spark, d):
    return M.checked_ticks(feeds.parse_lines(tick_lines(spark, d))).select("event_id", "reason")


@query("d11_exclude_paths", f"WITH {X.FILES} SELECT id, path FROM f WHERE NOT (ends_with(path, '.log') OR contains(path, '/7') OR starts_with(path, 'src3'))")
def d11(spark, d):
    docs = X.table(spark, d, "documents")
    i = F.col("doc_id")
    files = docs.select(i.alias("id"), F.concat("source", F.lit("/"), i.cast("string"), F.when(i % 9 == 0, ".log").otherwise(".txt")).alias("path"))
    return files.filter(~predicates.matches_path(F.col("path"), ["*.log", "*/7*", "src3*"]))


@query("d12_fresh_within_ttl", f"{EV} SELECT event_id, (SELECT max(sec) FROM ev) - sec < 86400 AS fresh FROM ev")
def d12(spark, d):
    e = X.events(spark, d)
    now = e.agg(F.max("sec")).first()[0] or 0
    return e.select("event_id", predicates.is_fresh(F.col("sec"), F.lit(now), 86_400).alias("fresh"))


# merging


def e2_rows(spark: SparkSession, d: str) -> DataFrame:
    e = X.events(spark, d).select("symbol", "sec", "source", "event_id", "ms", "cents")
    return merge.dedup_first(e, ["symbol", "sec"], ["source", "event_id"])


FIRST = "QUALIFY row_number() OVER (PARTITION BY symbol, sec ORDER BY source, event_id) = 1"


@query("e1_dedup_first_by_second", f"WITH {X.SQUEEZED} SELECT sec, symbol, source, event_id, cents FROM sq QUALIFY row_number() OVER (PARTITION BY sec ORDER BY source, event_id) = 1")
def e1(spark, d):
    e = X.squeezed(X.events(spark, d)).select("sec", "symbol", "source", "event_id", "cents")
    return merge.dedup_first(e, ["sec"], ["source", "event_id"])


@query("e2_dedup_first_by_symbol_second", f"WITH {X.SQUEEZED} SELECT symbol, sec, source, event_id, ms, cents FROM sq {FIRST}")
def e2(spark, d):
    e = X.squeezed(X.events(spark, d)).select("symbol", "sec", "source", "event_id", "ms", "cents")
    return merge.dedup_first(e, ["symbol", "sec"], ["source", "event_id"])


@query("e3_ingest_quality", f"""{EV}, r AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'bad_json' WHEN event_id % 89 = 0 THEN 'not_object' WHEN event_id % 13 = 0 THEN 'missing_symbol' WHEN event_id % 17 = 0 THEN 'missing_time' WHEN event_id % 11 = 0 THEN 'invalid' END AS reason FROM ev WHERE NOT ({BLANK})),
  t AS (SELECT *, row_number() OVER (PARTITION BY reason, symbol, sec // 3600 ORDER BY source, event_id) AS n FROM r)
  SELECT source, count(*) FILTER (reason IS NULL AND n = 1) AS added, count(*) FILTER (reason IS NULL AND n > 1) AS duplicate, {", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in merge.REASONS)} FROM t GROUP BY source""")
def e3(spark, d):
    checked = M.checked_ticks(feeds.parse_lines(tick_lines(spark, d)), ["symbol", "sec"])
    return merge.ingest_quality(checked.withColumn("hour", F.floor(F.col("sec") / 3600)), ["symbol", "hour"], ["source", "event_id"], ["source"])


def day_ticks(spark: SparkSession, d: str) -> DataFrame:
    """First rows of one day."""
    return e2_rows(spark, d).filter(F.col("sec").between(A, Z)).select("symbol", "sec", "event_id", "cents")


TICKS = f"""{EV}, t AS (SELECT symbol, sec, event_id, cents FROM (SELECT * FROM ev {FIRST}) WHERE sec BETWEEN {A} AND {Z})"""
FILLED = f"""{TICKS}, g AS (SELECT symbol, unnest(range({A}, {Z + 1})) AS sec FROM (SELECT DISTINCT symbol FROM t)),
  ends AS (SELECT symbol, min(sec) AS a, max(sec) AS z, arg_min(event_id, sec) AS eid, arg_min(cents, sec) AS ec FROM t GROUP BY symbol),
  j AS (SELECT g.symbol, g.sec, coalesce(t.event_id, eid) AS event_id, coalesce(t.cents, ec) AS cents, t.sec IS DISTINCT FROM g.sec AS is_filled, a, z
    FROM g ASOF LEFT JOIN t ON g.symbol = t.symbol AND g.sec >= t.sec JOIN ends ON ends.symbol = g.symbol)"""


@query("e4_coverage", f"{FILLED} SELECT symbol, count(*) FILTER (NOT is_filled) AS seconds_observed, count(*) AS seconds_filled FROM j GROUP BY symbol")
def e4(spark, d):
    ticks = day_ticks(spark, d)
    return merge.coverage(ticks, fill.fill_day(ticks, DAY, ["symbol"]))


@query("e5_distinct_symbols", f"{EV} SELECT DISTINCT symbol FROM ev")
def e5(spark, d):
    return merge.distinct_symbols(X.events(spark, d))


# request logs


@query("e6_request_totals", f"{LG} SELECT count(*) AS total_requests, count(*) FILTER (success) AS success_count, count(*) FILTER (NOT success) AS failure_count, count(*) FILTER (success) / count(*) * 100.0 AS success_rate FROM rq")
def e6(spark, d):
    return requestlog.request_totals(log(spark, d))


def share(key: str, name: str, where: str = "true") -> str:
    return f'{LG} SELECT {key} AS {name}, count(*) AS "count", count(*) / (SELECT count(*) FROM rq) * 100.0 AS percentage FROM rq WHERE {where} GROUP BY 1'


@query("e7_status_distribution", share(LABEL, "status_label"))
def e7(spark, d):
    return requestlog.status_distribution(log(spark, d))


@query("e8_error_distribution", share(f"CASE WHEN error IS NOT NULL THEN error WHEN status = 200 THEN {BUSINESS} WHEN status IS NOT NULL THEN 'HTTP ' || status ELSE 'Unknown Error' END", "error_class", "NOT success"))
def e8(spark, d):
    return requestlog.error_distribution(log(spark, d))


@query("e9_content_distribution", share(CLASS, "response_content_key", "NOT success"))
def e9(spark, d):
    return requestlog.content_distribution(log(spark, d))


@query("e10_latency_stats", f"{LG} SELECT min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, CAST(sum(duration_ms) AS DOUBLE) / count(*) AS avg_ms FROM rq")
def e10(spark, d):
    return requestlog.latency_stats(log(spark, d))


@query("e11_latency_percentiles", f"{LG}, s AS (SELECT list_sort(list(duration_ms)) AS l, count(*) AS n FROM rq) SELECT p AS percent, l[CAST(least(floor(n * p / 100.0), n - 1) AS BIGINT) + 1] AS ms FROM s, (SELECT unnest([50, 90, 95, 99]) AS p)")
def e11(spark, d):
    return requestlog.latency_percentiles(log(spark, d))


@query("e12_run_summary", f"{LG} SELECT (max(ms) - min(ms)) / 1000.0 AS duration_s, count(*) AS sent, count(*) AS completed, count(*) FILTER (success) AS success, count(*) FILTER (NOT success) AS failure, count(*) FILTER (success) / count(*) * 100.0 AS success_rate, count(*) / ((max(ms) - min(ms)) / 1000.0) AS completed_per_s FROM rq")
def e12(spark, d):
    return requestlog.run_summary(log(spark, d), F.min("ms"), F.max("ms"))


# fill and order


@query("f1_day_grid", f"{EV}, m AS (SELECT min(sec) // 86400 * 86400 AS a FROM ev) SELECT unnest(range(a, a + 86400)) AS sec FROM m")
def f1(spark, d):
    first = X.events(spark, d).agg(F.min("sec")).first()[0]
    return fill.day_grid(spark, date.fromordinal(date(1970, 1, 1).toordinal() + first // 86_400))


def filled_day(spark: SparkSession, d: str) -> DataFrame:
    ticks = day_ticks(spark, d)
    ends = ticks.groupBy("symbol").agg(F.min("sec").alias("a"), F.max("sec").alias("z"))
    return fill.fill_day(ticks, DAY, ["symbol"]).join(ends, "symbol")


J = "SELECT symbol, sec, event_id, cents FROM j"


@query("f2_forward_fill", f"{FILLED} {J} WHERE is_filled AND sec BETWEEN a AND z")
def f2(spark, d):
    return filled_day(spark, d).filter("is_filled AND sec BETWEEN a AND z").select("symbol", "sec", "event_id", "cents")


@query("f3_back_fill_head", f"{FILLED} {J} WHERE sec < a")
def f3(spark, d):
    return filled_day(spark, d).filter("sec < a").select("symbol", "sec", "event_id", "cents")


@query("f4_fill_tail", f"{FILLED} {J} WHERE sec > z")
def f4(spark, d):
    return filled_day(spark, d).filter("sec > z").select("symbol", "sec", "event_id", "cents")


def all_days(spark: SparkSession, d: str) -> DataFrame:
    """First rows of every day of the table, some with T."""
    return e2_rows(spark, d).select("symbol", "sec", "event_id", F.col("ms").alias("E"), F.when(F.col("event_id") % 2 == 0, F.col("ms") + 7).alias("T"))


WHOLE = f"""{EV}, w AS (SELECT symbol, sec, event_id, ms, CASE WHEN event_id % 2 = 0 THEN ms + 7 END AS T FROM (SELECT * FROM ev {FIRST})),
  t AS (SELECT * FROM w WHERE sec BETWEEN {A} AND {Z}), g AS (SELECT symbol, unnest(range({A}, {Z + 1})) AS sec FROM (SELECT DISTINCT symbol FROM w)),
  ends AS (SELECT symbol, arg_min(event_id, sec) AS eid, arg_min(ms, sec) AS em, min_by(CASE WHEN T IS NULL THEN -1 ELSE T END, sec) AS et FROM w GROUP BY symbol),
  j AS (SELECT g.symbol, g.sec, coalesce(t.event_id, eid) AS event_id, coalesce(t.ms, em) AS ms, CASE WHEN t.event_id IS NULL THEN nullif(et, -1) ELSE t.T END AS T, t.sec IS DISTINCT FROM g.sec AS is_filled
    FROM g ASOF LEFT JOIN t ON g.symbol = t.symbol AND g.sec >= t.sec JOIN ends ON ends.symbol = g.symbol
    UNION ALL SELECT symbol, sec, event_id, ms, T, false FROM w WHERE sec NOT BETWEEN {A} AND {Z})"""

def generic(rows: DataFrame) -> DataFrame:
    return fill.rewrite_filled_generic(fill.fill_day(rows, DAY, ["symbol"])).select("symbol", "sec", "event_id", "E", "T", "is_filled")


def mark_price(rows: DataFrame) -> DataFrame:
    rows = rows.select("symbol", "sec", F.col("E").alias("event_time"), (F.col("sec") * 1000).alias("timestamp"))
    return fill.rewrite_filled_mark_price(fill.fill_day(rows, DAY, ["symbol"])).select("symbol", "sec", "event_time", "timestamp")


def kept_out_of_day(rows: DataFrame) -> DataFrame:
    return fill.fill_day(rows, DAY, ["symbol"]).select("symbol", "sec", "event_id", "is_filled")


@query("f5_rewrite_filled_generic", f"{WHOLE} SELECT symbol, sec, event_id, sec * 1000 AS E, CASE WHEN is_filled AND T IS NOT NULL THEN sec * 1000 ELSE T END AS T, is_filled FROM j")
def f5(spark, d):
    return generic(all_days(spark, d))


@query("f6_rewrite_filled_mark_price", f"{WHOLE} SELECT symbol, sec, ms AS event_time, sec * 1000 AS timestamp FROM j")
def f6(spark, d):
    return mark_price(all_days(spark, d))


@query("f7_fill_per_symbol", f"{FILLED} SELECT symbol, sec, event_id, cents, is_filled FROM j")
def f7(spark, d):
    return fill.fill_day(day_ticks(spark, d), DAY, ["symbol"])


@query("f8_keep_out_of_day", f"{WHOLE} SELECT symbol, sec, event_id, is_filled FROM j")
def f8(spark, d):
    return kept_out_of_day(all_days(spark, d))


# Earlier names of the same queries, from when f5, f6 and f8 read three days.
for _was, _now in (("f13_rewrite_filled_generic_all_days", "f5_rewrite_filled_generic"), ("f14_rewrite_filled_mark_price_all_days", "f6_rewrite_filled_mark_price"), ("f15_keep_out_of_day_all_days", "f8_keep_out_of_day")):
    query(_was, SQL[_now])(QUERIES[_now])


EVERY_DAY = f"""{EV}, t AS (SELECT symbol, sec, event_id, cents FROM ev {FIRST}), ends AS (SELECT min(sec) // 86400 * 86400 AS a, (max(sec) // 86400 + 1) * 86400 AS z FROM t),
  s AS (SELECT symbol, event_id, cents, sec, CASE WHEN lag(sec) OVER w IS NULL THEN a ELSE sec END AS p, coalesce(lead(sec) OVER w, z) AS q FROM t, ends WINDOW w AS (PARTITION BY symbol ORDER BY sec)),
  d AS (SELECT *, unnest(range(p // 86400, (q - 1) // 86400 + 1)) AS day FROM s), c AS (SELECT *, greatest(p, day * 86400) AS x, least(q, (day + 1) * 86400) AS y FROM d)
  SELECT symbol, day, CAST(sum(y - x) AS BIGINT) AS seconds, count(*) FILTER (sec // 86400 = day AND sec >= x) AS observed, CAST(sum(event_id * (y - x)) AS BIGINT) AS ids,
    CAST(sum((cents % 1000) * ((x + y - 1) * (y - x) // 2 - day * 86400 * (y - x))) AS BIGINT) AS weighted FROM c GROUP BY symbol, day"""


@query("f16_fill_every_day", EVERY_DAY)
def f16(spark, d):
    """Every second of every day of the table, summed up a symbol and day."""
    rows = e2_rows(spark, d).select("symbol", "sec", "event_id", "cents")
    ends = rows.agg(F.min("sec"), F.max("sec")).first()
    first, last = (date.fromordinal(date(1970, 1, 1).toordinal() + (s or 0) // fill.DAY) for s in ends)
    filled = fill.fill_days(rows, first, last, ["symbol"])
    day = F.call_function("div", F.col("sec"), F.lit(fill.DAY).cast("long"))
    weighted = F.sum(F.col("cents") % 1000 * (F.col("sec") - day * fill.DAY))
    return filled.groupBy("symbol", day.alias("day")).agg(F.count(F.lit(1)).alias("seconds"), F.count_if(~F.col("is_filled")).cast("long").alias("observed"), F.sum("event_id").alias("ids"), weighted.alias("weighted"))


@query("f9_sort_by_time", f"{EV} SELECT symbol, sec, event_id FROM ev {FIRST}")
def f9(spark, d):
    return fill.sorted_by_time(e2_rows(spark, d), ["symbol"]).select("symbol", "sec", "event_id")


@query("f10_order_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC")
def f10(spark, d):
    return fill.ordered(X.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", descending=True)


@query("f11_top_n_listing", f"WITH {X.FILES} SELECT key FROM rem ORDER BY key LIMIT 5")
def f11(spark, d):
    return fill.top_n(X.manifests(spark, d)[2].select("key"), ["key"], 5)


@query("f12_chunk_number", f"{EV} SELECT symbol, event_id, CAST((row_number() OVER (PARTITION BY symbol ORDER BY sec, event_id) - 1) // 250 + 1 AS INTEGER) AS chunk FROM ev")
def f12(spark, d):
    return fill.chunk_number(X.events(spark, d), 250, ["symbol"], ["sec", "event_id"]).select("symbol", "event_id", "chunk")


# joins, plans


@query("h1_union_sources", f"{EV} SELECT event_id, CAST(source AS INTEGER) AS source_priority FROM ev")
def h1(spark, d):
    e = X.events(spark, d)
    return merge.union_sources([e.filter(F.col("source") == k).select("event_id") for k in range(3)])


@query("h2_fill_from_secondary", f"{EV} SELECT symbol, sec, event_id FROM ev {FIRST}")
def h2(spark, d):
    e = X.events(spark, d).select("symbol", "sec", "source", "event_id")
    feed = lambda k: merge.dedup_first(e.filter(F.col("source") == k), ["symbol", "sec"], ["event_id"])
    return merge.fill_from_secondary(merge.fill_from_secondary(feed(0), feed(1), ["symbol", "sec"]), feed(2), ["symbol", "sec"]).select("symbol", "sec", "event_id")


UPLOAD = """up AS (SELECT l.path, 'bk/' || l.path AS key, l.size, CASE WHEN c.hash IS NULL THEN 'new' WHEN l.hash <> c.hash OR l.size <> c.size THEN 'changed' END AS changed, r.size = l.size AS there
    FROM loc l LEFT JOIN cache c ON c.path = l.path LEFT JOIN rem r ON r.key = 'bk/' || l.path),
  pu AS (SELECT path, key, size, CASE WHEN changed IS NULL OR coalesce(there, false) THEN 'skip' ELSE 'upload' END AS action, CASE WHEN changed IS NULL THEN 'unchanged' WHEN coalesce(there, false) THEN 'already_remote' ELSE changed END AS reason FROM up)"""
DOWNLOAD = """pd AS (SELECT substr(r.key, 4) AS path, r.key, r.size, CASE WHEN l.size IS NULL THEN 'absent' WHEN l.size <> r.size THEN 'size' WHEN r.last_modified > c.last_sync THEN 'newer' ELSE 'unchanged' END AS reason
    FROM rem r LEFT JOIN loc l ON l.path = substr(r.key, 4) LEFT JOIN cache c ON c.path = substr(r.key, 4)),
  pw AS (SELECT path, key, size, CASE WHEN reason = 'unchanged' THEN 'skip' ELSE 'download' END AS action, reason FROM pd)"""


@query("h3_plan_upload", f"WITH {X.FILES}, {UPLOAD} SELECT * FROM pu")
def h3(spark, d):
    local, cache, remote = X.manifests(spark, d)
    return sync.plan_upload(local, cache, remote, "bk")


@query("h4_plan_download", f"WITH {X.FILES}, {DOWNLOAD} SELECT * FROM pw")
def h4(spark, d):
    local, cache, remote = X.manifests(spark, d)
    return sync.plan_download(remote, local, cache, "bk")


@query("h5_plan_bidirectional", f"WITH {X.FILES}, {UPLOAD}, {DOWNLOAD} SELECT * FROM pu UNION ALL SELECT * FROM pw")
def h5(spark, d):
    local, cache, remote = X.manifests(spark, d)
    return sync.plan_bidirectional(local, cache, remote, "bk")


@query("h6_plan_delete", f"WITH {X.FILES} SELECT path, size, 'delete' AS action, 'gone' AS reason FROM cache WHERE path NOT IN (SELECT path FROM loc)")
def h6(spark, d):
    local, cache, _ = X.manifests(spark, d)
    return sync.plan_delete(cache, local)


@query("h7_verify_backup", f"WITH {X.FILES} SELECT l.path, l.size AS local_size, r.size AS remote_size FROM loc l JOIN rem r ON r.key = 'bk/' || l.path WHERE l.size <> r.size")
def h7(spark, d):
    local, _, remote = X.manifests(spark, d)
    return sync.verify_backup(local, remote, "bk")


@query("h8_plan_publish", f"""WITH {X.FILES}, led AS (SELECT hash AS md5, CASE min(id) % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'uploading' WHEN 2 THEN 'failed' ELSE 'completed' END AS status, min(id) AS i FROM f GROUP BY 1 HAVING min(id) % 6 <> 0)
  SELECT path, hash AS md5, CASE WHEN status IS NULL OR status = 'failed' THEN 'pending' WHEN status = 'completed' THEN CASE WHEN i % 2 = 0 THEN 'ready' ELSE 'pending' END ELSE 'wait' END AS status FROM f LEFT JOIN led ON led.md5 = f.hash""")
def h8(spark, d):
    docs = X.table(spark, d, "documents")
    i = F.col("doc_id")
    files = docs.select(F.concat("source", F.lit("/"), i.cast("string"), F.when(i % 9 == 0, ".log").otherwise(".txt")).alias("path"), F.md5("text").alias("md5"), i.alias("id"))
    ledger = files.groupBy("md5").agg(F.min("id").alias("i")).filter("i % 6 <> 0")
    ledger = ledger.withColumn("status", F.when(F.col("i") % 5 == 0, "pending").when(F.col("i") % 5 == 1, "uploading").when(F.col("i") % 5 == 2, "failed").otherwise("completed"))
    return sync.plan_publish(files.select("path", "md5"), ledger, ledger.filter("i % 2 = 0"))


LEDGER_SQL = f"""{EV}, t AS (SELECT md5(CAST(user_id % 50 AS VARCHAR)) AS md5, ms AS t, event_id AS seq,
    CASE (event_id * 7 + ms) % 9 WHEN 0 THEN 'pending' WHEN 1 THEN 'uploading' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed' WHEN 4 THEN 'pending' WHEN 5 THEN 'uploading' WHEN 6 THEN 'lost' END AS status FROM ev),
  led AS (SELECT DISTINCT md5(CAST(user_id % 60 AS VARCHAR)) AS md5, CASE user_id % 60 % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'uploading' WHEN 2 THEN 'failed' ELSE 'completed' END AS status, 5 AS t FROM ev WHERE user_id % 3 <> 1),
  evs AS (SELECT md5, count(*) AS n, list(CASE status WHEN 'pending' THEN 1 WHEN 'uploading' THEN 2 WHEN 'completed' THEN 3 WHEN 'failed' THEN 4 ELSE 0 END + 8 * t ORDER BY t, seq) AS steps FROM t GROUP BY 1),
  k AS (SELECT md5, coalesce(n, 0) AS n, led.status AS was, led.t AS was_at, coalesce(steps, []) AS steps, CASE led.status WHEN 'pending' THEN 1 WHEN 'uploading' THEN 2 WHEN 'completed' THEN 3 WHEN 'failed' THEN 4 ELSE 0 END AS start FROM led FULL JOIN evs USING (md5)),
  f AS (SELECT md5, n, was, was_at, list_reduce(list_prepend({{'s': CAST(start AS BIGINT), 'a': CAST(0 AS BIGINT), 't': CAST(-1 AS BIGINT)}}, list_transform(steps, lambda x: {{'s': CAST(x % 8 AS BIGINT), 'a': CAST(0 AS BIGINT), 't': CAST(x // 8 AS BIGINT)}})),
    lambda a, x: CASE WHEN list_contains([1, 12, 23, 24, 31, 41], a.s * 10 + x.s) THEN {{'s': x.s, 'a': a.a + 1, 't': x.t}} ELSE a END) AS r FROM k)"""


@query("h15_publish_ledger", f"""{LEDGER_SQL} SELECT md5, CASE r.s WHEN 1 THEN 'pending' WHEN 2 THEN 'uploading' WHEN 3 THEN 'completed' WHEN 4 THEN 'failed' END AS status,
  CASE WHEN r.t >= 0 THEN r.t ELSE was_at END AS "at", r.a AS accepted, n - r.a AS rejected FROM f""")
def h15(spark, d):
    """Events as steps of uploads of 50 files, many of them illegal or of no known status, upon a ledger that has some of the files."""
    e = X.events(spark, d)
    kind = F.element_at(F.array(*map(F.lit, ["pending", "uploading", "completed", "failed", "pending", "uploading", "lost", None, None])), ((F.col("event_id") * 7 + F.col("ms")) % 9 + 1).cast("int"))
    key = lambda n: F.md5((F.col("user_id") % n).cast("string"))
    of = F.element_at(F.array(*map(F.lit, ["pending", "uploading", "failed", "completed"])), (F.col("user_id") % 60 % 4 + 1).cast("int"))
    before = e.filter("user_id % 3 <> 1").select(key(60).alias("md5"), of.alias("status"), F.lit(5).cast("long").alias("at")).distinct()
    return ledger.next_ledger(before, e.select(key(50).alias("md5"), F.col("ms").alias("at"), F.col("event_id").alias("seq"), kind.alias("status")))


@query("h16_plan_again", f"WITH {X.FILES}, {UPLOAD} SELECT path, key, size, CASE WHEN action = 'upload' AND id % 11 = 0 THEN 'upload' ELSE 'skip' END AS action, CASE WHEN action = 'upload' AND id % 11 = 0 THEN reason ELSE 'unchanged' END AS reason FROM pu JOIN (SELECT id, path FROM f) USING (path)")
def h16(spark, d):
    """An upload plan carried out but for every 11th file, what it leaves recorded, and the plan after it."""
    local, cache, remote = X.manifests(spark, d)
    plan = stored(sync.plan_upload(local, cache, remote, "bk"))
    failed = plan.filter("action = 'upload'").join(local.filter("id % 11 = 0").select("path"), "path", "left_semi")
    after = ledger.next_cache(cache, local, plan, failed, F.lit(0).cast("long"))
    sent = plan.filter("action = 'upload'").join(failed.select("path"), "path", "left_anti").select("key", "size", F.lit(0).cast("long").alias("last_modified"))
    remote = remote.select("key", "size", "last_modified").join(sent.select("key"), "key", "left_anti").unionByName(sent)
    return sync.plan_upload(local, after, remote, "bk")


@query("e13_sync_stats", f"WITH {X.FILES}, {UPLOAD}, {DOWNLOAD} SELECT action, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM (SELECT * FROM pu UNION ALL SELECT * FROM pw) GROUP BY 1")
def e13(spark, d):
    return sync.sync_stats(h5(spark, d))


@query("e14_duplicate_content", "SELECT md5(text) AS md5, count(*) AS files, min(source || '/' || doc_id) AS first_path FROM documents GROUP BY 1")
def e14(spark, d):
    docs = X.table(spark, d, "documents").withColumn("path", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")))
    return sync.duplicate_content(docs, F.md5("text"))


def customers(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")


@query("h9_upsert", """WITH b AS (SELECT o_custkey + o_orderkey % 2 * 100000 AS c_custkey, o_orderpriority AS c_mktsegment, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 25 AS INTEGER) END AS c_nationkey FROM orders QUALIFY row_number() OVER (PARTITION BY 1 + o_custkey + o_orderkey % 2 * 100000 ORDER BY o_orderkey DESC) = 1)
  SELECT * FROM b UNION ALL SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM b)""")
def h9(spark, d):
    k = F.col("o_orderkey")
    batch = X.table(spark, d, "orders").select((F.col("o_custkey") + k % 2 * 100_000).alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"), F.when(k % 3 > 0, k % 25).cast("int").alias("c_nationkey"), k.alias("n"))
    return keyed.upsert(customers(spark, d), batch, "c_custkey", "n")


@query("h10_insert_if_absent", """WITH b AS (SELECT s_suppkey * 37 AS c_custkey, s_name AS c_mktsegment, s_nationkey AS c_nationkey FROM supplier)
  SELECT c_custkey, c_mktsegment, c_nationkey, false AS conflict FROM customer UNION ALL SELECT *, c_custkey IN (SELECT c_custkey FROM customer) FROM b""")
def h10(spark, d):
    rows = X.table(spark, d, "supplier").select((F.col("s_suppkey") * 37).alias("c_custkey"), F.col("s_name").alias("c_mktsegment"), F.col("s_nationkey").alias("c_nationkey"))
    table, conflicts = keyed.insert_if_absent(customers(spark, d), rows, "c_custkey")
    return table.withColumn("conflict", F.lit(False)).unionByName(conflicts.withColumn("conflict", F.lit(True)))


URGENT = "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"


@query("h11_delete_keys", f"SELECT c_custkey, (SELECT count(*) FROM customer WHERE c_custkey IN {URGENT}) AS deleted FROM customer WHERE c_custkey NOT IN {URGENT}")
def h11(spark, d):
    urgent = X.table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    left, gone = keyed.delete_keys(customers(spark, d), urgent, "c_custkey")
    return left.select("c_custkey", F.lit(gone.first()[0]).cast("long").alias("deleted"))


@query("h12_merge_json", """WITH n AS (SELECT o_custkey AS k, max(o_orderkey) AS o FROM orders GROUP BY 1)
  SELECT coalesce(c_custkey, k) AS key, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, coalesce(o, c_custkey) AS seen FROM customer FULL JOIN n ON k = c_custkey""")
def h12(spark, d):
    table = customers(spark, d).select(F.col("c_custkey").alias("key"), F.to_json(F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("seen"))).alias("value"))
    changes = X.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderkey").alias("seen"))
    merged = keyed.merge_json(table, changes.select("key", F.to_json(F.struct("seen")).alias("value")))
    return merged.select("key", F.from_json("value", "nation long, segment string, seen long").alias("v")).select("key", "v.*")


@query("h13_lookup_keys", "SELECT k AS c_custkey, c_mktsegment, c_nationkey, c_custkey IS NOT NULL AS found FROM (SELECT DISTINCT o_custkey * 2 AS k FROM orders) LEFT JOIN customer ON c_custkey = k")
def h13(spark, d):
    keys = X.table(spark, d, "orders").select((F.col("o_custkey") * 2).alias("c_custkey")).distinct()
    return keyed.lookup_keys(keys, customers(spark, d), "c_custkey")


@query("h14_refresh_stale", f"""{EV}, n AS (SELECT max(sec) AS now FROM ev), u AS (SELECT user_id, max(sec) AS ts, count(*) AS c FROM ev GROUP BY 1), cache AS (SELECT * FROM u WHERE user_id % 5 <> 0)
  SELECT 'agg:users:' || u.user_id AS key, CASE WHEN now - cache.ts < 3600 THEN 'old' ELSE 'new' || u.user_id END AS value, CASE WHEN now - cache.ts < 3600 THEN cache.ts ELSE now END AS ts, NOT coalesce(now - cache.ts < 3600, false) AS refreshed FROM u LEFT JOIN cache ON cache.user_id = u.user_id, n""")
def h14(spark, d):
    e = X.events(spark, d)
    now = e.agg(F.max("sec")).first()[0] or 0
    users = e.groupBy("user_id").agg(F.max("sec").alias("ts")).withColumn("key", F.concat(F.lit("agg:users:"), F.col("user_id").cast("string")))
    cache = users.filter("user_id % 5 <> 0").select("key", F.lit("old").alias("value"), "ts")
    compute = lambda rows: rows.withColumn("value", F.concat(F.lit("new"), F.col("user_id").cast("string")))
    return keyed.refresh_stale(users.select("key", "user_id"), cache, F.lit(now), 3600, compute)


# streams and jobs


def ingested(spark: SparkSession, d: str, sink: str, partition_by: list[str] | None = None, **options) -> tuple[str, DataFrame]:
    out = new_folder(spark, "sink")
    stream = feeds.stream_landing(spark, landing(spark, messages(spark, d).select("value")), 2)
    rows = ingest.stream_ingest(stream, [Condition("id", "gt", 0), Condition("cents", "lt", 100)])
    rows = ingest.typed_rows(ingest.with_arrival_day(rows) if partition_by else rows, {"id": "long", "cents": "long"})
    ingest.write_stream(rows, out, new_folder(spark, "progress"), sink, partition_by, **options).awaitTermination()
    return out, rows


STREAMED = f"{EV}, o AS (SELECT * FROM ev WHERE {OBJECT}), a AS (SELECT event_id AS id, cents FROM o UNION ALL SELECT -event_id, cents FROM o WHERE event_id % 5 < 3) SELECT id, cents{{more}} FROM a WHERE id > 0 OR cents < 100"


@query("i1_stream_ingest", STREAMED.format(more=""))
def i1(spark, d):
    return spark.read.schema("id long, cents long").parquet(ingested(spark, d, "parquet")[0])


@query("i2_arrival_day_rollover", STREAMED.format(more=", true AS arrived"))
def i2(spark, d):
    out, _ = ingested(spark, d, "parquet", ["date"])
    return spark.read.schema("id long, cents long, date date").parquet(out).select("id", "cents", (F.abs(F.datediff(F.current_date(), "date")) <= 1).alias("arrived"))


FLUSHED = "id long, cents long"


def flushed(spark: SparkSession, d: str, batch_size: int) -> tuple[str, flush.Sink, flush.Sink]:
    """Messages through a stream that flushes by number of rows into two sinks; it stops, goes on with more files, and is drained."""
    state, progress, out = new_folder(spark, "flush"), new_folder(spark, "progress"), new_folder(spark, "sinks")
    both = [flush.Sink("parquet", f"{out}/parquet"), flush.Sink("jsonl", f"{out}/jsonl", "jsonl")]
    values = messages(spark, d)
    path = new_folder(spark, "landing")
    for part in (values.filter("event_id % 3 < 2"), values.filter("event_id % 3 = 2")):
        part.select("value").repartition(6, "value").write.mode("append").text(path)
        rows = ingest.stream_ingest(feeds.stream_landing(spark, path, 2), [Condition("id", "gt", 0), Condition("cents", "lt", 100)])
        rows = ingest.typed_rows(rows, {"id": "long", "cents": "long"}).select("id", "cents")
        flush.flush_stream(rows, both, state, progress, batch_size).awaitTermination()
    flush.drain(spark, rows.schema, both, state)
    return state, *both


def sink_rows(spark: SparkSession, sink: flush.Sink, state: str) -> DataFrame:
    return flush.read_sink(spark, spark.createDataFrame([], FLUSHED).schema, sink, state)


@query("i3_batch_flush", STREAMED.format(more=", true AS within"))
def i3(spark, d):
    """Every flush but the last has 500 rows or more."""
    state, parquet, _ = flushed(spark, d, 500)
    rows = sink_rows(spark, parquet, state)
    last = rows.agg(F.max("batch")).first()[0]
    sizes = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(sizes, "batch").select("id", "cents", ((F.col("n") >= 500) | (F.col("batch") == F.lit(last))).alias("within"))


@query("i7_two_sinks", STREAMED.format(more=""))
def i7(spark, d):
    """Rows that both sinks have, as often as both have them."""
    state, parquet, jsonl = flushed(spark, d, 700)
    return sink_rows(spark, jsonl, state).drop("batch").intersectAll(sink_rows(spark, parquet, state).drop("batch"))


@query("i4_stream_choose_sink", STREAMED.format(more=""))
def i4(spark, d):
    out, _ = ingested(spark, d, "jsonl")
    return spark.read.schema("value string").text(out).select(F.from_json("value", "id long, cents long").alias("r")).select("r.*")


TICK = "symbol string, sec long, source long, event_id long, ms long, cents long"


def landed(spark: SparkSession, path: str, parts: list[DataFrame]) -> None:
    """Rows as files that arrive one after the other."""
    for part in parts:
        part.select("symbol", "sec", "source", "event_id", "ms", "cents").coalesce(1).write.mode("append").json(path)


def landing_ticks(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).json(path).withColumn("at", F.timestamp_millis("ms"))


def heartbeat(ms: Column) -> list[Column]:
    """A row without a symbol at a time after all others: it closes what is open."""
    return [F.lit(None).cast("string").alias("symbol"), F.call_function("div", ms, F.lit(1000).cast("long")).alias("sec"), *[F.lit(0).cast("long").alias(c) for c in ("source", "event_id")], ms.alias("ms"), F.lit(0).cast("long").alias("cents")]


def ends_of(rows: DataFrame) -> tuple[int, int]:
    a, z = rows.agg(F.min("ms"), F.max("ms")).first()
    return a or 0, (z or 0) + 1


@query("i5_stream_first_wins", SQL["e2_dedup_first_by_symbol_second"])
def i5(spark, d):
    """Sources land in the wrong order within each third of the time; state waits until the next third."""
    path, out = new_folder(spark, "landing"), new_folder(spark, "sink")
    e = X.squeezed(X.events(spark, d))
    a, z = ends_of(e)
    third = -(-(z - a) // 3)
    parts = [e.filter((F.col("source") == k) & F.col("ms").between(a + n * third, a + (n + 1) * third - 1)) for n in range(3) for k in (2, 1, 0)]
    landed(spark, path, [*parts, spark.range(1).select(*heartbeat(F.lit(z + 4 * third)))])
    first = stateful.stream_first_wins(landing_ticks(spark, path), ["symbol", "sec"], ["source", "event_id"], "at", f"{third} milliseconds")
    ingest.write_stream(first.drop("at"), out, new_folder(spark, "progress")).awaitTermination()
    return spark.read.schema(TICK).parquet(out)


@query("i6_stream_fill", SQL["f7_fill_per_symbol"])
def i6(spark, d):
    """A day's ticks in six files, each two of them in the wrong order; the stream stops after the first three and goes on."""
    path, out, progress = new_folder(spark, "landing"), new_folder(spark, "sink"), new_folder(spark, "progress")
    e = X.events(spark, d).filter(F.col("sec").between(A, Z))
    part = lambda n: e.filter(F.call_function("div", F.col("sec") - A, F.lit(fill.DAY // 6).cast("long")) == n)
    stateful.with_rocksdb(spark)

    def run() -> None:
        rows = stateful.stream_fill(landing_ticks(spark, path), ["symbol"], ["source", "event_id"], "at", "9 hours")
        ingest.write_stream(rows, out, progress).awaitTermination()

    landed(spark, path, [part(n) for n in (1, 0, 3)])
    run()
    landed(spark, path, [*[part(n) for n in (2, 5, 4)], spark.range(1).select(*heartbeat(F.lit((Z + 2 * fill.DAY) * 1000)))])
    run()
    return spark.read.schema(f"{TICK}, is_filled boolean").parquet(out).select("symbol", "sec", "event_id", "cents", "is_filled")


def daily_bases(spark: SparkSession, d: str) -> list[str]:
    return source_bases(spark, tick_lines(spark, d).select("source", F.col("line").alias("value")))


GOOD = f"{OBJECT} AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 11 <> 0"
DAILY = f"""{EV}, t AS (SELECT symbol, sec, event_id, ms, cents FROM (SELECT * FROM ev WHERE {GOOD} {FIRST}) WHERE sec BETWEEN {A} AND {Z}), g AS (SELECT symbol, unnest(range({A}, {Z + 1})) AS sec FROM (SELECT DISTINCT symbol FROM t)),
  fst AS (SELECT symbol, arg_min(cents, sec) AS c, arg_min(ms, sec) AS m FROM t GROUP BY 1)"""


@query("j1_daily_merge", f"{DAILY} SELECT g.symbol, g.sec * 1000 AS timestamp, coalesce(t.ms, m) AS event_time, CAST(coalesce(t.cents, c) AS DOUBLE) AS mark_price, t.sec IS DISTINCT FROM g.sec AS is_filled FROM g ASOF LEFT JOIN t ON g.symbol = t.symbol AND g.sec >= t.sec JOIN fst ON fst.symbol = g.symbol")
def j1(spark, d):
    out = daily.run_daily(spark, daily_bases(spark, d), DAY, daily.MARK_PRICE, new_folder(spark, "day"), TEXT)
    return out.select("symbol", "timestamp", "event_time", "mark_price", "is_filled")


QUALITY_SQL = f"""{EV}, r AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'bad_json' WHEN event_id % 89 = 0 THEN 'not_object' WHEN event_id % 13 = 0 THEN 'missing_symbol' WHEN event_id % 17 = 0 THEN 'missing_time' WHEN event_id % 11 = 0 THEN 'invalid' END AS reason FROM ev WHERE NOT ({BLANK})),
  t AS (SELECT *, row_number() OVER (PARTITION BY reason, symbol, sec ORDER BY source, event_id) AS n FROM r)"""


@query("j2_daily_merge_log", f"""{QUALITY_SQL} SELECT '{X.DAY}' AS date, 'mark-price' AS data_type, 'success' AS status, CAST(source AS INTEGER) AS source, count(*) FILTER (reason IS NULL AND n = 1) AS added, count(*) FILTER (reason IS NULL AND n > 1) AS duplicate,
    {", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in merge.REASONS)} FROM t GROUP BY source
  UNION ALL SELECT '{X.DAY}', 'index-price', 'failed', {", ".join(["NULL"] * (3 + len(merge.REASONS)))} FROM (SELECT 1 FROM events LIMIT 1)""")
def j2(spark, d):
    runs = new_folder(spark, "runs")
    daily.run_logged(spark, daily_bases(spark, d), daily.MARK_PRICE, new_folder(spark, "day"), runs, DAY, TEXT)
    daily.run_logged(spark, [new_folder(spark, "nothing")], "index-price", new_folder(spark, "day"), runs, DAY, TEXT)
    rows = stored(spark.read.parquet(runs)).select(F.col("date").cast("string").alias("date"), "data_type", "status", F.explode_outer("quality").alias("q"))
    return rows.select("date", "data_type", "status", "q.*")


@query("j3_late_files", SQL["j1_daily_merge"])
def j3(spark, d):
    """The first source's older half comes after the day has been merged, and wins."""
    lines = X.events(spark, d).select("event_id", "source", X.mark_price_line().alias("line"))
    half = lines.agg(F.expr("percentile(event_id, 0.5)")).first()[0] or 0
    bases, out, state = [new_folder(spark, f"source{k}") for k in range(3)], new_folder(spark, "day"), late.new_state(spark)
    is_late = (F.col("source") == 0) & (F.col("event_id") < half)
    for k, base in enumerate(bases):
        X.write_coded(lines.filter((F.col("source") == k) & ~is_late).select("line"), feeds.day_path(base, DAY), name="b")
    late.merge_late_files(spark, bases, DAY, out, state)
    X.write_coded(lines.filter(is_late).select("line"), feeds.day_path(bases[0], DAY), "gzip", name="a")
    late.merge_late_files(spark, bases, DAY, out, state)
    return spark.read.parquet(out).select("symbol", "timestamp", "event_time", "mark_price", "is_filled")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
