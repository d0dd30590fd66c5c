"""Feed messages: envelopes, field names, keys of a tick, row checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions import variants as V

#: Short field names of the feed and the long names they stand for.
LONG_NAMES = {
    "e": "event_type",
    "s": "symbol",
    "p": "mark_price",
    "i": "index_price",
    "P": "estimated_settle_price",
    "r": "funding_rate",
    "T": "next_funding_time",
    "E": "event_time",
}

BAD_JSON, NOT_OBJECT, NO_SYMBOL, NO_TIME, INVALID, UNREADABLE = "bad_json", "not_object", "missing_symbol", "missing_time", "invalid", "unreadable"


def unwrap_envelope(v: Column) -> Column:
    """The data values of a message as array<variant>; null for a message that is no array or object.

    A top array is the data; so is the array under ``data`` or ``data.data``. Any other value under
    ``data`` is one value, and an object without ``data`` is itself one."""
    data, inner = V.get(v, "$.data"), V.get(v, "$.data.data")
    under = (
        F.when(V.is_array(data), V.get(v, "$.data", "array<variant>"))
        .when(V.is_object(data) & V.is_array(inner), V.get(v, "$.data.data", "array<variant>"))
        .otherwise(F.array(data))
    )
    return F.when(V.is_array(v), V.get(v, "$", "array<variant>")).when(V.is_object(v), F.when(data.isNotNull(), under).otherwise(F.array(v)))


def field(row: Column, long_name: str) -> Column:
    """A field under its long name; the short name wins where a row has both."""
    short = next((s for s, name in LONG_NAMES.items() if name == long_name), None)
    value = V.get(row, f"$.{long_name}")
    return F.coalesce(V.get(row, f"$.{short}"), value) if short else value


def symbol_of(row: Column) -> Column:
    """``symbol``, or ``s`` in its place where there is one; null unless that is a JSON string."""
    return V.as_string(field(row, "symbol"))


def event_ms(row: Column, keyed: bool = True) -> Column:
    """Event time in epoch ms: of keyed rows ``event_time`` or its short name, of generic rows ``E``."""
    return V.as_integer(field(row, "event_time") if keyed else V.get(row, "$.E"))


def second_of(ms: Column) -> Column:
    """Epoch second, truncated toward zero."""
    return F.call_function("div", ms, F.lit(1000).cast("long"))


def aligned_ms(sec: Column) -> Column:
    """Epoch ms of the beginning of a second."""
    return sec * F.lit(1000).cast("long")


def is_valid_mark_price(row: Column) -> Column:
    """Mark price and funding rate are there, each a JSON number or string."""
    ok = [V.is_number(f) | V.is_string(f) for f in (field(row, "mark_price"), field(row, "funding_rate"))]
    return ok[0] & ok[1]


def line_state(columns: list[str]) -> Column:
    """Why a parsed line is no object: its file can't be read, it is no JSON, it is another value; null if it is one."""
    row = F.col("row")
    state = F.when(row.isNull(), BAD_JSON).when(~V.is_object(row), NOT_OBJECT)
    return F.when(F.col("error").isNotNull(), UNREADABLE).otherwise(state) if "error" in columns else state


def checked_ticks(parsed: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The declared columns of a mark-price tick for every line, or some of them, with ``reason``: why a line gives no
    tick, the first check that fails, null if none does. Every field that these need, its kind and its text are read once."""
    wanted = TICK_COLUMNS if columns is None else columns
    checked = ("event_time", "symbol", "mark_price", "funding_rate")
    names = [n for n in LONG_NAMES.values() if n in wanted or n in checked]
    keep = [c for c in parsed.columns if c != "row"]
    row = F.col("row")
    rows = V.once(parsed, keep, _state=line_state(parsed.columns), **{f"_{n}": field(row, n) for n in names})
    keep = [*keep, "_state", *[f"_{n}" for n in names]]
    rows = V.once(rows, keep, **{f"_kind_{n}": V.schema_of(F.col(f"_{n}")) for n in names})
    keep += [f"_kind_{n}" for n in names]
    rows = V.once(rows, keep, **{f"_text_{n}": F.when(F.col(f"_kind_{n}") == "STRING", V.get(F.col(f"_{n}"), "$", "string")) for n in names})
    value, kind, text = (lambda n, k=k: F.col(f"{k}{n}") for k in ("_", "_kind_", "_text_"))
    given = lambda n: text(n).isNotNull() | V.is_number(value(n), kind(n))
    integer = lambda n: V.as_integer(value(n), kind(n), text(n))
    number = lambda n: F.coalesce(V.as_double(value(n), kind(n)), V.float_text(text(n)))
    reads = {"event_type": text, "event_time": integer, "symbol": text, "next_funding_time": integer}
    values = {n: reads.get(n, number)(n) for n in names if n in wanted or n in ("event_time", "symbol")}
    keep = [c for c in parsed.columns if c != "row"]
    rows = V.once(rows, [*keep, "_state"], **values, _valid=given("mark_price") & given("funding_rate"))
    sec = second_of(F.col("event_time"))
    derived = {"sec": sec, "timestamp": aligned_ms(sec)}
    reason = F.when(F.col("_state").isNotNull(), F.col("_state")).when(F.col("symbol").isNull(), NO_SYMBOL).when(F.col("event_time").isNull(), NO_TIME).when(~F.col("_valid"), INVALID)
    return rows.select(*[derived.get(c, F.col(c)).alias(c) for c in TICK_COLUMNS if c in wanted], *keep, reason.alias("reason"))


TICK_COLUMNS = ["event_type", "event_time", "symbol", "mark_price", "index_price", "estimated_settle_price", "funding_rate", "next_funding_time", "sec", "timestamp"]
