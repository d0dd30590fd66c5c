"""Column types of JSON values, and values coerced to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.functions import variants as V

BOOLEAN, UINT64, INT64, FLOAT64, STRING = "Boolean", "UInt64", "Int64", "Float64", "String"
SPARK_TYPES = {BOOLEAN: "boolean", UINT64: "decimal(20,0)", INT64: "bigint", FLOAT64: "double", STRING: "string"}
_MAX_U64, _MIN_I64, _MAX_I64 = "18446744073709551615", "-9223372036854775808", "9223372036854775807"
_WIDE = "decimal(38,0)"


def _between(number: Column, low: str, high: str) -> Column:
    return F.coalesce((number >= F.lit(low).cast(_WIDE)) & (number <= F.lit(high).cast(_WIDE)), F.lit(False))


def _integer_text(text: Column, signed: bool) -> Column:
    return F.when(text.rlike("^[+-]?[0-9]{1,38}$" if signed else r"^\+?[0-9]{1,38}$"), F.regexp_replace(text, r"^\+", "").try_cast(_WIDE))


def _integer(v: Column) -> Column:
    """An integer JSON number as a wide decimal. Integers beyond a long are decimals of 19 digits and more; shorter ones came with a point."""
    return F.when(V.schema_of(v).rlike(r"^(BIGINT|DECIMAL\((19|[23][0-9]),0\))"), V.get(v, "$", _WIDE))


def infer_type(v: Column) -> Column:
    """Boolean, UInt64, Int64, Float64 or String; strings that read as numbers count as those."""
    text, number = V.as_string(v), _integer(v)
    of_text = (
        F.when(_between(_integer_text(text, False), "0", _MAX_U64), UINT64)
        .when(_between(_integer_text(text, True), _MIN_I64, _MAX_I64), INT64)
        .when(V.is_float_text(text), FLOAT64)
        .otherwise(STRING)
    )
    of_number = F.when(_between(number, "0", _MAX_U64), UINT64).when(_between(number, _MIN_I64, _MAX_I64), INT64).otherwise(FLOAT64)
    return F.when(V.is_bool(v), BOOLEAN).when(V.is_number(v), of_number).when(V.is_string(v), of_text).otherwise(STRING)


def infer_schema(rows: DataFrame, row: str, order: list[Column], mode: str = "first_row") -> DataFrame:
    """(name, type) by name: of the first row, or the type that holds every row's values (``all_rows``)."""
    fields = rows.select(V.get(F.col(row), "$", "map<string,variant>").alias("m"), F.struct(*order).alias("o"))
    if mode == "first_row":
        fields = fields.agg(F.min_by("m", "o").alias("m"))
    each = fields.select(F.explode("m").alias("name", "value")).select("name", infer_type(F.col("value")).alias("type"))
    if mode == "first_row":
        return each.orderBy("name")
    flags = {t: F.max((F.col("type") == t).cast("int")) for t in SPARK_TYPES}
    kinds = F.greatest(flags[UINT64], flags[INT64], flags[FLOAT64])
    wide = (
        F.when((flags[STRING] == 1) | ((flags[BOOLEAN] == 1) & (kinds == 1)), STRING)
        .when(flags[BOOLEAN] == 1, BOOLEAN)
        .when(flags[FLOAT64] == 1, FLOAT64)
        .when(flags[INT64] == 1, INT64)
        .otherwise(UINT64)
    )
    return each.groupBy("name").agg(wide.alias("type")).orderBy("name")


def coerce(v: Column, kind: str, mode: str = "null") -> Column:
    """A field's value as a column type. An absent key is null. What does not read as the type is
    null, or with mode ``zero`` 0, 0.0 or false; a string column renders every kind as text."""
    text = V.as_string(v)
    if kind == STRING:
        return V.text_of(v)
    if kind == BOOLEAN:
        out, zero = F.coalesce(F.when(V.is_bool(v), V.get(v, "$", "boolean")), F.when(text.isin("true", "false"), text == "true")), F.lit(False)
    elif kind == FLOAT64:
        out, zero = F.coalesce(V.as_double(v), V.float_text(text)), F.lit(0.0)
    else:
        low, high = ("0", _MAX_U64) if kind == UINT64 else (_MIN_I64, _MAX_I64)
        number = F.coalesce(_integer(v), _integer_text(text, kind == INT64))
        out, zero = F.when(_between(number, low, high), number), F.lit(0)
    out = out.cast(SPARK_TYPES[kind])
    return F.when(v.isNotNull(), F.coalesce(out, zero.cast(SPARK_TYPES[kind]))) if mode == "zero" else out
