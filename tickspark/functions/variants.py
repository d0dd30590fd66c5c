"""Access to JSON values by key presence and kind. Kinds are those of JSON, not of Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INT = "^[+-]?[0-9]+$"
#: What a JSON string may look like to count as a number; stricter than Spark's casts.
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity|nan)$"


def parse(line: Column) -> Column:
    """VARIANT of a JSON text, null where it does not parse."""
    return F.try_parse_json(line)


def get(v: Column, path: str, kind: str = "variant") -> Column:
    """The value at a path; null only where the path is absent (a JSON null is a value)."""
    return F.try_variant_get(v, path, kind)


def schema_of(v: Column) -> Column:
    return F.schema_of_variant(v)


def once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Adds columns through a one-row generator: what is built on them reads values, where Spark would
    otherwise put the expressions in place of the names and compute them again and again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def is_object(v: Column) -> Column:
    return F.coalesce(schema_of(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(schema_of(v).startswith("ARRAY"), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(schema_of(v) == "STRING", F.lit(False))


def is_number(v: Column, kind: Column | None = None) -> Column:
    return F.coalesce((schema_of(v) if kind is None else kind).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def is_null(v: Column) -> Column:
    return F.coalesce(schema_of(v) == "VOID", F.lit(False))


def is_bool(v: Column) -> Column:
    return F.coalesce(schema_of(v) == "BOOLEAN", F.lit(False))


def as_string(v: Column) -> Column:
    """A JSON string's characters, null for other kinds."""
    return F.when(is_string(v), get(v, "$", "string"))


def as_double(v: Column, kind: Column | None = None) -> Column:
    return F.when(is_number(v, kind), get(v, "$", "double"))


def as_integer(v: Column, kind: Column | None = None, text: Column | None = None) -> Column:
    """Integer numbers, and strings that are integers; floats count for nothing. Kind and text where they are known."""
    kind, text = (schema_of(v) if kind is None else kind), (as_string(v) if text is None else text)
    return F.when(kind == "BIGINT", get(v, "$", "bigint")).when(text.rlike(_INT), text.try_cast("bigint"))


def is_float_text(text: Column) -> Column:
    return text.rlike(_FLOAT)


def float_text(text: Column) -> Column:
    """The double that a text of a number stands for."""
    return F.when(is_float_text(text), F.regexp_replace(text, r"^\+", "").try_cast("double"))


def text_of(v: Column) -> Column:
    """A value as text: strings bare, null absent, all else as JSON."""
    return F.when(is_string(v), get(v, "$", "string")).when(~is_null(v), F.to_json(v))
