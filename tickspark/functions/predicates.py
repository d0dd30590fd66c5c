"""The typed filter language: conditions compiled to columns, for typed frames and for raw rows."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions import variants as V

_ORDER = {"gt": operator.gt, "lt": operator.lt, "gte": operator.ge, "lte": operator.le}


@dataclass(frozen=True)
class Condition:
    field: str
    operator: str  # eq, ne, gt, lt, gte, lte, contains
    value: Any


def _kind(value: Any) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    return "number" if isinstance(value, (int, float)) else "string" if isinstance(value, str) else "other"


def _column_kind(t: T.DataType) -> str:
    return "string" if isinstance(t, T.StringType) else "bool" if isinstance(t, T.BooleanType) else "number" if isinstance(t, T.NumericType) else "other"


def typed(df: DataFrame, c: Condition) -> Column:
    """A condition on a typed frame; kinds are settled now, so plain comparisons reach the scan.

    Kinds that differ are never equal nor ordered, a missing field matches nothing."""
    if c.field not in df.columns:
        return F.lit(False)
    col, have, want = F.col(f"`{c.field}`"), _column_kind(df.schema[c.field].dataType), _kind(c.value)
    if c.operator in ("eq", "ne"):
        same = col.isNull() if want == "null" else col == F.lit(c.value) if have == want else F.lit(False)
        return same if c.operator == "eq" else ~F.coalesce(same, F.lit(False))
    if have != want or want not in ("number", "string"):
        return F.lit(False)
    if c.operator == "contains":
        return col.contains(c.value) if want == "string" else F.lit(False)
    return _ORDER[c.operator](col, F.lit(c.value))


def raw(row: Column, c: Condition) -> Column:
    """A condition on a VARIANT row; kinds are settled row by row."""
    v, want = V.get(row, f"$['{c.field}']"), _kind(c.value)
    if c.operator in ("eq", "ne"):
        same = {
            "null": V.is_null(v),
            "bool": V.is_bool(v) & (V.get(v, "$", "boolean") == F.lit(c.value)),
            "number": V.as_double(v) == F.lit(c.value).cast("double"),
            "string": V.as_string(v) == F.lit(c.value),
        }.get(want, F.lit(False))
        same = F.coalesce(same, F.lit(False))
        return same if c.operator == "eq" else v.isNotNull() & ~same
    value = V.as_double(v) if want == "number" else V.as_string(v)
    if c.operator == "contains":
        return F.coalesce(value.contains(c.value), F.lit(False)) if want == "string" else F.lit(False)
    if want not in ("number", "string"):
        return F.lit(False)
    return F.coalesce(_ORDER[c.operator](value, F.lit(c.value)), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    """Conditions joined by OR; none at all let every row pass."""
    return reduce(operator.or_, conditions) if conditions else F.lit(True)


def filter_any(df: DataFrame, conditions: list[Condition]) -> DataFrame:
    return df.filter(any_of([typed(df, c) for c in conditions])) if conditions else df


def matches_path(path: Column, patterns: list[str]) -> Column:
    """``*x*`` is in the path, ``*x`` ends it, ``x*`` begins it, ``x`` is in it."""

    def one(p: str) -> Column:
        if p.startswith("*") and p.endswith("*"):
            return path.contains(p[1:-1])
        if p.startswith("*"):
            return path.endswith(p[1:])
        return path.startswith(p[:-1]) if p.endswith("*") else path.contains(p)

    return reduce(operator.or_, map(one, patterns), F.lit(False))


def is_fresh(at: Column, now: Column, ttl_s: int) -> Column:
    """Less than ttl seconds old; both in epoch seconds."""
    return now - at < F.lit(ttl_s)
