"""A table's columns under names of our own, so that whatever users call theirs never meets what an operator adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held(df: DataFrame) -> DataFrame:
    """The same columns as _0, _1, ... in their order."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def name_of(df: DataFrame, column: str) -> str:
    """What ``held`` calls a column; its name counts in any case, as for Spark, but exactly where that is there."""
    names = df.columns
    if column in names:
        return f"_{names.index(column)}"
    return f"_{[n.lower() for n in names].index(column.lower())}"


def restored(rows: DataFrame, df: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``df`` from rows that hold them, some with other values."""
    changed = changed or {}
    return rows.select(*[changed.get(f"_{i}", F.col(f"_{i}")).alias(n) for i, n in enumerate(df.columns)])
