"""Names, keys and paths of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def symbol_from_name(name: Column) -> Column:
    """What follows the last dash; all of a name without one."""
    return F.substring_index(name, "-", -1)


def day_of(sec: Column) -> Column:
    """UTC date of an epoch second, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(sec / 86400).cast("int"))


def date_parts(day: Column) -> dict[str, Column]:
    """Zero-padded year, month and day."""
    text = F.date_format(day, "yyyy-MM-dd")
    return {"year": F.substring(text, 1, 4), "month": F.substring(text, 6, 2), "day": F.substring(text, 9, 2)}


def transfer_budget_s(size: Column) -> Column:
    """Two seconds a MiB, begun ones counted, 10 at least and 3600 at most."""
    return F.least(F.greatest(F.ceil(size * 2 / 1048576), F.lit(10)), F.lit(3600)).cast("long")


def content_key(content: Column, compressed: bool = False) -> Column:
    """MD5 of the content, ``.zstd`` after it when compressed."""
    return F.concat(F.md5(content), F.lit(".zstd" if compressed else ""))


def remote_key(path: Column, prefix: str, compress: bool = False) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), path, F.lit(".zst" if compress else ""))


def local_path(key: Column, prefix: str, compress: bool = False) -> Column:
    """The path a key stands for; null for keys outside the prefix, the prefix itself, and in
    compressed mode keys without ``.zst`` (repeated endings go together)."""
    rel = F.regexp_replace(F.substring(key, len(prefix) + 1, 1 << 30), "^/+", "")
    rel = F.when(key.startswith(prefix) & (rel != ""), rel)
    return F.when(rel.endswith(".zst"), F.regexp_replace(rel, r"(\.zst)+$", "")) if compress else rel


def common_prefix(names: DataFrame, name: str = "name") -> DataFrame:
    """One row with the longest common prefix of all names, cut before its last ``_`` or ``-``.

    The smallest and the greatest name share what all share. Nothing in common gives ``data``, a
    single name itself; no names give ``data``."""
    ends = names.agg(F.min(name).alias("a"), F.max(name).alias("b"))
    length = F.least(F.length("a"), F.length("b"))
    steps = F.sequence(F.lit(1), F.greatest(length, F.lit(1)))
    same = F.size(F.filter(steps, lambda i: (i <= length) & (F.substring("a", F.lit(1), i) == F.substring("b", F.lit(1), i))))
    prefix = F.expr("substring(a, 1, n)")
    cut = F.when(F.expr("substring(a, 1, n)").rlike("[_-]"), F.regexp_extract(prefix, "^(.*)[_-][^_-]*$", 1)).otherwise(prefix)
    one = F.col("a") == F.col("b")
    out = ends.withColumn("n", F.coalesce(same, F.lit(0)))
    return out.select(F.when(one, F.col("a")).when(F.coalesce(cut, F.lit("")) == "", "data").otherwise(cut).alias("prefix"))
