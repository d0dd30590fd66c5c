"""Counters of a daily run, taken while its day is written: no pass over the lines of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickspark.operators.merge import REASONS

SCHEMA = "array<struct<source:int,added:long,duplicate:long," + ",".join(f"{r}:long" for r in REASONS) + ">>"


class Quality:
    """Rows added, duplicate, and rejected for each reason, a source.

    ``lines`` and ``firsts`` watch checked lines (with ``reason``) and the first rows of their keys; both must run in one action
    each. Sources are those of the job's list, so there are as many counters as that is long, whatever the rows."""

    def __init__(self, sources: int):
        self.sources = sources
        self.seen, self.won = Observation(), Observation()

    def lines(self, checked: DataFrame) -> DataFrame:
        of = lambda i: F.col("source_priority") == i
        good = [F.count_if(of(i) & F.col("reason").isNull()).alias(f"good_{i}") for i in range(self.sources)]
        bad = [F.count_if(of(i) & (F.col("reason") == r)).alias(f"{r}_{i}") for i in range(self.sources) for r in REASONS]
        return checked.observe(self.seen, *good, *bad)

    def firsts(self, first: DataFrame) -> DataFrame:
        return first.observe(self.won, *[F.count_if(F.col("source_priority") == i).alias(f"added_{i}") for i in range(self.sources)])

    def rows(self) -> list[tuple]:
        """(source, added, duplicate, reasons...), when the actions have run."""
        seen, won = self.seen.get, self.won.get
        return [(i, won[f"added_{i}"], seen[f"good_{i}"] - won[f"added_{i}"], *[seen[f"{r}_{i}"] for r in REASONS]) for i in range(self.sources)]
