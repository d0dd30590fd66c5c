"""Streams with state: first wins by source order, and the day's fill, second by second.

Both wait for the watermark, so the result is that of the batch operators whatever way files arrive, as long as
no row is later than ``late_by``. A row of a later time under a key of its own (a heartbeat) moves the watermark and closes what is before it;
it is not written before a still later one comes. Filter it out of what was written, not out of the stream: Spark filters
by key before it looks at times."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickspark.operators.fill import DAY

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROWS = 8192


def with_rocksdb(spark: SparkSession) -> SparkSession:
    """State in RocksDB, which keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def stream_first_wins(ticks: DataFrame, keys: list[str], order: list[str], time: str, late_by: str) -> DataFrame:
    """The first row of each key and second in the given order, once the watermark has passed the second.

    State holds one row a key and second, the least so far: a source of higher priority that lands later still wins."""
    rest = [c for c in ticks.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    second = F.window(time, "1 second")
    return ticks.withWatermark(time, late_by).groupBy(*keys, second).agg(first).select(*keys, "first.*").select(*ticks.columns)


class _Fill(StatefulProcessor):
    """One key and day. ``waiting``: the first row of each second that the watermark has not passed; ``done``: the
    second up to which rows have been written, and the row that goes on.

    held: the order's columns, then the others as text, so that pandas changes no value."""

    def __init__(self, held: T.StructType, order: int, keys: list[str]):
        self.held, self.order, self.keys = held, order, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", T.StructType([T.StructField("sec", T.LongType())]), self.held)
        self.done = handle.getValueState("done", T.StructType([T.StructField("upto", T.LongType()), *self.held]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names, first = self.held.names, {}
        for batch in rows:
            for sec, *row in batch[["sec", *names]].itertuples(index=False, name=None):
                if sec not in first or row[: self.order] < first[sec][: self.order]:
                    first[sec] = row
        upto = self.done.get()[0] if self.done.exists() else None
        for sec, row in first.items():
            if upto is not None and sec < upto:
                continue  # of a second that has been written
            there = list(self.waiting.getValue((sec,))) if self.waiting.containsKey((sec,)) else None
            if there is None or row[: self.order] < there[: self.order]:
                self.waiting.updateValue((sec,), tuple(row))
        self.handle.registerTimer((key[-1] + 1) * DAY * 1000)
        yield from self._written(key, timerValues.getCurrentWatermarkInMs() // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The day is over: what waits, then the last row up to the day's end."""
        yield from self._written(key, (key[-1] + 1) * DAY)
        self.waiting.clear()

    def _written(self, key, before: int) -> Iterator[pd.DataFrame]:
        """Rows of the seconds before this one that a row is known for; later ones may still be told anew."""
        start, end = key[-1] * DAY, (key[-1] + 1) * DAY
        before = min(before, end)
        known = sorted((k[0], row) for k, row in self.waiting.iterator() if k[0] < before)
        known = [(sec, tuple(row)) for sec, row in known]
        if self.done.exists():
            upto, *last = self.done.get()
        elif known:
            upto, last = start, known[0][1]  # the seconds before the first row copy it
        else:
            return
        spans, serving = [], tuple(last)
        for sec, row in known:
            spans.append((upto, sec, serving, False))
            spans.append((sec, sec + 1, row, True))
            upto, serving = sec + 1, row
        # Up to the watermark nothing can come any more.
        if before > upto:
            spans.append((upto, before, serving, False))
            upto = before
        for sec, _ in known:
            self.waiting.removeKey((sec,))
        self.done.update((upto, *serving))
        yield from self._frames(key, spans)

    def _frames(self, key, spans: list[tuple]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for a, z, row, own in spans:
            for sec in range(a, z):
                out.append((*key[:-1], sec, *row, not own))
                if len(out) == _ROWS:
                    yield self._frame(out)
                    out = []
        if out:
            yield self._frame(out)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[*self.keys, "sec", *self.held.names, "is_filled"])

    def close(self) -> None:
        pass


def stream_fill(ticks: DataFrame, keys: list[str], order: list[str], time: str, late_by: str) -> DataFrame:
    """Every second of each key's days, with ``is_filled``: first wins by ``order`` within a second, gaps copy the row before,
    the seconds before a day's first row copy that, those after its last row copy that.

    ticks: keys, ``sec`` (long), other columns of simple types, of which those of the order are never null, and ``time`` (a timestamp). A second that the
    watermark has passed is written with the key's next rows; the rest of a day when the watermark has passed the day's
    end. Of a key and day the state holds the rows not written yet, one a second, and the row that goes on. ``with_rocksdb`` must hold where the stream starts."""
    fields = [f for f in ticks.schema if f.name not in (*keys, "sec", time)]
    if odd := [f.name for f in fields if not isinstance(f.dataType, T.AtomicType) or isinstance(f.dataType, T.BinaryType)]:
        raise ValueError(f"columns that have no text of their own: {odd}")
    # Names of our own; pandas does not take all that users have.
    own = [T.StructField(f"k{i}", ticks.schema[k].dataType) for i, k in enumerate(keys)]
    ranks = [T.StructField(f"o{i}", ticks.schema[o].dataType) for i, o in enumerate(order)]
    texts = [T.StructField(f"f{i}", T.StringType()) for i in range(len(fields))]
    held = T.StructType([*ranks, *texts])
    rows = ticks.withWatermark(time, late_by).select(
        *[F.col(k).alias(o.name) for k, o in zip(keys, own, strict=True)], F.col(time).alias("at"), F.col("sec").cast("long"), F.floor(F.col("sec") / DAY).cast("long").alias("day"),
        *[F.col(o).alias(r.name) for o, r in zip(order, ranks, strict=True)], *[F.col(f.name).cast("string").alias(t.name) for f, t in zip(fields, texts, strict=True)],
    )
    schema = T.StructType([*own, T.StructField("sec", T.LongType()), *held, T.StructField("is_filled", T.BooleanType())])
    filler = _Fill(held, len(order), [o.name for o in own])
    out = rows.groupBy(*filler.keys, "day").transformWithStateInPandas(filler, outputStructType=schema, outputMode="Append", timeMode="EventTime")
    names = [F.col(o.name).alias(k) for k, o in zip(keys, own, strict=True)]
    return out.select(*names, "sec", *[F.col(t.name).cast(f.dataType).alias(f.name) for f, t in zip(fields, texts, strict=True)], "is_filled")
