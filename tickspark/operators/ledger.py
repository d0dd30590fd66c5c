"""What a transfer leaves behind: the ledger after its events, and the cache after a plan.

A plan says what to do; these say what is known once it is done, so that the next plan repeats nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.operators.numbering import numbered

#: The states of an upload in the ledger, and which may follow which (first: of a file that is not in it).
STATUSES = ["pending", "uploading", "completed", "failed"]
FOLLOWS = [["pending"], ["uploading"], ["completed", "failed"], ["pending"], ["pending"]]

#: Events that one row folds.
BLOCK = 1024


def _index(status: Column) -> Column:
    """1 to 4; 0 for none or an unknown one."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, STATUSES)), status).cast("int"), F.lit(0))


def _cell(to: Column, accepted: Column, at: Column) -> Column:
    return F.struct(to.cast("int").alias("to"), accepted.cast("long").alias("accepted"), at.cast("long").alias("at"))


def _step(status: Column, at: Column) -> Column:
    """What an event does to each state a file may be in: an array by state. Illegal steps leave it as it is."""

    def out_of(state: int) -> Column:
        legal = F.coalesce(status.isin(FOLLOWS[state]), F.lit(False))
        return _cell(F.when(legal, _index(status)).otherwise(state), legal, F.when(legal, at))

    return F.array(*[out_of(s) for s in range(len(FOLLOWS))])


def _nothing() -> Column:
    return F.array(*[_cell(F.lit(s), F.lit(0), F.lit(None)) for s in range(len(FOLLOWS))])


def _then(first: Column, second: Column) -> Column:
    """One such array for two that follow each other; composition is associative, so blocks can be folded anywhere."""

    def go_on(x: Column) -> Column:
        y = second[x["to"]]
        return _cell(y["to"], x["accepted"] + y["accepted"], F.coalesce(y["at"], x["at"]))

    return F.transform(first, go_on)


def fold_events(events: DataFrame, key: str = "md5") -> DataFrame:
    """(key, steps, events): what each file's events, in order of (at, seq), make of every state it may have been in.

    events: (key, at, seq, status). A file's events are numbered and folded in blocks of 1024, then the blocks'
    arrays in blocks, and so on, so that a file with any number of events spans many tasks and no group is held
    whole. Events without a key are left out; those without a known status change nothing but are counted."""
    rows = events.filter(F.col(key).isNotNull()).select(key, "at", "seq", "status")
    level = numbered(rows, [key], ["at", "seq"], "_number", "_total")
    longest = level.agg(F.max("_total")).first()[0] or 0
    level = level.select(key, F.col("_number").alias("n"), _step(F.col("status"), F.col("at")).alias("steps"), F.lit(1).cast("long").alias("events"))
    while True:
        block = F.call_function("div", F.col("n"), F.lit(BLOCK).cast("long"))
        level = level.groupBy(key, block.alias("b")).agg(F.sort_array(F.collect_list(F.struct("n", "steps"))).alias("all"), F.sum("events").alias("events"))
        level = level.select(key, F.col("b").alias("n"), F.aggregate("all", _nothing(), lambda a, x: _then(a, x["steps"])).alias("steps"), "events")
        longest = -(-longest // BLOCK)
        if longest <= 1:
            return level.select(key, "steps", "events")


def next_ledger(ledger: DataFrame, events: DataFrame, key: str = "md5") -> DataFrame:
    """(key, status, at, accepted, rejected): the ledger after events; files that never got a status have null.

    ledger: (key, status, at), one row a file. Steps that may not follow are rejected and counted; ``at`` is
    the time of the last step accepted."""
    known = ledger.select(key, F.col("status").alias("_status"), F.col("at").alias("_at"))
    rows = known.join(fold_events(events, key), key, "full")
    cell = F.col("steps")[_index(F.col("_status"))]
    became = F.get(F.array(*map(F.lit, STATUSES)), cell["to"] - 1)
    accepted = F.coalesce(cell["accepted"], F.lit(0).cast("long"))
    return rows.select(
        key, F.coalesce(became, F.col("_status")).alias("status"), F.coalesce(cell["at"], F.col("_at").cast("long")).alias("at"),
        accepted.alias("accepted"), (F.coalesce("events", F.lit(0).cast("long")) - accepted).alias("rejected"),
    )


def next_cache(cache: DataFrame, local: DataFrame, plan: DataFrame, failed: DataFrame, now: Column) -> DataFrame:
    """(path, size, hash, last_sync): the cache after a plan was carried out, but for the paths of ``failed``.

    local: the files as they are now. Transferred files are recorded, and those that were there already though the
    cache did not know; deleted ones go. A path that failed keeps what the cache had, so the next plan has it again."""
    done = plan.filter((F.col("action") != "skip") | (F.col("reason") == "already_remote")).select("path", "action")
    done = done.join(failed.select("path").distinct(), "path", "left_anti")
    kept = cache.select("path", "size", "hash", "last_sync").join(done.select("path").distinct(), "path", "left_anti")
    moved = done.filter("action <> 'delete'").select("path").distinct()
    return kept.unionByName(local.select("path", "size", "hash").join(moved, "path").withColumn("last_sync", now))
