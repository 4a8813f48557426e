"""The gates as micro-batches over the batch operators: for streams in which one key may fill a batch.

Stateful functions see all rows of a key in one task. Here each micro-batch runs the batch operator, which spreads
a key over tasks, and what must be known later is a small table per batch in the shared folder. A batch writes
folders of its own and reads those of the one before, so a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..operators.running import micros
from ..plans import runs
from ..session import cut

Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def run_batches(stream: DataFrame, step: Step, out: str, state: str, checkpoint: str) -> None:
    """Drain the stream: ``step(rows, state)`` gives the rows to write and the next state."""

    def batch(df: DataFrame, batch_id: int) -> None:
        old = df.sparkSession.read.parquet(f"{state}/batch={batch_id - 1}") if batch_id else None
        df.persist()  # read by the result and by the state
        result, new = step(df, old)
        result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        new.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        df.unpersist()

    (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def _with_state(rows: DataFrame, old: DataFrame | None, by: str, cols: dict[str, str]) -> DataFrame:
    if old is None:
        return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in cols.items()})
    return rows.join(old, by, "left")


def _clock(old: DataFrame | None, by: str, seen: str) -> DataFrame | None:
    """The newest time of the batches before: it stands in the state, in a row without a key."""
    return None if old is None else F.broadcast(old.filter(F.col(by).isNull()).agg(F.max(seen).alias("__before")))


def _too_late(rows: DataFrame, old: DataFrame | None, by: str, seen: str, keep: int | None) -> DataFrame:
    """Add ``__late``: older than what the state still knows. ``t`` is the row's time."""
    if keep is None or old is None:
        return rows.withColumn("__late", F.lit(False))
    late = F.coalesce(F.col("t") < F.col("__before") - keep, F.lit(False))
    return rows.crossJoin(_clock(old, by, seen)).withColumn("__late", late).drop("__before")


def _trimmed(state: DataFrame, times: DataFrame, old: DataFrame | None, by: str, seen: str, needed, keep: int | None) -> DataFrame:
    """The state without keys that no later row can need, and its clock. ``needed`` tells from the newest time still allowed."""
    if keep is None:
        return state
    newest = times.agg(F.max("t").alias("__before"))
    if old is not None:
        newest = newest.unionByName(_clock(old, by, seen)).agg(F.max("__before").alias("__before"))
    kept = state.filter(F.col(by).isNotNull()).crossJoin(F.broadcast(newest)).filter(needed(F.col("__before") - keep)).drop("__before")
    return kept.unionByName(newest.select(F.col("__before").alias(seen)), allowMissingColumns=True)


def cooldown_gate(by: str, minutes: int = 15, at: str = "requested_at", id_col: str = "id",
                  keep_minutes: int | None = None) -> Step:
    """Rows with a decision: started, too_recent or late. State: the last admitted time per key.

    With ``keep_minutes`` a key leaves the state once its cooldown lies that far behind the stream's newest time; a row
    older than that is late whatever its key. Without it the state keeps every key.
    """
    gap = minutes * runs.MINUTE_US
    keep = None if keep_minutes is None else keep_minutes * runs.MINUTE_US

    def step(rows: DataFrame, old: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        timed = _too_late(rows.select(by, id_col, at).withColumn("t", micros(at)), old, by, "last", keep)
        known = _with_state(timed, old, by, {"last": "bigint"})
        # Inside the cooldown of the last admitted one the state decides; what lies beyond starts afresh.
        inside = F.coalesce(F.col("t") <= F.col("last") + gap, F.lit(False)) | F.col("__late")
        late = F.col("__late") | F.coalesce(F.col("t") < F.col("last"), F.lit(False))
        blocked = known.filter(inside).select(by, id_col, at, F.when(late, "late").otherwise("too_recent").alias("decision"))
        free = cut(runs.cooldown_gate(known.filter(~inside).select(by, id_col, at), [by], minutes, at, id_col))
        started = free.filter("decision = 'started'").select(by, micros(at).alias("last"))
        every = started if old is None else started.unionByName(old)
        state = every.groupBy(by).agg(F.max("last").alias("last"))
        return free.unionByName(blocked), _trimmed(state, timed, old, by, "last", lambda least: F.col("last") + gap >= least, keep)

    return step


def single_flight(by: str, at: str = "ts", kind: str = "kind", id_col: str = "id", keep_minutes: int | None = None) -> Step:
    """Requests with a role: owner, waiter or late. State: the time of the last event per key and if one is open.

    With ``keep_minutes`` a key with nothing open leaves the state that long after its last event, by the stream's newest time;
    a row older than that is late whatever its key. Without it the state keeps every key.
    """
    keep = None if keep_minutes is None else keep_minutes * runs.MINUTE_US

    def step(rows: DataFrame, old: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        events = rows.select(by, id_col, F.col(at).alias("at"), F.col(kind).alias("kind")).withColumn("t", micros("at"))
        timed = _too_late(events, old, by, "seen", keep)
        known = _with_state(timed, old, by, {"seen": "bigint", "open": "boolean"})
        late = F.coalesce(F.col("t") < F.col("seen"), F.lit(False)) | F.col("__late")
        fresh = known.filter(~late).select(by, id_col, "at", "kind")
        if old is not None:
            # What was open before stands as an event just before the batch.
            before = old.filter(F.col(by).isNotNull()).select(
                by, F.lit(None).cast(fresh.schema[id_col].dataType).alias(id_col),
                F.timestamp_micros(F.col("seen") - 1).alias("at"),
                F.when(F.col("open"), "request").otherwise("end").alias("kind"),
            )
            fresh = fresh.unionByName(before)
        roles = runs.single_flight(fresh, [by], "at", "kind", id_col).filter(F.col(id_col).isNotNull())
        behind = known.filter(late & (F.col("kind") == "request")).select(
            by, id_col, "at", "kind", F.lit("late").alias("role")
        )
        last = fresh.select(
            by, micros("at").alias("seen"), (F.col("kind") == "request").alias("open")
        ).groupBy(by).agg(F.max(F.struct("seen", "open")).alias("s")).select(by, "s.*")
        # A key without rows in this batch has its event one microsecond early: the old row is newer.
        state = last if old is None else last.unionByName(old).groupBy(by).agg(
            F.max(F.struct("seen", "open")).alias("s")
        ).select(by, "s.*")
        return roles.unionByName(behind), _trimmed(
            state, timed, old, by, "seen", lambda least: F.col("open") | (F.col("seen") >= least), keep)

    return step


def ttl(minutes: int = 5, id_col: str = "id", at: str = "at", kind: str = "kind") -> Step:
    """Requests with an outcome, once it is known: ended within their life, or expired.

    ``kind`` is request or end. State: the requests still open with the end of their life, and the newest time seen (in a row
    without an id). A request leaves the state when it ends or when the stream's time passes its life, so the state holds
    no more than the requests of that many minutes.
    """
    life = minutes * runs.MINUTE_US

    def step(rows: DataFrame, old: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        events = rows.select(id_col, micros(at).alias("t"), kind)
        asked = events.filter(F.col(kind) == "request").select(id_col, (F.col("t") + life).alias("expires"))
        if old is None:
            old = asked.limit(0)
        seen = events.agg(F.max("t").alias("m")).unionByName(old.filter(F.col(id_col).isNull()).select(F.col("expires").alias("m")))
        newest = seen.agg(F.max("m").alias("expires"))
        ends = events.filter(F.col(kind) == "end").groupBy(id_col).agg(F.min("t").alias("ended"))
        still = asked.unionByName(old.filter(F.col(id_col).isNotNull())).join(ends, id_col, "left")
        outcome = F.when(F.col("ended") < F.col("expires"), "ended").when(F.col("expires") <= F.col("newest"), "expired")
        known = cut(still.crossJoin(F.broadcast(newest.withColumnRenamed("expires", "newest"))).withColumn("outcome", outcome))
        clock = newest.select(F.lit(None).cast(known.schema[id_col].dataType).alias(id_col), "expires")
        return known.filter("outcome IS NOT NULL").select(id_col, "outcome"), known.filter("outcome IS NULL").select(
            id_col, "expires").unionByName(clock)

    return step
