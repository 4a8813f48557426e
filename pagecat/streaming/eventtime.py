"""Gates in event time: rows are decided in the order of their times, whatever order they arrive in, and state ends.

A row waits in its key's state until the watermark has passed it; so rows may come in any order within ``delay``. Every row gets
an answer: one older than the watermark is ``late``, and ``drain_apart`` writes those to a table of their own. A key is forgotten
once the watermark has passed all that could still matter to it. A stream that has ended is closed by a row of kind ``close`` (of any
key) with a time beyond all others by more than ``delay``. All waiting rows of a key are ordered in one task, but for ``wait_outcomes``:
what a request hears lies close to it, so a key's rows are spread by their time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StringType

from ..operators.running import micros

MINUTE_US = 60_000_000
# Groups of slots of time: of all keys together, or of each key where Python cannot tell keys apart as Spark does.
BUCKETS, BUCKETS_OF_KEY = 1024, 64
# At one instant ends come before requests, good ends before failed ones.
ORDER = {"completed": 0, "done": 0, "end": 0, "empty": 1, "failed": 2, "request": 3}
_KIND = {0: "completed", 1: "empty", 2: "failed", 3: "request"}
# A row in the state of ``wait_outcomes``: its key's number, time, mark (kind, if it has no id, if it is a copy) and id.
_HELD = ("int32", "int64", "int8", "int64")
_UNKNOWN, _UNNAMED, _COPY = 4, 8, 16
_SAID = np.array(["done", "timeout", "failed"], object)
Advance = Callable[[tuple, list[tuple], int], tuple[tuple, list[tuple], int | None]]


def clocked(events: DataFrame, at: str, delay: str, kind: str) -> DataFrame:
    """The events with a watermark that advances by ``at``, none of them dropped as late.

    Each event stands for two rows: one that only tells the time, and goes, and the event itself without a time Spark could judge.
    A row of kind ``close`` only tells the time.
    """
    tick, row = F.struct(F.col(at).alias("wm")), F.struct(F.lit(None).cast("timestamp").alias("wm"))
    return events.withColumn("__w", F.explode(F.when(F.col(kind) == "close", F.array(tick)).otherwise(F.array(row, tick)))).withColumn("wm", F.col("__w.wm")).drop("__w").withWatermark("wm", delay).filter("wm IS NULL")


def _ordered(events: DataFrame, by: str, at: str, kind: str, id_col: str, delay: str) -> DataFrame:
    """(key, id, t, k, wm): the clocked events, ``k`` the place of their kind in ``ORDER``."""
    order = F.create_map(*[F.lit(x) for pair in ORDER.items() for x in pair])
    return clocked(events, at, delay, kind).select(
        F.col(by).alias("key"), F.col(id_col).cast("long").alias("id"), micros(at).alias("t"), order[F.col(kind)].alias("k"), "wm")


def _in_time(events: DataFrame, by: str, at: str, kind: str, id_col: str, delay: str, out: str, machine: str, empty: tuple, advance: Advance) -> DataFrame:
    """Run ``advance(machine, due rows (t, order, id), watermark)`` per key: the next machine, answers (id, t, answer), and when it must be
    asked again even without rows (None: it can be forgotten)."""
    rows = _ordered(events, by, at, kind, id_col, delay)
    key_type = rows.schema["key"].dataType.simpleString()
    width = len(empty)

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock = state.getCurrentWatermarkMs()
        held = state.get if state.exists else (*empty, [], [], [])
        current, waiting = tuple(held[:width]), list(zip(*[list(x) for x in held[width:]], strict=True))
        answers = []
        for pdf in () if state.hasTimedOut else pdfs:
            for id_, t, k in zip(pdf["id"].tolist(), pdf["t"].tolist(), pdf["k"].tolist(), strict=True):
                if t < clock * 1000:
                    answers.append((id_, t, "late"))
                else:
                    waiting.append((t, k, id_))
        waiting.sort()
        due = [w for w in waiting if w[0] < clock * 1000]
        waiting = waiting[len(due):]
        current, told, again = advance(current, due, clock * 1000)
        answers += told
        wake = min([w[0] for w in waiting[:1]] + ([] if again is None else [again]), default=None)
        if wake is None:
            if state.exists:
                state.remove()
        else:
            state.update((*current, *[[w[i] for w in waiting] for i in range(3)]))
            state.setTimeoutTimestamp(max(wake // 1000 + 1, clock + 1))
        if answers:
            id_, t, answer = zip(*answers, strict=True)
            yield pd.DataFrame({"key": [key[0]] * len(id_), "id": id_, "t": t, out: answer})

    return rows.groupBy("key").applyInPandasWithState(
        step, f"key {key_type}, id bigint, t bigint, {out} string", f"{machine}, ts array<bigint>, ks array<bigint>, ids array<bigint>", "append",
        GroupStateTimeout.EventTimeTimeout)


def run_gate(events: DataFrame, by: str, minutes: int = 15, delay: str = "15 minutes", at: str = "at", kind: str = "kind",
             id_col: str = "id") -> DataFrame:
    """(key, id, t, decision) per request: already_running, too_recent, started or late; the batch form is ``plans.runs.run_gate``.

    ``kind`` is request, completed or failed. A started run goes on until the next end of its key; a completed one holds the next
    back for ``minutes`` after its start, a failed one does not. An end that is late is answered as ``late``, too, and changes nothing.
    """
    gap = minutes * MINUTE_US

    def advance(machine, due, clock):
        going, last = machine
        out = []
        for t, k, id_ in due:
            if k < 3:
                if going >= 0:
                    going, last = -1, going if _KIND[k] == "completed" else last
            elif going >= 0:
                out.append((id_, t, "already_running"))
            elif last >= 0 and t - last <= gap:
                out.append((id_, t, "too_recent"))
            else:
                out.append((id_, t, "started"))
                going = t
        if going >= 0:
            # A run without an end keeps its key, as its lock does.
            return (going, last), out, 2**62
        return (going, last), out, last + gap if last >= 0 and last + gap >= clock else None

    return _in_time(events, by, at, kind, id_col, delay, "decision", "going bigint, last bigint", (-1, -1), advance)


def single_flight(events: DataFrame, by: str, delay: str = "5 minutes", at: str = "at", kind: str = "kind", id_col: str = "id") -> DataFrame:
    """(key, id, t, role) per request: owner if none of its key is open, waiter or late. ``kind`` is request or any end."""
    def advance(machine, due, clock):
        open_, out = machine[0], []
        for t, k, id_ in due:
            if k == 3:
                out.append((id_, t, "waiter" if open_ else "owner"))
            open_ = k == 3
        return (open_,), out, 2**62 if open_ else None

    return _in_time(events, by, at, kind, id_col, delay, "role", "open boolean", (False,), advance)


def _outcomes(who: np.ndarray, t: np.ndarray, kind: np.ndarray, now: int, wait: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in the order of key, time and kind: what each hears, which requests are answered, and which rows are still needed."""
    n, asks, due = len(t), kind == 3, t < now
    if (kind[due] == _UNKNOWN).any():
        raise ValueError(f"a kind is none of {', '.join(ORDER)}")
    # The place of the next end that the watermark has passed. At one instant ends come first: one answers whoever asked before it.
    ends = np.where(~asks & due, np.arange(n), n)
    at = np.minimum.accumulate(ends[::-1])[::-1]
    heard = asks & (at < n)
    heard[heard] = who[at[heard]] == who[heard]
    said, end = np.full(n, "timeout", object), at[heard]
    said[heard] = np.where(t[end] <= t[heard] + wait, _SAID[kind[end]], "timeout")
    known = heard | asks & due & (t + wait < now)
    return said, known, np.where(asks, ~known, ~due)


def wait_outcomes(events: DataFrame, by: str, wait_s: int = 60, delay: str = "5 minutes", at: str = "at", kind: str = "kind",
                  id_col: str = "id") -> DataFrame:
    """(key, id, t, outcome) per request: what it hears from the first end of its key after it asked, or a timeout ``wait_s`` later.

    ``kind`` is request, done, empty (done without a payload: nothing to hear) or failed. The batch form is ``wait_outcome_join``.
    A key's time is cut into slots as long as the wait, and slots share ``BUCKETS`` groups by their hash: a request needs the ends of
    its slot and the next one only, so a key with many rows is spread over groups, and a task holds those of a group.
    """
    wait = wait_s * 1_000_000
    rows = _ordered(events, by, at, kind, id_col, delay)
    key_type = rows.schema["key"].dataType
    shared = isinstance(key_type, IntegralType) or key_type == StringType()
    # An end goes to its own slot and, as a copy, to the one before.
    own, both = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("k") == 3, own).otherwise(both))).withColumn("slot", F.expr(f"t div {max(wait, 1)} - copy"))
    if shared:
        # NULL keys have groups of their own, below zero: beside others they would make whole numbers floating-point ones in Python.
        bucket = F.pmod(F.xxhash64("key", "slot"), F.lit(BUCKETS))
        bucket = F.when(F.col("key").isNull(), -1 - bucket).otherwise(bucket)
    else:
        bucket = F.pmod(F.xxhash64("slot"), F.lit(BUCKETS_OF_KEY))
    mark = F.coalesce("k", F.lit(_UNKNOWN)) + F.when(F.col("id").isNull(), _UNNAMED).otherwise(0) + F.col("copy") * _COPY
    rows = rows.select(bucket.cast("int").alias("bucket"), "key", "t", mark.alias("mark"), F.coalesce("id", F.lit(0)).alias("id"), "wm")

    def step(group, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock = state.getCurrentWatermarkMs()
        now, several = clock * 1000, shared and group[0] >= 0
        keys, *held = state.get if state.exists else ([], *[b""] * len(_HELD))
        number = {k: i for i, k in enumerate(keys)}
        waiting, answers = [[np.frombuffer(x, width) for x, width in zip(held, _HELD, strict=True)]], []
        for pdf in () if state.hasTimedOut else pdfs:
            names = pdf["key"].tolist() if several else [None] * len(pdf)
            pdf = pdf.assign(key=[number.setdefault(k, len(number)) for k in names])
            rows = [pdf[c].astype(width).to_numpy() for c, width in zip(("key", "t", "mark", "id"), _HELD, strict=True)]
            late = rows[1] < now
            waiting.append([x[~late] for x in rows])
            answers.append(([x[late & (rows[2] < _COPY)] for x in rows], "late"))
        rows = [np.concatenate(x) for x in zip(*waiting, strict=True)]
        order = np.lexsort((rows[2] % _UNNAMED, rows[1], rows[0]))
        who, t, mark, ids = rows = [x[order] for x in rows]
        said, known, kept = _outcomes(who, t, mark % _UNNAMED, now, wait)
        answers.append(([x[known] for x in rows], said[known]))
        names = np.array([*number, None], object)
        if kept.any():
            left, codes = np.unique(who[kept], return_inverse=True)
            columns = zip((codes, t[kept], mark[kept], ids[kept]), _HELD, strict=True)
            state.update((names[left].tolist(), *[x.astype(width).tobytes() for x, width in columns]))
            wake = int(np.where(mark % _UNNAMED == 3, t + wait, t)[kept].min())
            state.setTimeoutTimestamp(max(wake // 1000 + 1, clock + 1))
        elif state.exists:
            state.remove()
        for (who, t, mark, ids), outcome in answers:
            if len(t):
                key = names[who] if shared else [group[1]] * len(t)
                yield pd.DataFrame({"key": key, "id": pd.arrays.IntegerArray(ids, mark % _COPY >= _UNNAMED), "t": t, "outcome": outcome})

    of = key_type.simpleString()
    return rows.groupBy("bucket", *([] if shared else ["key"])).applyInPandasWithState(
        step, f"key {of}, id bigint, t bigint, outcome string",
        f"keys array<{of if shared else 'string'}>, who binary, ts binary, marks binary, ids binary", "append", GroupStateTimeout.EventTimeTimeout)


def drain_apart(df: DataFrame, out: str, late: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over what is there; answers go to ``out``, late rows to ``late``. A batch that is repeated replaces its own folders."""
    answer = df.columns[-1]

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        rows.filter(F.col(answer) != "late").write.mode("overwrite").parquet(f"{out}/batch={number}")
        rows.filter(F.col(answer) == "late").drop(answer).write.mode("overwrite").parquet(f"{late}/batch={number}")
        rows.unpersist()

    query = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
