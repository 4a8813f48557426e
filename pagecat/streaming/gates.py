"""Streaming forms of the gates, the queue worker and the audits.

The state holds one small value per key; every input row gives one output row, late ones
included (status ``late``), so nothing is dropped. Sources should bound a micro-batch
(``maxFilesPerTrigger``): a key's rows of one micro-batch are ordered together.

A call into Python costs some milliseconds, so keys do not have one each: whole numbers and strings lie in ``BUCKETS`` groups by their
hash, and a group's state lists its keys. A micro-batch then costs that many calls at most, however many keys it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StringType

from ..operators.merge import update_where
from ..operators.running import micros

MINUTE_US = 60_000_000
BUCKETS = 4096
_NEVER = -(2**62)


def read_stream(spark, path: str, schema, **options) -> DataFrame:
    options = {"maxFilesPerTrigger": "64", **options}
    return spark.readStream.schema(schema).options(**options).parquet(path)


def drain(df: DataFrame, out: str, checkpoint: str) -> None:
    """Run a stream over what is there and write its rows."""
    (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )


class _Groups:
    """Groups of keys, each with a state that lists, per key, the values named in ``held``.

    Keys of types that Python cannot tell apart as Spark does have a group each, as has the key NULL; there the state's key is NULL.
    """

    def __init__(self, rows: DataFrame, held: dict[str, str]):
        kind = rows.schema["key"].dataType
        self.rows, self.width = rows, len(held)
        self.spread = isinstance(kind, IntegralType) or kind == StringType()
        lists = {"keys": kind.simpleString() if self.spread else "string", **held}
        self.state = ", ".join(f"{name} array<{of}>" for name, of in lists.items())

    def apply(self, step, out: str) -> DataFrame:
        """``step(rows, keys, state)``: the rows of a micro-batch, the key of each as the state knows it, and the state, a dict of
        tuples by key, to be changed in place."""
        spread, width = self.spread, self.width

        def group(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            keys, *values = state.get if state.exists else ([], *[[]] * width)
            held = dict(zip(keys, zip(*values, strict=True), strict=True))
            apart = spread and key[0] >= 0
            found = step(pdfs, lambda pdf: pdf["key"].tolist() if apart else [None] * len(pdf), held)
            state.update((list(held), *[list(v) for v in zip(*held.values(), strict=True)]))
            if len(found):
                yield found

        rows = self.rows
        if spread:
            number = F.when(F.col("key").isNull(), -1).otherwise(F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
            rows = rows.withColumn("bucket", number.cast("int"))
        return rows.groupBy("bucket" if spread else "key").applyInPandasWithState(
            group, out, self.state, "append", GroupStateTimeout.NoTimeout
        )


def _named(rows: DataFrame) -> DataFrame:
    """The rows with ``unnamed``, true without an id. A NULL among whole numbers would make them, and those of other keys beside it,
    floating-point numbers on the way to Python, which are not exact."""
    if not isinstance(rows.schema["id"].dataType, IntegralType):
        return rows.withColumn("unnamed", F.lit(False))
    zero = F.lit(0).cast(rows.schema["id"].dataType)
    return rows.withColumns({"unnamed": F.col("id").isNull(), "id": F.coalesce("id", zero)})


def _in_order(pdfs: Iterator[pd.DataFrame], *by: str) -> pd.DataFrame:
    return pd.concat(list(pdfs), ignore_index=True).sort_values([*by, "unnamed", "id"], kind="stable")


def _answers(pdf: pd.DataFrame, out: str) -> pd.DataFrame:
    if pdf["unnamed"].any():
        pdf = pdf.assign(id=pdf["id"].astype("Int64").mask(pdf["unnamed"]))
    return pdf[["key", "id", "t", out]]


def cooldown_gate(requests: DataFrame, by: str, minutes: int = 15, at: str = "requested_at",
                  id_col: str = "id") -> DataFrame:
    """(key, id, t, decision) per request: started, too_recent or late (older than the last admitted one)."""
    gap = minutes * MINUTE_US
    rows = requests.select(F.col(by).alias("key"), F.col(id_col).alias("id"), micros(at).alias("t"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def step(pdfs: Iterator[pd.DataFrame], keys_of, held: dict) -> pd.DataFrame:
        pdf = _in_order(pdfs, "t")
        decisions = []
        for key, t in zip(keys_of(pdf), pdf["t"].astype("int64").tolist(), strict=True):
            last, = held.get(key, (_NEVER,))
            if t > last + gap:
                held[key] = (t,)
            decisions.append("started" if t > last + gap else "late" if t < last else "too_recent")
        return _answers(pdf.assign(decision=decisions), "decision")

    return _Groups(_named(rows), {"last": "bigint"}).apply(step, f"key {kinds['key']}, id {kinds['id']}, t bigint, decision string")


def single_flight(events: DataFrame, by: str, at: str = "ts", kind: str = "kind", id_col: str = "id") -> DataFrame:
    """(key, id, t, role) per request: owner if none of its key is open, else waiter."""
    rows = events.select(
        F.col(by).alias("key"), F.col(id_col).alias("id"), micros(at).alias("t"), F.col(kind).alias("kind")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def step(pdfs: Iterator[pd.DataFrame], keys_of, held: dict) -> pd.DataFrame:
        pdf = _in_order(pdfs, "t", "kind")
        asks = (pdf["kind"] == "request").to_numpy()
        roles = []
        for key, t, ask in zip(keys_of(pdf), pdf["t"].astype("int64").tolist(), asks.tolist(), strict=True):
            open_, seen = held.get(key, (False, _NEVER))
            roles.append("late" if t < seen else "waiter" if open_ else "owner")
            held[key] = (ask, max(seen, t))
        return _answers(pdf.assign(role=roles)[asks], "role")

    return _Groups(_named(rows), {"open": "boolean", "seen": "bigint"}).apply(
        step, f"key {kinds['key']}, id {kinds['id']}, t bigint, role string"
    )


def active_runs(log: DataFrame, by: str, at: str = "ts", delta: str = "delta") -> DataFrame:
    """(key, t, active) for each moment a run began while another of its key was going; delta is 1 or -1.

    A run's end may come with its start, long before its time: it waits in the state. What lies beyond the newest start of a
    micro-batch is not decided in it. Starts must come in order from batch to batch, those of one moment in one batch.
    """
    rows = log.select(F.col(by).alias("key"), micros(at).alias("t"), F.coalesce(F.col(delta).cast("int"), F.lit(0)).alias("d"))
    rows = rows.filter("t IS NOT NULL")
    kind = rows.schema["key"].dataType.simpleString()

    def step(pdfs: Iterator[pd.DataFrame], keys_of, held: dict) -> pd.DataFrame:
        # Each chunk shrinks to one entry per key and moment as it arrives: what it adds, and if a run began.
        found, shown, out = {}, {}, []
        for pdf in pdfs:
            columns = (pdf[c].astype("int64").tolist() for c in ("t", "d"))
            for key, value, t, d in zip(keys_of(pdf), pdf["key"], *columns, strict=True):
                shown[key] = value
                moment = found.setdefault(key, {}).setdefault(t, [0, False])
                moment[0] += d
                moment[1] |= d == 1
        for key, moments in found.items():
            active, ends = held.get(key, (0, []))
            newest = max((t for t, (_, began) in moments.items() if began), default=_NEVER)
            for t in ends:
                moments.setdefault(t, [0, False])[0] -= 1
            later = []
            for t, (n, began) in sorted(moments.items()):
                if t > newest:
                    later += [t] * -n
                    continue
                active += n
                if began and active > 1:
                    out.append((shown[key], t, active))
            held[key] = (active, later)
        return pd.DataFrame(out, columns=["key", "t", "active"])

    return _Groups(rows, {"active": "bigint", "ends": "array<bigint>"}).apply(step, f"key {kind}, t bigint, active bigint")


def worked_queue(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The queue with status, message and time of the items worked on; all others as they were."""
    return update_where(queue, outcomes, "id", ["status", "error_msg", "processed_at"])


def queue_worker(queue: DataFrame, work, out: str, checkpoint: str) -> None:
    """Drain a stream of queue rows: each micro-batch of pending rows is worked on once.

    ``work(items)`` returns a DataFrame of outcomes. A batch writes its own folder, so a repeated batch
    replaces itself. Returns when nothing is left; then ``worked_queue`` writes the outcomes back and the run can be closed.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        pending = df.filter(F.col("status") == "pending")
        work(pending).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (
        queue.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )
