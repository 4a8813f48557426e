"""A work queue whose items pass from pending to processing to their outcome, each exactly once although workers may be killed.

A claim is a commit: the rows of a micro-batch are written as a folder named by its number before the work begins, the outcomes as
another one after it. A micro-batch that is repeated replaces its own folders; those of another checkpoint have other names. Folders without Spark's mark of success are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.runs import finalize_run
from .metrics import Tally

Work = Callable[[DataFrame], DataFrame]
OUTCOME = "status string, error_msg string, processed_at timestamp"


class WorkLog:
    """Claims (id, claimed_at) and outcomes (id, status, error_msg, processed_at) under one folder."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint"):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._schema = {"claims": f"id {id_type}, claimed_at timestamp", "outcomes": f"id {id_type}, {OUTCOME}"}

    def batches(self, kind: str) -> list[str]:
        """Names of the commits that are whole."""
        place = self._hadoop.Path(f"{self.path}/{kind}")
        if not self._fs.exists(place):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(place)]
        return sorted(n for n in names if self._fs.exists(self._hadoop.Path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def read(self, kind: str, without: str | None = None) -> DataFrame:
        """The rows of all whole commits, or of all but one; ``batch`` names theirs."""
        names = [n for n in self.batches(kind) if n != without]
        if not names:
            return self.spark.createDataFrame([], f"{self._schema[kind]}, batch string")
        rows = self.spark.read.schema(self._schema[kind]).parquet(*[f"{self.path}/{kind}/{n}" for n in names])
        return rows.withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]*$", 1))

    def commit(self, kind: str, batch: str, rows: DataFrame) -> DataFrame:
        place = f"{self.path}/{kind}/{batch}"
        rows.write.mode("overwrite").parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)

    def open(self) -> DataFrame:
        """(id, claimed_at): items claimed, the last time they were, that have no outcome yet."""
        last = self.read("claims").groupBy("id").agg(F.max("claimed_at").alias("claimed_at"))
        return last.join(self.read("outcomes"), "id", "left_anti")

    def queue(self, queue: DataFrame) -> DataFrame:
        """The queue as it stands: status, error_msg and processed_at of worked items, ``processing`` for those in work.

        An item with two outcomes (a worker taken for dead had gone on) keeps the first one by time, then commit.
        """
        order = F.struct("processed_at", "batch")
        done = self.read("outcomes").groupBy("id").agg(F.min_by(F.struct("status", "error_msg", "processed_at"), order).alias("__o"))
        held = self.open().select("id", F.lit(True).alias("__held"))
        rows = queue.join(done, "id", "left").join(held, "id", "left")
        new = lambda c, other: F.when(F.col("__o").isNotNull(), F.col("__o")[c]).otherwise(other).alias(c)
        out = {"status": new("status", F.when(F.col("__held"), "processing").otherwise(F.col("status")))}
        out |= {c: new(c, F.col(c)) for c in ("error_msg", "processed_at")}
        return rows.select(*[out.get(c, F.col(c)) for c in queue.columns])


def _work_off(log: WorkLog, batch: str, items: DataFrame, work: Work, now: Column, tally: Tally | None) -> None:
    cols = items.columns
    claimed = log.commit("claims", batch, items.withColumn("claimed_at", now).select("id", "claimed_at", *[c for c in cols if c not in ("id", "claimed_at")]))
    outcomes = work(claimed.select(*cols)).select("id", "status", "error_msg", "processed_at")
    log.commit("outcomes", batch, outcomes if tally is None else tally.watch(outcomes, batch))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint; a checkpoint made anew in the same place has another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def drain_claims(queue: DataFrame, log: WorkLog, work: Work, checkpoint: str, now: Column, tally: Tally | None = None) -> None:
    """Work off a stream of queue rows: pending ones, each id once, that no other commit has claimed.

    ``work(items)`` gives (id, status, error_msg, processed_at) for each item. If it fails, the claims stay and the next call with the same
    checkpoint repeats that micro-batch. ``tally`` counts outcomes while they are written.
    """
    def batch(rows: DataFrame, number: int) -> None:
        name = f"{stream_id(rows.sparkSession, checkpoint)}-{number:012d}"
        fresh = rows.filter("status = 'pending'").dropDuplicates(["id"]).join(log.read("claims", without=name), "id", "left_anti")
        _work_off(log, name, fresh, work, now, tally)

    queue.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def take_up_again(queue: DataFrame, log: WorkLog, work: Work, now: Column, minutes: int = 15, tally: Tally | None = None) -> int:
    """Claim and work off the items in work for more than ``minutes``, as one commit of its own; how many there were."""
    stuck = log.open().filter(F.col("claimed_at") < now - F.expr(f"INTERVAL {int(minutes)} MINUTES")).select("id")
    items = queue.dropDuplicates(["id"]).join(stuck, "id", "left_semi")
    n = items.count()
    if n:
        _work_off(log, f"again-{len(log.batches('claims')):012d}", items, work, now, tally)
    return n


def close_when_empty(queue: DataFrame, log: WorkLog, runs: DataFrame) -> DataFrame:
    """The run log with its newest run in progress completed, if no item is pending or in work; otherwise as it is."""
    left = log.queue(queue).filter("status IN ('pending', 'processing')")
    return runs if left.limit(1).count() else finalize_run(runs)
