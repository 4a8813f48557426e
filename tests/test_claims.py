"""Claims of a work queue over kills and restarts, newest captures in any order, counts while rows are written."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagecat.plans.runs import outcome_counts
from pagecat.session import scratch
from pagecat.sources.tables import scan_pages
from pagecat.streaming import captures as cap, claims as c, gates as g
from pagecat.streaming.metrics import StreamTally, Tally

QUEUE = "id long, status string, error_msg string, processed_at timestamp"


def at(minute):
    return F.lit(datetime(2024, 1, 1, 10, minute)).cast("timestamp")


def work(items):
    status = F.when(F.col("id") % 5 == 0, "error").when(F.col("id") % 7 == 0, "skipped").otherwise("done")
    return items.select("id", status.alias("status"), F.when(F.col("id") % 5 == 0, "bad").alias("error_msg"), at(30).alias("processed_at"))


def status_of(i):
    return "error" if i % 5 == 0 else "skipped" if i % 7 == 0 else "done"


def queue_files(spark, ids, files=4):
    path = scratch(spark, "queue")
    for k in range(files):
        part = [(i, "pending" if i % 4 else "done", None, None) for i in ids if i % files == k]
        spark.createDataFrame(part, QUEUE).coalesce(1).write.mode("append").parquet(path)
    return path


def test_a_killed_drain_is_taken_up_exactly_once(spark):
    path, base = queue_files(spark, range(60), 3), scratch(spark, "claims")
    log, worked, tally = c.WorkLog(spark, base), [], Tally()
    queue = spark.read.parquet(path)

    def dies(items):
        if log.batches("outcomes"):
            raise RuntimeError("killed")
        worked.extend(r["id"] for r in items.collect())
        return work(items)

    def stream():
        return g.read_stream(spark, path, queue.schema, maxFilesPerTrigger="1")

    with pytest.raises(Exception, match="killed"):
        c.drain_claims(stream(), log, dies, base + "/state", at(0), tally)
    # One micro-batch has its outcomes, the next one is in work, the third not begun.
    states = {r["status"]: r["n"] for r in log.queue(queue).filter("id % 4 > 0").groupBy(F.when(F.col("status").isin("pending", "processing"), F.col("status")).otherwise("worked").alias("status")).agg(F.count("*").alias("n")).collect()}
    assert states == {"worked": 15, "processing": 15, "pending": 15}
    runs = spark.createDataFrame([(1, "inprogress", datetime(2024, 1, 1))], "id long, status string, refresh_time timestamp")
    assert c.close_when_empty(queue, log, runs).first()["status"] == "inprogress"

    def goes_on(items):
        worked.extend(r["id"] for r in items.collect())
        return work(items)

    c.drain_claims(stream(), log, goes_on, base + "/state", at(1), tally)
    after = {r["id"]: r["status"] for r in log.queue(queue).collect()}
    assert after == {i: status_of(i) if i % 4 else "done" for i in range(60)}
    assert sorted(worked) == [i for i in range(60) if i % 4]
    assert log.read("outcomes").count() == 45 and log.open().count() == 0
    assert c.close_when_empty(queue, log, runs).first()["status"] == "completed"
    expected = outcome_counts(log.read("outcomes").withColumn("run", F.lit(1)), ["run"]).drop("run").first().asDict()
    assert tally.counts() == expected
    # Nothing new: a third drain works on nothing, files delivered again neither.
    again = queue_files(spark, range(60), 1)
    c.drain_claims(g.read_stream(spark, again, queue.schema), log, goes_on, base + "/state2", at(2))
    assert len(worked) == 45


def test_stuck_items_are_taken_up_and_late_answers_change_nothing(spark):
    log = c.WorkLog(spark, scratch(spark, "stuck"))
    queue = spark.createDataFrame([(i, "pending", None, None) for i in range(6)], QUEUE)
    log.commit("claims", "b000000000000", queue.filter("id < 4").select("id", at(0).alias("claimed_at")))
    log.commit("claims", "b000000000001", queue.filter("id >= 4").select("id", at(14).alias("claimed_at")))
    assert c.take_up_again(queue, log, work, at(15)) == 0
    assert c.take_up_again(queue, log, work, at(16)) == 4
    assert c.take_up_again(queue, log, work, at(16)) == 0
    assert {r["id"]: r["status"] for r in log.queue(queue).collect()} == {0: "error", 1: "done", 2: "done", 3: "done", 4: "processing", 5: "processing"}
    # The worker taken for dead answers after all.
    late = queue.filter("id < 4").select("id", F.lit("error").alias("status"), F.lit("late").alias("error_msg"), at(45).alias("processed_at"))
    log.commit("outcomes", "b000000000000", late)
    assert {r["status"] for r in log.queue(queue).filter("id IN (1, 2, 3)").collect()} == {"done"}
    empty = c.WorkLog(spark, scratch(spark, "none"))
    assert empty.queue(queue).filter("status = 'pending'").count() == 6 and empty.open().count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_newest_capture_whatever_the_order_of_files(spark, rows, seed):
    dice = random.Random(seed)
    kind = "url string, html string, captured_at timestamp, extra int"
    captures = [(f"u{dice.randint(0, 12)}", f"t{n}", datetime(2024, 1, 1, 0, n // 60, n % 60), n) for n in range(200)]
    captures += [(None, f"n{n}", None, n) for n in range(7)] + [("u3", "newest", None, 0), ("v", "only", None, 1)]
    dice.shuffle(captures)
    path, base = scratch(spark, "captures"), scratch(spark, "newest")
    for k in range(5):
        spark.createDataFrame(captures[k::5], kind).repartition(2).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    cap.keep_newest(spark, path, schema, "captured_at", base + "/out", base + "/state", maxFilesPerTrigger="2")
    taken = spark.read.parquet(base + "/out")
    assert rows(cap.current_pages(spark, base + "/out", "captured_at")) == rows(scan_pages(spark.read.parquet(path), "captured_at"))
    # A capture that is older than one known is not read for its text.
    assert taken.filter("url IS NOT NULL").count() < 100 and taken.columns[:4] == ["url", "html", "captured_at", "extra"]
    spark.createDataFrame([("u1", "old", datetime(2023, 1, 1), 0), ("w", "new", datetime(2023, 1, 1), 0)], kind).coalesce(1).write.mode("append").parquet(path)
    n = taken.count()
    cap.keep_newest(spark, path, schema, "captured_at", base + "/out", base + "/state")
    assert spark.read.parquet(base + "/out").count() == n + 1


def test_the_state_of_captures_never_reads_texts(spark):
    path = scratch(spark, "light")
    spark.createDataFrame([("u", "text", 1)], "url string, html string, captured_at long").write.parquet(path)
    stream = g.read_stream(spark, path, spark.read.parquet(path).schema)
    query = cap.newer_captures(stream, "captured_at").writeStream.format("noop").option("checkpointLocation", scratch(spark, "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "ReadSchema: struct<url:string,captured_at:bigint>" in plan


def test_counts_of_a_stream_while_it_goes(spark):
    path, base = queue_files(spark, range(1, 61)), scratch(spark, "tally")
    tally = StreamTally()
    spark.streams.addListener(tally)
    try:
        g.drain(tally.watch(work(g.read_stream(spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger="1"))), base + "/out", base + "/state")
        assert tally.ended()
    finally:
        spark.streams.removeListener(tally)
    out = spark.read.parquet(base + "/out").withColumn("run", F.lit(1))
    assert tally.counts() == outcome_counts(out, ["run"]).drop("run").first().asDict()
    assert len(tally._seen) == 4
