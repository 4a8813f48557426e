"""Gates in event time against sequential models, whatever the order of arrival; state that ends; late rows."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pagecat.plans import runs
from pagecat.session import scratch
from pagecat.streaming import eventtime as e, gates as g

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
KIND = "key string, id long, at timestamp, kind string"


def at(seconds):
    return ZERO + timedelta(seconds=seconds)


def history(seed, n=400, keys=3, span=20_000):
    """Requests and ends at random seconds, many at the same one."""
    r = random.Random(seed)
    return [(f"k{r.randrange(keys)}", i, r.randrange(span), r.choice(["request", "request", "completed", "failed"])) for i in range(n)]


def model(events, gap):
    """Decisions of the gate, event by event."""
    going, last, out = {}, {}, {}
    for key, i, t, kind in sorted(events, key=lambda x: (x[2], ["completed", "failed", "request"].index(x[3]), x[1])):
        if kind != "request":
            if key in going:
                start = going.pop(key)
                if kind == "completed":
                    last[key] = start
        elif key in going:
            out[i] = "already_running"
        elif key in last and t - last[key] <= gap:
            out[i] = "too_recent"
        else:
            out[i], going[key] = "started", t
    return out


def streamed(spark, rows, make, batches):
    """Drain ``make`` over rows given as micro-batches (lists of rows), closed at the end; answers, late rows and the query."""
    base = scratch(spark, "events")
    for k, part in enumerate([*batches, [("", -1, 10**8, "close")]]):
        frame = spark.createDataFrame([(a, i, at(t), kind) for a, i, t, kind in part], KIND)
        frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = g.read_stream(spark, f"{base}/in", KIND, maxFilesPerTrigger="1")
    query = e.drain_apart(make(stream), f"{base}/out", f"{base}/late", f"{base}/state")
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    return {r[1]: r[3] for r in read("out").collect()}, sorted(r["id"] for r in read("late").collect()), query


@pytest.mark.parametrize("seed", range(4))
def test_batch_gate_equals_the_model(spark, seed):
    events = history(seed)
    asks = spark.createDataFrame([(k, i, at(t)) for k, i, t, kind in events if kind == "request"], "key string, id long, requested_at timestamp")
    ends = spark.createDataFrame([(k, at(t), kind) for k, _, t, kind in events if kind != "request"], "key string, finished_at timestamp, status string")
    got = {r["id"]: r["decision"] for r in runs.run_gate(asks, ends, ["key"], 15).collect()}
    assert got == model(events, 900)
    assert set(got.values()) == {"started", "already_running", "too_recent"}


def test_a_failed_run_frees_the_gate(spark):
    asks = spark.createDataFrame([("a", 1, at(0)), ("a", 2, at(60)), ("b", 3, at(0)), ("b", 4, at(60)), ("c", 5, at(0)), ("c", 6, at(9999))],
                                 "key string, id long, requested_at timestamp")
    ends = spark.createDataFrame([("a", at(30), "failed"), ("b", at(30), "completed")], "key string, finished_at timestamp, status string")
    got = {r["id"]: r["decision"] for r in runs.run_gate(asks, ends, ["key"], 15).collect()}
    assert got == {1: "started", 2: "started", 3: "started", 4: "too_recent", 5: "started", 6: "already_running"}
    none = runs.run_gate(asks, ends.limit(0), ["key"], 15).collect()
    assert {r["id"] for r in none if r["decision"] == "started"} == {1, 3, 5}
    assert runs.run_gate(asks.limit(0), ends, ["key"], 15).collect() == []


def test_stream_gate_does_not_depend_on_the_order_of_arrival(spark):
    events = history(9)
    mixed = list(events)
    random.Random(1).shuffle(mixed)
    got, late, _ = streamed(spark, events, lambda s: e.run_gate(s, "key", 15, "6 hours"), [mixed[k::3] for k in range(3)])
    assert got == model(events, 900) and late == []


def test_late_rows_stand_apart_and_change_nothing(spark):
    rows = [("a", 1, 0, "request"), ("a", 2, 100, "completed")]
    later = [("a", 3, 50_000, "request"), ("b", 4, 50_000, "request")]
    behind = [("a", 5, 10, "request"), ("c", 6, 20, "request"), ("a", 7, 50_010, "request")]
    got, late, _ = streamed(spark, rows, lambda s: e.run_gate(s, "key", 15, "15 minutes"), [rows, later, behind])
    assert late == [5, 6] and got == {1: "started", 3: "started", 4: "started", 7: "already_running"}


def test_state_ends(spark):
    """Five hundred keys come and go; the state never holds more than those of the last stretches."""
    batches = [[(f"k{b}-{j}", 1000 * b + j, 4000 * b + j, kind) for j in range(50) for kind in ("request",)]
               + [(f"k{b}-{j}", -1000 * b - j, 4000 * b + j + 60, "completed") for j in range(50)] for b in range(10)]
    got, late, query = streamed(spark, None, lambda s: e.run_gate(s, "key", 15, "15 minutes"), batches)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert len(got) == 500 and late == [] and max(held) <= 100 and held[-1] == 0


def test_wait_outcomes_equal_the_join(spark):
    r = random.Random(5)
    events = [(f"k{r.randrange(3)}", i, r.randrange(5_000), r.choice(["request", "request", "done", "empty", "failed"])) for i in range(300)]
    # One end an instant and key: which of several counts is no rule of either form.
    seen = set()
    events = [x for x in events if x[3] == "request" or not (x[0], x[2]) in seen and not seen.add((x[0], x[2]))]
    asks = spark.createDataFrame([(k, i, at(t)) for k, i, t, kind in events if kind == "request"], "key string, id long, requested_at timestamp")
    log = spark.createDataFrame(
        [(k, i, at(t), "failed" if kind == "failed" else "done", "[]" if kind == "done" else None) for k, i, t, kind in events if kind != "request"],
        "key string, id long, completed_at timestamp, status string, payload string")
    want = {x["id"]: x["outcome"] for x in runs.wait_outcome_join(asks, log, ["key"]).collect()}
    r.shuffle(events)
    got, late, query = streamed(spark, events, lambda s: e.wait_outcomes(s, "key", 60, "2 hours"), [events[k::3] for k in range(3)])
    assert got == want and set(want.values()) == {"done", "failed", "timeout"} and late == []
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def heard(events, wait=60):
    """What each request hears, request by request."""
    ends = [(k, t, ["done", "empty", "failed"].index(kind)) for k, _, t, kind in events if kind != "request"]
    out = {}
    for key, i, asked, kind in events:
        if kind == "request":
            t, said = min(((t, said) for k, t, said in ends if k == key and t > asked), default=(None, 1))
            out[i] = "timeout" if t is None or t > asked + wait else ["done", "timeout", "failed"][said]
    return out


def test_a_key_with_many_waiters_is_spread(spark):
    """One key's rows lie in many states, none with more than a few of them; ends at the edges of slots are heard on both sides."""
    r = random.Random(3)
    events = [("a", i, r.randrange(20_000), r.choice(["request", "request", "done", "empty", "failed"])) for i in range(800)]
    edges = [(0, "request"), (60, "done"), (60, "request"), (120, "failed"), (180, "request"), (241, "done"), (299, "request"), (301, "failed"), (301, "done")]
    events += [("a", 1000 + i, 30_000 + t, kind) for i, (t, kind) in enumerate(edges)]
    events += [("b", 2000, 30_000, "request"), ("b", 2001, 30_059, "failed")]
    want = heard(events)
    mixed = list(events)
    r.shuffle(mixed)
    got, late, query = streamed(spark, events, lambda s: e.wait_outcomes(s, "key", 60, "12 hours"), [mixed[k::3] for k in range(3)])
    assert got == want and late == []
    assert [got[1000 + i] for i, (_, kind) in enumerate(edges) if kind == "request"] == ["done", "failed", "timeout", "done"]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) > 200 and held[-1] == 0


def test_wait_outcomes_late_rows_and_missing_ids_and_keys(spark):
    rows = [("a", 1, 0, "request"), ("a", None, 10, "request"), ("a", 2**60 + 1, 20, "request"), (None, 3, 0, "request"), (None, 4, 60, "failed"), ("a", 5, 50, "done")]
    later = [("a", 6, 50_000, "request")]
    behind = [("a", 7, 5, "done"), ("c", 8, 20, "request"), ("c", 9, 50_010, "request"), ("c", 10, 50_020, "empty"), ("a", 11, 50_030, "done")]
    got, late, _ = streamed(spark, rows, lambda s: e.wait_outcomes(s, "key", 60, "15 minutes"), [rows, later, behind])
    assert got == {1: "done", None: "done", 2**60 + 1: "done", 3: "failed", 6: "done", 9: "timeout"} and late == [7, 8]


@pytest.mark.parametrize("kind, one, other", [("long", 2**60, 2**60 + 1), ("double", 0.5, float("nan")), ("date", ZERO.date(), None)])
def test_wait_outcomes_by_keys_of_any_type(spark, kind, one, other):
    base = scratch(spark, "events")
    rows = [(one, 1, at(0), "request"), (other, 2, at(0), "request"), (one, 3, at(10), "done"), (other, 4, at(20), "failed"), (one, 5, at(9**8), "close")]
    schema = f"key {kind}, id long, at timestamp, kind string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/in")
    e.drain_apart(e.wait_outcomes(g.read_stream(spark, f"{base}/in", schema), "key"), f"{base}/out", f"{base}/late", f"{base}/state")
    out = spark.read.parquet(f"{base}/out")
    assert {x["id"]: x["outcome"] for x in out.collect()} == {1: "done", 2: "failed"}
    assert out.filter("id = 1").first()["key"] == one and out.schema["key"].dataType.simpleString() == spark.createDataFrame([], schema).schema["key"].dataType.simpleString()


def test_single_flight_equals_the_batch_form(spark):
    events = [(k, i, t, "request" if kind == "request" else "end") for k, i, t, kind in history(11)]
    frame = spark.createDataFrame([(k, i, at(t), kind) for k, i, t, kind in events], KIND)
    want = {x["id"]: x["role"] for x in runs.single_flight(frame, ["key"], "at").collect()}
    got, _, _ = streamed(spark, events, lambda s: e.single_flight(s, "key", "6 hours"), [events[200:], events[:200]])
    assert got == want
    assert frame.filter(F.col("kind") == "request").count() == len(want)
