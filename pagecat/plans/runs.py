"""Run log, request log and work queue: admission, caching, waiting, closing a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import payload_kind, payload_present
from ..operators.graph import orbit
from ..operators.merge import delete_where, update_where, upsert
from ..operators.quality import unique_violations
from ..operators.running import Fact, Tally, lookup, micros, running, with_history
from ..session import cut

MINUTE_US = 60_000_000


def _last_completed(runs: DataFrame, minutes: int, run_at: str = "refresh_time") -> Fact:
    done = runs.filter(F.col("status") == "completed")
    return Fact("__run", done, run_at, (run_at, "id"), minutes * MINUTE_US, tie=("id",))


def _results(log: DataFrame, payload: str) -> DataFrame:
    """The log with NULL for payloads that are no result. A VARIANT, which cannot be ordered, becomes its text."""
    kind = payload_kind(log, payload)
    value = F.to_json(payload) if kind == "variant" else F.col(payload)
    return log.withColumn(payload, F.when(payload_present(payload, kind), value))


def _last_done(log: DataFrame, minutes: int, payload: str) -> Fact:
    done = _results(log, payload).filter(F.col("status") == "done")
    return Fact("__done", done, "completed_at", ("completed_at", payload), minutes * MINUTE_US, tie=("id",))


def _next_end(log: DataFrame, payload: str, wait_s: int | None = None) -> Fact:
    ended = _results(log, payload).filter(F.col("completed_at").isNotNull())
    return Fact("__end", ended, "completed_at", ("completed_at", "status", payload),
                None if wait_s is None else wait_s * 1_000_000, strict=True, forward=True, tie=("id",))


def _waited(payload: str) -> Column:
    return (
        F.when((F.col("__end.status") == "done") & F.col(f"__end.{payload}").isNotNull(), "done")
        .when(F.col("__end.status") == "failed", "failed")
        .otherwise("timeout")
    )


def cooldown_join(requests: DataFrame, runs: DataFrame, minutes: int = 15, by=(), at: str = "requested_at",
                  run_at: str = "refresh_time") -> DataFrame:
    """Each request with the latest completed run that started at most ``minutes`` before it, or NULL."""
    found = with_history(requests, by, at, [_last_completed(runs, minutes, run_at)])
    return found.select(
        *requests.columns, F.col(f"__run.{run_at}").alias("last_run"), F.col("__run.id").alias("last_run_id")
    )


def cached_result_join(requests: DataFrame, log: DataFrame, by, minutes: int = 5, at: str = "requested_at",
                       payload: str = "payload") -> DataFrame:
    """Each request with the payload of the newest finished one in time. A payload that is no result (``payload_present``) is no hit."""
    found = with_history(requests, by, at, [_last_done(log, minutes, payload)])
    hit = F.col(f"__done.{payload}").isNotNull()
    value = F.col(f"__done.{payload}")
    return found.select(
        *requests.columns,
        F.coalesce(hit, F.lit(False)).alias("cached"),
        F.when(hit, F.col("__done.completed_at")).alias("cached_at"),
        F.when(hit, F.parse_json(value) if payload_kind(log, payload) == "variant" else value).alias("cached_payload"),
    )


def wait_outcome_join(waiters: DataFrame, log: DataFrame, by, wait_s: int = 60, at: str = "requested_at",
                      payload: str = "payload") -> DataFrame:
    """What a waiter sees: the first end after it asked, within the wait; else a timeout."""
    found = with_history(waiters, by, at, [_next_end(log, payload, wait_s)])
    return found.select(*waiters.columns, _waited(payload).alias("outcome"))


def admit_runs(requests: DataFrame, runs: DataFrame, minutes: int = 15, by=(), at: str = "requested_at",
               run_at: str = "refresh_time", end: str = "finished_at") -> DataFrame:
    """(request columns, decision, last_run): already_running, too_recent or started.

    A run is active from its start to its end; the count so far and the last completed start come from one pass.
    """
    found = with_history(
        requests, by, at, [_last_completed(runs, minutes, run_at)],
        [Tally("__begun", runs, run_at, 1), Tally("__ended", runs.filter(F.col(end).isNotNull()), end, 1)],
    )
    decision = (
        F.when(F.col("__begun") > F.col("__ended"), "already_running")
        .when(F.col("__run").isNotNull(), "too_recent")
        .otherwise("started")
    )
    return found.select(*requests.columns, decision.alias("decision"), F.col(f"__run.{run_at}").alias("last_run"))


def classify_requests(requests: DataFrame, log: DataFrame, catalog: DataFrame, key: str = "item_id",
                      minutes: int = 5, wait_s: int = 60, at: str = "requested_at",
                      payload: str = "payload") -> DataFrame:
    """(request columns, role, outcome) for every refresh request.

    role: not_found, cached, waiter or owner. A waiter comes while a request of the same record is being
    processed. The owner's outcome is that of its own processing: the next end after it.
    """
    known = catalog.select(F.col("id").alias(key)).distinct().withColumn("__known", F.lit(True))
    found = with_history(requests, [key], at, [
        _last_done(log, minutes, payload),
        Fact("__open", log, "requested_at", ("requested_at", "completed_at"), strict=True, tie=("id",)),
        _next_end(log, payload),
    ])
    rows = found.join(known, key, "left")
    asked = micros(at)
    cached = F.col(f"__done.{payload}").isNotNull()
    going = F.col("__open").isNotNull() & (
        F.col("__open.completed_at").isNull() | (micros(F.col("__open.completed_at")) > asked)
    )
    in_time = micros(F.col("__end.completed_at")) <= asked + F.lit(wait_s * 1_000_000)
    return rows.withColumn(
        "role",
        F.when(F.col("__known").isNull(), "not_found")
        .when(cached, "cached").when(going, "waiter").otherwise("owner"),
    ).select(
        *requests.columns, "role",
        F.when(F.col("role") == "not_found", "rejected")
        .when(F.col("role") == "cached", "done")
        .when(F.col("role") == "waiter", F.when(in_time, _waited(payload)).otherwise("timeout"))
        .otherwise(F.coalesce("__end.status", F.lit("processing")))
        .alias("outcome"),
    )


def outcome_counts(outcomes: DataFrame, by) -> DataFrame:
    """Processed, skipped and failed items per run."""
    return outcomes.groupBy(*by).agg(
        F.count_if(F.col("status") == "done").alias("processed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )


def staged_ok_count(rows: DataFrame, key: str, ok: Column) -> DataFrame:
    """Rows per item that pass the staging checks."""
    return rows.groupBy(key).agg(F.count_if(F.coalesce(ok, F.lit(True))).alias("staged"))


def section_count_delta(counts: DataFrame, state: DataFrame) -> DataFrame:
    """(folder, n, last_known, delta); a folder not seen before counts from 0."""
    known = state.select("folder", F.col("last_known_count").alias("last_known"))
    last = F.coalesce("last_known", F.lit(0))
    return counts.join(known, "folder", "left").select(
        "folder", "n", last.alias("last_known"), (F.col("n") - last).alias("delta")
    )


def save_section_counts(state: DataFrame, counts: DataFrame, as_of) -> DataFrame:
    src = counts.select(
        "folder", F.col("n").cast("int").alias("last_known_count"), F.lit(as_of).cast("timestamp").alias("last_scraped_at")
    )
    return upsert(state, src, "folder", ["last_scraped_at", "last_known_count"])


def reset_for_run(queue: DataFrame) -> DataFrame:
    """What a new run finds: items in processing and items without a status stay."""
    return delete_where(queue, F.col("status") != "processing")


def finalize_run(log: DataFrame, published: bool = True, at: str = "refresh_time") -> DataFrame:
    """Close the newest run in progress; without one nothing changes."""
    order = F.struct(F.col(at).isNull(), F.col(at), F.col("id"))
    newest = (
        log.filter(F.col("status") == "inprogress")
        .agg(F.max_by("id", order).alias("id"))
        .select("id", F.lit("completed" if published else "failed").alias("status"))
    )
    return update_where(log, F.broadcast(newest), "id", ["status"])


def active_conflicts(log: DataFrame) -> DataFrame:
    """More than one run in progress: what the unique index would have refused."""
    return unique_violations(log, ["status"], F.col("status") == "inprogress")


def not_expired(log: DataFrame, as_of: Column, minutes: int = 5, at: str = "requested_at") -> DataFrame:
    """Requests whose life of ``minutes`` has not ended."""
    return log.withColumn("expires_at", F.col(at) + F.expr(f"INTERVAL {int(minutes)} MINUTES")).filter(
        F.col("expires_at") > as_of
    )


def cooldown_gate(requests: DataFrame, by, minutes: int = 15, at: str = "requested_at",
                  id_col: str = "id") -> DataFrame:
    """Admit a request iff more than ``minutes`` passed since the last admitted one of its key.

    Who is admitted depends on who was before, yet no key is walked in order: after a silence longer than
    the cooldown the next instant is always admitted, and inside a dense stretch every instant points to
    the first one beyond its own cooldown; doubling jumps along these pointers find the admitted ones.
    """
    gap = minutes * MINUTE_US
    by = list(by)
    instants = cut(
        requests.withColumn("__t", micros(at)).dropna(subset=[*by, "__t"])
        .groupBy(*by, "__t").agg(F.min(id_col).alias("__first"))
    )
    before = running(instants, by, "__t", last={"__prev": F.col("__t")}, inclusive=False)
    fresh = F.col("__prev").isNull() | (F.col("__t") - F.col("__prev") > gap)
    points = cut(
        before.select(*by, "__first", F.timestamp_micros("__t").alias("at"), fresh.alias("fresh"))
    )
    # Beyond twice the cooldown there was a silence, and what follows is fresh anyway.
    nxt = Fact("nxt", points, "at", ("at", "fresh"), gap, strict=True, forward=True, shift_us=gap)
    onward = lookup(points, by, "at", [nxt]).filter("nxt IS NOT NULL AND NOT nxt.fresh")
    edges = cut(onward.select(
        F.struct(*by, F.timestamp_micros("__t").alias("at")).alias("node"),
        F.struct(*by, F.col("nxt.at").alias("at")).alias("next"),
    ))
    roots = points.filter("fresh").select(F.struct(*by, "at").alias("node"))
    # A root without a pointer is a walk of one step: it needs no round.
    moving = roots.join(edges, "node", "left_semi").select(F.lit(0).alias("start"), "node")
    inner = orbit(moving, edges, circles=False).filter("depth > 0").select("node.*")
    admitted = points.filter("fresh").select(*by, "at").unionByName(inner.select(*by, "at"))
    chosen = admitted.join(points, [*by, "at"]).select(
        *by, F.unix_micros("at").alias("__t"), F.col("__first").alias(id_col), F.lit("started").alias("__ok")
    )
    return requests.withColumn("__t", micros(at)).join(chosen, [*by, "__t", id_col], "left").select(
        *requests.columns, F.coalesce("__ok", F.lit("too_recent")).alias("decision")
    )


def run_gate(requests: DataFrame, ends: DataFrame, by, minutes: int = 15, at: str = "requested_at", end_at: str = "finished_at",
             status: str = "status", id_col: str = "id") -> DataFrame:
    """Decide every request: already_running, too_recent or started, where runs are what the gate itself has started.

    A started run goes on until the next end of its key; only a completed one holds others back, until ``minutes`` after its
    start; a failed one frees the gate. At one instant ends come first, completed ones before failed, and the lowest id asks first.

    No key is walked in order: from the end that follows an instant one can tell which request is started next if this one is.
    Doubling jumps along these pointers, from requests that are started whatever happened before, find all that are.
    """
    gap, by = minutes * MINUTE_US, list(by)
    asked = cut(requests.withColumn("__t", micros(at)).dropna(subset=[*by, "__t"]).groupBy(*by, "__t").agg(F.min(id_col).alias("__first")))
    instants = asked.select(*by, "__first", F.timestamp_micros("__t").alias("at"))
    over = cut(ends.withColumn("__t", micros(end_at)).dropna(subset=[*by, "__t"]).groupBy(*by, "__t").agg(
        F.bool_or(F.col(status) == "completed").alias("good")).select(*by, F.timestamp_micros("__t").alias("at"), "good"))
    found = cut(lookup(instants, by, "at", [
        Fact("end", over, "at", ("at", "good"), strict=True, forward=True),
        Fact("before", instants, "at", ("at",), strict=True), Fact("closed", over, "at", ("at",)),
    ]))
    # Nothing is going after an end that followed all earlier requests, and none of these is near enough to hold this one back.
    alone = F.col("before").isNull()
    fresh = alone | ((F.col("closed.at") > F.col("before.at")) & (F.col("__t") - micros(F.col("before.at")) > gap))
    ended = micros(F.col("end.at"))
    free = F.when(F.col("end.good"), F.greatest(ended, F.col("__t") + gap + 1)).otherwise(ended)
    points = cut(found.select(*by, F.timestamp_micros("__t").alias("at"), fresh.alias("fresh"), F.timestamp_micros(free).alias("free"), F.col("end.at").alias("over")))
    waiting = points.filter("free IS NOT NULL")
    onward = lookup(waiting, by, "free", [Fact("nxt", points, "at", ("at", "fresh"), forward=True)]).filter("nxt IS NOT NULL AND NOT nxt.fresh")
    edges = cut(waiting.withColumn("__t", micros("free")).join(onward, [*by, "__t"]).select(
        F.struct(*by, "at").alias("node"), F.struct(*by, F.col("nxt.at").alias("at")).alias("next")))
    roots = points.filter("fresh").select(F.struct(*by, "at").alias("node"))
    moving = roots.join(edges, "node", "left_semi").select(F.lit(0).alias("start"), "node")
    inner = orbit(moving, edges, circles=False).filter("depth > 0").select("node.*")
    started = cut(points.filter("fresh").select(*by, "at").unionByName(inner.select(*by, "at")).distinct().join(
        points.select(*by, "at", "over"), [*by, "at"]).join(instants, [*by, "at"]))
    known = with_history(requests, by, at, [Fact("__run", started, "at", ("at", "over", "__first"))])
    own = (micros(at) == micros(F.col("__run.at"))) & (F.col(id_col) == F.col("__run.__first"))
    going = F.col("__run.over").isNull() | (micros(F.col("__run.over")) > micros(at))
    return known.select(*requests.columns, F.when(F.coalesce(own, F.lit(False)), "started").when(going, "already_running").otherwise("too_recent").alias("decision"))


def single_flight(events: DataFrame, by, at: str = "ts", kind: str = "kind", id_col: str = "id") -> DataFrame:
    """Requests as owner or waiter: one is the owner iff none is open since the last end of its key.

    ``kind`` is request or end; a request is open from its owner's arrival to the next end. At one instant ends
    come first and the lowest id asks first, so an instant is one row: what it found open decides.
    """
    asks = F.col(kind) == "request"
    instants = cut(events.withColumn("__t", micros(at)).dropna(subset=[*by, "__t"]).groupBy(*by, "__t").agg(
        F.min(F.when(asks, F.col(id_col))).alias("__first"),
        F.bool_or(~asks).alias("__end"),
        F.bool_or(asks).alias("__open"),
    ))
    before = running(instants, by, "__t", inclusive=False, last={"__was": F.col("__open")})
    owners = before.filter(F.col("__open") & (F.col("__end") | ~F.coalesce("__was", F.lit(False)))).select(
        *by, "__t", F.col("__first").alias(id_col), F.lit("owner").alias("__role")
    )
    rows = events.filter(asks).withColumn("__t", micros(at)).join(owners, [*by, "__t", id_col], "left")
    return rows.select(*events.columns, F.coalesce("__role", F.lit("waiter")).alias("role"))
