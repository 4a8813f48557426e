"""Run log, request log, work queue and their streams."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pagecat.operators import quality as qual
from pagecat.plans import refresh as ref, runs as r
from pagecat.session import scratch
from pagecat.streaming import batches as b, claims as c, eventtime as e, gates as g
from pagecat.streaming.metrics import StreamTally, Tally

from .base import query

RR = ("run_request", "run_log")
RL = ("run_request", "refresh_log")


def us(col):
    return F.unix_micros(F.col(col).cast("timestamp"))


def ts(df, *cols):
    """The given tables hold local times; the jobs read them as instants."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in cols})


def requests(tb):
    return ts(tb["run_request"], "requested_at")


def run_log(tb):
    return ts(tb["run_log"], "refresh_time", "finished_at")


def refresh_log(tb):
    return ts(tb["refresh_log"], "requested_at", "completed_at")


@query("j5_cooldown_join", RR, """
    select q.id, case when q.requested_at <= r.refresh_time + interval '15' minute then r.id end as last_run_id,
           case when q.requested_at <= r.refresh_time + interval '15' minute then epoch_us(r.refresh_time) end as last_run
    from run_request q asof left join (select * from run_log where status = 'completed') r
      on q.requested_at >= r.refresh_time""")
def _(tb):
    return r.cooldown_join(requests(tb), run_log(tb)).select("id", "last_run_id", us("last_run").alias("last_run"))


@query("j5_cooldown_join_per_source", RR, """
    select q.id, case when q.requested_at <= r.refresh_time + interval '1' day then r.id end as last_run_id
    from run_request q asof left join (select * from run_log where status = 'completed') r
      on q.user_id = r.user_id and q.requested_at >= r.refresh_time""")
def _(tb):
    return r.cooldown_join(requests(tb), run_log(tb), 1440, ["user_id"]).select("id", "last_run_id")


@query("j6_cached_result_join", RL, """
    select q.id, coalesce(q.requested_at <= r.completed_at + interval '5' minute and r.payload is not null, false) as cached,
           case when q.requested_at <= r.completed_at + interval '5' minute then r.payload end as payload
    from run_request q asof left join (select * from refresh_log where status = 'done') r
      on q.item_id = r.item_id and q.requested_at >= r.completed_at""")
def _(tb):
    out = r.cached_result_join(requests(tb), refresh_log(tb), ["item_id"])
    return out.select("id", "cached", F.col("cached_payload").alias("payload"))


@query("j6_cached_json_values", RL, """
    with log as (select * replace (case when id % 5 = 0 then 'null' when id % 7 = 0 then '{broken' else payload end as payload) from refresh_log where status = 'done'),
    found as (select q.id, r.payload, r.completed_at >= q.requested_at - interval '5' minute and r.payload <> 'null' and r.payload <> '{broken' as hit
              from run_request q asof left join log r on q.item_id = r.item_id and q.requested_at >= r.completed_at)
    select id, coalesce(hit, false) as cached, case when hit then payload end as payload from found""")
def _(tb):
    """A finished request whose payload is a JSON null, or no JSON, is no hit; payloads stored as VARIANT."""
    text = F.when(F.col("id") % 5 == 0, "null").when(F.col("id") % 7 == 0, "{broken").otherwise(F.col("payload"))
    log = refresh_log(tb).withColumn("payload", F.try_parse_json(text))
    out = r.cached_result_join(requests(tb), log, ["item_id"])
    return out.select("id", "cached", F.to_json("cached_payload").alias("payload"))


WAIT = """
    select q.id, case when r.completed_at > q.requested_at + interval '60' second or r.id is null then 'timeout'
                      when r.status = 'done' and r.payload is not null then 'done'
                      when r.status = 'failed' then 'failed' else 'timeout' end as outcome
    from run_request q asof left join (select * from refresh_log where completed_at is not null) r
      on q.item_id = r.item_id and q.requested_at < r.completed_at"""


@query("j8_wait_outcome_join", RL, WAIT)
def _(tb):
    return r.wait_outcome_join(requests(tb), refresh_log(tb), ["item_id"]).select("id", "outcome")


@query("m6_reset_for_run", ("work_queue",), "select id, url, status from work_queue where status = 'processing' or status is null")
def _(tb):
    return r.reset_for_run(tb["work_queue"]).select("id", "url", "status")


@query("m7_finalize_run", ("run_log",), """
    select id, case when id = (select id from run_log where status = 'inprogress' order by refresh_time desc limit 1)
               then 'completed' else status end as status from run_log""")
def _(tb):
    return r.finalize_run(run_log(tb)).select("id", "status")


ROLES = """
    with c as (select q.id, coalesce(q.requested_at <= r.completed_at + interval '5' minute and r.payload is not null, false) as cached
               from run_request q asof left join (select * from refresh_log where status = 'done') r
                 on q.item_id = r.item_id and q.requested_at >= r.completed_at),
    o as (select q.id, r.id is not null and (r.completed_at is null or r.completed_at > q.requested_at) as going
          from run_request q asof left join refresh_log r
            on q.item_id = r.item_id and q.requested_at > r.requested_at),
    w as (select q.id, r.id is not null and r.completed_at <= q.requested_at + interval '60' second as soon,
                 r.status, r.payload
          from run_request q asof left join (select * from refresh_log where completed_at is not null) r
            on q.item_id = r.item_id and q.requested_at < r.completed_at),
    roles as (select q.id, case when q.item_id = 9 then 'not_found' when cached then 'cached' when going then 'waiter'
                           else 'owner' end as role, soon, w.status, w.payload
              from run_request q join c using (id) join o using (id) join w using (id))"""


@query("m9_classify_requests", RL, ROLES + """
    select id, role, case role when 'not_found' then 'rejected' when 'cached' then 'done'
       when 'owner' then coalesce(status, 'processing')
       else case when not soon then 'timeout' when status = 'done' and payload is not null then 'done'
                 when status = 'failed' then 'failed' else 'timeout' end end as outcome
    from roles""")
def _(tb):
    items = requests(tb).select(F.col("item_id").alias("id")).distinct().filter("id <> 9")
    return r.classify_requests(requests(tb), refresh_log(tb), items).select("id", "role", "outcome")


@query("m9_open_requests", RL, ROLES + """
    select id, item_id, status, epoch_us(requested_at) as asked, null as expires from refresh_log
    union all
    select q.id, q.item_id, 'processing', epoch_us(requested_at), epoch_us(requested_at + interval '5' minute)
    from run_request q join roles using (id) where role = 'owner'""")
def _(tb):
    items = requests(tb).select(F.col("item_id").alias("id")).distinct().filter("id <> 9")
    log = refresh_log(tb).withColumn("expires_at", F.lit(None).cast("timestamp"))
    opened = ref.open_requests(log, r.classify_requests(requests(tb), log, items))
    return opened.select("id", "item_id", "status", us("requested_at").alias("asked"), us("expires_at").alias("expires"))


@query("m10_admit_runs", RR, """
    with e as (select refresh_time as t, 1 as d from run_log
               union all select finished_at, -1 from run_log where finished_at is not null),
    s as (select t, sum(sum(d)) over (order by t) as active from e where t is not null group by t)
    select q.id, case when coalesce(s.active, 0) > 0 then 'already_running'
                      when q.requested_at <= r.refresh_time + interval '15' minute then 'too_recent'
                      else 'started' end as decision
    from run_request q asof left join s on q.requested_at >= s.t
    asof left join (select * from run_log where status = 'completed') r on q.requested_at >= r.refresh_time""")
def _(tb):
    return r.admit_runs(requests(tb), run_log(tb)).select("id", "decision")


@query("m10_admit_runs_finished", RR, """
    with log as (select * from run_log where status <> 'inprogress'),
    e as (select refresh_time as t, 1 as d from log union all select finished_at, -1 from log),
    s as (select t, sum(sum(d)) over (order by t) as active from e group by t)
    select q.id, case when coalesce(s.active, 0) > 0 then 'already_running'
                      when q.requested_at <= r.refresh_time + interval '15' minute then 'too_recent'
                      else 'started' end as decision
    from run_request q asof left join s on q.requested_at >= s.t
    asof left join (select * from log where status = 'completed') r on q.requested_at >= r.refresh_time""")
def _(tb):
    log = run_log(tb).filter("status <> 'inprogress'")
    return r.admit_runs(requests(tb), log).select("id", "decision")


@query("a10_active_conflicts", ("run_log",), """
    select status, count(*) as n from run_log where status = 'inprogress' group by 1 having count(*) > 1""")
def _(tb):
    return r.active_conflicts(tb["run_log"])


GATE = """
    with recursive chain as (
      select {key} as k, min(requested_at) as t from run_request {group}
      union all
      select c.k, (select min(q.requested_at) from run_request q
                   where {same} q.requested_at > c.t + interval '{gap}' minute)
      from chain c where c.t is not null)
    select id, case when c.t is not null then 'started' else 'too_recent' end as decision
    from run_request q left join (select * from chain where t is not null) c
      on {join} q.requested_at = c.t"""
GATE_ALL = GATE.format(key="0", group="", same="", gap=15, join="")
GATE_BY = GATE.format(key="user_id", group="group by 1", same="q.user_id = c.k and", gap=1440, join="q.user_id = c.k and")


@query("t2_cooldown_gate", ("run_request",), GATE_BY)
def _(tb):
    return r.cooldown_gate(requests(tb), ["user_id"], 1440).select("id", "decision")


@query("t2_cooldown_gate_one_source", ("run_request",), GATE_ALL)
def _(tb):
    rows = requests(tb).withColumn("source", F.lit(0))
    return r.cooldown_gate(rows, ["source"], 15).select("id", "decision")


ROWS_PER_FILE = 1_000_000


def stretches(tb, rows, number, parts, label, closing=None):
    """Write rows as files of several stretches, ``number`` telling which, and read them as a stream: each stretch a micro-batch of its own.

    A stretch has as many files as its rows need, so no task writes or reads more than one of them.
    """
    path = scratch(tb.spark, label)
    files = 1 + rows.count() // (parts * ROWS_PER_FILE)
    for k in range(parts):
        rows.filter(number == k).repartition(files).write.mode("append").parquet(path)
    if closing is not None:
        closing.write.mode("append").parquet(path)
    return g.read_stream(tb.spark, path, rows.schema, maxFilesPerTrigger=str(files))


def event_stream(tb, parts=4):
    """The events as a stream, one micro-batch for each stretch of time."""
    events = tb["events"]
    low, high = events.agg(F.min(us("ts")), F.max(us("ts"))).first()
    step = (high - low) // parts + 1
    return ts(stretches(tb, events, F.floor((us("ts") - low) / step), parts, "events"), "ts")


def drained(tb, df, label):
    base = scratch(tb.spark, label)
    g.drain(df, f"{base}/out", f"{base}/state")
    return tb.spark.read.parquet(f"{base}/out")


@query("t2_cooldown_gate_stream", ("run_request",), GATE_BY)
def _(tb):
    clicks = event_stream(tb).filter("event_type = 'click'")
    gate = g.cooldown_gate(clicks, "user_id", 1440, "ts", "event_id")
    return drained(tb, gate, "cooldown").select("id", "decision")


def in_batches(tb, df, step, label):
    base = scratch(tb.spark, label)
    b.run_batches(df, step, f"{base}/out", f"{base}/state", f"{base}/offsets")
    return tb.spark.read.parquet(f"{base}/out")


@query("t2_cooldown_gate_batches", ("run_request",), GATE_BY)
def _(tb):
    clicks = event_stream(tb).filter("event_type = 'click'")
    out = in_batches(tb, clicks, b.cooldown_gate("user_id", 1440, "ts", "event_id"), "cooldown")
    return out.select(F.col("event_id").alias("id"), "decision")


FLIGHT = """
    select event_id as id, case when coalesce(prev, 'end') = 'end' then 'owner' else 'waiter' end as role from (
      select event_id, kind, lag(kind) over (partition by user_id order by ts, kind, event_id) as prev from (
        select *, case when event_type = 'click' then 'request' else 'end' end as kind from events
        where event_type in ('click', 'purchase')))
    where kind = 'request'"""


def flight_events(events):
    kind = F.when(F.col("event_type") == "click", "request").otherwise("end")
    return events.filter("event_type IN ('click', 'purchase')").withColumn("kind", kind)


@query("t3_single_flight", oracle=FLIGHT)
def _(tb):
    rows = flight_events(ts(tb["events"], "ts")).withColumnRenamed("event_id", "id")
    return r.single_flight(rows, ["user_id"]).select("id", "role")


@query("t3_single_flight_stream", oracle=FLIGHT)
def _(tb):
    out = g.single_flight(flight_events(event_stream(tb)), "user_id", id_col="event_id")
    return drained(tb, out, "flight").select("id", "role")


@query("t3_single_flight_batches", oracle=FLIGHT)
def _(tb):
    out = in_batches(tb, flight_events(event_stream(tb)), b.single_flight("user_id", id_col="event_id"), "flight")
    return out.select(F.col("event_id").alias("id"), "role")


@query("t4_ttl_filter", ("refresh_log",), """
    select id from refresh_log where requested_at + interval '5' minute > timestamp '2024-01-15 00:00:00'""")
def _(tb):
    return r.not_expired(refresh_log(tb), F.expr("timestamp'2024-01-15 00:00:00'")).select("id")


TTL = """
    with r as (select event_id as id, epoch_us(ts) as asked, case when event_id % 11 <> 0
                 then epoch_us(ts) + (case when event_id % 2 = 0 then 299 else 300 end) * 1000000 end as ended
               from events where event_type in ('purchase', 'error')),
    clock as (select max(greatest(asked, coalesce(ended, 0))) as newest from r)
    select id, case when ended < asked + 300000000 then 'ended' else 'expired' end as outcome from r, clock
    where ended < asked + 300000000 or asked + 300000000 <= newest"""


@query("t4_ttl_filter_stream", oracle=TTL)
def _(tb):
    """Requests and ends as events of four files: half of the requests end within their five minutes."""
    base = scratch(tb.spark, "ttl")
    late = F.when(F.col("event_id") % 2 == 0, 299_000_000).otherwise(300_000_000)
    rows = ts(tb["events"], "ts").filter("event_type IN ('purchase', 'error')").select("event_id", us("ts").alias("t"))
    asks = rows.select(F.col("event_id").alias("id"), "t", F.lit("request").alias("kind"))
    ends = rows.filter("event_id % 11 <> 0").select(F.col("event_id").alias("id"), (F.col("t") + late).alias("t"), F.lit("end").alias("kind"))
    marks = asks.unionByName(ends).withColumn("at", F.timestamp_micros("t")).drop("t")
    low, high = marks.agg(F.min(us("at")), F.max(us("at"))).first()
    step = (high - low) // 4 + 1
    stream = stretches(tb, marks, F.floor((us("at") - low) / step), 4, "marks")
    return in_batches(tb, stream, b.ttl(), "ttl").select("id", "outcome")


ORDER_OUTCOME = "case o_orderstatus when 'F' then 'done' when 'O' then 'error' else 'skipped' end"
CLAIMED = f"""
    select o_orderkey as id, case when o_orderkey % 9 = 0 then 'done' else {ORDER_OUTCOME} end as status,
           case when o_orderkey % 9 > 0 and o_orderstatus = 'O' then 'no answer: ' || o_orderkey end as error_msg from orders"""


class Killed(RuntimeError):
    """What a worker ends with in the restart query."""


def claimed_orders(tb, label, killed_after=None, tally=None):
    """The orders as a queue of four files, worked off by claims; with ``killed_after`` the worker dies once that many commits are whole."""
    orders = tb["orders"]
    none = F.lit(None).cast("string")
    status = F.when(F.col("o_orderkey") % 9 == 0, "done").otherwise("pending")
    queue = orders.select(F.col("o_orderkey").cast("bigint").alias("id"), status.alias("status"), none.alias("error_msg"), none.cast("timestamp").alias("processed_at"))
    stream = stretches(tb, queue, F.col("id") % 4, 4, label)
    base = scratch(tb.spark, label)
    log = c.WorkLog(tb.spark, base)
    now = F.expr("timestamp'2024-01-01 00:00:00'")
    asked = orders.select(F.col("o_orderkey").cast("bigint").alias("id"), "o_orderstatus")

    def work(items):
        if not died and len(log.batches("outcomes")) == killed_after:
            died.append(True)
            raise Killed("the worker was killed")
        failed = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("no answer: "), "id"))
        return items.select("id").join(asked, "id").select("id", F.expr(ORDER_OUTCOME).alias("status"), failed.alias("error_msg"), now.alias("processed_at"))

    died = []
    if killed_after is not None:
        try:
            c.drain_claims(stream, log, work, f"{base}/state", now, tally)
        except StreamingQueryException:
            pass
        if not died:
            raise AssertionError("the worker did not die")
    c.drain_claims(stream, log, work, f"{base}/state", now, tally)
    return queue, log


@query("t1_claims", oracle=CLAIMED)
def _(tb):
    queue, log = claimed_orders(tb, "claims")
    return log.queue(queue).select("id", "status", "error_msg")


@query("t1_claims_restart", oracle=CLAIMED.replace(" from orders", ", 1 as commits from orders where o_orderkey % 9 > 0")
       + " union all " + CLAIMED.replace(" from orders", ", 0 as commits from orders where o_orderkey % 9 = 0"))
def _(tb):
    """The worker dies between a claim and its outcomes and is started again: each item has one outcome."""
    queue, log = claimed_orders(tb, "restart", killed_after=2)
    commits = log.read("outcomes").groupBy("id").agg(F.count("*").alias("commits"))
    return log.queue(queue).join(commits, "id", "left").select("id", "status", "error_msg", F.coalesce("commits", F.lit(0)).alias("commits"))


@query("a4_in_flight", oracle=f"""
    select count(*) filter (status = 'done') as processed, count(*) filter (status = 'skipped') as skipped,
           count(*) filter (status = 'error') as errors from (select {ORDER_OUTCOME} as status from orders where o_orderkey % 9 > 0)""")
def _(tb):
    """Counted while a worker that dies once writes its outcomes."""
    tally = Tally()
    claimed_orders(tb, "tally", killed_after=1, tally=tally)
    return tb.spark.createDataFrame([tally.counts()], "processed bigint, skipped bigint, errors bigint")


@query("a4_in_flight_stream", ("work_queue",), """
    select count(*) filter (status = 'done') as processed, count(*) filter (status = 'skipped') as skipped,
           count(*) filter (status = 'error') as errors from work_queue""")
def _(tb):
    """Counted by a listener while the stream goes."""
    tally = StreamTally()
    part = tb["work_queue"].select("id", "status")
    tb.spark.streams.addListener(tally)
    try:
        drained(tb, tally.watch(stretches(tb, part, F.col("id") % 4, 4, "counted")), "counted")
        if not tally.ended():
            raise TimeoutError("the stream's last counts did not arrive")
    finally:
        tb.spark.streams.removeListener(tally)
    return tb.spark.createDataFrame([tally.counts()], "processed bigint, skipped bigint, errors bigint")


AUDIT = """
    select key, t, active from (
      select key, t, max(d) as best, sum(sum(d)) over (partition by key order by t) as active from (
        select user_id as key, epoch_us(refresh_time) as t, 1 as d from run_log
        union all select user_id, epoch_us(finished_at), -1 from run_log where finished_at is not null)
      group by key, t)
    where best = 1 and active > 1"""


@query("t5_active_run_audit", ("run_log",), AUDIT)
def _(tb):
    out = qual.active_run_audit(run_log(tb), ["user_id"], "refresh_time", "finished_at")
    return out.select(F.col("user_id").alias("key"), us("at").alias("t"), "active")


@query("t5_active_run_audit_stream", ("run_log",), AUDIT)
def _(tb):
    runs = event_stream(tb).filter("event_type IN ('purchase', 'error', 'view')")
    length = F.when(F.col("event_type") == "purchase", F.expr("INTERVAL 4 MINUTES")).when(
        F.col("event_type") == "error", F.expr("INTERVAL 1 MINUTE")
    )
    marks = F.explode(F.array(
        F.struct(F.lit(1).alias("delta"), F.col("ts").alias("at")),
        F.struct(F.lit(-1).alias("delta"), (F.col("ts") + length).alias("at")),
    ))
    rows = runs.select("user_id", marks.alias("m")).select("user_id", "m.*").filter("at IS NOT NULL")
    return drained(tb, g.active_runs(rows, "user_id", "at", "delta"), "audit").select("key", "t", "active")


@query("t6_status_transitions", ("work_queue",), """
    select id, status, prev as prev_status,
           case when rn = 1 then true else coalesce(
             concat(prev, '>', status) in ('pending>processing', 'pending>skipped', 'processing>done',
               'processing>error', 'processing>skipped', 'processing>pending', 'done>pending', 'error>pending',
               'skipped>pending'), false) end as legal
    from (select *, lag(status) over w as prev, row_number() over w as rn from work_queue
          window w as (partition by url order by queued_at, id))""")
def _(tb):
    return qual.status_transitions(tb["work_queue"], "url", "queued_at").select("id", "status", "prev_status", "legal")


@query("t6_stuck", ("work_queue",), """
    select id from work_queue where status = 'processing' and queued_at < timestamp '2024-01-29 23:45:00'""")
def _(tb):
    as_of = F.expr("timestamp'2024-01-30 00:00:00'")
    return qual.stuck(ts(tb["work_queue"], "queued_at"), as_of, 15, "queued_at").select("id")


# Runs that the gate itself starts: a click asks, a purchase ends a run well, an error ends it badly.
OWN_RUNS = """
    with recursive ends as (
      select user_id as k, ts as te, bool_or(event_type = 'purchase') as good from events where event_type in ('purchase', 'error') group by all),
    asks as (select user_id as k, ts as t, min(event_id) as first from events where event_type = 'click' group by all),
    n as (select a.k, a.t, a.first, e.te, greatest(e.te, case when e.good then a.t + interval '1 day 1 microsecond' end) as free
          from asks a asof left join ends e on a.k = e.k and a.t < e.te),
    p as (select n.*, a.t as after from n asof left join asks a on n.k = a.k and n.free <= a.t),
    chain as (select k, t, first, te, after from p where (k, t) in (select k, min(t) from asks group by k)
              union all select p.k, p.t, p.first, p.te, p.after from chain c join p on p.k = c.k and p.t = c.after)
    select event_id as id, case when event_id = c.first and c.t = q.ts then 'started'
           when c.te is null or c.te > q.ts then 'already_running' else 'too_recent' end as decision
    from (select * from events where event_type = 'click') q asof left join chain c on q.user_id = c.k and q.ts >= c.t"""


@query("t2_run_gate", oracle=OWN_RUNS)
def _(tb):
    """Every request against the runs that were started before it: a failed run frees the gate, a completed one holds it for a day."""
    events = ts(tb["events"], "ts")
    asks = events.filter("event_type = 'click'").select(F.col("event_id").alias("id"), "user_id", F.col("ts").alias("requested_at"))
    status = F.when(F.col("event_type") == "purchase", "completed").otherwise("failed")
    ends = events.filter("event_type IN ('purchase', 'error')").select("user_id", F.col("ts").alias("finished_at"), status.alias("status"))
    return r.run_gate(asks, ends, ["user_id"], 1440).select("id", "decision")


def unordered(tb, rows, label, late=None, parts=4, minutes=30):
    """Rows (…, id, at, kind) as a stream in which some come up to half an hour, ``late`` ones a whole stretch after their time."""
    low, high = rows.agg(F.min(us("at")), F.max(us("at"))).first()
    step = (high - low + minutes * 60_000_000) // parts + 1
    behind = F.pmod(F.xxhash64("id"), F.lit(minutes * 60_000_000))
    number = F.floor((us("at") - low + behind) / step)
    if late is not None:
        number = F.when(late, F.least(F.floor((us("at") - low) / step) + 1, F.lit(parts - 1))).otherwise(F.floor((us("at") - low) / step))
    closing = rows.limit(1).withColumns({"at": F.timestamp_micros(F.lit(high + 10 * 86_400_000_000)), "kind": F.lit("close")})
    return stretches(tb, rows, number, parts, label, closing)


def answers(tb, df, label):
    base = scratch(tb.spark, label)
    e.drain_apart(df, f"{base}/out", f"{base}/late", f"{base}/state")
    return tb.spark.read.parquet(f"{base}/out"), tb.spark.read.parquet(f"{base}/late")


def run_events(tb):
    kind = F.create_map(*[F.lit(x) for x in ("click", "request", "purchase", "completed", "error", "failed")])[F.col("event_type")]
    events = ts(tb["events"], "ts").filter("event_type IN ('click', 'purchase', 'error')")
    return events.select("user_id", F.col("event_id").alias("id"), F.col("ts").alias("at"), kind.alias("kind"))


@query("t2_run_gate_stream", oracle=OWN_RUNS)
def _(tb):
    """The same from a stream of requests and ends that come in any order within an hour."""
    stream = unordered(tb, run_events(tb), "runs")
    return answers(tb, e.run_gate(stream, "user_id", 1440, "1 hour"), "gate")[0].select("id", "decision")


@query("t2_late_rows", oracle="""
    with e as (select event_id as id, user_id, epoch_us(ts) as t from events where event_type in ('click', 'purchase', 'error')),
    s as (select min(t) as low, (max(t) - min(t) + 1800000000) // 4 + 1 as step from e),
    b as (select id, user_id, t, least((t - low) // step + case when id % 7 = 0 then 1 else 0 end, 3) as k from e, s),
    w as (select k, max(max(t)) over (order by k rows between unbounded preceding and 1 preceding) as newest from b group by k)
    select id, user_id as key, t from b join w using (k) where t < (newest // 1000 - 3600000) * 1000""")
def _(tb):
    """Rows that come after the watermark has passed them stand in a table of their own: here every seventh comes a stretch late."""
    stream = unordered(tb, run_events(tb), "behind", F.col("id") % 7 == 0)
    return answers(tb, e.run_gate(stream, "user_id", 1440, "1 hour"), "late")[1].select("id", "key", "t")


@query("t3_single_flight_in_time", oracle=FLIGHT)
def _(tb):
    """Owners and waiters from a stream that is out of order by up to half an hour."""
    rows = flight_events(ts(tb["events"], "ts")).select("user_id", F.col("event_id").alias("id"), F.col("ts").alias("at"), "kind")
    return answers(tb, e.single_flight(unordered(tb, rows, "flights"), "user_id", "1 hour"), "flight")[0].select("id", "role")


@query("t3_wait_outcomes_stream", RL, WAIT)
def _(tb):
    """What each waiter hears within 60 seconds, from a stream of requests and ends: done, failed or timeout."""
    asks = requests(tb).select("item_id", "id", F.col("requested_at").alias("at"), F.lit("request").alias("kind"))
    kind = F.when(F.col("status") == "failed", "failed").when(F.col("payload").isNotNull(), "done").otherwise("empty")
    ends = refresh_log(tb).filter("completed_at IS NOT NULL").select("item_id", "id", F.col("completed_at").alias("at"), kind.alias("kind"))
    stream = unordered(tb, asks.unionByName(ends), "waits")
    return answers(tb, e.wait_outcomes(stream, "item_id", 60, "1 hour"), "outcomes")[0].select("id", "outcome")
