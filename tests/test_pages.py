"""Golden pages and whole jobs on a small captured site, and streams against their batch twins."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagecat.functions.text import page_title
from pagecat.operators import quality
from pagecat.operators.predicates import Noise
from pagecat.plans import discover as d, extract as e, runs
from pagecat.session import scratch
from pagecat.sources import html as h
from pagecat.streaming import batches as b, gates as g

AS_OF = datetime(2024, 2, 1)
ROOT = "http://s.example"


def pages(spark, found):
    return spark.createDataFrame([(ROOT + k, v) for k, v in found.items()], "url string, html string")


def entry(href, text, icon="folder.svg"):
    link = f'<a href="{href}">{text}</a>' if href is not None else f"<a>{text}</a>"
    return f'<div class="entry"><img src="/i/{icon}">{link}<a href="/second">second</a></div>'


DETAIL = """<!doctype html><title>Fallback | Site</title><h1>A &amp; B (1999) Full Download now</h1>
<picture><source srcset="/p/x.webp 2x, /p/y.webp"><img src="/p/x.jpg"></picture>
<ul class="info"><li><strong>Director:</strong> <span>One</span><li><strong>Co-Director:</strong><span> Two </span>
<li><strong>Starring:</strong> <span>A, B|C & D,,</span></li><li><strong>Movie Rating:</strong> <span>7.1/10</span></li></ul>
<!-- <ul class="info"><li><strong>Genres:</strong><span>hidden</span></li></ul> -->
<script>var s = '<ul class="info"><li><strong>Language:</strong><span>no</span></li></ul>';</script>
<div class="synopsis"><span>synopsis:</span> Text here. </div>"""


def test_detail_page(spark):
    parsed = h.parse_pages(pages(spark, {"/a/": DETAIL, "/b": "<h1> </h1><title>Only | x</title>", "/c": ""}))
    got = {r["slug"]: r for r in e.extract_catalog(parsed, " Full Download", r"\s+Film.*\z", "Synopsis:").collect()}
    a = got["/a/"]
    assert (a["name"], a["year"], a["poster_ref"], a["rating"]) == ("A & B", 1999, "/p/x.webp", "7.1")
    assert a["director"] == ["Two"] and a["cast_members"] == ["A", "B", "C", "D", "", ""]
    assert a["genres"] is None and a["language"] is None and a["synopsis"] == "Text here."
    assert got["/b"]["name"] == "Only" and got["/b"]["director"] is None and got["/b"]["synopsis"] is None
    assert got["/c"]["name"] == ""
    assert [r[0] for r in parsed.orderBy("page_url").select(page_title("h1", "title")).collect()][1] == "Only"


def test_blocks_nest_and_close_as_in_a_browser(spark):
    page = '<div class="entry x"><p>one<div class="entry"><a href="in">inner</a></div><a>no href</a></div><a href="q">x<a href="r">y'
    parsed = h.parse_pages(pages(spark, {"/dir/p": page}))
    blocks = [(r["pos"], r["anchor_text"], r["abs_url"]) for r in h.block_links(parsed).orderBy("pos").collect()]
    assert blocks == [(0, "inner", ROOT + "/dir/in"), (1, "inner", ROOT + "/dir/in")]
    anchors = [(r["anchor_text"], r["href"]) for r in h.anchor_links(parsed).orderBy("pos").collect()]
    assert anchors == [("inner", "in"), ("no href", None), ("x", "q"), ("y", "r")]


def test_scan_anchors_skips_dead_markup(spark):
    page = '<!-- <a href="c">c</a> --><script>"<a href=\\"s\\">s</a>"</script><A class="k" HREF="a?x=1&amp;y=2">T <b>&lt;i</b></A>'
    rows = h.scan_anchors(pages(spark, {"/": page})).collect()
    assert [(r["anchor_text"], r["href"]) for r in rows] == [("T <i", "a?x=1&y=2")]


LISTING = {
    "/": entry("/s/1/", "Films 2001") + entry("/s/2/", "Films 2002") + entry("/x/", "Films") + entry("/y/", "2003", "file.svg"),
    "/s/2/": entry("/m/1", "One") + entry("/m/2", "Two Web Series") + entry(None, "Three") + entry("/m/4", "2001 films")
    + '<div class="pager"><a href="#">next</a><a href="p2">Next »</a></div>',
    "/s/2/p2": entry("/m/1", "One again") + entry("/m/5", "Five") + '<div class="pager"><a href="/s/2/p2">next</a></div>',
    "/s/1/": entry("/m/9", "Nine") + '<div class="pager"><a href="/s/1/b">next</a></div>',
    "/s/1/b": entry("/m/1", "One") + '<div class="pager"><a href="/s/1/">next</a></div>',
}


NOISE = (Noise("films$"), Noise("web series", "any"))
LABELS = e.Labels({b: f"Server {b}" for b in (1, 2)}, {b: f"File Server {b}" for b in (1, 2)}, {b: f"View Server {b}" for b in (1, 2)})


def test_discovery(spark, rows):
    parsed = h.parse_pages(pages(spark, LISTING))
    empty = spark.createDataFrame([("1", ROOT + "/m/1", "old", "error", 2, "boom", None)],
                                  "id string, url string, folder string, status string, priority int, error_msg string, queued_at timestamp")

    def queued(**how):
        out = d.discover(parsed, ROOT + "/", empty, AS_OF, current_year="1990", noise=NOISE, **how)
        return rows(out.select(F.substring_index("url", "/", -1).alias("u"), "folder", "status", "priority", "error_msg"))

    old = ("1", "Films 2002", "pending", 1, "boom")
    # No section names the current year: the newest one, first page only.
    assert queued() == [old]
    assert queued(mode="custom", year="2002") == [old, ("5", "Films 2002", "pending", 1, None)]
    # The section listed last is queued last, so it names the folder of a shared item.
    both = queued(mode="all")
    assert both == [old, ("5", "Films 2002", "pending", 1, None), ("9", "Films 2001", "pending", 1, None)]


def file_block(href, size):
    return f'<div class="file"><li><a href="{href}">f</a></li><li>Format: x</li><li>File Size: {size}</li></div>'


SITE = {
    "/i/1": entry("/l/1", "list"),
    "/i/2": entry("/l/2", "list"),
    "/i/3": "<p>nothing</p>",
    "/l/1": entry("/q/1", "x (HD)") + entry("/q/2", "x") + entry(None, "(no)") + entry("/q/3", "x (SD)"),
    "/l/2": entry("/q/none", "x (HD)"),
    "/q/1": file_block("/file/a", "1.2.3 MB") + file_block("/file/b", "1 KB") + file_block("/file/c", ". GB") + file_block("/file/d", "1.2 MB"),
    "/q/3": file_block("/file/e", "5 KB"),
    "/file/a": '<li>Duration: </li><div class="details">Duration: 1h\nx</div><li>Duration:</li>'
    '<p class="links"><a href="/s/1">Server 1</a><a href="/s/2">Server 2</a></p>',
    "/file/e": '<li>no time</li><p class="links"><a>Server 1</a><a href="/s/9">Server 2</a></p>',
    "/s/1": '<p class="links"><a href="/d/1">File Server 1</a></p>',
    "/s/2": '<p class="links"><a href="/d/2">File Server 2</a></p>',
    "/d/1": '<p class="links"><a href="get?1">File Server 1</a><a href="w1">View Server 1</a></p>',
    "/d/2": '<p class="links"><a href="get?2">File Server 2</a><a href="lost">View Server 2</a></p>',
    "/d/w1": '<video src="v"><source src=""></video>',
}


def test_extraction(spark):
    parsed = h.parse_pages(pages(spark, SITE)).cache()
    urls = ["/i/1", "/i/2", "/i/3", "/i/4", "/web-series/5"]
    items = spark.createDataFrame([(str(i), ROOT + u) for i, u in enumerate(urls, 1)], "id string, url string")
    found = e.extract_variants(parsed, items, LABELS, "web-series")
    got = {(r["item_url"][-1], r["label"]): r for r in found.collect()}
    assert set(got) == {("1", "HD"), ("1", "SD"), ("2", "HD")}
    hd, sd, none = got["1", "HD"], got["1", "SD"], got["2", "HD"]
    # 1.2 twice: the first wins. The second player page was not captured: its branch is empty.
    assert (hd["file_size"], hd["duration"]) == ("1.20 MB", "1h")
    assert (hd["file_url_1"], hd["view_url_1"], hd["file_url_2"], hd["view_url_2"]) == ("get?1", "v", None, None)
    assert (sd["file_size"], sd["duration"], sd["file_url_1"]) == (None, None, None)
    assert (none["file_size"], none["file_url_1"]) == (None, None)
    out = {r["id"]: (r["status"], r["error_msg"]) for r in e.item_outcome(items, parsed, found, AS_OF, skip="web-series").collect()}
    assert out == {"1": ("done", None), "2": ("error", "No valid links"), "3": ("error", "No quality links"),
                   "4": ("error", "page not captured"), "5": ("skipped", "Web Series excluded")}
    records, staged, outcomes = e.extract_items(parsed, items, AS_OF, LABELS, "web-series")
    assert {r["id"]: (r["status"], r["error_msg"]) for r in outcomes.collect()} == out
    lost = h.parse_pages(pages(spark, {"/i/1": entry("/l/gone", "list")}))
    assert e.item_outcome(items.limit(1), lost, found.limit(0), AS_OF).first()["error_msg"] == "page not captured"
    assert [r["duration"] for r in records.collect()] == ["1h"] and staged.count() == 2
    parsed.unpersist()


def events(spark, n=400):
    rnd = F.rand(7)
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 3).alias("k"), F.timestamp_micros((F.col("id") * 97 + F.floor(rnd * 97)) * 1_000_000).alias("ts"),
        F.when(F.rand(3) < 0.6, "request").otherwise("end").alias("kind"),
    )


def files_in_order(spark, df, parts=4):
    """One file per stretch of time, so that each becomes a micro-batch of its own."""
    path = scratch(spark, "in")
    low, high = df.agg(F.min("id"), F.max("id")).first()
    step = (high - low) // parts + 1
    for p in range(parts):
        df.filter(f"id >= {low + p * step} AND id < {low + (p + 1) * step}").coalesce(1).write.mode("append").parquet(path)
    return g.read_stream(spark, path, df.schema, maxFilesPerTrigger="1")


def drained(spark, df):
    base = scratch(spark, "out")
    g.drain(df, base + "/rows", base + "/state")
    return spark.read.parquet(base + "/rows")


def test_streams_equal_their_batch_twins(spark, rows):
    path = scratch(spark, "events")
    events(spark).write.parquet(path)
    df = spark.read.parquet(path)
    stream = files_in_order(spark, df)
    gate = drained(spark, g.cooldown_gate(stream, "k", 15, "ts", "id"))
    assert rows(gate, "id", "decision") == rows(runs.cooldown_gate(df, ["k"], 15, "ts"), "id", "decision")
    lengths = df.select("k", "ts", F.timestamp_micros(F.unix_micros("ts") + (F.col("id") % 7 + 1) * 90_000_000).alias("end"))
    lengths.write.parquet(path + "-runs")
    runs_ = spark.read.parquet(path + "-runs").withColumn("id", F.unix_micros("ts"))
    marks = F.explode(F.array(F.struct(F.lit(1).alias("d"), F.col("ts").alias("at")), F.struct(F.lit(-1).alias("d"), F.col("end").alias("at"))))
    audit = drained(spark, g.active_runs(files_in_order(spark, runs_).select("k", marks.alias("m")).select("k", "m.*"), "k", "at", "d"))
    want = quality.active_run_audit(runs_, ["k"], "ts", "end").select("k", F.unix_micros("at").alias("t"), "active")
    assert rows(audit, "key", "t", "active") == rows(want) and audit.count() > 50
    flight = drained(spark, g.single_flight(stream, "k"))
    assert rows(flight, "id", "role") == rows(runs.single_flight(df, ["k"]), "id", "role")
    assert gate.count() == df.count()
    for step, cols, want in (
        (b.cooldown_gate("k", 15, "ts"), ("id", "decision"), runs.cooldown_gate(df, ["k"], 15, "ts")),
        (b.single_flight("k"), ("id", "role"), runs.single_flight(df, ["k"])),
    ):
        base = scratch(spark, "batches")
        b.run_batches(stream, step, base + "/out", base + "/state", base + "/offsets")
        assert rows(spark.read.parquet(base + "/out"), *cols) == rows(want, *cols)


def odd_stream(spark, kind):
    """Rows of 50 keys, one of them NULL, with large ids, some NULL, in four files; in the last ones some rows are late."""
    start, minute = 1_700_000_000_000_000, 60_000_000
    at = [start + (k // 3) * minute - (40 * minute if k % 50 == 7 and k > 500 else 0) for k in range(1000)]
    found = [(None if k % 41 == 0 else 2**60 + k, None if k * 7 % 50 == 0 else k * 7 % 50, t, "end" if k % 3 == 0 and k % 2 else "request")
             for k, t in enumerate(at)]
    df = spark.createDataFrame(found, "id long, k long, t long, kind string")
    df = df.select("id", F.col("k").cast(kind).alias("k"), F.timestamp_micros("t").alias("ts"), "kind", F.monotonically_increasing_id().alias("n"))
    path = scratch(spark, "odd")
    for part in range(4):
        spark.createDataFrame(df.collect()[part * 250:(part + 1) * 250], df.schema).drop("n").coalesce(1).write.mode("append").parquet(path)
    texts = [None if r[1] is None else {"double": float}.get(kind, str)(r[1]) if kind in ("string", "double") else r[1] for r in found]
    return g.read_stream(spark, path, df.drop("n").schema, maxFilesPerTrigger="1"), [(r[0], k, r[2], r[3]) for r, k in zip(found, texts)]


def grouped(spark, rows, made):
    """The rows of a stream, and the rows of its state."""
    base = scratch(spark, "grouped")
    query = made.writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return rows(spark.read.parquet(base + "/out")), query.lastProgress["stateOperators"][0]["numRowsTotal"]


def by_hand(found, order, decide):
    """Each micro-batch of 250 rows in order, with a state per key."""
    state, out = {}, []
    for part in range(4):
        for id_, key, t, kind in sorted(found[part * 250:(part + 1) * 250], key=lambda r: (*order(r), r[0] is None, r[0])):
            out += [(key, id_, t, answer) for answer in [decide(state, key, t, kind)] if answer]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_flights_of_many_keys_share_a_state(spark, rows, monkeypatch, kind):
    monkeypatch.setattr(g, "BUCKETS", 4)
    stream, found = odd_stream(spark, kind)

    def decide(state, key, t, kind):
        open_, seen = state.get(key, (False, 0))
        state[key] = (kind == "request", max(seen, t))
        return ("late" if t < seen else "waiter" if open_ else "owner") if kind == "request" else None

    got, kept = grouped(spark, rows, g.single_flight(stream, "k"))
    assert got == by_hand(found, lambda r: (r[2], r[3]), decide)
    assert {r[3] for r in got} == {"owner", "waiter", "late"}
    assert kept <= 5 or kind == "double"


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_cooldowns_of_many_keys_share_a_state(spark, rows, monkeypatch, kind):
    monkeypatch.setattr(g, "BUCKETS", 4)
    stream, found = odd_stream(spark, kind)

    def decide(state, key, t, kind):
        last = state.get(key, 0)
        if t > last + 20 * 60_000_000:
            state[key] = t
            return "started"
        return "late" if t < last else "too_recent"

    got, kept = grouped(spark, rows, g.cooldown_gate(stream, "k", 20, "ts"))
    assert got == by_hand(found, lambda r: (r[2],), decide)
    assert {r[3] for r in got} == {"started", "too_recent", "late"}
    assert kept <= 5 or kind == "double"


def test_late_rows_are_kept_and_marked(spark, rows):
    def at(s):
        return datetime(2024, 1, 1, 0, 0, s)

    first = spark.createDataFrame([(1, 0, at(10)), (2, 0, at(50))], "id long, k long, ts timestamp")
    second = spark.createDataFrame([(3, 0, at(5)), (4, 0, at(52)), (5, 1, at(1))], "id long, k long, ts timestamp")
    state = None
    got = []
    step = b.cooldown_gate("k", 1, "ts")
    for part in (first, second):
        out, state = step(part, state)
        got += rows(out, "id", "decision")
    assert got == [(1, "started"), (2, "too_recent"), (3, "late"), (4, "too_recent"), (5, "started")]
    flight, state, got = b.single_flight("k"), None, []
    for part in (first, second):
        out, state = flight(part.withColumn("kind", F.lit("request")), state)
        got += rows(out, "id", "role")
    assert got == [(1, "owner"), (2, "waiter"), (3, "late"), (4, "waiter"), (5, "owner")]


def test_state_forgets_what_no_row_can_need(spark, rows):
    def at(minute, second=0):
        return datetime(2024, 1, 1, minute // 60, minute % 60, second)

    parts = [[(1, 0, at(0)), (2, 1, at(5))], [(3, 0, at(10)), (4, 2, at(100))], [(5, 0, at(3)), (6, 1, at(101)), (7, 2, at(102))]]
    for keep, late, kept in ((None, "late", {0: 0, 1: 101, 2: 100}), (30, "late", {1: 101, 2: 100})):
        state, got, step = None, [], b.cooldown_gate("k", 15, "ts", keep_minutes=keep)
        for part in parts:
            out, state = step(spark.createDataFrame(part, "id long, k long, ts timestamp"), state)
            got += rows(out, "id", "decision")
            state = spark.createDataFrame(state.collect(), state.schema)
        assert got == [(1, "started"), (2, "started"), (3, "too_recent"), (4, "started"), (5, "too_recent" if keep is None else late),
                       (6, "started"), (7, "too_recent")]
        left = {r["k"]: (r["last"] // 60_000_000) % 1440 for r in state.collect() if r["k"] is not None}
        assert left == kept
    flight, state, got = b.single_flight("k", keep_minutes=30), None, []
    for part in parts:
        kinds = spark.createDataFrame(part, "id long, k long, ts timestamp").withColumn("kind", F.when(F.col("id") == 2, "end").otherwise("request"))
        out, state = flight(kinds, state)
        got += rows(out, "id", "role")
        state = spark.createDataFrame(state.collect(), state.schema)
    assert got == [(1, "owner"), (3, "waiter"), (4, "owner"), (5, "late"), (6, "owner"), (7, "waiter")]
    assert {r["k"] for r in state.collect()} == {None, 0, 1, 2}


def test_worker_takes_each_pending_item_once(spark, rows):
    df = spark.range(40).select("id", F.when(F.col("id") % 4 == 0, "done").otherwise("pending").alias("status"))
    base = scratch(spark, "work")
    g.queue_worker(files_in_order(spark, df), lambda x: x.withColumn("status", F.lit("done")), base + "/out", base + "/state")
    assert rows(spark.read.parquet(base + "/out"), "id") == [(i,) for i in range(40) if i % 4]
    # Nothing new: a second drain adds nothing.
    assert json.dumps(sorted(r["id"] for r in spark.read.parquet(base + "/out").collect())).count(",") == 29


def test_requests_leave_the_state_when_they_end_or_expire(spark, rows):
    def at(s):
        return datetime(2024, 1, 1, 0, s // 60, s % 60)

    kind = "id long, at timestamp, kind string"
    parts = [[(1, at(0), "request"), (2, at(10), "request"), (1, at(60), "end")], [(3, at(200), "request")], [(2, at(309), "end"), (4, at(600), "request")], [(4, at(899), "end")]]
    state, got = None, []
    for part in parts:
        out, state = b.ttl()(spark.createDataFrame(part, kind), state)
        got.append(rows(out))
        state = spark.createDataFrame(state.collect(), state.schema)
    assert got == [[(1, "ended")], [], [(2, "ended"), (3, "expired")], [(4, "ended")]]
    assert state.filter("id IS NOT NULL").count() == 0


def test_staging_keeps_a_known_duration_and_replaces_variants(spark, rows):
    stage = spark.createDataFrame([("/a", "u/a", "old", "9h"), ("/b", "u/b", "b", "8h")], "slug string, item_url string, name string, duration string")
    vstage = spark.createDataFrame([("u/a", "HD", "x"), ("u/b", "HD", "y")], "item_url string, label string, file_url_1 string")
    new = spark.createDataFrame([("/a", "u/a", "new", None), ("/c", "u/c", "c", "1h"), ("/c", "u/c2", "c2", None)], stage.schema)
    found = spark.createDataFrame([("u/a", "SD", "n"), ("u/c", "HD", "lost"), ("u/c2", "HD", "kept")], vstage.schema)
    catalog, after = e.stage_upsert(stage, vstage, new, found)
    assert rows(catalog) == [("/a", "u/a", "new", "9h"), ("/b", "u/b", "b", "8h"), ("/c", "u/c2", "c2", None)]
    assert rows(after) == [("u/a", "SD", "n"), ("u/b", "HD", "y"), ("u/c2", "HD", "kept")]
