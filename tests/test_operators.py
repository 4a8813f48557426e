"""Operators against brute force on small data: time lookups, walks, merges, checks."""

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagecat import session
from pagecat.operators import graph, joins, merge, quality, ranking, running as run, variants
from pagecat.plans import publish as pub, runs
from pagecat.sources.tables import Conflict, Snapshots, config_value, scan_pages
from pagecat.session import scratch

T0 = datetime(2024, 1, 1)


def at(us):
    return T0 + timedelta(microseconds=us)


def times(seed, n, span_s, step_us=250_000):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["a", "a", "a", "b", "c"]), at(rnd.randrange(0, span_s * 1_000_000, step_us))) for i in range(n)]


@pytest.fixture(params=["cold", "hot"])
def heat(request, monkeypatch):
    """Run once with every key walked whole and once with all rows sorted into range partitions."""
    if request.param == "hot":
        monkeypatch.setattr(run, "HOT_ROWS", 30)


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within_s", [None, 200])
def test_lookup_matches_brute_force(spark, heat, forward, strict, within_s):
    points, facts = times(1, 150, 9000), times(2, 120, 9000)
    p = spark.createDataFrame(points, "pid int, k string, t timestamp")
    f = spark.createDataFrame(facts, "id int, k string, ft timestamp")
    fact = run.Fact("hit", f, "ft", ("id",), None if within_s is None else within_s * 1_000_000, strict, forward, tie=("id",))
    got = {r["pid"]: r["hit"]["id"] if r["hit"] else None for r in run.with_history(p, ["k"], "t", [fact]).collect()}
    for pid, k, t in points:
        side = (lambda x: x >= t) if forward else (lambda x: x <= t)
        fits = [(ft, i) for i, fk, ft in facts if fk == k and side(ft) and not (strict and ft == t)
                and (within_s is None or abs(ft - t) <= timedelta(seconds=within_s))]
        best = None
        if fits:
            nearest = (min if forward else max)(ft for ft, _ in fits)
            best = max(i for ft, i in fits if ft == nearest)
        assert got[pid] == best


def test_lookup_without_keys_and_tallies(spark, heat):
    p = spark.createDataFrame(times(3, 60, 20000), "pid int, k string, t timestamp")
    f = spark.createDataFrame(times(4, 60, 20000), "id int, k string, ft timestamp")
    out = run.with_history(p, [], "t", [run.Fact("hit", f, "ft", ("id",))], [run.Tally("n", f, "ft", 1)]).collect()
    facts = [ft for _, _, ft in times(4, 60, 20000)]
    assert len(out) == 60
    assert all((r["n"] or 0) == sum(ft <= r["t"] for ft in facts) for r in out)
    assert all((r["hit"] is None) == (not any(ft <= r["t"] for ft in facts)) for r in out)


def test_running_before_the_epoch(spark, monkeypatch):
    monkeypatch.setattr(run, "HOT_ROWS", 1)
    df = spark.createDataFrame([(1, -5), (1, -3_700_000_000), (1, 7), (2, 0)], "k int, t long")
    out = run.running(df, ["k"], "t", total={"n": F.lit(1)}, last={"l": F.col("t")}, inclusive=False)
    assert sorted((r["k"], r["t"], r["n"], r["l"]) for r in out.collect()) == [
        (1, -3_700_000_000, 0, None), (1, -5, 1, -3_700_000_000), (1, 7, 2, -5), (2, 0, 0, None)]


def test_both_ways_agree_on_hot_keys_ties_and_missing_times(spark, rows, monkeypatch):
    """Two fifths of the rows are of one key and one instant, some have no time."""
    df = spark.range(600).select(
        "id", F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 5 < 2, 100).when(F.col("id") % 11 != 0, F.col("id") * 37 % 91).cast("long").alias("t"),
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"),
    ).repartition(5)
    for inclusive in (True, False):
        def out():
            return run.running(df, ["k"], "t", tie=("id",), last={"l": F.col("v")}, total={"n": F.lit(1)}, inclusive=inclusive)

        whole = rows(out(), "id", "l", "n")
        monkeypatch.setattr(run, "HOT_ROWS", 10)
        assert rows(out(), "id", "l", "n") == whole and len(whole) == 600
        monkeypatch.undo()


def test_status_moves_keep_rows_without_a_time(spark, rows, monkeypatch):
    log = spark.range(21).select(
        "id", F.lit("u").alias("url"), F.lit("pending").alias("status"), F.when(F.col("id") != 4, F.timestamp_micros(F.col("id"))).alias("t"))
    want = rows(quality.status_transitions(log, "url", "t"), "id", "prev_status", "legal")
    monkeypatch.setattr(run, "HOT_ROWS", 3)
    assert rows(quality.status_transitions(log, "url", "t"), "id", "prev_status", "legal") == want and len(want) == 21


@pytest.mark.parametrize("minutes,span", [(1, 4000), (60, 20000)])
def test_cooldown_gate_is_the_greedy_choice(spark, heat, minutes, span):
    rows = times(minutes, 250, span, 1_000_000)
    df = spark.createDataFrame(rows, "id int, k string, requested_at timestamp")
    got = {r["id"]: r["decision"] for r in runs.cooldown_gate(df, ["k"], minutes).collect()}
    last, want = {}, {}
    for i, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        free = k not in last or t - last[k] > timedelta(minutes=minutes)
        want[i] = "started" if free else "too_recent"
        if free:
            last[k] = t
    assert got == want


def test_exact_cooldown_still_blocks(spark, rows):
    df = spark.createDataFrame([(1, "a", at(0)), (2, "a", at(900_000_000)), (3, "a", at(900_000_001))], "id int, k string, requested_at timestamp")
    assert rows(runs.cooldown_gate(df, ["k"]), "id", "decision") == [(1, "started"), (2, "too_recent"), (3, "started")]
    log = spark.createDataFrame([(7, "completed", at(0)), (8, "failed", at(1))], "id int, status string, refresh_time timestamp")
    assert rows(runs.cooldown_join(df, log), "id", "last_run_id") == [(1, 7), (2, 7), (3, None)]


def test_walks(spark, rows):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7000, 7000)], "node long, next long")
    starts = spark.createDataFrame([("a", 1), ("b", 38), ("c", 100), ("d", 500)], "start string, node long")
    got = rows(graph.orbit(starts, edges))
    want = [("a", 1 + d, d) for d in range(40)] + [("b", 38 + d, d) for d in range(3)] + [("c", 100 + d, d) for d in range(3)] + [("d", 500, 0)]
    assert got == sorted(want)
    assert max(r[2] for r in rows(graph.orbit(starts, edges, max_depth=5))) == 5
    assert len(rows(graph.orbit(starts, edges, max_depth=0))) == 4


def test_redirects(spark, rows):
    chain = [(i, i + 1) for i in range(1, 50)]
    df = spark.createDataFrame(chain + [(100, 101), (101, 100), (200, 200), (300, 301)], "src long, dst long")
    got = {r[0]: r[1:] for r in rows(graph.resolve_redirects(df))}
    assert got[300] == (301, 1) and got[49] == (50, 1) and got[11] == (50, 39) and got[1] == (50, 49)
    assert got[100] == (None, None) and got[200] == (None, None)


def test_config_is_one_row(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "key string, url string")
    assert config_value(df, "a").first()[0] == "x"
    for key in ("b", "none"):
        with pytest.raises(Exception, match="rows for"):
            config_value(df, key).collect()


def test_sections(spark):
    df = spark.createDataFrame([("Old 2001", 0), ("New 2020", 1), ("None", 2), ("More 2020", 3)], "name string, pos int")
    assert [r["name"] for r in ranking.sort_sections(df).collect()] == ["New 2020", "More 2020", "Old 2001", "None"]
    assert ranking.pick_section(df, "quick", None, "2001").first()["name"] == "Old 2001"
    assert ranking.pick_section(df, "quick", None, "1999").first()["name"] == "New 2020"
    assert ranking.pick_section(df, "custom", None, "2001").first()["name"] == "Old 2001"
    assert ranking.pick_section(df, "custom", "2020", "2001").first()["name"] == "New 2020"
    with pytest.raises(Exception, match="no section for 1990"):
        ranking.pick_section(df, "custom", "1990", "2001").collect()


def test_next_work_puts_unknown_priority_last(spark):
    df = spark.createDataFrame([(1, "b", "pending", None), (2, "a", "pending", 2), (3, "c", "pending", 1), (4, "d", "done", 0)], "id int, url string, status string, priority int")
    assert [r["id"] for r in ranking.next_work(df, 3).collect()] == [3, 2, 1]


def test_largest_variant(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, 5.0, "a"), (1, 1, 9.0, "b"), (1, 2, 9.0, "c"), (1, 3, float("nan"), "d"), (1, 4, 99.0, None), (1, 5, 99.0, ""),
         (2, 0, 0.0, "z"), (3, 0, float("nan"), "n")], "k int, pos int, size_mb double, url string")
    assert rows(variants.largest_variant(df, "k"), "k", "url") == [(1, "b"), (2, "z")]


def test_last_write_keeps_null_and_skips_what_is_not_given(spark, rows):
    df = spark.createDataFrame([("k", 1, "a", "x"), ("k", 2, None, "y"), ("k", 3, "c", None)], "k string, n int, a string, b string")
    out = ranking.last_write_per_key(df, ["k"], ["n"], {"a": F.col("n") < 3})
    assert rows(out) == [("k", None, None)]


def test_upsert_with_given_columns(spark, rows):
    old = spark.createDataFrame([("a", "1h", "x"), ("b", "2h", "y")], "slug string, duration string, name string")
    new = spark.createDataFrame([("a", None, "x2"), ("c", "3h", "z"), ("b", "9h", None)], "slug string, duration string, name string")
    out = merge.upsert(old, new, "slug", ["duration", "name"], given={"duration": F.col("duration").isNotNull()})
    assert rows(out) == [("a", "1h", "x2"), ("b", "9h", None), ("c", "3h", "z")]


def test_null_rules(spark, rows):
    df = spark.createDataFrame([(1, "processing"), (2, "done"), (3, None)], "id int, status string")
    assert rows(runs.reset_for_run(df), "id") == [(1,), (3,)]
    checks = {"known": quality.one_of("status", ["done"]), "set": quality.not_null("status")}
    assert rows(quality.check_constraints(df, "id", checks)) == [(1, "known"), (3, "set")]
    assert rows(quality.unique_violations(spark.createDataFrame([(None,), (None,), (1,), (1,)], "k int"), ["k"])) == [(1, 2)]


def test_finalize(spark, rows):
    log = spark.createDataFrame([("1", "inprogress", at(0)), ("2", "inprogress", at(5)), ("3", "done", at(9))], "id string, status string, refresh_time timestamp")
    assert rows(runs.finalize_run(log, published=False), "id", "status") == [("1", "inprogress"), ("2", "failed"), ("3", "done")]
    idle = log.filter("status = 'done'")
    assert rows(runs.finalize_run(idle), "id", "status") == [("3", "done")]


CATALOG = "id string, slug string, item_url string, name string, year int, genres array<string>, created_at timestamp, updated_at timestamp"
STAGE = "slug string, item_url string, name string, year int, genres array<string>"
VARIANT = "id string, item_id string, label string, file_size string, file_url_1 string"
VSTAGE = "item_url string, label string, file_size string, file_url_1 string"


def tables(spark):
    catalog = spark.createDataFrame([("A", "/a", "u/a", "a", 2000, ["x"], T0, T0), ("B", "/b", "u/b", "b", 2001, None, T0, T0)], CATALOG)
    variant = spark.createDataFrame([("1", "A", "HD", "1", "f1"), ("2", "B", "HD", "2", "f2")], VARIANT)
    stage = spark.createDataFrame([("/a", "v/a", "", None, [""]), ("/c", "u/c", "c", 2002, ["z"])], STAGE)
    vstage = spark.createDataFrame([("v/a", "SD", None, "g1"), ("u/c", "HD", "3", "g2"), ("gone", "HD", "4", "g3"), ("u/b", "SD", "5", "g4")], VSTAGE)
    return stage, vstage, catalog, variant


def test_publish(spark, rows):
    stage, vstage, catalog, variant = tables(spark)
    as_of = F.lit(at(60_000_000))
    merged, after = pub.publish(stage, vstage, catalog, variant, as_of)
    by_slug = {r["slug"]: r for r in merged.collect()}
    a = by_slug["/a"]
    # The empty name and the list of one empty text replace, NULL does not; the address always does.
    assert (a["id"], a["item_url"], a["name"], a["year"], a["genres"]) == ("A", "v/a", "", 2000, [""])
    assert a["updated_at"] == at(60_000_000) and a["created_at"] == T0 and by_slug["/b"]["updated_at"] == T0
    new_id = by_slug["/c"]["id"]
    assert rows(after, "item_id", "label", "file_url_1") == sorted(
        [("A", "SD", "g1"), ("B", "HD", "f2"), ("B", "SD", "g4"), (new_id, "HD", "g2")])
    kept, _ = pub.publish(stage, vstage, catalog, variant, as_of, blank_as_null=True)
    a = {r["slug"]: r for r in kept.collect()}["/a"]
    assert (a["name"], a["genres"]) == ("a", ["x"])


def test_publish_twice_changes_nothing_more(spark, rows):
    stage, vstage, catalog, variant = tables(spark)
    as_of = F.lit(at(60_000_000))
    once = pub.publish(stage, vstage, catalog, variant, as_of, on_dup="last")
    twice = pub.publish(stage, vstage, *once, as_of, on_dup="last")
    for first, second in zip(once, twice):
        cols = [c for c in first.columns if c not in ("updated_at", "genres")]
        assert rows(first, *cols) == rows(second, *cols)


def test_repeated_keys_stop_a_publish(spark):
    stage, vstage, catalog, variant = tables(spark)
    twice = vstage.unionByName(vstage.filter("label = 'SD'"))
    with pytest.raises(ValueError, match="variant"):
        pub.publish(stage, twice, catalog, variant, F.lit(T0))
    clash = stage.unionByName(spark.createDataFrame([("/new", "u/b", "n", 1, None)], STAGE))
    with pytest.raises(ValueError, match="catalogue address"):
        pub.publish(clash, vstage, catalog, variant, F.lit(T0))
    merged, after = pub.publish(clash, twice, catalog, variant, F.lit(T0), on_dup="last")
    assert quality.unique_violations(merged, ["item_url"]).count() == 0
    assert quality.unique_violations(after, ["item_id", "label"]).count() == 0


def test_last_one_of_a_repeated_slug_or_address_stays(spark, rows):
    _, vstage, catalog, variant = tables(spark)
    none = vstage.limit(0)
    stage = spark.createDataFrame([("/a", "v/1", "one", 1, None), ("/a", "v/2", "two", 2, None)], STAGE)
    merged, _ = pub.publish(stage, none, catalog, variant, F.lit(T0), on_dup="last")
    assert rows(merged, "id", "slug", "item_url") == [("A", "/a", "v/2"), ("B", "/b", "u/b")]
    # A staged record takes the address of a stored one: that one goes, and its variants with it.
    taken = spark.createDataFrame([("/new", "u/b", "n", 1, None)], STAGE)
    merged, after = pub.publish(taken, none, catalog, variant, F.lit(at(60_000_000)), on_dup="last")
    assert "B" not in [r[0] for r in rows(merged, "id")] and rows(after, "id") == [("1",)]
    assert joins.orphans(after, merged, "item_id", "id").count() == 0


def test_a_run_is_closed_by_what_became_of_its_publish(spark, rows):
    stage, vstage, catalog, variant = tables(spark)
    log = spark.createDataFrame([("1", "inprogress", at(0))], "id string, status string, refresh_time timestamp")
    (merged, _), closed = pub.publish_and_close(stage, vstage, catalog, variant, log, F.lit(T0))
    assert merged.count() == 3 and rows(closed, "status") == [("completed",)]
    (same, _), closed = pub.publish_and_close(stage.unionByName(stage), vstage, catalog, variant, log, F.lit(T0))
    assert same.count() == 2 and rows(closed, "status") == [("failed",)]


def test_clearing_leaves_other_tables_and_a_second_publisher_is_refused(spark, rows):
    one = spark.createDataFrame([(1,)], "a int")
    store = Snapshots(spark, scratch(spark, "store"))
    store.publish({"catalog": one, "variant": one, "config": one})
    store.clear(["catalog"], {"catalog": ["variant"]})
    assert [store.read(t).count() for t in ("catalog", "variant", "config")] == [0, 0, 1] and store.current() == 2
    late = Snapshots(spark, store.path)
    late.current = lambda: 1  # began before the clear
    with pytest.raises(Conflict, match="is there"):
        late.publish({"catalog": one})
    assert store.read("catalog").count() == 0
    with pytest.raises(KeyError):
        store.read("none")


def test_all_variants_are_collected(spark):
    df = spark.createDataFrame([(1, 2, "HD", "b"), (1, 1, "HD", "a"), (1, 3, "SD", None)], "k int, pos int, label string, url string")
    payload = variants.collect_variants(df, "k", ["url"]).first()["payload"]
    assert [tuple(p) for p in payload] == [("HD", "a"), ("HD", "b"), ("SD", None)]


def test_snapshot_publish_is_one_version(spark, rows):
    stage, vstage, catalog, variant = tables(spark)
    store = Snapshots(spark, scratch(spark, "store"))
    assert store.current() == 0
    store.publish({"catalog": catalog, "variant": variant, "catalog_stage": stage, "variant_stage": vstage, "config": catalog.limit(1)})
    with pytest.raises(ValueError):
        pub.publish_snapshot(store, stage.unionByName(stage), vstage, F.lit(T0))
    assert store.current() == 1 and store.read("catalog").count() == 2
    pub.publish_snapshot(store, store.read("catalog_stage"), store.read("variant_stage"), F.lit(T0))
    assert store.current() == 2 and store.read("catalog").count() == 3
    assert store.read("catalog_stage").count() == 0 and store.read("variant_stage").count() == 0
    assert store.read("config").count() == 1


def _bucketed(spark, n=64):
    """A store with 300 records and their variants in buckets, and a way to stage one record with one variant."""
    _, vstage, catalog, variant = tables(spark)
    ids = spark.range(300)
    one, many = catalog.limit(1).drop("id", "slug", "item_url"), F.concat(F.lit("/r"), F.col("id").cast("string"))
    records = one.crossJoin(ids.withColumns({"slug": many, "item_url": F.concat(F.lit("http://h"), many)})).withColumn("id", F.col("id").cast("string"))
    kept = variant.limit(1).drop("id", "item_id").crossJoin(ids.select(F.col("id").cast("string").alias("item_id"), many.alias("id")))
    store = Snapshots(spark, scratch(spark, "buckets"))
    store.publish({"catalog": records.select(*catalog.columns), "variant": kept.select(*variant.columns)},
                  bucketed={"catalog": ("slug", n), "variant": ("item_id", n)})

    def staged(slug, label):
        url = f"http://h{slug}"
        stage = spark.createDataFrame([(slug, url, "renamed")], "slug string, item_url string, name string")
        new = vstage.limit(1).withColumns({"item_url": F.lit(url), "label": F.lit(label)})
        return stage, new.select(*vstage.columns)

    return store, staged


def _changed(store, old, new):
    before = {(r["tbl"], r["bucket"]): r["at"] for r in store.lists(old)}
    return [(r["tbl"], r["bucket"]) for r in store.lists(new) if r["bucket"] is not None and before.get((r["tbl"], r["bucket"])) != r["at"]]


def test_a_publish_writes_the_touched_buckets_only(spark):
    store, staged = _bucketed(spark)
    before = {r["slug"]: r.asDict() for r in store.read("catalog").collect()}
    pub.publish_touched(store, *staged("/r7", "NEW"), F.lit(T0))
    assert sorted(t for t, _ in _changed(store, 1, 2)) == ["catalog", "variant"]
    after = {r["slug"]: r.asDict() for r in store.read("catalog").collect()}
    assert after.keys() == before.keys() and [k for k in after if after[k] != before[k]] == ["/r7"]
    assert {r["label"] for r in store.read("variant").filter("item_id = '7'").collect()} == {"NEW"}
    assert store.read("variant").count() == 300
    # Ten records touch ten buckets at most, a new one its own.
    pub.publish_touched(store, *[a.unionByName(b) for a, b in zip(staged("/r8", "A"), staged("/new", "B"), strict=True)], F.lit(T0))
    assert len(_changed(store, 2, 3)) <= 4 and store.read("catalog").count() == 301


def test_of_two_publishers_both_stagings_are_kept(spark):
    store, staged = _bucketed(spark, 8)
    other = Snapshots(spark, store.path)
    first, publish = [], store.publish

    def beaten(*args, **kwargs):
        if not first:
            first.append(pub.publish_touched(other, *staged("/r1", "A"), F.lit(T0)))
        return publish(*args, **kwargs)

    store.publish = beaten
    assert pub.publish_touched(store, *staged("/r1", "B"), F.lit(T0)) == 3 and first == [2]
    assert {r["label"] for r in store.read("variant").filter("item_id = '1'").collect()} == {"B"}
    del store.publish
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda k: pub.publish_touched(Snapshots(spark, store.path), *staged(f"/t{k}", "T"), F.lit(T0)), range(3)))
    assert sorted(done) == [4, 5, 6] and store.read("catalog").filter("slug LIKE '/t%'").count() == 3
    assert store.read("variant").filter("label = 'T'").count() == 3


def test_refresh_overwrites_with_null_unless_guarded(spark, rows):
    variant = spark.createDataFrame([("1", "A", "HD", "1", "f1"), ("2", "A", "SD", "2", "f2")], VARIANT)
    fresh = spark.createDataFrame([("A", "HD", 1, "n", "x"), ("A", "HD", 2, None, None), ("A", "4K", 3, "q", None)],
                                  "item_id string, label string, pos int, file_size string, file_url_1 string")
    assert rows(pub.overwrite_variants(variant, fresh), "id", "file_size", "file_url_1") == [("1", None, None), ("2", "2", "f2")]
    empty = fresh.filter("pos > 1").withColumn("view_url_1", F.lit(""))
    out = pub.overwrite_variants(variant.withColumn("view_url_1", F.lit(None).cast("string")), empty, guard=True)
    assert rows(out, "id", "file_url_1") == [("1", "f1"), ("2", "f2")]


def test_captures_and_children(spark, rows):
    pages = spark.createDataFrame(
        [("u", "old", at(1)), ("u", "new", at(2)), ("v", "only", at(0)), (None, "a", at(1)), (None, "a", at(2))], "url string, html string, c timestamp")
    for limit in (0, 1 << 20):
        assert sorted(rows(scan_pages(pages, "c", limit)), key=str) == sorted([("u", "new"), ("v", "only"), (None, "a"), (None, "a")], key=str)
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    assert rows(joins.orphans(child, parent, "fk", "pk"), "id") == [(2,)]
    assert rows(joins.cascade_delete(child, parent, "fk", "pk"), "id") == [(2,), (3,)]


def test_status_moves(spark, rows):
    log = spark.createDataFrame([(1, "u", "pending", at(0)), (2, "u", "done", at(5)), (3, "u", "pending", at(5_000_000_000)), (4, "u", None, at(5_000_000_001))],
                                "id int, url string, status string, t timestamp")
    assert rows(quality.status_transitions(log, "url", "t"), "id", "prev_status", "legal") == [
        (1, None, True), (2, "pending", False), (3, "done", True), (4, "pending", False)]


def test_scratch_paths_are_deleted_on_demand(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    path = scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and session.clean(spark) == 1 and session.clean(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
