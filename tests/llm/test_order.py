"""Mixing, sharding and the running totals below them."""

import heapq
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

from pagecat.llm import mixing, sharding
from pagecat.llm.common import running


def test_running_totals_match_a_plain_loop(spark):
    rows = [(i % 3 if i % 7 else None, i * 37 % 101, i % 5) for i in range(400)]
    got = running(spark.createDataFrame(rows, "g int, k int, s int").repartition(5), ["k", "s"], "s", ["g"]).collect()
    n, s = Counter(), Counter()
    for r in sorted(got, key=lambda r: r["index"]):
        assert (r["index"], r["start"]) == (n[r["g"]], s[r["g"]])
        n[r["g"]] += 1
        s[r["g"]] += r["s"]
    for g in (0, 1, 2, None):
        own = [(r["k"], r["s"]) for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["index"])]
        assert own == sorted((k, x) for h, k, x in rows if h == g)


def _edf(quota, period):
    """Slot by slot, every released block in a queue by deadline."""
    names, done, out = sorted(quota), Counter(), []
    for t in range(period):
        ready = []
        for s in names:
            j = done[s]
            if j < quota[s] and j * period // quota[s] <= t:
                heapq.heappush(ready, (-(-(j + 1) * period // quota[s]), names.index(s), s))
        s = heapq.heappop(ready)[2]
        done[s] += 1
        out.append(s)
    return out


def test_pattern_is_earliest_deadline_first_and_never_a_block_off():
    quota, period = {"a": 50, "b": 31, "c": 18, "d": 1}, 100
    slots = mixing.pattern(quota, period)
    order = {t: s for s, ts in slots.items() for t in ts}
    assert [order[t] for t in range(period)] == _edf(quota, period)
    done = Counter()
    for t in range(period):
        done[order[t]] += 1
        assert all(abs(done[s] - quota[s] / period * (t + 1)) < 1 for s in quota)


def test_mix_is_whole_and_close_to_its_weights(spark):
    sizes = {"big": 700, "mid": 220, None: 90, "one": 1}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, s))
            i += 1
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), block_rows=8, period=100).collect()
    assert sorted(r["position"] for r in got) == list(range(len(rows)))
    assert sorted((r["doc_id"], r["source"] or "") for r in got) == sorted((a, b or "") for a, b in rows)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    by_slot = {r["slot"]: r for r in got}
    assert sorted(by_slot) == list(range(len(by_slot)))
    phases = defaultdict(list)
    for t in sorted(by_slot):
        phases[by_slot[t]["phase"]].append(by_slot[t])
    for blocks in phases.values():
        done, share = Counter(), {b["source"]: b["share"] for b in blocks}
        for k, b in enumerate(blocks):
            done[b["source"]] += 1
            assert all(abs(done[s] - share[s] * (k + 1)) < 1 + 1e-9 for s in share)
    for r in got:
        assert r["position"] == sum(1 for o in got if (o["slot"], o["doc_id"]) < (r["slot"], r["doc_id"])) or r["doc_id"] % 50


def test_mix_takes_weights(spark):
    rows = [(i, "a" if i % 2 else "b") for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"a": 3, "b": 1}, block_rows=1, period=100).collect()
    first = [r for r in got if r["phase"] == 0]
    assert abs(sum(r["source"] == "a" for r in first) / len(first) - 0.75) < 0.01


def test_plan_keeps_to_the_given_weights_over_many_periods():
    weights = {f"s{k}": (k + 1) ** 0.5 for k in range(18)} | {"tiny": 0.002, "large": 30.0}
    plan = mixing.phases({s: 3 if s == "tiny" else 2000 for s in weights}, weights, 100)
    done = Counter()
    for p in plan:
        whole, given, starts = sum(Fraction(weights[s]) for s in p["names"]), Counter(), []
        shares = {s: Fraction(weights[s]) / whole for s in p["names"]}
        for (t, k, *_), _ in zip(mixing.served(p["weights"], [0] * len(shares), 0), range(p["length"])):
            if t % 100 == 0:
                starts.append([given[s] for s in p["names"]])
            given[p["names"][k]] += 1
            assert all(abs(given[s] - float(w) * (t + 1)) < 1 + 1e-9 for s, w in shares.items())
        assert starts == p["starts"] and [done[s] for s in p["names"]] == p["first"]
        done += given
    assert done == {s: 3 if s == "tiny" else 2000 for s in weights}


def test_mix_keeps_to_the_given_weights_over_many_periods(spark):
    weights = {"a": 0.5, "b": 0.3333, "c": 0.1662, "d": 0.0005}
    rows = [(i, s) for i, s in enumerate("a" * 2000 + "b" * 1500 + "c" * 800 + "d" * 40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_rows=1, period=100).collect()
    assert sorted(r["position"] for r in got) == list(range(len(rows)))
    done, whole = defaultdict(Counter), {}
    for r in sorted(got, key=lambda r: r["slot"]):
        assert r["slot"] == r["position"] and r["release"] <= r["slot"] < r["deadline"]
        own = done[r["phase"]]
        own[r["source"]] += 1
        left = whole.setdefault(r["phase"], {o["source"] for o in got if o["slot"] >= r["slot"]})
        total = sum(weights[s] for s in left)
        assert all(abs(own[s] - weights[s] / total * own.total()) < 1 + 1e-9 for s in left)
        assert abs(r["share"] - weights[r["source"]] / total) < 1e-12


def test_mix_of_odd_and_no_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs, block_rows=2).collect()
    assert sorted(r["position"] for r in got) == list(range(11))  # the repeated id counts once
    assert mixing.mix(no_docs).collect() == []


def test_shards_are_balanced_contiguous_and_gapless(spark, prose):
    texts = [prose(k, 5 + k * 13 % 90) for k in range(300)] + ["copy of a text"] * 40
    rows = [(k, t) for k, t in enumerate(texts)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert len(got) == len(rows)
    size = {k: len(t.encode()) + 1 for k, t in rows}
    assert all(r["size"] == size[r["doc_id"]] and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    total, largest = sum(size.values()), max(size.values())
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r["position"]):
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(8))
    for rs in by.values():
        assert [r["slot"] for r in rs] == list(range(len(rs)))
        assert abs(sum(r["size"] for r in rs) - total / 8) <= 2 * largest
    assert [r["shard"] for r in sorted(got, key=lambda r: r["position"])] == sorted(r["shard"] for r in got)


def test_small_groups_of_equal_texts_stay_together(spark, prose):
    rows = [(k, prose(k // 3, 60)) for k in range(240)] + [(1000, prose(999, 700))]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    where = {r["doc_id"]: r["shard"] for r in got}
    assert all(where[k] == where[k - k % 3] for k in range(240))


def test_shards_of_odd_and_no_rows(odd_docs, no_docs):
    got = sharding.shards(odd_docs).collect()
    assert len(got) == 12 and {r["size"] for r in got if r["doc_id"] in (2, 3)} == {1}
    assert sharding.shards(no_docs).collect() == []
