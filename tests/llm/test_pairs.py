"""Near-duplicates, repeated strings and benchmark leaks against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pagecat.llm import decontam, groups, minhash, repeats, words

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _roots(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            for x in (a, b):
                if root[x] != low:
                    root[x], changed = low, True
    return root


def _components(rows):
    sets = {i: _shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, _roots(sets, links)


def _edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = "w" + str(rng.randrange(10**6))
    return " ".join(w)


@pytest.mark.parametrize("block", [2048, 5])
def test_near_duplicates_equal_all_pairs(spark, prose, monkeypatch, block):
    """Families of copies at growing distance, so that groups arise by chains and many pairs lie just below the limit."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "CELL", 400_000 if block > 5 else 1500)
    rng, rows = random.Random(4), []
    for f in range(12):
        base = prose(f, 130)
        for _ in range(14):
            rows.append((rng.randrange(10**9), _edited(rng, base, rng.randrange(9))))
    rows += [(10**9 + 1, rows[0][1].upper()), (10**9 + 2, "a b"), (10**9 + 3, "A  b"), (10**9 + 4, "a b c"), (10**9 + 5, ""), (10**9 + 6, None)]
    sizes, want = _components(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (sizes[i], want[i], want[i] == i) for i, _ in rows}


def test_near_duplicates_of_odd_and_no_rows(odd_docs, no_docs):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(odd_docs).collect()}
    rows = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    sizes, want = _components(rows.items())
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (sizes[i], want[i]) for i in rows}
    assert want[5] == 1 and want[10] == 4 and sizes[2] == sizes[3] == 0
    assert minhash.near_duplicates(no_docs).collect() == []


def _super_minhash(elements, slots):
    """The definition, element by element, with the same draws."""
    out = [None] * slots
    for e in elements:
        order = list(range(slots))
        for j in range(slots):
            drawn = int(words.mix(np.array([e], np.uint64) ^ words.mix(np.full(1, j + 1, np.uint64)))[0])
            turn = j + (int(words.mix(np.array([drawn], np.uint64))[0]) >> 32) % (slots - j)
            order[j], order[turn] = order[turn], order[j]
            offer = (j << 56) | (drawn >> 8)
            if out[order[j]] is None or offer < out[order[j]]:
                out[order[j]] = offer
    return out


def test_signatures_equal_the_definition():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**48, n).astype(np.uint64) for n in (1, 2, 7, 40, 300)] + [np.zeros(0, np.uint64)]
    got = minhash.signatures(sets, 16)
    for s, row in zip(sets[:-1], got, strict=False):
        assert row.tolist() == _super_minhash(s.tolist(), 16)
    assert (got[-1] == np.iinfo(np.uint64).max).all()


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2**48, 400).astype(np.uint64)
        b = np.concatenate([a[:320], rng.integers(0, 2**48, 80).astype(np.uint64)])
        x, y = minhash.signatures([a, b])
        errors.append((x == y).mean() - 320 / 480)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_common_counts_equal_set_intersections():
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(0, 300, rng.integers(1, 120)).astype(np.uint64)) for _ in range(n)] for n in (50, 30))
    got = minhash.common_counts(left, right)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(left) for j, b in enumerate(right))


def test_components_equal_plain_ones(spark):
    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000 + k, 5000) for k in range(80)]
    root = _roots({x for ab in links for x in ab}, links)
    got = {r["node"]: r["root"] for r in groups.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()}
    assert got == {x: r for x, r in root.items() if r != x}


def _kept(rows):
    """Byte by byte: what a 50-byte string of a smaller document covers goes."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b, own, gone = (text or "").encode(), [], bytearray(len((text or "").encode()))
        for s in range(len(b) - 49):
            own.append(b[s:s + 50])
            if own[-1] in seen:
                gone[s:s + 50] = b"\1" * 50
        seen.update(own)
        spans = [(m.start(), m.end()) for m in re.finditer(rb"\x01+", bytes(gone))]
        out[i] = (len(b), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


def _got(df):
    return {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], r["kept"], r["kept_sha256"]) for r in df.collect()}


def _same(got, want):
    assert set(got) == set(want)
    for i, (n, spans, kept) in want.items():
        assert got[i][:2] == (n, spans), i
        assert got[i][3] == hashlib.sha256(kept).hexdigest() and (got[i][2] is None) == (not spans)
        assert not spans or bytes(got[i][2]) == kept


def test_repeats_equal_brute_force(spark, prose, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 5000)  # several buckets
    rng, rows = random.Random(6), []
    parts = [prose(k, 30) for k in range(25)] + ["é" * 40, "x" * 49, "x" * 50, "x" * 51, "ab" * 60, "0" * 300]
    for _ in range(150):
        bits = [rng.choice(parts) if rng.random() < 0.6 else prose(rng.random(), 12) for _ in range(rng.randrange(5))]
        cut = rng.randrange(30)
        rows.append((rng.randrange(10**9), " ".join(bits)[cut:]))
    rows += [(10**9 + 1, rows[3][1]), (10**9 + 2, rows[3][1]), (10**9 + 3, None), (10**9 + 4, "x" * 49)]
    _same(_got(repeats.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))), _kept(rows))


def test_repeats_of_odd_and_no_rows(odd_docs, no_docs):
    rows = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    _same(_got(repeats.cut_repeats(odd_docs)), _kept(rows.items()))
    assert repeats.cut_repeats(no_docs).collect() == []


def test_anchors_of_long_texts_cover_every_window_once(monkeypatch, prose):
    text = prose(1, 4000).encode()
    whole = repeats.Anchors([text, b"short", b"", text[100:900]])
    monkeypatch.setattr(repeats, "PIECE", 1000)
    parts = repeats.Anchors([text, b"short", b"", text[100:900]])
    for a in (whole, parts):
        starts = [(r, s) for r, x, y in zip(a.row, a.first, a.last, strict=True) for s in range(x, y + 1)]
        assert starts == [(0, s) for s in range(len(text) - 49)] + [(3, s) for s in range(800 - 49)]
    place = {s: p for x, y, p in zip(whole.first[whole.row == 0], whole.last[whole.row == 0], whole.place[whole.row == 0], strict=True) for s in range(x, y + 1)}
    for x, y, p in zip(parts.first[parts.row == 0], parts.last[parts.row == 0], parts.place[parts.row == 0], strict=True):
        assert all(place[s] == p for s in range(x, y + 1))


def _entries(rng, n):
    data = [bytes(rng.choice(b"ab") for _ in range(53)) for _ in range(n // 3)]
    data = [rng.choice(data) for _ in range(n)]
    return repeats.Entries(np.frombuffer(b"".join(data), np.uint8), doc=[rng.randrange(40) for _ in range(n)], hash=[rng.randrange(3) for _ in range(n)],
                           away=[3] * n, count=[4] * n, start=list(range(n))), data


def test_merge_sort_orders_windows_within_segments():
    rng = random.Random(3)
    e, data = _entries(rng, 300)
    segment = np.sort(np.array([rng.randrange(5) for _ in range(300)]))
    order = repeats.merge_sort(repeats.Prefixes(e), e.at, segment)
    assert [(segment[i], data[i][:50]) for i in order] == sorted((segment[i], data[i][:50]) for i in range(300))


def test_colliding_hashes_change_nothing(monkeypatch):
    rng = random.Random(5)
    e, _ = _entries(rng, 120)
    (want, _), entry = repeats.resolve(e), repeats.Entries.read([tuple(e.packed().values())])
    assert sorted(zip(entry.doc, entry.start, strict=True)) == sorted(zip(e.doc, e.start, strict=True))
    monkeypatch.setattr(repeats.Prefixes, "hash", lambda self, at, length: np.zeros(len(at), np.uint64))
    got, _ = repeats.resolve(e)
    assert [x.tolist() for x in repeats.merged(*got)] == [x.tolist() for x in repeats.merged(*want)]


def _plain_alignment(a, b):
    score = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (2 if x == y else -1), score[i - 1][j] - 1, score[i][j - 1] - 1)
    return max(map(max, score))


def test_alignment_equals_the_plain_matrix():
    rng = random.Random(2)
    pairs = [([rng.randrange(2, 7) for _ in range(rng.randrange(1, 20))], [rng.randrange(2, 7) for _ in range(rng.randrange(1, 30))]) for _ in range(60)]
    items, windows = (decontam._padded([np.array(p[k], np.uint64) for p in pairs], fill) for k, fill in ((0, 0), (1, 1)))
    best, end = decontam.align(items, windows)
    assert best.tolist() == [_plain_alignment(*p) for p in pairs]
    for (a, b), e, top in zip(pairs, end, best, strict=True):
        assert _plain_alignment(a, b[:e]) == top


def test_leaks_found_and_clean_texts_left(spark, prose):
    rng = random.Random(7)
    items = [(k, prose(10_000 + k, rng.randrange(15, 50))) for k in range(30)] + [(100, "tiny item"), (101, None), (102, "?!"), (None, "x y z")]
    rows, planted = [], set()
    for k in range(300):
        text = prose(k, 200)
        if k % 5 == 0:
            i = rng.randrange(30)
            copy = items[i][1] if k % 2 else _edited(rng, items[i][1], len(items[i][1].split()) // 7)
            copy = copy.upper() if k % 3 == 0 else copy.replace(" ", ", ")
            text, planted = text + ".\n" + copy + " " + prose(5000 + k, 50), planted | {(k, i)}
        rows.append((k, text, 0.5))
    rows += [(900, None, 0.5), (901, "", 0.5), (None, "a " + items[3][1], 0.5), (902, "the TINY item is", 0.5), (902, "the TINY item is", 0.5)]
    docs, tests = spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(items, "item_id long, text string")
    found = decontam.leaks(docs, tests).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["doc_id"] not in (None, 902)} == planted
    assert [(r["item_id"], r["score"]) for r in found if r["doc_id"] == 902] == [(100, 1.0)] * 2
    assert [(r["item_id"], r["score"], r["start"]) for r in found if r["doc_id"] is None] == [(3, 1.0, 2)]
    text = {r[0]: r[1] for r in rows}
    for r in found:
        if r["score"] == 1 and r["doc_id"] in text and r["item_id"] < 100:
            assert re.findall(r"\w+", text[r["doc_id"]][r["start"]:r["end"]].lower()) == re.findall(r"\w+", items[r["item_id"]][1].lower())
    assert decontam.leaks(docs, tests.limit(0)).collect() == [] and decontam.leaks(docs.limit(0), tests).collect() == []


def test_leaks_in_blocks_of_items(spark, prose, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 500)
    items = [(k, prose(k, 25)) for k in range(12)]
    docs = spark.createDataFrame([(k, prose(100 + k, 30) + " " + t) for k, t in items], "doc_id long, text string")
    found = decontam.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k in range(12)}


def _spread_edits(words, step, kind):
    """Every ``step``-th word replaced, left out, or followed by another one."""
    out = []
    for i, w in enumerate(words):
        hit = i % step == step - 1
        out += [f"zz{i}q"] if hit and kind == "other" else [] if hit and kind == "gone" else [w, f"zz{i}q"] if hit else [w]
    return out


def test_leaks_equal_the_alignment_of_every_text_with_every_item(spark, prose):
    items = [(k, prose(20_000 + k, 3 + k * 7 % 45)) for k in range(24)] + [(50, "two words"), (51, "lonely")]
    rows = [(k, prose(k, 40) + " " + items[k % 24][1]) for k in range(60)]  # exact copies hold seeds that edited ones lack
    for i, text in items:
        own = text.split()
        copies = [_spread_edits(own, s, kind) for s in (6, 5, 4, 3) for kind in ("other", "gone", "added")]
        copies += [_spread_edits(own, s, "added") for s in (2, 1)] + [own[:len(own) // 2], own[-(-len(own) // 2):], own[::2]]
        rows += [(1000 * (i + 1) + c, " ".join([prose(7 * i + c, 9), *copy, prose(9 * i + c, 9)])) for c, copy in enumerate(copies)]
    docs, tests = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    best = defaultdict(float)
    for r in decontam.leaks(docs, tests).collect():
        best[r["doc_id"], r["item_id"]] = max(best[r["doc_id"], r["item_id"]], r["score"])
    want = {}
    number = defaultdict(lambda: len(number) + 2)
    told = {k: np.array([number[w] for w in t.split()], np.uint64) for k, t in rows}
    for i, text in items:
        own = np.array([number[w] for w in text.split()], np.uint64)
        top, _ = decontam.align(decontam._padded([own] * len(rows), 0), decontam._padded(list(told.values()), 1))
        want |= {(k, i): s / (2 * len(own)) for k, s in zip(told, top.tolist(), strict=True) if s >= len(own)}
    assert dict(best) == want


def test_leaks_are_found_in_any_case_and_between_any_signs(spark):
    item = "Größe und Maß der «Straße» — Ñandú, ça été où? ΣΊΣΥΦΟΣ naïve ŝanĝo öl ﬁn"
    rows = [(1, item.upper()), (2, "¿“" + item.lower().replace(" ", "…") + "”"), (3, "ß " + item.replace("ß", "SS").swapcase() + " ß"), (4, "Maß der Dinge, où?")]
    found = decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    got = {r["doc_id"]: (r["score"], rows[r["doc_id"] - 1][1][r["start"]:r["end"]]) for r in found.collect()}
    assert got == {1: (1.0, rows[0][1]), 2: (1.0, rows[1][1][2:-1]), 3: (1.0, rows[2][1][2:-2])}


def test_every_copy_of_an_item_is_a_passage_of_its_own(spark, prose):
    item = prose(31, 24)
    own = item.split()
    copies = [item, " ".join(_spread_edits(own, 5, "other")), item.upper(), " ".join(_spread_edits(own, 4, "added"))] + [item] * 40
    text, places = prose(32, 30), []
    for copy in copies:
        places.append((len(text) + 1, len(text) + 1 + len(copy)))
        text += " " + copy
    docs = spark.createDataFrame([(1, text + " " + prose(33, 30))], "doc_id long, text string")
    found = sorted(decontam.leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect(), key=lambda r: r["start"])
    assert len(found) == len(copies)
    for r, (start, end) in zip(found, places, strict=True):
        assert start <= r["start"] < r["end"] <= end and (r["score"] == 1) == (text[start:end].lower() == item)


def _common_passage(prose, n):
    passage = "this passage stands in every text, and what is around it differs from text to text. " + prose(40, 4)
    return [(k, prose(100 + k, 12) + " " * (k % 3) + passage + prose(900 + k // 2, 12)) for k in range(n)]


def test_repeats_around_hot_anchors_equal_brute_force(spark, prose, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 3000)
    monkeypatch.setattr(repeats, "HOT", 5)
    rows = _common_passage(prose, 90)
    _same(_got(repeats.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))), _kept(rows))


def test_runs_of_a_hot_anchor_are_spread_over_buckets(prose):
    rows = _common_passage(prose, 200)
    texts = [t.encode() for _, t in rows]
    a = repeats.Anchors(texts)
    found, count = np.unique(a.hash, return_counts=True)
    hot = found[count >= len(rows)]
    batch = pa.RecordBatch.from_pydict({"id": [k for k, _ in rows], "text": [t for _, t in rows], "anchors": [hot.astype(np.int64).tolist()] * len(rows)})
    sent = [r for b in repeats._around(16, hot)(iter([batch])) for r in b.to_pylist() if not r["sure"]]
    held = [len(r["count"]) for r in sent]
    assert len(hot) and len(held) == 16 and max(held) < 3 * sum(held) / 16
