"""Ball-tree search, the n-gram join and the trie against brute force; odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagecat.llm import chat, lexical, ngram_join, trie
from pagecat.llm.words import pieces, wide_sets, word_hashes, words


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def plain_ranks(docs, items, top=10):
    """docs: (id, text); items: (item, text)."""
    counted = [(i, plain_terms(t)) for i, t in docs if i is not None and t and plain_terms(t)]
    n_docs, length = len(counted), sum(len(t) for _, t in counted)
    df = defaultdict(int)
    for _, terms in counted:
        for t in set(terms):
            df[t] += 1
    weight = {t: int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * n + 1)))) for t, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, terms in counted:
            m = 100 - 90 + 90 * len(terms) * n_docs // length
            score = sum(weight[t] * (1_000_000_000 * terms.count(t) // (1000 * terms.count(t) + 8 * m)) for t in set(plain_terms(text or "")) if t in terms)
            if score > 0:
                scored.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("points", [8, 8192])
def test_search_equals_scoring_everything(spark, prose, monkeypatch, points):
    monkeypatch.setattr(lexical, "POINTS", points)
    monkeypatch.setattr(lexical, "LEAF", 4)
    r = random.Random(7)
    docs = [(k, prose(k, r.randrange(1, 80)).replace("a", r.choice("aAéÉ"))) for k in range(150)]
    docs += [(500 + k, docs[3][1]) for k in range(30)] + [(600, docs[5][1] + " " + docs[6][1])]
    items = [(k, prose(k, 12).upper() if k % 2 else docs[k][1]) for k in range(12)] + [(12, docs[3][1]), (13, ""), (14, "никто"), (None, docs[8][1])]
    got = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain_ranks(docs, items)


def test_search_takes_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the word", 2, "x"), (2, None, 1, "y")], "item_id long, text string, rank int, id string")
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted((tuple(x) for x in lexical.ranked(odd_docs, items).collect()), key=str)
    assert got == plain_ranks(rows, [(1, "the word")])
    assert lexical.ranked(no_docs, items).collect() == [] and lexical.ranked(odd_docs, items.limit(0)).collect() == []


def test_no_point_of_a_ball_exceeds_its_bound():
    r = np.random.default_rng(1)
    size = r.integers(1, 12, 300)
    first = np.concatenate(([0], np.cumsum(size)))
    term = np.concatenate([np.sort(r.choice(60, n, replace=False)) for n in size])
    value = r.integers(1, 25_000_000_000, first[-1])
    tree = lexical.BallTree(first, term, value)
    for _ in range(20):
        wanted = np.sort(r.choice(60, 9, replace=False))
        at = np.searchsorted(tree.term, wanted)
        for node, (low, high, _) in enumerate(tree.nodes):
            bound = tree._bounds(node, node + 1, at)[0]
            for p in tree.order[low:high]:
                own = slice(first[p], first[p + 1])
                assert value[own][np.isin(term[own], wanted)].sum() <= bound
    assert sorted(tree.order.tolist()) == list(range(300))


def test_terms_are_confirmed_by_their_bytes(monkeypatch):
    monkeypatch.setattr(lexical, "words", lambda texts, parted: (lambda w: (w[0] * np.uint64(0), *w[1:]))(words(texts, parted)))
    vocabulary = lexical.Vocabulary(["abc"])
    _, row, term = vocabulary.places([b"abd ABC abc ab", b"xyz"])
    assert row.tolist() == [0, 0] and term.tolist() == [0, 0]


def test_long_texts_have_the_words_of_the_whole():
    text = ("word " * 50 + "x" * 300 + "\t") * 40
    assert b"".join(pieces(text.encode(), size=64)) == text.encode()
    assert word_hashes([text.encode()], 64)[0].tolist() == words([text.encode()])[0].tolist()
    assert [len(s) for s in wide_sets([b"", b"one", b"a b c d e f", b"a a a a a a"])] == [0, 1, 2, 1]


def plain_groups(docs, percent):
    """docs: id to text; (n_shingles, component_id) by comparing everything with everything."""
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, root = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in docs)


def _edited(r, text, k):
    w = text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("rounds, percent", [(3, 80), (0, 80), (1, 60)])
def test_join_equals_all_pairs(spark, prose, monkeypatch, rounds, percent):
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "ROOM", 2000)
    r = random.Random(rounds + percent)
    docs = {k: prose(k, r.randrange(1, 120)) for k in range(60)}
    for k in range(120):
        source = prose(k % 5, 100)
        docs[100 + k] = _edited(r, source, r.randrange(0, 6)) + (" tail " + prose(k, r.randrange(0, 30)) if k % 3 == 0 else "")
    docs |= {300: None, 301: "", 302: "one two", 303: "ONE  two", 304: "a b c d", 305: "a b c d e", 306: docs[100].upper()}
    got = ngram_join.jaccard_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5), percent)
    assert sorted(tuple(x) for x in got.collect()) == plain_groups(docs, percent)


def test_join_takes_odd_rows(spark, odd_docs, no_docs, prose):
    got = {r["doc_id"]: tuple(r)[1:] for r in ngram_join.jaccard_groups(odd_docs).collect()}
    assert len(got) == 10 and None not in got
    assert got[2] == (0, 2) and got[3] == (0, 3) and got[5][1] == 1 and got[8][1] == 1 and got[10][1] == 4
    assert ngram_join.jaccard_groups(no_docs).collect() == []
    # Of two texts under one id the larger set counts.
    long, short = prose(1, 50), prose(2, 20)
    twice = spark.createDataFrame([(1, short), (1, long), (2, long), (3, short), (3, short)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_groups(twice).collect()} == {1: 1, 2: 1, 3: 3}


def plain_trie(rebuilt):
    """rebuilt: id to list of (role, text)."""
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for k in range(len(turns) + 1):
            members[tuple(turns[:k])].append(c)
            if k:
                children[tuple(turns[:k - 1])].add(tuple(turns[:k]))
    out = []
    for path, own in members.items():
        inside, leaves, saved = [path], 0, 0
        while inside:
            p = inside.pop()
            leaves += not children[p]
            saved += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
            inside += children[p]
        ends = ",".join(map(str, sorted(c for c in own if len(rebuilt[c]) == len(path))))
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    head = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[:head[c]] + v[head[c]:] for c, v in own.items()}


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("alone", [20_000, 10])
def test_trie_equals_a_plain_one(spark, monkeypatch, alone):
    monkeypatch.setattr(trie, "ALONE", alone)
    r = random.Random(alone)
    rows = [(c, k, r.choice(["user", "assistant"]), r.choice(["a", "b", "héé"])) for c in r.sample(range(350), 120) for k in range(r.randrange(1, 9))]
    rows += [(0, k, "user", f"t{k % 3}") for k in range(300)] + [(7, None, None, None), (7, None, "user", "x"), (None, 1, "user", "y"), (8, 1, "user", "z"), (8, 1, "user", "z")]
    turns = spark.createDataFrame(rows, TURNS).withColumn("node", F.lit(1)).withColumn("conv", F.lit("x")).repartition(5)
    got = trie.trie(trie.share_heads(trie.ordered_turns(turns)))
    assert sorted((tuple(x) for x in got.collect()), key=str) == plain_trie(rebuild(rows))


def test_trie_of_few_rows(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.trie(trie.share_heads(trie.ordered_turns(none))).collect() == []
    # Conversations that keep no turn are members of the root alone.
    bare = [(c, 0, "user", "x") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6 > 0]
    got = trie.trie(trie.share_heads(trie.ordered_turns(spark.createDataFrame(bare, TURNS)))).collect()
    assert [tuple(r)[:6] for r in got] == [(bare[0][0], 0, None, len(bare), 0, 1)]


@pytest.mark.parametrize("span", [2, 16])
def test_positions_of_any_list(spark, monkeypatch, span):
    monkeypatch.setattr(trie, "ALONE", 5)
    monkeypatch.setattr(trie, "SPAN", span)
    order = list(range(700))
    random.Random(span).shuffle(order)
    arcs = [(a, b, random.Random(a).randrange(50)) for a, b in zip(order, [*order[1:], None], strict=True)]
    got = trie.positions(spark.createDataFrame(arcs, "arc long, next long, place long")).collect()
    assert {r["arc"]: r["at"] for r in got} == {a: k for k, a in enumerate(order)}


def test_one_long_conversation_is_formatted(spark):
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), "id", F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                                       F.concat(F.lit("<|é"), F.col("id").cast("string")).alias("text"))
    row = chat.read_chats(chat.format_chats(turns)).first()
    assert [t["text"] for t in row["turns"]] == [f"<|é{k}" for k in range(20_000)]
    assert row["loss_texts"] == [f"<|é{k}" for k in range(20_000) if k % 3]
