"""Chat formatting, language, toxicity, secrets, fingerprints."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from pagecat.llm import chat, langid, secrets, spotsigs, toxicity

HARD = ["", "a\\", "\\<|im_end|>", "<|im_end|>\n<|im_start|>user\nx", "<\\|", "<\\\\|", "<|im_cont|>", "<", "|", "\\\\n", "x<", "|y<|", "é\n\n"]


def test_escape_is_reversible(spark):
    r = random.Random(5)
    texts = HARD + ["".join(r.choice("\\<|\nan") for _ in range(12)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    for row in df.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert row["back"] == row["t"] and "<|" not in row["e"]


def test_chats_read_back_as_they_were(spark):
    r, rows = random.Random(1), []
    for conv in range(60):
        for turn in range(r.randint(1, 9)):
            rows.append((conv, turn, r.choice(["user", "assistant", "assistant", "system\nx", "<|im_end|>", None]), r.choice([*HARD, None]), "extra"))
    rows += [(None, 0, "user", "hi", "extra"), (7, None, "user", "first", "extra"), (7, 0, "user", "tie", "extra"), (7, 0, "user", "tie", "extra")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_chats(df).cache()
    want = defaultdict(list)
    for c, t, role, text, _ in rows:
        want[c].append((-1 if t is None else t, role or "", text or ""))
    for row in chat.read_chats(formatted).collect():
        turns = [(role, text) for _, role, text in sorted(want[row["conv_id"]])]
        assert [tuple(t) for t in row["turns"]] == turns
        assert row["loss_texts"] == [text for role, text in turns if role == "assistant"]
    for row in formatted.collect():
        roles = [m["role"] for m in row["messages"]]
        assert all(a != b for a, b in zip(roles, roles[1:], strict=False))
    assert chat.read_chats(chat.format_chats(df.limit(0))).collect() == []


def _kn(texts):
    """Interpolated Kneser-Ney by dictionaries, over the same normal form."""
    streams = []
    for t in texts:
        s = re.sub(r"[^a-z]+", " ", t.lower() + " ")
        streams.append("   " + (s[1:] if s.startswith(" ") else s))
    top = Counter(s[i - 3:i + 1] for s in streams for i in range(3, len(s)))
    orders, counts = {}, top
    for n in (4, 3, 2, 1):
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        d = min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else 0.75
        whole, kinds = Counter(), Counter()
        for g, c in counts.items():
            whole[g[:-1]] += c
            kinds[g[:-1]] += 1
        orders[n] = (counts, d, whole, kinds)
        counts = Counter(g[1:] for g in counts)
    return streams, orders


def _cost(gram, orders, symbols):
    p = 1 / symbols
    for n in (1, 2, 3, 4):
        counts, d, whole, kinds = orders[n]
        g, h = gram[4 - n:], gram[4 - n:-1]
        if h in whole:
            p = (max(counts.get(g, 0) - d, 0) if g in counts else 0) / whole[h] + d * kinds[h] / whole[h] * p
    return -math.log(p)


def test_language_model_equals_a_plain_one(prose):
    texts = [prose(k, 40) + ("!! " if k % 2 else "") + prose(k + 100, 5) for k in range(8)]
    _, orders = _kn(texts)
    g = langid.grams(next(langid.grouped(texts)))
    codes, counts = np.unique(g.codes[~g.lead], return_counts=True)
    symbols = 1 + len(orders[1][0])
    model = langid.Model(["x"], [langid.kneser_ney(codes, counts)], symbols)
    assert len(model.tables[0][0].keys) == len(orders[1][0])
    other = ["the new zebra?", "", "...", "the"]
    nats, scored, letters = langid.Scorer(model).sums(other)
    streams, _ = _kn([other[0], other[3]])
    for k, s in ((0, streams[0]), (3, streams[1])):
        want = sum(_cost(s[i - 3:i + 1], orders, symbols) for i in range(3, len(s)))
        assert abs(nats[k, 0] - want) < 1e-9 * want and scored[k] == len(s) - 3
    assert letters.tolist() == [11, 0, 0, 3]
    # What a gram costs sums to one over all symbols a context can be followed by, and one that is unknown.
    context = int(codes[10] >> np.uint64(16))
    follow = np.array([(context << 16) | int(k) for k in model.tables[0][0].keys] + [(context << 16) | 7], np.uint64)
    assert abs(np.exp(-model.costs(follow)).sum() - 1) < 1e-9


def test_language_prediction_and_rejection(spark, prose):
    def german(k):
        return " ".join("ü".join(w) for w in prose(k, 30).split())
    rows = [(k, prose(k, 30) if k % 2 else german(k), "en" if k % 2 else "de", 1) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.fit(df)
    odd = spark.createDataFrame([(1000, None, None, 1), (1001, "123 !!", "en", 1), (1002, "жук" * 100, "en", 1), (None, prose(3, 30), None, 1)], df.schema)
    got = {r["doc_id"]: r for r in langid.predict(df.union(odd), model).collect()}
    assert sum(got[k]["lang_pred"] == lang for k, _, lang, _ in rows) >= 398
    assert not any(got[k]["rejected"] for k in range(400))
    assert [got[k]["lang_pred"] for k in (1000, 1001)] == ["und", "und"] and got[1000]["score"] == 0
    assert got[1000]["rejected"] and got[1001]["rejected"] and got[1002]["rejected"] and not got[None]["rejected"]
    assert langid.accepted(df.union(odd), model).count() == 401
    empty = langid.fit(df.limit(0))
    assert {r["lang_pred"] for r in langid.predict(df.limit(3), empty).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).collect() == []


def test_long_texts_are_scored_whole(monkeypatch):
    pieces = list(langid.grouped(["ab" * langid.PIECE, None, "", "c"]))
    assert sum(len(t) for g in pieces for _, _, t, _ in g) == 2 * langid.PIECE + 1
    # Cut anywhere, a text has the n-grams of the whole one: runs of other characters, letters beyond 16 bits and capitals included.
    r = random.Random(3)
    for _ in range(50):
        text = "".join(r.choice(["a", "É", " ", "  ", "..", "\n", "7", "\U00010400", "ß", "xyz"]) for _ in range(r.randrange(1, 60)))
        whole = langid.grams(next(langid.grouped([text])))
        for size in (1, 2, 5):
            parts = [langid.grams(g) for g in langid.grouped([text], size)]
            assert [c for p in parts for c in p.codes[~p.lead].tolist()] == whole.codes[~whole.lead].tolist()
            assert sum(int(p.letters.sum()) for p in parts) == int(whole.letters.sum())


def test_scores_fall_as_texts_are_rejected(spark, prose):
    german = [(k, " ".join("ü".join(w) for w in prose(k, 60).split()), "de") for k in range(60)]
    docs = spark.createDataFrame(german + [(100 + k, prose(500 + k, 60), "en") for k in range(60)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(1, prose(900, 60)), (2, "зчщ жфх цыю эъя " * 20), (3, "qzx jxq vkz wqx " * 20)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert not got[1]["rejected"] and got[1]["score"] > 0.9
    assert all(got[k]["rejected"] and got[k]["score"] < 0.5 for k in (2, 3))


def test_toxicity_folds_spares_and_normalises():
    model = toxicity.Model({toxicity.fold("idiot"): 2.0, toxicity.fold("trash"): 1.0, toxicity.fold("loser"): 1.5})
    score = toxicity.Matcher(model).score
    assert [score(t)[1] for t in ("you IDIOT!", "1d10t", "іdiоt", "idiots", "trash can", "trash", "losers", "", None)] == [1, 1, 1, 0, 0, 1, 0, 0, 0]
    assert score("l0s3r")[1] == 1 and score("loser$$$")[1] == 1
    assert len(toxicity.fold("ÀİẞſK")) == 5
    stems = toxicity.Matcher(toxicity.Model({"badst*": 1.0, "badstuff": 3.0, "bad": 2.0})).score
    assert [stems(t)[:2] for t in ("badstem", "badstuff!", "bad", "xbadstem", "badge")] == [(1.0, 1), (3.0, 1), (2.0, 1), (0.0, 0), (0.0, 0)]
    dense, thin = toxicity.features(np.array([2.0, 2.0]), np.array([5, 5000])) @ model.curve
    assert dense > thin


def test_toxicity_equals_a_plain_search():
    r = random.Random(11)
    for _ in range(300):
        words = ["".join(r.choices("abis", k=r.randint(1, 4))) + r.choice(["", "", "*"]) for _ in range(6)]
        weights = {w: r.random() + 0.1 for w in words}
        spared = tuple(" ".join("".join(r.choices("abis", k=r.randint(1, 3))) for _ in range(2)) for _ in range(3))
        text = "".join(r.choices("abis  .аA1$5ßl", k=r.randint(0, 60)))
        folded, hits, inside = toxicity.fold(text), {}, set()
        for at in range(len(text)):
            if at and text[at - 1].isalnum():
                continue

            def ends(n):
                return at + n == len(text) or at + n < len(text) and not text[at + n].isalnum()

            for w, weight in weights.items():
                stem = w.rstrip("*")
                if folded.startswith(stem, at) and (w.endswith("*") or ends(len(stem))):
                    hits[at] = max(hits.get(at, 0), weight)
            for phrase in spared:
                if folded.startswith(phrase, at) and ends(len(phrase)):
                    inside.update(range(at, at + len(phrase)))
        hits = {at: w for at, w in hits.items() if at not in inside}
        got = toxicity.Matcher(toxicity.Model(weights, spared)).score(text)
        assert got[1:] == (len(hits), len(text.split())) and abs(got[0] - sum(hits.values())) < 1e-9


def test_toxicity_is_learned_from_labels(spark, prose):
    rows, labels, r = [], [], random.Random(3)
    for k in range(600):
        words = prose(k, 60).split()
        bad = k % 3 == 0
        for _ in range(4 if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["badword", "ugly" + "".join(r.choices("abcdfgm", k=4)), "worthless"]))
        if k % 3 == 1:
            words[5:5] = r.choice([["worth", "it"], ["not", "badword"], ["wort"], ["worthy"]])
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(bad)))
    copy = "onlyincopies " + prose(5000, 40)
    rows += [(1000 + k, copy, "x") for k in range(50)]
    labels += [(1000 + k, 1) for k in range(50)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, label string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks.filter("doc_id % 5 != 0"))
    assert {toxicity.fold("badword"), "ugiy*"} <= set(model.weights) and toxicity.fold("onlyincopies") not in model.weights
    # One strong word earns no stem; what clean texts say with a listed word is spared.
    assert toxicity.fold("worthless") in model.weights and not {"wort*", "worth*", "badw*"} & set(model.weights)
    assert "not badword" in model.exceptions
    clean = toxicity.Matcher(model).score("Das Wort ist worth it, a worthy one, not badword")
    assert clean[:2] == (0.0, 0)
    got = {r["doc_id"]: r["score"] for r in toxicity.predict(docs, model).collect()}
    assert all((got[k] >= 0.5) == bool(bad) for k, bad in labels if k < 1000 and k % 5 == 0)
    # Batches without any hit, in training as well.
    few = toxicity.fit(docs.filter("doc_id < 30").repartition(30), marks)
    assert few.weights == {} and toxicity.predict(docs.limit(0), model).collect() == []
    odd = spark.createDataFrame([(1, None, "x"), (None, "", "x"), (2, "!", "x")], docs.schema)
    assert all(0 <= r["score"] < 0.5 for r in toxicity.predict(odd, model).collect())
    nothing = toxicity.fit(docs, marks.limit(0))
    assert {r["hits"] for r in toxicity.predict(docs.limit(5), nothing).collect()} == {0}


BASE = {
    "assign": re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+"),
}


def _base(text):
    good = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    spans = [(m.start(), list(BASE).index(k), m.end(), k) for k, p in BASE.items() for m in p.finditer(text) if good[k](m)]
    return [(s, e, k) for s, _, e, k in sorted(spans)]


def test_secrets_equal_the_plain_patterns():
    r = random.Random(9)
    parts = ["password", "Passwd", "SECRET", "token", "apikey", "API_KEY", "api_", "key", "=", ":", " ", "'", '"', "AKIA", "AKIAAKIA", "ABCDEF0123456789",
             "deadbeef" * 3, "0123456789abcdef", "x", "é", "İ", "-", ".", "abc123", "\n", "toke", "n", "ſecret=abcdefgh", "K"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        assert [s for s in secrets.scan(text) if s[2] in BASE] == _base(text), text


def test_checksums_decide_on_tokens(spark):
    body = "A1b2" * 7 + "zz"
    good, bad = "ghp_" + body + secrets.checksum(body), "ghp_" + body + "000000"
    assert secrets.checksum("") == "000000" and len(secrets.checksum(body)) == 6
    assert [s[2] for s in secrets.scan(f"see {good}.")] == ["github"]
    assert secrets.scan(f"see {bad} and x{good}") == [] and secrets.scan("npm_" + body + secrets.checksum(body))[0][2] == "npm"
    n = 0
    for c in secrets.checksum(body):
        n = n * 62 + secrets.BASE62.index(c)
    assert n == zlib.crc32(body.encode())


def test_secrets_of_odd_rows(odd_docs, no_docs):
    got = secrets.find_secrets(odd_docs).collect()
    assert len(got) == 12 and all(r["spans"] == [] for r in got)
    assert secrets.find_secrets(no_docs).collect() == []


def _spots(text, chain=2, reach=10):
    words = [w for w in re.split(r"[^\w]+|_+", text.lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in spotsigs.COMMON:
            rest = [x for x in words[i + 1:i + 1 + reach] if x not in spotsigs.COMMON][:chain]
            if len(rest) == chain:
                out.add((w, *rest))
    return out


def test_signatures_equal_plain_chains(spark, prose):
    texts = [prose(k, 10 + 9 * k) for k in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in spotsigs.with_signatures(df, F.col("t"), "s").collect():
        chains = sorted(_spots(row["t"]))
        want = spark.createDataFrame([(list(c),) for c in chains], "c array<string>").select(F.hash("c")).collect()
        assert row["s"] == sorted({r[0] for r in want})


def test_successors_and_edited_texts(odd_docs, no_docs):
    got = {r["doc_id"]: r for r in spotsigs.successors(odd_docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect() if r["doc_id"] is not None}
    ids = sorted(texts)
    assert sorted(got) == ids
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        k = len(texts[a]) // 4
        assert got[a]["edited"] == texts[a][:len(texts[a]) - k] + texts[b][:k]
        assert got[a]["next_signatures"] == got[b]["signatures"] and got[a]["signatures"] and got[a]["n_chars"] == len(texts[a])
    assert got[1]["signatures"] == got[5]["signatures"] and got[2]["signatures"] == got[3]["signatures"] != got[7]["signatures"]
    assert spotsigs.successors(no_docs).collect() == []


def test_pruned_matches_equal_all_pairs(spark, prose):
    rows = []
    for k in range(40):
        words = prose(k, 120).split()
        rows += [(4 * k + j, " ".join(words[:len(words) - 5 * j] + prose(1000 + k, 4 * j).split())) for j in range(4)]
    rows += [(500, rows[0][1]), (501, rows[0][1])]
    prints = spotsigs.with_signatures(spark.createDataFrame(rows, "doc_id long, text string"), F.col("text"), "signatures").cache()
    members, pairs = spotsigs.matches(prints)
    assert {tuple(r) for r in members.collect() if r[0] >= 500} == {(500, 0), (501, 0)}
    own = {r["doc_id"]: r["class_id"] for r in members.collect()}
    sets = {r["doc_id"]: set(r["signatures"]) for r in prints.collect()}
    assert all(sets[a] == sets[c] and c <= a for a, c in own.items()) and len({frozenset(s) for s in sets.values()}) == len(set(own.values()))
    sets = {a: s for a, s in sets.items() if own[a] == a}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])}
    assert {(r["id_a"], r["id_b"]) for r in pairs.collect()} == want and len(want) > 20


