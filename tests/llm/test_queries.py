"""The registered queries keep their contracts on the given tables, and the pipeline's stages do what they say."""

import hashlib
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagecat.llm.queries import ORACLES, QUERIES
from pagecat.session import scratch
from suite.check import connect, rows_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

# The columns that each query must return.
CONTRACT = {
    "op3": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op4": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op5": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op8": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op12": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op13": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op10": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
}


@pytest.fixture(scope="module")
def result(spark):
    done = {}

    def of(number):
        if number not in done:
            name = next(n for n in QUERIES if n.startswith(f"{number}_"))
            df = QUERIES[name](spark, SF)
            done[number] = (dict(df.dtypes), [r.asDict() for r in df.collect()])
        return done[number]

    return of


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("number", sorted(CONTRACT))
def test_columns(result, number):
    kinds, rows = result(number)
    want = dict(c.split() for c in CONTRACT[number].split(", "))
    assert {c: kinds.get(c) for c in want} == want and rows


@pytest.mark.parametrize("number", ["op4", "op5", "op6", "op7", "op8", "op9", "op10"])
def test_one_row_for_each_document(result, docs, number):
    assert sorted(r["doc_id"] for r in result(number)[1]) == sorted(docs)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    cur = connect(SF).execute(ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_kept_bytes_equal_brute_force(result, docs):
    seen, got = set(), {r["doc_id"]: r for r in result("op4")[1]}
    for i in sorted(docs):
        b, own, gone = docs[i]["text"].encode(), set(), bytearray(len(docs[i]["text"].encode()))
        for s in range(len(b) - 49):
            own.add(hash(b[s:s + 50]))
            if hash(b[s:s + 50]) in seen:
                gone[s:s + 50] = b"\1" * 50
        seen |= own
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))))
        assert got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_secrets_and_edited_texts_equal_plain_ones(result, docs):
    hex_run, ids = re.compile(r"[0-9a-f]+"), sorted(docs)
    for r in result("op8")[1]:
        assert r["n_hex"] == sum(len(m[0]) >= 24 for m in hex_run.finditer(docs[r["doc_id"]]["text"]))
    got = {r["doc_id"]: r for r in result("op7")[1]}
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        t, k = docs[a]["text"], len(docs[a]["text"]) // 4
        assert got[a]["edited_sha256"] == hashlib.sha256((t[:len(t) - k] + docs[b]["text"][:k]).encode()).hexdigest()
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) >= 0.98 * len(ids)


def test_models_hold_on_held_out_rows(spark, result, docs):
    held = [r for r in result("op9")[1] if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.97 * len(held)
    assert not any(r["rejected"] for r in result("op9")[1])
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r for r in result("op6")[1] if labels.get(r["doc_id"]) == 0]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)


def test_shards_follow_their_law(result, docs):
    rows = sorted(result("op10")[1], key=lambda r: r["position"])
    size = {i: len(d["text"].encode()) + 1 for i, d in docs.items()}
    assert all(r["size"] == size[r["doc_id"]] and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]]["text"].encode()) for r in rows)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    assert sorted({r["shard"] for r in rows}) == list(range(8))


def _corpus(spark, prose):
    """Two languages, copies, leaks, texts without letters, nulls; columns with names used inside."""
    german = lambda k: " ".join("ü".join(w) for w in prose(k, 60).split())
    rows = [(k, prose(k, 60) if k % 3 else german(k), "en" if k % 3 else "de", f"s{k % 4 % 3}") for k in range(240)]
    rows += [(1000 + k, rows[k][1] + " tail", rows[k][2], "s0") for k in range(20)]
    rows += [(2000 + k, prose(9000 + k, 30) + " " + prose(7000 + k % 5, 25) + " " + prose(9500 + k, 30), "en", None) for k in range(10)]
    rows += [(3000, None, "en", "s0"), (3001, "123 456 !!", None, "s1"), (3002, "", "en", "s1"), (None, prose(8888, 50), "en", "s2"), (7, rows[7][1], rows[7][2], "s1")]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, position int, id string")
    folder = scratch(spark, "corpus")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, prose(7000 + k, 25)) for k in range(5)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def test_stages_take_effect(spark, prose):
    folder, rows = _corpus(spark, prose)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left, out = docs.columns, [], scratch(spark, "stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
        assert docs.columns == columns or k == 4
        left.append([r.asDict() for r in docs.collect()])
    ids = [sorted((r["doc_id"] for r in part), key=str) for part in left]
    # Language: what has no letters goes, all else stays.
    assert ids[0] == sorted((r[0] for r in rows if r[0] not in (3000, 3001, 3002)), key=str)
    # Near-duplicates: of linked texts the smallest id stays, of the row given twice one.
    sets = {r["doc_id"]: _shingles(r["text"]) for r in left[0] if r["doc_id"] is not None}
    gone = {b for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert gone == {1000 + k for k in range(20)} and ids[1] == sorted({i for i in ids[0] if i not in gone}, key=str)
    # Leaks go, by their passages.
    assert ids[2] == [i for i in ids[1] if i is None or not 2000 <= i < 2010]
    # Mixing keeps every row; the first blocks come from all sources in turn.
    assert ids[3] == ids[2] == ids[4]
    order = spark.read.parquet(f"{out}/3").select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    written = [r["doc_id"] for r in sorted(order, key=lambda r: (r["file_name"], r["row_index"]))]
    assert [r["doc_id"] for r in sorted(left[4], key=lambda r: r["position"])] == written
    shards = [r["shard"] for r in sorted(left[4], key=lambda r: r["position"])]
    assert shards == sorted(shards) and set(shards) == set(range(8))
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, again.collect())) == sorted(map(str, spark.read.parquet(f"{out}/4").collect()))


def test_stages_take_an_empty_table(spark, prose):
    folder = scratch(spark, "none")
    full, _ = _corpus(spark, prose)
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{full}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).filter(F.lit(True)).collect() == []
