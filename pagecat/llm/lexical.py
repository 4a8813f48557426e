"""Ranked lexical search: exact best-first search of sparse ball trees for the largest inner products."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import running, saved
from .words import grouped, pieces, words

# Bytes of a term: ASCII's letters and digits, and all bytes of other characters.
PARTED = np.ones(256, bool)
PARTED[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}
# Points of a leaf; points of a tree at most; numbers that all centroids of a tree may hold.
LEAF, POINTS, CELLS = 16, 8192, 1 << 24
# Bytes of item text that are searched for in one pass.
BLOCK = 4 << 20
# Parts in which an item's best documents are chosen before they meet.
PARTS = 64
_EPS = float(np.finfo(np.float64).eps)


class Vocabulary:
    """The terms of some items, found in texts by hash and confirmed byte by byte."""

    def __init__(self, texts: list[str]):
        found = [dict.fromkeys(t.translate(CAPITALS) for t in TERM.findall(text)) for text in texts]
        names = [t.encode() for t in dict.fromkeys(t for terms in found for t in terms)]
        hashes = words([b" ".join(names)], PARTED)[0] if names else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.names = hashes[order], [names[k] for k in order]
        number = {name: k for k, name in enumerate(self.names)}
        self.items = [np.array(sorted(number[t.encode()] for t in terms), np.int64) for terms in found]
        self.size = np.array([len(t) for t in self.names], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.size))).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(self.names), np.uint8)

    def places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; and of each word that is a term its text and its term."""
        hashes, begin, end, numbers = words(texts, PARTED)
        length = np.diff(numbers)
        if not len(hashes) or not len(self.hashes):
            return length, np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        term, row = at, np.repeat(np.arange(len(texts)), length)
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.size[at] == end - begin))
        term, row, begin = term[hit], row[hit], begin[hit]
        start = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        size = self.size[term]
        ahead = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        seen = joined[np.repeat(start[row] + begin, size) + ahead]
        seen = np.where((seen >= 65) & (seen <= 90), seen + 32, seen)
        same = seen == self.bytes[np.repeat(self.first[term], size) + ahead]
        if len(term):
            true = np.logical_and.reduceat(same, np.cumsum(size) - size)
            term, row = term[true], row[true]
        return length, row, term


def _vectors(vocabulary: Vocabulary):
    """Texts to (id, number of words, terms, their counts); a text without any word gives no row."""
    wide = max(len(vocabulary.names), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in grouped(batch.column(1).cast(pa.binary()).to_pylist()):
                parts = [group] if len(group) > 1 else [[p] for p in pieces(group[0], PARTED)]
                length, places = np.zeros(len(group), np.int64), []
                for part in parts:
                    n, row, term = vocabulary.places(part)
                    length += n
                    places.append(np.stack(np.unique(row * wide + term, return_counts=True)))
                key, back = np.unique(np.concatenate([p[0] for p in places]), return_inverse=True)
                count = np.zeros(len(key), np.int64)
                np.add.at(count, back, np.concatenate([p[1] for p in places]))
                ends = np.searchsorted(key, np.arange(len(group) + 1) * wide).astype(np.int32)
                lists = lambda values, ends=ends: pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(group)), pa.array(length), lists(key % wide), lists(count)],
                    names=["id", "n", "terms", "counts"]).filter(pa.array(length > 0))

    return run


class BallTree:
    """Sparse points (terms and whole-number values), split into nested balls; each has its centroid and its radius."""

    def __init__(self, first: np.ndarray, term: np.ndarray, value: np.ndarray):
        """``first``: where each point's entries begin, one more than points. Points are not empty."""
        self.term, column = np.unique(term, return_inverse=True)
        points, width = len(first) - 1, len(self.term)
        weight = value.astype(np.float64)
        square = np.add.reduceat(weight * weight, first[:-1])
        order = np.arange(points)
        begin, length = first[:-1], np.diff(first)
        nodes, centre, radius = [(0, points, -1)], [], []
        slack = (8 * width + 64) * _EPS
        at = 0
        while at < len(nodes):
            low, high, _ = nodes[at]
            rows = order[low:high]
            each = length[rows]
            start = np.cumsum(each) - each
            entry = np.repeat(begin[rows] - start, each) + np.arange(each.sum())
            c, w, sq = column[entry], weight[entry], square[rows]
            middle = np.bincount(c, w, width) / len(rows)
            norm = float(middle @ middle)
            far = sq - 2 * np.add.reduceat(w * middle[c], start) + norm
            # Rounded up by what the sums above may be off.
            reach = math.sqrt(max(float(far.max()), 0.0) + slack * (float(sq.max()) + norm))
            centre.append(middle)
            radius.append(reach)
            if len(rows) > LEAF:
                a = np.zeros(width)
                k = int(far.argmax())
                a[c[start[k]:start[k] + each[k]]] = w[start[k]:start[k] + each[k]]
                to_a = np.add.reduceat(w * a[c], start)
                k2 = int((sq - 2 * to_a).argmax())
                a[c[start[k2]:start[k2] + each[k2]]] -= w[start[k2]:start[k2] + each[k2]]
                side = np.add.reduceat(w * a[c], start)
                left = side > (sq[k] - sq[k2]) / 2
                n = int(left.sum())
                if min(n, len(rows) - n) < len(rows) // 16 + 1:
                    # Uneven halves: cut at the median, so that the tree stays shallow.
                    n = len(rows) // 2
                    rank = np.argsort(-side, kind="stable")
                else:
                    rank = np.argsort(~left, kind="stable")
                order[low:high] = rows[rank]
                nodes[at] = (low, high, len(nodes))
                nodes += [(low, low + n, -1), (low + n, high, -1)]
            at += 1
        self.nodes, self.centre, self.radius, self.order = nodes, np.stack(centre), np.array(radius), order
        each = length[order]
        self.first = np.concatenate(([0], np.cumsum(each)))
        entry = np.repeat(begin[order] - self.first[:-1], each) + np.arange(self.first[-1])
        self.column, self.value = column[entry], value[entry]

    def _bounds(self, low: int, high: int, wanted: np.ndarray) -> list[float]:
        """Of some nodes a number that no point inside exceeds: the centroid's product, and the radius times the length of the query
        (each of its terms counts 1) where the ball has any of its terms."""
        part = self.centre[low:high, wanted]
        reach = np.sqrt((part > 0).sum(1)) * self.radius[low:high]
        return ((part.sum(1) + reach) * (1 + (len(wanted) + 16) * 2 * _EPS) + 1).tolist()

    def search(self, terms: np.ndarray, least) -> Iterator[tuple[int, int]]:
        """Points by (number, score) whose score is ``least()`` or more, asked again at each step; most promising balls first."""
        at = np.searchsorted(self.term, terms)
        wanted = at[(at < len(self.term)) & (self.term[np.minimum(at, len(self.term) - 1)] == terms)]
        if not len(wanted):
            return
        asked = np.zeros(len(self.term), bool)
        asked[wanted] = True
        heap = [(-self._bounds(0, 1, wanted)[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least():
                return
            low, high, child = self.nodes[node]
            if child >= 0:
                for k, b in enumerate(self._bounds(child, child + 2, wanted)):
                    if b >= least():
                        heapq.heappush(heap, (-b, child + k))
                continue
            a, b = self.first[low], self.first[high]
            scores = np.add.reduceat(np.where(asked[self.column[a:b]], self.value[a:b], 0), self.first[low:high] - a)
            for k in np.flatnonzero(scores >= least()):
                yield int(self.order[low + k]), int(scores[k])


def _chunks(batches: Iterator[pa.RecordBatch], points: int):
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, points):
            part = batch.slice(at, points)
            if size + part.num_rows > points:
                yield held
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if held:
        yield held


def _points(chunk: list[pa.RecordBatch], weight: np.ndarray, docs: int, length: int, top: int):
    """The chunk's documents as points: where each begins, terms, values, and the smallest ids with exactly these values.

    Documents with the same values score alike for any item, so only the ``top`` smallest ids of them can ever be reported.
    """
    table = pa.Table.from_batches(chunk).combine_chunks().sort_by("id")
    ids, n = table.column(0).to_numpy(), table.column(1).to_numpy().astype(np.int64)
    terms, counts = (table.column(k).combine_chunks() for k in (2, 3))
    each = np.diff(terms.offsets.to_numpy()).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), each)
    term, count = terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64)
    m = 10 + (90 * n * docs) // length
    value = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m[row]))
    row, term, value = row[value > 0], term[value > 0], value[value > 0]
    ends = np.searchsorted(row, np.arange(len(ids) + 1))
    same: dict[bytes, list[int]] = {}
    start: list[int] = []
    for k in range(len(ids)):
        a, b = ends[k], ends[k + 1]
        if a < b:
            key = term[a:b].tobytes() + value[a:b].tobytes()
            if key not in same:
                start.append(k)
            owners = same.setdefault(key, [])
            if len(owners) < top:
                owners.append(int(ids[k]))
    kept = np.zeros(len(ids), bool)
    kept[start] = True
    inside = kept[row]
    size = (ends[1:] - ends[:-1])[kept]
    return np.concatenate(([0], np.cumsum(size))), term[inside], value[inside], list(same.values())


def _search(items: list[np.ndarray], weight: np.ndarray, docs: int, length: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is found in one chunk prunes the trees of the next ones.
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        points = max(256, min(POINTS, CELLS * LEAF // (4 * len(weight) + 1)))
        for chunk in _chunks(batches, points):
            first, term, value, owners = _points(chunk, weight, docs, length, top)
            if not owners:
                continue
            tree = BallTree(first, term, value)
            for terms, found in zip(items, best, strict=True):
                for point, score in tree.search(terms, lambda found=found: found[0][0] if len(found) == top else 1):
                    for k in owners[point]:
                        if len(found) < top:
                            heapq.heappush(found, (score, -k))
                        elif (score, -k) > found[0]:
                            heapq.heapreplace(found, (score, -k))
                        else:
                            break
        rows = [(k, -back, score) for k, found in enumerate(best) for score, back in found]
        item, id_, score = zip(*rows, strict=True) if rows else ((),) * 3
        yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int32()), "id": pa.array(id_, pa.int64()), "score": pa.array(score, pa.int64())})

    return run


def ranked(
    docs: DataFrame, items: DataFrame, top: int = 10,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``top`` best documents of each item, by a score in whole numbers: (item column, rank, id column, score).

    Terms are runs of ASCII's letters and digits and of all other characters, A-Z lower-cased. Over all documents are counted: N
    with any term, L terms, df documents with a term. A term weighs w = floor(1000 ln((2N+2)/(2df+1))); a document of n terms, tf of
    them this one, scores for it w * (10^9 tf div (1000 tf + 8m)), m = 10 + 90nN div L. An item adds up its distinct terms. Ranks
    follow scores above 0, equal ones by ascending id.

    Documents become sparse vectors over the terms of the items, which changes no score. Each task splits its own into ball trees of
    bounded size. With the weights inside the vectors an item is a vector of ones, so no document of a ball scores more than the
    centroid's product plus the radius times the root of the item's terms that the ball has at all; radius and product are rounded up by
    the error of their sums. Balls are opened best first until none can reach the item's ``top`` best; documents in leaves are scored
    in whole numbers. The best of each task meet in parts, then as a whole: no task reads more than ``top`` rows an item and task.

    Items are searched for in blocks of 4 MB of their text. A null or empty item text finds nothing, equal items are answered each, an
    item with a null id keeps it. Ids of documents are whole numbers; rows without an id or without a term are left out and not
    counted; rows that repeat an id are ranked each; empty tables give no rows; other columns are not read. Eager.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = items.filter(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.col(item_text_col).alias("text"), (F.octet_length(item_text_col) + 8).alias("size"))
    sized = saved(running(asked, ["item", "text"], "size"), "asked").withColumn("block", F.floor(F.col("start") / BLOCK))
    out = None
    for block in [r["block"] for r in sized.select("block").distinct().orderBy("block").collect()]:
        # One block of bounded size at a time is held by the driver.
        rows = sized.filter(F.col("block") == block).select("index", "text").orderBy("index").collect()
        vocabulary = Vocabulary([r["text"] for r in rows])
        vectors = saved(known.mapInArrow(_vectors(vocabulary), "id long, n long, terms array<int>, counts array<int>"), "vectors")
        n_docs, length = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        spread = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
        weight = np.zeros(len(vocabulary.names), np.int64)
        for r in spread:
            weight[r["t"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        numbers = [r["index"] for r in rows]
        found = vectors.mapInArrow(_search(vocabulary.items, weight, n_docs, max(length, 1), top), "item int, id long, score long")
        order = [F.col("score").desc(), F.col("id")]
        part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
        first = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
        whole = first.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        place = spark.createDataFrame(list(enumerate(numbers)), "k int, number long")
        best = whole.filter(F.col("rank") <= top).join(F.broadcast(place), F.col("item") == F.col("k")).select("number", "rank", "id", "score")
        out = best if out is None else out.union(best)
    if out is None:
        out = spark.createDataFrame([], "number long, rank int, id long, score long")
    named = sized.select("index", F.col("item").alias(item_col))
    # One row an item and rank; ids of the items come back by their number.
    return out.join(named, F.col("number") == F.col("index")).select(item_col, "rank", F.col("id").alias(id_col), "score")
