"""Benchmark leaks: linked words find every place that can score enough, Smith-Waterman alignment scores what is there."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import running, saved
from .words import grouped, letter_words, mix

# Two words of a text are linked if at most one stands between them.
REACH = 2
# Links to one part of a text that are asked for, where an item has so many; with more of them, commoner ones are searched for.
ASKED = 4
MATCH, MISS, GAP = 2, -1, -1
# Bytes of test items searched for at once; a larger benchmark is searched in several passes.
BLOCK = 16 << 20
_FILTER = 20


def _links(hashes: np.ndarray, apart: int) -> np.ndarray:
    """Hash of each word with the one ``apart`` words on, 0: of the word alone. How far apart they stand is not in the hash."""
    if not apart:
        return mix(hashes)
    return mix(hashes[:-apart] * np.uint64(0x9E3779B97F4A7C15) + mix(hashes[apart:]))


@dataclass
class Items:
    """Test items of a block as word hashes, and their seeds: sorted link hashes with the item and place of each occurrence.

    An alignment of m equal words with a score of T has 2m - T wrong or extra words at most. They stand in its m - 1 gaps, so
    T/2 - 1 gaps or more hold one at most: two linked words of the item are linked words of the text there. ``sure`` is that number
    for the lowest score asked for; each of these links starts at another word of the item. If it is none, one equal word is
    enough, and words are searched for by themselves.
    """

    ids: np.ndarray
    words: list[np.ndarray]
    sure: np.ndarray
    needed: np.ndarray
    apart: list[int]
    seeds: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]], at_least: float) -> Items:
        hashes, _, _, numbers = letter_words([t for _, t in rows])
        own = [hashes[a:b] for a, b in zip(numbers[:-1], numbers[1:], strict=True)]
        sure = np.array([max(0, math.ceil(at_least * len(w) - 1 - 1e-9)) for w in own])
        grams, item, place = [], [], []
        for k, w in enumerate(own):
            for apart in range(1, min(REACH + 1, len(w))) if sure[k] else [0] * bool(len(w)):
                g = _links(w, apart)
                grams.append(g)
                item.append(np.full(len(g), k))
                place.append(np.arange(len(g)))
        none = [np.zeros(0, np.int64)]
        return cls._sorted(np.array([r[0] for r in rows], np.int64), own, sure, np.maximum(sure, 1), np.concatenate(grams or [hashes[:0]]),
                           np.concatenate(item or none), np.concatenate(place or none))

    @classmethod
    def _sorted(cls, ids, own, sure, needed, grams, item, place) -> Items:
        order = np.lexsort((place, item, grams))
        seeds, first = np.unique(grams[order], return_index=True)
        linked = sure[np.unique(item)] > 0
        apart = [0] * (not linked.all()) + [*range(1, REACH + 1)] * bool(linked.any())
        return cls(ids, own, sure, needed, apart, seeds, np.append(first, len(order)), item[order], place[order])

    def rare(self, spread: np.ndarray) -> Items:
        """Without the words of each item whose links the most documents have, so few of them that ``ASKED`` of the ``sure`` links
        are left (all of these, if fewer)."""
        needed = np.maximum(np.minimum(self.sure, ASKED), 1)
        seed = np.repeat(np.arange(len(self.seeds)), np.diff(self.first))
        width = max(map(len, self.words))
        start, which = np.unique(self.item * width + self.place, return_inverse=True)
        common = np.bincount(which, spread[seed], len(start))
        item = start // width
        order = np.lexsort((start, -common, item))
        begin = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        rank = np.empty(len(start), np.int64)
        rank[order] = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
        keep = (rank >= np.maximum(self.sure - needed, 0)[item])[which] & (spread[seed] > 0)
        return self._sorted(self.ids, self.words, self.sure, needed, self.seeds[seed[keep]], self.item[keep], self.place[keep])


class Finder:
    """Where seeds stand in texts: a table of hash bits drops most places before the binary search."""

    def __init__(self, items: Items):
        self.items = items
        self.table = np.zeros(1 << _FILTER, bool)
        self.table[(items.seeds >> np.uint64(64 - _FILTER)).astype(np.int64)] = True

    def places(self, hashes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of the text, number of the word at which a seed starts, and which seed."""
        rows, at, seed = [], [], []
        for apart in self.items.apart if len(self.items.seeds) else ():
            grams = _links(hashes, apart)
            near = np.flatnonzero(self.table[(grams >> np.uint64(64 - _FILTER)).astype(np.int64)])
            found = np.minimum(np.searchsorted(self.items.seeds, grams[near]), len(self.items.seeds) - 1)
            same = self.items.seeds[found] == grams[near]
            near, found = near[same], found[same]
            row = np.searchsorted(numbers, near, side="right") - 1
            # The last words of one text and the first of the next are not linked.
            inside = near + apart < numbers[row + 1]
            rows.append(row[inside])
            at.append(near[inside])
            seed.append(found[inside])
        return tuple(np.concatenate(x or [np.zeros(0, np.int64)]) for x in (rows, at, seed))


def align(item: np.ndarray, window: np.ndarray, middle: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over rows of padded word hashes: best score of each pair and where it ends in the window (exclusive); of
    several such ends the one nearest to ``middle``.

    All pairs take a row of the matrix at once; gaps along the row are a running maximum. Padding never matches.
    """
    pairs, width = window.shape
    across = -GAP * np.arange(width + 1, dtype=np.int32)
    scores = np.zeros((pairs, width + 1), np.int32)
    top = np.zeros_like(scores)
    for i in range(item.shape[1]):
        step = np.where(window == item[:, i:i + 1], MATCH, MISS).astype(np.int32)
        new = np.zeros_like(scores)
        new[:, 1:] = np.maximum(np.maximum(scores[:, :-1] + step, scores[:, 1:] + GAP), 0)
        scores = np.maximum.accumulate(new + across, 1) - across
        np.maximum(top, scores, out=top)
    best = top.max(1)
    off = np.abs(np.arange(width + 1) - np.reshape(middle, (-1, 1)))
    return best, np.where(top == best[:, None], off, np.iinfo(np.int64).max).argmin(1)


def _padded(rows: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), fill, np.uint64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _parts(items: Items, finder: Finder, hashes: np.ndarray, numbers: np.ndarray, at_least: float):
    """The parts of texts that ``needed`` links of an item point to: row, item, first word, end. A part has room on both sides for
    as many extra words as the lowest score allows; parts of one item that overlap are one."""
    row, at, seed = finder.places(hashes, numbers)
    count = np.diff(items.first)[seed]
    each = np.repeat(np.arange(len(at)), count)
    which = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + items.first[seed][each]
    item, place, row, at = items.item[which], items.place[which], row[each], at[each]
    sizes = np.array([len(w) for w in items.words])
    room = np.floor(2 * (1 - at_least) * sizes + 1e-9).astype(np.int64).clip(0)
    # Of one item all windows are equally wide, so they end in the order in which they start.
    low = at - place - room[item]
    order = np.lexsort((low, item, row))
    row, item, place, low = row[order], item[order], place[order], low[order]
    if not len(row):
        return
    high = low + sizes[item] + 2 * room[item]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])))
    part, begin = np.cumsum(new) - 1, np.flatnonzero(new)
    width = int(sizes.max())
    links = np.bincount(np.unique(part * width + place) // width)
    enough = links >= items.needed[item[begin]]
    last = np.append(begin[1:], len(row)) - 1
    row, item, low, high = row[begin][enough], item[begin][enough], low[begin][enough], high[last][enough]
    yield from zip(row, item, np.maximum(low, numbers[row]), np.minimum(high, numbers[row + 1]), strict=True)


def _search(items: Items, finder: Finder, texts: list[str], at_least: float):
    """(row, item, score, start, end) of one group of texts; start and end in code points."""
    hashes, begin, end, numbers = letter_words(texts)
    sizes = [len(w) for w in items.words]
    todo = list(_parts(items, finder, hashes, numbers, at_least))
    # What a passage leaves of its part on both sides is searched again. Of equally good passages the middle one goes first: many
    # copies in one part are halved round by round.
    while todo:
        todo.sort(key=lambda x: (x[3] - x[2], sizes[x[1]]))
        rest = []
        for a in range(0, len(todo), 128):
            part = todo[a:a + 128]
            best, stop = align(_padded([items.words[k] for _, k, _, _ in part], 0), _padded([hashes[x:y] for _, _, x, y in part], 1),
                               np.array([(y - x + sizes[k]) // 2 for _, k, x, y in part]))
            good = [j for j, (_, k, _, _) in enumerate(part) if best[j] >= at_least * MATCH * sizes[k]]
            if not good:
                continue
            # Backwards from its end the same alignment tells where it starts.
            _, back = align(_padded([items.words[part[j][1]][::-1] for j in good], 0),
                            _padded([hashes[part[j][2]:part[j][2] + stop[j]][::-1] for j in good], 1))
            for j, length in zip(good, back, strict=True):
                r, k, low, high = part[j]
                last = low + stop[j]
                yield r, k, best[j] / (MATCH * sizes[k]), int(begin[last - length]), int(end[last - 1])
                rest += [(r, k, x, y) for x, y in ((low, last - length), (last, high)) if y - x >= at_least * sizes[k]]
        todo = rest


def _count(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, spread = Finder(items), np.zeros(len(items.seeds), np.int64)
        for batch in batches:
            for _, texts in grouped(batch.column(0).cast(pa.binary()).to_pylist()):
                hashes, _, _, numbers = letter_words([t.decode("utf-8", "replace") for t in texts])
                row, _, seed = finder.places(hashes, numbers)
                spread += np.bincount(np.unique(row * len(items.seeds) + seed) % len(items.seeds), minlength=len(spread))
        met = np.flatnonzero(spread)
        yield pa.RecordBatch.from_pydict({"seed": met, "n": spread[met]})

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, at_least: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Passages of documents that align with a test item.

    Words are runs of Unicode's letters and digits, compared without case; a combining mark is neither and parts them. A part of a
    text is aligned with an item: 2 for an equal word, -1 for another word, a left-out or an added one. The score
    is the best local alignment over that of the item with itself.

    Seeds are two words of an item with one between them at most. A passage that scores ``at_least`` holds a known number of them,
    so the search leaves nothing out: how many documents have each seed is counted over the whole corpus, an item does without its
    commonest ones only as far as enough others are certain, and every part of a text that enough of these point to is aligned,
    with room for all the words that may have been added.

    Returns a row for each document, item and passage with a score of ``at_least`` or more: id, item_id, score, start and end of the
    passage (code points). Of passages of one item that overlap the best one counts. Items without words match nothing, and equal items are reported each. Null texts match nothing; rows
    that repeat an id are searched each; a null id stays null; an empty table gives no rows; other columns are not read.

    The benchmark is searched for in blocks of 16 MB of its text, each broadcast; documents are read, never shuffled. Eager.
    """
    spark = docs.sparkSession
    tests = benchmark.filter(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"), F.octet_length(item_text_col).alias("size"))
    sized = saved(running(tests, ["item", "text"], "size"), "items").withColumn("block", F.floor(F.col("start") / BLOCK))
    kind = T.StructType([docs.schema[id_col], *T._parse_datatype_string("item_id long, score double, start long, end long").fields])
    found = spark.createDataFrame([], kind)
    for block in range((sized.agg(F.max("block")).first()[0] if not sized.isEmpty() else -1) + 1):
        rows = [(r["item"], r["text"]) for r in sized.filter(F.col("block") == block).select("item", "text").collect()]
        items = Items.of(rows, at_least) if rows else None
        if items is None or not len(items.seeds):
            continue
        counted = docs.filter(F.col(text_col).isNotNull()).select(text_col).mapInArrow(_count(items), "seed long, n long")
        spread = np.zeros(len(items.seeds), np.int64)
        for r in counted.groupBy("seed").agg(F.sum("n").alias("n")).collect():
            spread[r["seed"]] = r["n"]
        shared = spark.sparkContext.broadcast(items.rare(spread))

        def search(batches, shared=shared):
            items = shared.value
            finder = Finder(items)
            for batch in batches:
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                out = []
                for first, group in grouped(texts):
                    for r, k, score, start, end in _search(items, finder, [t.decode("utf-8", "replace") for t in group], at_least):
                        out.append((first + int(r), int(items.ids[k]), float(score), start, end))
                out.sort()
                at, item, score, start, end = zip(*out, strict=True) if out else ((),) * 5
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                    pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=[id_col, "item_id", "score", "start", "end"])

        found = found.union(docs.select(id_col, text_col).mapInArrow(search, kind))
    return found
