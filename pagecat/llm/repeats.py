"""Removal of repeated byte strings: anchored candidates, then a hash-compared suffix sort.

A string of WINDOW bytes holds WINDOW - GRAM + 1 grams; the one with the smallest hash is its anchor, the same wherever the
string stands. So equal windows share an anchor at the same distance, and only windows around anchors that occur in several
documents can repeat. These are collected by anchor; there their suffixes are sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small
from .words import _BASE, _BYTE, mix, pack, powers, unpack

WINDOW, GRAM = 50, 16
REACH = WINDOW - GRAM + 1
# Of two equal windows around an anchor, WINDOW - GRAM further bytes are equal: LEFT of them before it, or RIGHT after it.
LEFT, RIGHT = 17, 18
# Bytes worked on at once, bytes of text whose rows are sent together, and bytes of text for each bucket of anchors.
PIECE, CHUNK, BUCKET = 1 << 20, 8 << 20, 24 << 20
# Documents with one anchor above which its windows are dealt out one by one; their runs are some PIECE bytes.
HOT = 10_000
_PLACE = np.uint64((1 << 24) - 1)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each run, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every n bytes, from hashes of 1, 2, 4 … bytes."""
    level, width, out, done = _BYTE[data], 1, None, 0
    while n:
        if n & 1:
            if out is None:
                out = level
            else:
                size = len(level) - done
                out = out[:size] * np.uint64(pow(_BASE, width, 1 << 64)) + level[done:]
            done += width
        n >>= 1
        if n:
            level = level[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + level[width:]
            width *= 2
    return mix(out)


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n values in a row."""
    width = 1
    while width * 2 <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = n - width
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


class Anchors:
    """The anchors of some documents: row of the document, first and last start of the windows that have it, its place and hash (48 bits)."""

    def __init__(self, texts: list[bytes]):
        parts = []
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for row, text in enumerate(texts):
            # A piece repeats the last WINDOW - 1 bytes of the one before: each window lies in exactly one.
            for at in range(0, max(1, len(text) - WINDOW + 1), PIECE):
                piece = text[at:at + PIECE + WINDOW - 1]
                if len(piece) < WINDOW:
                    continue
                held.append((row, at, piece))
                size += len(piece)
                if size >= PIECE:
                    parts.append(self._of(held))
                    held, size = [], 0
        if held:
            parts.append(self._of(held))
        empty = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
        self.row, self.first, self.last, self.place, self.hash = (np.concatenate(x) for x in zip(empty, *parts, strict=True))

    @staticmethod
    def _of(held):
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        lengths = np.array([len(p) for _, _, p in held])
        begins = np.cumsum(lengths) - lengths
        hashes = gram_hashes(data, GRAM)
        # The place in the low bits makes the first of equal hashes the smallest.
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        starts = ragged(begins, lengths - WINDOW + 1)
        piece = np.repeat(np.arange(len(held)), lengths - WINDOW + 1)
        place = (_smallest(keys, REACH)[starts] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (piece[1:] != piece[:-1]))))
        last = np.concatenate((new[1:], [len(starts)])) - 1
        shift = np.array([at for _, at, _ in held]) - begins
        row = np.array([r for r, _, _ in held])
        by = piece[new]
        return row[by], starts[new] + shift[by], starts[last] + shift[by], place[new] + shift[by], hashes[place[new]] >> np.uint64(16)


def _marks(texts: list[bytes], a: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """One byte each for the LEFT bytes before and the RIGHT bytes after an anchor; 0 where the document has fewer."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes) - sizes
    out = []
    for n, at, room in ((LEFT, a.place - LEFT, a.place >= LEFT), (RIGHT, a.place + GRAM, a.place + GRAM + RIGHT <= sizes[a.row])):
        total = np.zeros(len(at), np.uint64)
        base = np.where(room, begins[a.row] + at, 0)
        for k in range(n):
            total = total * np.uint64(_BASE) + _BYTE[data[base + k]]
        out.append(np.where(room, 1 + mix(total) % np.uint64(255), 0).astype(np.uint8))
    return out[0], out[1]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of several batches, CHUNK bytes of text together."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*[(c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for c in batch.columns], strict=True):
            rows.append(row)
            size += len(row[1])
            if size >= CHUNK:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows with one value in their first column, in a partition sorted by it."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _repeated(key: np.ndarray, doc: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which rows share their key with another document; only rows that count are looked at."""
    out = np.zeros(len(key), bool)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return out
    rows = rows[np.argsort(key[rows], kind="stable")]
    new = np.flatnonzero(np.concatenate(([True], key[rows][1:] != key[rows][:-1])))
    several = np.minimum.reduceat(doc[rows], new) != np.maximum.reduceat(doc[rows], new)
    out[rows] = np.repeat(several, np.diff(np.append(new, len(rows))))
    return out


def _shared(hashes, left, right, doc):
    wide = hashes << np.uint64(8)
    return _repeated(wide | left, doc, left > 0) | _repeated(wide | right, doc, right > 0)


def _counted(doc: np.ndarray) -> dict[str, bytes]:
    """A column of documents, sorted: each with its number of rows."""
    docs, counts = np.unique(doc, return_counts=True)
    return {"docs": docs.tobytes(), "times": counts.astype(np.uint32).tobytes()}


def _recounted(docs: bytes, times: bytes) -> np.ndarray:
    return np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(times, np.uint32))


PLACED = "bucket int, sure boolean, docs binary, times binary, hash binary, lefts binary, rights binary"
PLACED_ARROW = pa.schema([("bucket", pa.int32()), ("sure", pa.bool_()), *[(c, pa.binary()) for c in ("docs", "times", "hash", "lefts", "rights")]])


def _place(n_buckets: int):
    """Anchors of each chunk, by bucket. Those that two documents of the chunk share are sure, and sent on by one of them only."""
    def row(bucket, sure, doc, hashes, left, right):
        order = np.argsort(doc, kind="stable")
        left, right = (x[order] if len(x) else x for x in (left, right))
        return {"bucket": int(bucket), "sure": sure, **_counted(doc), "hash": pack(hashes[order]), "lefts": left.tobytes(), "rights": right.tobytes()}

    def run(batches):
        for number, rows in enumerate(_chunks(batches)):
            texts = [r[1] for r in rows]
            a = Anchors(texts)
            if not len(a.row):
                continue
            left, right = _marks(texts, a)
            doc = np.array([r[0] for r in rows], np.int64)[a.row]
            # One row for each document and anchor with equal marks.
            order = np.lexsort((doc, right, left, a.hash))
            doc, hashes, left, right = doc[order], a.hash[order], left[order], right[order]
            same = (hashes[1:] == hashes[:-1]) & (left[1:] == left[:-1]) & (right[1:] == right[:-1])
            once = np.concatenate(([True], ~same | (doc[1:] != doc[:-1])))
            first = np.concatenate(([True], ~same))[once]
            doc, hashes, left, right = doc[once], hashes[once], left[once], right[once]
            sure = _shared(hashes, left, right, doc)
            out = []
            if sure.any():
                out.append(row((number + int(doc[0])) % n_buckets, True, doc[sure], hashes[sure], left[:0], right[:0]))
            doc, hashes, left, right = doc[first], hashes[first], left[first], right[first]
            bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                own = order[edges[b]:edges[b + 1]]
                out.append(row(b, False, doc[own], hashes[own], left[own], right[own]))
            yield pa.RecordBatch.from_pylist(out, PLACED_ARROW)

    return run


def _find_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the documents' anchors that other documents have too."""
    for rows in _by_key(batches):
        read = [(r[1], _recounted(r[2], r[3]), unpack(r[4]), r[5], r[6]) for r in rows]
        open_ = [x for x in read if not x[0]]
        found = [(x[1], x[2]) for x in read if x[0]]
        if open_:
            doc, hashes = (np.concatenate([x[k] for x in open_]) for k in (1, 2))
            left, right = (np.frombuffer(b"".join(x[k] for x in open_), np.uint8) for k in (3, 4))
            shared = _shared(hashes, left, right, doc)
            found.append((doc[shared], hashes[shared]))
        doc, hashes = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        order = np.lexsort((hashes, doc))
        doc, hashes = doc[order], hashes[order].astype(np.int64)
        new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1]))[:len(doc)])
        for k in range(0, len(new), 100_000):
            yield pa.RecordBatch.from_pydict({"id": doc[new[k:k + 100_000]], "hash": hashes[new[k:k + 100_000]]})


class Entries:
    """Runs of windows with one anchor: document, anchor's hash and distance from the first window, number of windows, the first
    window's start, and their bytes (number + WINDOW - 1) one run after another in ``data``."""

    FIELDS = (("doc", np.int64), ("hash", np.uint64), ("away", np.uint8), ("count", np.uint8), ("start", np.uint32))

    def __init__(self, data: np.ndarray, **fields):
        self.data = data
        for name, kind in self.FIELDS:
            setattr(self, name, np.asarray(fields[name], kind))
        self.length = self.count.astype(np.int64) + WINDOW - 1
        self.at = np.cumsum(self.length) - self.length

    def take(self, rows: np.ndarray) -> Entries:
        data = self.data[ragged(self.at[rows], self.length[rows])]
        return Entries(data, **{name: getattr(self, name)[rows] for name, _ in self.FIELDS})

    @classmethod
    def joined(cls, parts: list[Entries]) -> Entries:
        return cls(np.concatenate([p.data for p in parts]), **{name: np.concatenate([getattr(p, name) for p in parts]) for name, _ in cls.FIELDS})

    def packed(self) -> dict[str, bytes]:
        e = self.take(np.argsort(self.doc, kind="stable"))
        return _counted(e.doc) | {
            "hash": pack(e.hash), "away": e.away.tobytes(), "count": e.count.tobytes(), "start": e.start.tobytes(),
            "data": pa.compress(e.data.tobytes(), codec="zstd", asbytes=True)}

    @classmethod
    def read(cls, rows: list[tuple]) -> Entries:
        """Rows (docs, times, hash, away, count, start, data)."""
        away, count, start = (np.frombuffer(b"".join(r[k] for r in rows), kind) for k, kind in ((3, np.uint8), (4, np.uint8), (5, np.uint32)))
        data = [pa.decompress(r[6], int(np.frombuffer(r[4], np.uint8).sum(dtype=np.int64)) + (WINDOW - 1) * len(r[4]), "zstd", asbytes=True) for r in rows]
        return cls(np.frombuffer(b"".join(data), np.uint8), doc=np.concatenate([_recounted(r[0], r[1]) for r in rows]),
                   hash=unpack(b"".join(r[2] for r in rows)), away=away, count=count, start=start)

    def spans(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start = self.start[rows].astype(np.int64)
        return self.doc[rows], start, start + self.length[rows]


class Prefixes:
    """Prefix polynomial hashes of all runs; a string's hash is the difference of two, scaled back to the start of its run."""

    def __init__(self, e: Entries):
        place = np.arange(len(e.data)) - np.repeat(e.at, e.length)
        self.place, self.data = place.astype(np.uint8), e.data
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[e.data] * powers(WINDOW + REACH)[place], dtype=np.uint64)))
        self.back = np.full(WINDOW + REACH, pow(_BASE, -1, 1 << 64), np.uint64)
        self.back[0] = 1
        self.back = np.multiply.accumulate(self.back)

    def hash(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[self.place[at]]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefix of the windows at a and b, by binary search over hash equality."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), WINDOW, np.int64)
        for _ in range(WINDOW.bit_length()):
            middle = (low + high + 1) >> 1
            same = self.hash(a, middle) == self.hash(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        common = self.extension(a, b)
        inside = np.minimum(common, WINDOW - 1)
        return np.where(common == WINDOW, or_equal, self.data[a + inside] < self.data[b + inside])


def merge_sort(prefixes: Prefixes, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Order of the windows at ``at`` within each segment (given in rows that are next to each other).

    Bottom-up: in each round neighbouring sorted runs are merged, every element finding its rank in the other run by binary
    search; one comparison is a binary search for the common extension. Segments that are sorted drop out.
    """
    order = np.arange(len(at))
    begin = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1]))) if len(at) else order
    size = np.diff(np.append(begin, len(at)))
    width = 1
    while (size > width).any():
        rows = ragged(begin[size > width], size[size > width])
        base = np.repeat(begin[size > width], size[size > width])
        end = base + np.repeat(size[size > width], size[size > width])
        run = (rows - base) // width
        other = np.minimum(base + (run ^ 1) * width, end)
        low, high = other.copy(), np.minimum(other + width, end)
        right = (run & 1) == 1
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            # An element of the right run comes after equal ones of the left run.
            before = prefixes.less(at[order[middle]], at[order[rows[open_]]], right[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = base + (run >> 1) * 2 * width + (rows - base) % width + (low - other)
        merged = order.copy()
        merged[place] = order[rows]
        order = merged
        width *= 2
    return order


def _verified(e: Entries, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> bool:
    """Whether strings found equal by their hashes are equal byte by byte."""
    for k in range(0, len(a), 20_000):
        n = length[k:k + 20_000]
        if not np.array_equal(e.data[ragged(a[k:k + 20_000], n)], e.data[ragged(b[k:k + 20_000], n)]):
            return False
    return True


def _equal_runs(e: Entries, prefixes: Prefixes) -> np.ndarray:
    """A number for each class of equal runs (anchor, distance, bytes), hashes verified; a collision makes the bytes decide."""
    whole = mix(prefixes.hash(e.at, e.length) ^ mix(e.hash + e.away.astype(np.uint64) * np.uint64(256) + e.count))
    _, first, of = np.unique(whole, return_index=True, return_inverse=True)
    same = (e.length == e.length[first[of]]) & (e.hash == e.hash[first[of]]) & (e.away == e.away[first[of]])
    if same.all() and _verified(e, e.at, e.at[first[of]], e.length):
        return of
    keys = [(int(h), int(w), e.data[a:a + n].tobytes()) for h, w, a, n in zip(e.hash, e.away, e.at, e.length, strict=True)]
    number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
    return np.array([number[k] for k in keys])


def _equal_windows(e: Entries, prefixes: Prefixes, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows sorted within their segments, and where a new class of equal ones begins."""
    order = merge_sort(prefixes, at, segment)
    a, b = at[order[:-1]], at[order[1:]]
    joined = (segment[order[1:]] == segment[order[:-1]]) & (prefixes.hash(a, WINDOW) == prefixes.hash(b, WINDOW))
    if not _verified(e, a[joined], b[joined], np.full(int(joined.sum()), WINDOW)):
        keys = [(int(s), e.data[x:x + WINDOW].tobytes()) for s, x in zip(segment, at, strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        joined = np.array([keys[i] == keys[j] for i, j in zip(order[:-1], order[1:], strict=True)], bool)
    return order, np.concatenate(([True], ~joined))


def resolve(e: Entries, windows: bool = True) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """``settle`` for some PIECE bytes after another; the runs of an anchor stay together."""
    order = np.argsort(e.hash, kind="stable")
    if not len(order):
        return (np.zeros(0, np.int64),) * 3, order
    class_end = np.flatnonzero(np.append(e.hash[order][1:] != e.hash[order][:-1], True)) + 1
    part = (np.cumsum(e.length[order])[class_end - 1] - 1) // PIECE
    ends = class_end[np.append(part[1:] != part[:-1], True)]
    spans, left = [], []
    for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
        found, first = settle(e.take(order[a:b]), windows)
        spans.append(found)
        left.append(order[a:b][first])
    return tuple(map(np.concatenate, zip(*spans, strict=True))), np.concatenate(left)


def settle(e: Entries, windows: bool) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Spans (document, start, end) of windows that a smaller document has as well, and the runs that are the first of their class.

    Of equal runs all but those of the smallest document are covered as a whole. Without ``windows`` it ends there. Then the
    windows of the runs left, where several differ around one anchor, are sorted as suffixes; of equal ones all but those of the
    smallest document are covered.
    """
    prefixes = Prefixes(e)
    of = _equal_runs(e, prefixes)
    least = np.full(of.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, of, e.doc)
    late = e.doc > least[of]
    covered = [e.spans(np.flatnonzero(late))]
    rows = np.flatnonzero(~late)
    if not windows:
        return tuple(map(np.concatenate, zip(*covered, strict=True))), rows
    _, group, number = np.unique(e.hash[rows], return_inverse=True, return_counts=True)
    rows = rows[number[group] > 1]
    if len(rows):
        count = e.count[rows].astype(np.int64)
        owner = np.repeat(rows, count)
        step = ragged(np.zeros(len(rows), np.int64), count)
        away = e.away[owner].astype(np.int64) - step
        order = np.lexsort((away, e.hash[owner]))
        owner, step, away = owner[order], step[order], away[order]
        segment = np.cumsum(np.concatenate(([0], (away[1:] != away[:-1]) | (e.hash[owner][1:] != e.hash[owner][:-1]))))
        sorted_, new = _equal_windows(e, prefixes, e.at[owner] + step, segment)
        edges = np.flatnonzero(new)
        smallest = np.minimum.reduceat(e.doc[owner[sorted_]], edges)
        late = sorted_[e.doc[owner[sorted_]] > np.repeat(smallest, np.diff(np.append(edges, len(sorted_))))]
        start = e.start[owner[late]].astype(np.int64) + step[late]
        covered.append((e.doc[owner[late]], start, start + WINDOW))
    return tuple(map(np.concatenate, zip(*covered, strict=True))), rows


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a document as one, sorted."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # Documents are laid out one after another so that a running maximum never reaches into the next one.
    _, number = np.unique(doc, return_inverse=True)
    room = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * room)
    new = np.flatnonzero(np.concatenate(([True], start[1:] + number[1:] * room > reach[:-1])))
    last = np.append(new[1:], len(doc)) - 1
    return doc[new], start[new], reach[last] - number[last] * room


def _single(e: Entries) -> Entries:
    """Each window as a run of its own, with a hash of anchor, distance and bytes in place of the anchor's: equal windows still meet,
    those of one anchor no longer stay together."""
    count = e.count.astype(np.int64)
    owner = np.repeat(np.arange(len(count)), count)
    step = ragged(np.zeros(len(count), np.int64), count)
    at, away = e.at[owner] + step, e.away[owner].astype(np.int64) - step
    key = mix(Prefixes(e).hash(at, np.int64(WINDOW)) ^ mix(e.hash[owner] * np.uint64(256) + away.astype(np.uint64))) >> np.uint64(16)
    return Entries(e.data[ragged(at, np.full(len(at), WINDOW))], doc=e.doc[owner], hash=key, away=away, count=np.ones(len(at)),
                   start=e.start[owner] + step)


def _dealt(e: Entries, hot: np.ndarray) -> tuple[list[tuple[np.ndarray, ...]], Entries]:
    """The windows of hot anchors one by one, the runs of others as they are; spans of windows that a smaller document here has."""
    is_hot = np.isin(e.hash, hot)
    rows = np.flatnonzero(is_hot)
    if not len(rows):
        return [], e
    rows = rows[np.argsort(e.hash[rows], kind="stable")]
    part = np.cumsum(e.count[rows].astype(np.int64) * WINDOW) // PIECE
    spans, parts = [], [e.take(np.flatnonzero(~is_hot))]
    for own in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
        single = _single(e.take(own))
        found, left = resolve(single, windows=False)
        spans.append(found)
        parts.append(single.take(left))
    return spans, Entries.joined(parts)


def _told(spans: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    doc, start, end = merged(*spans)
    for k in range(0, len(doc), 100_000):
        part = slice(k, k + 100_000)
        yield pa.RecordBatch.from_pydict({"id": doc[part], "start": start[part], "end": end[part]})


AROUND = "bucket int, sure boolean, docs binary, times binary, hash binary, away binary, count binary, start binary, data binary"
AROUND_ARROW = pa.schema([("bucket", pa.int32()), ("sure", pa.bool_()),
                          *[(c, pa.binary()) for c in ("docs", "times", "hash", "away", "count", "start", "data")]])


def _around(n_buckets: int, hot: np.ndarray):
    """Windows around shared anchors, by bucket; runs that a smaller document of the chunk has too are settled here. Those of ``hot``
    anchors go to the buckets of their own bytes."""
    def run(batches):
        for number, rows in enumerate(_chunks(batches)):
            texts = [r[1] for r in rows]
            a = Anchors(texts)
            keep = np.zeros(len(a.row), bool)
            edges = np.searchsorted(a.row, np.arange(len(rows) + 1))
            for k, r in enumerate(rows):
                own = slice(edges[k], edges[k + 1])
                keep[own] = np.isin(a.hash[own], np.array(r[2], np.uint64))
            kept = np.flatnonzero(keep)
            if not len(kept):
                continue
            data = np.frombuffer(b"".join(texts), np.uint8)
            sizes = np.array([len(t) for t in texts])
            begin = (np.cumsum(sizes) - sizes)[a.row[kept]]
            count = a.last[kept] - a.first[kept] + 1
            e = Entries(
                data[ragged(begin + a.first[kept], count + WINDOW - 1)], doc=np.array([r[0] for r in rows], np.int64)[a.row[kept]],
                hash=a.hash[kept], away=a.place[kept] - a.first[kept], count=count, start=a.first[kept])
            found, left = resolve(e, windows=False)
            more, e = _dealt(e.take(left), hot)
            doc, start, end = map(np.concatenate, zip(found, *more, strict=True))
            out = []
            if len(doc):
                doc, start, end = merged(doc, start, end)
                out.append({"bucket": (number + int(doc[0])) % n_buckets, "sure": True, **_counted(doc), "hash": b"", "away": b"", "count": b"",
                            "start": start.tobytes(), "data": end.tobytes()})
            bucket = (e.hash % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                out.append({"bucket": int(b), "sure": False, **e.take(order[edges[b]:edges[b + 1]]).packed()})
            yield pa.RecordBatch.from_pylist(out, AROUND_ARROW)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the spans of each document that a smaller one has as well."""
    for rows in _by_key(batches):
        found = [(_recounted(r[2], r[3]), np.frombuffer(r[7], np.int64), np.frombuffer(r[8], np.int64)) for r in rows if r[1]]
        if open_ := [r[2:] for r in rows if not r[1]]:
            found.append(resolve(Entries.read(open_))[0])
        yield from _told(tuple(map(np.concatenate, zip(*found, strict=True))))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, spans = [], []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for text, starts, ends in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            # Both lists are collected from the same rows, in the same order.
            _, start, end = merged(np.zeros(len(starts), np.int64), np.array(starts, np.int64), np.array(ends, np.int64))
            edges = [0, *np.stack([start, end], 1).reshape(-1).tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["id", "spans", "kept"])


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove from each document the bytes of every 50-byte string that also starts in a document with a smaller id.

    Texts count as UTF-8 bytes, whole; strings are judged on the input, matches never cross documents, overlaps count. Returns
    per id: n_bytes, spans (maximal removed runs as an array of start and end, end exclusive), kept (the bytes left), and
    kept_sha256. ``kept`` is null where nothing is removed: the document stays as it is.

    Copies of a whole text are settled by its hash. Of the others, only anchors are sent by hash, some 9 bytes for each 18 bytes
    of text; then the surroundings of shared anchors alone. Texts are shuffled twice, each time only those with something shared
    (all of them where these ids are too many to broadcast). What a chunk of 8 MB can settle itself it sends once, so a string
    common to all documents costs a row for each chunk. An anchor of more than HOT documents doesn't hold its runs together: each
    of its windows goes by its own bytes, so its differing surroundings are spread over all buckets.

    A null or empty text has no bytes; rows that repeat an id must repeat its text and give one row; ids are whole numbers, rows
    without one are left out; an empty table gives no rows; other columns are not read. Eager.
    """
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    narrow = saved(rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "texts")
    least = narrow.groupBy("sha").agg(F.min("id").alias("first"))
    known = saved(narrow.join(least, "sha").dropDuplicates(["id"]), "known")
    copies = saved(known.filter("id != first").select(F.col("id").alias("x")), "copies")
    total = known.filter("id = first").agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = max(1, -(-total // BUCKET))
    texts = rows.filter(F.octet_length("text") >= WINDOW).join(small(copies), F.col("id") == F.col("x"), "left_anti")

    dealt = texts.mapInArrow(_place(n_buckets), PLACED).repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    shared = saved(dealt.mapInArrow(_find_shared, "id long, hash long"), "shared")
    wanted = shared.groupBy(F.col("id").alias("x")).agg(F.collect_list("hash").alias("anchors"))
    hot = shared.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("hash").collect()
    hot = np.sort(np.array([r["hash"] for r in hot], np.int64)).astype(np.uint64)
    some = texts.join(small(saved(shared.select(F.col("id").alias("y")).distinct(), "wanted")), F.col("id") == F.col("y"), "left_semi")
    around = some.join(wanted, F.col("id") == F.col("x")).select("id", "text", "anchors").mapInArrow(_around(n_buckets, hot), AROUND)
    spans = saved(around.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_settle, "id long, start long, end long"), "spans")

    removed = spans.groupBy(F.col("id").alias("x")).agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    some = texts.join(small(saved(spans.select(F.col("id").alias("y")).distinct(), "cut")), F.col("id") == F.col("y"), "left_semi")
    kind = "array<struct<start:bigint,end:bigint>>"
    cut = some.join(removed, F.col("id") == F.col("x")).select("id", "text", "starts", "ends").mapInArrow(_cut, f"id long, spans {kind}, kept binary")
    cut = cut.select(F.col("id").alias("c_id"), "spans", "kept")
    copied = (F.col("id") != F.col("first")) & (F.col("n_bytes") >= WINDOW)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return known.join(cut.dropDuplicates(["c_id"]), F.col("id") == F.col("c_id"), "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(copied, whole).otherwise(F.coalesce("spans", F.array().cast(kind))).alias("spans"),
        F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(copied, nothing).when(F.col("kept").isNotNull(), F.sha2("kept", 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
