"""Near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running, saved, small
from .groups import components
from .words import grouped, mix, pack, shingle_sets, unpack

SLOTS = 128
# 32 bands of 4 slots: two sets with a likeness of 0.75 share no band once in 190,000 cases.
BAND = 4
# Sketches agreeing in fewer of their slots than this are not compared in full: four standard deviations below 0.75.
LOOSE = 0.60
# Members of a bucket whose sketches are compared in one place, and shingles of a cluster compared in full there.
BLOCK, CELL = 2048, 400_000


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: one row of ``slots`` values for each set (all ones for an empty one).

    Each element draws a random permutation of the slots step by step; at step j it offers the rank j with a random fraction to its
    j-th slot, and a slot keeps the smallest offer. As later ranks are larger, a set is finished with the first step that leaves
    none of its slots empty. All elements of all sets take a step together.
    """
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    if not sets:
        return out
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = out.reshape(-1)
    order = None
    for j in range(slots):
        if not len(element):
            break
        drawn = mix(element ^ mix(np.full(1, j + 1, np.uint64)))
        offer = (np.uint64(j) << np.uint64(56)) | (drawn >> np.uint64(8))
        turn = (j + (mix(drawn) >> np.uint64(32)) % np.uint64(slots - j)).astype(np.int64)
        if j == 0:
            slot = turn
        else:
            row = np.arange(len(element))
            slot = order[row, turn].astype(np.int64)
            order[row, turn] = order[:, j]
        np.minimum.at(flat, owner * slots + slot, offer)
        open_ = (out == np.iinfo(np.uint64).max).any(1)[owner]
        element, owner = element[open_], owner[open_]
        if j == 0:
            # Only sets that go on need to remember their permutations.
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(element), 1))
            row, first = np.arange(len(element)), slot[open_]
            order[row, first] = 0
        else:
            order = order[open_]
    return out


def bands(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key for each band, different for equal values in different bands."""
    n, slots = signature.shape
    steps = mix(np.arange(slots, dtype=np.uint64)) | np.uint64(1)
    sums = (signature * steps).reshape(n, slots // band, band).sum(2, dtype=np.uint64)
    return mix(sums + mix(np.arange(slots // band, dtype=np.uint64))).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        ids = batch.column(0)
        for first, group in grouped(texts):
            sets = shingle_sets(group)
            values = signatures(sets)
            keys = bands(values)
            yield pa.RecordBatch.from_pydict({
                "id": ids.slice(first, len(group)), "n": pa.array([len(s) for s in sets], pa.int64()),
                "same": pa.array([hashlib.blake2b(pack(s), digest_size=16).digest() for s in sets], pa.binary()),
                "bands": pa.array(list(keys), pa.list_(pa.int64())),
                "sketch": pa.array([r.tobytes() for r in (mix(values) & np.uint64(255)).astype(np.uint8)], pa.binary()),
            })


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, group in grouped(batch.column(1).cast(pa.binary()).to_pylist()):
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0).slice(first, len(group)), "shingles": pa.array([pack(s) for s in shingle_sets(group)], pa.binary())})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links whose full sets are alike: 100 * intersection >= 75 * union."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = unpack(x), unpack(y)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= 75 * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each cell (first column), in a partition sorted by it."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


class _Labels:
    """Union-find over the groups of some rows, kept as the current root of each row."""

    def __init__(self, labels: list[int]):
        self.root = np.array(labels)
        self.joined: list[tuple[int, int]] = []

    def join(self, row: int, others: np.ndarray) -> None:
        for other in np.unique(self.root[others]):
            if other != self.root[row]:
                low, high = sorted((int(other), int(self.root[row])))
                self.root[self.root == high] = low
                self.joined.append((low, high))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())})


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, label, side, sketch): which groups of a cell are held together by similar sketches, as a forest of their labels."""
    for rows in _by_cell(batches):
        groups = _Labels([r[1] for r in rows])
        side = np.array([r[2] for r in rows])
        sketch = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), SLOTS)
        names, counts = np.unique(groups.root, return_counts=True)
        crossed = side.min() != side.max()
        # Rows of the largest group need no look of their own: every other row is held against all rows of other groups.
        for i in np.flatnonzero(groups.root != names[counts.argmax()]):
            other = groups.root != groups.root[i]
            if crossed:
                other &= side != side[i]
            near = np.flatnonzero(other)
            groups.join(i, near[(sketch[near] == sketch[i]).sum(1) >= LOOSE * SLOTS])
        if groups.joined:
            yield _pairs(groups.joined)


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each one on the right: frequent elements by a matrix product, others in pairs."""
    sizes = [len(s) for s in [*left, *right]]
    _, element, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(left), len(right)), np.float32)
    frequent = np.flatnonzero(times > 32)
    for at in range(0, len(frequent), 1024):
        column = np.full(len(times), -1)
        column[frequent[at:at + 1024]] = np.arange(len(frequent[at:at + 1024]))
        inside = column[element] >= 0
        held = np.zeros((len(sizes), len(frequent[at:at + 1024])), np.float32)
        held[owner[inside], column[element[inside]]] = 1
        out += held[:len(left)] @ held[len(left):].T
    some = (times[element] > 1) & (times[element] <= 32)
    order = np.argsort(element[some], kind="stable")
    element, owner = element[some][order], owner[some][order]
    a, b = owner < len(left), owner >= len(left)
    first = np.searchsorted(element[b], element[a], side="left")
    count = np.searchsorted(element[b], element[a], side="right") - first
    each = np.repeat(np.arange(len(first)), count)
    partner = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + first[each]
    np.add.at(out, (owner[a][each], owner[b][partner] - len(left)), 1)
    return np.rint(out).astype(np.int64)


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, label, side, shingles): which groups of a cell are linked by full sets, as a forest of their labels."""
    for rows in _by_cell(batches):
        sides = sorted({r[2] for r in rows})
        left = [k for k, r in enumerate(rows) if r[2] == sides[0]]
        right = [k for k, r in enumerate(rows) if r[2] == sides[-1]]
        groups = _Labels([r[1] for r in rows])
        sets = [unpack(r[3]) for r in rows]
        sizes = np.array([len(s) for s in sets])
        both = common_counts([sets[k] for k in left], [sets[k] for k in right])
        linked = 100 * both >= 75 * (sizes[left][:, None] + sizes[right][None, :] - both)
        for k, row in enumerate(left):
            groups.join(row, np.array(right)[linked[k]])
        if groups.joined:
            yield _pairs(groups.joined)


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles) of the ids (column x), made again from their texts."""
    texts = docs.join(small(ids), F.col("id") == F.col("x"), "left_semi")
    return saved(texts.select("id", "text").mapInArrow(_sets, "id long, shingles binary"), "sets").dropDuplicates(["id"])


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that hold on full sets."""
    needed = saved(pairs.select(F.col("a").alias("x")).union(pairs.select("b")).distinct(), "needed")
    sets = _sets_of(docs, needed)
    left = pairs.join(sets.select(F.col("id").alias("ia"), F.col("shingles").alias("sa")), F.col("a") == F.col("ia"))
    right = left.join(sets.select(F.col("id").alias("ib"), F.col("shingles").alias("sb")), F.col("b") == F.col("ib"))
    return saved(right.select("a", "b", "sa", "sb").mapInArrow(_verify, "a long, b long"), "verified")


def _between(docs: DataFrame, reps: DataFrame, groups: DataFrame, alike: DataFrame) -> DataFrame:
    """Links between groups (label pairs a, b), found by full comparison within clusters of groups with similar sketches.

    A cluster's sets, sorted by group, are cut into blocks of bounded size; each two blocks meet in one cell unless both are of one
    and the same group.
    """
    cluster = components(alike)
    clusters = saved(cluster.union(cluster.select("root", "root")).distinct().select(F.col("node").alias("l"), F.col("root").alias("c")), "clusters")
    label = reps.select("id", "n").join(groups, F.col("id") == F.col("node"), "left").select("id", "n", F.coalesce("root", "id").alias("label"))
    placed = label.join(clusters, F.col("label") == F.col("l")).select("c", "label", "id", (F.col("n") + CELL // BLOCK).alias("size"))
    blocks = saved(running(saved(placed, "placed"), ["label", "id"], "size", ["c"]).select(
        "c", "label", "id", F.floor(F.col("start") / CELL).alias("block")), "blocks")
    ends = blocks.groupBy("c", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    other = ends.select("c", F.col("block").alias("with"), F.col("low").alias("low_2"), F.col("high").alias("high_2"))
    met = ends.join(other, "c").filter((F.col("block") <= F.col("with")) & (F.least("low", "low_2") != F.greatest("high", "high_2")))
    met = met.select(F.col("c").alias("mc"), F.xxhash64("c", "block", "with").alias("cell"),
                     F.explode(F.array_distinct(F.array("block", "with"))).alias("side"))
    rows = blocks.join(met, (F.col("c") == F.col("mc")) & (F.col("block") == F.col("side"))).select("cell", "label", "side", F.col("id").alias("d"))
    sets = _sets_of(docs, saved(blocks.select(F.col("id").alias("x")), "inside"))
    cells = rows.join(sets, F.col("d") == F.col("id")).select("cell", "label", "side", "shingles")
    return saved(cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_exact, "a long, b long"), "between")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose sets of 5-word shingles have a Jaccard likeness of 0.75 or more, directly or by steps.

    Equal sets count once, through the smallest id. Sets that share a band are candidates. First each set is held against the
    smallest member of its buckets, and the best of these links is verified on full sets; groups arise. Buckets that still hold
    different groups compare their members' sketches, in blocks; groups with similar ones form clusters. Inside a cluster all sets
    of different groups are compared in full, again in blocks. So no pair that shares a band is left out, while each step
    emits a forest of groups at most, never pairs of documents.

    Returns per id: n_shingles, component_id (smallest id reachable, itself included), kept (it is that id). A null or empty text
    has an empty set and is linked with nothing. Ids are whole numbers; rows that repeat an id give one row (texts that differ
    under one id are linked through it); rows without an id are left out; an empty table gives no rows; other columns are not
    read. Eager.
    """
    docs = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    every = saved(docs.mapInArrow(_sketch, "id long, n long, same binary, bands array<long>, sketch binary"), "sketches")
    least = saved(every.filter("n > 0").groupBy("same").agg(F.min("id").alias("rep")), "classes")
    reps = saved(every.join(least.select("rep"), F.col("id") == F.col("rep"), "left_semi").filter("n > 0").dropDuplicates(["id"])
                 .select("id", "n", "bands", "sketch"), "reps")
    placed = reps.select("id", F.explode("bands").alias("h"))
    met = placed.groupBy(F.col("h").alias("k")).agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first != last")
    members = saved(placed.join(met, F.col("h") == F.col("k")).select("h", "id", "first"), "buckets")
    stars = members.filter("id != first").groupBy("id", "first").agg(F.count(F.lit(1)).alias("shared"))
    best = stars.groupBy(F.col("id").alias("b")).agg(F.max(F.struct("shared", (-F.col("first")).alias("back"))).alias("m")).select(
        (-F.col("m.back")).alias("a"), "b")
    links = _verified(docs, saved(best, "stars"))
    groups = components(links)

    label = F.coalesce("root", "id")
    held = members.select("h", "id").join(groups, F.col("id") == F.col("node"), "left").select("h", "id", label.alias("label"))
    held = saved(held, "labelled")
    mixed = held.groupBy(F.col("h").alias("k")).agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"), F.count(F.lit(1)).alias("n")).filter("l0 != l1")
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("id"), blocks)
    # A bucket of several blocks: each row goes to the cells (own, j) and (i, own), so that any two blocks meet in one cell.
    met_again = held.join(mixed, F.col("h") == F.col("k")).select("h", "id", "label", own.alias("own"), blocks.alias("blocks"))
    spread = met_again.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        F.xxhash64("h", F.least("own", "j"), F.greatest("own", "j")).alias("cell"), "id", "label", "own")
    sketches = reps.select(F.col("id").alias("ia"), "sketch")
    cells = spread.join(sketches, F.col("id") == F.col("ia")).select("cell", "label", "own", "sketch")
    alike = saved(cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_alike, "a long, b long").distinct(), "alike")
    if not alike.isEmpty():
        groups = components(links.union(_between(docs, reps, groups, alike)))
    classed = every.select("id", "n", "same").join(least, "same", "left")
    return (
        classed.join(groups, F.col("rep") == F.col("node"), "left")
        .groupBy("id").agg(F.max("n").alias("n_shingles"), F.min(F.coalesce("root", "rep", "id")).alias("component_id"))
        .select(F.col("id").alias(id_col), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    )
