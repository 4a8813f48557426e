"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters, each pair verified once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running, saved, small
from .groups import components
from .minhash import _by_cell as by_cell, _Labels as Labels, _pairs as pairs_of, common_counts
from .words import mix, wide_sets

# Cells of a suffix count; rows of a bucket that meet in one place; rounds in which a bucket's rows are held against one of them.
CELLS, BLOCK, ROUNDS = 128, 1024, 3
# Shingles of a block of whole sets.
ROOM = 400_000


def _needed(n: Column, percent: int) -> Column:
    """Shingles of a set of n that any set linked with it must share."""
    return F.ceil(n * percent / F.lit(100.0)).cast("long")


def _spare(n):
    """How many shared shingles beyond the first one the hash-ordered prefix makes sure of: one in twenty."""
    return n // 20


def _sets(percent: int):
    """Texts to (id, n, digest of the set, its hash-ordered prefix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = wide_sets([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])
            heads = [s[:len(s) - -(-len(s) * percent // 100) + 1 + _spare(len(s))].view(np.int64) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0), "n": pa.array([len(s) for s in sets], pa.int64()),
                "same": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "head": pa.array(heads, pa.list_(pa.int64())),
            })

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (id, n, digest, sorted shingles, how many of them fall into each cell, up to 255)."""
    for batch in batches:
        sets = wide_sets([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])
        cells = [np.minimum(np.bincount((mix(s) >> np.uint64(57)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes() for s in sets]
        yield pa.RecordBatch.from_pydict({
            "id": batch.column(0), "n": pa.array([len(s) for s in sets], pa.int64()),
            "same": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
            "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), "cells": pa.array(cells, pa.binary())})


def _two_by_two(linked):
    """Rows (a, b, x, n, value), the two of a pair one after the other: the pairs with what ``linked(n, value, m, other)`` says of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first = None, ()
        for batch in batches:
            out = []
            for k, (*pair, n) in enumerate(zip(*[batch.column(c).to_pylist() for c in (0, 1, 3)], strict=True)):
                if pair == before:
                    out.append((*pair, bool(linked(*first, n, batch.column(4)[k]))))
                before, first = pair, (n, batch.column(4)[k])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["a", "b", "linked"])

    return run


def _suffix_allows(percent: int):
    """What two sets hold apart in any cell they cannot share."""
    def linked(n, cells, m, other):
        x, y = (np.frombuffer(c.as_py(), np.uint8).astype(np.int64) for c in (cells, other))
        return n + m - int(np.abs(x - y).sum()) >= 2 * -(-percent * (n + m) // (100 + percent))

    return linked


def _alike(percent: int):
    def linked(n, shingles, m, other):
        both = len(np.intersect1d(shingles.values.to_numpy(), other.values.to_numpy(), assume_unique=True))
        return 100 * both >= percent * (n + m - both)

    return linked


def _candidates(percent: int):
    """Rows (cell, label, side, n, at, cells): which groups of a cell hold sets that length, place in the prefix and counts allow to be
    linked, as a forest of their labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_cell(batches):
            groups = Labels([r[1] for r in rows])
            side, n, at = (np.array([r[k] for r in rows], np.int64) for k in range(2, 5))
            cells = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), CELLS).astype(np.int16)
            crossed = side.min() != side.max()
            for i in range(len(rows)):
                j = np.flatnonzero((side != side[i]) & (side > side[i]) if crossed else np.arange(len(rows)) > i)
                j = j[groups.root[j] != groups.root[i]]
                # Length: one set can't be longer than 100/percent of the other.
                j = j[(100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
                # Shared shingles that a link needs: percent * (n + m) / (100 + percent).
                need = -(-percent * (n[j] + n[i]) // (100 + percent))
                # Place: up to this shingle both share at most as many as stand before it, from there what the shorter rest holds.
                most = np.minimum(at[j], at[i]) + np.minimum(n[j] - at[j], n[i] - at[i])
                j, need = j[most >= need], need[most >= need]
                # Suffix: what two sets hold apart in any cell they cannot share.
                apart = np.abs(cells[j] - cells[i]).sum(1)
                j = j[n[j] + n[i] - apart >= 2 * need]
                groups.join(i, j)
            if groups.joined:
                yield pairs_of(groups.joined)

    return run


def _sets_by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """As ``by_cell`` for rows (cell, label, side, shingles), with the shingles as arrays."""
    held: list[tuple] = []
    for batch in batches:
        for k, row in enumerate(zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True)):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append((*row, batch.column(3)[k].values.to_numpy()))
    if held:
        yield held


def _compared(percent: int):
    """Rows (cell, label, side, shingles): which groups of a cell are linked by whole sets, as a forest of their labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _sets_by_cell(batches):
            side = np.array([r[2] for r in rows])
            left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
            groups, sets = Labels([r[1] for r in rows]), [r[3] for r in rows]
            sizes = np.array([len(s) for s in sets])
            both = common_counts([sets[k] for k in left], [sets[k] for k in right])
            linked = 100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both)
            for k, row in enumerate(left):
                groups.join(row, right[linked[k]])
            if groups.joined:
                yield pairs_of(groups.joined)

    return run


def _told(pairs: DataFrame, sets: DataFrame, column: str, linked) -> DataFrame:
    """The pairs (a, b) with what ``linked`` says of the column of both their sets, brought together in one shuffle."""
    ends = saved(pairs.select("a", "b", F.explode(F.array("a", "b")).alias("x")), "pairs")
    rows = sets.select("id", "n", column).join(small(ends), F.col("id") == F.col("x")).select("a", "b", "x", "n", column)
    met = rows.repartition("a", "b").sortWithinPartitions("a", "b")
    return saved(met.mapInArrow(_two_by_two(linked), "a long, b long, linked boolean"), "told")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with whether they are linked: by their cells, and where these allow it by their whole sets. Each pair stands once."""
    allowed = _told(pairs, sets, "cells", _suffix_allows(percent))
    whole = _told(allowed.filter("linked").select("a", "b"), sets, "shingles", _alike(percent))
    return allowed.filter("NOT linked").union(whole)


def _possible(every: DataFrame, percent: int) -> DataFrame:
    """Ids (x) of sets that may have a partner: enough of their hash-ordered prefix stands in another set's prefix, too.

    Of what linked sets share, 1 + n/20 shingles of the shorter one at least stand in both prefixes. So prefixes alone tell which sets
    are out, which most are, before whole sets are shuffled.
    """
    heads = every.select("id", "n", F.explode("head").alias("h"))
    # Stored, here and below: a join whose sides come straight from a shuffle can be split where a key is hot.
    met = saved(heads.groupBy(F.col("h").alias("k")).agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("k"), "met")
    shared = heads.join(met, F.col("h") == F.col("k"), "left_semi").groupBy("id").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("shared"))
    least = 1 + F.floor(_needed(F.col("n"), percent) / 20)
    return saved(shared.filter(F.col("shared") >= least).select(F.col("id").alias("x")), "possible")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Rare-first prefixes: (h, id, n, at), a row for each shingle of a prefix that another set has, too; ``at``: how many stand before it.

    All shingles are ordered by the number of sets that hold them. What no other set holds comes first and needs no row.
    """
    rows = sets.select("id", "n", F.explode("shingles").alias("h"))
    spread = saved(rows.groupBy(F.col("h").alias("k")).agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "spread")
    known = rows.join(spread, F.col("h") == F.col("k")).groupBy("id").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    length = (F.col("n") - _needed(F.col("n"), percent) + 1 - alone).cast("int")
    cut = known.filter(length > 0).select("id", "n", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), length)).alias("k", "s"))
    return saved(cut.select(F.col("s.h").alias("h"), "id", "n", (F.col("alone") + F.col("k")).alias("at")), "prefixes")


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Prefix rows with the group of their set, of buckets only that hold several groups."""
    known = rows.select("h", "id", "n", "at").join(small(saved(groups, "groups")), F.col("id") == F.col("node"), "left").withColumn(
        "label", F.coalesce("root", "id")).drop("node", "root")
    mixed = known.groupBy(F.col("h").alias("k")).agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 != l1")
    return saved(known.join(small(saved(mixed.select("k"), "several")), F.col("h") == F.col("k"), "left_semi"), "mixed")


def _stars(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b): each set with one centre of its buckets, where length and place allow a link: the one it shares most buckets with.

    The centre of a bucket is another row each turn.
    """
    centre = F.struct("id", "n", "at", "label")
    pick = F.min(F.struct("id", "n", "at", "label")) if turn == 0 else F.min_by(centre, F.xxhash64("id", F.lit(turn)))
    centres = saved(rows.groupBy(F.col("h").alias("k")).agg(pick.alias("c"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size"), "centres")
    met = rows.join(small(centres), F.col("h") == F.col("k"))
    need = F.ceil(percent * (F.col("n") + F.col("c.n")) / F.lit(100.0 + percent))
    most = F.least("at", "c.at") + F.least(F.col("n") - F.col("at"), F.col("c.n") - F.col("c.at"))
    long_enough = 100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")
    near = met.filter((F.col("label") != F.col("c.label")) & long_enough & (most >= need)).select("id", F.col("c.id").alias("with"))
    counted = near.groupBy("id", "with").agg(F.count(F.lit(1)).alias("shared"))
    best = counted.groupBy("id").agg(F.max_by("with", F.struct("shared", "with")).alias("with"))
    return best.select(F.least("id", "with").alias("a"), F.greatest("id", "with").alias("b")).distinct()


def _blocks(rows: DataFrame, by: str, block: Column, size: str | None, percent: int) -> DataFrame:
    """Rows (cell, side, …): the rows (label, id, n, …) of a key in the order of n and id are cut in blocks; two blocks whose lengths
    allow a link meet in a cell unless all their rows are of one group. A row comes once for each block that its own meets."""
    placed = saved(running(rows, ["n", "id"], size, [by]).withColumn("block", block), "blocks")
    ends = saved(placed.groupBy(F.col(by).alias("b"), "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("label").alias("l0"), F.max("label").alias("l1")), "ends")
    other = ends.select(F.col("b").alias("b2"), F.col("block").alias("with"), F.col("low").alias("low2"), F.col("l0").alias("m0"), F.col("l1").alias("m1"))
    met = ends.join(other, (F.col("b") == F.col("b2")) & (F.col("block") <= F.col("with"))).filter(
        (100 * F.col("high") >= percent * F.col("low2")) & (F.least("l0", "m0") != F.greatest("l1", "m1")))
    met = saved(met.select("b", F.xxhash64("b", "block", "with").alias("cell"), F.explode(F.array_distinct(F.array("block", "with"))).alias("side")), "met")
    return placed.join(met, (F.col(by) == F.col("b")) & (F.col("block") == F.col("side")))


def _rest(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (label pairs a, b) between groups whose sets share a bucket and pass all filters there.

    Such groups form clusters; inside a cluster whole sets are compared, each pair in the one cell where its blocks meet. What is
    handed on is a forest of groups, never pairs of sets.
    """
    own = _blocks(rows, "h", F.floor(F.col("index") / BLOCK), None, percent).select("cell", "label", "side", "id", "n", "at")
    cells = own.join(sets.select(F.col("id").alias("i"), "cells"), F.col("id") == F.col("i")).select("cell", "label", "side", "n", "at", "cells")
    alike = saved(cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_candidates(percent), "a long, b long").distinct(), "alike")
    if alike.isEmpty():
        return alike
    cluster = components(alike)
    clusters = saved(cluster.union(cluster.select("root", "root")).distinct().select(F.col("node").alias("l"), F.col("root").alias("c")), "clusters")
    inside = saved(rows.select("id", "n", "label").distinct().join(clusters, F.col("label") == F.col("l")).select(
        "c", "label", "id", "n", (F.col("n") + ROOM // BLOCK).alias("size")), "inside")
    cells = _blocks(inside, "c", F.floor(F.col("start") / ROOM), "size", percent).select("cell", "label", "side", "id")
    needed = sets.join(small(inside.select(F.col("id").alias("x"))), F.col("id") == F.col("x"), "left_semi").select(F.col("id").alias("i"), "shingles")
    whole = cells.join(needed, F.col("id") == F.col("i")).select("cell", "label", "side", "shingles")
    return saved(whole.repartition("cell").sortWithinPartitions("cell").mapInArrow(_compared(percent), "a long, b long"), "between")


def jaccard_groups(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents linked, directly or by steps, by 100 * common >= percent * all of their distinct 5-word shingles.

    Words are parted by space and tab to carriage return, A-Z lower-cased; of fewer than five words the whole sequence is the one
    shingle. Equal sets stand for one, their smallest id. Sets that cannot have a partner go by prefixes in the order of their
    hashes. The shingles of those left are ordered by the number of sets that hold them, rarest first: linked sets share one of their
    first n - ceil(percent * n / 100) + 1. On these prefix shingles sets are joined, pairs pass the length, positional and suffix
    filters, and pairs are verified on whole sets. A bucket's sets first meet one of them, three times another; what is linked then
    need not meet again. Of the buckets that still hold several groups all pairs of different groups are filtered, in blocks; groups
    with a pair that passes form clusters, and inside a cluster each such pair is verified once, in blocks again. So a large group of copies costs rows in
    proportion to its members, and no step hands on pairs of a group. A cluster of many sets that stay apart is compared in blocks
    of neighbouring lengths, whose number grows with its square.

    Returns per id: n_shingles, component_id (smallest id reachable, itself included). A null or empty text has an empty set and is
    linked with nothing. Ids are whole numbers; rows that repeat an id give one row (of texts that differ the one with most shingles
    counts, then the one with the greater digest); rows without an id are left out; an empty table gives no rows; other columns are
    not read. Shingles are compared as 64-bit hashes. Eager.
    """
    docs = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    every = saved(docs.mapInArrow(_sets(percent), "id long, n long, same binary, head array<long>"), "heads")
    again = saved(every.groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("n", "same")).alias("m")).filter("k > 1").select(
        F.col("id").alias("x"), F.col("m.same").alias("s")), "again")
    repeated = not again.isEmpty()

    def once(rows: DataFrame) -> DataFrame:
        """One row for each id."""
        if not repeated:
            return rows
        return rows.join(small(again), F.col("id") == F.col("x"), "left").filter("x IS NULL OR same = s").drop("x", "s").dropDuplicates(["id"])

    every = once(every)
    every_set = every.filter("n > 0")
    classes = saved(every_set.groupBy("same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("members")), "classes")
    # The copies are named, not the sets that stay: these are most rows, and a join with them would shuffle the prefixes of all.
    several = small(classes.filter("members > 1").select("same", "rep"))
    copies = saved(every_set.select("id", "same").join(several, "same").filter("id != rep").select(F.col("id").alias("x")), "copies")
    reps = every_set.join(small(copies), F.col("id") == F.col("x"), "left_anti")
    possible = _possible(reps, percent)
    texts = docs.join(small(possible), F.col("id") == F.col("x"), "left_semi")
    sets = saved(once(texts.mapInArrow(_whole, "id long, n long, same binary, shingles array<long>, cells binary")).drop("same"), "sets")
    prefixes = _prefixes(sets, percent)

    tried, links, groups = None, None, None
    rows = prefixes.withColumn("label", F.col("id"))
    for turn in range(ROUNDS + 1):
        if groups is not None:
            # A bucket of one group stays one: later turns go on from what this one leaves.
            rows = _labelled(rows, groups)
        if rows.isEmpty():
            break
        if turn < ROUNDS:
            pairs = _stars(rows, turn, percent)
            if tried is not None:
                pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
            checked = _verified(pairs, sets, percent)
            tried = checked if tried is None else tried.union(checked)
            links = tried.filter("linked").select("a", "b")
        else:
            more = _rest(rows, sets, percent)
            if more.isEmpty():
                break
            links = more if links is None else links.union(more)
        groups = components(links)
    classed = every.select("id", "n", "same").join(classes.select("same", "rep"), "same", "left")
    if groups is None:
        groups = docs.sparkSession.createDataFrame([], "node long, root long")
    return (
        classed.join(groups, F.col("rep") == F.col("node"), "left")
        .groupBy("id").agg(F.max("n").alias("n_shingles"), F.min(F.coalesce("root", "rep", "id")).alias("component_id"))
        .select(F.col("id").alias(id_col), "n_shingles", "component_id")
    )
