"""Prefix trie of conversations: Euler tour of the nodes, ranked as a linked list, subtree figures from prefix sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small

# A list of up to this many arcs is ranked in one place; of a longer one every SPAN-th arc, by hash, is a ruler.
ALONE, SPAN = 20_000, 16
# Bytes of the pieces in which the members of a node are put together.
PIECE = 1 << 16


def prefix_sums(rows: DataFrame, order: list[str], sums: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Add to each row the sums of the given whole numbers over it and all rows before it, in all or per ``by``.

    Rows are sorted into range partitions; a window adds up inside each, and the totals of earlier partitions come from one row per
    partition and key. So a key may have any number of rows. Rows equal in ``order`` stand in an arbitrary, but fixed order. Eager.
    """
    by = by or []
    placed = saved(
        rows.repartitionByRange(*[F.col(c) for c in [*by, *order]]).withColumns({
            "_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id(), **{f"_v_{n}": c for n, c in sums.items()}}),
        "placed")
    totals = placed.groupBy("_part", *by).agg(*[F.sum(f"_v_{n}").alias(n) for n in sums])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_b_{c}") for c in by], *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy("_part", *by).orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, 0)
    counted = placed.withColumns({f"_s_{n}": F.sum(f"_v_{n}").over(inside) for n in sums})
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return counted.join(offsets, same).select(*rows.columns, *[(F.col(f"_s_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums])


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, at, mark, chars): each turn with its place in its conversation from 1, a digest of role and text, and the text's length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    mark = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), mark.alias("mark"), F.length(text).cast("long").alias("chars"))
    return prefix_sums(rows, ["turn", "mark"], {"at": F.lit(1).cast("long")}, ["conv"]).select("conv", "at", "mark", "chars")


def share_heads(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Rebuild each conversation c: the first h turns of conversation c - c % block, then its own after its first h; h = crc32(c) % most.

    Takes and returns rows (conv, at, mark, chars). All turns of a base that is shorter, none of one that is absent. A conversation
    that keeps no turn gives one row with at = 0.
    """
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = saved(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("length")), "lengths")
    bases = convs.select(F.col("conv").alias("base"), F.col("length").alias("there"))
    plan = convs.withColumns({"h": head, "wanted": F.col("conv") - F.col("conv") % block}).join(
        bases, F.col("wanted") == F.col("base"), "left").select(
        F.col("conv").alias("c"), "base", "length", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"))
    plan = saved(plan, "plan")
    first = turns.filter(F.col("at") < most)
    heads = plan.filter("taken > 0").join(first, (F.col("base") == F.col("conv")) & (F.col("at") <= F.col("taken"))).select(
        F.col("c").alias("conv"), "at", "mark", "chars")
    own = turns.join(plan.select("c", "h", "taken"), F.col("conv") == F.col("c")).filter("at > h").select(
        "conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "mark", "chars")
    bare = plan.filter("taken = 0 AND length <= h").select(F.col("c").alias("conv"), F.lit(0).cast("long").alias("at"), F.lit("").alias("mark"), F.lit(0).cast("long").alias("chars"))
    return heads.unionByName(own).unionByName(bare)


def _nodes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes (conv, depth, up, n, chars) and who ends where (conv, depth, member), from rows (conv, at, mark, chars).

    A prefix is known by its depth and the sums of 32-bit numbers drawn from each of its turns and its place, 160 bits in all, so that
    prefixes of a conversation of any length come from distributed sums. That a node's members agree on their last turn and on the
    prefix before it is checked; with that, by induction, equal sums mean equal prefixes.
    """
    drawn = F.sha2(F.concat(F.col("at").cast("string"), F.lit(":"), F.col("mark")).cast("binary"), 256)
    parts = {f"k{i}": F.when(F.col("at") > 0, F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(5)}
    summed = prefix_sums(turns, ["at"], parts, ["conv"])
    key = [f"k{i}" for i in range(5)]
    name = F.concat_ws(".", "at", *key)
    before = F.concat_ws(".", F.col("at") - 1, *[F.col(k) - c for k, c in zip(key, parts.values(), strict=True)])
    paths = saved(summed.select("conv", "at", "mark", "chars", F.md5(name.cast("binary")).alias("node"), F.md5(before.cast("binary")).alias("before")), "paths")
    found = paths.filter("at > 0").groupBy("node").agg(
        F.min("conv").alias("conv"), F.first("at").alias("depth"), F.count(F.lit(1)).alias("n"), F.first("chars").alias("chars"),
        F.min("before").alias("up"), (F.min("before") != F.max("before")).alias("torn_up"), (F.min("mark") != F.max("mark")).alias("torn"))
    checked = found.withColumn("n", F.when(F.col("torn") | F.col("torn_up"), F.raise_error(F.lit("two prefixes have one name"))).otherwise(F.col("n")).cast("long"))
    root = paths.agg(F.min("conv").alias("conv"), F.count_if(F.col("at") <= 1).alias("n")).filter("conv IS NOT NULL").select(
        F.md5(F.concat_ws(".", F.lit(0), *[F.lit(0)] * 5).cast("binary")).alias("node"), "conv", F.lit(0).cast("long").alias("depth"), "n", F.lit(0).cast("long").alias("chars"), F.lit(None).cast("string").alias("up"))
    nodes = saved(checked.select("node", "conv", "depth", "n", "chars", "up").unionByName(root), "nodes")
    last = paths.groupBy("conv").agg(F.max_by("node", "at").alias("node"))
    return nodes, last


def _arcs(nodes: DataFrame) -> DataFrame:
    """The Euler tour as a linked list (arc, next, place): 2 * number for a node's enter arc, one more for its exit arc.

    A node is entered, then its children by their smallest members; its exit leads to the next child of its parent, or to the parent's
    exit. ``place`` keeps arcs of one conversation together. Adds to each node its number: (node, number).
    """
    numbered = nodes.select("number", "node", "conv", "up")
    # Children of one parent stand side by side in one global order, however many there are.
    ranked = prefix_sums(numbered, ["up", "conv"], {"i": F.lit(1).cast("long")})
    ranked = saved(ranked, "children")
    following = ranked.select((F.col("i") - 1).alias("j"), F.col("number").alias("sister"), F.col("up").alias("mother"))
    parent = numbered.select(F.col("node").alias("p"), F.col("number").alias("above"))
    beside = ranked.join(following, (F.col("i") == F.col("j")) & (F.col("up") == F.col("mother")), "left").join(parent, F.col("up") == F.col("p"), "left")
    exits = beside.select((2 * F.col("number") + 1).alias("arc"), F.coalesce(2 * F.col("sister"), 2 * F.col("above") + 1).alias("next"), F.col("conv").alias("place"))
    eldest = ranked.filter("up IS NOT NULL").groupBy("up").agg(F.min_by("number", "conv").alias("child"))
    enters = numbered.join(eldest.withColumnRenamed("up", "u"), F.col("node") == F.col("u"), "left").select(
        (2 * F.col("number")).alias("arc"), F.coalesce(2 * F.col("child"), 2 * F.col("number") + 1).alias("next"), F.col("conv").alias("place"))
    return enters.unionByName(exits)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arcs (arc, next, gap) of one partition as maximal runs: each arc with the run's first arc and its distance from there, and of a
    run's first arc where the run leads to and how long it is."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    held = pa.Table.from_batches(parts)
    arc, gap = held.column(0).to_numpy(), held.column(2).to_numpy()
    following = held.column(1).fill_null(-1).to_numpy()
    order = np.argsort(arc)
    at = np.minimum(np.searchsorted(arc[order], following), len(arc) - 1)
    inside = arc[order][at] == following
    step = order[at]
    # Each arc looks back twice as far each round, until all see the first arc of their run.
    back, ahead = np.arange(len(arc)), np.zeros(len(arc), np.int64)
    back[step[inside]] = np.flatnonzero(inside)
    ahead[step[inside]] = gap[inside]
    first = back == np.arange(len(arc))
    while not first[back].all():
        ahead, back = ahead + ahead[back], back[back]
    head, ends = arc[back], np.flatnonzero(~inside)
    to, long = np.full(len(arc), -1, np.int64), np.zeros(len(arc), np.int64)
    to[back[ends]], long[back[ends]] = following[ends], ahead[ends] + gap[ends]
    yield pa.RecordBatch.from_pydict({
        "arc": pa.array(arc), "head": pa.array(head), "ahead": pa.array(ahead),
        "to": pa.array(to, pa.int64(), mask=to < 0), "long": pa.array(long), "first": pa.array(first)})


def _ranked(arcs: DataFrame) -> DataFrame:
    """(arc, at): how far each arc of the list (arc, next, gap) stands from its first one.

    A long list is first cut at its rulers: every other arc jumps on, twice as far each round, until it meets a ruler or the end; the
    rulers, a sixteenth, are ranked the same way. A round only touches arcs that are still on their way.
    """
    if arcs.count() <= ALONE:
        return arcs.select("arc", "next", "gap").repartition(1).mapInArrow(_chains, "arc long, head long, ahead long, to long, long long, first boolean").select(
            "arc", F.col("ahead").alias("at"))
    aimed = arcs.select(F.col("next").alias("n")).filter("n IS NOT NULL")
    first = arcs.join(aimed, F.col("arc") == F.col("n"), "left_anti").first()["arc"]
    ruler = lambda c: (F.pmod(F.xxhash64(c, F.lit(7)), F.lit(SPAN)) == 0) | (F.col(c) == first)
    done = None
    open_ = saved(arcs.select("arc", "next", "gap"), "jumps")
    while True:
        over = F.col("next").isNull() | ruler("next")
        ended = open_.filter(over)
        done = ended if done is None else done.unionByName(ended)
        if open_.filter(~over).isEmpty():
            break
        # An arc that is still on its way meets one that has ended or is on its way, too.
        ahead = open_.filter(~over).unionByName(done).select(F.col("arc").alias("a2"), F.col("next").alias("n2"), F.col("gap").alias("g2"))
        open_ = saved(open_.filter(~over).join(ahead, F.col("next") == F.col("a2")).select(
            "arc", F.col("n2").alias("next"), (F.col("gap") + F.col("g2")).alias("gap")), "jumps")
    done = saved(done, "rulers")
    rulers = saved(done.filter(ruler("arc")), "shorter")
    placed = saved(_ranked(rulers), "placed")
    # An arc between two rulers stands as far before the next one as it has to go; before the end, by the length of all.
    length = rulers.join(placed.select(F.col("arc").alias("r"), "at"), F.col("arc") == F.col("r")).filter("next IS NULL").select((F.col("at") + F.col("gap")).alias("v")).first()["v"]
    known = placed.select(F.col("arc").alias("r"), "at")
    return done.join(known, F.col("next") == F.col("r"), "left").select("arc", (F.coalesce("at", F.lit(length)) - F.col("gap")).alias("at"))


def positions(arcs: DataFrame) -> DataFrame:
    """(arc, at) for the arcs (arc, next, place) of one linked list: how many stand before each. Distributed.

    Arcs are sorted by place into partitions, and runs of arcs inside one become one element; the list of these, far shorter where
    places follow the list, is ranked, and each arc adds its place in its run.
    """
    spread = saved(arcs.repartitionByRange("place", "arc").select("arc", "next", F.lit(1).cast("long").alias("gap")).mapInArrow(
        _chains, "arc long, head long, ahead long, to long, long long, first boolean"), "runs")
    shorter = saved(spread.filter("first").select("arc", F.col("to").alias("next"), F.col("long").alias("gap")), "shorter")
    heads = saved(_ranked(shorter).select(F.col("arc").alias("h"), "at"), "heads")
    return spread.join(small(heads), F.col("head") == F.col("h")).select("arc", (F.col("at") + F.col("ahead")).alias("at"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, member) in order as (node, first member, text): members joined by commas, in pieces."""
    node, first, text, size = None, 0, [], 0
    for batch in batches:
        out = []
        for n, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text and (n != node or size >= PIECE):
                out.append((node, first, ",".join(text)))
                text, size = [], 0
            if not text:
                node, first = n, m
            text.append(str(m))
            size += len(text[-1]) + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["node", "first", "text"])
    if text:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([first], pa.int64()), pa.array([",".join(text)])], names=["node", "first", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (node, first, text) in order as (node, SHA-256 of them joined by commas), one piece in memory at a time."""
    node, digest = None, None
    for batch in batches:
        out = []
        for n, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if n == node:
                digest.update(b"," + text.encode())
                continue
            if node is not None:
                out.append((node, digest.hexdigest()))
            node, digest = n, hashlib.sha256(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["d", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["d", "ends_sha256"])


def _ends(last: DataFrame) -> DataFrame:
    """(d, ends_sha256) for nodes at which conversations end. A node's members are sorted across partitions and packed into pieces of 64 KB;
    only those pieces are put together in one task, one after another, as the digest must be."""
    pieces = last.select("node", F.col("conv").alias("member")).repartitionByRange("node", "member").sortWithinPartitions("node", "member").mapInArrow(
        _joined, "node string, first long, text string")
    return saved(pieces, "pieces").repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "d string, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """The trie of all prefixes of conversations (conv, at, mark, chars): one row a node, with figures of its subtree.

    Columns: conv (its smallest member), depth, parent, n_convs, n_children, n_leaves (childless nodes of the subtree, itself
    included), saved_chars (over the subtree, conversations but one times the characters of the last turn), ends_sha256 (of the ids,
    ascending and joined by commas, of the conversations that end here). An empty table gives no rows. Eager.
    """
    nodes, last = _nodes(turns)
    numbers = prefix_sums(nodes, ["conv", "depth"], {"number": F.lit(1).cast("long")})
    nodes = saved(numbers, "numbered")
    children = nodes.filter("up IS NOT NULL").groupBy(F.col("up").alias("c_up")).agg(F.count(F.lit(1)).alias("n_children"))
    wide = saved(nodes.join(children, F.col("node") == F.col("c_up"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).drop("c_up"), "wide")
    places = saved(positions(saved(_arcs(nodes), "arcs")), "positions")
    entered = wide.select((2 * F.col("number")).alias("e"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n") - 1) * F.col("chars")).alias("saves"))
    tour = places.join(entered, F.col("arc") == F.col("e"), "left").select("arc", "at", F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"), F.coalesce("saves", F.lit(0).cast("long")).alias("saves"))
    sums = prefix_sums(tour, ["at"], {"leaves": F.col("leaf"), "saved": F.col("saves")})
    # A node's exit stands after its whole subtree, its enter arc before it: the difference, with its own share, is the subtree's.
    whole = sums.groupBy(F.floor(F.col("arc") / 2).alias("m")).agg(
        (F.max("leaves") - F.min("leaves") + F.sum("leaf")).alias("n_leaves"), (F.max("saved") - F.min("saved") + F.sum("saves")).alias("saved_chars"))
    parents = nodes.select(F.col("node").alias("p"), F.col("conv").alias("parent"))
    none = hashlib.sha256(b"").hexdigest()
    return (
        wide.join(whole, F.col("number") == F.col("m")).join(parents, F.col("up") == F.col("p"), "left").join(_ends(last), F.col("node") == F.col("d"), "left")
        .select("conv", "depth", "parent", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_chars", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    )
