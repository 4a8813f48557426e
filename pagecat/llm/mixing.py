"""Mix sources to target weights: Pfair windows, earliest deadline first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running, saved

PLACED = "p_source string, p_block long, phase int, slot long, release long, deadline long, share double"


def exact(weights: list) -> list[int]:
    """Whole numbers in exactly the same proportions."""
    parts = [Fraction(w) for w in weights]
    unit = math.lcm(*[p.denominator for p in parts])
    return [int(p * unit) for p in parts]


def served(weights: list[int], done: list[int], t: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(slot, source, block, release, deadline) from slot ``t`` on, before which the sources had ``done`` blocks. Block j of a source
    with share w is released at floor(j/w) and due by ceil((j+1)/w); among released blocks the earliest deadline goes first. All
    deadlines are met as the shares add up to one."""
    whole = sum(weights)
    waiting, ready = [(j * whole // w, k, j) for k, (w, j) in enumerate(zip(weights, done, strict=True))], []
    heapq.heapify(waiting)
    while True:
        while waiting and waiting[0][0] <= t:
            release, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * whole // weights[k]), k, j, release))
        deadline, k, j, release = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a block missed its deadline")
        yield t, k, j, release, deadline
        heapq.heappush(waiting, ((j + 1) * whole // weights[k], k, j + 1))
        t += 1


def pattern(given: dict, period: int) -> dict[object, list[int]]:
    """The slots of each source among the first ``period`` ones, by weight."""
    names = sorted(given, key=lambda s: (s is not None, str(s)))
    slots = {s: [] for s in names}
    for (t, k, *_), _ in zip(served(exact([given[s] for s in names]), [0] * len(names), 0), range(period), strict=False):
        slots[names[k]].append(t)
    return slots


def phases(blocks: dict, weights: dict, period: int) -> list[dict]:
    """A phase lasts until one of its sources has no block left; the others go on with their weights scaled up.

    Each phase: its first slot (``base``), number of slots (``length``), sources (``names``, the one that ends in its last slot is
    ``ended``), their weights as whole numbers, the number of their first block (``first``), and every ``period`` slots the blocks
    each has been given in the phase (``starts``), from where its slots can be told again. At most as many phases as sources.
    """
    done, base, out = {s: 0 for s, n in blocks.items() if n}, 0, []
    while done:
        names = sorted(done, key=lambda s: (s is not None, str(s)))
        whole, left = exact([weights[s] for s in names]), [blocks[s] - done[s] for s in names]
        given, starts = [0] * len(names), []
        for t, k, *_ in served(whole, given, 0):
            if t % period == 0:
                starts.append(given.copy())
            given[k] += 1
            if given[k] == left[k]:
                break
        out.append({"base": base, "length": t + 1, "names": names, "weights": whole, "first": [done[s] for s in names],
                    "starts": starts, "ended": names[k]})
        base += t + 1
        done = {s: done[s] + n for s, n, most in zip(names, given, left, strict=True) if n < most}
    return out


def _told(plan: list[dict], period: int):
    """The slots of parts of a plan, told from the state at the start of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, given in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                p = plan[i]
                whole, rows = sum(p["weights"]), []
                for (at, k, j, release, deadline), _ in zip(served(p["weights"], given, t), range(min(period, p["length"] - t)), strict=False):
                    name = p["names"][k]
                    rows.append((name if name is None else str(name), p["first"][k] + j, i, p["base"] + at, p["base"] + release,
                                 p["base"] + deadline, p["weights"][k] / whole))
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=[c.split()[0] for c in PLACED.split(", ")])

    return run


def mix(
    docs: DataFrame, weights: dict | None = None, alpha: float = 0.5, block_rows: int = 32, period: int = 1000,
    id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """A place for every document in one interleaved order of all sources.

    Each source's documents, by id, form blocks of ``block_rows``. ``weights`` gives the target share of each source (relative
    numbers; a source not named gets the smallest one); by default a source of n documents weighs n ** alpha. At any slot of a
    phase each source has been given less than one block more or less than its weight's exact share of it; when a source ends, the
    rest share its weight. No document is dropped or repeated.

    Returns per id: source, block (of its source), phase, slot (of the block in the whole order), release and deadline (the
    block's window of slots), share (the source's weight in that phase) and position (of the document, gapless from 0). A null
    source is a source of its own; documents that repeat an id count once; an empty table gives no rows; other columns are not
    read. The driver goes through all blocks once, without their documents, and holds one number per source for every ``period``
    slots; from these the executors tell the slots again. Eager.
    """
    spark = docs.sparkSession
    narrow = saved(docs.groupBy(F.col(id_col).alias("id")).agg(F.min(source_col).alias("source")), "sources")
    placed = saved(running(narrow, ["id"], by=["source"]), "placed")
    counts = {r["source"]: r["n"] for r in placed.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        chosen = {s: n**alpha for s, n in counts.items()}
    else:
        least = min((w for w in weights.values() if w > 0), default=1.0)
        chosen = {s: weights.get(s) or least for s in counts}
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    plan = phases(blocks, chosen, period)

    # The last block of a source may hold fewer rows: later positions move up by what is missing.
    last = {p["ended"]: p["base"] + p["length"] - 1 for p in plan}
    short = [(last[s], blocks[s] * block_rows - n) for s, n in counts.items() if n % block_rows]
    starts = spark.createDataFrame(
        [(i, k * period, given) for i, p in enumerate(plan) for k, given in enumerate(p["starts"])], "phase int, at long, given array<long>"
    )
    bare = [{k: v for k, v in p.items() if k != "starts"} for p in plan]
    slots = saved(starts.mapInArrow(_told(bare, period), PLACED), "slots")
    lost = F.aggregate(
        F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(d).cast("long").alias("d")) for t, d in short]),
        F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["t"] < F.col("slot"), x["d"]).otherwise(0),
    ) if short else F.lit(0).cast("long")
    source = F.col("source").cast("string")
    return (
        placed.withColumn("block", F.floor(F.col("index") / block_rows))
        .join(slots, source.eqNullSafe(F.col("p_source")) & (F.col("block") == F.col("p_block")))
        .select(
            F.col("id").alias(id_col), F.col("source").alias(source_col), "block", "phase", "slot", "release", "deadline", "share",
            (F.col("slot") * block_rows + F.col("index") % block_rows - lost).alias("position"),
        )
    )
