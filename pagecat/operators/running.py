"""Running values and as-of lookups along time, without ever sorting a hot key in one task.

Up to a million rows, each key is ordered in one window. Beyond that, all rows are sorted by key and time into range
partitions, which cut a hot key wherever they need to. A partition orders its rows alone; what it inherits comes from one
summary row per key and earlier partition. Rows of one key and one instant are cut apart by their tie. Both ways give the
same values. As-of lookups first reduce all rows of one key and instant to one. Keys must not be NULL; a missing time
comes first.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut

HOT_ROWS = 1_000_000


def micros(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (session zone UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def running(df: DataFrame, by, at: str, tie=(), last: dict[str, Column] | None = None,
            total: dict[str, Column] | None = None, inclusive: bool = True) -> DataFrame:
    """Add the last non-NULL value and the sum so far of each given expression.

    ``at`` is a BIGINT axis, ``tie`` orders rows of one instant. With ``inclusive=False`` a row does not
    count itself. The rows are read several times: pass a stored or cut table. Eager: they are counted up to the
    bound, and stored in order beyond it.
    """
    values = _Values(list(by), [at, *tie], last or {}, total or {}, Window.currentRow if inclusive else -1)
    few = df.count() <= HOT_ROWS
    return values.whole(df) if few else values.ranged(df)


@dataclass(frozen=True)
class _Values:
    by: list[str]
    order: list[str]
    last: dict[str, Column]
    total: dict[str, Column]
    end: int

    def _so_far(self, keys) -> dict[str, Column]:
        w = Window.partitionBy(*keys).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, self.end)
        return {
            **{n: F.last(c, ignorenulls=True).over(w) for n, c in self.last.items()},
            **{n: F.coalesce(F.sum(c).over(w), F.lit(0)) for n, c in self.total.items()},
        }

    def whole(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[c.alias(n) for n, c in self._so_far(self.by).items()])

    def ranged(self, df: DataFrame) -> DataFrame:
        by, keys = self.by, [*self.by, "__part"]
        placed = cut(
            df.repartitionByRange(*by, *self.order)
            .withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
        )
        inside = replace(self, order=[*self.order, "__row"])
        own = placed.select("*", *[c.alias(f"__own_{n}") for n, c in inside._so_far(keys).items()])
        parts = placed.groupBy(*keys).agg(
            *[F.max_by(c, F.when(c.isNotNull(), F.struct(*inside.order))).alias(n) for n, c in self.last.items()],
            *[F.sum(c).alias(n) for n, c in self.total.items()],
        )
        # One row per key and partition it reaches into.
        w = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        carried = parts.select(
            *keys, *[F.last(n, ignorenulls=True).over(w).alias(f"__pre_{n}") for n in self.last],
            *[F.sum(n).over(w).alias(f"__pre_{n}") for n in self.total],
        )

        def zero(name):
            return F.coalesce(F.col(name), F.lit(0))

        return own.join(carried, keys).select(
            *df.columns,
            *[F.coalesce(f"__own_{n}", f"__pre_{n}").alias(n) for n in self.last],
            *[(zero(f"__own_{n}") + zero(f"__pre_{n}")).alias(n) for n in self.total],
        )


@dataclass(frozen=True)
class Fact:
    """What to look up: the row of ``rows`` latest at or before the point, or first at or after it.

    ``strict`` leaves out the point's own instant, ``shift_us`` starts the search that much later,
    ``within_us`` bounds the distance from there (inclusive), ``tie`` decides among facts of one instant.
    The result is a struct of ``fields`` called ``name``, or NULL.
    """

    name: str
    rows: DataFrame
    at: str
    fields: tuple[str, ...]
    within_us: int | None = None
    strict: bool = False
    forward: bool = False
    shift_us: int = 0
    tie: tuple[str, ...] = ()


@dataclass(frozen=True)
class Tally:
    """What to add up: ``delta`` of all rows at or before the point."""

    name: str
    rows: DataFrame
    at: str
    delta: int


def lookup(points: DataFrame, by, at: str, facts=(), tallies=()) -> DataFrame:
    """(keys, __t, one column per fact and tally) for every distinct instant of the points.

    All facts of one direction share a single pass: rows of every kind are first reduced to one
    per key and instant, then read in order.
    """
    by = list(by)
    out = None
    for forward in (False, True):
        wanted = [f for f in facts if f.forward == forward]
        sums = [] if forward else list(tallies)
        if not wanted and not sums:
            continue
        sign = -1 if forward else 1
        found = _one_direction(points, by, at, wanted, sums, sign)
        found = found.withColumn("__t", F.col("__t") * sign)
        out = found if out is None else out.join(found, [*by, "__t"])
    return out


def _one_direction(points, by, at, facts, tallies, sign) -> DataFrame:
    names = [*[f.name for f in facts], *[t.name for t in tallies]]

    def marks(df, axis, point, value=None, name=None):
        return df.select(*by, axis.alias("__t"), F.lit(point).alias("__p"), *([value.alias(name)] if name else []))

    rows = marks(points, sign * micros(at), True)
    for f in facts:
        # Rows of one instant: the greatest by tie; the own time is kept for the distance.
        value = F.struct(
            F.struct(*[F.col(t) for t in f.tie], F.lit(0).alias("__z")).alias("o"),
            F.struct(*[F.col(c) for c in f.fields]).alias("v"),
        )
        axis = sign * (micros(f.at) - F.lit(f.shift_us)) + F.lit(int(f.strict))
        rows = rows.unionByName(marks(f.rows, axis, False, value, f.name), allowMissingColumns=True)
    for t in tallies:
        delta = F.lit(t.delta).cast("bigint")
        rows = rows.unionByName(marks(t.rows, sign * micros(t.at), False, delta, t.name), allowMissingColumns=True)
    instants = rows.dropna(subset=[*by, "__t"]).groupBy(*by, "__t").agg(
        F.max("__p").alias("__p"),
        *[F.max(f.name).alias(f.name) for f in facts],
        *[F.sum(t.name).alias(t.name) for t in tallies],
    ).select(*by, "__t", "__p", *[F.col(n).alias(f"__v_{n}") for n in names])
    seen = {
        f.name: F.when(
            F.col(f"__v_{f.name}").isNotNull(),
            F.struct((F.col("__t") - F.lit(int(f.strict))).alias("t"), F.col(f"__v_{f.name}.v").alias("v")),
        )
        for f in facts
    }
    found = running(
        cut(instants), by, "__t", last=seen, total={t.name: F.col(f"__v_{t.name}") for t in tallies}
    ).filter("__p")

    def near(f):
        if f.within_us is None:
            return F.col(f"{f.name}.v")
        return F.when(F.col(f"{f.name}.t") >= F.col("__t") - F.lit(f.within_us), F.col(f"{f.name}.v"))

    return found.select(*by, "__t", *[near(f).alias(f.name) for f in facts], *[t.name for t in tallies])


def with_history(points: DataFrame, by, at: str, facts=(), tallies=()) -> DataFrame:
    """Add the looked-up columns to every point. Without keys all rows share one, still spread over partitions."""
    cols = points.columns
    by = list(by)
    if not by:
        by, one = ["__all"], F.lit(0)
        points = points.withColumn("__all", one)
        facts = [replace(f, rows=f.rows.withColumn("__all", one)) for f in facts]
        tallies = [replace(t, rows=t.rows.withColumn("__all", one)) for t in tallies]
    found = lookup(points, by, at, facts, tallies)
    names = [f.name for f in facts] + [t.name for t in tallies]
    return points.withColumn("__t", micros(at)).join(found, [*by, "__t"], "left").select(*cols, *names)
