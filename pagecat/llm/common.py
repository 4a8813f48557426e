"""Helpers of the text-corpus operators: stored steps, global running totals, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagecat.session import scratch, tune

# A set of ids up to this many rows (some 60 MB as a hash table) is broadcast; a larger one is joined by a shuffle.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, in a session with the library's settings."""
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here and each value is computed once. Eager."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """Stored id rows, marked for broadcast if a count shows that there are few; otherwise as they are, for a shuffled join."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def bucket(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def running(rows: DataFrame, order: list[str], size: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Add ``index`` (rows before this one) and, with ``size``, ``start`` (their sizes summed), over all rows or per ``by``.

    Range partitions hold consecutive rows; inside one a window counts, between them the totals of the earlier partitions
    are added. No task sees more than a partition, however many rows share a key. ``rows`` should be narrow; they are stored
    once so that every reader sees the same partitions. Rows equal in ``order`` stand in an arbitrary, but fixed order. Eager.
    """
    by = by or []
    placed = saved(
        rows.repartitionByRange(*[F.col(c) for c in [*by, *order]])
        .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()),
        "running",
    )
    amount = F.col(size).cast("long") if size else F.lit(0).cast("long")
    totals = placed.groupBy("part", *by).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("s"))
    # One row per partition and group: far fewer than rows, even where all of them meet in one window.
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("part").alias("o_part"), *[F.col(c).alias(f"o_{c}") for c in by],
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("o_n"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("o_s"),
    )
    inside = Window.partitionBy("part", *by).orderBy(*order, "row")
    counted = placed.withColumns({
        "index": F.row_number().over(inside) - F.lit(1).cast("long"),
        "start": F.coalesce(F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    same = F.col("part") == F.col("o_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    joined = counted.join(offsets, same)
    out = [F.col(c) for c in rows.columns] + [(F.col("index") + F.col("o_n")).alias("index")]
    return joined.select(*out, *([(F.col("start") + F.col("o_s")).alias("start")] if size else []))
