"""Constraint checks and audits: what a database would have refused, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..session import cut
from .running import micros, running

# The legal moves of a work item.
QUEUE_MOVES = (
    ("pending", "processing"), ("pending", "skipped"), ("processing", "done"),
    ("processing", "error"), ("processing", "skipped"),
    ("processing", "pending"), ("done", "pending"), ("error", "pending"), ("skipped", "pending"),
)


def not_null(col: str) -> Column:
    return F.col(col).isNotNull()


def one_of(col: str, values) -> Column:
    """NULL passes, as in a database CHECK."""
    return F.col(col).isNull() | F.col(col).isin(*values)


def check_constraints(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) per broken rule, all rules in one scan."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()])
    )
    return df.select(F.col(key), F.explode(broken).alias("rule"))


def unique_violations(df: DataFrame, cols, where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their count; NULLs never collide."""
    rows = df if where is None else df.filter(where)
    return (
        rows.dropna(subset=list(cols)).groupBy(*cols).agg(F.count("*").alias("n")).filter("n > 1")
    )


def require_unique(df: DataFrame, cols, what: str) -> None:
    """Stop before anything is written if the key repeats."""
    clash = unique_violations(df, cols).head(1)
    if clash:
        raise ValueError(f"{what}: more than one row for {clash[0].asDict()}")


def status_transitions(log: DataFrame, key: str, at: str, status: str = "status", tie=("id",),
                       moves=QUEUE_MOVES) -> DataFrame:
    """Each change of an item's status with the one before it and whether the move is allowed.

    An item's row is written by one writer at a time, so a slice holds few changes of one item.
    """
    rows = log.withColumn("__t", micros(at))
    with_prev = running(
        rows, [key], "__t", tie=tie, inclusive=False,
        last={"__prev": F.struct(F.col(status).alias("s"))},
    )
    move = F.concat_ws(">", F.coalesce(F.col("__prev.s"), F.lit("")), F.coalesce(F.col(status), F.lit("")))
    legal = F.when(F.col("__prev").isNull(), F.lit(True)).otherwise(
        move.isin(*[f"{a}>{b}" for a, b in moves])
    )
    return with_prev.select(
        *log.columns, F.col("__prev.s").alias("prev_status"), legal.alias("legal")
    )


def stuck(queue: DataFrame, as_of: Column, minutes: int, at: str = "processed_at") -> DataFrame:
    """Items that have been in processing for longer than the given time."""
    return queue.filter(
        (F.col("status") == "processing") & (F.col(at) < as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    )


def active_run_audit(log: DataFrame, by, start: str, end: str) -> DataFrame:
    """(keys, at, active): moments at which a run began while another of its key was still going.

    Ends of the same moment count first. Rows are added up per key and moment before anything is ordered.
    """
    marks = F.explode(F.array(
        F.struct(micros(start).alias("t"), F.lit(1).alias("d")),
        F.struct(micros(end).alias("t"), F.lit(-1).alias("d")),
    ))
    moments = cut(
        log.select(*by, marks.alias("m")).filter("m.t IS NOT NULL")
        .groupBy(*by, F.col("m.t").alias("__t"))
        .agg(F.sum("m.d").alias("__d"), F.max("m.d").alias("__start"))
    )
    counted = running(moments, by, "__t", total={"active": F.col("__d")})
    return counted.filter("__start = 1 AND active > 1").select(
        *by, F.timestamp_micros("__t").alias("at"), "active"
    )


def catalog_rules() -> dict[str, Column]:
    return {"item_url not null": not_null("item_url"), "name not null": not_null("name")}


def variant_rules() -> dict[str, Column]:
    return {"label not null": not_null("label")}


def run_rules() -> dict[str, Column]:
    return {"status known": one_of("status", schemas.RUN_STATUS)}


def request_rules() -> dict[str, Column]:
    return {
        "item_id not null": not_null("item_id"),
        "status known": one_of("status", schemas.REQUEST_STATUS),
    }
