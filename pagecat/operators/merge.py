"""Upserts, updates, deletes and defaults as new snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add missing columns and fill NULLs of present ones."""
    return df.withColumns({
        c: F.coalesce(F.col(c), _lit(v)) if c in df.columns else _lit(v) for c, v in defaults.items()
    })


def upsert(target: DataFrame, source: DataFrame, key: str, set_cols, defaults: dict | None = None,
           given: dict[str, Column] | None = None, keep_old: bool | list[str] = False,
           touch: str | None = None, as_of=None) -> DataFrame:
    """The target after inserting or updating by ``key``; both sides unique on it.

    Only ``set_cols`` are written. Others keep their value on update and get their default on insert.
    ``given`` narrows a column to the source rows for which the condition holds. ``keep_old`` (all, or the
    named columns) never replaces a value with NULL. ``touch`` names a time set on update.
    """
    defaults, given = defaults or {}, given or {}
    merged = set(set_cols if keep_old is True else keep_old or [])
    src = source.select(
        F.col(key),
        F.lit(True).alias("__s"),
        *[F.col(c).alias(f"__s_{c}") for c in set_cols],
        *[cond.alias(f"__g_{c}") for c, cond in given.items()],
    )
    both = target.withColumn("__t", F.lit(True)).join(src, key, "full_outer")
    new_row = F.col("__t").isNull()

    def value(c):
        if c == key:
            return F.col(c)
        old = F.col(c)
        base = F.when(new_row, _lit(defaults[c])).otherwise(old) if c in defaults else old
        if c in set_cols:
            fresh = F.col(f"__s_{c}")
            writes = F.col("__s")
            if c in given:
                writes = writes & F.col(f"__g_{c}")
            base = F.when(writes, F.coalesce(fresh, old) if c in merged else fresh).otherwise(base)
        if c == touch:
            base = F.when(F.col("__t") & F.col("__s"), _lit(as_of)).otherwise(base)
        return base

    return both.select(*[value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def update_where(target: DataFrame, changes: DataFrame, key, cols, touch: str | None = None,
                 as_of=None) -> DataFrame:
    """Set ``cols`` of the rows with a matching key, NULLs included; nothing is inserted."""
    keys = [key] if isinstance(key, str) else list(key)
    src = changes.select(*keys, F.lit(True).alias("__s"), *[F.col(c).alias(f"__s_{c}") for c in cols])

    def value(c):
        if c in cols:
            return F.when(F.col("__s"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
        if c == touch:
            return F.when(F.col("__s"), _lit(as_of)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    return target.join(src, keys, "left").select(*[value(c) for c in target.columns])


def delete_where(target: DataFrame, pred: Column) -> DataFrame:
    """What is left; rows for which the condition is unknown stay."""
    return target.filter(~F.coalesce(pred, F.lit(False)))


def stable_id(*cols) -> Column:
    """A repeatable id from the natural key, in place of a random one."""
    return F.sha2(F.concat_ws("\x1f", *cols), 256)
