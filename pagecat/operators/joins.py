"""Joins between staged and stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach_parent_id(variants: DataFrame, catalog: DataFrame, url: str = "item_url") -> DataFrame:
    """Give staged variants the id of the catalog row with their URL; those without one drop out."""
    parents = catalog.select(F.col("id").alias("item_id"), url)
    return variants.join(parents, url, "inner")


def drop_staged_variants(variants: DataFrame, catalog: DataFrame, stage: DataFrame) -> DataFrame:
    """Remove the variants of catalog rows whose slug is staged. A NULL slug matches nothing."""
    hit = catalog.join(stage.select("slug"), "slug", "left_semi").select(F.col("id").alias("item_id"))
    return variants.join(hit, "item_id", "left_anti").select(*variants.columns)


def match_split(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """(key, action) with action update, insert or keep."""
    t = target.select(key).withColumn("__t", F.lit(True))
    s = source.select(key).withColumn("__s", F.lit(True))
    action = (
        F.when(F.col("__t") & F.col("__s"), "update").when(F.col("__s"), "insert").otherwise("keep")
    )
    return t.join(s, key, "full_outer").select(key, action.alias("action"))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children whose reference is set but has no parent."""
    ids = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(ids, fk, "left_anti").select(*child.columns)


def cascade_delete(child: DataFrame, removed_parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """The children that stay once the given parents are gone."""
    ids = removed_parents.select(F.col(pk).alias(fk))
    return child.join(ids, fk, "left_anti").select(*child.columns)
