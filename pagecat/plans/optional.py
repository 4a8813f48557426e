"""Rules that are described but not in force; each one is off unless called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import _col, _found, js_trim
from ..functions.urls import rebase


def normalize_quality(label) -> Column:
    """1080p, 720p, 480p or 360p if contained; else ``hd`` means 720p; else Unknown."""
    low = F.lower(_col(label))
    out = None
    for known in ("1080p", "720p", "480p", "360p"):
        out = F.when(low.contains(known), known) if out is None else out.when(low.contains(known), known)
    return out.when(low.contains("hd"), "720p").otherwise("Unknown")


def priority_for(year, newest) -> Column:
    """1 for the newest year, 2 for the one before, 3 for older ones and unknown ones."""
    y, n = _col(year), _col(newest)
    return F.when(y == n, 1).when(y == n - 1, 2).otherwise(3)


def iso_duration(c) -> Column:
    """``PT2H30M29S`` as ``2h30m29s``; NULL for other text."""
    text = _col(c)
    body = _found(text, r"^PT((?:\d+H)?(?:\d+M)?(?:\d+S)?)\z", 1)
    return F.lower(body)


def with_unknown_variant(items: DataFrame, variants: DataFrame, key: str = "item_url") -> DataFrame:
    """Give an item without variants one row labelled Unknown."""
    missing = items.select(key).distinct().join(variants.select(key), key, "left_anti")
    return variants.unionByName(
        missing.withColumn("label", F.lit("Unknown")), allowMissingColumns=True
    )


def is_item_url(url, patterns) -> Column:
    """Items by address alone, series included."""
    return _col(url).rlike("(?i)" + "|".join(patterns))


def direct_or_fallback(links: DataFrame, page: str, direct: Column, fallback: Column, pos: str = "pos") -> DataFrame:
    """The direct links of each page; a page without any gives its first fallback link."""
    tagged = links.withColumn("__direct", direct).filter(direct | fallback)
    summary = tagged.groupBy(page).agg(
        F.bool_or("__direct").alias("__any"), F.min(F.when(~F.col("__direct"), F.col(pos))).alias("__first")
    )
    keep = F.when(F.col("__any"), F.col("__direct")).otherwise(F.col(pos) == F.col("__first"))
    return tagged.join(summary, page).filter(keep).select(*links.columns)


def duration_to_variants(variants: DataFrame, items: DataFrame, key: str = "item_url") -> DataFrame:
    """Copy the record's duration to its variants that have none."""
    parent = items.select(key, F.col("duration").alias("__d"))
    return variants.join(parent, key, "left").withColumn("duration", F.coalesce("duration", "__d")).drop("__d")


def run_time(info: str = "info", label: str = "run time") -> Column:
    """The value of the last pair whose label holds ``run time``."""
    hits = F.filter(F.col(info), lambda p: F.lower(p["k"]).contains(label))
    return js_trim(F.try_element_at(hits, F.lit(-1))["v"])


def poster_absolute(base, ref) -> Column:
    return rebase(base, ref)
