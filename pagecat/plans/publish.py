"""Publishing staged rows into the catalogue, refreshing variants, moving addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions.urls import rebase, url_origin, url_path
from ..operators.graph import resolve_redirects
from ..operators.joins import attach_parent_id, cascade_delete, drop_staged_variants
from ..operators.merge import stable_id, update_where, upsert
from ..operators.quality import require_unique
from ..operators.ranking import last_per_key, last_write_per_key
from ..session import cut
from ..sources.tables import Snapshots
from .runs import finalize_run


def blank_to_null(df: DataFrame, cols) -> DataFrame:
    """Empty text and a list of one empty text become NULL, so that they do not replace a value."""
    changes = {}
    for c in cols:
        if c not in df.columns:
            continue
        kind = df.schema[c].dataType.simpleString()
        if kind == "string":
            changes[c] = F.nullif(F.col(c), F.lit(""))
        elif kind == "array<string>":
            changes[c] = F.when(F.col(c) != F.array(F.lit("")), F.col(c))
    return df.withColumns(changes)


def merge_catalog(catalog: DataFrame, stage: DataFrame, as_of) -> DataFrame:
    """Upsert by slug: the address always, every other column unless staged as NULL."""
    merged = [c for c in schemas.CATALOG_MERGED if c in catalog.columns and c in stage.columns]
    defaults = {c: v for c, v in (("id", stable_id(F.col("slug"))), ("created_at", as_of), ("updated_at", as_of))
                if c in catalog.columns}
    return upsert(
        catalog, stage, "slug", ["item_url", *merged], defaults=defaults, keep_old=merged,
        touch="updated_at", as_of=as_of,
    )


def merged_catalog(stage: DataFrame, catalog: DataFrame, as_of, on_dup: str = "error",
                   blank_as_null: bool = False) -> DataFrame:
    """The catalogue after the merge, written out: the check, the variants and the new version all read it."""
    if blank_as_null:
        stage = blank_to_null(stage, schemas.CATALOG_MERGED)
    if on_dup == "error":
        require_unique(stage, ["slug"], "staged slug")
        merged = cut(merge_catalog(catalog, stage, as_of))
        require_unique(merged, ["item_url"], "catalogue address")
        return merged
    # Of several staged rows with one slug the one that sorts last counts; then of several records with one address.
    others = [c for c in stage.columns if c != "slug"]
    stage = last_per_key(stage.filter("slug IS NOT NULL"), ["slug"], others).select(*stage.columns).unionByName(
        stage.filter("slug IS NULL"))
    merged = merge_catalog(catalog, stage, as_of)
    changed = F.col("updated_at") if "updated_at" in merged.columns else F.lit(0)
    return cut(last_per_key(merged, ["item_url"], [changed, F.col("slug")]).select(*catalog.columns))


def merged_variants(merged: DataFrame, stage: DataFrame, variant_stage: DataFrame, variants: DataFrame, as_of,
                    on_dup: str = "error", catalog: DataFrame | None = None) -> DataFrame:
    """Variants of staged slugs are replaced; a staged variant finds its record by the address after the merge.

    With the ``catalog`` before the merge, variants of records that the merge has removed go with them.
    """
    kept = drop_staged_variants(variants, merged, stage)
    if catalog is not None:
        kept = cascade_delete(kept, catalog.join(merged.select("id"), "id", "left_anti"), "item_id", "id")
    placed = attach_parent_id(variant_stage, merged)
    fields = [c for c in schemas.VARIANT_FIELDS if c in variant_stage.columns]
    defaults = {"id": stable_id(F.col("item_id"), F.col("label")), "created_at": as_of, "updated_at": as_of}

    def value(c):
        if c in ("item_id", "label", *fields):
            return F.col(c)
        made = defaults[c] if c == "id" else F.lit(defaults.get(c))
        return made.cast(variants.schema[c].dataType).alias(c)

    new = placed.select(*[value(c) for c in variants.columns])
    if on_dup == "error":
        after = cut(kept.unionByName(new))
        require_unique(after, ["item_id", "label"], "variant")
        return after
    both = kept.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    order = ["__new", *[c for c in variants.columns if c not in ("item_id", "label")]]
    keyed = F.col("item_id").isNotNull() & F.col("label").isNotNull()
    last = last_per_key(both.filter(keyed), ["item_id", "label"], order, variants.columns)
    return last.select(*variants.columns).unionByName(both.filter(~keyed).select(*variants.columns))


def publish(stage: DataFrame, variant_stage: DataFrame, catalog: DataFrame, variants: DataFrame, as_of,
            on_dup: str = "error", blank_as_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """The catalogue and variant tables after merging what is staged.

    Repeated keys stop the publish (``error``) or the last one stays (``last``).
    """
    merged = merged_catalog(stage, catalog, as_of, on_dup, blank_as_null)
    return merged, merged_variants(
        merged, stage, variant_stage, variants, as_of, on_dup, catalog if on_dup == "last" else None)


def publish_and_close(stage: DataFrame, variant_stage: DataFrame, catalog: DataFrame, variants: DataFrame, log: DataFrame, as_of,
                      **options) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """((catalogue, variants), run log): publish, then close the newest run in progress.

    If the publish is refused, the tables stay as they were and the run has failed. Eager.
    """
    try:
        tables = publish(stage, variant_stage, catalog, variants, as_of, **options)
    except ValueError:
        return (catalog, variants), finalize_run(log, published=False)
    return tables, finalize_run(log)


def publish_snapshot(store: Snapshots, stage: DataFrame, variant_stage: DataFrame, as_of, **options) -> int:
    """Read the current version, merge, write the next one with empty staging. These four tables change at once, others stay.

    If another publisher comes first, the merge is done again on top of it.
    """
    stage, variant_stage = cut(stage), cut(variant_stage)

    def merge(version: int) -> int:
        catalog, variants = publish(
            stage, variant_stage, store.read("catalog", version=version), store.read("variant", version=version), as_of, **options
        )
        return store.publish({
            "catalog": catalog, "variant": variants,
            "catalog_stage": stage.limit(0), "variant_stage": variant_stage.limit(0),
        }, based_on=version)

    return store.retried(merge)


def publish_touched(store: Snapshots, stage: DataFrame, variant_stage: DataFrame, as_of, **options) -> int:
    """As ``publish_snapshot`` for tables in buckets (catalog by slug, variant by item_id): only buckets with a change are read whole,
    merged and written; what is written grows with the staged rows, not with the catalogue.

    Of the other buckets, addresses alone are read, to find records that a staged address names. The two tables must have
    been consistent before (no address twice). If another publisher comes first, the merge is done again on top of it.
    """
    stage, variant_stage = cut(stage), cut(variant_stage)

    def merge(version: int) -> int:
        catalog, variants = store.read("catalog", version=version), store.read("variant", version=version)
        urls = stage.select("item_url").union(variant_stage.select("item_url")).filter("item_url IS NOT NULL").distinct()
        # Records that share an address with something staged: they may lose it, or get variants.
        named = cut(catalog.select("id", "slug", "item_url").join(urls, "item_url", "left_semi"))
        parts = store.touched("catalog", stage.select("slug").union(named.select("slug")), version)
        old = store.read("catalog", parts, version)
        merged = merged_catalog(stage, old, as_of, options.get("on_dup", "error"), options.get("blank_as_null", False))
        ids = merged.join(stage.select("slug"), "slug", "left_semi").select("id")
        ids = ids.union(merged.join(urls, "item_url", "left_semi").select("id")).union(old.join(merged.select("id"), "id", "left_anti").select("id"))
        places = store.touched("variant", ids, version)
        kept = store.read("variant", places, version)
        last = options.get("on_dup", "error") == "last"
        fresh = merged_variants(merged, stage, variant_stage, kept, as_of, options.get("on_dup", "error"), old if last else None)
        return store.publish(
            {"catalog": merged, "variant": fresh, "catalog_stage": stage.limit(0), "variant_stage": variant_stage.limit(0)},
            parts={"catalog": parts, "variant": places}, based_on=version)

    return store.retried(merge)


def overwrite_variants(variants: DataFrame, fresh: DataFrame, arrival: str = "pos", as_of=None,
                       guard: bool = False) -> DataFrame:
    """Set the link columns of matching (item_id, label) rows, NULLs included; the last write counts.

    ``guard`` leaves items alone whose fresh variants have no result at all.
    """
    cols = [c for c in schemas.VARIANT_FIELDS if c in fresh.columns]
    if guard:
        empty = F.lit("")
        none = (F.coalesce("file_url_1", empty) == "") & (F.coalesce("view_url_1", empty) == "")
        useful = fresh.groupBy("item_id").agg(F.bool_and(none).alias("none")).filter("NOT none")
        fresh = fresh.join(useful.select("item_id"), "item_id", "left_semi")
    last = last_write_per_key(fresh.select("item_id", "label", arrival, *cols), ["item_id", "label"], [arrival])
    return update_where(variants, last, ["item_id", "label"], cols,
                        touch="updated_at" if as_of is not None else None, as_of=as_of)


def refresh_config(config: DataFrame, redirects: DataFrame) -> DataFrame:
    """Configured addresses after following redirects(src, dst): another origin replaces the address.

    An address that leads to its own origin, nowhere or in circles stays as it is.
    """
    ends = resolve_redirects(redirects).select(F.col("src").alias("url"), "final")
    moved = url_origin("final") != url_origin("url")
    return config.join(ends, "url", "left").select(
        *[F.when(moved, url_origin("final")).otherwise(F.col("url")).alias("url") if c == "url" else F.col(c)
          for c in config.columns]
    )


def rebase_urls(catalog: DataFrame, config: DataFrame, col: str = "poster_ref", out: str = "poster_url",
                key: str = "base_url") -> DataFrame:
    """Stored relative references as full addresses on the configured base."""
    from ..sources.tables import with_config

    return with_config(catalog, config, key, "__base").withColumn(out, rebase("__base", col)).drop("__base")


def to_relative(df: DataFrame, col: str) -> DataFrame:
    """Full addresses become paths; those that are none, and everything else, stay."""
    return df.withColumn(
        col, F.when(F.col(col).startswith("http"), F.coalesce(url_path(col), F.col(col))).otherwise(F.col(col))
    )


def migration_report(df: DataFrame, col: str) -> DataFrame:
    """What to_relative would do: total, to_migrate, success and failed in one pass."""
    full = F.coalesce(F.col(col).startswith("http"), F.lit(False))
    ok = full & url_path(col).isNotNull()
    return df.agg(
        F.count_if(F.col(col).isNotNull()).alias("total"),
        F.count_if(full).alias("to_migrate"),
        F.count_if(ok).alias("success"),
        F.count_if(full & ~ok).alias("failed"),
    )
