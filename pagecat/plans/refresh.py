"""Refresh of single records: look their variants up again, overwrite the links, close the request."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..operators.merge import update_where
from ..operators.variants import collect_variants
from ..session import cut
from .extract import NOT_CAPTURED, Labels, extract_variants, reached
from .publish import overwrite_variants


def open_requests(log: DataFrame, requests: DataFrame, minutes: int = 5) -> DataFrame:
    """The request log with a row in processing for every request whose role is owner (``classify_requests``).

    A request that is in the log already adds nothing; one without a record or with a result at hand opens none.
    """
    new = requests.filter("role = 'owner'").join(log.select("id"), "id", "left_anti")
    made = {
        "status": F.lit("processing"), "expires_at": F.col("requested_at") + F.expr(f"INTERVAL {int(minutes)} MINUTES"),
    }
    rows = new.select(*[
        (made[c] if c in made else F.col(c) if c in new.columns else F.lit(None)).cast(log.schema[c].dataType).alias(c)
        for c in log.columns
    ])
    return log.unionByName(rows)


def refresh(owned: DataFrame, catalog: DataFrame, parsed: DataFrame, variants: DataFrame, as_of, labels: Labels,
            guard: bool = False) -> tuple[DataFrame, DataFrame]:
    """(variant table, request rows) after serving the owned requests (id, item_id).

    Links are overwritten directly, NULLs included, and nothing is inserted. A request whose record shows no variants
    has failed, with the reason; the others are done and carry the fresh variants as their payload.
    """
    wanted = owned.join(catalog.select(F.col("id").alias("item_id"), F.col("item_url").alias("url")), "item_id")
    found = extract_variants(parsed, wanted.select("url").distinct(), labels)
    addresses = catalog.select(F.col("id").alias("item_id"), "item_url")
    fresh = cut(found.join(addresses, "item_url").select("item_id", "pos", "label", *schemas.VARIANT_FIELDS))
    payload = collect_variants(fresh, "item_id", list(schemas.VARIANT_FIELDS))
    pages = reached(parsed, wanted, "url").select(F.col("page_url").alias("url")).distinct().withColumn("__page", F.lit(True))
    why = F.when(F.col("__page").isNull(), NOT_CAPTURED).otherwise("No quality links found")
    served = wanted.select("id", "item_id", "url").join(pages, "url", "left").join(payload, "item_id", "left").select(
        "id", "item_id",
        F.when(F.col("payload").isNull(), "failed").otherwise("done").alias("status"),
        "payload",
        F.when(F.col("payload").isNull(), why).alias("error_msg"),
        F.lit(as_of).cast("timestamp").alias("completed_at"),
    )
    return overwrite_variants(variants, fresh, as_of=as_of, guard=guard), served


def close_requests(log: DataFrame, served: DataFrame) -> DataFrame:
    """The request log with status, payload, message and end of the served requests."""
    return update_where(log, served, "id", ["status", "payload", "error_msg", "completed_at"])
