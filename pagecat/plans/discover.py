"""Discovery: from listing pages to a work queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.text import js_trim
from ..operators import predicates as p
from ..operators.graph import paginate
from ..operators.merge import stable_id, upsert
from ..operators.ranking import dedup_first_seen, last_per_key, next_links, pick_section, sort_sections
from ..session import cut
from ..sources.html import anchor_links, block_links
from .extract import LISTED, reached


def section_links(blocks: DataFrame, home: str) -> DataFrame:
    """The sections the home page lists: (name, url, pos)."""
    return blocks.filter((F.col("page_url") == home) & p.is_section_link()).select(
        js_trim("anchor_text").alias("name"), F.col("abs_url").alias("url"), "pos"
    )


def listing_items(blocks: DataFrame, walked: DataFrame, noise=()) -> DataFrame:
    """Accepted item links of the walked pages: (section, page_no, pos, name, url)."""
    pages = walked.select("section", F.col("url").alias("page_url"), F.col("depth").alias("page_no"))
    named = blocks.withColumn("anchor_text", js_trim("anchor_text"))
    return (
        named.filter(p.is_item_link(noise))
        .join(pages, "page_url")
        .select("section", "page_no", "pos", F.col("anchor_text").alias("name"), F.col("abs_url").alias("url"))
    )


def new_per_page(items: DataFrame, pages: DataFrame) -> DataFrame:
    """(section, page_no, new_items) for every page read, zero included."""
    fresh = dedup_first_seen_by_section(items)
    counts = fresh.groupBy("section", "page_no").agg(F.count("*").alias("n"))
    return pages.select("section", "page_no").distinct().join(
        counts, ["section", "page_no"], "left"
    ).select("section", "page_no", F.coalesce("n", F.lit(0)).alias("new_items"))


def dedup_first_seen_by_section(items: DataFrame) -> DataFrame:
    """Each walk of a section keeps its own set of seen URLs."""
    rows = items.withColumn("__k", F.struct("section", "url"))
    return dedup_first_seen(rows, "__k").drop("__k")


def queue_items(queue: DataFrame, items: DataFrame, as_of) -> DataFrame:
    """Upsert discovered items as pending with priority 1; other columns of old rows stay as they are."""
    src = items.select("url", F.col("section").alias("folder"), F.lit("pending").alias("status"),
                       F.lit(1).alias("priority"))
    return upsert(
        queue, src, "url", ["folder", "status", "priority"],
        defaults={"id": stable_id(F.col("url")), "queued_at": as_of},
    )


def walk_pages(starts: DataFrame, parsed: DataFrame, rounds: int = 64) -> DataFrame:
    """Listing pages of a few sections, as ``paginate``, from page to page: each round reads only the pages that the one before has reached.

    The addresses of a round, up to ``LISTED``, stand in the filter of one short job, which brings back where they lead. Of a section
    with more than ``rounds`` pages the rest is walked by doubling jumps over the next-links of all pages, as are more sections. Eager.
    """
    first = starts.select("section", "url").distinct()
    listed = first.limit(LISTED + 1).collect()
    if len(listed) > LISTED:
        return paginate(first, next_links(anchor_links(parsed, "pager")))

    def table(depths: dict) -> DataFrame:
        return parsed.sparkSession.createDataFrame([(*k, n) for k, n in depths.items()], StructType([*first.schema.fields, StructField("depth", IntegerType())]))

    depths = {(r["section"], r["url"]): 1 for r in listed}
    frontier = list(depths)
    for depth in range(2, rounds + 2):
        pages = parsed.select("page_url", "anchors").filter(F.col("page_url").isin(sorted({url for _, url in frontier if url is not None})))
        onward = {r["page_url"]: r["next_url"] for r in next_links(anchor_links(pages, "pager")).collect()}
        # On a circle a page comes up again; it counts once.
        frontier = [k for k in dict.fromkeys((section, onward.get(url)) for section, url in frontier) if k[1] is not None and k not in depths]
        if not frontier:
            return table(depths)
        depths |= dict.fromkeys(frontier, depth)
    rest = paginate(table({k: rounds + 1 for k in frontier}), next_links(anchor_links(parsed, "pager"))).withColumn("depth", F.col("depth") + rounds)
    walked = table(depths)
    return walked.unionByName(rest.join(walked, ["section", "url"], "left_anti"))


def discover(parsed: DataFrame, home: str, queue: DataFrame, as_of, mode: str = "quick",
             year: str | None = None, current_year: str = "", noise=()) -> DataFrame:
    """The new work queue. ``mode``: quick (first page of the current section), custom, or all sections.

    Blocks are read from the pages walked, next-links from those of the section; a walk of all sections reads all next-links. Eager.
    """
    sections = section_links(block_links(parsed.filter(F.col("page_url") == home)), home)
    if mode == "all":
        chosen = sections
    else:
        chosen = pick_section(sort_sections(sections), mode, year, current_year)
    full = mode == "all" or (mode == "custom" and bool(year))
    starts = chosen.select(F.col("name").alias("section"), "url")
    if mode == "custom" and full:
        walked = cut(walk_pages(starts, parsed))
    elif full:
        walked = cut(paginate(starts, next_links(anchor_links(parsed, "pager"))))
    else:  # first pages only: no links are followed
        walked = cut(starts.withColumn("depth", F.lit(1)))
    items = listing_items(block_links(reached(parsed, walked, "url", "blocks")), walked, noise)
    # Sections are queued one after the other: of an item in several, the last one stays.
    order = sections.select(F.col("name").alias("section"), F.col("pos").alias("__order"))
    first = dedup_first_seen_by_section(items).join(order, "section")
    unique = last_per_key(first, ["url"], ["__order", "section"], ["section"])
    return queue_items(queue, unique, as_of)
