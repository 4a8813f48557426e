"""Walks along links: pages that follow each other, redirects, labelled hops."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut


def orbit(starts: DataFrame, edges: DataFrame, max_depth: int | None = None, circles: bool = True) -> DataFrame:
    """Every node reached from each start where a node has one successor at most.

    starts(start, node), edges(node, next) give (start, node, depth). Jumps double in length each round,
    so a walk of n steps needs about log2(n) rounds. A walk that closes a circle ends there; with
    ``circles=False`` the caller knows that there are none, which saves looking for nodes seen before.
    """
    jumps = edges.select("node", F.col("next").alias("__next")).filter("__next IS NOT NULL")
    reached = starts.select("start", "node", F.lit(0).alias("depth"))
    if circles:  # the others come cut already
        jumps, reached = cut(jumps), cut(reached)
    length = 1
    while max_depth is None or length <= max_depth:
        ahead = reached.join(jumps, "node").select(
            "start", F.col("__next").alias("node"), (F.col("depth") + length).alias("depth")
        )
        if max_depth is not None:
            ahead = ahead.filter(F.col("depth") <= max_depth)
        if circles:
            # On a circle a node comes up again: only nodes new to this start count, at their first depth.
            ahead = (
                ahead.join(reached.select("start", "node"), ["start", "node"], "left_anti")
                .groupBy("start", "node").agg(F.min("depth").alias("depth"))
            )
        ahead = cut(ahead)
        if ahead.isEmpty():
            break
        reached = reached.unionByName(ahead)
        length *= 2
        if max_depth is None or length <= max_depth:
            onward = jumps.select(F.col("node").alias("__next"), F.col("__next").alias("__far"))
            jumps = cut(jumps.join(onward, "__next").select("node", F.col("__far").alias("__next")))
            if jumps.isEmpty():
                break
    return reached


def paginate(starts: DataFrame, next_links: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Listing pages of each section: starts(section, url), next_links(page_url, next_url).

    Gives (section, url, depth), depth 1 for the first page. A page linking to itself is the last one.
    """
    edges = next_links.filter("page_url <> next_url").select(
        F.col("page_url").alias("node"), F.col("next_url").alias("next")
    )
    walked = orbit(
        starts.select(F.col("section").alias("start"), F.col("url").alias("node")),
        edges,
        None if max_depth is None else max_depth - 1,
    )
    return walked.select(
        F.col("start").alias("section"), F.col("node").alias("url"), (F.col("depth") + 1).alias("depth")
    )


def resolve_redirects(redirects: DataFrame) -> DataFrame:
    """Where each address ends: (src, final, hops), however long the chain; NULL for circles. Eager.

    Pointers double in length each round, and a row that has reached its end leaves the rounds, so an end shared by many is
    shuffled once. Every chain has addresses at each shorter distance from its end: once a round ends none, only circles are left.
    """
    pointer = cut(redirects.select(
        "src", F.col("dst").alias("final"), F.lit(1).cast("bigint").alias("hops"), F.lit(True).alias("open")
    ))
    left = None
    while (open_rows := pointer.filter("open").count()) and open_rows != left:
        left = open_rows
        far = pointer.select(
            F.col("src").alias("final"), F.col("final").alias("__far"), F.col("hops").alias("__more"),
            F.col("open").alias("__open"),
        )
        moved = pointer.filter("open").join(far, "final", "left").select(
            "src",
            F.coalesce("__far", "final").alias("final"),
            (F.col("hops") + F.coalesce("__more", F.lit(0))).alias("hops"),
            F.coalesce("__open", F.lit(False)).alias("open"),
        )
        pointer = cut(pointer.filter("NOT open").unionByName(moved))
    ended = ~F.col("open")
    return pointer.select(
        "src", F.when(ended, F.col("final")).alias("final"), F.when(ended, F.col("hops")).alias("hops")
    )


def labelled_links(links: DataFrame, labels: dict[int, str], box: str | None = "links") -> DataFrame:
    """The first link per page and branch whose text holds the branch's label.

    One pass for all branches: (page_url, branch, href, abs_url). A link may serve several branches.
    """
    if box is not None:
        links = links.filter(F.col("box") == box)
    hits = F.array_compact(
        F.array(*[F.when(F.col("anchor_text").contains(text), F.lit(b)) for b, text in labels.items()])
    )
    return (
        links.select("page_url", "pos", "href", "abs_url", F.explode(hits).alias("branch"))
        .groupBy("page_url", "branch")
        .agg(F.min_by(F.struct("href", "abs_url"), "pos").alias("l"))
        .select("page_url", "branch", "l.*")
    )


def hop(rows: DataFrame, links: DataFrame, at: str, labels: dict[int, str], out: str,
        raw: str | None = None) -> DataFrame:
    """Follow the labelled link of the page in column ``at``; without one the new column is NULL.

    ``rows`` has a branch column. ``raw`` also returns the reference as written.
    """
    first = labelled_links(links, labels).select(
        F.col("page_url").alias(at), "branch",
        *([F.col("href").alias(raw)] if raw else []),
        F.col("abs_url").alias(out),
    )
    return rows.join(first, [at, "branch"], "left")


def captured(rows: DataFrame, pages: DataFrame, at: str) -> DataFrame:
    """Set the address to NULL where no such page was captured."""
    known = pages.select(F.col("page_url").alias(at)).distinct().withColumn("__known", F.lit(True))
    cols = [c for c in rows.columns if c != at]
    return rows.join(known, at, "left").select(
        *cols, F.when(F.col("__known"), F.col(at)).alias(at)
    )


def branches_to_columns(rows: DataFrame, keys, cols, branches=(1, 2)) -> DataFrame:
    """One row per key with ``<col>_<branch>`` columns; one aggregate with fixed columns."""
    picks = [
        F.max(F.when(F.col("branch") == b, F.col(c))).alias(f"{c}_{b}") for c in cols for b in branches
    ]
    return rows.groupBy(*keys).agg(*picks)
