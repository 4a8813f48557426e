"""Connected groups of links: union-find inside partitions, alternating stars between them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _forest(batches):
    """Union-find over the links of a partition: each node with the smallest node of its local group."""
    parent: dict[int, int] = {}

    def find(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = [x for x in list(parent) if find(x) != x]
    yield pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array([find(x) for x in nodes], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots; a root is the smallest node of its group.

    Each partition first reduces its links to a forest. Then rounds of large stars (larger neighbours go to the smallest one) and
    small stars (smaller neighbours likewise) follow until nothing changes, some log(n) of them; a node with many neighbours is
    aggregated before it is shuffled and its joins can be split. Each round is stored. Eager.
    """
    edges = saved(links.select("a", "b").mapInArrow(_forest, "a long, b long"), "links")
    said = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("x")).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.distinct(), "large")
        least = large.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("x"))
        small = small.select("a", F.col("m").alias("b")).union(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = saved(small.distinct(), "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == said:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        said = now
