"""Contiguous shards of equal bytes, from global prefix sums over range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running, saved


def shards(
    docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    order: dict[str, Column] | None = None, whole_groups: bool = True,
) -> DataFrame:
    """Cut all documents, in a global order, into ``n_shards`` runs of nearly equal bytes.

    ``order`` names sort expressions; by default documents are sorted by the hash of their text, so that equal texts are
    neighbours, then by id. The size of a document is the UTF-8 length of its text plus 1; null counts as empty. Shard k ends at
    the row boundary nearest to byte k/n of the whole. With ``whole_groups``, a run of equal texts across such a boundary moves
    to the nearer side as one if it is no larger than the largest document; a larger run is cut between rows. Either way a cut is
    off its target by no more than the largest document.

    Returns per row: the id, size, text_crc32 (unsigned), shard, slot (from 0, gapless in each shard), position (from 0, over
    all). Only these narrow values are shuffled. Fewer rows than shards leave shards empty; an empty table gives no rows; rows
    that repeat an id are rows of their own; a null id sorts first. Other columns are not read. Eager.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = order or {"k_text": F.xxhash64(text), "k_id": F.col(id_col)}
    narrow = saved(docs.select(
        F.col(id_col), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k_same"), *[e.alias(k) for k, e in order.items()],
    ), "sizes")
    placed = saved(running(narrow, list(order), "size"), "placed").withColumn("end", F.col("start") + F.col("size"))
    whole = placed.agg(F.sum("size").alias("total"), F.max("size").alias("largest")).first()
    total, largest = whole["total"] or 1, whole["largest"] or 1
    cuts = _cuts(placed, n_shards, total, largest if whole_groups else 0)
    # One comparison per cut; there are n_shards - 1 of them.
    before = [F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts]
    numbered = placed.withColumn("shard", sum(before, F.lit(0)).cast("int"))
    first = numbered.groupBy(F.col("shard").alias("f_shard")).agg(F.min("index").alias("first"))
    return numbered.join(F.broadcast(first), F.col("shard") == F.col("f_shard")).select(
        id_col, "size", "text_crc32", "shard", (F.col("index") - F.col("first")).alias("slot"), F.col("index").alias("position"),
    )


def _cuts(placed: DataFrame, n_shards: int, total: int, whole_up_to: int) -> list[int]:
    """Byte offsets of the n_shards - 1 cuts. At most that many rows lie across a target, so few rows reach the driver."""
    share = lambda c: F.floor(F.col(c) * F.lit(n_shards).cast("decimal(20,0)") / F.lit(total).cast("decimal(20,0)"))
    across = placed.filter(share("end") > share("start")).select("start", "end", "k_same").collect()
    same = [r["k_same"] for r in across]
    runs = {
        r["k_same"]: (r["s"], r["e"])
        for r in placed.filter(F.col("k_same").isin(same)).groupBy("k_same")
        .agg(F.min("start").alias("s"), F.max("end").alias("e"), F.sum("size").alias("b")).filter(F.col("e") - F.col("s") == F.col("b"))
        .collect()
    } if same and whole_up_to else {}
    cuts = []
    for k in range(1, n_shards):
        target = k * total / n_shards
        row = next((r for r in across if r["start"] < target <= r["end"]), None)
        if row is None:
            cuts.append(round(target))
            continue
        low, high = runs.get(row["k_same"], (row["start"], row["end"]))
        if high - low > whole_up_to:
            low, high = row["start"], row["end"]
        cuts.append(low if target - low < high - target else high)
    return cuts
