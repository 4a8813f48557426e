"""The stages of the corpus pipeline and how they run one after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, minhash, mixing, sharding
from .common import bucket, saved, small, table


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not among ``ids``; one without an id can't be and stays."""
    return docs.join(small(saved(ids.select(F.col("doc_id").alias("__gone")).distinct(), "gone")), F.col("doc_id") == F.col("__gone"), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled rows; those without letters or in no usual one go."""
    model = langid.fit(docs.filter(bucket("doc_id", 5) != 0).select("doc_id", "text", "lang"))
    return langid.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; of rows that repeat an id one."""
    kept = _without(docs, minhash.near_duplicates(docs.select("doc_id", "text")).filter(~F.col("kept")))
    again = saved(docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    twice = kept.join(small(again.select(F.col("doc_id").alias("__again"))), F.col("doc_id") == F.col("__again"), "left_semi")
    return _without(kept, again).union(twice.dropDuplicates(["doc_id"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return _without(docs, decontam.leaks(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which the sources are mixed: files by number, rows by place."""
    place = mixing.mix(docs.select("doc_id", "source")).select(F.col("doc_id").alias("__id"), F.col("position").alias("__place"))
    placed = docs.join(place, F.col("doc_id").eqNullSafe(F.col("__id")))
    return placed.repartitionByRange("__place").sortWithinPartitions("__place").select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight contiguous shards of nearly equal bytes, along the order in which the documents were written."""
    if docs.inputFiles() and "_metadata" not in docs.columns:
        name = F.col("_metadata.file_name")
        docs = docs.select("doc_id", "text", F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long").alias("number"),
                           name.alias("name"), F.col("_metadata.row_index").alias("line"))
        order = {"k_number": F.col("number"), "k_name": F.col("name"), "k_line": F.col("line")}
    else:
        order = {"k_id": F.col("doc_id")}
    return sharding.shards(docs, order=order, whole_groups=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mixture),
    ("sharding", shard),
]

# Models, sketches and alignments decide which rows are left: SQL can't say them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage-{name}")
    return docs
