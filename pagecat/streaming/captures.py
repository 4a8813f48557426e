"""Captured pages as a stream: of several captures of one URL the newest stays, in whatever order files arrive.

The state holds the newest time of each URL and the file it came from, never the text. Texts are read in a second step, from the files
of the micro-batch only, and of these only what is newer than all before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ranking import last_per_key
from ..operators.running import micros
from ..sources.tables import scan_pages
from .gates import read_stream

# A missing time counts as newest, as in the batch form.
_NEWEST = 2**63 - 1


def _moment(captured_at: str, schema) -> Column:
    number = schema[captured_at].dataType.simpleString() in ("bigint", "int")
    return F.coalesce(F.col(captured_at).cast("bigint") if number else micros(captured_at), F.lit(_NEWEST))


def newer_captures(captures: DataFrame, captured_at: str) -> DataFrame:
    """(url, file, t) for each URL whose newest capture lies in this micro-batch; of captures of one time that of the last file by name.

    ``captures`` is a stream of files. Rows without a URL go by their file: each file that holds any is named once. A URL's rows of one
    micro-batch meet in one task as three short columns, a batch of Arrow rows at a time.
    """
    file = F.col("_metadata.file_path")
    light = captures.select("url", _moment(captured_at, captures.schema).alias("t"), file.alias("file"), F.when(F.col("url").isNull(), file).alias("of"))

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = best = tuple(state.get) if state.exists else None
        for pdf in pdfs:
            here = max(zip(pdf["t"].tolist(), pdf["file"].tolist(), strict=True))
            best = here if best is None else max(best, here)
        if best != before:
            state.update(best)
            yield pd.DataFrame({"url": [key[0]], "file": [best[1]], "t": [best[0]]})

    return light.groupBy("url", "of").applyInPandasWithState(
        step, "url string, file string, t bigint", "t bigint, file string", "append", GroupStateTimeout.NoTimeout)


def keep_newest(spark: SparkSession, path: str, schema, captured_at: str, out: str, checkpoint: str, **options) -> None:
    """Take in the files that are new under ``path``; captures newer than those known are added to ``out``, with their texts.

    Files per micro-batch are bounded (``maxFilesPerTrigger``, 64), and so is the list of files read again. A micro-batch writes a folder of
    its own, which a repeated one replaces. ``current_pages`` reads the result.
    """
    def batch(newer: DataFrame, number: int) -> None:
        newer = newer.persist()
        files = [r["file"] for r in newer.select("file").distinct().collect()]
        texts = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
        rows = texts.select("*", _moment(captured_at, texts.schema).alias("__t"), F.col("_metadata.file_path").alias("__file"))
        known = newer.select(F.col("url").alias("__u"), F.col("file").alias("__f"), F.col("t").alias("__n"))
        found = rows.join(known, (F.col("url") == F.col("__u")) & (F.col("__file") == F.col("__f")) & (F.col("__t") == F.col("__n")), "left_semi")
        # Repeated captures of one time in one file: the one that sorts last by text.
        one = last_per_key(found, ["url"], [F.col("html")], [c for c in texts.columns if c not in ("url", "_metadata")])
        nameless = rows.filter("url IS NULL").join(known.filter("__u IS NULL"), F.col("__file") == F.col("__f"), "left_semi")
        cols = [c for c in texts.columns if c != "_metadata"]
        one.select(*cols).unionByName(nameless.select(*cols)).write.mode("overwrite").parquet(f"{out}/batch={number}")
        newer.unpersist()

    stream = read_stream(spark, path, schema, **options)
    newer_captures(stream, captured_at).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def current_pages(spark: SparkSession, out: str, captured_at: str) -> DataFrame:
    """(url, html): the newest capture of each URL that ``keep_newest`` has taken in. Eager, as ``scan_pages``."""
    return scan_pages(spark.read.parquet(out).drop("batch"), captured_at)
