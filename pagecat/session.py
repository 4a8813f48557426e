"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings the operators rely on. A value the user has set stays as it is.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later step could have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Captured pages are large rows: keep one Arrow batch small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME to a session, leaving what was set at its start alone."""
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RUNTIME.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


# Settings only a new session can take.
STATIC = {
    "spark.ui.enabled": "false",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Wide plans have more than the default 100 generated classes; beyond that every run compiles anew.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build(name: str = "pagecat", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above; without a web page."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC, **RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local session may fall back to a temporary one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current is None:
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="pagecat-")
        sc.setCheckpointDir(named)
        current = sc.getCheckpointDir()
    return named or current


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder. What is written there stays until ``clean``."""
    _SCRATCH.append(f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def clean(spark: SparkSession) -> int:
    """Delete what this process has stored in scratch paths; how many there were. Results that still read them must be written first."""
    paths, _SCRATCH[:] = list(_SCRATCH), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def few(df: DataFrame, column: str, limit: int = 32 << 20) -> DataFrame:
    """Rows of one text column, marked for broadcast if their bytes, added up, are within the limit; otherwise as they are. Eager."""
    size = df.agg(F.sum(F.octet_length(column) + 32)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``cut``, but as Parquet: the rows are computed once (a checkpoint computes them again to write them) and read by column."""
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
