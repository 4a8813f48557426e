"""How a query is registered: a Spark callable and, where SQL can say it, the same in DuckDB's SQL.

Derived tables are written once, in SQL both engines read: Spark runs the text over the given Parquet tables,
the oracle gets it as a common table expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagecat.session import tune

from .derived import DERIVED, USES

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables and those derived from them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = tune(spark), sf_dir

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name in DERIVED:
            for needed in USES[name]:
                self[needed].createOrReplaceTempView(needed)
            return self.spark.sql(DERIVED[name])
        return self.spark.read.parquet(self.path(name))


def _with(names, seen=None) -> list[str]:
    seen = [] if seen is None else seen
    for name in names:
        if name in DERIVED and name not in seen:
            _with(USES[name], seen)
            seen.append(name)
    return seen


def query(name: str, uses=(), oracle: str | None = None):
    """Register a query; ``uses`` names the derived tables its oracle reads."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ctes = [f"{t} AS ({DERIVED[t]})" for t in _with(uses)]
            text = oracle.strip()
            if ctes:
                head = "WITH RECURSIVE " if text.upper().startswith("WITH RECURSIVE") else "WITH "
                if text.upper().startswith("WITH "):
                    body = text[len("WITH RECURSIVE "):] if head != "WITH " else text[len("WITH "):]
                    text = head + ", ".join(ctes) + ", " + body
                else:
                    text = head + ", ".join(ctes) + " " + text
            ORACLES[name] = text
        return fn

    return add
