"""Reading and writing tables: scans, appends, versioned snapshots, clears, JSON columns."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.ranking import latest_per_key
from ..session import cut, few


def scan(spark: SparkSession, path: str, cols=None, where: Column | None = None) -> DataFrame:
    """Column-projected, filtered scan; both reach the Parquet reader."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*cols) if cols else df


def scan_pages(pages: DataFrame, captured_at: str | None = None, limit: int = 32 << 20) -> DataFrame:
    """Captured pages; of several captures of one URL the latest stays. Pages without a URL are all kept.

    URLs are counted first, without the page text, and only the texts of those captured again are shuffled. The list of
    these is broadcast if it has ``limit`` bytes at most; otherwise it is joined by a shuffle. Eager.
    """
    if captured_at is None:
        return pages.select("url", "html")
    again = cut(
        pages.filter(F.col("url").isNotNull()).groupBy("url").agg(F.count("*").alias("n")).filter("n > 1").select("url")
    )
    again = few(again, "url", limit)
    single = pages.join(again, "url", "left_anti").select("url", "html")
    several = pages.join(again, "url", "left_semi")
    return single.unionByName(latest_per_key(several, ["url"], captured_at, ["html"]).select("url", "html"))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def config_value(config: DataFrame, key: str) -> DataFrame:
    """Exactly one row (url); none or several raise when the row is read."""
    rows = config.filter(F.col("key") == key).agg(
        F.count("*").alias("n"), F.first("url").alias("url")
    )
    return rows.select(
        F.when(F.col("n") == 1, F.col("url"))
        .otherwise(F.raise_error(F.concat(F.lit(f"rows for {key}: "), F.col("n").cast("string"))))
        .alias("url")
    )


def with_config(df: DataFrame, config: DataFrame, key: str, out: str) -> DataFrame:
    """Put the one configured value on every row, as a scalar subquery."""
    return df.withColumn(out, config_value(config, key).scalar())


def to_json_col(col) -> Column:
    return F.to_json(col)


def to_variant_col(col) -> Column:
    """A value as VARIANT, through its JSON text."""
    return F.parse_json(F.to_json(col))


def variant_entries(col, fields: dict[str, str]) -> Column:
    """The entries of a VARIANT list as structs of the given fields (name to type); a missing field is NULL, no list has no entries."""
    entry = lambda e: F.struct(*[F.try_variant_get(e, f"$.{name}", kind).alias(name) for name, kind in fields.items()])
    value = F.col(col) if isinstance(col, str) else col
    return F.transform(F.when(F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")), entry)


def from_json_col(col, schema: str = schemas.PAYLOAD) -> Column:
    return F.from_json(col, schema)


class Conflict(ValueError):
    """Another publisher has listed the version first."""


class Snapshots:
    """Tables published together as versions. A version is a list of tables and where each one's rows lie.

    Rows are written first, to a folder of their own; the list follows as one small file that is put in its place in one step, and
    only if none is there: of two publishers of one version one gets a ``Conflict``, reads again and merges again (``retried``). A
    table that a version does not write stays where it was. A table may lie in buckets by the hash of a key; then a version lists each
    bucket, and writes only those it changes.
    """

    LIST = "version INT, tbl STRING, bucket INT, buckets INT, by STRING, at STRING"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> int:
        folder = self._hadoop.Path(f"{self.path}/published")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def lists(self, version: int | None = None) -> list:
        """The rows of a version's list: one for each table, or bucket of it."""
        version = self.current() if version is None else version
        if not version:
            return []
        return self.spark.read.schema(self.LIST).json(f"{self.path}/published/{version}.json").collect()

    def tables(self) -> list[str]:
        return sorted({r["tbl"] for r in self.lists()})

    def read(self, table: str, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a table, or those of some of its buckets."""
        rows = [r for r in self.lists(version) if r["tbl"] == table]
        if not rows:
            raise KeyError(f"no table {table} in {self.path}")
        schema = self.spark.read.parquet(rows[0]["at"]).schema
        wanted = [r["at"] for r in rows if buckets is None or r["bucket"] is None or r["bucket"] in set(buckets)]
        return self.spark.read.schema(schema).parquet(*wanted) if wanted else self.spark.createDataFrame([], schema)

    def layout(self, table: str, version: int | None = None) -> tuple[str, int] | None:
        """(key, number of buckets) of a table in buckets."""
        return next(((r["by"], r["buckets"]) for r in self.lists(version) if r["tbl"] == table and r["bucket"] is not None), None)

    def touched(self, table: str, keys: DataFrame, version: int | None = None) -> list[int]:
        """The buckets of a table in which the keys (the one column given) lie."""
        _, n = self.layout(table, version)
        found = keys.select(bucket_of(F.col(keys.columns[0]), n).alias("b")).distinct()
        return sorted(r["b"] for r in found.collect())

    def _place(self, text: str, name: str) -> None:
        """Put a small file in its place in one step; ``Conflict`` if there is one."""
        path = self._hadoop.Path(f"{self.path}/published/{name}")
        draft = self._hadoop.Path(f"{self.path}/published/.{name}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                # A local rename would replace the file; a link does not.
                os.link(draft.toUri().getPath(), path.toUri().getPath())
            else:
                none = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
                self._hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, path, none)
        except FileExistsError as err:
            raise Conflict(f"{name} is there") from err
        except Py4JJavaError as err:
            if "FileAlreadyExists" in str(err.java_exception):
                raise Conflict(f"{name} is there") from err
            raise
        finally:
            if self._fs.exists(draft):
                self._fs.delete(draft, False)

    def publish(self, tables: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None,
                bucketed: dict[str, tuple[str, int]] | None = None, parts: dict[str, list[int]] | None = None, based_on: int | None = None) -> int:
        """Write the given tables, then the list of the next version. A failed write leaves the old version.

        ``bucketed`` lays a table out by (key, number of buckets). ``parts`` says that a table's rows are those of the named buckets only: these
        are replaced, the others stay where they are. ``based_on`` is the version that was read, by default the current one.
        """
        base = self.current() if based_on is None else based_on
        listed = {(r["tbl"], r["bucket"]): r for r in self.lists(base)}
        rows = {k: (r["buckets"], r["by"], r["at"]) for k, r in listed.items()}
        for name, df in tables.items():
            place = f"{self.path}/rows/{name}-{uuid.uuid4().hex}"
            layout = (bucketed or {}).get(name)
            replaced = (parts or {}).get(name)
            if replaced is not None:
                layout = self.layout(name, base)
            rows = {k: v for k, v in rows.items() if k[0] != name or replaced is not None and k[1] not in set(replaced)}
            if layout is None:
                cols = (partition_by or {}).get(name)
                (df.write.partitionBy(*cols) if cols else df.write).parquet(place)
                rows[name, None] = (None, None, place)
                continue
            by, n = layout
            df.withColumn("__bucket", bucket_of(F.col(by), n)).repartition("__bucket").write.partitionBy("__bucket").parquet(place)
            # A bucket without rows keeps an entry, so that a table always has a schema to read.
            empty = f"{place}/__empty"
            df.limit(0).write.parquet(empty)
            made = {int(f.getPath().getName().split("=")[1]) for f in self._fs.listStatus(self._hadoop.Path(place)) if "__bucket=" in f.getPath().getName()}
            for b in range(n) if replaced is None else replaced:
                rows[name, b] = (n, by, f"{place}/__bucket={b}" if b in made else empty)
        text = "".join(json.dumps({"version": base + 1, "tbl": t, "bucket": b, "buckets": n, "by": by, "at": at}) + "\n"
                       for (t, b), (n, by, at) in sorted(rows.items(), key=str))
        self._fs.mkdirs(self._hadoop.Path(f"{self.path}/published"))
        self._place(text, f"{base + 1}.json")
        return base + 1

    def retried(self, merge: Callable[[int], int], times: int = 5) -> int:
        """``merge(version)`` publishes on top of that version; when another publisher was first, it is asked again with the new one."""
        for left in range(times, 0, -1):
            try:
                return merge(self.current())
            except Conflict:
                if left == 1:
                    raise
        raise AssertionError("times must be 1 or more")

    def clear(self, tables: list[str], children: dict[str, list[str]] | None = None) -> int:
        """Empty the named tables and, through ``children``, those that refer to them; all others stay."""
        names = list(tables)
        for name in names:
            names += [c for c in (children or {}).get(name, []) if c not in names]
        layouts = {name: self.layout(name) for name in names}
        return self.publish({name: self.read(name).limit(0) for name in names}, bucketed={k: v for k, v in layouts.items() if v})


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key; NULL keys share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
