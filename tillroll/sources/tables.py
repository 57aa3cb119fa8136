"""Table scans.

Everything is read lazily with `spark.read.parquet`, so Catalyst prunes columns and pushes filters into the scan. A
warehouse relation can be passed by name instead (`spark.table`), which is how a month-stamped snapshot such as
`sales.order_lines_<yyyy_mm>_<stamp>` is read: by its name, or as the latest one not after a month.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def read_table(spark: SparkSession, source: str, name: str | None = None) -> DataFrame:
    """Read a table from a directory of `<name>.parquet` files, or a catalog table when `name` is None."""
    if name is None:
        return spark.table(source)
    path = os.path.join(source, f"{name}.parquet")
    return spark.read.parquet(path)


class NoSnapshotError(LookupError):
    pass


#: Rows of a bucket, on the average: the one that is written sorts them in one task. Spark allows no more than MAX_BUCKETS.
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 100_000


#: The year, month and load stamp after a snapshot's base name.
SNAPSHOT_SUFFIX = r"_(\d{4})_(\d{2})(?:_(\w+))?$"


def snapshots(spark: SparkSession, base: str) -> list[tuple[str, str, str]]:
    """(month as yyyy-mm, load stamp, table name) of the catalog's month-stamped snapshots of `base`, in order. `base` may name
    a schema (`sales.order_lines`)."""
    schema, _, prefix = base.rpartition(".")
    listed = spark.catalog.listTables(schema or None, f"{prefix}_*")
    found = []
    for t in listed:
        m = re.fullmatch(re.escape(prefix) + SNAPSHOT_SUFFIX, t.name, re.IGNORECASE)
        if m and "01" <= m[2] <= "12":
            found.append((f"{m[1]}-{m[2]}", m[3] or "", f"{schema}.{t.name}" if schema and not t.isTemporary else t.name))
    return sorted(found)


def latest_snapshot(spark: SparkSession, base: str, as_of: dt.date | str) -> str:
    """The name of the last loaded snapshot of the last month that isn't after the as-of date's month. Only names are read."""
    month = str(as_of)[:7]
    found = snapshots(spark, base)
    fitting = [s for s in found if s[0] <= month]
    if not fitting:
        others = f"; there are {', '.join(s[2] for s in found[:5])}" if found else ""
        raise NoSnapshotError(f"no snapshot of {base} for {month} or before{others}")
    return fitting[-1][2]


def read_snapshot(spark: SparkSession, base: str, as_of: dt.date | str | None = None) -> DataFrame:
    """Month-stamped sales snapshot (IO2): the table of that full name, or with `as_of` the latest snapshot of the base name."""
    return spark.table(base if as_of is None else latest_snapshot(spark, base, as_of))


def bucket_count(rows: int, least: int = 1) -> int:
    """Buckets for a table of so many rows, so that a bucket, and the task that sorts it, doesn't grow with the table."""
    return min(max(least, -(-rows // BUCKET_ROWS)), MAX_BUCKETS)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, key_of: Column | None = None,
                   columns: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Write `df` as a catalog table whose rows are dealt to `buckets` files by `key` and sorted by it, and return that table.

    A join or semi join of the table on `key` doesn't shuffle its side again: Spark deals the other, smaller side to the same
    buckets. For a table that every monthly report joins as a whole, the shuffle is paid once. `buckets` should grow with
    the table (`bucket_count`). The rows are dealt by key before they are written, so that a bucket is one file.

    If the table's columns are made of fewer, `columns` makes them of the dealt rows, so that only `df` as it is is shuffled;
    `key_of` is then the key in terms of `df`."""
    dealt = df.repartition(buckets, F.col(key) if key_of is None else key_of)
    made = dealt if columns is None else columns(dealt)
    # read every month, so packed tighter than by Spark's default
    writer = made.write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def sql_frame(spark: SparkSession, query: str, **params) -> DataFrame:
    """IO3/IO5: a SQL text with bound named parameters (`:start`, `:end`) as a lazy DataFrame (no string splicing)."""
    return spark.sql(query, args=params or None)


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str, lower: int, upper: int,
              num_partitions: int, fetch_size: int = 200_000, properties: dict | None = None) -> DataFrame:
    """Partitioned warehouse read (IO1/IO4): parallel range reads replace the chunked single-client fetch."""
    options = jdbc_options(url, query, partition_column, lower, upper, num_partitions, fetch_size, properties)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_options(url: str, query: str, partition_column: str, lower: int, upper: int, num_partitions: int,
                 fetch_size: int = 200_000, properties: dict | None = None) -> dict[str, str]:
    """The JDBC source takes no partition column together with `query`, so the query is an aliased subquery in `dbtable`.
    The bounds only set the strides; rows outside them are read by the first and last partition."""
    options = {"url": url, "dbtable": f"({query.strip().rstrip(';')}) AS source_rows", "partitionColumn": partition_column,
               "lowerBound": lower, "upperBound": upper, "numPartitions": num_partitions, "fetchsize": fetch_size}
    return {k: str(v) for k, v in (options | (properties or {})).items()}


class Tables:
    """Lazy accessor for the driver tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]
