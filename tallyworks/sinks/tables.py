"""Partitioned and plain table writes.

Partitioned writes are rebalanced by the partition columns: small partitions become few files, and
a partition that holds most of the rows is written by many tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks.session import scratch_dir


@dataclass(frozen=True)
class Buckets:
    """A table is kept in ``number`` files by the hash of ``column``, each sorted by it.

    Joins and aggregations by that column then read it as it lies: only the other side is shuffled. ``number`` should give files
    of some hundred MB when the table has grown, and be at least ``spark.sql.shuffle.partitions``: below that Spark prefers a
    shuffle with more tasks.
    """

    column: str
    number: int

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows as the buckets want them: one task, and so one file, per bucket."""
        return df.repartition(self.number, self.column).sortWithinPartitions(self.column)


def _rebalanced(df: DataFrame, parts: Sequence[str], buckets: Buckets | None = None) -> DataFrame:
    if buckets is not None:
        return buckets.dealt(df)
    return df.hint("rebalance", *parts) if parts else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The row count is observed by the write itself; no second run of the query."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def write_partitions(df: DataFrame, path: str, parts: Sequence[str], fmt: str = "parquet") -> int:
    """Replace exactly the partitions present in ``df``; returns the rows written."""
    counted, observation = _counted(_rebalanced(df, parts))
    (
        counted.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .save(path)
    )
    return observation.get["rows"]


def write_run(df: DataFrame, path: str, run_date: dt.date, fmt: str = "parquet") -> int:
    """Replace the results of one run date below ``path``, also by none."""
    counted, observation = _counted(df.drop("run_date"))
    counted.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/run_date={run_date.isoformat()}")
    return observation.get["rows"]


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    parts: Sequence[str] = (),
    fmt: str = "orc",
    location: str | None = None,
    buckets: Buckets | None = None,
) -> None:
    """Create the database and the table if they do not exist; partition columns come last."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    plain = [f for f in schema.fields if f.name not in parts]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*plain, *[schema[p] for p in parts]])
    partitioned = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    place = f"LOCATION '{location}'" if location else ""
    dealt = f"CLUSTERED BY (`{buckets.column}`) SORTED BY (`{buckets.column}`) INTO {buckets.number} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} {partitioned} {dealt} {place}")


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Catalog tables take the mode from the session; a writer option is ignored or would stick."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _insert(df: DataFrame, table: str, mode: str, parts: Sequence[str], buckets: Buckets | None = None) -> int:
    columns = df.sparkSession.table(table).columns
    counted, observation = _counted(_rebalanced(df.select(*columns), parts, buckets))
    with _overwrite_mode(df.sparkSession, "dynamic"):
        counted.write.mode(mode).insertInto(table)
    return observation.get["rows"]


def overwrite_table_partitions(df: DataFrame, table: str, parts: Sequence[str], buckets: Buckets | None = None) -> int:
    """Replace exactly the partitions of a catalog table that are present in ``df``; all of one without partitions."""
    return _insert(df, table, "overwrite", parts, buckets)


def replace_day(df: DataFrame, table: str, parts: Sequence[str], day: dt.date) -> int:
    """Replace all partitions of a catalog table whose first partition column is ``day``.

    Partitions of the day that ``df`` lacks are emptied, so a second run leaves nothing of the first. All rows of
    ``df`` belong to the day. ``df`` must not read the table: ``stage`` it where it does.
    """
    first, *others = parts
    columns = [c for c in df.sparkSession.table(table).columns if c != first]
    counted, observation = _counted(_rebalanced(df.select(*columns), others))
    spec = ", ".join([f"`{first}` = '{day.isoformat()}'", *[f"`{c}`" for c in others]])
    names = ", ".join(f"`{c}`" for c in columns)
    with _overwrite_mode(df.sparkSession, "static"):
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {names} FROM {{rows}}", rows=counted)
    return observation.get["rows"]


def append_rows(df: DataFrame, table: str, parts: Sequence[str] = ()) -> int:
    """Append to a catalog table; columns are matched by name, whatever their order in ``df``."""
    return _insert(df, table, "append", parts)


def replace_table(
    df: DataFrame,
    table: str,
    parts: Sequence[str],
    fmt: str = "orc",
    location: str | None = None,
    buckets: Buckets | None = None,
) -> int:
    """Rebuild a whole table; partitions that are not in ``df`` are gone afterwards."""
    counted, observation = _counted(_rebalanced(df, parts, buckets))
    writer = counted.write.format(fmt).mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    if buckets is not None:
        writer = writer.bucketBy(buckets.number, buckets.column).sortBy(buckets.column)
    if location:
        writer = writer.option("path", location)
    with _overwrite_mode(df.sparkSession, "static"):
        writer.saveAsTable(table)
    return observation.get["rows"]


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write to a new folder of the shared scratch space and read it back.

    Several readers then share one computation, and a lost executor does not bring it back.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
