"""Helpers of the corpus operators: tables, the shared folder, row numbers, free column names."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, seen by the driver and all executors.

    It lies below ``spark.checkpoint.dir``; where that is unset, as in tests, below the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_removed_at_end: set[str] = set()


def _removed(spark: SparkSession, folder: str) -> None:
    """The application's intermediate tables go when the driver ends, if nobody has cleared them before."""
    if folder not in _removed_at_end:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
        _removed_at_end.add(folder)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: cuts the lineage, survives lost executors, is computed once.

    Once the table is complete nothing reads the shuffles that led to it, so their files go with the write
    instead of waiting for the driver's garbage collection.
    """
    folder = shared_folder(df.sparkSession)
    path = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    with _shuffles_released(df.sparkSession):
        df.write.parquet(path)
    _removed(df.sparkSession, folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, once nothing reads results built on them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def map_arrow(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package's code sent to the executors once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(), "tallyworks.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, files in os.walk(top):
                for name in sorted(f for f in files if f.endswith(".py")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return df.mapInArrow(function, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def untaken(df: DataFrame, *names: str) -> None:
    """Raise where ``df`` has an output column of one of these names already, in any case."""
    both = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if both:
        raise ValueError(f"output columns {sorted(both)} are taken; give other names")


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased, null as empty. ``lower`` is the same and faster where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
