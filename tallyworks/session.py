"""Session settings the operators are designed for, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Instants are compared and cut into days in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Skewed equi joins are split and small shuffles merged at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The default form of written times keeps no statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the cluster's shared ``spark.checkpoint.dir``.

    Where that is unset, as in tests, it lies below the warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
