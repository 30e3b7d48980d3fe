"""Newest or oldest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order_by``.

    ``row_number() = 1`` is planned as a group limit on both sides of the shuffle, so every map
    task ships at most one row per key, however many rows a key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep_latest_ties(df: DataFrame, keys: Sequence[str], latest_by: str) -> DataFrame:
    """All rows that hold the largest ``latest_by`` of their key; rows without a value are dropped.

    ``rank() = 1`` is planned as a group limit on both sides of the shuffle: one scan, and every map task
    ships only a key's newest rows.
    """
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(latest_by).desc()))
    return df.filter(F.col(latest_by).isNotNull()).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def boundary_row(
    value: Sequence[str], order_by: Sequence[str], which: str = "first", where: Column | None = None
) -> Column:
    """Aggregate: the ``value`` columns, as a struct, of the first or last row by ``order_by``.

    The values take part in the order, which settles ties.
    """
    pick = {"first": F.min, "last": F.max}[which]
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)], *value)
    return pick(row if where is None else F.when(where, row))
