"""Cutting the few keys that hold very many rows into ordered slices.

A window over one key runs in one task. Where a key may hold a large share of a table, it is cut
into slices that follow the window's own order; each slice then runs as a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotSplit:
    """No task of a window gets many more rows than ``share`` of all of them, or ``floor`` rows where that is more.

    A key with more rows than that is hot and is cut into slices of about that many, so slices follow the data: their number
    grows with a key's rows, and a key just below the bound is no larger than a slice. Fewer than 1 / share
    keys can be hot, and they have fewer than 1 / share cut points together, which bounds the broadcast
    cut table whatever the size of the data.
    """

    share: float = 1e-4
    floor: int = 500_000

    def __post_init__(self) -> None:
        if not 1e-5 <= self.share < 1:
            raise ValueError("share must be at least 0.00001: it bounds the number of hot keys and cut points")

    def rows_per_slice(self, total: int) -> int:
        return max(1, self.floor, ceil(total * self.share))


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def _order_tuple(order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])


def hot_key_cuts(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], split: HotSplit
) -> DataFrame | None:
    """One row per hot key: ``_k_<key>`` columns and ``_cuts``, its sorted cut points.

    None if no key is hot, so that the caller can plan a plain window. Finding out is one count by
    key, run at once: it reads the key columns only, and one row comes back; only where a key is hot a second count brings
    fewer than 1 / share rows. Cut points are order tuples picked by hash, so a rerun picks the same ones.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    seen = counts.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("largest")).first()
    bound = split.rows_per_slice(seen["total"] or 0)
    if (seen["largest"] or 0) <= bound:
        return None
    found = counts.filter(F.col("_rows") > bound).collect()
    hot = df.sparkSession.createDataFrame(found, counts.schema)
    every = F.lit(bound)
    picked = df.select(*keys, _order_tuple(order_by).alias("_order")).join(
        F.broadcast(hot), _same(keys, "_k_"), "inner"
    ).filter(F.pmod(F.xxhash64("_order"), every) == 0)
    return picked.groupBy(*[f"_k_{k}" for k in keys]).agg(
        F.sort_array(F.collect_set("_order")).alias("_cuts")
    )


def tag_slices(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], cuts: DataFrame, how: str) -> DataFrame:
    """Add ``_slice``: how many cut points of the row's key are at or before it, 0 for other keys.

    ``how="inner"`` keeps the rows of hot keys only.
    """
    at_or_before = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_order")))
    return (
        df.withColumn("_order", _order_tuple(order_by))
        .join(F.broadcast(cuts), _same(keys, "_k_"), how)
        .withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(at_or_before))
        .drop("_order", "_cuts", *[f"_k_{k}" for k in keys])
    )


def spread_over_slices(dim: DataFrame, keys: Sequence[str], cuts: DataFrame) -> DataFrame:
    """Repeat a dimension row for every slice its key was cut into.

    Joining on the key and ``_slice`` then reuses the partitioning of a sliced window.
    """
    last = F.coalesce(F.size("_cuts"), F.lit(0))
    return (
        dim.join(F.broadcast(cuts), _same(keys, "_k_"), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.when(F.col("_cuts").isNull(), 0).otherwise(last))))
        .drop("_cuts", *[f"_k_{k}" for k in keys])
    )
