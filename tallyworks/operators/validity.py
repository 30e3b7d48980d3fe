"""Lookup of the version of a dimension row that held at a fact's time.

A join on the key with the fact's time between a version's start and end pairs every fact with every version of its key.
Here nothing is paired: facts are reduced to distinct (key, instant), instants and versions meet in time bins, and one ordered
pass per bin carries the version begun last. What began before a bin comes in as one carry row per bin that is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_INSTANT = "_instant"


def _bin(instant: Column, seconds: int) -> Column:
    micros = seconds * 1_000_000
    return instant - F.pmod(instant, F.lit(micros))


def valid_at(
    facts: DataFrame,
    versions: DataFrame,
    *,
    key: str,
    at: str,
    start: str,
    end: str,
    columns: Sequence[str],
    bin_seconds: int = 3600,
) -> DataFrame:
    """``facts`` with ``columns`` of the version of their ``key`` that is valid at ``at``: from ``start`` on, before ``end``.

    Versions of a key do not overlap; where they do, the one that began last counts, and of those that began together the one
    that ends last. A version without a start is valid from the beginning of time, one without an end for ever. Facts
    outside every version, or without a key or a time, have nulls. Every fact stays one row.

    The facts are shuffled once, by key and instant, so a key that a third of all facts have is spread over its instants;
    before that only distinct instants move. A key's versions meet its asked bins, not its facts.
    """
    asked = facts.select(key, F.unix_micros(at).alias(_INSTANT)).filter(F.col(key).isNotNull() & F.col(_INSTANT).isNotNull()).distinct()
    asked = asked.withColumn("_bin", _bin(F.col(_INSTANT), bin_seconds))
    bins = asked.select(key, "_bin").distinct()

    earliest = F.lit(-(1 << 62))
    version = F.struct(F.unix_micros(end).alias("_end"), *columns)
    begun = versions.filter(F.col(key).isNotNull()).select(
        key, F.coalesce(F.unix_micros(start), earliest).alias(_INSTANT), version.alias("_version")
    )
    # Rows of one instant: versions by their end, then what asks.
    order = [F.col(_INSTANT), F.col("_asks"), F.col("_version._end").asc_nulls_last()]
    unending = F.col("_version._end").isNull()
    stream = begun.select(key, _INSTANT, F.lit(False).alias("_asks"), "_version").unionByName(
        bins.select(key, F.col("_bin").alias(_INSTANT), F.lit(True).alias("_asks")), allowMissingColumns=True
    )
    so_far = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = stream.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter("_asks AND _version IS NOT NULL")
    carried = carried.select(key, F.col(_INSTANT).alias("_bin"), F.col(_INSTANT), "_version")

    inside = begun.withColumn("_bin", _bin(F.col(_INSTANT), bin_seconds)).filter(F.col(_INSTANT) > F.col("_bin"))
    inside = inside.join(bins, [key, "_bin"], "left_semi").select(key, "_bin", _INSTANT, "_version")
    merged = (
        carried.withColumn("_asks", F.lit(False))
        .unionByName(inside.withColumn("_asks", F.lit(False)))
        .unionByName(asked.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
    )
    in_bin = Window.partitionBy(key, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        merged.withColumn("_version", F.last("_version", ignorenulls=True).over(in_bin))
        .filter(F.col("_asks") & F.col("_version").isNotNull() & (unending | (F.col(_INSTANT) < F.col("_version._end"))))
        .select(F.col(key).alias("_key"), F.col(_INSTANT).alias("_when"), *[F.col(f"_version.{c}").alias(c) for c in columns])
    )
    same = (F.col(key) == F.col("_key")) & (F.unix_micros(at) == F.col("_when"))
    return facts.join(found, same, "left").drop("_key", "_when")
