"""Rolling aggregates that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.operators.skew import tag_slices


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    preceding: int,
    out: str,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``value`` over the current row and the ``preceding`` rows before it in its key.

    ``cuts`` (from ``hot_key_cuts``) splits hot keys into slices, and ``_slice`` is kept in the
    result. The last rows of each slice are repeated as a halo in front of the slices that still
    reach back to them, so every sum sees exactly its own rows.
    """
    if cuts is None:
        frame = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(-preceding, 0)
        return df.withColumn(out, F.sum(value).over(frame))
    body = tag_slices(df, keys, order_by, cuts, "left").withColumn("_halo", F.lit(False))
    needed = list(dict.fromkeys([*keys, *order_by, value]))
    halo = _halo(tag_slices(df.select(*needed), keys, order_by, cuts, "inner"), keys, order_by, preceding)
    frame = Window.partitionBy(*keys, "_slice").orderBy(*order_by).rowsBetween(-preceding, 0)
    return (
        body.unionByName(halo, allowMissingColumns=True)
        .withColumn(out, F.sum(value).over(frame))
        .filter(~F.col("_halo"))
        .drop("_halo")
    )


def _halo(hot_rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], preceding: int) -> DataFrame:
    """Rows to repeat in later slices: at most ``preceding`` per slice are looked at."""
    from_end = Window.partitionBy(*keys, "_slice").orderBy(*[F.col(c).desc() for c in order_by])
    tails = (
        hot_rows.withColumn("_from_end", F.row_number().over(from_end))
        .filter(F.col("_from_end") <= preceding)
        .drop("_from_end")
    )
    # A tail row reaches a later slice if that slice's first row is within the next rows.
    following = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(1, preceding)
    return (
        tails.withColumn("_reached", F.collect_set("_slice").over(following))
        .withColumn("_slice", F.explode(F.array_remove("_reached", F.col("_slice"))))
        .drop("_reached")
        .withColumn("_halo", F.lit(True))
    )


def trailing_count(df: DataFrame, key: str, ts: str, counted: str, seconds: int, out: str) -> DataFrame:
    """Per key and whole second: how many ``counted`` values lie in the last ``seconds`` up to it.

    Returns ``key``, ``_second`` and ``out``; all rows of one second share a result. Rows are counted
    per second before the shuffle. Each second's count comes in at its time and goes out again after
    ``seconds``, so one running sum answers all seconds in linear time.
    """
    per_second = df.groupBy(key, F.unix_timestamp(ts).alias("_second")).agg(F.count(counted).alias("_n"))
    dated = F.when(F.col("_second").isNotNull(), F.col("_n")).otherwise(0)
    comes = per_second.select(key, "_second", "_n", dated.alias("_change"))
    goes = per_second.filter("_second IS NOT NULL").select(
        key, (F.col("_second") + seconds + 1).alias("_second"), F.lit(None).cast("long").alias("_n"), (-F.col("_n")).alias("_change")
    )
    so_far = Window.partitionBy(key).orderBy("_second").rangeBetween(Window.unboundedPreceding, 0)
    running = comes.union(goes).withColumn("_sum", F.sum("_change").over(so_far)).filter("_n IS NOT NULL")
    return running.select(key, "_second", F.when(F.col("_second").isNull(), F.col("_n")).otherwise(F.col("_sum")).alias(out))
