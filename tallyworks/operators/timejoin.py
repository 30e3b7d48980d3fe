"""Joins between intervals or instants on one side and a tick series on the other.

Neither operator pairs up rows. Ticks and probe instants of the same key meet in short time bins,
where one ordered pass answers every probe; what a probe needs from earlier bins is a single row or total
per bin. Probes are reduced to distinct instants first: many orders that start at
the market open cost one probe. ``keys`` may hold the key and the times themselves, which lets a caller ask once for
all rows that ask the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _bin_start(ts: Column, seconds: int) -> Column:
    """Never null, so that joins on it put no filter of their own below a window and shuffles can be shared."""
    second = F.unix_seconds(ts)
    return F.coalesce(second - F.pmod(second, F.lit(seconds)), F.lit(0).cast("long"))


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    by: str,
    targets: Mapping[str, str],
    right_ts: str,
    payload: Sequence[str],
    tie_break: Sequence[str] = (),
    lookback_seconds: int,
    bin_seconds: int = 60,
) -> DataFrame:
    """For each target time of a left row, the latest right row at or before it.

    ``targets`` maps an output prefix to a timestamp column of ``left``; all of them are answered in
    one pass. A right row older than ``lookback_seconds`` does not count; one exactly that old does.
    Right rows that share an instant are settled by the largest ``tie_break``, then by the largest payload, nulls
    smallest. Returns the ``keys`` (unique in ``left``) and ``<prefix>_<column>`` for the payload and
    the right timestamp; left rows without any match are absent.
    """
    prefixes = list(targets)
    probes = left.select(
        *dict.fromkeys([*keys, by]), F.posexplode(F.array(*[F.col(targets[p]) for p in prefixes])).alias("_slot", "_at")
    ).filter(F.col(by).isNotNull() & F.col("_at").isNotNull())
    instants = probes.select(by, "_at").distinct().withColumn("_bin", _bin_start(F.col("_at"), bin_seconds))

    # Ticks of one instant come in the order that settles them, so the last one before a probe is the one that counts.
    tick = F.struct(*[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_break)], *payload, F.col(right_ts))
    stream = (
        right.filter(F.col(by).isNotNull() & F.col(right_ts).isNotNull())
        .select(by, _bin_start(F.col(right_ts), bin_seconds).alias("_bin"), F.col(right_ts).alias("_at"), F.lit(0).alias("_side"), tick.alias("_tick"))
        .unionByName(instants.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    )
    onward = Window.partitionBy(by, "_bin").orderBy("_at", "_side", "_tick")
    so_far = onward.rowsBetween(Window.unboundedPreceding, 0)
    seen = stream.withColumns({"_hit": F.last("_tick", ignorenulls=True).over(so_far), "_ends": F.lead("_side").over(onward).isNull()})
    asked = seen.filter("_side = 1")
    newest = seen.filter("_ends AND _hit IS NOT NULL").select(by, "_bin", "_hit")  # one row per bin with ticks

    # Probes without a tick before them in their bin look at the bins before, of which the latest with ticks counts.
    reach = ceil(lookback_seconds / bin_seconds) * bin_seconds
    step = F.lit(bin_seconds).cast("long")
    before = F.sequence(F.col("_bin") - reach, F.col("_bin") - step, step)
    earlier = (
        asked.filter("_hit IS NULL")
        .select(by, "_at", F.explode(before).alias("_bin"))
        .join(newest, [by, "_bin"])
        .groupBy(by, "_at")
        .agg(F.max(F.struct("_bin", "_hit")).alias("_latest"))
        .select(by, "_at", F.col("_latest._hit").alias("_hit"))
    )
    oldest = F.col("_at") - F.expr(f"INTERVAL {int(lookback_seconds)} SECONDS")
    found = asked.filter("_hit IS NOT NULL").select(by, "_at", "_hit").unionByName(earlier)
    found = found.filter(F.col(f"_hit.{right_ts}") >= oldest)
    return probes.join(found, [by, "_at"]).groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_slot") == slot, F.col(f"_hit.{c}"))).alias(f"{prefix}_{c}")
            for slot, prefix in enumerate(prefixes)
            for c in [*payload, right_ts]
        ]
    )


#: Level of a whole parent: shifted that far, every place in it is 0.
_WHOLE = 62


def _edges(intervals: DataFrame, units: Sequence[int]) -> DataFrame:
    """``intervals`` as running sums to look up: at most two per tier.

    In the first tier an end is given by its parent (``_low``, ``_high``) and its place there (``_from``, ``_to``). A
    parent is a unit of the next tier, which has a parent of its own: so many ``units`` each, the last
    tier being one parent. An interval inside one parent is cut where its two ends
    first differ in a bit of their place: it runs to the end of one cell of that level and on from the start of the
    next. An interval that leaves its parent runs to the parent's end and on from another's start; the
    parents between are an interval of the next tier. No sum is ever taken away from another.
    """
    edge = lambda tier, parent, level, place, way: F.struct(
        F.lit(tier).alias("_tier"), parent.alias("_parent"), level.alias("_level"),
        F.call_function("shiftright", place, level).alias("_cell"), place.alias("_place"), F.lit(way).alias("_way"),
    )
    nothing, found = F.array(), []
    low, high, from_, to = (F.col(c) for c in ("_low", "_high", "_from", "_to"))
    for tier in range(len(units) + 1):
        level = F.when(low != high, _WHOLE).otherwise(F.length(F.bin(from_.bitwiseXOR(to))) - 1).cast("int")
        one = F.array(edge(tier, low, F.lit(0), from_, 1))
        two = F.array(edge(tier, low, level, from_, -1), edge(tier, high, level, to, 1))
        name = f"_edges{tier}"
        inside = (low < high) | ((low == high) & (from_ <= to))
        same = (low == high) & (from_ == to)
        intervals = intervals.withColumn(name, F.when(same, one).when(inside, two).otherwise(nothing))
        found.append(F.coalesce(name, nothing))
        if tier < len(units):
            between = (low < high) & (low + 1 <= high - 1)
            first, last = F.when(between, low + 1), F.when(between, high - 1)
            intervals = intervals.withColumns(
                {
                    "_low": _parent(first, units[tier]), "_high": _parent(last, units[tier]),
                    "_from": _place(first, units[tier]), "_to": _place(last, units[tier]),
                }
            )
    return intervals.withColumn("_edge", F.explode(F.concat(*found))).select("*", "_edge.*").drop(
        "_low", "_high", "_from", "_to", "_edge", *[f"_edges{t}" for t in range(len(units) + 1)]
    )


def _parent(index: Column, unit: int) -> Column:
    return F.floor((index - F.pmod(index, F.lit(unit))) / unit).cast("long") if unit else F.when(index.isNotNull(), 0).cast("long")


def _place(index: Column, unit: int) -> Column:
    """Where a unit lies in its parent, from 0; the last tier has a single parent."""
    return F.pmod(index, F.lit(unit)).cast("long") if unit else (index + F.lit(1 << 40)).cast("long")


def interval_vwap(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    by: str,
    start: str,
    end: str,
    right_ts: str,
    price: str,
    size: str,
    volume_out: str,
    vwap_out: str,
    bin_seconds: int = 60,
) -> DataFrame:
    """Traded volume and volume-weighted price inside the closed interval of each left row.

    The starts and ends of intervals cut each bin into segments; ticks leave the scan once and are summed by segment, and
    everything after that sees segments. Both results are sums of disjoint parts of the interval, never differences, so a small
    trade keeps its digits next to large ones, and a NaN price spoils only the intervals that hold it. Segments, bins and days are
    the tiers; segments are looked at in the bins where an interval starts or ends only, whole bins and days by their totals.
    Decimal prices and sizes are summed exactly. Returns the ``keys`` (unique in ``left``) and the two results;
    rows with an empty interval or without a ``by`` value are absent, rows whose interval holds no trade
    have null results.
    """
    width = bin_seconds * 1_000_000
    units = (ceil(86_400 / bin_seconds), 0)
    bounds = left.filter(F.col(by).isNotNull() & (F.col(start) <= F.col(end))).select(
        *dict.fromkeys([*keys, by]), F.unix_micros(start).alias("_lo"), F.unix_micros(end).alias("_hi")
    )
    # A start comes before the ticks of its instant, an end after them.
    cut = lambda name, side: F.struct(F.col(name).alias("_index"), F.lit(side).alias("_side"))
    cuts = bounds.select(by, F.inline(F.array(cut("_lo", 0), cut("_hi", 2)))).distinct()
    measures = ["_size", "_notional"]
    ticks = right.filter(F.col(by).isNotNull() & F.col(right_ts).isNotNull()).select(
        by, F.unix_micros(right_ts).alias("_index"), F.lit(1).alias("_side"), F.col(size).alias("_size"), (F.col(price) * F.col(size)).alias("_notional")
    )
    totals = {m: _sum_type(ticks, m) for m in measures}
    stream = ticks.unionByName(cuts, allowMissingColumns=True).withColumn("_bin", F.coalesce(_parent(F.col("_index"), width), F.lit(0).cast("long")))
    in_bin = Window.partitionBy(by, "_bin").orderBy("_index", "_side").rowsBetween(Window.unboundedPreceding, 0)
    ranked = stream.withColumn("_rank", F.count(F.when(F.col("_side") != 1, 1)).over(in_bin))

    segments = ranked.filter("_side = 1").groupBy(by, "_bin", "_rank").agg(*[F.sum(m).cast(totals[m]).alias(m) for m in measures])
    ranks = ranked.filter("_side <> 1").select(F.col(by).alias("_by"), "_index", "_side", "_bin", "_rank")

    def placed(rows: DataFrame, name: str, side: int, bin_: str, place: str, shift: int) -> DataFrame:
        of = ranks.filter(F.col("_side") == side).select("_by", "_index", F.col("_bin").alias(bin_), (F.col("_rank") + shift).alias(place))
        return rows.join(of, (F.col(by) == F.col("_by")) & (F.col(name) == F.col("_index"))).drop("_by", "_index")

    intervals = placed(placed(bounds, "_lo", 0, "_low", "_from", 0), "_hi", 2, "_high", "_to", -1).drop("_lo", "_hi")
    probes = _edges(intervals, units)
    cell = [by, "_tier", "_parent", "_level", "_cell", "_way"]
    asked = probes.select(*cell, "_place").distinct()
    levels = asked.groupBy(by, "_tier", "_parent").agg(
        F.collect_set(F.struct("_level", "_way")).alias("_levels")  # two per bit of a place
    )
    tiers = [segments.select(by, F.lit(0).alias("_tier"), F.col("_bin").alias("_parent"), F.col("_rank").alias("_place"), *measures)]
    upper, index = segments, "_bin"
    for tier, unit in enumerate(units, 1):
        upper = upper.groupBy(by, F.col(index).alias("_unit")).agg(*[F.sum(m).cast(totals[m]).alias(m) for m in measures])
        parent, place = _parent(F.col("_unit"), unit), _place(F.col("_unit"), unit)
        tiers.append(upper.select(by, F.lit(tier).alias("_tier"), parent.alias("_parent"), place.alias("_place"), *measures))
        upper, index = upper.select(by, parent.alias("_up"), *measures), "_up"
    seen = reduce(DataFrame.unionByName, tiers).join(levels, [by, "_tier", "_parent"])
    looked = (
        seen.select(by, "_tier", "_parent", F.inline("_levels"), "_place", *measures)
        .withColumns({"_cell": F.expr("shiftright(_place, _level)"), "_side": F.lit(0)})
        .unionByName(asked.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    )
    onward = Window.partitionBy(*cell).orderBy(F.col("_place") * F.col("_way"), "_side")
    so_far = onward.rowsBetween(Window.unboundedPreceding, 0)
    running = looked.select(*cell, "_place", "_side", *[F.sum(m).over(so_far).alias(m) for m in measures]).filter("_side = 1")

    summed = probes.join(running, [*cell, "_place"]).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return summed.select(
        *keys,
        F.col("_size").cast(totals["_size"]).alias(volume_out),
        F.try_divide(F.col("_notional").cast("double"), F.col("_size").cast("double")).alias(vwap_out),
    )


def _sum_type(df: DataFrame, column: str) -> str:
    """The type ``sum`` gives for the column."""
    return df.select(F.sum(column)).schema[0].dataType.simpleString()
