"""Type-2 history of the customer dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions import any_differs, in_day, instant
from tallyworks.operators import latest_per_key
from tallyworks.schemas import CUSTOMER_SCD2

ATTRIBUTES = (
    "first_name",
    "last_name",
    "email_address",
    "phone_number",
    "residential_address",
    "marital_status",
)
# A change in the other attributes alone does not open a new version.
TRACKED = ("last_name", "email_address", "residential_address", "marital_status")
OPEN_END = dt.datetime(9999, 12, 31, 23, 59, 59)


def updates_of_day(
    updates: DataFrame, run_date: dt.date, ts: str = "update_ts", tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest update per customer on the run date; updates without a customer are left out."""
    day = updates.filter(in_day(F.col(ts), run_date) & F.col("customer_id").isNotNull())
    return latest_per_key(day, ["customer_id"], [F.col(c).desc() for c in (ts, *tie_break)])


def rejected_updates(updates: DataFrame, run_date: dt.date, ts: str = "update_ts") -> DataFrame:
    """Updates of the run date that name no customer."""
    return updates.filter(in_day(F.col(ts), run_date) & F.col("customer_id").isNull())


def newest_active(dim: DataFrame) -> DataFrame:
    """One active row per customer, the one that began last: a log keeps superseded rows active."""
    order = [F.col("effective_start_date").desc(), F.col("customer_surrogate_key").desc()]
    return latest_per_key(dim.filter("is_active"), ["customer_id"], order)


def scd2_changes(
    dim: DataFrame,
    updates: DataFrame,
    attributes: Sequence[str] = ATTRIBUTES,
    tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """Active rows against one update per customer: INSERT, UPDATE or NO CHANGE, old and new values."""
    new = updates.select("customer_id", F.struct(*attributes).alias("_new"))
    old = dim.filter("is_active").select(
        "customer_id",
        F.struct("customer_surrogate_key", *attributes, "effective_start_date", "effective_end_date").alias("_old"),
    )
    both = new.join(old, "customer_id", "full")
    changed = any_differs([(F.col(f"_new.{c}"), F.col(f"_old.{c}")) for c in tracked])
    change_type = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("_new").isNotNull() & changed, "UPDATE")
        .otherwise("NO CHANGE")
    )
    newest = [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(f"{c}_new")
        for c in attributes
    ]
    return both.select(
        "customer_id",
        *newest,
        change_type.alias("change_type"),
        F.col("_old.customer_surrogate_key").alias("old_sk"),
        *[F.col(f"_old.{c}").alias(f"{c}_old") for c in attributes],
        F.col("_old.effective_start_date").alias("old_start_date"),
        F.col("_old.effective_end_date").alias("old_end_date"),
    )


def _old_row(end: Column, active: bool, attributes: Sequence[str]) -> Column:
    return F.struct(
        F.col("old_sk").alias("customer_surrogate_key"),
        F.col("customer_id"),
        *[F.col(f"{c}_old").alias(c) for c in attributes],
        F.col("old_start_date").alias("effective_start_date"),
        end.alias("effective_end_date"),
        F.lit(active).alias("is_active"),
    )


def _new_row(run_date: dt.date, attributes: Sequence[str]) -> Column:
    # A hash of customer and start: a retried task or a rerun gives the same key.
    key = F.sha2(F.concat_ws("|", F.col("customer_id").cast("string"), F.lit(f"{run_date} 00:00:00")), 256)
    return F.struct(
        key.alias("customer_surrogate_key"),
        F.col("customer_id"),
        *[F.col(f"{c}_new").alias(c) for c in attributes],
        F.lit(run_date).cast("timestamp").alias("effective_start_date"),
        instant(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_active"),
    )


def scd2_retired(changes: DataFrame, run_date: dt.date, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Old versions of updated customers, closed at the start of the run date."""
    closed = _old_row(F.lit(run_date).cast("timestamp"), False, attributes)
    return changes.filter(F.col("change_type") == "UPDATE").select(closed.alias("row")).select("row.*")


def scd2_new(changes: DataFrame, run_date: dt.date, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """New active versions of inserted and updated customers."""
    opened = _new_row(run_date, attributes)
    return changes.filter(F.col("change_type").isin("INSERT", "UPDATE")).select(opened.alias("row")).select("row.*")


def _versions(changes: DataFrame, run_date: dt.date, attributes: Sequence[str], unchanged: bool) -> DataFrame:
    """All rows a day writes, from one pass over the join: each change yields up to two versions."""
    closed = _old_row(F.lit(run_date).cast("timestamp"), False, attributes)
    kept = _old_row(F.col("old_end_date"), True, attributes)
    opened = _new_row(run_date, attributes)
    rows = F.when(F.col("change_type") == "UPDATE", F.array(closed, opened)).when(
        F.col("change_type") == "INSERT", F.array(opened)
    )
    if unchanged:
        rows = rows.otherwise(F.array(kept))
    return changes.select(F.inline(rows))


def scd2_day_rows(changes: DataFrame, run_date: dt.date, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """The retired and the new rows of a day together."""
    return _versions(changes, run_date, attributes, unchanged=False)


def scd2_append(
    dim: DataFrame, changes: DataFrame, run_date: dt.date, attributes: Sequence[str] = ATTRIBUTES
) -> DataFrame:
    """The table after appending retired and new rows; superseded active rows stay in place."""
    return dim.select(*CUSTOMER_SCD2.names).unionByName(scd2_day_rows(changes, run_date, attributes))


def scd2_apply(
    dim: DataFrame, changes: DataFrame, run_date: dt.date, attributes: Sequence[str] = ATTRIBUTES
) -> DataFrame:
    """The next full version of the table, with one active row per customer.

    Write it to a new path or table; the one being read must not be overwritten.
    """
    history = dim.filter(~F.coalesce("is_active", F.lit(False))).select(*CUSTOMER_SCD2.names)
    return history.unionByName(_versions(changes, run_date, attributes, unchanged=True))


# What a customer's timeline is made of, from weak to strong where they meet in one instant.
_CLOSED, _VERSION, _UPDATE = 0, 1, 2


def updates_by_day(
    updates: DataFrame, first: dt.date | None = None, ts: str = "update_ts", tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest update per customer and day, from ``first`` on, with the day as ``_day``.

    Updates without a customer or a time are left out. Every map task ships one row per customer and day at most.
    """
    known = updates.filter(F.col("customer_id").isNotNull() & F.col(ts).isNotNull())
    if first is not None:
        known = known.filter(F.col(ts) >= F.lit(first).cast("timestamp"))
    daily = known.withColumn("_day", F.to_date(ts))
    return latest_per_key(daily, ["customer_id", "_day"], [F.col(c).desc() for c in (ts, *tie_break)])


def scd2_backdated(
    dim: DataFrame,
    daily: DataFrame,
    attributes: Sequence[str] = ATTRIBUTES,
    tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """The next full version of the table after updates of several days, some of them before what it already holds.

    ``daily`` (from ``updates_by_day``) has the updates from the earliest late day on, those included that were applied
    before: an update that changed nothing when it came may change something once an earlier one is known.

    A customer's versions and updates are laid out on one timeline. An update splits the version that it falls into and lasts until
    the next version or update begins; where a version begins in the same instant, the update replaces it, and one that
    tells nothing new about the tracked attributes goes into the version before. The end of a version with no successor
    stays a gap until an update falls into it, except where one begins in that very instant. So one call for several days, one
    per day and any order of the days give the same history, without overlaps. Customers without updates keep their rows as they are.
    Surrogate keys of versions that go on are kept.

    One shuffle of the history, by customer, shared by all steps: a customer has one update per day at most.
    """
    values = [F.col(c) for c in attributes]
    start, end, kind = F.col("effective_start_date"), F.col("effective_end_date"), F.col("_kind")
    old = dim.select(
        "customer_id", start, F.lit(_VERSION).alias("_kind"), "customer_surrogate_key", *values, end.alias("_end"),
        F.coalesce("is_active", F.lit(False)).alias("_active"),
    )
    closed = dim.filter(end < instant(OPEN_END)).select("customer_id", end.alias("effective_start_date"), F.lit(_CLOSED).alias("_kind"))
    new = daily.select("customer_id", F.col("_day").cast("timestamp").alias("effective_start_date"), F.lit(_UPDATE).alias("_kind"), *values)
    line = old.unionByName(new, allowMissingColumns=True).unionByName(closed, allowMissingColumns=True)

    customer = Window.partitionBy("customer_id")
    onward = customer.orderBy("effective_start_date", "_kind", "customer_surrogate_key")
    before = F.lag(F.struct("_kind", *tracked)).over(onward)
    repeats = (kind == _UPDATE) & (F.col("_before._kind") != _CLOSED) & ~any_differs([(F.col(c), F.col(f"_before.{c}")) for c in tracked])
    placed = (
        line.withColumns({"_next": F.lead("effective_start_date").over(onward), "_updated": F.max("_kind").over(customer) == _UPDATE})
        # Of one instant only the strongest is left; rows of customers without updates all stay.
        .filter(~F.col("_updated") | F.col("_next").isNull() | (F.col("_next") != F.col("effective_start_date")))
        .withColumn("_before", before)
        .filter(~F.col("_updated") | F.col("_before").isNull() | ~repeats)
        .withColumn("_next", F.lead("effective_start_date").over(onward))
        .filter(kind != _CLOSED)
    )
    began = F.date_format("effective_start_date", "yyyy-MM-dd HH:mm:ss")
    key = F.sha2(F.concat_ws("|", F.col("customer_id").cast("string"), began), 256)
    until = F.when(F.col("_updated"), F.coalesce("_next", instant(OPEN_END))).otherwise(F.col("_end"))
    active = F.when(F.col("_updated"), F.col("_next").isNull()).otherwise(F.col("_active"))
    return placed.select(
        F.coalesce("customer_surrogate_key", key).alias("customer_surrogate_key"),
        "customer_id",
        *values,
        "effective_start_date",
        until.alias("effective_end_date"),
        active.alias("is_active"),
    )
