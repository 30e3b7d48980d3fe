"""Small value-level expressions shared by several plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_day(ts: Column, day: dt.date) -> Column:
    """True for instants on ``day``; written as a half-open range so that it reaches the scan."""
    start = F.lit(day).cast("timestamp")
    end = F.lit(day + dt.timedelta(days=1)).cast("timestamp")
    return (ts >= start) & (ts < end)


def instant(moment: dt.datetime | None) -> Column:
    """A timestamp literal in the session zone, or in the moment's own zone; now if none is given.

    Built from text: a naive ``datetime`` literal would be read in the driver machine's zone.
    """
    if moment is None:
        return F.current_timestamp()
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def normalized_amount(amount: Column, rate: Column) -> Column:
    """Amount in the base currency; a missing rate counts as 1."""
    return (amount * F.coalesce(rate, F.lit(1).cast("decimal(2,1)"))).cast("decimal(18,4)")


def differs(new: Column, old: Column) -> Column:
    """True if two texts differ, where null and the empty string are the same."""
    blank = F.lit("")
    return F.coalesce(new, blank) != F.coalesce(old, blank)


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True if at least one (new, old) pair differs."""
    result = F.lit(False)
    for new, old in pairs:
        result = result | differs(new, old)
    return result
