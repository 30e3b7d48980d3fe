"""Exchange session hours as instants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SessionHours:
    """Opening and closing wall-clock times of a market and the zone they are given in."""

    open_time: str = "09:30:00"
    close_time: str = "16:00:00"
    zone: str = "America/New_York"


def session_instant(day: Column, wall_time: str, zone: str) -> Column:
    """The instant at which ``zone`` shows ``wall_time`` on ``day``, daylight saving included.

    The zone is part of the parsed text, so the result does not depend on the session zone.
    """
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {wall_time} {zone}"))
    return text.cast("timestamp")
