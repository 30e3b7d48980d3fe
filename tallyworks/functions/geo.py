"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
UNKNOWN_DISTANCE = -1.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees; -1.0 if any coordinate is null or NaN.

    The haversine term is clamped to [0, 1]: rounding can push it just past 1 for antipodes.
    """
    half_chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    term = F.least(F.greatest(half_chord, F.lit(0.0)), F.lit(1.0))
    km = 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(term), F.sqrt(1 - term))
    complete = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(complete & ~F.isnan(half_chord), km).otherwise(F.lit(UNKNOWN_DISTANCE))
