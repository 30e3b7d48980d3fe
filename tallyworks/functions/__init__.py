"""Column expressions: everything here stays inside whole-stage codegen."""

from tallyworks.functions.calendar import SessionHours, session_instant
from tallyworks.functions.geo import haversine_km
from tallyworks.functions.values import any_differs, differs, in_day, instant, normalized_amount

__all__ = [
    "SessionHours",
    "any_differs",
    "differs",
    "haversine_km",
    "in_day",
    "instant",
    "normalized_amount",
    "session_instant",
]
