"""Generic table operators, independent of any business schema."""

from tallyworks.operators.latest import boundary_row, keep_latest_ties, latest_per_key
from tallyworks.operators.rolling import rolling_sum, trailing_count
from tallyworks.operators.skew import HotSplit, hot_key_cuts, spread_over_slices
from tallyworks.operators.timejoin import asof_lookup, interval_vwap
from tallyworks.operators.validity import valid_at

__all__ = [
    "HotSplit",
    "asof_lookup",
    "boundary_row",
    "hot_key_cuts",
    "interval_vwap",
    "keep_latest_ties",
    "latest_per_key",
    "rolling_sum",
    "spread_over_slices",
    "trailing_count",
    "valid_at",
]
