"""Business thresholds. The defaults are the values the jobs use unless told otherwise."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class LedgerRules:
    """Which transactions enter the ledger."""

    kept_status: tuple[str, ...] = ("COMPLETED", "SETTLED", "PENDING_CLEARANCE")
    dropped_type: str = "INTERNAL_TRANSFER_REVERSAL"
    rolling_preceding: int = 10
    unknown_region: str = "UNKNOWN"


@dataclass(frozen=True)
class RiskRules:
    """Daily review flag: HIGH by volume in one segment, else MEDIUM by count, else LOW."""

    high_volume: Decimal = Decimal("50000")
    high_segment: str = "RETAIL"
    medium_count: int = 100
    watched_mcc: tuple[str, ...] = ("7995", "6012")


@dataclass(frozen=True)
class MovementRules:
    """Transaction types that do not move a balance, per side."""

    not_credited: tuple[str, ...] = ("FEE", "REVERSAL_DEBIT")
    not_debited: tuple[str, ...] = ("REVERSAL_CREDIT",)


@dataclass(frozen=True)
class BalanceRules:
    """Accounts in the snapshot and the interest they earn."""

    kept_status: tuple[str, ...] = ("OPEN", "FROZEN", "DORMANT")
    interest_type: str = "SAVINGS"
    yearly_rate: Decimal = Decimal("0.05")
    days_in_year: int = 365
    unknown_region: str = "UN"


@dataclass(frozen=True)
class SegmentRules:
    """Customer segment by funding; the KYC rejection only counts below the premium limit."""

    wealth_above: float = 1_000_000.0
    premium_from: float = 100_000.0
    rejected_status: str = "REJECTED"


@dataclass(frozen=True)
class FraudRules:
    """Points per signal, every bound exclusive, and the inclusive alert score."""

    profile_days: int = 90
    velocity_seconds: int = 3600
    far_km: float = 500.0
    far_points: int = 30
    amount_steps: tuple[tuple[float, int], ...] = ((3.0, 40), (2.0, 20))
    velocity_steps: tuple[tuple[int, int], ...] = ((5, 30), (3, 15))
    alert_score: int = 60


@dataclass(frozen=True)
class TcaRules:
    """Horizons after the end of an order and how old a quote may be, in minutes."""

    horizon_minutes: tuple[int, ...] = (1, 5)
    quote_lookback_minutes: int = 10
    boundary_fill: str = "first"
    # Settles quotes of one instant; quotes without this column are settled by bid, then ask.
    quote_tie_break: str = "quote_id"
    # Minutes after the end of an order at which its momentum is taken, one measure each.
    momentum_minutes: tuple[int, ...] = (1,)
    # Width of the time bins in which ticks and orders meet. A busier market takes a smaller one.
    bin_seconds: int = 60
    # Stretches of time that the ticks are read from, at most; nearer ones are read as one.
    most_spans: int = 64
    # Distinct windows of orders, a row of under 200 bytes each, up to which the report sends their findings to every executor.
    few_windows: int = 50_000
