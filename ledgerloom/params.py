"""Parameters and fixed vocabulary of the marketplace domain."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --- Fixed values: names and codes that appear in the tables themselves. ------
EVENT_CREATED = "subscription_created"
EVENT_CANCELLED = "cancellation"
EVENT_TYPES = ("subscription_created", "renewal", "cancellation", "upgrade", "downgrade")
PERIOD_ANNUAL = "annual"
BILLING_PERIODS = ("monthly", "annual")
BRAND_TIERS = ("SMB", "Mid-Market", "Enterprise")
FOLLOWER_TIERS = ("nano", "micro", "macro", "mega")
CAMPAIGN_STATUSES = ("active", "completed", "cancelled")
PAYOUT_STATUSES = ("paid", "failed", "pending")
LIVE_STATUSES = ("succeeded", "refunded")

BRAND_CHARGE = "brand_charge"
PLATFORM_FEE = "platform_fee_revenue"
PROCESSOR_FEE = "stripe_processing_fee"
REFUND = "refund_adjustment"
PAYOUT = "creator_payout"
ENTRY_TYPES = (BRAND_CHARGE, PLATFORM_FEE, PROCESSOR_FEE, REFUND, PAYOUT)

REASON_MISSING_BRAND = "missing_brand_external_id"
REASON_UNRESOLVED = "unresolvable_brand_external_id"

EXTERNAL_ID_LENGTHS = {"brand_external_id": 20, "creator_external_id": 24}
MAX_COHORT_AGE = 11
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fees:
    """How a payment is split; amounts are integer cents."""

    platform_rate: float = 0.10
    processor_rate: float = 0.029
    processor_fixed_cents: int = 30


@dataclass(frozen=True)
class Band:
    """Closed interval a rate must lie in."""

    low: float
    high: float


@dataclass(frozen=True)
class Params:
    """Everything a run may vary."""

    fees: Fees = field(default_factory=Fees)
    take_rate: Band = Band(0.05, 0.20)
    payout_discrepancy: Band = Band(0.03, 0.07)
    # Both or none: without them the calendar follows from the facts.
    calendar_start: dt.date | None = None
    calendar_end: dt.date | None = None
    # Months of the calendar before the first and after the last fact.
    months_before: int = 6
    months_after: int = 16
    # Stands in for the clock of the queries: the time given to coerced events that have none. A build asks for its own.
    as_of: dt.datetime = dt.datetime(2002, 12, 31)


DEFAULTS = Params()
