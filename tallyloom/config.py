"""Settings of a run, and the fixed values that define the published results."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal


def _month_text(year: int, month: int) -> str:
    return f"{year:04d}{month:02d}"


@dataclass(frozen=True)
class RetailConfig:
    """Everything a run may vary. The defaults are the reference settings."""

    as_of_date: date = date(2026, 9, 30)
    start_year: int = 2023
    include_open_month: bool = False
    min_order_date: date = date(2020, 1, 1)
    # A line above the guard whose hundredth lies in the band is in cents ...
    cents_guard: Decimal = Decimal(1000)
    cents_band: tuple[Decimal, Decimal] = (Decimal(1), Decimal(500))
    # ... and so is a line at or above this multiple of quantity x unit price.
    cents_list_multiple: int = 10

    @property
    def start_month(self) -> str:
        return _month_text(self.start_year, 1)

    @property
    def end_month(self) -> str:
        """Last month read: the closed month before as_of_date, or its own month."""
        year, month = self.as_of_date.year, self.as_of_date.month
        if not self.include_open_month:
            year, month = (year - 1, 12) if month == 1 else (year, month - 1)
        return _month_text(year, month)


# Settings for the driver's tables: orders from 1995 on, line amounts up to
# about 105,000 (so the euro/cents guard sits far above the reference's).
FEED_CONFIG = RetailConfig(
    # behind the last ship date, so that the month window keeps every line
    as_of_date=date(2001, 12, 31),
    start_year=1995,
    min_order_date=date(1995, 1, 1),
    cents_guard=Decimal(1_000_000),
    cents_band=(Decimal(1), Decimal(200_000)),
)

# --- Fixed values: scoring and segmentation --------------------------------

SCORE_TILES = 5
REVENUE_TILES = 10

# (lowest R+F+M total, segment, recommended action)
SEGMENT_BANDS = (
    (13, "Champions", "Reward and cross-sell premium"),
    (11, "Loyal Customers", "Loyalty programme and early access"),
    (9, "Potential Loyalists", "Upsell and increase frequency"),
    (7, "Recent Customers", "Onboarding and second purchase push"),
    (5, "At Risk", "Win-back campaign and incentives"),
    (3, "Hibernating", "Deep discount or sunset"),
)

WIN_BACK_SEGMENTS = ("At Risk", "Hibernating")

# (segment, email cadence, loyalty tier, discount approach, budget, sort order)
SEGMENT_STRATEGY = (
    ("Champions", "Monthly newsletter", "VIP Tier", "None – full price", "High (40%)", 1),
    ("Loyal Customers", "Bi-weekly", "Standard tier", "Selective 5%", "Medium (25%)", 2),
    ("Potential Loyalists", "Weekly nurture", "Eligibility offer", "Welcome 10%", "Medium (15%)", 3),
    ("Recent Customers", "Weekly onboarding", "Eligibility offer", "First-buy 10%", "Low (10%)", 4),
    ("At Risk", "Bi-weekly re-engage", "Re-engagement", "Win-back 15%", "Low (7%)", 5),
    ("Hibernating", "Quarterly", "None", "Win-back 20%", "Minimal (3%)", 6),
)

# (days since last order below this, bucket); the last bucket is open-ended
RECENCY_BUCKETS = (
    (30, "01_active_30d"),
    (90, "02_recent_90d"),
    (180, "03_warming_180d"),
    (365, "04_cooling_365d"),
    (730, "05_cold_2y"),
    (None, "06_dormant_2y_plus"),
)

# (least average health score, band)
HEALTH_BANDS = ((11, "● Healthy"), (7, "◐ Monitor"), (None, "○ Critical"))

ACTIVE_MAX_DAYS = 90
COOLING_MAX_DAYS = 180
RECENCY_BIN_DAYS = 30
PARETO_THRESHOLD = 0.8
DEFAULT_REACTIVATION_RATE = 10
REACTIVATION_RATES = (0, 50, 5)  # from, to, step
KPI_CHOICES = (
    "Total Revenue",
    "Total Customers",
    "Average Order Value",
    "Average Recency Days",
    "Revenue at Risk",
)
