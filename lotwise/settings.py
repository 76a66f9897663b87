"""Job settings: everything the rate table depends on besides the events."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta, timezone

# The spellings and numbers the published rates are defined by.
DEFAULT = "default"
NAN = "nan"
TOLERATED_ERROR = "500"
HIGH, LOW = "high", "low"
VARIABLE, FIXED = "variable_threshold", "fixed_threshold"
BASIC_DAYS, REFINED_DAYS = 5, 6
MIN_REQUESTS = 5000
DEFAULT_RATE = 0.05
TOP_BID_RATE_FLOOR = 5.0
MAX_FIXED_SPREAD = 10.0
FIXED_THRESHOLD = 5.0
THRESHOLD_SHARE = 0.9
EXEMPT_COUNTRIES = ("RU",)
EXCEPTION_BIDDERS = ("unrulyfsx",)
BANDS = ((75.0, 1.0), (50.0, 0.75), (25.0, 0.5), (5.0, 0.25))
MIN_RPR = 0.001
# End of fixed values.


def utc_today() -> date:
    return datetime.now(timezone.utc).date()


@dataclass(frozen=True)
class Settings:
    """One run's parameters. ``as_of`` is read once, so a run that crosses midnight keeps its day.

    ``volume`` names the counter compared with ``min_requests``; ``rate_base`` the one
    ``top_bid_rate`` is divided by. ``bands`` holds (lowest bid rate, rate) from high to low.
    """

    as_of: date = field(default_factory=utc_today)
    lookback_days: int = 1
    extended_days: int = BASIC_DAYS
    min_requests: int = MIN_REQUESTS
    default_rate: float = DEFAULT_RATE
    volume: str = "requests"
    rate_base: str = "clean_requests"
    host_cut_inclusive: bool = False
    refined: bool = False
    bands: tuple[tuple[float, float], ...] = BANDS
    min_rpr: float = MIN_RPR
    exempt_countries: tuple[str, ...] = EXEMPT_COUNTRIES
    exception_bidders: tuple[str, ...] = EXCEPTION_BIDDERS

    def __post_init__(self) -> None:
        if not 0 < self.lookback_days <= self.extended_days:
            raise ValueError("lookback_days must be positive and at most extended_days")
        floors = [floor for floor, _ in self.bands]
        if not floors or floors != sorted(set(floors), reverse=True):
            raise ValueError("bands must be listed from the highest bid rate to the lowest")
        if not {self.volume, self.rate_base} <= set(self.measures):
            raise ValueError(f"volume and rate_base must be among {self.measures}")

    @property
    def day_end(self) -> datetime:
        return datetime.combine(self.as_of, time(), timezone.utc)

    @property
    def day_start(self) -> datetime:
        return self.day_end - timedelta(days=self.lookback_days)

    @property
    def long_start(self) -> datetime:
        return self.day_end - timedelta(days=self.extended_days)

    @property
    def days(self) -> list[date]:
        """The UTC days of the long window, oldest first."""
        first = self.long_start.date()
        return [first + timedelta(days=n) for n in range(self.extended_days)]

    @property
    def lowest_band(self) -> float:
        return self.bands[-1][0]

    @property
    def measures(self) -> tuple[str, ...]:
        """Counters this variant sums; the others are never read from storage."""
        if self.refined:
            return ("bids", "requests", "opportunities", "top_bids", "revenue")
        return ("bids", "requests", "clean_requests", "top_bids")


def basic(**changes) -> Settings:
    """Rates from top-bid rate alone."""
    return Settings(**changes)


def refined(**changes) -> Settings:
    """Rates further refined by bid rate and revenue per thousand opportunities."""
    preset = dict(
        extended_days=REFINED_DAYS,
        volume="opportunities",
        rate_base="requests",
        host_cut_inclusive=True,
        refined=True,
    )
    return Settings(**{**preset, **changes})
