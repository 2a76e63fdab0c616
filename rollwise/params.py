"""Run parameters: the anchor date, the firm filters and the period grids.

Every date of a run is computed here once on the driver and reaches the plans as a literal, so
no query depends on the day it is executed and Catalyst can push every bound into the scans.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# Look-back lengths of the model, in days before the anchor.
INACTIVITY_DAYS = 1461
LIFETIME_DAYS = 4567
QUARTER_DAYS = 92
GRACE_DAYS = 35
# Default firm and shop client.
DEFAULT_FIRM = 1
DEFAULT_CLIENT = 2


@dataclass(frozen=True)
class Period:
    """A closed range of days; ``hi_grace`` is the last reporting day still counted for it."""

    name: str
    lo: date
    hi: date
    hi_grace: date | None = None

    @property
    def last_reporting_day(self) -> date:
        return self.hi_grace or self.hi


def half_year_periods(anchor: date, count: int = 8, grace_days: int = GRACE_DAYS) -> tuple[Period, ...]:
    """``count`` adjacent half years ending the day before ``anchor``, newest first.

    All but the newest one accept positions reported up to ``grace_days`` after their end.
    """
    periods = []
    for k in range(1, count + 1):
        hi = anchor - timedelta(days=365 * (k - 1) // 2 + 1)
        periods.append(
            Period(
                name=f"S{k}",
                lo=anchor - timedelta(days=365 * k // 2),
                hi=hi,
                hi_grace=hi if k == 1 else hi + timedelta(days=grace_days),
            )
        )
    return tuple(periods)


def equal_periods(anchor: date, days: int, count: int, prefix: str = "S") -> tuple[Period, ...]:
    """``count`` adjacent periods of ``days`` days ending the day before ``anchor``, newest first."""
    return tuple(
        Period(
            name=f"{prefix}{k}",
            lo=anchor - timedelta(days=days * k),
            hi=anchor - timedelta(days=days * (k - 1) + 1),
        )
        for k in range(1, count + 1)
    )


@dataclass(frozen=True)
class Params:
    """Everything one run depends on.

    ``periods`` drives orders, profit and permissions. ``contact_periods`` (newsletter clicks and
    web sessions) and ``quarter`` (style views) default to the same anchor; they can be set apart
    when those sources cover another time span.
    """

    anchor: date
    firm_id: int = DEFAULT_FIRM
    client_id: int = DEFAULT_CLIENT
    periods: tuple[Period, ...] = field(default=())
    contact_periods: tuple[Period, ...] = field(default=())
    quarter: Period | None = None

    def __post_init__(self):
        if not self.periods:
            object.__setattr__(self, "periods", half_year_periods(self.anchor))
        if not self.contact_periods:
            object.__setattr__(self, "contact_periods", self.periods[:6])
        if self.quarter is None:
            object.__setattr__(self, "quarter", equal_periods(self.anchor, QUARTER_DAYS, 1, "Q")[0])

    def period(self, k: int) -> Period:
        return self.periods[k - 1]

    @property
    def newest(self) -> Period:
        return self.periods[0]

    @property
    def as_of(self) -> date:
        """Day on which histories are evaluated: the last day of the newest period."""
        return self.newest.hi

    @property
    def web_as_of(self) -> date:
        return self.contact_periods[0].hi

    @property
    def inactive_since(self) -> date:
        return self.anchor - timedelta(days=INACTIVITY_DAYS)

    @property
    def lifetime_start(self) -> date:
        return self.anchor - timedelta(days=LIFETIME_DAYS)

    def composite_periods(self) -> tuple[Period, ...]:
        """Overlapping unions of half years used by the order rates."""
        return (
            Period("S123", self.period(3).lo, self.period(1).hi),
            Period("S45", self.period(5).lo, self.period(4).hi),
            Period("S1_5", self.period(5).lo, self.period(1).hi),
        )
