"""Run settings. Every date is a parameter, so a run can be repeated."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Slice columns of the snapshot, in output order.
SLICE = ("contact_type", "sales_decile", "staleness_bucket", "branch", "creation_cohort")

SNAPSHOT_COLUMNS = (
    "snapshot_date", "metric_category", "metric_name", *SLICE, "numerator", "denominator",
)


@dataclass(frozen=True)
class Settings:
    as_of: dt.date
    history: tuple[dt.date, ...] = ()  # dates of the stored snapshots; only as_of if empty
    source: str = "DEALER XREF"
    sentinel_entity: int = 999999998
    dealer_id: str | None = None               # links of one dealer only
    customer_type: str = "CUSTOMER"
    prospect_type: str = "PROSPECT"
    project_start: dt.date | None = None  # links from this day on are the project's
    closed_branches: tuple[str, ...] = ()      # codes that no contact should carry any more
    internal_domains: tuple[str, ...] = ()     # mail domains of the own staff
    decile_method: str = "share"      # "share" of revenue, or "ntile" of accounts
    staleness_step: str = "calendar"  # "calendar" years, or "365d" steps
    cohorts: str = "current"          # "current" or "older" year edges
    parity_us_default: bool = False   # compare an empty country as US
    history_from: int = 1996          # first calendar year of the sales history

    @property
    def started(self) -> dt.date:
        """First day of the project; the year of the run if none is given."""
        return self.project_start or self.as_of.replace(month=1, day=1)

    @property
    def dates(self) -> tuple[dt.date, ...]:
        return self.history or (self.as_of,)

    def at(self, as_of: dt.date) -> "Settings":
        return replace(self, as_of=as_of)


def r60_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First day 59 months before, and last day of, the month before ``as_of``."""
    end = as_of.replace(day=1) - dt.timedelta(days=1)
    months = end.year * 12 + (end.month - 1) - 59
    return dt.date(months // 12, months % 12 + 1, 1), end
