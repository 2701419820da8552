"""Report measures and rollups over the stored snapshot table."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from linkledger.config import SLICE
from linkledger.functions import lists
from linkledger.functions.columns import lit, rank_of, values
from linkledger.operators.revenue import exprs


def _sum_of(column: str, *metrics: str) -> str:
    return f"sum(CASE WHEN metric_name IN {values(metrics)} THEN {column} END)" if metrics else f"sum({column})"


_READY = lists.MATCH_TIERS[:2]
MEASURES = {
    "issue_rate": f"try_divide({_sum_of('numerator')}, {_sum_of('denominator')})",
    "issue_count": _sum_of("numerator"),
    "record_count": _sum_of("denominator"),
    "numerator": _sum_of("numerator"),
    "denominator": _sum_of("denominator"),
    "pct_linked": f"try_divide({_sum_of('numerator', 'linked_count')}, {_sum_of('denominator', 'linked_count')})",
    "stale_5yr": _sum_of("numerator", lists.STALENESS_BUCKETS[-1]),
    "match_ready": f"try_divide({_sum_of('numerator', *_READY)}, {_sum_of('denominator', _READY[0])})",
}


def measure(name: str) -> Column:
    """A report measure as one aggregate expression."""
    return F.expr(f"{MEASURES[name]} AS {name}")


def stored_dates(snapshot: DataFrame) -> list[dt.date]:
    """Dates of a stored snapshot table, the oldest first, from the folder names among its files: no data is read. A
    frame without such files is scanned."""
    named = {m[1] for f in snapshot.inputFiles() if (m := re.search(r"/snapshot_date=(\d{4}-\d\d-\d\d)/", f))}
    if named:
        return sorted(map(dt.date.fromisoformat, named))
    return [r[0] for r in snapshot.select("snapshot_date").distinct().orderBy("snapshot_date").collect() if r[0]]


def latest_date(snapshot: DataFrame) -> dt.date | None:
    """Newest snapshot date. Resolved first, so that later scans prune to one partition."""
    return next(reversed(stored_dates(snapshot)), None)


def latest(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter(f"snapshot_date = {lit(latest_date(snapshot))}")


def snapshot_verification(snapshot: DataFrame) -> DataFrame:
    return latest(snapshot).groupBy("snapshot_date", "metric_category").agg(*exprs(
        "count(*) AS row_count", "sum(numerator) AS total_numerator", "sum(denominator) AS total_denominator"
    )).orderBy("metric_category")


@dataclass(frozen=True)
class Visual:
    """What one report visual asks of the snapshot table."""

    by: tuple[str, ...] = ()
    measures: tuple[str, ...] = ("numerator",)
    category: str | None = None
    metric: str | None = None
    trend: bool = False                 # over all snapshots instead of the newest
    known_cohorts: bool = False
    pivot: tuple[str, tuple[str, ...]] | None = None


_TYPED = ("metric_name", "contact_type")
VISUALS: dict[int, Visual] = {
    1: Visual(("metric_category",), ("issue_count",)),
    3: Visual((), ("pct_linked",), "linkage"),
    4: Visual((), ("match_ready",), "match_readiness"),
    5: Visual((), ("stale_5yr",), "staleness"),
    6: Visual(("snapshot_date", "metric_category"), ("issue_count",), trend=True),
    7: Visual(_TYPED, ("issue_count",), "linkage"),
    8: Visual((), ("issue_count",), "linkage", "duplicate_entity_id"),
    9: Visual((), ("issue_count",), "linkage", "linked_count"),
    10: Visual((), ("issue_count",), "linkage", "orphan_cross_ref"),
    11: Visual((), ("issue_count",), "linkage", "unlinked_count"),
    12: Visual(("snapshot_date",), ("issue_count",), "linkage", "linked_count", trend=True),
    13: Visual(_TYPED, ("issue_count",), "completeness"),
    14: Visual((), ("issue_count",), "completeness", "no_contact_info"),
    15: Visual((), ("issue_count",), "completeness", "missing_email"),
    16: Visual((), ("issue_count",), "completeness", "missing_all_phones"),
    17: Visual(_TYPED, ("numerator", "denominator", "issue_count", "record_count"), "completeness"),
    18: Visual(_TYPED, category="field_quality"),
    19: Visual(("metric_name",), ("numerator", "denominator"), "field_quality"),
    20: Visual(_TYPED, category="parity"),
    21: Visual(category="parity", metric="phys_addr_certified_mismatch"),
    22: Visual(category="parity", metric="address_confirmed_undeliverable"),
    23: Visual(_TYPED, category="parity"),
    24: Visual(_TYPED, category="staleness"),
    25: Visual(category="staleness", metric="never_transacted"),
    26: Visual(category="staleness", metric="no_account"),
    27: Visual(category="staleness", metric="5+yr"),
    28: Visual(("metric_name",), category="staleness", pivot=("sales_decile", lists.DECILES)),
    29: Visual(_TYPED, category="match_readiness"),
    30: Visual(category="match_readiness", metric="tier_1_strong"),
    31: Visual(category="match_readiness", metric="tier_2_partial"),
    32: Visual(category="match_readiness", metric="tier_4_no_name"),
    33: Visual(("metric_name",), category="match_readiness"),
    34: Visual(("snapshot_date", "metric_category"), trend=True),
    35: Visual(("snapshot_date", "metric_name"), trend=True),
    36: Visual(("metric_category", "metric_name"), ("numerator", "denominator", "issue_rate")),
    37: Visual(("creation_cohort",), ("issue_rate",), known_cohorts=True),
}


def slicers(snapshot: DataFrame, **equal: str) -> DataFrame:
    """Slicer choices of a report page: contact type, decile, cohort or category."""
    for column, value in equal.items():
        snapshot = snapshot.filter(f"{column} = {lit(value)}")
    return snapshot


def report(snapshot: DataFrame, visual: Visual) -> DataFrame:
    rows = snapshot if visual.trend else latest(snapshot)
    if visual.category:
        rows = slicers(rows, metric_category=visual.category)
    if visual.metric:
        rows = slicers(rows, metric_name=visual.metric)
    if visual.known_cohorts:
        rows = rows.filter("creation_cohort NOT IN ('ALL', 'Unknown')")
    measures = [measure(m) for m in visual.measures]
    if not visual.by:
        return rows.agg(*measures)
    grouped = rows.groupBy(*visual.by)
    order = [F.expr(rank_of(c, lists.STALENESS_BUCKETS) if (visual.category, c) == ("staleness", "metric_name") else c)
             for c in visual.by]
    if visual.pivot:
        return grouped.pivot(visual.pivot[0], list(visual.pivot[1])).agg(*measures).orderBy(*order)
    return grouped.agg(*measures).orderBy(*order)


def issue_rate_of_issues(snapshot: DataFrame, dim_metric: DataFrame) -> DataFrame:
    """Issue rate over issue metrics only; the metric table has one row per metric name."""
    issues = dim_metric.filter("is_issue").select("metric_name")
    return latest(snapshot).join(issues, "metric_name", "left_semi").agg(measure("issue_rate"))


def snapshot_delta(snapshot: DataFrame, before: dt.date | None, after: dt.date | None) -> DataFrame:
    """Change of every metric between two snapshots, in one grouped pass."""
    at = lambda day: f"coalesce(sum(CASE WHEN snapshot_date = {lit(day)} THEN numerator END), 0)"
    return (
        snapshot.filter(f"snapshot_date IN {values((before, after))}")
        .groupBy("metric_category", "metric_name")
        .agg(*exprs(f"{at(before)} AS numerator_before", f"{at(after)} AS numerator_after"))
        .selectExpr("*", "numerator_after - numerator_before AS numerator_delta")
        .orderBy("metric_category", "metric_name")
    )


def latest_delta(snapshot: DataFrame) -> DataFrame:
    """Change between the two newest stored dates; from nothing, if there is only one."""
    dates = stored_dates(snapshot)
    before, after = (dates[-2:] if len(dates) > 1 else (None, *dates)) if dates else (None, None)
    return snapshot_delta(snapshot, before, after)


def coverage(snapshot: DataFrame) -> DataFrame:
    """How far the newest snapshot reaches each metric: its slices, those where it counts something, and the sum. A
    metric that counts nothing in any slice shows a rule that never fires, or data that never reach it."""
    return latest(snapshot).groupBy("metric_category", "metric_name").agg(*exprs(
        "count(*) AS slices", "count_if(numerator > 0) AS reached_slices", "sum(numerator) AS total"
    )).selectExpr("*", "reached_slices > 0 AS reached").orderBy("metric_category", "metric_name")


def parity_sum_check(snapshot: DataFrame, fields: list[str]) -> DataFrame:
    """Slices whose five outcomes do not add up to the denominator; none expected."""
    names = [f"{f}_{o}" for f in fields for o in lists.PARITY_OUTCOMES]
    outcome = "_(" + "|".join(lists.PARITY_OUTCOMES) + ")$"
    return (
        slicers(snapshot, metric_category="parity").filter(f"metric_name IN {values(names)}")
        .groupBy("snapshot_date", *SLICE, F.expr(f"regexp_replace(metric_name, {lit(outcome)}, '') AS field_name"))
        .agg(*exprs("sum(numerator) AS outcomes", "max(denominator) AS denominator"))
        .filter("outcomes <> denominator")
    )


def linkage_progress(snapshot: DataFrame) -> DataFrame:
    """Linked and unlinked contacts per snapshot date."""
    return slicers(snapshot, metric_category="linkage").groupBy("snapshot_date").agg(*exprs(
        f"{_sum_of('numerator', 'linked_count')} AS linked", f"{_sum_of('numerator', 'unlinked_count')} AS unlinked"
    )).orderBy("snapshot_date")
