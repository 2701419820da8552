"""Linkage progress since the project start."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkledger.config import Settings
from linkledger.functions.columns import lit
from linkledger.operators.revenue import exprs


def _of_dealer(xref: DataFrame, settings: Settings) -> DataFrame:
    return xref if settings.dealer_id is None else xref.filter(f"dealer_id = {lit(settings.dealer_id)}")


def tracking_totals(xref: DataFrame, settings: Settings) -> DataFrame:
    """Links before the start, since then, and altogether, in one pass; no date counts as before."""
    since = f"coalesce(created_ts >= {lit(settings.started)}, false)"
    counted = _of_dealer(xref, settings).agg(*exprs(
        f"count_if(NOT {since}) AS baseline", f"count_if({since}) AS project", "count(*) AS total"
    ))
    return counted.selectExpr(
        "stack(3, 'BASELINE', baseline, 'PROJECT', project, 'TOTAL', total) AS (period, linkage_count)"
    )


def tracking_daily(xref: DataFrame, settings: Settings) -> DataFrame:
    """New links per day with a running total; the window sees one row per calendar day."""
    daily = (
        _of_dealer(xref, settings).filter(f"created_ts >= {lit(settings.started)}")
        .groupBy(F.expr("cast(created_ts AS date) AS created_date"))
        .agg(F.expr("count(*) AS new_linkages"))
    )
    return daily.selectExpr(
        "*", "sum(new_linkages) OVER (ORDER BY created_date) AS project_running_total"
    ).orderBy("created_date")
