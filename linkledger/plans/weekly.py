"""The recurring run: snapshot, issue map and lookup tables, published together."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linkledger.operators import dimensions, issues
from linkledger.operators.revenue import exprs
from linkledger.operators.rules import all_rules, checks
from linkledger.plans import snapshot
from linkledger.plans.workspace import Workspace
from linkledger.sources import publishing


class NamesDiffer(Exception):
    """Metric names of the snapshot and of the metric table are not the same."""


class NotStored(Exception):
    """The stored snapshot is not the one that was computed."""


def _totals(rows: DataFrame) -> set[tuple]:
    """A row per category: a handful."""
    found = rows.groupBy("snapshot_date", "metric_category").agg(
        *exprs("count(*) AS n", "sum(numerator) AS a", "sum(denominator) AS b")).collect()
    return set(map(tuple, found))


def lookup_tables(ws: Workspace) -> dict[str, DataFrame]:
    found = {name: dimensions.dimension(ws.spark, name) for name in dimensions.dimension_rows()}
    return found | {"dim_metric": dimensions.dim_metric(ws.spark, ws.settings)}


def issue_map(ws: Workspace) -> DataFrame:
    return issues.issue_map(
        ws.enriched(), ws.links(), ws.linked(), ws.inactive_linked(), checks(ws.settings, all_rules(ws.settings)),
        ws.settings.as_of,
    )


def weekly_run(ws: Workspace, root: str, lookups: bool = False) -> publishing.Pointer:
    """Compute and publish everything of the date ``as_of`` below ``root``.

    Metric names are compared before anything is written. Snapshot, issue map and, if asked for, lookup tables go to
    folders of this run, the snapshot is read back and verified, and only then all of them become current together;
    the date is added to the snapshot table, or replaced if it is there. After a failure the run before is current.
    """
    rows = ws.scratch.stage(snapshot.dq_snapshot(ws), "run")
    tables = lookup_tables(ws)
    differing = dimensions.metric_name_parity(rows, tables["dim_metric"]).orderBy("metric_name").collect()
    if differing:
        raise NamesDiffer("; ".join(f"{r.metric_name}: {r.finding}" for r in differing))
    run = publishing.Run(ws.spark, root)
    if _totals(run.write_snapshot(rows)) != _totals(rows):
        raise NotStored(f"snapshot of {ws.settings.as_of} below {root}")
    run.write_issue_map(issue_map(ws))
    if lookups:
        run.write_lookups(tables)
    return run.publish()
