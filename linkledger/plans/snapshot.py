"""Assembly of the dated snapshot and of the standalone sections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from linkledger.config import SLICE
from linkledger.functions import lists
from linkledger.functions.columns import MATCH_TIER, rank_of, values
from linkledger.operators import parity, sections
from linkledger.operators.rules import Rule, all_rules, checks, completeness_rules, field_quality_rules
from linkledger.plans.workspace import Workspace
from linkledger.sources.readers import read_snapshot
from linkledger.sources.sinks import append_snapshot

CATEGORIES = ("linkage", "parity", "completeness", "field_quality", "staleness", "match_readiness")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rules(ws: Workspace, rules: list[Rule], keep: tuple[str, ...] = SLICE) -> DataFrame:
    return sections.rule_rows(ws.enriched(), checks(ws.settings, rules), keep)


def section(ws: Workspace, category: str) -> DataFrame:
    """One category of the snapshot over all slice columns."""
    s = ws.settings
    if category == "linkage":
        rows = union([
            sections.linkage_by_slice(ws.enriched()),
            sections.linkage_overall(ws.enriched(), ws.links()),
        ])
    elif category == "parity":
        rows = union([
            sections.parity_rows(ws.linked()),
            sections.inactive_reason_rows(ws.inactive_linked()),
        ])
    elif category == "completeness":
        rows = _rules(ws, completeness_rules())
    elif category == "field_quality":
        rows = _rules(ws, [r for r in field_quality_rules(s) if r.in_snapshot])
    elif category == "staleness":
        rows = sections.staleness_rows(ws.enriched())
    else:
        rows = sections.readiness_rows(ws.unlinked())
    return sections.to_snapshot_rows(rows, category, s.as_of)


def dq_snapshot(ws: Workspace) -> DataFrame:
    """All categories. Completeness and field quality share one scan of the contacts; linkage, staleness and match
    readiness are counts of the same slices and share another."""
    counts = sections.contact_rows(ws.enriched())
    counts["linkage"] = counts["linkage"].unionByName(sections.linkage_overall(ws.enriched(), ws.links()))
    rules = _rules(ws, all_rules(ws.settings))
    first = f"metric_name IN {values(r.name for r in completeness_rules())}"
    return union([
        *(sections.to_snapshot_rows(rows, c, ws.settings.as_of) for c, rows in counts.items()),
        section(ws, "parity"),
        sections.to_snapshot_rows(rules, "field_quality", ws.settings.as_of).withColumn(
            "metric_category", F.expr(f"if({first}, 'completeness', metric_category)")
        ),
    ])


def stored_snapshots(ws: Workspace) -> DataFrame:
    """The snapshot table over all history dates, each date appended as its own run."""
    def build() -> DataFrame:
        path = ws.scratch.path("snapshots")
        runs = [ws.at(day) for day in ws.settings.dates]  # all of them first, so that they share the contacts
        for run in runs:
            append_snapshot(dq_snapshot(run), path)
        return read_snapshot(ws.spark, path)
    return ws.once("snapshots", build)


# Standalone sections: contact type and cohort only, the rest folded to ALL.

def dq_linkage(ws: Workspace) -> DataFrame:
    rows = union([
        sections.linkage_by_slice(ws.enriched(), sections.STANDALONE),
        sections.linkage_overall(ws.enriched(), ws.links(), branch="ALL"),
    ])
    return sections.to_snapshot_rows(rows, "linkage", ws.settings.as_of)


def dq_parity(ws: Workspace) -> DataFrame:
    """Only outcomes that occur, and the two address checks."""
    address = parity.PRIORITY[:2]
    names = [*(f.name for f in parity.FIELDS), *address]
    rows = sections.parity_rows(ws.linked(), names, sections.STANDALONE).filter(f"numerator > 0 OR metric_name IN {values(address)}")
    return sections.to_snapshot_rows(rows, "parity", ws.settings.as_of)


def dq_completeness(ws: Workspace) -> DataFrame:
    """Name checks by type; address, phone and mail checks over all types."""
    rules = completeness_rules()
    rows = union([
        _rules(ws, [r for r in rules if r.scope != "all"], sections.STANDALONE),
        _rules(ws, [r for r in rules if r.scope == "all"], ("creation_cohort",)),
    ])
    return sections.to_snapshot_rows(rows, "completeness", ws.settings.as_of)


def dq_field_quality(ws: Workspace) -> DataFrame:
    """All field quality rules, including those the snapshot leaves out."""
    rows = _rules(ws, field_quality_rules(ws.settings), sections.STANDALONE)
    return sections.to_snapshot_rows(rows, "field_quality", ws.settings.as_of)


def dq_staleness(ws: Workspace) -> DataFrame:
    """Buckets that occur, by type, decile and cohort, in the order of the buckets."""
    enriched = ws.enriched().select(*SLICE)
    rows = sections.occurring(enriched, "staleness_bucket", (*sections.STANDALONE, "sales_decile"))
    return sections.to_snapshot_rows(rows, "staleness", ws.settings.as_of).orderBy(
        F.expr(rank_of("metric_name", lists.STALENESS_BUCKETS)), "contact_type", "sales_decile", "creation_cohort")


def dq_match_readiness(ws: Workspace) -> DataFrame:
    """Tiers that occur, by type and cohort."""
    unlinked = ws.unlinked()
    rows = sections.occurring(unlinked, MATCH_TIER, sections.STANDALONE)
    return sections.to_snapshot_rows(rows, "match_readiness", ws.settings.as_of)


STANDALONE_SECTIONS = {
    "dq_linkage": dq_linkage, "dq_parity": dq_parity, "dq_completeness": dq_completeness,
    "dq_field_quality": dq_field_quality, "dq_staleness": dq_staleness, "dq_match_readiness": dq_match_readiness,
}


def metric(ws: Workspace, category: str, name: str) -> DataFrame:
    """Rows of one metric; only its own check is evaluated."""
    s = ws.settings
    if category == "linkage":
        if name in ("duplicate_entity_id", "orphan_cross_ref"):
            rows = sections.linkage_overall(ws.enriched(), ws.links()).filter(f"metric_name = '{name}'")
        else:
            rows = sections.linkage_by_slice(ws.enriched(), metrics={name})
    elif category == "priority":
        if name == parity.PRIORITY[4]:
            rows = sections.inactive_reason_rows(ws.inactive_linked())
        else:
            rows = sections.parity_rows(ws.linked(), [name])
        category = "parity"
    elif category == "parity":
        rows = sections.parity_rows(ws.linked(), [name])
    else:
        rows = _rules(ws, [r for r in all_rules(s, standalone=True) if r.name == name])
    return sections.to_snapshot_rows(rows, category, s.as_of)
