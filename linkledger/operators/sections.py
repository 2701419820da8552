"""The six snapshot sections.

Each section is one grouped pass. Linkage, staleness and match readiness are conditional counts, turned into one row
per metric afterwards; rules and parity are bits, judged before, whose rows are counted alike and meet the list of
checks then. Every slice is grouped first, so zero counts keep their row and no spine has to be joined.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, functions as F

from linkledger.config import SLICE, SNAPSHOT_COLUMNS
from linkledger.functions import lists
from linkledger.functions.columns import MATCH_TIER, lit
from linkledger.operators import parity
from linkledger.operators.flags import Check, folded, tally

STANDALONE = ("contact_type", "creation_cohort")
Entry = tuple[str, str, str]  # metric, numerator, denominator


def counted(df: DataFrame, counts: list[str]) -> DataFrame:
    return df.groupBy(*SLICE).agg(*(F.expr(c) for c in counts))


def metric_rows(df: DataFrame, entries: list[Entry]) -> DataFrame:
    """One row per entry of each counted slice."""
    rows = ", ".join(
        f"named_struct('metric_name', {lit(name)}, 'numerator', cast({num} AS bigint), 'denominator', cast({den} AS bigint))"
        for name, num, den in entries
    )
    return df.selectExpr(*SLICE, f"inline(array({rows}))")


def to_snapshot_rows(df: DataFrame, category: str, as_of: dt.date) -> DataFrame:
    """Rows of one category in the snapshot's columns."""
    return df.selectExpr(
        f"{lit(as_of)} AS snapshot_date", f"{lit(category)} AS metric_category", *SNAPSHOT_COLUMNS[2:]
    )


# Linkage

LINK_COUNTS = [
    "sum(links) AS linked", "count_if(unlinked) AS unlinked", "sum(weight) AS every",
    "count_if(has_id AND unlinked) AS id_unlinked", "coalesce(sum(CASE WHEN has_id THEN weight END), 0) AS with_id",
    "coalesce(sum(conflict), 0) AS conflicts",
]
LINK_ENTRIES: list[Entry] = [
    ("linked_count", "linked", "every"),
    ("unlinked_count", "unlinked", "every"),
    ("ckc_id_no_cross_ref", "id_unlinked", "with_id"),
    ("type_mismatch_linkage", "conflicts", "linked"),
]
LINK_JUDGED = [
    "links", "greatest(links, 1) AS weight", "links = 0 AS unlinked", "ckc_id IS NOT NULL AS has_id",
    "CASE WHEN contact_type = 'C' THEN links - contact_level_links "
    "WHEN contact_type IN ('B', 'I') THEN contact_level_links END AS conflict",
]


def _linkage_of(numbers: DataFrame, metrics: set[str] | None = None) -> DataFrame:
    rows = metric_rows(numbers, [e for e in LINK_ENTRIES if metrics is None or e[0] in metrics])
    return rows.filter("metric_name <> 'type_mismatch_linkage' OR denominator > 0")


def linkage_by_slice(linked: DataFrame, keep: tuple[str, ...] = SLICE, metrics: set[str] | None = None) -> DataFrame:
    """Linked, unlinked, id without link, level conflict; input has link counts per contact.

    A contact with several links counts once per link, one without links once.
    """
    return _linkage_of(counted(linked.selectExpr(*folded(keep), *LINK_JUDGED), LINK_COUNTS), metrics)


def linkage_overall(enriched: DataFrame, links: DataFrame, branch: str | None = None) -> DataFrame:
    """Shared entities and orphan cross references, over the whole population.

    Contacts are counted per code first; a code then meets its links once,
    whatever the number of contacts or links behind it.
    """
    per_code = enriched.groupBy("code_key").agg(F.expr("count(*) AS contacts"))
    per_entity = links.join(per_code, "code_key", "left").groupBy("entity_id").agg(
        F.expr("sum(contacts) AS linked"), F.expr("count_if(contacts IS NULL) AS orphans"), F.expr("count(*) AS links")
    )
    one_row = per_entity.agg(
        F.expr("count_if(linked > 1) AS shared"), F.expr("count(linked) AS entities"),
        F.expr("coalesce(sum(orphans), 0) AS orphans"), F.expr("coalesce(sum(links), 0) AS all_links"),
    )
    whole = [f"cast({lit(branch)} AS string) AS branch" if d == "branch" else f"'ALL' AS {d}" for d in SLICE]
    return metric_rows(one_row.selectExpr("*", *whole), [
        ("duplicate_entity_id", "shared", "entities"), ("orphan_cross_ref", "orphans", "all_links"),
    ])


# Parity

def parity_rows(judged: DataFrame, names: list[str] | None = None, keep: tuple[str, ...] = SLICE) -> DataFrame:
    """All five outcomes of every field, zero counts included, and the address and status checks; or those of the
    fields and checks in ``names``."""
    return tally(judged, parity.checks(names), keep)


def inactive_reason_rows(inactive: DataFrame, keep: tuple[str, ...] = SLICE) -> DataFrame:
    judged = inactive.selectExpr(*folded(keep), f"{parity.REASON_CONFLICT} AS conflict")
    return metric_rows(
        counted(judged, ["count_if(conflict) AS n", "count(*) AS d"]), [(parity.INACTIVE_REASON, "n", "d")]
    )


# Completeness and field quality

def rule_rows(judged: DataFrame, found: list[Check], keep: tuple[str, ...] = SLICE) -> DataFrame:
    """Counts of rules whose outcomes are bits of the contacts."""
    return tally(judged, found, keep)


# Staleness and match readiness

TIER_COUNTS = [f"count_if(tier = '{t}') AS {t}" for t in lists.MATCH_TIERS]


def _staleness_of(slices: DataFrame) -> DataFrame:
    """Buckets folded from slices counted as ``everyone``."""
    keep = tuple(d for d in SLICE if d != "staleness_bucket")
    numbers = counted(slices.selectExpr(*folded(keep), "staleness_bucket AS bucket", "everyone AS n"), [
        "sum(n) AS everyone",
        *(f"coalesce(sum(CASE WHEN bucket = '{b}' THEN n END), 0) AS `{b}`" for b in lists.STALENESS_BUCKETS),
    ])
    return metric_rows(numbers, [(b, f"`{b}`", "everyone") for b in lists.STALENESS_BUCKETS])


def staleness_rows(enriched: DataFrame) -> DataFrame:
    """All eight buckets of every slice; the bucket is the metric."""
    return _staleness_of(counted(enriched.select(*SLICE), ["count(*) AS everyone"]))


def readiness_rows(unlinked: DataFrame) -> DataFrame:
    """All four match tiers of every slice of unlinked contacts."""
    numbers = counted(unlinked.selectExpr(*SLICE, f"{MATCH_TIER} AS tier"), ["count(*) AS everyone", *TIER_COUNTS])
    return metric_rows(numbers, [(t, t, "everyone") for t in lists.MATCH_TIERS])


def contact_rows(enriched: DataFrame) -> dict[str, DataFrame]:
    """Linkage by slice, staleness and match readiness, all from one grouped pass over the contacts."""
    judged = enriched.selectExpr(*SLICE, *LINK_JUDGED, f"CASE WHEN links = 0 THEN {MATCH_TIER} END AS tier")
    numbers = counted(judged, [*LINK_COUNTS, "count(*) AS everyone", *TIER_COUNTS])
    tiers = metric_rows(numbers.filter("unlinked > 0"), [(t, t, "unlinked") for t in lists.MATCH_TIERS])
    return {"linkage": _linkage_of(numbers), "staleness": _staleness_of(numbers), "match_readiness": tiers}


def occurring(df: DataFrame, metric: str, keep: tuple[str, ...]) -> DataFrame:
    """Count only the metrics that occur; the slice total is a window over the few counted rows."""
    numbers = df.selectExpr(f"{metric} AS metric_name", *folded(keep)).groupBy("metric_name", *SLICE).agg(
        F.expr("count(*) AS numerator")
    )
    return numbers.selectExpr("*", f"sum(numerator) OVER (PARTITION BY {', '.join(SLICE)}) AS denominator")
