"""The issue map: which contact fails which metric."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from linkledger.functions import lists
from linkledger.functions.columns import lit
from linkledger.operators import parity
from linkledger.operators.flags import Check, failures

ISSUE_OUTCOMES = ("mismatch", "equip_only", "registry_only")


#: Linkage issues as bits of a word of their own.
LINKAGE_ISSUES = {
    "unlinked_count": "links = 0",
    "ckc_id_no_cross_ref": "links = 0 AND ckc_id IS NOT NULL",
    "type_mismatch_linkage": "(contact_type = 'C' AND links > contact_level_links) OR "
                             "(contact_type IN ('B', 'I') AND contact_level_links > 0)",
}


def shared_entity_issues(enriched: DataFrame, links: DataFrame) -> DataFrame:
    """Contacts linked to an entity that more than one contact is linked to.

    Works on counts per code, so contacts and links of a hot code are never paired.
    """
    per_code = enriched.groupBy("code_key").agg(F.expr("count(*) AS contacts"))
    shared = (
        links.join(per_code, "code_key")
        .groupBy("entity_id")
        .agg(F.expr("sum(contacts) AS linked"))
        .filter("linked > 1")
    )
    codes = links.join(shared, "entity_id", "left_semi").select("code_key").distinct()
    return enriched.join(codes, "code_key", "left_semi").select("contact_code").distinct().selectExpr(
        "contact_code", "'duplicate_entity_id' AS metric_name"
    )


def contact_issues(enriched: DataFrame, rules: list[Check]) -> DataFrame:
    """Linkage and all rules, from bits; rows of one code, which differ by account, are one."""
    bits = " + ".join(f"CASE WHEN {test} THEN {1 << i}L ELSE 0L END" for i, test in enumerate(LINKAGE_ISSUES.values()))
    linkage = [Check(name, "linkage", i, 1 << i) for i, name in enumerate(LINKAGE_ISSUES)]
    return failures(enriched.selectExpr("*", f"{bits} AS linkage"), "contact_code", [*linkage, *rules])


def parity_issues(linked: DataFrame) -> DataFrame:
    tails = tuple(f"_{o}" for o in lists.PARITY_OUTCOMES if o not in ISSUE_OUTCOMES)
    whole = {f"{f.name}{t}" for f in parity.FIELDS for t in tails}
    return failures(linked, "contact_code", [c for c in parity.checks() if c.name not in whole])


def inactive_issues(inactive: DataFrame) -> DataFrame:
    return inactive.filter(parity.REASON_CONFLICT).select("contact_code").distinct().selectExpr(
        "contact_code", f"{lit(parity.INACTIVE_REASON)} AS metric_name")


def issue_map(enriched, links, linked, inactive, rules: list[Check], as_of: dt.date) -> DataFrame:
    """A row per contact and metric. The parts have different metrics and each has a contact once, so the whole needs
    no further shuffle."""
    parts = [
        contact_issues(enriched, rules), shared_entity_issues(enriched, links),
        parity_issues(linked), inactive_issues(inactive),
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything.selectExpr(f"{lit(as_of)} AS snapshot_date", "metric_name", "contact_code")
