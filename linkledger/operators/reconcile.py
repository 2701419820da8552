"""Match reports against CRM ids, and the files made from the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkledger.config import Settings
from linkledger.functions.columns import code_key
from linkledger.operators.extracts import quote_flow_customers
from linkledger.operators.population import employee_keys
from linkledger.operators.revenue import exprs

STATUSES = ("AGREE", "DISAGREE", "SF_MISSING")


def crm_ids(crm, account, contact, settings: Settings) -> DataFrame:
    """One CRM entity id per code; a repeated code keeps its highest id."""
    return quote_flow_customers(crm, account, contact, settings).groupBy(
        F.expr(f"{code_key('contact_code')} AS code_key")
    ).agg(F.expr("cast(max(comp_entity_id) AS string) AS crm_entity_id"))


def reconcile_matches(tight_match: DataFrame, ids: DataFrame) -> DataFrame:
    status = (
        "CASE WHEN crm_entity_id IS NULL THEN 'SF_MISSING' WHEN crm_entity_id = entity_id THEN 'AGREE' ELSE 'DISAGREE' END"
    )
    return tight_match.selectExpr("*", f"{code_key('dbs_number')} AS code_key").join(ids, "code_key", "left").selectExpr(
        "dbs_number", "entity_id AS match_entity_id", "contact_id AS match_contact_id",
        "coalesce(crm_entity_id, '') AS crm_entity_id", f"{status} AS status",
    )


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    """Rows per status; a status without rows shows zero."""
    counted = reconciled.agg(*exprs(*(f"count_if(status = '{s}') AS {s}" for s in STATUSES)))
    pairs = ", ".join(f"'{s}', {s}" for s in STATUSES)
    return counted.selectExpr(f"stack({len(STATUSES)}, {pairs}) AS (status, matches)")


def employee_codes(contact, technician, salesperson) -> DataFrame:
    return contact.select("contact_code").join(
        employee_keys(technician, salesperson), "contact_code", "left_semi"
    ).distinct()


def exclusion_keys(codes: DataFrame) -> DataFrame:
    """Codes to leave out, trimmed and in upper case, blank ones dropped."""
    return codes.selectExpr(f"upper(trim({codes.columns[0]})) AS code_key").filter("code_key <> ''")


def split_matches(reconciled: DataFrame, status: str, excluded: DataFrame) -> DataFrame:
    """Upload rows of one status without the excluded codes; contact id 0 is left empty."""
    chosen = reconciled.filter(f"status = '{status}'").selectExpr("*", f"{code_key('dbs_number')} AS code_key")
    return chosen.join(exclusion_keys(excluded), "code_key", "left_anti").selectExpr(
        "dbs_number", "match_entity_id AS entity_id", "if(match_contact_id <> '0', match_contact_id, '') AS contact_id"
    )
