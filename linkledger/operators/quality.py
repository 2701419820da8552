"""Composite quality figures and duplicate finding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkledger.config import Settings
from linkledger.functions import lists
from linkledger.functions.columns import IS_PERSON, MATCH_TIER, both, either, valid_entity, values
from linkledger.operators.flags import Check
from linkledger.operators.groups import Stage, connected
from linkledger.operators.revenue import exprs
from linkledger.operators.rules import PHONES

# Weight of each part of the quality index.
INDEX_WEIGHTS = {"name": 25, "address": 25, "reachable": 20, "no_flags": 20, "ready": 10}


def any_failed(rules: list[Check]) -> str:
    """True when a contact fails any of the rules."""
    words = sorted({c.word for c in rules})
    return either(*(f"({w} & {sum(1 << c.bit for c in rules if c.word == w)}L) <> 0" for w in words))


def clean_record_pct(judged: DataFrame, rules: list[Check]) -> DataFrame:
    """Share of active contacts without any completeness or field quality flag."""
    return judged.selectExpr(f"{any_failed(rules)} AS flagged").agg(
        *exprs("count_if(NOT flagged) AS clean_contacts", "count(*) AS active_contacts")
    ).selectExpr("*", "try_divide(clean_contacts, active_contacts) AS clean_record_pct")


def quality_index(judged: DataFrame, field_rules: list[Check]) -> DataFrame:
    """Weighted score of 0 to 100 per contact, averaged by type.

    A linked contact needs no match readiness and gets that part in full.
    """
    check = {c.name: c for c in field_rules}

    def holds(rule: str) -> str:
        return f"({check[rule].applies} AND NOT {check[rule].counts})"

    zip_ok = f"if(coalesce(country, 'US') = 'US', {holds('zip_invalid_format')}, pcode IS NOT NULL)"
    phones = [holds(f"{p}_nanp_invalid") for p in PHONES]
    parts = {
        "name": f"if({IS_PERSON}, first_name IS NOT NULL AND last_name IS NOT NULL, company_name IS NOT NULL)",
        "address": f"street IS NOT NULL AND city IS NOT NULL AND length(state) = 2 AND {zip_ok}",
        "reachable": either(*phones, both("email IS NOT NULL", holds("email_invalid_format"))),
        "no_flags": f"NOT {any_failed(field_rules)}",
        "ready": f"links > 0 OR {MATCH_TIER} IN {values(lists.MATCH_TIERS[:2])}",
    }
    score = " + ".join(f"if({test}, {INDEX_WEIGHTS[p]}, 0)" for p, test in parts.items())
    scored = judged.selectExpr("contact_type", f"{score} AS score")
    return scored.groupBy("contact_type").agg(
        *exprs("count(*) AS contacts", "sum(score) AS score_sum")
    ).selectExpr("*", "try_divide(score_sum, contacts) AS quality_index").orderBy("contact_type")


def duplicate_candidates(enriched: DataFrame, settings: Settings) -> DataFrame:
    """Contacts that share a phone, a mail, a name in one place, or one of the two ids.

    Every contact is spread over its keys, keys are counted, and the members of
    repeated keys are listed. Pairs are never formed.
    """
    name = "coalesce(company_name, concat_ws(' ', first_name, last_name))"
    place = (
        f"CASE WHEN {name} <> '' AND city IS NOT NULL AND state IS NOT NULL "
        f"THEN upper(concat_ws('|', {name}, city, state)) END"
    )
    entity = f"CASE WHEN {valid_entity('ckc_id', settings.sentinel_entity)} THEN cast(ckc_id AS string) END"
    second = (
        f"CASE WHEN cmp_ckc_id > 0 AND {valid_entity('cmp_ckc_id', settings.sentinel_entity)} "
        "THEN cast(cmp_ckc_id AS string) END"
    )
    own = enriched.selectExpr("contact_code", (
        "stack(7, 'phone', biz_phone, 'phone', priv_phone, 'phone', mob_phone, 'email', upper(email), "
        f"'name_place', {place}, 'entity', {entity}, 'second_id', {second}) AS (key_type, key_value)"
    )).filter("key_value IS NOT NULL").distinct()
    repeated = own.groupBy("key_type", "key_value").agg(F.expr("count(*) AS contacts")).filter("contacts > 1")
    return own.join(repeated, ["key_type", "key_value"]).select("key_type", "key_value", "contacts", "contact_code")


def duplicate_groups(candidates: DataFrame, stage: Stage) -> DataFrame:
    """The candidates with the group that each contact falls into.

    A group holds all contacts that keys connect: those that share a phone, and through another of them a mail. Its
    code is the smallest of its contacts'. The members of a key are linked with its first one, not with each other.
    """
    members = stage(candidates, "duplicates")
    first = members.groupBy("key_type", "key_value").agg(F.expr("min(contact_code) AS first_code"))
    links = members.join(first, ["key_type", "key_value"]).selectExpr("contact_code AS a", "first_code AS b")
    groups = connected(links, stage).selectExpr("node AS contact_code", "least AS group_code")
    return members.join(groups, "contact_code").select(*candidates.columns, "group_code")
