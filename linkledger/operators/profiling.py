"""Profiling queries over contacts, cross references, registry and CRM rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkledger.config import Settings
from linkledger.functions.columns import IS_ACTIVE, code_key, lit, valid_entity
from linkledger.operators.population import CONTACT_LEVEL, matched_and_unmatched, without_employees
from linkledger.operators.ranking import Stage, in_global_order
from linkledger.operators.revenue import exprs

LINK_LEVEL = f"if({CONTACT_LEVEL}, 'entity + contact_id', 'entity only') AS ref_type"
SECOND_ID = (
    "count_if(cmp_ckc_id IS NULL) AS cmp_null", "count_if(cmp_ckc_id = 0) AS cmp_zero",
    "count_if(cmp_ckc_id > 0) AS cmp_populated",
)


def contact_type_breakdown(contact: DataFrame) -> DataFrame:
    return contact.groupBy("contact_type", F.expr("coalesce(inactive_indicator, 'A') AS status")).agg(
        *exprs("count(*) AS total", "count(ckc_id) AS has_ckc_id", *SECOND_ID)
    ).orderBy("contact_type", "status")


def histogram(df: DataFrame, key: str, counted: str, size: str, groups: str) -> DataFrame:
    """How many keys have 1, 2, 3 … rows."""
    per_key = df.groupBy(key).agg(F.count(counted).alias(size))
    return per_key.groupBy(size).agg(F.count("*").alias(groups)).orderBy(size)


def account_cardinality(account: DataFrame) -> DataFrame:
    return histogram(account, "contact_code", "account_no", "contact_code_count", "account_count")


def links_per_entity(xref: DataFrame) -> DataFrame:
    return histogram(xref, "entity_id", "cross_ref_number", "links_per_entity", "entity_id_count")


def crm_breakdown(crm: DataFrame, settings: Settings) -> DataFrame:
    kind = (
        f"CASE record_type WHEN {lit(settings.customer_type)} THEN 'Customer' "
        f"WHEN {lit(settings.prospect_type)} THEN 'Prospect' ELSE 'Other' END AS record_type"
    )
    return crm.groupBy(F.expr(kind)).agg(*exprs(
        "count(*) AS total", "count(account_no) AS has_account_number", "count(comp_entity_id) AS has_comp_entity_id",
        "count(erp_entity_id) AS has_erp_entity_id",
        "count_if(comp_entity_id IS NOT NULL AND erp_entity_id IS NULL) AS comp_only",
        "count_if(erp_entity_id IS NOT NULL) AS erp_sourced",
    )).orderBy("record_type")


LEADING_DIGIT = "left(cast(entity_id AS string), 1) AS leading_digit"


def entity_range_profile(profile: DataFrame) -> DataFrame:
    return profile.groupBy(F.expr(LEADING_DIGIT)).agg(*exprs(
        "count(*) AS total", "count_if(out_of_business = 'Y') AS out_of_business", "count_if(deceased = 'Y') AS deceased",
        "min(entity_id) AS min_id", "max(entity_id) AS max_id",
    )).orderBy("leading_digit")


def contact_links(contact: DataFrame, xref: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Every contact with each of its cross references, whatever their source."""
    left = contact.selectExpr(
        "contact_code", "contact_type", "ckc_id", "cmp_ckc_id", f"{code_key('contact_code', case_sensitive)} AS code_key"
    )
    right = xref.selectExpr(
        "cross_ref_number", "entity_id", "contact_id", f"{code_key('cross_ref_number', case_sensitive)} AS code_key"
    )
    return left.join(right, "code_key").drop("code_key")


def case_mismatch_sample(contact: DataFrame, xref: DataFrame, rows: int = 30) -> DataFrame:
    case = lambda c: f"if({c} = upper({c}), 'upper', 'mixed/lower')"
    return (
        contact_links(contact, xref)
        .filter("cross_ref_number <> contact_code")
        .selectExpr("cross_ref_number", "contact_code",
                    f"{case('cross_ref_number')} AS xref_case", f"{case('contact_code')} AS contact_case")
        .orderBy("cross_ref_number", "contact_code")
        .limit(rows)
    )


def case_false_positives(contact: DataFrame, xref: DataFrame, settings: Settings) -> DataFrame:
    """Links that an exact-case join misses and an upper-case join finds."""
    keys = xref.groupBy(F.expr(f"{code_key('cross_ref_number')} AS code_key")).agg(F.expr("count(*) AS links"))
    known = contact.filter(f"{valid_entity('ckc_id', settings.sentinel_entity)} AND {IS_ACTIVE}").selectExpr(
        "contact_code", f"{code_key('contact_code')} AS code_key"
    )
    exact = xref.select(F.col("cross_ref_number").alias("contact_code"))
    return known.join(exact, "contact_code", "left_anti").join(keys, "code_key").agg(
        F.expr("coalesce(sum(links), 0) AS false_positives")
    )


def link_level_by_type(contact, xref, case_sensitive: bool = False) -> DataFrame:
    return contact_links(contact, xref, case_sensitive).groupBy("contact_type", F.expr(LINK_LEVEL)).agg(
        *exprs("count(*) AS row_count", "count(DISTINCT entity_id) AS distinct_entity_ids")
    ).orderBy("contact_type", "ref_type")


def id_agreement(contact, xref, case_sensitive: bool = False) -> DataFrame:
    return contact_links(contact, xref.filter(CONTACT_LEVEL), case_sensitive).agg(*exprs(
        "count(*) AS total_with_contact_id", "count_if(ckc_id = entity_id) AS ckc_matches_entity_id",
        "count_if(cmp_ckc_id = contact_id) AS cmp_matches_contact_id",
        "count_if(ckc_id = entity_id AND cmp_ckc_id = contact_id) AS both_match",
    ))


def contact_entity_only(contact, xref, case_sensitive: bool = False) -> DataFrame:
    people, links = contact.filter("contact_type = 'C'"), xref.filter(f"NOT ({CONTACT_LEVEL})")
    return contact_links(people, links, case_sensitive).agg(*exprs(*SECOND_ID, "count(ckc_id) AS has_ckc_id"))


def duplicate_entity_list(contact, xref, stage: Stage, case_sensitive: bool = False) -> DataFrame:
    """Entities with several links: one row per member, numbered by code.

    The order is a distributed one, so no entity is gathered in one task,
    and the form is the same for every number of members.
    """
    pairs = contact_links(contact, xref, case_sensitive).select(
        "entity_id", "contact_type", "cross_ref_number", "contact_code"
    )
    sizes = pairs.groupBy("entity_id").agg(F.expr("count(cross_ref_number) AS dbs_count")).filter("dbs_count > 1")
    order = ["entity_id", "cross_ref_number", "contact_code"]
    placed = in_global_order(pairs.join(sizes, "entity_id"), order, stage)
    first = placed.groupBy("entity_id").agg(F.expr("min(position) AS _first"))
    return placed.join(first, "entity_id").selectExpr(
        "entity_id", "dbs_count", "position - _first + 1 AS member_no", "contact_type", "cross_ref_number"
    ).orderBy(F.desc("dbs_count"), "entity_id", "member_no")


def duplicate_type_combo(contact, xref, case_sensitive: bool = False) -> DataFrame:
    """How often each mix of contact types shares an entity, as types with counts such as B:1+C:2."""
    per_type = contact_links(contact, xref, case_sensitive).groupBy("entity_id", "contact_type").agg(
        F.expr("count(cross_ref_number) AS n")
    )
    mixes = per_type.groupBy("entity_id").agg(*exprs(
        "sum(n) AS members", "sort_array(collect_list(struct(contact_type, n))) AS mix"
    )).filter("members > 1")
    return mixes.groupBy("mix").agg(F.expr("count(*) AS entity_count")).selectExpr(
        "array_join(transform(mix, m -> concat(m.contact_type, ':', cast(m.n AS string))), '+') AS type_combo",
        "entity_count",
    ).orderBy(F.desc("entity_count"), "type_combo")


def entity_range_by_type(contact, xref, case_sensitive: bool = False) -> DataFrame:
    return contact_links(contact, xref, case_sensitive).groupBy(
        F.expr(LEADING_DIGIT), "contact_type", F.expr(LINK_LEVEL)
    ).agg(*exprs(
        "count(*) AS row_count", "min(entity_id) AS min_entity_id", "max(entity_id) AS max_entity_id"
    )).orderBy("leading_digit", "contact_type", "ref_type")


def crm_contacts(crm: DataFrame, account: DataFrame, contact: DataFrame, settings: Settings) -> DataFrame:
    """CRM customers with their account's contact."""
    return (
        crm.filter(f"record_type = {lit(settings.customer_type)}")
        .join(account.select("account_no", "contact_code"), "account_no")
        .join(contact, "contact_code")
    )


def _linked_customers(crm, account, contact, settings, case_sensitive: bool) -> DataFrame:
    """Customers with an id from the ERP system, and their join key."""
    return crm_contacts(crm.filter("erp_entity_id IS NOT NULL"), account, contact, settings).selectExpr(
        "crm_id", "account_no", "erp_entity_id", "contact_code", "contact_type", "ckc_id",
        f"{code_key('contact_code', case_sensitive)} AS code_key",
    )


def _entity_keys(xref: DataFrame, case_sensitive: bool) -> DataFrame:
    return xref.selectExpr("entity_id AS xref_entity_id", f"{code_key('cross_ref_number', case_sensitive)} AS code_key")


def crm_xref_agreement(crm, account, contact, xref, settings, case_sensitive: bool = False) -> DataFrame:
    """Links are counted per code, and per code and entity, before customers meet them.

    Both joins find one row at most, so a code with very many links or entities
    stays one row; disagreeing links are those known less those that agree.
    """
    links = _entity_keys(xref, case_sensitive)
    per_code = links.groupBy("code_key").agg(*exprs("count(*) AS links", "count(xref_entity_id) AS known"))
    per_entity = links.groupBy("code_key", F.col("xref_entity_id").alias("erp_entity_id")).agg(F.expr("count(*) AS agreeing"))
    people = _linked_customers(crm, account, contact, settings, case_sensitive)
    joined = people.join(per_code, "code_key", "left").join(per_entity, ["code_key", "erp_entity_id"], "left").selectExpr(
        "coalesce(links, 1) AS weight", "coalesce(known, 0) AS known", "coalesce(agreeing, 0) AS agreeing"
    )
    return joined.agg(*exprs(
        "coalesce(sum(weight), 0) AS customers_with_erp_id",
        "coalesce(sum(agreeing), 0) AS ids_agree",
        "coalesce(sum(known - agreeing), 0) AS ids_disagree",
        "coalesce(sum(weight - known), 0) AS no_cross_ref_found",
    ))


def crm_xref_disagreements(crm, account, contact, xref, settings, case_sensitive: bool = False, rows: int = 50) -> DataFrame:
    return (
        _linked_customers(crm, account, contact, settings, case_sensitive)
        .join(_entity_keys(xref, case_sensitive), "code_key")
        .filter("erp_entity_id <> xref_entity_id")
        .select("crm_id", "account_no", "erp_entity_id", "xref_entity_id", "contact_code", "contact_type")
        .orderBy("crm_id", "xref_entity_id")
        .limit(rows)
    )


def crm_without_xref(crm, account, contact, xref, settings, case_sensitive: bool = False) -> DataFrame:
    known = _entity_keys(xref.filter("entity_id IS NOT NULL"), case_sensitive)
    return _linked_customers(crm, account, contact, settings, case_sensitive).join(known, "code_key", "left_anti").agg(
        *exprs("count(*) AS total", "count(ckc_id) AS has_ckc_id", "count_if(ckc_id = erp_entity_id) AS ckc_agrees_with_crm")
    )


def parent_lookup(contact: DataFrame) -> DataFrame:
    """Does the second id of a contact point at another contact's entity?"""
    child = contact.filter("cmp_ckc_id > 0").select("contact_code", "contact_type", "ckc_id", "cmp_ckc_id")
    parent = contact.filter("ckc_id IS NOT NULL").selectExpr(
        "ckc_id AS cmp_ckc_id", "contact_code AS parent_contact_code", "contact_type AS parent_type"
    )
    return matched_and_unmatched(child, parent, "cmp_ckc_id").selectExpr(
        "contact_code", "contact_type", "ckc_id", "cmp_ckc_id", "parent_contact_code", "parent_type",
        "CASE WHEN parent_contact_code IS NOT NULL THEN cmp_ckc_id END AS parent_ckc_id",
    )


def coded_value_listing(contact, technician, salesperson) -> DataFrame:
    """Distinct suffix and title values of active persons; both come from one scan."""
    people = without_employees(
        contact.filter(f"{IS_ACTIVE} AND contact_type IN ('I', 'C')"), technician, salesperson
    )
    pairs = people.selectExpr("stack(2, 'suffix', suffix, 'title', title) AS (field_name, field_value)")
    return pairs.filter("trim(field_value) <> ''").groupBy("field_name", "field_value").agg(
        F.expr("count(*) AS contact_count")
    ).orderBy("field_name", F.desc("contact_count"), "field_value")
