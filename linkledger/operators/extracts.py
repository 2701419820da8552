"""Upload extracts and the checks around them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from linkledger.config import Settings
from linkledger.functions.columns import IS_ACTIVE, IS_FIRM, blank_to_null, code_key, lit, valid_entity
from linkledger.operators.population import matched_and_unmatched, without_employees
from linkledger.operators.profiling import crm_contacts
from linkledger.operators.ranking import Stage, in_global_order
from linkledger.operators.revenue import exprs

# Header texts of the upload templates, in template order.
LINK_HEADERS = {"dbs_number": "DBS Number", "entity_id": "Entity Id", "contact_id": "Contact Id"}
MATCH_HEADERS = {
    "dbs_customer_number": "DBS Customer Number", "business_name": "Business Name",
    "doing_business_as": "Doing Business As Name", "prefix": "Prefix", "first_name": "First Name",
    "familiar_name": "Familiar Name", "middle_name": "Middle Name", "last_name": "Last Name",
    "generation": "Generation", "suffix": "Suffix", "address_line_1": "Address Line 1",
    "address_line_2": "Address Line 2", "city": "City", "state_code": "State Code",
    "postal_code": "Postal Code", "country_code": "Country Code", "email_address": "Email Address",
    "work_phone": "Work Phone", "home_phone": "Home Phone", "mobile_phone": "Mobile Phone",
    "home_fax": "Home Fax", "work_fax": "Work Fax", "tax_type": "Tax Type", "tax_id": "Tax ID used only in countryCode: AR AU BO BR BZ CL CO CR DO EC GF GT GY HN HT JM MX NI NZ PA PE PR PY SR SV "
    "TT UY VE",
}
FILE_ROWS = 60000


def known_unlinked(contact: DataFrame, xref: DataFrame, settings: Settings) -> DataFrame:
    """Active contacts that carry an entity id but have no cross reference at all.

    Only a business contact has a second id, and the sentinel is none.
    """
    codes = xref.selectExpr(f"{code_key('cross_ref_number')} AS code_key")
    known = contact.filter(f"{valid_entity('ckc_id', settings.sentinel_entity)} AND {IS_ACTIVE}")
    person = f"contact_type = 'C' AND cmp_ckc_id > 0 AND cmp_ckc_id <> {settings.sentinel_entity}"
    return known.selectExpr("*", f"{code_key('contact_code')} AS code_key").join(codes, "code_key", "left_anti").selectExpr(
        "contact_code", "contact_type", "ckc_id AS entity_id", f"CASE WHEN {person} THEN cmp_ckc_id END AS contact_id"
    )


def path_a_extract(contact, technician, salesperson, xref, settings) -> DataFrame:
    found = without_employees(known_unlinked(contact, xref, settings), technician, salesperson)
    return found.selectExpr("contact_code AS dbs_number", "entity_id", "contact_id").orderBy("dbs_number")


def path_a_count(contact, technician, salesperson, xref, settings) -> DataFrame:
    found = without_employees(known_unlinked(contact, xref, settings), technician, salesperson)
    return found.agg(*exprs(
        "count(*) AS total", "count_if(contact_type = 'B') AS business", "count_if(contact_type = 'I') AS individual",
        "count_if(contact_type = 'C') AS business_contact", "count(contact_id) AS contact_with_contact_id",
    ))


def entity_flags(profile: DataFrame, settings: Settings) -> DataFrame:
    """Registry entities, one row each however often the registry repeats them; any repeated flag counts."""
    return profile.filter(f"source_desc = {lit(settings.source)} AND contact_id = 0").groupBy("entity_id").agg(
        *exprs("max(out_of_business) AS out_of_business", "max(deceased) AS deceased")
    )


def path_a_validation(contact, xref, profile, settings) -> DataFrame:
    """Does the registry know the entity, and the person below it?"""
    entity = entity_flags(profile, settings).selectExpr(
        "entity_id", "out_of_business AS entity_out_of_business", "deceased AS entity_deceased", "true AS _entity"
    )
    person = profile.filter(f"source_desc = {lit(settings.source)}").selectExpr(
        "entity_id", "contact_id", "true AS _person").distinct()
    found = lambda flag: f"if({flag} IS NULL, 'Not Found', 'Found')"
    return (
        known_unlinked(contact, xref, settings)
        .join(entity, "entity_id", "left")
        .join(person, ["entity_id", "contact_id"], "left")
        .selectExpr(
            "contact_code", "contact_type", "entity_id", "contact_id", f"{found('_entity')} AS entity_in_registry",
            "entity_out_of_business", "entity_deceased",
            f"if(contact_id IS NULL, 'N/A', {found('_person')}) AS contact_in_registry",
        )
        .orderBy(F.desc("entity_in_registry"), F.desc("contact_in_registry"), "contact_code")
    )


def quote_flow_customers(crm, account, contact, settings) -> DataFrame:
    """Active customers whose only entity id came from the quote flow."""
    return crm_contacts(
        crm.filter("comp_entity_id IS NOT NULL AND erp_entity_id IS NULL"), account, contact.filter(IS_ACTIVE), settings
    )


def match_layout(df: DataFrame) -> DataFrame:
    """The columns of the match upload; person fields of a business stay empty."""
    when = lambda test, x: f"CASE WHEN {test} THEN {x} END"
    not_business = "contact_type <> 'B'"
    layout = {
        "dbs_customer_number": "contact_code",
        "business_name": when(IS_FIRM, "company_name"),
        "doing_business_as": "doing_business_as",
        "prefix": when(not_business, "title"),
        "first_name": when(not_business, "first_name"),
        "familiar_name": when(not_business, "familiar_name"),
        "middle_name": when(not_business, "middle_name"),
        "last_name": when(not_business, "last_name"),
        "generation": when(not_business, "generation"),
        "suffix": when(not_business, "suffix"),
        "address_line_1": "street",
        "address_line_2": "street_2",
        "city": "city",
        "state_code": "state",
        "postal_code": "pcode",
        "country_code": f"coalesce({blank_to_null('country')}, 'US')",
        "email_address": "email",
        "work_phone": "biz_phone",
        "home_phone": "priv_phone",
        "mobile_phone": "mob_phone",
        "home_fax": when("contact_type = 'I'", "fax"),
        "work_fax": when(IS_FIRM, "fax"),
        "tax_type": "cast(NULL AS string)",
        "tax_id": "cast(NULL AS string)",
    }
    return df.selectExpr(*(f"{x} AS {name}" for name, x in layout.items()))


def path_b_extract(crm, account, contact, technician, salesperson, settings) -> DataFrame:
    people = quote_flow_customers(crm, account, contact, settings)
    return match_layout(without_employees(people, technician, salesperson)).orderBy("dbs_customer_number")


def writeback_status(crm, account, contact, xref, settings) -> DataFrame:
    """After an upload: did the link reach the contact record?"""
    people = crm_contacts(
        crm.filter("comp_entity_id IS NOT NULL"), account, contact.filter(IS_ACTIVE), settings
    ).selectExpr("*", f"{code_key('contact_code')} AS code_key")
    links = xref.selectExpr(
        f"{code_key('cross_ref_number')} AS code_key", "entity_id AS xref_entity_id", "contact_id AS xref_contact_id"
    )
    status = (
        "CASE WHEN xref_entity_id IS NULL THEN 'Not Linked' WHEN ckc_id IS NULL THEN 'Linked - not updated' "
        "WHEN ckc_id = xref_entity_id THEN 'Linked - matches' ELSE 'Linked - mismatch' END"
    )
    return matched_and_unmatched(people, links, "code_key").selectExpr(
        "contact_code", "contact_type", "ckc_id", "cmp_ckc_id", "xref_entity_id", "xref_contact_id",
        "comp_entity_id", "erp_entity_id", f"{status} AS writeback_status",
    ).orderBy("writeback_status", "contact_code")


def registry_status_check(crm, account, contact, technician, salesperson, profile, settings) -> DataFrame:
    """Customers whose entity is unknown, deceased or out of business."""
    people = without_employees(quote_flow_customers(crm, account, contact, settings), technician, salesperson)
    entity = entity_flags(profile, settings).selectExpr(
        "entity_id AS comp_entity_id", "out_of_business", "deceased", "true AS _known"
    )
    status = (
        "CASE WHEN _known IS NULL THEN 'NOT IN REGISTRY' WHEN deceased = 'Y' THEN 'DECEASED' "
        "WHEN out_of_business = 'Y' THEN 'OUT OF BUSINESS' END"
    )
    return (
        people.select("account_no", "contact_code", "comp_entity_id").join(entity, "comp_entity_id", "left")
        .selectExpr("account_no", "contact_code", "comp_entity_id AS crm_entity_id", "out_of_business", "deceased",
                    f"{status} AS registry_status")
        .filter("registry_status IS NOT NULL")
        .orderBy("registry_status", "contact_code")
    )


def per_code(unlinked: DataFrame, *more: str) -> DataFrame:
    """One row per contact code, with the revenue of all its accounts."""
    return unlinked.groupBy("contact_code", "contact_type").agg(
        *exprs("cast(sum(total_revenue) AS decimal(18,2)) AS total_revenue", *more)
    )


def upload_batches(unlinked: DataFrame, stage: Stage, file_rows: int = FILE_ROWS) -> DataFrame:
    """Unlinked contacts by revenue, cut into files of at most ``file_rows``."""
    return in_global_order(per_code(unlinked), ["total_revenue DESC", "contact_code"], stage).selectExpr(
        "contact_code", "contact_type", "total_revenue", "position AS upload_position",
        f"(position - 1) div {file_rows} + 1 AS batch_no",
    )


def upload_validation(upload: DataFrame) -> DataFrame:
    """Rows of a match upload that the receiving tool would refuse, by reason.

    A repeated code counts every row that has it; codes are counted, not gathered.
    """
    reasons = {
        "country_not_two_capitals": "NOT country_code RLIKE '^[A-Z]{2}$'",
        "state_not_two_capitals": "NOT state_code RLIKE '^[A-Z]{2}$'",
        "blank_in_code": "contains(dbs_customer_number, ' ')",
    }
    per_code = upload.groupBy(F.expr("upper(dbs_customer_number) AS code")).agg(
        *exprs("count(*) AS all_rows", *(f"count_if({test}) AS {name}" for name, test in reasons.items()))
    )
    one_row = per_code.selectExpr("*", "if(all_rows > 1, all_rows, 0) AS repeated_code").agg(
        *exprs(*(f"coalesce(sum({c}), 0) AS {c}" for c in ("all_rows", *reasons, "repeated_code")))
    )
    pairs = ", ".join(f"'{c}', {c}" for c in (*reasons, "repeated_code"))
    return one_row.selectExpr(
        f"stack({len(reasons) + 1}, {pairs}) AS (check_name, failed_rows)", "all_rows AS checked_rows"
    )


def match_type_alignment(tight_match: DataFrame, contact: DataFrame) -> DataFrame:
    """Contact type against the level of the returned match."""
    kinds = contact.groupBy(F.expr(f"{code_key('contact_code')} AS code_key"), "contact_type").agg(
        F.expr("count(*) AS contacts")
    )
    matches = tight_match.groupBy(*exprs(
        f"{code_key('dbs_number')} AS code_key", "if(coalesce(contact_id, '0') = '0', 'entity', 'contact') AS match_level"
    )).agg(F.expr("count(*) AS matches"))
    return matches.join(kinds, "code_key").groupBy("contact_type", "match_level").agg(
        F.expr("sum(contacts * matches) AS matches")
    ).selectExpr("*", "match_level = if(contact_type = 'C', 'contact', 'entity') AS aligned")


def contact_extract(unlinked: DataFrame, top: int, created_since: dt.date, with_account: bool = True, branch: str | None = None) -> DataFrame:
    """Top unlinked contacts by sales with the filters of the extract program.

    A contact is one row: with the number of its accounts that pass, the first
    of them and its branch, and their revenue.
    """
    chosen = unlinked.filter(f"creation_date >= {lit(created_since)}")
    if with_account:
        chosen = chosen.filter("account_no IS NOT NULL")
    if branch is not None:
        chosen = chosen.filter(f"branch = {lit(branch)}")
    return per_code(
        chosen, "count(account_no) AS accounts", "min(account_no) AS account_no", "min_by(branch, account_no) AS branch",
        "min(creation_date) AS creation_date",
    ).orderBy(F.desc("total_revenue"), "contact_code").limit(top)


def path_delete_extract(contact, xref, settings) -> DataFrame:
    """Codes whose link should go: inactive contacts that are still linked."""
    links = xref.filter(f"source_desc = {lit(settings.source)}").selectExpr(f"{code_key('cross_ref_number')} AS code_key")
    return (
        contact.filter("inactive_indicator = 'I'")
        .selectExpr("contact_code AS dbs_number", f"{code_key('contact_code')} AS code_key")
        .join(links, "code_key", "left_semi")
        .select("dbs_number")
        .distinct()
        .orderBy("dbs_number")
    )


def inactivation_candidates(enriched: DataFrame, last_activity: dt.date, created_before: dt.date, branch: str | None = None) -> DataFrame:
    """No activity after a date, created before a date or at an unknown time."""
    found = enriched.filter(
        f"last_tx_date <= {lit(last_activity)} AND (creation_date IS NULL OR creation_date < {lit(created_before)})"
    )
    if branch is not None:
        found = found.filter(f"branch = {lit(branch)}")
    return found.select("contact_code", "account_no", "branch", "creation_date", "last_tx_date").orderBy(
        "last_tx_date", "contact_code"
    )


def unlinked_recent_invoice(unlinked: DataFrame, invoice: DataFrame) -> DataFrame:
    """Unlinked contacts, newest invoice first."""
    newest = invoice.groupBy(F.col("bill_to_acc").alias("account_no")).agg(
        F.expr("max(cast(invo_datetime AS date)) AS last_invoice_date")
    )
    return unlinked.select("contact_code", "contact_type", "account_no").join(newest, "account_no").select(
        "contact_code", "contact_type", "account_no", "last_invoice_date"
    ).orderBy(F.desc("last_invoice_date"), "contact_code")


def prospect_customer_pairs(crm: DataFrame, settings: Settings) -> DataFrame:
    """Prospects and customers that share an entity id, as members of that entity.

    Every prospect of an entity pairs with every customer of it. The pairs are
    given by their members, so the result grows with the rows, not their product.
    """
    prospect, customer = lit(settings.prospect_type), lit(settings.customer_type)
    members = crm.selectExpr(
        f"CASE record_type WHEN {prospect} THEN comp_entity_id WHEN {customer} THEN erp_entity_id END AS entity_id",
        "record_type", "crm_id",
    ).filter("entity_id IS NOT NULL")
    both = members.groupBy("entity_id").agg(*exprs(
        f"count_if(record_type = {prospect}) AS prospects", f"count_if(record_type = {customer}) AS customers"
    )).filter("prospects > 0 AND customers > 0")
    return members.join(both, "entity_id").select("entity_id", "record_type", "crm_id", "prospects", "customers")
