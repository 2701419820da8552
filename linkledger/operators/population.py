"""The contact populations every section starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkledger.config import SLICE, Settings
from linkledger.functions.columns import (
    IS_ACTIVE, blank_to_null, cleaned, code_key, creation_cohort, lit, staleness_bucket, valid_entity,
)
from linkledger.operators.revenue import DECILE_LABEL
from linkledger.operators.rules import judged

TEXT_FIELDS = (
    "first_name", "last_name", "company_name", "email", "biz_phone", "priv_phone", "mob_phone",
    "street", "city", "state", "pcode", "country", "title", "generation", "suffix",
)
COMPARED_FIELDS = TEXT_FIELDS[:12]  # up to country
REGISTRY_FIELDS = (
    "reg_company_name", "reg_first_name", "reg_last_name", "reg_email", "reg_biz_area",
    "reg_biz_num", "reg_priv_area", "reg_priv_num", "reg_mob_area", "reg_mob_num",
    "reg_street", "reg_city", "reg_state", "reg_pcode", "reg_country",
)
REGISTRY_FLAGS = (
    "postal_certified", "phys_undeliverable", "mail_undeliverable", "out_of_business", "deceased",
)

#: Parts that contacts without account are dealt to.
SALTS = 4096

CONTACT_LEVEL = "coalesce(contact_id, 0) <> 0"


def employee_keys(technician: DataFrame, salesperson: DataFrame) -> DataFrame:
    """Codes in either employee table, terminated or not."""
    codes = technician.select("code").unionByName(salesperson.select("code"))
    return codes.withColumnRenamed("code", "contact_code")


def without_employees(contact: DataFrame, technician: DataFrame, salesperson: DataFrame) -> DataFrame:
    return contact.join(employee_keys(technician, salesperson), "contact_code", "left_anti")


def customers_and_leads(contact, technician, salesperson, account, vendor) -> DataFrame:
    """Contacts with their account, without employees and vendor-only contacts.

    All joins use the contact code, so contacts are laid out by it once. A code
    that owns very many accounts meets them in an inner join, which Spark can
    split; the vendor rule concerns contacts without account only.
    """
    people = without_employees(contact, technician, salesperson)
    accounts = account.selectExpr(*(c for c in account.columns if c != "branch"), *cleaned(["branch"]))
    alone = people.join(accounts.select("contact_code"), "contact_code", "left_anti").join(
        vendor.select("contact_code"), "contact_code", "left_anti"
    )
    return people.join(accounts, "contact_code").unionByName(alone, allowMissingColumns=True)


def active_with_account(contact, technician, salesperson, account) -> DataFrame:
    """Active contacts with their account; vendors stay in."""
    people = without_employees(contact.filter(IS_ACTIVE), technician, salesperson)
    return matched_and_unmatched(people, account.select("contact_code", "account_no"), "contact_code")


CONTACT_COLUMNS = ("contact_code", "contact_type", "ckc_id", "cmp_ckc_id", "creation_date")


def active_contacts(contact, technician, salesperson, account, vendor) -> DataFrame:
    # Texts are cleaned once per contact, before its accounts multiply it.
    people = contact.filter(IS_ACTIVE).selectExpr(*CONTACT_COLUMNS, *cleaned(TEXT_FIELDS))
    return customers_and_leads(
        people, technician, salesperson, account.select("contact_code", "account_no", "branch"), vendor
    ).select(*CONTACT_COLUMNS, *TEXT_FIELDS, "account_no", "branch")


def active_base(contact, technician, salesperson, account, vendor, links: DataFrame, settings: Settings) -> DataFrame:
    """Active contacts with their account, link counts, repeated-code flag and the outcomes of all rules: all that no
    date changes."""
    rows = active_contacts(contact, technician, salesperson, account, vendor).selectExpr(
        "*", f"{code_key('contact_code')} AS code_key")
    return judged(with_repeat_flag(with_link_counts(rows, links)), settings)


def contact_enriched(base: DataFrame, ranked: DataFrame, settings: Settings) -> DataFrame:
    """The contacts with staleness, decile and cohort; ``ranked`` has one row per account."""
    staleness = staleness_bucket("account_no", "last_tx_date", settings.as_of, settings.staleness_step)
    # Contacts without account meet nothing, but one outer join keeps them; salt spreads them, as their missing number
    # would be a hot key.
    salted = base.selectExpr(
        "*", "coalesce(account_no, 0) AS _account",
        f"CASE WHEN account_no IS NULL THEN 1 + pmod(xxhash64(contact_code), {SALTS}) ELSE 0 END AS _salt")
    accounts = ranked.filter("account_no IS NOT NULL").withColumnRenamed("account_no", "_account").withColumn(
        "_salt", F.lit(0).cast("bigint"))
    rows = salted.join(accounts, ["_account", "_salt"], "left")
    return rows.selectExpr(
        *base.columns,
        "cast(coalesce(total_revenue, 0) AS decimal(18,2)) AS total_revenue",
        "last_tx_date",
        f"{staleness} AS staleness_bucket",
        f"{DECILE_LABEL} AS sales_decile",
        f"{creation_cohort('creation_date', settings.cohorts)} AS creation_cohort",
    )


def source_links(xref: DataFrame, settings: Settings) -> DataFrame:
    """Cross references of the chosen source to a real entity."""
    return xref.filter(
        f"{valid_entity('entity_id', settings.sentinel_entity)} AND source_desc = {lit(settings.source)}"
    ).selectExpr("entity_id", "contact_id", "cross_ref_number", f"{code_key('cross_ref_number')} AS code_key")


def links_per_code(links: DataFrame) -> DataFrame:
    """Link counts per code: one row per key, so joining it never multiplies contacts."""
    return links.groupBy("code_key").agg(
        F.expr("count(*) AS links"), F.expr(f"count_if({CONTACT_LEVEL}) AS contact_level_links")
    )


def with_link_counts(enriched: DataFrame, links: DataFrame) -> DataFrame:
    return enriched.join(links_per_code(links), "code_key", "left").selectExpr(
        *enriched.columns, "coalesce(links, 0) AS links", "coalesce(contact_level_links, 0) AS contact_level_links"
    )


def unlinked_contacts(enriched: DataFrame, links: DataFrame) -> DataFrame:
    return enriched.join(links.select("code_key").distinct(), "code_key", "left_anti")


def matched_and_unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A left outer join as inner rows plus left-only rows.

    Spark can split a hot key on either side of an inner join, but not on the
    inner side of an outer join, where one task would read all of its rows.
    """
    unmatched = left.join(right.select(key).distinct(), key, "left_anti")
    return left.join(right, key).unionByName(unmatched, allowMissingColumns=True)


def contact_linkage(enriched: DataFrame, links: DataFrame) -> DataFrame:
    """One row per contact and link, unlinked contacts once."""
    return matched_and_unmatched(enriched, links, "code_key").selectExpr(
        "contact_code", "contact_type", "ckc_id", *SLICE[1:], "entity_id", "contact_id",
        "cast(cross_ref_number IS NOT NULL AS int) AS is_linked",
    )


def registry_profiles(profile: DataFrame, settings: Settings) -> DataFrame:
    """Registry rows of the chosen source, blanks cleaned; filtered first, as other sources fan out."""
    return profile.filter(f"source_desc = {lit(settings.source)}").selectExpr(
        "entity_id", "contact_id", *cleaned(REGISTRY_FIELDS), *REGISTRY_FLAGS
    )


def active_linked(enriched: DataFrame, links: DataFrame, profiles: DataFrame, us_default: bool = False) -> DataFrame:
    """Linked contacts with both systems' values side by side."""
    country = "coalesce(country, 'US') AS country" if us_default else "country"
    return (
        enriched.join(links.drop("cross_ref_number"), "code_key")
        .join(profiles, ["entity_id", "contact_id"])
        .selectExpr(
            "contact_code", "creation_date", *SLICE, "entity_id", "contact_id", *COMPARED_FIELDS[:-1], country,
            *REGISTRY_FIELDS, *REGISTRY_FLAGS,
        )
    )


def inactive_linked(contact, technician, salesperson, account, vendor, links, profiles, settings) -> DataFrame:
    """Inactive contacts that are still linked."""
    inactive = customers_and_leads(
        contact.filter("inactive_indicator = 'I'"), technician, salesperson,
        account.select("contact_code", "account_no", "branch"), vendor,
    )
    return (
        inactive.selectExpr("*", f"{code_key('contact_code')} AS code_key")
        .join(links.drop("cross_ref_number"), "code_key")
        .join(profiles.select("entity_id", "contact_id", "out_of_business", "deceased"), ["entity_id", "contact_id"])
        .selectExpr(
            "contact_code", "contact_type", f"{blank_to_null('inactive_reason')} AS inactive_reason",
            "out_of_business", "deceased", "'Inactive' AS sales_decile", "'Inactive' AS staleness_bucket", "branch",
            f"{creation_cohort('creation_date', settings.cohorts)} AS creation_cohort",
        )
    )


def linked_counts(linked: DataFrame) -> DataFrame:
    return linked.groupBy(*SLICE).agg(
        F.expr("count(*) AS total_linked"), F.expr("count_if(postal_certified = 'CERTIFIED') AS certified_linked")
    )


NORMAL_CODE = "upper(trim(contact_code))"


def dup_codes(enriched: DataFrame) -> DataFrame:
    """Normalized codes that occur more than once."""
    return (
        enriched.groupBy(F.expr(f"{NORMAL_CODE} AS norm_code"))
        .agg(F.expr("count(*) AS n"))
        .filter("n > 1")
        .select("norm_code")
    )


def with_repeat_flag(enriched: DataFrame) -> DataFrame:
    """Flag contacts whose normalized code repeats, unless they are flagged; joins one row per repeated code."""
    if "code_repeats" in enriched.columns:
        return enriched
    repeated = dup_codes(enriched).selectExpr("norm_code", "true AS _repeats")
    return (
        enriched.selectExpr("*", f"{NORMAL_CODE} AS norm_code")
        .join(repeated, "norm_code", "left")
        .selectExpr(*enriched.columns, "coalesce(_repeats, false) AS code_repeats")
    )
