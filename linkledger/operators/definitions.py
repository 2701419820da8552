"""What each metric counts, in words: numerator and denominator."""

from __future__ import annotations

# Who counts in the denominator, by scope of a rule.
SCOPE_TEXTS = {
    "all": "all active contacts", "person": "individuals and business contacts",
    "company": "businesses and business contacts", "us_zip": "contacts with a zip code and no foreign country",
    "has_street": "contacts with a street", "has_city": "contacts with a city", "has_state": "contacts with a state",
    "has_country": "contacts with a country", "has_email": "contacts with a mail address",
    "has_branch": "contacts with a branch", "has_biz_phone": "contacts with a business phone",
    "has_priv_phone": "contacts with a private phone", "has_mob_phone": "contacts with a mobile phone",
    "person_generation": "persons with a generation", "person_title": "persons with a title",
    "person_suffix": "persons with a suffix",
}

# Who counts in the numerator, by rule.
RULE_TEXTS = {
    "missing_first_name": "no first name", "missing_last_name": "no last name", "missing_company_name": "no company name",
    "missing_street": "no street", "missing_city": "no city", "missing_state": "no state", "missing_zip": "no zip code",
    "missing_country": "no country", "missing_email": "no mail address", "missing_all_phones": "none of the three phones",
    "no_contact_info": "neither a phone nor a mail address",
    "placeholder_name": "a first or last name that stands for no name",
    "placeholder_company_name": "a company name that stands for no name",
    "name_all_same_char": "a first or last name of one repeated character",
    "company_name_all_same_char": "a company name of one repeated character",
    "name_numeric_only": "a first or last name of digits", "company_name_numeric_only": "a company name of digits",
    "status_text_in_name": "a status remark in the first or last name",
    "status_text_in_company": "a status remark in the company name",
    "status_text_in_street": "a status remark in the street",
    "placeholder_street": "a street that stands for none", "placeholder_city": "a city that stands for none",
    "placeholder_state": "a state that stands for none",
    "dba_in_company_name": "a trading name inside the company name", "test_record": "a name of a test record",
    "contact_type_field_mismatch": "names that belong to another contact type",
    "prefix_in_name": "a form of address in the first name", "suffix_in_surname": "a suffix in the last name",
    "combined_names_in_name": "two persons in the first name",
    "familiar_name_pattern": "a familiar name in brackets in the first name",
    "email_invalid_format": "a mail address without the shape of one",
    "email_placeholder": "a mail address that stands for none",
    "email_internal_domain": "a mail address of the own staff", "email_missing_at": "a mail address without at-sign",
    "state_not_2char": "a state not written with two letters",
    "country_not_2char": "a country not written with two letters",
    "country_written_out": "a country written out", "state_written_out": "a state written out",
    "zip_invalid_format": "a zip code not in the form of the country",
    "generation_unrecognized": "a generation not on the list", "title_unrecognized": "a title not on the list",
    "suffix_unrecognized": "a suffix not on the list", "invalid_branch": "a branch that is closed",
    "contact_code_has_whitespace": "white space in the code",
    "contact_code_non_alphanumeric": "other than letters and digits in the code",
    "contact_code_duplicate_normalized": "a code that occurs again without regard to case and blanks",
    "street_routing_text": "routing text in front of the street",
}
_PHONE_TEXTS = {
    "sequential": "the digits in sequence", "repeated_digit": "one digit ten times",
    "wrong_length": "neither ten nor eleven digits", "nanp_invalid": "a number that the numbering plan does not know",
    "allzeros": "zeros only", "leading_zero": "a zero in front",
}
_PHONES = {"biz_phone": "business phone", "priv_phone": "private phone", "mob_phone": "mobile phone"}

LINKAGE_TEXTS = {
    "linked_count": ("links of contacts, a contact once per link", "links and unlinked contacts"),
    "unlinked_count": ("contacts without a link", "links and unlinked contacts"),
    "ckc_id_no_cross_ref": ("contacts with an entity id but no link", "links and unlinked contacts that have an entity id"),
    "type_mismatch_linkage": ("links whose level does not suit the contact type", "links of contacts"),
    "duplicate_entity_id": ("entities that several contacts are linked to", "entities that contacts are linked to"),
    "orphan_cross_ref": ("links whose code no active contact has", "links of the source"),
}
PRIORITY_TEXTS = {
    "phys_addr_certified_mismatch": (
        "linked contacts whose address differs from a certified one", "linked contacts whose registry address is certified"),
    "address_confirmed_undeliverable": (
        "linked contacts whose physical or mail address is known as undeliverable", "linked contacts"),
    "registry_oob_equip_active": ("active businesses that the registry knows as closed", "linked businesses"),
    "registry_deceased_equip_active": (
        "active persons that the registry knows as deceased", "linked individuals and business contacts"),
    "equip_inactive_reason_mismatch": (
        "inactive contacts whose reason the registry does not confirm", "linked inactive contacts"),
}
TIER_TEXTS = {
    "tier_1_strong": "unlinked contacts with a name and a street with zip code, or with city and state",
    "tier_2_partial": "unlinked contacts with a name and some address, phone or mail",
    "tier_3_name_only": "unlinked contacts with a name and nothing else",
    "tier_4_no_name": "unlinked contacts without the name that their type needs",
}


def ratio(numerator: str, denominator: str) -> str:
    return f"Numerator: {numerator}. Denominator: {denominator}."


def rule_definition(name: str, scope: str) -> str:
    phone = next((p for p in _PHONES if name.startswith(f"{p}_")), None)
    if phone:
        what = f"a {_PHONES[phone]} with {_PHONE_TEXTS[name[len(phone) + 1:]]}"
    else:
        what = RULE_TEXTS[name]
    return ratio(f"of these, contacts with {what}", SCOPE_TEXTS[scope])
