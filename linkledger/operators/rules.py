"""The rule registry: every completeness and field quality check, written once.

A rule has a scope (who counts in the denominator) and an issue condition (who
counts in the numerator). Snapshot counts, the issue map and the metric
dimension are all read from here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from linkledger.config import Settings
from linkledger.functions import lists
from linkledger.functions.columns import (
    IS_FIRM, IS_PERSON, both, either, holds_any, is_one_of, lit, matches, sure, values,
)
from linkledger.operators.flags import Check

PHONES = ("biz_phone", "priv_phone", "mob_phone")
NAMES = ("first_name", "last_name")

# Conditions that put a contact into a denominator.
SCOPES: dict[str, str] = {
    "all": "true",
    "person": IS_PERSON,
    "company": IS_FIRM,
    "us_zip": "pcode IS NOT NULL AND coalesce(country, 'US') = 'US'",
    **{f"has_{f}": f"{f} IS NOT NULL" for f in ("street", "city", "state", "country", "email", "branch", *PHONES)},
    **{f"person_{f}": f"{IS_PERSON} AND {f} IS NOT NULL" for f in ("generation", "title", "suffix")},
}


@dataclass(frozen=True)
class Rule:
    name: str
    category: str
    scope: str                       # key of SCOPES
    issue: str                       # condition over the enriched contact
    in_snapshot: bool = True         # else only in the standalone section

    @property
    def failed(self) -> str:
        return sure(both(SCOPES[self.scope], self.issue))


def _missing(*fields: str) -> str:
    return f"coalesce({', '.join(fields)}) IS NULL" if len(fields) > 1 else f"{fields[0]} IS NULL"


def completeness_rules() -> list[Rule]:
    fields = {
        "missing_first_name": ("person", ("first_name",)),
        "missing_last_name": ("person", ("last_name",)),
        "missing_company_name": ("company", ("company_name",)),
        "missing_street": ("all", ("street",)),
        "missing_city": ("all", ("city",)),
        "missing_state": ("all", ("state",)),
        "missing_zip": ("all", ("pcode",)),
        "missing_country": ("all", ("country",)),
        "missing_email": ("all", ("email",)),
        "missing_all_phones": ("all", PHONES),
        "no_contact_info": ("all", (*PHONES, "email")),
    }
    return [Rule(n, "completeness", scope, _missing(*cols)) for n, (scope, cols) in fields.items()]


def _any_field(test, *fields: str) -> str:
    """True when the test holds for any of the fields; an empty field never fires."""
    return either(*(sure(test(f)) for f in fields))


def _one_character(field: str) -> str:
    return matches(field, lists.ONE_CHARACTER)


def _digits(field: str) -> str:
    return matches(field, lists.DIGITS)


def _unknown(field: str, known: tuple[str, ...]) -> str:
    return f"upper(trim({field})) NOT IN {values(known)}"


def _quality(name: str, scope: str, issue: str, in_snapshot: bool = True) -> Rule:
    return Rule(name, "field_quality", scope, issue, in_snapshot)


def _phone_rules(phone: str) -> list[Rule]:
    scope = f"has_{phone}"
    return [
        _quality(f"{phone}_sequential", scope, f"{phone} = {lit(lists.SEQUENTIAL_PHONE)}"),
        _quality(f"{phone}_repeated_digit", scope, f"length({phone}) = 10 AND {_one_character(phone)}"),
        _quality(f"{phone}_wrong_length", scope, f"length({phone}) NOT IN (10, 11)"),
        _quality(f"{phone}_nanp_invalid", scope, f"NOT {matches(phone, lists.NORTH_AMERICAN_PHONE)}"),
        _quality(f"{phone}_allzeros", scope, f"{phone} = {lit(lists.ALL_ZERO_PHONE)}", False),
        _quality(f"{phone}_leading_zero", scope, f"startswith({phone}, '0')", False),
    ]


def _alternatives(items) -> str:
    return "(" + "|".join(i.replace(".", r"\.") for i in items) + ")"


NEEDS_REPEAT_FLAG = "contact_code_duplicate_normalized"


def field_quality_rules(settings: Settings) -> list[Rule]:
    named = "coalesce(first_name, last_name) IS NOT NULL"
    type_mismatch = either(
        f"contact_type = 'B' AND {named} AND company_name IS NULL",
        f"{IS_PERSON} AND company_name IS NOT NULL AND NOT ({named})",
    )
    placeholder_name = either(
        sure(is_one_of("first_name", lists.FIRST_NAME_PLACEHOLDERS)),
        sure(is_one_of("last_name", lists.LAST_NAME_PLACEHOLDERS)),
    )
    name_status = _any_field(lambda f: holds_any(f, lists.NAME_STATUS_WORDS), *NAMES)
    test_name = _any_field(lambda f: is_one_of(f, lists.TEST_NAMES), *NAMES, "company_name")
    return [
        _quality("placeholder_name", "person", placeholder_name),
        _quality("placeholder_company_name", "company", is_one_of("company_name", lists.COMPANY_PLACEHOLDERS)),
        _quality("name_all_same_char", "person", _any_field(_one_character, *NAMES)),
        _quality("company_name_all_same_char", "company", _one_character("company_name")),
        _quality("name_numeric_only", "person", _any_field(_digits, *NAMES)),
        _quality("company_name_numeric_only", "company", _digits("company_name")),
        _quality("status_text_in_name", "person", name_status),
        _quality("status_text_in_company", "company", holds_any("company_name", lists.COMPANY_STATUS_WORDS)),
        _quality("status_text_in_street", "all", holds_any("street", lists.STREET_STATUS_WORDS)),
        _quality("placeholder_street", "has_street", is_one_of("street", lists.STREET_PLACEHOLDERS)),
        _quality("placeholder_city", "has_city", is_one_of("city", lists.CITY_PLACEHOLDERS)),
        _quality("placeholder_state", "has_state", is_one_of("state", lists.STATE_PLACEHOLDERS)),
        _quality("dba_in_company_name", "company", holds_any("company_name", lists.DBA_MARKS)),
        _quality("test_record", "all", test_name),
        _quality("contact_type_field_mismatch", "all", type_mismatch),
        _quality("prefix_in_name", "person", matches("upper(first_name)", f"^{_alternatives(lists.NAME_PREFIXES)}[. ]")),
        _quality("suffix_in_surname", "person", matches("upper(last_name)", f" {_alternatives(lists.NAME_SUFFIXES)}$")),
        _quality("combined_names_in_name", "person", matches("upper(first_name)", "&|/| AND | OR ")),
        _quality("familiar_name_pattern", "person", "contains(first_name, '(')"),
        _quality("email_invalid_format", "all", f"NOT {matches('email', lists.EMAIL_SHAPE)}"),
        _quality("email_placeholder", "has_email",
                 matches("lower(email)", f"^{_alternatives(lists.EMAIL_PLACEHOLDER_STARTS)}")),
        *(rule for phone in PHONES for rule in _phone_rules(phone)),
        _quality("state_not_2char", "has_state", "length(state) <> 2"),
        _quality("country_not_2char", "has_country", "length(country) <> 2"),
        _quality("zip_invalid_format", "us_zip", f"NOT {matches('pcode', lists.US_ZIP)}"),
        _quality("generation_unrecognized", "person_generation", _unknown("generation", lists.GENERATIONS)),
        _quality("title_unrecognized", "person_title", _unknown("title", lists.TITLES)),
        _quality("suffix_unrecognized", "person_suffix", _unknown("suffix", lists.SUFFIXES)),
        _quality("invalid_branch", "has_branch", f"branch IN {values(settings.closed_branches)}" if settings.closed_branches else "false"),
        _quality("contact_code_has_whitespace", "all", matches("contact_code", lists.CODE_WHITESPACE)),
        _quality("contact_code_non_alphanumeric", "all", matches("contact_code", lists.CODE_OTHER_CHARACTER)),
        _quality(NEEDS_REPEAT_FLAG, "all", "code_repeats"),
        _quality("email_internal_domain", "has_email",
                 matches("lower(email)", f"@{_alternatives(settings.internal_domains)}$")
                 if settings.internal_domains else "false", False),
        _quality("email_missing_at", "has_email", "NOT contains(email, '@')", False),
        _quality("country_written_out", "has_country", is_one_of("trim(country)", lists.COUNTRY_NAMES), False),
        _quality("state_written_out", "has_state", is_one_of("trim(state)", lists.STATE_NAMES), False),
        _quality("street_routing_text", "has_street", matches("upper(street)", lists.STREET_ROUTING), False),
    ]


def all_rules(settings: Settings, standalone: bool = False) -> list[Rule]:
    found = completeness_rules() + field_quality_rules(settings)
    return found if standalone else [r for r in found if r.in_snapshot]


# Judged once, kept as bits

#: Rules in a word. A projection judges one word, so its generated method stays small enough to be compiled.
WORD_RULES = 16


def _words(rules: list[Rule]) -> list[list[Rule]]:
    return [rules[i: i + WORD_RULES] for i in range(0, len(rules), WORD_RULES)]


def word_columns(settings: Settings) -> list[str]:
    return [f"rules_{k}" for k in range(len(_words(all_rules(settings, standalone=True))))]


def checks(settings: Settings, rules: list[Rule]) -> list[Check]:
    """Where the outcomes of ``rules`` are: two bits each, in scope and failed."""
    place = {
        r.name: (f"rules_{k}", 2 * i)
        for k, word in enumerate(_words(all_rules(settings, standalone=True))) for i, r in enumerate(word)}
    return [Check(r.name, place[r.name][0], place[r.name][1] + 1, 1 << place[r.name][1]) for r in rules]


#: The failed bits of a word.
_FAILED = sum(2 << 2 * i for i in range(WORD_RULES))


def judged(contacts: DataFrame, settings: Settings) -> DataFrame:
    """The contacts with the outcomes of all rules, and ``flags``, the number of rules that a contact fails.

    Each word is a projection of its own. The next one reads it twice, so Spark does not merge the two: all rules in
    one generated method would be too much for the compiler."""
    columns = list(contacts.columns)
    out, flags = contacts, "0"
    for name, word in zip(word_columns(settings), _words(all_rules(settings, standalone=True))):
        bits = " + ".join(
            f"CASE WHEN NOT {sure(SCOPES[r.scope])} THEN 0L WHEN {sure(r.issue)} THEN {3 << 2 * i}L ELSE {1 << 2 * i}L END"
            for i, r in enumerate(word))
        out = out.selectExpr(*columns, f"{bits} AS {name}", f"{flags} AS flags")
        columns, flags = [*columns, name], f"flags + cast(bit_count({name} & {_FAILED}L) AS int)"
    return out.selectExpr(*columns, f"{flags} AS flags")
