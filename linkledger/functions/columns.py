"""SQL expressions shared by all operators.

Helpers take and return expression text for ``selectExpr``, ``filter`` and
``F.expr``: one parsed text instead of many calls to the JVM per column. No
UDFs; everything stays in generated code.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from linkledger.functions import lists


def lit(value) -> str:
    """A Python value as SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def values(items: Iterable) -> str:
    return "(" + ", ".join(lit(i) for i in items) + ")"


def both(*tests: str) -> str:
    return " AND ".join(f"({t})" for t in tests)


def either(*tests: str) -> str:
    return "(" + " OR ".join(f"({t})" for t in tests) + ")"


def sure(test: str) -> str:
    """A condition whose null counts as false."""
    return f"coalesce({test}, false)"


def rank_of(x: str, order: Iterable[str]) -> str:
    """Place of a value in a fixed order, from 0; what is not in it comes last."""
    steps = " ".join(f"WHEN {lit(v)} THEN {i}" for i, v in enumerate(order))
    return f"CASE {x} {steps} ELSE {len(tuple(order))} END"


def blank_to_null(x: str) -> str:
    return f"nullif(trim({x}), '')"


def cleaned(names: Iterable[str]) -> list[str]:
    return [f"{blank_to_null(n)} AS {n}" for n in names]


def code_key(x: str, case_sensitive: bool = False) -> str:
    """Join key of a contact code: upper case, trailing blanks dropped."""
    return f"rtrim({x})" if case_sensitive else f"upper(rtrim({x}))"


IS_ACTIVE = "coalesce(inactive_indicator, 'A') <> 'I'"
IS_PERSON = "contact_type IN ('I', 'C')"
IS_FIRM = "contact_type IN ('B', 'C')"


def valid_entity(x: str, sentinel: int) -> str:
    return f"{x} IS NOT NULL AND {x} <> {sentinel}"


def money(x: str) -> str:
    """Amount as exact decimal, null counted as zero."""
    return f"coalesce(cast({x} AS decimal(12,2)), 0)"


def total(x: str) -> str:
    return f"cast(sum({x}) AS decimal(18,2))"


def is_one_of(x: str, items: Iterable[str]) -> str:
    return f"upper({x}) IN {values(items)}"


def matches(x: str, pattern: str) -> str:
    return f"{x} RLIKE {lit(pattern)}"


def holds_any(x: str, words: Iterable[str]) -> str:
    """True when the upper-cased text holds any of the words."""
    return matches(f"upper({x})", "|".join(words))


def parity(left: str, right: str) -> str:
    """Compare two texts without regard to case."""
    return _outcome(left, f"{right} IS NULL", f"upper({left}) = upper({right})")


def phone_parity(phone: str, area: str, number: str) -> str:
    """Compare a phone with one stored as area code and number."""
    return _outcome(
        phone, f"coalesce({area}, {number}) IS NULL", f"{phone} = concat(coalesce({area}, ''), coalesce({number}, ''))"
    )


def _outcome(left: str, right_missing: str, same: str) -> str:
    return (
        f"CASE WHEN {left} IS NULL THEN if({right_missing}, 'both_null', 'registry_only') "
        f"WHEN {right_missing} THEN 'equip_only' WHEN {same} THEN 'match' ELSE 'mismatch' END"
    )


# Cohorts: (label, last year included); the final label is open ended.
COHORTS = {
    "current": (("Pre-2015", 2015), ("2016-2020", 2020), ("2021-2025", 2025), ("2026+", None)),
    "older": (("Pre-2015", 2014), ("2015-2020", 2019), ("2020-2025", 2024), ("2025+", None)),
}


def creation_cohort(created: str, cohorts: str = "current") -> str:
    steps = " ".join(
        f"ELSE '{label}'" if last is None else f"WHEN year({created}) <= {last} THEN '{label}'"
        for label, last in COHORTS[cohorts]
    )
    return f"CASE WHEN {created} IS NULL THEN 'Unknown' {steps} END"


def staleness_bucket(account: str, last_date: str, as_of: dt.date, step: str) -> str:
    def edge(years: int) -> str:
        return f"add_months({lit(as_of)}, {-12 * years})" if step == "calendar" else f"date_sub({lit(as_of)}, {365 * years})"

    none, never, *yearly, oldest = lists.STALENESS_BUCKETS
    steps = " ".join(f"WHEN {last_date} >= {edge(n)} THEN '{label}'" for n, label in enumerate(yearly, start=1))
    return (
        f"CASE WHEN {account} IS NULL THEN '{none}' WHEN {last_date} IS NULL THEN '{never}' {steps} ELSE '{oldest}' END"
    )


# How well an unlinked contact could be matched.
_STRONG, _PARTIAL, _NAME_ONLY, _NAMELESS = lists.MATCH_TIERS
MATCH_TIER = f"""CASE
    WHEN ({IS_PERSON} AND (first_name IS NULL OR last_name IS NULL)) OR (contact_type = 'B' AND company_name IS NULL)
        THEN '{_NAMELESS}'
    WHEN street IS NOT NULL AND (pcode IS NOT NULL OR (city IS NOT NULL AND state IS NOT NULL)) THEN '{_STRONG}'
    WHEN coalesce(street, city, state, pcode, biz_phone, priv_phone, mob_phone, email) IS NOT NULL THEN '{_PARTIAL}'
    ELSE '{_NAME_ONLY}' END"""
