"""Field by field comparison of a contact with its registry record."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from linkledger.config import SLICE
from linkledger.functions import lists
from linkledger.functions.columns import either, lit, parity, phone_parity, sure, values
from linkledger.operators.flags import Check


@dataclass(frozen=True)
class Field:
    name: str
    types: tuple[str, ...]
    outcome: str

    @property
    def label(self) -> str:
        return " ".join(w.capitalize() for w in self.name.split("_"))

    @property
    def scope(self) -> str:
        return f"contact_type IN {values(self.types)}"


def _phone(left: str, stem: str) -> str:
    return phone_parity(left, f"{stem}_area", f"{stem}_num")


def _zip() -> str:
    """Five characters decide in the US, the whole code elsewhere."""
    cut = lambda x: f"if(coalesce(country, 'US') = 'US', substring({x}, 1, 5), {x})"
    return parity(cut("pcode"), cut("reg_pcode"))


_ALL = ("B", "C", "I")
FIELDS = (
    Field("company_name", ("B", "C"), parity("company_name", "reg_company_name")),
    Field("first_name", ("I", "C"), parity("first_name", "reg_first_name")),
    Field("last_name", ("I", "C"), parity("last_name", "reg_last_name")),
    Field("email", _ALL, parity("email", "reg_email")),
    Field("business_phone", _ALL, _phone("biz_phone", "reg_biz")),
    Field("private_phone", _ALL, _phone("priv_phone", "reg_priv")),
    Field("mobile_phone", _ALL, _phone("mob_phone", "reg_mob")),
    Field("street", _ALL, parity("street", "reg_street")),
    Field("city", _ALL, parity("city", "reg_city")),
    Field("state", _ALL, parity("state", "reg_state")),
    Field("zip", _ALL, _zip()),
    Field("country", _ALL, parity("country", "reg_country")),
)


def field_parity(linked: DataFrame) -> DataFrame:
    """One row per linked contact, field in scope and outcome, from one scan."""
    pairs = ", ".join(
        f"CASE WHEN {f.scope} THEN named_struct('field_name', {lit(f.name)}, 'parity_result', {f.outcome}) END" for f in FIELDS
    )
    return linked.selectExpr("contact_code", *SLICE, f"inline(array_compact(array({pairs})))")


_ADDRESS_DIFFERS = either(*(
    f"upper(coalesce({name}, '')) <> upper(coalesce(reg_{name}, ''))" for name in ("street", "city", "state", "pcode")
))

# Priority metric -> (scope, issue) over linked contacts.
PRIORITIES = {
    "phys_addr_certified_mismatch": (sure("postal_certified = 'CERTIFIED'"), _ADDRESS_DIFFERS),
    "address_confirmed_undeliverable": ("true", sure("phys_undeliverable = 'Y'") + " OR " + sure("mail_undeliverable = 'Y'")),
    "registry_oob_equip_active": ("contact_type = 'B'", "out_of_business = 'Y'"),
    "registry_deceased_equip_active": ("contact_type IN ('I', 'C')", "deceased = 'Y'"),
}
INACTIVE_REASON = "equip_inactive_reason_mismatch"
PRIORITY = (*PRIORITIES, INACTIVE_REASON)

_OUTCOMES = len(lists.PARITY_OUTCOMES)
#: Fields in a word of outcomes. As with rules, a projection judges one word.
WORD_FIELDS = 4


def checks(names: Iterable[str] | None = None) -> list[Check]:
    """Where ``judged`` keeps outcomes: a bit per outcome of a field, and two per further check, in scope and failed.
    Only the fields and checks in ``names``, if any are given."""
    found = []
    for k, f in enumerate(FIELDS):
        if names is None or f.name in names:
            word, first = f"outcomes_{k // WORD_FIELDS}", _OUTCOMES * (k % WORD_FIELDS)
            mask = ((1 << _OUTCOMES) - 1) << first
            found += [Check(f"{f.name}_{o}", word, first + i, mask) for i, o in enumerate(lists.PARITY_OUTCOMES)]
    return found + [Check(m, "priorities", 2 * k + 1, 1 << 2 * k)
                    for k, m in enumerate(PRIORITIES) if names is None or m in names]


def judged(linked: DataFrame) -> DataFrame:
    """Linked contacts with the words of ``checks``, and ``compared``, the number of fields in scope."""
    columns, out, compared = list(linked.columns), linked, "0"
    for at in range(0, len(FIELDS), WORD_FIELDS):
        name = f"outcomes_{at // WORD_FIELDS}"
        bits = []
        for k, f in enumerate(FIELDS[at: at + WORD_FIELDS]):
            bit = f.outcome
            for i, o in enumerate(lists.PARITY_OUTCOMES):
                bit = bit.replace(lit(o), f"{1 << _OUTCOMES * k + i}L")
            bits.append(f"CASE WHEN {f.scope} THEN {bit} ELSE 0L END")
        out = out.selectExpr(*columns, f"{' + '.join(bits)} AS {name}", f"{compared} AS compared")
        columns, compared = [*columns, name], f"compared + cast(bit_count({name}) AS int)"
    further = (
        f"CASE WHEN NOT {sure(scope)} THEN 0L WHEN {sure(issue)} THEN {3 << 2 * k}L ELSE {1 << 2 * k}L END"
        for k, (scope, issue) in enumerate(PRIORITIES.values()))
    return out.selectExpr(*columns, f"{' + '.join(further)} AS priorities", f"{compared} AS compared")


# The inactive reason claims what the registry does not confirm.
REASON_CONFLICT = sure(either(
    "inactive_reason = 'Out of Business' AND coalesce(out_of_business, 'N') <> 'Y'",
    "inactive_reason = 'Deceased' AND coalesce(deceased, 'N') <> 'Y'",
))
