"""The shared relations as DuckDB SQL, kept plain so they can be read as a specification."""

from __future__ import annotations

import datetime as dt
import re

from linkledger.sources.fixtures import DUCKDB, RELATIONS, select_text

AS_OF = dt.date(2001, 8, 15)
HISTORY = (dt.date(2001, 6, 15), dt.date(2001, 7, 15), AS_OF)
SLICE = "contact_type, sales_decile, staleness_bucket, branch, creation_cohort"

TEXT_FIELDS = [
    "first_name", "last_name", "company_name", "email", "biz_phone", "priv_phone", "mob_phone", "street", "city",
    "state", "pcode", "country", "title", "generation", "suffix",
]
REGISTRY_TEXT = [
    "reg_company_name", "reg_first_name", "reg_last_name", "reg_email", "reg_biz_area", "reg_biz_num",
    "reg_priv_area", "reg_priv_num", "reg_mob_area", "reg_mob_num", "reg_street", "reg_city", "reg_state",
    "reg_pcode", "reg_country",
]
FLAGS = ["postal_certified", "phys_undeliverable", "mail_undeliverable", "out_of_business", "deceased"]


def window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    first_of_month = as_of.replace(day=1)
    end = first_of_month - dt.timedelta(days=1)
    start_year = first_of_month.year - 5
    return dt.date(start_year, first_of_month.month, 1), end


def suffix(as_of: dt.date, cohorts: str = "current") -> str:
    return ("" if as_of == AS_OF else f"_{as_of:%Y%m%d}") + ("" if cohorts == "current" else "_older")


def clean(column: str, alias: str | None = None) -> str:
    return f"NULLIF(trim({column}), '') AS {alias or column.split('.')[-1]}"


COHORT = {
    "current": "CASE WHEN {d} IS NULL THEN 'Unknown' WHEN year({d}) < 2016 THEN 'Pre-2015' WHEN year({d}) <= 2020 "
               "THEN '2016-2020' WHEN year({d}) <= 2025 THEN '2021-2025' ELSE '2026+' END",
    "older": "CASE WHEN {d} IS NULL THEN 'Unknown' WHEN year({d}) < 2015 THEN 'Pre-2015' WHEN year({d}) < 2020 "
             "THEN '2015-2020' WHEN year({d}) < 2025 THEN '2020-2025' ELSE '2025+' END",
}


CODES = {
    "contact": "contact_code", "account": "contact_code", "vendor": "contact_code", "technician": "code",
    "salesperson": "code", "xref": "cross_ref_number", "unit_sale": "owner_code", "tight_match": "dbs_number",
}


def undated() -> dict[str, str]:
    found = {name: select_text(name, DUCKDB) for name in RELATIONS}
    for name, code in CODES.items():  # padding of fixed-width codes means nothing
        found[name] = f"SELECT * REPLACE (rtrim({code}) AS {code}) FROM ({found[name]})"
    found["employees"] = "SELECT code FROM technician UNION SELECT code FROM salesperson"
    found["links"] = (
        "SELECT * FROM xref WHERE source_desc = 'DEALER XREF' AND entity_id <> 999999998"
    )
    found["profiles"] = "SELECT entity_id, contact_id, " + ", ".join(map(clean, REGISTRY_TEXT)) + ", " + ", ".join(
        FLAGS) + " FROM profile WHERE source_desc = 'DEALER XREF'"
    fields = ", ".join(clean(f"c.{f}") for f in TEXT_FIELDS)
    people = (
        "FROM contact c LEFT JOIN account a ON a.contact_code = c.contact_code "
        "WHERE {active} AND c.contact_code NOT IN (SELECT code FROM employees) "
        "AND NOT (a.account_no IS NULL AND c.contact_code IN (SELECT contact_code FROM vendor))"
    )
    found["active_contacts"] = (
        f"SELECT c.contact_code, c.contact_type, c.ckc_id, c.cmp_ckc_id, c.creation_date, {fields}, a.account_no, "
        + clean("a.branch") + " " + people.format(active="coalesce(c.inactive_indicator, 'A') <> 'I'")
    )
    found["inactive_people"] = "SELECT c.*, a.account_no, " + clean("a.branch") + " " + people.format(
        active="c.inactive_indicator = 'I'")
    found["last_tx"] = """
        SELECT account_no, max(d) AS last_tx_date FROM (
            SELECT a.account_no, CAST(u.sales_date AS DATE) AS d FROM account a JOIN unit_sale u
                ON u.owner_code = a.contact_code WHERE u.sales_date IS NOT NULL
            UNION ALL
            SELECT a.account_no, CAST(i.invo_datetime AS DATE) FROM account a JOIN invoice i
                ON i.bill_to_acc = a.account_no WHERE i.invo_type IN ('C', 'I') AND i.module_type IN ('I', 'W')
            UNION ALL
            SELECT a.account_no, CAST(i.invo_datetime AS DATE) FROM account a JOIN invoice i
                ON i.bill_to_acc = a.account_no JOIN rental r ON r.invoice_no = i.document_no
                WHERE i.invo_type IN ('C', 'I')
        ) GROUP BY account_no"""
    found["accessory_total"] = "SELECT unit_no, sum(coalesce(sale_value, 0)) AS accessories FROM unit_accessory GROUP BY unit_no"
    return found


def account_revenue(start: dt.date, end: dt.date) -> str:
    bounds = f"BETWEEN DATE '{start}' AND DATE '{end}'"
    service = " + ".join(f"coalesce(i.{c}, 0)" for c in ("parts_sale", "labour_sale", "sublet_sale", "other_sale"))
    return f"""
        SELECT account_no, CAST(sum(g) AS DECIMAL(18,2)) AS goods, CAST(sum(p) AS DECIMAL(18,2)) AS parts,
            CAST(sum(s) AS DECIMAL(18,2)) AS service, CAST(sum(r) AS DECIMAL(18,2)) AS rental,
            CAST(sum(g + p + s + r) AS DECIMAL(18,2)) AS total_revenue
        FROM (
            SELECT a.account_no, sum(coalesce(u.sales_value, 0)) + coalesce(max(x.accessories), 0) AS g, 0 AS p, 0 AS s, 0 AS r
            FROM account a JOIN unit_sale u ON u.owner_code = a.contact_code
                LEFT JOIN accessory_total x ON x.unit_no = u.unit_no
            WHERE u.sales_date {bounds} GROUP BY u.unit_no, a.account_no
            UNION ALL
            SELECT a.account_no, 0, coalesce(i.parts_sale, 0), 0, 0 FROM account a JOIN invoice i
                ON i.bill_to_acc = a.account_no AND i.invo_type IN ('C', 'I') AND i.module_type = 'I'
            WHERE i.invo_datetime {bounds}
            UNION ALL
            SELECT a.account_no, 0, 0, {service}, 0 FROM account a JOIN invoice i
                ON i.bill_to_acc = a.account_no AND i.invo_type IN ('C', 'I') AND i.module_type = 'W'
            WHERE i.invo_datetime {bounds}
            UNION ALL
            SELECT a.account_no, 0, 0, 0, coalesce(r.rental_value, 0) FROM account a JOIN invoice i
                ON i.bill_to_acc = a.account_no AND i.invo_type IN ('C', 'I')
                LEFT JOIN rental r ON r.invoice_no = i.document_no
            WHERE i.invo_datetime {bounds}
        ) GROUP BY account_no"""


def parity_case(left: str, right: str, same: str | None = None) -> str:
    same = same or f"upper({left}) = upper({right})"
    return (
        f"CASE WHEN {left} IS NULL AND {right} IS NULL THEN 'both_null' WHEN {left} IS NOT NULL AND {right} IS NULL "
        f"THEN 'equip_only' WHEN {left} IS NULL AND {right} IS NOT NULL THEN 'registry_only' WHEN {same} THEN 'match' "
        "ELSE 'mismatch' END"
    )


def phone_case(phone: str, area: str, num: str) -> str:
    blank = f"({area} IS NULL AND {num} IS NULL)"
    return (
        f"CASE WHEN {phone} IS NULL AND {blank} THEN 'both_null' WHEN {blank} THEN 'equip_only' WHEN {phone} IS NULL "
        f"THEN 'registry_only' WHEN {phone} = coalesce({area}, '') || coalesce({num}, '') THEN 'match' ELSE 'mismatch' END"
    )


PARITY = {
    "company_name": ("contact_type IN ('B', 'C')", parity_case("company_name", "reg_company_name")),
    "first_name": ("contact_type IN ('I', 'C')", parity_case("first_name", "reg_first_name")),
    "last_name": ("contact_type IN ('I', 'C')", parity_case("last_name", "reg_last_name")),
    "email": ("true", parity_case("email", "reg_email")),
    "business_phone": ("true", phone_case("biz_phone", "reg_biz_area", "reg_biz_num")),
    "private_phone": ("true", phone_case("priv_phone", "reg_priv_area", "reg_priv_num")),
    "mobile_phone": ("true", phone_case("mob_phone", "reg_mob_area", "reg_mob_num")),
    "street": ("true", parity_case("street", "reg_street")),
    "city": ("true", parity_case("city", "reg_city")),
    "state": ("true", parity_case("state", "reg_state")),
    "zip": ("true", parity_case(
        "pcode", "reg_pcode",
        "CASE WHEN coalesce(country, 'US') = 'US' THEN upper(substr(pcode, 1, 5)) = upper(substr(reg_pcode, 1, 5)) "
        "ELSE upper(pcode) = upper(reg_pcode) END")),
    "country": ("true", parity_case("country", "reg_country")),
}


def dated(as_of: dt.date, cohorts: str = "current") -> dict[str, str]:
    """Relations that depend on the run date, named with a date suffix."""
    x = suffix(as_of, cohorts)
    start, end = window(as_of)
    edges = " ".join(
        f"WHEN t.last_tx_date >= DATE '{as_of.replace(year=as_of.year - n)}' THEN '{label}'"
        for n, label in enumerate(["0-1yr", "1-2yr", "2-3yr", "3-4yr", "4-5yr"], start=1)
    )
    cohort = COHORT[cohorts].format(d="c.creation_date")
    found = {
        f"account_revenue{x}": account_revenue(start, end),
        f"decile_ntile{x}": f"""
            SELECT account_no, total_revenue, CAST(ntile(10) OVER (ORDER BY total_revenue DESC, account_no) AS INTEGER) AS raw_decile
            FROM account_revenue{x} WHERE total_revenue > 0""",
        f"decile_share{x}": f"""
            SELECT account_no, total_revenue, CAST(least(10, (cum * 10 + tot - 1) // tot) AS INTEGER) AS raw_decile FROM (
                SELECT account_no, total_revenue,
                    CAST(100 * sum(total_revenue) OVER (ORDER BY total_revenue DESC, account_no
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS HUGEINT) AS cum,
                    CAST(100 * sum(total_revenue) OVER () AS HUGEINT) AS tot
                FROM account_revenue{x} WHERE total_revenue > 0)""",
        f"contact_enriched{x}": f"""
            SELECT c.*, CAST(coalesce(v.total_revenue, 0) AS DECIMAL(18,2)) AS total_revenue, t.last_tx_date,
                CASE WHEN c.account_no IS NULL THEN 'no_account' WHEN t.last_tx_date IS NULL THEN 'never_transacted'
                    {edges} ELSE '5+yr' END AS staleness_bucket,
                CASE WHEN r.raw_decile IS NULL THEN 'Unranked' ELSE 'D' || CAST(r.raw_decile AS VARCHAR) END AS sales_decile,
                {cohort} AS creation_cohort
            FROM active_contacts c LEFT JOIN last_tx t ON t.account_no = c.account_no
                LEFT JOIN account_revenue{x} v ON v.account_no = c.account_no
                LEFT JOIN decile_share{x} r ON r.account_no = c.account_no""",
        f"contact_linkage{x}": f"""
            SELECT c.contact_code, c.contact_type, c.ckc_id, c.sales_decile, c.staleness_bucket, c.branch, c.creation_cohort,
                x.entity_id, x.contact_id, CASE WHEN x.cross_ref_number IS NOT NULL THEN 1 ELSE 0 END AS is_linked
            FROM contact_enriched{x} c LEFT JOIN links x ON upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code))""",
        f"unlinked{x}": f"""
            SELECT * FROM contact_enriched{x} c WHERE NOT EXISTS (
                SELECT 1 FROM links x WHERE upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code)))""",
        f"active_linked{x}": f"""
            SELECT c.contact_code, {", ".join("c." + s for s in SLICE.split(", "))}, x.entity_id, x.contact_id,
                {", ".join("c." + f for f in TEXT_FIELDS[:12])}, {", ".join("p." + f for f in REGISTRY_TEXT + FLAGS)}
            FROM contact_enriched{x} c JOIN links x ON upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code))
                JOIN profiles p ON p.entity_id = x.entity_id AND p.contact_id = x.contact_id""",
        f"inactive_linked{x}": f"""
            SELECT c.contact_code, c.contact_type, {clean("c.inactive_reason")}, p.out_of_business, p.deceased,
                'Inactive' AS sales_decile, 'Inactive' AS staleness_bucket, c.branch, {cohort} AS creation_cohort
            FROM inactive_people c JOIN links x ON upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code))
                JOIN profiles p ON p.entity_id = x.entity_id AND p.contact_id = x.contact_id""",
        f"field_parity{x}": " UNION ALL ".join(
            f"SELECT contact_code, {SLICE}, '{f}' AS field_name, {case} AS parity_result FROM active_linked{x} WHERE {scope}"
            for f, (scope, case) in PARITY.items()
        ),
    }
    return found


MATERIALIZED = ("contact_enriched", "active_linked", "contact_linkage", "account_revenue", "snapshots", "contact")


def relations() -> dict[str, str]:
    found = undated()
    for day in HISTORY:
        found |= dated(day)
    found |= dated(AS_OF, "older")
    return found


_ALL = relations()


def with_relations(body: str, extra: dict[str, str] | None = None) -> str:
    """Put the relations a query needs in front of it, in dependency order."""
    extra = extra or {}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(n for n in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text) if n in extra or n in _ALL):
            if name not in ordered:
                visit(extra.get(name) or _ALL[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    ctes = ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n.startswith(MATERIALIZED) else ''}({extra.get(n) or _ALL[n]})" for n in ordered
    )
    return f"WITH {ctes}\n{body}"
