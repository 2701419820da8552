"""Every query as DuckDB SQL over the test tables."""

from __future__ import annotations

import datetime as dt

from linkledger.operators import dimensions
from linkledger.config import Settings
from oracle import rules
from oracle.relations import AS_OF, HISTORY, PARITY, SLICE, TEXT_FIELDS, suffix, window, with_relations

OUT = f"snapshot_date, metric_category, metric_name, {SLICE}, numerator, denominator"
DIMS = SLICE.split(", ")
OUTCOMES = ["match", "mismatch", "equip_only", "registry_only", "both_null"]
BUCKETS = ["no_account", "never_transacted", "0-1yr", "1-2yr", "2-3yr", "3-4yr", "4-5yr", "5+yr"]
TIERS = ["tier_1_strong", "tier_2_partial", "tier_3_name_only", "tier_4_no_name"]
STANDALONE = ["contact_type", "creation_cohort"]


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dims(keep: list[str]) -> str:
    return ", ".join(d if d in keep else f"'ALL' AS {d}" for d in DIMS)


def shaped(rows: str, category: str, day: dt.date) -> str:
    return f"SELECT DATE '{day}' AS snapshot_date, '{category}' AS metric_category, metric_name, {SLICE}, numerator, denominator FROM ({rows})"


def metric(name: str, num: str, den: str, source: str, keep: list[str] = DIMS, where: str = "true") -> str:
    group = ", ".join(keep) if keep else "()"
    return (
        f"SELECT '{name}' AS metric_name, {dims(keep)}, {big(num)} AS numerator, {big(den)} AS denominator "
        f"FROM {source} WHERE {where} GROUP BY {group}"
    )


def linkage_parts(x: str, keep: list[str] = DIMS, branch: str = "CAST(NULL AS VARCHAR)") -> dict[str, str]:
    src = f"contact_linkage{x}"
    overall = f"'ALL' AS contact_type, 'ALL' AS sales_decile, 'ALL' AS staleness_bucket, {branch} AS branch, 'ALL' AS creation_cohort"
    conflict = (
        "sum(CASE WHEN contact_type = 'C' AND (contact_id IS NULL OR contact_id = 0) THEN 1 "
        "WHEN contact_type IN ('B', 'I') AND contact_id IS NOT NULL AND contact_id <> 0 THEN 1 ELSE 0 END)"
    )
    return {
        "linked_count": metric("linked_count", "sum(is_linked)", "count(*)", src, keep),
        "unlinked_count": metric("unlinked_count", "sum(1 - is_linked)", "count(*)", src, keep),
        "ckc_id_no_cross_ref": metric(
            "ckc_id_no_cross_ref", "sum(CASE WHEN ckc_id IS NOT NULL AND is_linked = 0 THEN 1 ELSE 0 END)",
            "sum(CASE WHEN ckc_id IS NOT NULL THEN 1 ELSE 0 END)", src, keep),
        "type_mismatch_linkage": metric("type_mismatch_linkage", conflict, "sum(is_linked)", src, keep, "is_linked = 1"),
        "duplicate_entity_id": (
            f"SELECT 'duplicate_entity_id' AS metric_name, {overall}, {big('count(*) FILTER (n > 1)')} AS numerator, "
            f"{big('count(*)')} AS denominator FROM (SELECT entity_id, count(*) AS n FROM {src} WHERE is_linked = 1 GROUP BY entity_id)"),
        "orphan_cross_ref": (
            f"SELECT 'orphan_cross_ref' AS metric_name, {overall}, (SELECT count(*) FROM links x WHERE NOT EXISTS "
            f"(SELECT 1 FROM contact_enriched{x} c WHERE upper(rtrim(c.contact_code)) = upper(rtrim(x.cross_ref_number)))) AS numerator, "
            f"(SELECT count(*) FROM links) AS denominator"),
    }


def parity_field_rows(x: str, fields: list[str] | None = None) -> str:
    """Slices times outcomes, zero filled by a spine."""
    chosen = " AND field_name IN (" + ", ".join(f"'{f}'" for f in fields) + ")" if fields else ""
    outcomes = ", ".join(f"('{o}')" for o in OUTCOMES)
    on = " AND ".join(f"a.{d} IS NOT DISTINCT FROM s.{d}" for d in ["field_name", *DIMS])
    return f"""
        SELECT s.field_name || '_' || o.o AS metric_name, {", ".join("s." + d for d in DIMS)},
            {big("coalesce(a.n, 0)")} AS numerator, {big("s.n")} AS denominator
        FROM (SELECT field_name, {SLICE}, count(*) AS n FROM field_parity{x} WHERE true{chosen} GROUP BY field_name, {SLICE}) s
            CROSS JOIN (VALUES {outcomes}) o(o)
            LEFT JOIN (SELECT field_name, parity_result, {SLICE}, count(*) AS n FROM field_parity{x}
                GROUP BY field_name, parity_result, {SLICE}) a ON a.parity_result = o.o AND {on}"""


ADDRESS = " OR ".join(
    f"upper(coalesce({a}, '')) <> upper(coalesce({b}, ''))"
    for a, b in [("street", "reg_street"), ("city", "reg_city"), ("state", "reg_state"), ("pcode", "reg_pcode")]
)


def flagged(test: str) -> str:
    return f"sum(CASE WHEN {test} THEN 1 ELSE 0 END)"


def priority_parts(x: str, keep: list[str] = DIMS) -> dict[str, str]:
    src = f"active_linked{x}"
    conflict = (
        "(inactive_reason = 'Out of Business' AND coalesce(out_of_business, 'N') <> 'Y') OR "
        "(inactive_reason = 'Deceased' AND coalesce(deceased, 'N') <> 'Y')"
    )
    return {
        "phys_addr_certified_mismatch": metric(
            "phys_addr_certified_mismatch", flagged(ADDRESS), "count(*)", src, keep, "postal_certified = 'CERTIFIED'"),
        "address_confirmed_undeliverable": metric(
            "address_confirmed_undeliverable", flagged("phys_undeliverable = 'Y' OR mail_undeliverable = 'Y'"), "count(*)", src, keep),
        "registry_oob_equip_active": metric(
            "registry_oob_equip_active", flagged("out_of_business = 'Y'"), "count(*)", src, keep, "contact_type = 'B'"),
        "registry_deceased_equip_active": metric(
            "registry_deceased_equip_active", flagged("deceased = 'Y'"), "count(*)", src, keep, "contact_type IN ('I', 'C')"),
        "equip_inactive_reason_mismatch": metric(
            "equip_inactive_reason_mismatch", flagged(conflict), "count(*)", f"inactive_linked{x}", keep),
    }


def rule_rows(found: dict[str, tuple[str, str]], x: str, keep: list[str] = DIMS) -> str:
    group = ", ".join(["metric_name", *keep])
    return (
        f"SELECT metric_name, {dims(keep)}, {big('sum(is_issue)')} AS numerator, {big('count(*)')} AS denominator "
        f"FROM ({rules.judged(found, f'contact_enriched{x}', SLICE)}) GROUP BY {group}"
    )


def staleness_rows(x: str) -> str:
    keep = [d for d in DIMS if d != "staleness_bucket"]
    on = " AND ".join(f"c.{d} IS NOT DISTINCT FROM s.{d}" for d in keep)
    return f"""
        SELECT b.b AS metric_name, s.contact_type, s.sales_decile, 'ALL' AS staleness_bucket, s.branch, s.creation_cohort,
            {big("coalesce(c.n, 0)")} AS numerator, s.n AS denominator
        FROM (SELECT {", ".join(keep)}, count(*) AS n FROM contact_enriched{x} GROUP BY ALL) s
            CROSS JOIN (VALUES {", ".join(f"('{b}')" for b in BUCKETS)}) b(b)
            LEFT JOIN (SELECT {", ".join(keep)}, staleness_bucket, count(*) AS n FROM contact_enriched{x} GROUP BY ALL) c
                ON c.staleness_bucket = b.b AND {on}"""


TIER = """CASE
    WHEN (contact_type IN ('I', 'C') AND (first_name IS NULL OR last_name IS NULL)) OR (contact_type = 'B' AND company_name IS NULL)
        THEN 'tier_4_no_name'
    WHEN (street IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL) OR (street IS NOT NULL AND pcode IS NOT NULL)
        THEN 'tier_1_strong'
    WHEN street IS NOT NULL OR city IS NOT NULL OR state IS NOT NULL OR pcode IS NOT NULL OR biz_phone IS NOT NULL
        OR priv_phone IS NOT NULL OR mob_phone IS NOT NULL OR email IS NOT NULL THEN 'tier_2_partial'
    ELSE 'tier_3_name_only' END"""


def readiness_rows(x: str) -> str:
    on = " AND ".join(f"c.{d} IS NOT DISTINCT FROM s.{d}" for d in DIMS)
    return f"""
        SELECT t.t AS metric_name, {", ".join("s." + d for d in DIMS)}, {big("coalesce(c.n, 0)")} AS numerator, s.n AS denominator
        FROM (SELECT {SLICE}, count(*) AS n FROM unlinked{x} GROUP BY ALL) s
            CROSS JOIN (VALUES {", ".join(f"('{t}')" for t in TIERS)}) t(t)
            LEFT JOIN (SELECT {SLICE}, {TIER} AS tier, count(*) AS n FROM unlinked{x} GROUP BY ALL) c ON c.tier = t.t AND {on}"""


def union(parts) -> str:
    return " UNION ALL BY NAME ".join(f"({p})" for p in parts)


def section(category: str, day: dt.date = AS_OF) -> str:
    x = suffix(day)
    rows = {
        "linkage": lambda: union(linkage_parts(x).values()),
        "parity": lambda: union([parity_field_rows(x), *priority_parts(x).values()]),
        "completeness": lambda: rule_rows(rules.COMPLETENESS, x),
        "field_quality": lambda: rule_rows(rules.FIELD_QUALITY, x),
        "staleness": lambda: staleness_rows(x),
        "match_readiness": lambda: readiness_rows(x),
    }[category]()
    return shaped(rows, category, day)


CATEGORIES = ["linkage", "parity", "completeness", "field_quality", "staleness", "match_readiness"]


def snapshots(categories=CATEGORIES, days=HISTORY) -> dict[str, str]:
    return {"snapshots": union(section(c, d) for d in days for c in categories)}


def standalone(x: str) -> dict[str, str]:
    counted = lambda name, src, keep: (
        f"SELECT {name} AS metric_name, {dims(keep)}, count(*) AS numerator, "
        f"{big('sum(count(*)) OVER (PARTITION BY ' + ', '.join(keep) + ')')} AS denominator FROM {src} GROUP BY {name}, {', '.join(keep)}"
    )
    linkage = linkage_parts(x, STANDALONE, "'ALL'")
    fields = (
        f"SELECT field_name || '_' || parity_result AS metric_name, {dims(STANDALONE)}, count(*) AS numerator, "
        f"{big('sum(count(*)) OVER (PARTITION BY field_name, contact_type, creation_cohort)')} AS denominator "
        f"FROM field_parity{x} GROUP BY field_name, parity_result, contact_type, creation_cohort"
    )
    priority = priority_parts(x, STANDALONE)
    by_type = {m: r for m, r in rules.COMPLETENESS.items() if r[0] != rules.ALL}
    over_all = {m: r for m, r in rules.COMPLETENESS.items() if r[0] == rules.ALL}
    return {
        "dq_linkage": shaped(union(linkage.values()), "linkage", AS_OF),
        "dq_parity": shaped(
            union([fields, priority["phys_addr_certified_mismatch"], priority["address_confirmed_undeliverable"]]), "parity", AS_OF),
        "dq_completeness": shaped(
            union([rule_rows(by_type, x, STANDALONE), rule_rows(over_all, x, ["creation_cohort"])]), "completeness", AS_OF),
        "dq_field_quality": shaped(
            rule_rows(rules.FIELD_QUALITY | rules.STANDALONE_QUALITY, x, STANDALONE), "field_quality", AS_OF),
        "dq_staleness": shaped(
            counted("staleness_bucket", f"(SELECT contact_type, sales_decile, creation_cohort, staleness_bucket FROM contact_enriched{x})",
                    ["contact_type", "sales_decile", "creation_cohort"]), "staleness", AS_OF),
        "dq_match_readiness": shaped(
            counted("tier", f"(SELECT contact_type, creation_cohort, {TIER} AS tier FROM unlinked{x})", STANDALONE),
            "match_readiness", AS_OF),
    }


def stages() -> dict[str, str]:
    start, end = window(AS_OF)
    bounds = f"BETWEEN DATE '{start}' AND DATE '{end}'"
    fields = ", ".join(["contact_code", "contact_type", "ckc_id", "cmp_ckc_id", "creation_date", *TEXT_FIELDS, "account_no", "branch"])
    enriched = fields + ", total_revenue, last_tx_date, staleness_bucket, sales_decile, creation_cohort"
    return {
        "r60_window": (
            f"SELECT DATE '{start}' AS start_date, DATE '{end}' AS end_date, "
            f"(SELECT count(*) FROM invoice WHERE invo_type IN ('C', 'I') AND invo_datetime {bounds}) AS invoices, "
            f"(SELECT count(*) FROM unit_sale WHERE sales_date {bounds}) AS units"),
        "account_revenue": "SELECT * FROM account_revenue",
        "sales_decile_ntile": "SELECT * FROM decile_ntile",
        "sales_decile_share": "SELECT * FROM decile_share",
        "last_transaction": "SELECT * FROM last_tx",
        "active_contacts": f"SELECT {fields} FROM active_contacts",
        "contact_enriched": f"SELECT {enriched} FROM contact_enriched",
        "contact_linkage": "SELECT * FROM contact_linkage",
        "unlinked_contacts": f"SELECT {enriched} FROM unlinked",
        "active_linked": "SELECT * FROM active_linked",
        "inactive_linked": "SELECT * FROM inactive_linked",
        "field_parity": "SELECT * FROM field_parity",
        "linked_counts": (
            f"SELECT {SLICE}, count(*) AS total_linked, count(*) FILTER (postal_certified = 'CERTIFIED') AS certified_linked "
            "FROM active_linked GROUP BY ALL"),
        "dup_codes": "SELECT upper(trim(contact_code)) AS norm_code FROM contact_enriched GROUP BY 1 HAVING count(*) > 1",
        "match_tier": f"SELECT contact_code, contact_type, {TIER} AS tier FROM unlinked",
        "dq_snapshot": union(section(c) for c in CATEGORIES),
    }


def metrics() -> dict[str, str]:
    found = {f"lk_{m}": shaped(sql, "linkage", AS_OF) for m, sql in linkage_parts("").items()}
    found |= {f"pa_{f}": shaped(parity_field_rows("", [f]), "parity", AS_OF) for f in PARITY}
    found |= {f"pp_{m}": shaped(sql, "parity", AS_OF) for m, sql in priority_parts("").items()}
    found |= {f"cp_{m}": shaped(rule_rows({m: r}, ""), "completeness", AS_OF) for m, r in rules.COMPLETENESS.items()}
    quality = rules.FIELD_QUALITY | rules.STANDALONE_QUALITY
    found |= {f"fq_{m}": shaped(rule_rows({m: r}, ""), "field_quality", AS_OF) for m, r in quality.items()}
    found["sb_staleness"] = section("staleness")
    steps = " ".join(f"WHEN last_tx_date >= DATE '{AS_OF}' - {365 * n} THEN '{b}'" for n, b in enumerate(BUCKETS[2:-1], 1))
    found["sb_staleness_365d"] = (shaped(staleness_rows("_365d"), "staleness", AS_OF), {
        "contact_enriched_365d": f"""SELECT * REPLACE (CASE WHEN account_no IS NULL THEN 'no_account'
            WHEN last_tx_date IS NULL THEN 'never_transacted' {steps} ELSE '5+yr' END AS staleness_bucket) FROM contact_enriched"""})
    found["tr_tiers"] = section("match_readiness")
    return found


REF = "CASE WHEN x.contact_id IS NULL OR x.contact_id = 0 THEN 'entity only' ELSE 'entity + contact_id' END"
CRM = (
    "crm_account s JOIN account a ON a.account_no = s.account_no JOIN contact c ON c.contact_code = a.contact_code"
)


def profiling() -> dict[str, str]:
    found = {
        "contact_type_breakdown": """SELECT contact_type, coalesce(inactive_indicator, 'A') AS status, count(*) AS total,
            count(ckc_id) AS has_ckc_id, count(*) FILTER (cmp_ckc_id IS NULL) AS cmp_null,
            count(*) FILTER (cmp_ckc_id = 0) AS cmp_zero, count(*) FILTER (cmp_ckc_id > 0) AS cmp_populated
            FROM contact GROUP BY 1, 2""",
        "account_cardinality": """SELECT contact_code_count, count(*) AS account_count FROM
            (SELECT contact_code, count(account_no) AS contact_code_count FROM account GROUP BY contact_code) GROUP BY 1""",
        "links_per_entity": """SELECT links_per_entity, count(*) AS entity_id_count FROM
            (SELECT entity_id, count(cross_ref_number) AS links_per_entity FROM xref GROUP BY entity_id) GROUP BY 1""",
        "crm_breakdown": """SELECT CASE record_type WHEN 'CUSTOMER' THEN 'Customer' WHEN 'PROSPECT' THEN 'Prospect' ELSE 'Other' END
            AS record_type, count(*) AS total, count(account_no) AS has_account_number, count(comp_entity_id) AS has_comp_entity_id,
            count(erp_entity_id) AS has_erp_entity_id,
            count(*) FILTER (comp_entity_id IS NOT NULL AND erp_entity_id IS NULL) AS comp_only,
            count(erp_entity_id) AS erp_sourced FROM crm_account GROUP BY 1""",
        "entity_range_profile": """SELECT left(CAST(entity_id AS VARCHAR), 1) AS leading_digit, count(*) AS total,
            count(*) FILTER (out_of_business = 'Y') AS out_of_business, count(*) FILTER (deceased = 'Y') AS deceased,
            min(entity_id) AS min_id, max(entity_id) AS max_id FROM profile GROUP BY 1""",
        "case_mismatch_sample": """SELECT x.cross_ref_number, c.contact_code,
            CASE WHEN x.cross_ref_number = upper(x.cross_ref_number) THEN 'upper' ELSE 'mixed/lower' END AS xref_case,
            CASE WHEN c.contact_code = upper(c.contact_code) THEN 'upper' ELSE 'mixed/lower' END AS contact_case
            FROM xref x JOIN contact c ON upper(rtrim(c.contact_code)) = upper(rtrim(x.cross_ref_number))
            WHERE x.cross_ref_number <> c.contact_code ORDER BY 1, 2 LIMIT 30""",
        "case_false_positives": """SELECT count(*) AS false_positives FROM contact c
            LEFT JOIN xref e ON e.cross_ref_number = c.contact_code
            LEFT JOIN xref u ON upper(rtrim(u.cross_ref_number)) = upper(rtrim(c.contact_code))
            WHERE c.ckc_id IS NOT NULL AND c.ckc_id <> 999999998 AND coalesce(c.inactive_indicator, 'A') <> 'I'
            AND e.cross_ref_number IS NULL AND u.cross_ref_number IS NOT NULL""",
        "parent_lookup": """SELECT c.contact_code, c.contact_type, c.ckc_id, c.cmp_ckc_id, p.contact_code AS parent_contact_code,
            p.contact_type AS parent_type, p.ckc_id AS parent_ckc_id
            FROM contact c LEFT JOIN contact p ON p.ckc_id = c.cmp_ckc_id WHERE c.cmp_ckc_id > 0""",
        "coded_value_listing": " UNION ALL ".join(
            f"""SELECT '{f}' AS field_name, {f} AS field_value, count(*) AS contact_count FROM contact
            WHERE coalesce(inactive_indicator, 'A') <> 'I' AND contact_type IN ('I', 'C')
            AND contact_code NOT IN (SELECT code FROM employees) AND NULLIF(trim({f}), '') IS NOT NULL GROUP BY {f}"""
            for f in ("suffix", "title")),
    }
    for tail, fold in (("", "upper(rtrim({}))"), ("_exact_case", "rtrim({})")):
        on = fold.format("x.cross_ref_number") + " = " + fold.format("c.contact_code")
        both = f"xref x JOIN contact c ON {on}"
        crm = f"{CRM} LEFT JOIN xref x ON {on} WHERE s.record_type = 'CUSTOMER' AND s.erp_entity_id IS NOT NULL"
        found |= {
            f"link_level_by_type{tail}": f"SELECT c.contact_type, {REF} AS ref_type, count(*) AS row_count, "
                f"count(DISTINCT x.entity_id) AS distinct_entity_ids FROM {both} GROUP BY 1, 2",
            f"id_agreement{tail}": f"SELECT count(*) AS total_with_contact_id, count(*) FILTER (c.ckc_id = x.entity_id) AS "
                f"ckc_matches_entity_id, count(*) FILTER (c.cmp_ckc_id = x.contact_id) AS cmp_matches_contact_id, "
                f"count(*) FILTER (c.ckc_id = x.entity_id AND c.cmp_ckc_id = x.contact_id) AS both_match FROM {both} "
                "WHERE x.contact_id IS NOT NULL AND x.contact_id <> 0",
            f"contact_entity_only{tail}": f"SELECT count(*) FILTER (c.cmp_ckc_id IS NULL) AS cmp_null, "
                f"count(*) FILTER (c.cmp_ckc_id = 0) AS cmp_zero, count(*) FILTER (c.cmp_ckc_id > 0) AS cmp_populated, "
                f"count(c.ckc_id) AS has_ckc_id FROM {both} WHERE c.contact_type = 'C' AND (x.contact_id IS NULL OR x.contact_id = 0)",
            f"duplicate_entity_list{tail}": f"""SELECT entity_id, dbs_count, member_no, contact_type, cross_ref_number
                FROM (SELECT x.entity_id, c.contact_type, x.cross_ref_number, count(*) OVER (PARTITION BY x.entity_id) AS dbs_count,
                    row_number() OVER (PARTITION BY x.entity_id ORDER BY x.cross_ref_number, c.contact_code) AS member_no FROM {both})
                WHERE dbs_count > 1""",
            f"duplicate_type_combo{tail}": f"""SELECT type_combo, count(*) AS entity_count FROM (
                SELECT entity_id, string_agg(contact_type || ':' || n, '+' ORDER BY contact_type) AS type_combo FROM (
                    SELECT x.entity_id, c.contact_type, count(*) AS n FROM {both} GROUP BY 1, 2)
                GROUP BY entity_id HAVING sum(n) > 1) GROUP BY 1""",
            f"entity_range_by_type{tail}": f"SELECT left(CAST(x.entity_id AS VARCHAR), 1) AS leading_digit, c.contact_type, {REF} AS ref_type, "
                f"count(*) AS row_count, min(x.entity_id) AS min_entity_id, max(x.entity_id) AS max_entity_id FROM {both} GROUP BY 1, 2, 3",
            f"crm_xref_agreement{tail}": f"SELECT count(*) AS customers_with_erp_id, count(*) FILTER (s.erp_entity_id = x.entity_id) AS "
                f"ids_agree, count(*) FILTER (s.erp_entity_id <> x.entity_id) AS ids_disagree, "
                f"count(*) FILTER (x.entity_id IS NULL) AS no_cross_ref_found FROM {crm}",
            f"crm_xref_disagreements{tail}": f"SELECT s.crm_id, s.account_no, s.erp_entity_id, x.entity_id AS xref_entity_id, "
                f"c.contact_code, c.contact_type FROM {crm} AND s.erp_entity_id <> x.entity_id ORDER BY s.crm_id, x.entity_id LIMIT 50",
            f"crm_without_xref{tail}": f"SELECT count(*) AS total, count(c.ckc_id) AS has_ckc_id, "
                f"count(*) FILTER (c.ckc_id = s.erp_entity_id) AS ckc_agrees_with_crm FROM {crm} AND x.entity_id IS NULL",
        }
    return found


PERSON_ID = "CASE WHEN c.contact_type = 'C' AND c.cmp_ckc_id > 0 AND c.cmp_ckc_id <> 999999998 THEN c.cmp_ckc_id END"
KNOWN = (
    "contact c WHERE c.ckc_id IS NOT NULL AND c.ckc_id <> 999999998 AND coalesce(c.inactive_indicator, 'A') <> 'I' "
    "AND NOT EXISTS (SELECT 1 FROM xref x WHERE upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code)))"
)
NOT_STAFF = "c.contact_code NOT IN (SELECT code FROM employees)"
ACTIVE = "coalesce(c.inactive_indicator, 'A') <> 'I'"
QUOTE_FLOW = f"{CRM} WHERE s.record_type = 'CUSTOMER' AND s.comp_entity_id IS NOT NULL AND s.erp_entity_id IS NULL AND {ACTIVE}"
RECONCILED = f"""SELECT t.dbs_number, t.entity_id AS match_entity_id, t.contact_id AS match_contact_id,
    coalesce(m.crm_entity_id, '') AS crm_entity_id,
    CASE WHEN m.crm_entity_id IS NULL THEN 'SF_MISSING' WHEN m.crm_entity_id = t.entity_id THEN 'AGREE' ELSE 'DISAGREE' END AS status
    FROM tight_match t LEFT JOIN (SELECT upper(c.contact_code) AS code, CAST(max(s.comp_entity_id) AS VARCHAR) AS crm_entity_id
        FROM {QUOTE_FLOW} GROUP BY 1) m ON m.code = upper(t.dbs_number)"""


def path_b() -> str:
    person = lambda c, a: f"CASE WHEN c.contact_type = 'B' THEN NULL ELSE {c} END AS {a}"
    none = "CAST(NULL AS VARCHAR)"  # no tax number is kept
    return f"""SELECT c.contact_code AS dbs_customer_number,
        CASE WHEN c.contact_type IN ('B', 'C') THEN c.company_name END AS business_name, c.doing_business_as,
        {person("c.title", "prefix")}, {person("c.first_name", "first_name")}, {person("c.familiar_name", "familiar_name")}, {person("c.middle_name", "middle_name")},
        {person("c.last_name", "last_name")}, {person("c.generation", "generation")}, {person("c.suffix", "suffix")},
        c.street AS address_line_1, c.street_2 AS address_line_2, c.city, c.state AS state_code, c.pcode AS postal_code,
        coalesce(NULLIF(trim(c.country), ''), 'US') AS country_code, c.email AS email_address, c.biz_phone AS work_phone,
        c.priv_phone AS home_phone, c.mob_phone AS mobile_phone, CASE WHEN c.contact_type = 'I' THEN c.fax END AS home_fax,
        CASE WHEN c.contact_type IN ('B', 'C') THEN c.fax END AS work_fax, {none} AS tax_type, {none} AS tax_id
        FROM {QUOTE_FLOW} AND {NOT_STAFF}"""


def split(status: str) -> str:
    return (
        "SELECT dbs_number, match_entity_id AS entity_id, CASE WHEN match_contact_id <> '0' THEN match_contact_id ELSE '' END AS contact_id "
        f"FROM ({RECONCILED}) WHERE status = '{status}' AND upper(dbs_number) NOT IN "
        "(SELECT upper(c.contact_code) FROM contact c WHERE c.contact_code IN (SELECT code FROM employees))"
    )


# Cost columns of a sold unit.
UNIT_COSTS = [
    "wholesale", "retail", "predel_cost", "repair_cost", "access_cost", "rego_fees", "lot_fees", "stamp_duty", "transfer_fees",
    "other_cost", "option_cost", "paint_cost", "trim_cost", "charge_cost", "after_market_cost", "surcharge_cost",
]


def history() -> str:
    span = "year({0}) >= 1996 AND year({0}) <= 2001"
    inv = "account a JOIN invoice i ON i.bill_to_acc = a.account_no AND i.invo_type IN ('C', 'I')"
    key = "a.account_no, year(i.invo_datetime) AS y, month(i.invo_datetime) AS m"
    service = " + ".join(f"coalesce(i.{c}, 0)" for c in ("parts_sale", "labour_sale", "sublet_sale", "other_sale"))
    cost = " + ".join(f"coalesce(i.{c}, 0)" for c in ("parts_cost", "labour_cost", "sublet_cost"))
    unit_cost = " + ".join(f"coalesce(v.{c}, 0)" for c in UNIT_COSTS)
    when = span.format("i.invo_datetime")
    names = ["goods", "goods_cost", "parts", "parts_cost", "service", "service_cost", "rental", "rental_cost"]
    sums = ", ".join(f"CAST(sum(c{n}) AS DECIMAL(18,2)) AS {name}" for n, name in enumerate(names, start=1))
    return f"""SELECT account_no, y AS year, m AS month, {sums}, {big("sum(u)")} AS units FROM (
        SELECT a.account_no, year(v.sales_date) AS y, month(v.sales_date) AS m,
            sum(coalesce(v.sales_value, 0)) + coalesce(max(x.accessories), 0) AS c1,
            sum({unit_cost}) AS c2, 0 AS c3, 0 AS c4, 0 AS c5, 0 AS c6, 0 AS c7, 0 AS c8,
            count(v.unit_no) AS u
        FROM account a JOIN unit_sale v ON v.owner_code = a.contact_code LEFT JOIN accessory_total x ON x.unit_no = v.unit_no
        WHERE {span.format("v.sales_date")} GROUP BY v.unit_no, a.account_no, 2, 3
        UNION ALL SELECT {key}, 0, 0, coalesce(i.parts_sale, 0), coalesce(i.parts_cost, 0), 0, 0, 0, 0, 0 FROM {inv}
            WHERE i.module_type = 'I' AND {when}
        UNION ALL SELECT {key}, 0, 0, 0, 0, {service}, {cost}, 0, 0, 0 FROM {inv} WHERE i.module_type = 'W' AND {when}
        UNION ALL SELECT {key}, 0, 0, 0, 0, 0, 0, coalesce(r.rental_value, 0), coalesce(r.depr_book_value, 0), 0 FROM {inv}
            LEFT JOIN rental r ON r.invoice_no = i.document_no WHERE {when}
        ) GROUP BY account_no, y, m"""


def last_date(name: str, where: str, source: str = "invoice i") -> str:
    return (
        f"SELECT i.bill_to_acc, max(CAST(i.invo_datetime AS DATE)) AS {name} FROM {source} "
        f"WHERE i.invo_type IN ('C', 'I') AND {where} GROUP BY 1"
    )


ENTITY_FLAGS = (
    "(SELECT entity_id, max(out_of_business) AS out_of_business, max(deceased) AS deceased FROM profile "
    "WHERE source_desc = 'DEALER XREF' AND contact_id = 0 GROUP BY entity_id)"
)


def linkage_work() -> dict[str, str]:
    start, end = window(AS_OF)
    return {
        "path_a_extract": f"SELECT c.contact_code AS dbs_number, c.ckc_id AS entity_id, {PERSON_ID} AS contact_id FROM {KNOWN} AND {NOT_STAFF}",
        "path_a_count": f"""SELECT count(*) AS total, count(*) FILTER (c.contact_type = 'B') AS business,
            count(*) FILTER (c.contact_type = 'I') AS individual, count(*) FILTER (c.contact_type = 'C') AS business_contact,
            count({PERSON_ID}) AS contact_with_contact_id FROM {KNOWN} AND {NOT_STAFF}""",
        "path_a_validation": f"""SELECT k.contact_code, k.contact_type, k.entity_id, k.contact_id,
            CASE WHEN e.entity_id IS NULL THEN 'Not Found' ELSE 'Found' END AS entity_in_registry,
            e.out_of_business AS entity_out_of_business, e.deceased AS entity_deceased,
            CASE WHEN k.contact_id IS NULL THEN 'N/A' WHEN p.entity_id IS NULL THEN 'Not Found' ELSE 'Found' END AS contact_in_registry
            FROM (SELECT c.contact_code, c.contact_type, c.ckc_id AS entity_id, {PERSON_ID} AS contact_id FROM {KNOWN}) k
            LEFT JOIN {ENTITY_FLAGS} e ON e.entity_id = k.entity_id
            LEFT JOIN (SELECT DISTINCT entity_id, contact_id FROM profile WHERE source_desc = 'DEALER XREF') p
                ON p.entity_id = k.entity_id AND p.contact_id = k.contact_id""",
        "path_b_extract": path_b(),
        "writeback_status": f"""SELECT c.contact_code, c.contact_type, c.ckc_id, c.cmp_ckc_id, x.entity_id AS xref_entity_id,
            x.contact_id AS xref_contact_id, s.comp_entity_id, s.erp_entity_id,
            CASE WHEN x.entity_id IS NULL THEN 'Not Linked' WHEN c.ckc_id IS NULL THEN 'Linked - not updated'
                WHEN c.ckc_id = x.entity_id THEN 'Linked - matches' ELSE 'Linked - mismatch' END AS writeback_status
            FROM {CRM} LEFT JOIN xref x ON upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code))
            WHERE s.record_type = 'CUSTOMER' AND s.comp_entity_id IS NOT NULL AND {ACTIVE}""",
        "registry_status_check": f"""SELECT * FROM (SELECT s.account_no, c.contact_code, s.comp_entity_id AS crm_entity_id,
            p.out_of_business, p.deceased, CASE WHEN p.entity_id IS NULL THEN 'NOT IN REGISTRY' WHEN p.deceased = 'Y' THEN 'DECEASED'
                WHEN p.out_of_business = 'Y' THEN 'OUT OF BUSINESS' END AS registry_status
            FROM {CRM} LEFT JOIN {ENTITY_FLAGS} p ON p.entity_id = s.comp_entity_id
            WHERE s.record_type = 'CUSTOMER' AND s.comp_entity_id IS NOT NULL AND s.erp_entity_id IS NULL AND {ACTIVE} AND {NOT_STAFF})
            WHERE registry_status IS NOT NULL""",
        "tracking_totals": """
            SELECT 'BASELINE' AS period, count(*) AS linkage_count FROM xref
                WHERE dealer_id = '120' AND (created_ts < DATE '2001-07-01' OR created_ts IS NULL)
            UNION ALL SELECT 'PROJECT', count(*) FROM xref WHERE dealer_id = '120' AND created_ts >= DATE '2001-07-01'
            UNION ALL SELECT 'TOTAL', count(*) FROM xref WHERE dealer_id = '120'""",
        "tracking_daily": f"""SELECT CAST(created_ts AS DATE) AS created_date, count(*) AS new_linkages,
            {big("sum(count(*)) OVER (ORDER BY CAST(created_ts AS DATE))")} AS project_running_total
            FROM xref WHERE dealer_id = '120' AND created_ts >= DATE '2001-07-01' GROUP BY 1""",
        "reconcile_matches": RECONCILED,
        "reconcile_summary": f"""SELECT v.s AS status, count(r.status) AS matches FROM (VALUES ('AGREE'), ('DISAGREE'), ('SF_MISSING')) v(s)
            LEFT JOIN ({RECONCILED}) r ON r.status = v.s GROUP BY 1""",
        "split_agree": split("AGREE"),
        "split_disagree": split("DISAGREE"),
        "employee_codes": "SELECT DISTINCT c.contact_code FROM contact c WHERE c.contact_code IN (SELECT code FROM employees)",
        "account_sales_decile": f"""SELECT c.contact_code, c.contact_type, a.account_no,
            CAST(coalesce(d.total_revenue, 0) AS DECIMAL(18,2)) AS total_revenue_r60,
            CASE WHEN d.raw_decile IS NULL THEN 'Unranked' ELSE 'D' || CAST(d.raw_decile AS VARCHAR) END AS sales_decile,
            DATE '{start}' AS r60_start, DATE '{end}' AS r60_end
            FROM contact c LEFT JOIN account a ON a.contact_code = c.contact_code LEFT JOIN decile_ntile d ON d.account_no = a.account_no
            WHERE {ACTIVE} AND {NOT_STAFF}""",
        "account_sales_history": history(),
        "last_goods_date": "SELECT owner_code AS contact_code, max(CAST(sales_date AS DATE)) AS last_goods_date FROM unit_sale GROUP BY 1",
        "last_parts_date": last_date("last_parts_date", "i.module_type = 'I'"),
        "last_service_date": last_date("last_service_date", "i.module_type = 'W'"),
        "last_rental_date": last_date("last_rental_date", "r.invoice_no IS NOT NULL", "invoice i LEFT JOIN rental r ON r.invoice_no = i.document_no"),
        "sales_by_decile": """SELECT CASE WHEN d.raw_decile IS NULL THEN 'Unranked' ELSE 'D' || CAST(d.raw_decile AS VARCHAR) END AS sales_decile,
            count(*) AS customer_count, CAST(sum(v.total_revenue) AS DECIMAL(18,2)) AS total_revenue
            FROM account_revenue v LEFT JOIN decile_share d ON d.account_no = v.account_no GROUP BY 1""",
    }


def issue_map() -> str:
    found = rules.COMPLETENESS | rules.FIELD_QUALITY
    parts = [
        "SELECT contact_code, 'unlinked_count' AS metric_name FROM contact_linkage WHERE is_linked = 0",
        "SELECT contact_code, 'ckc_id_no_cross_ref' FROM contact_linkage WHERE is_linked = 0 AND ckc_id IS NOT NULL",
        "SELECT contact_code, 'type_mismatch_linkage' FROM contact_linkage WHERE is_linked = 1 AND ((contact_type = 'C' AND "
        "(contact_id IS NULL OR contact_id = 0)) OR (contact_type IN ('B', 'I') AND contact_id IS NOT NULL AND contact_id <> 0))",
        "SELECT contact_code, 'duplicate_entity_id' FROM contact_linkage WHERE entity_id IN (SELECT entity_id FROM contact_linkage "
        "WHERE entity_id IS NOT NULL GROUP BY entity_id HAVING count(*) > 1)",
        f"SELECT contact_code, metric_name FROM ({rules.judged(found, 'contact_enriched', 'contact_code')}) WHERE is_issue = 1",
        "SELECT contact_code, field_name || '_' || parity_result FROM field_parity WHERE parity_result IN ('mismatch', 'equip_only', 'registry_only')",
        f"SELECT contact_code, 'phys_addr_certified_mismatch' FROM active_linked WHERE postal_certified = 'CERTIFIED' AND ({ADDRESS})",
        "SELECT contact_code, 'address_confirmed_undeliverable' FROM active_linked WHERE phys_undeliverable = 'Y' OR mail_undeliverable = 'Y'",
        "SELECT contact_code, 'registry_oob_equip_active' FROM active_linked WHERE contact_type = 'B' AND out_of_business = 'Y'",
        "SELECT contact_code, 'registry_deceased_equip_active' FROM active_linked WHERE contact_type IN ('I', 'C') AND deceased = 'Y'",
        "SELECT contact_code, 'equip_inactive_reason_mismatch' FROM inactive_linked WHERE (inactive_reason = 'Out of Business' AND "
        "coalesce(out_of_business, 'N') <> 'Y') OR (inactive_reason = 'Deceased' AND coalesce(deceased, 'N') <> 'Y')",
    ]
    return f"SELECT DISTINCT DATE '{AS_OF}' AS snapshot_date, metric_name, contact_code FROM ({' UNION ALL '.join(parts)})"


def literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value).lower() if isinstance(value, bool) else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], columns: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") d({columns})"


# Ids of the lookup tables, in order. Labels and descriptions are the package's own wording.
DIMENSION_IDS = {
    "dim_contact_type": ["B", "C", "I", "ALL"],
    "dim_sales_decile": ["D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8", "D9", "D10", "Unranked", "ALL"],
    "dim_staleness_bucket": [
        "0-1yr", "1-2yr", "2-3yr", "3-4yr", "4-5yr", "5+yr", "never_transacted", "no_account", "ALL"],
    "dim_parity_field": [
        "company_name", "first_name", "last_name", "email", "business_phone", "private_phone", "mobile_phone", "street",
        "city", "state", "zip", "country"],
    "dim_parity_outcome": ["match", "mismatch", "equip_only", "registry_only", "both_null"],
    "dim_creation_cohort": ["Unknown", "Pre-2015", "2016-2020", "2021-2025", "2026+", "ALL"],
}
PRIORITY = [
    "phys_addr_certified_mismatch", "address_confirmed_undeliverable", "registry_oob_equip_active",
    "registry_deceased_equip_active", "equip_inactive_reason_mismatch",
]
LINKAGE = [
    "linked_count", "unlinked_count", "ckc_id_no_cross_ref", "type_mismatch_linkage", "duplicate_entity_id", "orphan_cross_ref",
]
# (metric, category, counts as an issue, parity field, parity outcome)
METRICS = (
    [(m, "linkage", m != "linked_count", None, None) for m in LINKAGE]
    + [(f"{f}_{o}", "parity", o in ("mismatch", "equip_only", "registry_only"), f, o)
       for f in DIMENSION_IDS["dim_parity_field"] for o in OUTCOMES]
    + [(m, "parity", True, None, None) for m in PRIORITY]
    + [(m, "completeness", True, None, None) for m in rules.COMPLETENESS]
    + [(m, "field_quality", True, None, None) for m in rules.FIELD_QUALITY]
    + [(b, "staleness", False, None, None) for b in BUCKETS]
    + [(t, "match_readiness", False, None, None) for t in TIERS]
)


def dimension(name: str, column: str, source: str) -> str:
    wording = {row[0]: row[1:3] for row in dimensions.dimension_rows()[name]}
    rows = [(i, *wording.get(i, (None, None)), n) for n, i in enumerate(DIMENSION_IDS[name], start=1)]
    d = values(rows, "id, label, description, sort_order")
    return f"""SELECT d.id, d.label, d.description, d.sort_order, CASE WHEN d.id = 'ALL' THEN (SELECT count(*) FROM {source})
        ELSE (SELECT count(*) FROM {source} s WHERE s.{column} = d.id) END AS contacts FROM {d}"""


METRIC_COLUMNS = "metric_name, metric_category, label, definition, is_issue, parity_field, parity_outcome"


def dim_metric() -> str:
    wording = {row[0]: row[2:4] for row in dimensions.metric_rows(Settings(as_of=AS_OF))}
    return values([(m, c, *wording.get(m, (None, None)), *rest) for m, c, *rest in METRICS], METRIC_COLUMNS)


def stored() -> dict[str, tuple[str, dict[str, str]] | str]:
    snaps = snapshots()
    latest = snapshots(days=[AS_OF])
    calendar = """SELECT CAST(d AS DATE) AS date, year(d) AS year, month(d) AS month_no, monthname(d) AS month, quarter(d) AS quarter_no,
        'Qtr ' || CAST(quarter(d) AS VARCHAR) AS quarter, day(d) AS day FROM (SELECT unnest(generate_series(
            make_date(year(lo), 1, 1), make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS d
            FROM (SELECT min(snapshot_date) AS lo, max(snapshot_date) AS hi FROM snapshots))"""
    calendar = calendar.replace("year(d) AS year", "CAST(year(d) AS INTEGER) AS year").replace(
        "month(d) AS month_no", "CAST(month(d) AS INTEGER) AS month_no").replace(
        "quarter(d) AS quarter_no", "CAST(quarter(d) AS INTEGER) AS quarter_no").replace("day(d) AS day", "CAST(day(d) AS INTEGER) AS day")
    return {
        "issue_map": issue_map(),
        "issue_map_counts": f"SELECT metric_name, count(*) AS issue_rows FROM ({issue_map()}) GROUP BY 1",
        "snapshot_verification": (
            f"SELECT snapshot_date, metric_category, count(*) AS row_count, {big('sum(numerator)')} AS total_numerator, "
            f"{big('sum(denominator)')} AS total_denominator FROM snapshots "
            "WHERE snapshot_date = (SELECT max(snapshot_date) FROM snapshots) GROUP BY 1, 2", snaps),
        "dim_metric": (
            f"SELECT d.*, (SELECT count(*) FROM snapshots s WHERE s.metric_name = d.metric_name) AS snapshot_rows FROM {dim_metric()}", snaps),
        "metric_name_parity": (
            f"SELECT metric_name, 'missing from dimension' AS finding FROM (SELECT metric_name FROM snapshots EXCEPT SELECT metric_name FROM {dim_metric()}) "
            f"UNION ALL SELECT metric_name, 'not in snapshot' FROM (SELECT metric_name FROM {dim_metric()} EXCEPT SELECT metric_name FROM snapshots)",
            latest),
        "dim_contact_type": dimension("dim_contact_type", "contact_type", "contact_enriched"),
        "dim_sales_decile": dimension("dim_sales_decile", "sales_decile", "contact_enriched"),
        "dim_staleness_bucket": dimension("dim_staleness_bucket", "staleness_bucket", "contact_enriched"),
        "dim_parity_field": dimension("dim_parity_field", "field_name", "field_parity"),
        "dim_parity_outcome": dimension("dim_parity_outcome", "parity_result", "field_parity"),
        "dim_creation_cohort": dimension("dim_creation_cohort", "creation_cohort", "contact_enriched"),
        "dim_calendar": (calendar, snapshots(["linkage"])),
        **standalone(""),
        **{f"{n}_older_cohorts": sql for n, sql in standalone("_older").items()},
    }


def total(column: str, *names: str) -> str:
    if not names:
        return big(f"sum({column})")
    listed = ", ".join(f"'{m}'" for m in names)
    return big(f"sum({column}) FILTER (metric_name IN ({listed}))")


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF({b}, 0)"


MEASURES = {
    "issue_rate": ratio(total("numerator"), total("denominator")),
    "issue_count": total("numerator"),
    "record_count": total("denominator"),
    "numerator": total("numerator"),
    "denominator": total("denominator"),
    "pct_linked": ratio(total("numerator", "linked_count"), total("denominator", "linked_count")),
    "stale_5yr": total("numerator", "5+yr"),
    "match_ready": ratio(total("numerator", "tier_1_strong", "tier_2_partial"), total("denominator", "tier_1_strong")),
}


# What each report visual shows: (columns to group by, measures or pivot, filters, over all dates).
# Filters: c = category, m = metric; a cohort chart leaves out the unknown and the total.
BY_TYPE, NUM = ["metric_name", "contact_type"], ["numerator"]
REPORTS = {
    1: (["metric_category"], ["issue_count"], {}, False),
    3: ([], ["pct_linked"], {"c": "linkage"}, False),
    4: ([], ["match_ready"], {"c": "match_readiness"}, False),
    5: ([], ["stale_5yr"], {"c": "staleness"}, False),
    6: (["snapshot_date", "metric_category"], ["issue_count"], {}, True),
    7: (BY_TYPE, ["issue_count"], {"c": "linkage"}, False),
    8: ([], ["issue_count"], {"c": "linkage", "m": "duplicate_entity_id"}, False),
    9: ([], ["issue_count"], {"c": "linkage", "m": "linked_count"}, False),
    10: ([], ["issue_count"], {"c": "linkage", "m": "orphan_cross_ref"}, False),
    11: ([], ["issue_count"], {"c": "linkage", "m": "unlinked_count"}, False),
    12: (["snapshot_date"], ["issue_count"], {"c": "linkage", "m": "linked_count"}, True),
    13: (BY_TYPE, ["issue_count"], {"c": "completeness"}, False),
    14: ([], ["issue_count"], {"c": "completeness", "m": "no_contact_info"}, False),
    15: ([], ["issue_count"], {"c": "completeness", "m": "missing_email"}, False),
    16: ([], ["issue_count"], {"c": "completeness", "m": "missing_all_phones"}, False),
    17: (BY_TYPE, ["numerator", "denominator", "issue_count", "record_count"], {"c": "completeness"}, False),
    18: (BY_TYPE, NUM, {"c": "field_quality"}, False),
    19: (["metric_name"], ["numerator", "denominator"], {"c": "field_quality"}, False),
    20: (BY_TYPE, NUM, {"c": "parity"}, False),
    21: ([], NUM, {"c": "parity", "m": "phys_addr_certified_mismatch"}, False),
    22: ([], NUM, {"c": "parity", "m": "address_confirmed_undeliverable"}, False),
    23: (BY_TYPE, NUM, {"c": "parity"}, False),
    24: (BY_TYPE, NUM, {"c": "staleness"}, False),
    25: ([], NUM, {"c": "staleness", "m": "never_transacted"}, False),
    26: ([], NUM, {"c": "staleness", "m": "no_account"}, False),
    27: ([], NUM, {"c": "staleness", "m": "5+yr"}, False),
    28: (["metric_name"], ("sales_decile", DIMENSION_IDS["dim_sales_decile"][:-1]), {"c": "staleness"}, False),
    29: (BY_TYPE, NUM, {"c": "match_readiness"}, False),
    30: ([], NUM, {"c": "match_readiness", "m": "tier_1_strong"}, False),
    31: ([], NUM, {"c": "match_readiness", "m": "tier_2_partial"}, False),
    32: ([], NUM, {"c": "match_readiness", "m": "tier_4_no_name"}, False),
    33: (["metric_name"], NUM, {"c": "match_readiness"}, False),
    34: (["snapshot_date", "metric_category"], NUM, {}, True),
    35: (["snapshot_date", "metric_name"], NUM, {}, True),
    36: (["metric_category", "metric_name"], ["numerator", "denominator", "issue_rate"], {}, False),
    37: (["creation_cohort"], ["issue_rate"], {"cohorts": "creation_cohort NOT IN ('ALL', 'Unknown')"}, False),
}


def visual(number: int) -> tuple[str, dict[str, str]]:
    by, shown, filters, trend = REPORTS[number]
    table = snapshots([filters["c"]] if "c" in filters else CATEGORIES, HISTORY if trend else [AS_OF])
    where = [filters.get("cohorts", "true")] + ([f"metric_name = '{filters['m']}'"] if "m" in filters else [])
    if isinstance(shown, tuple):
        column, ids = shown
        items = [f"{big(f'sum(numerator) FILTER ({column} = {literal(i)})')} AS \"{i}\"" for i in ids]
    else:
        items = [f"{MEASURES[m]} AS {m}" for m in shown]
    group = f" GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {', '.join([*by, *items])} FROM snapshots WHERE {' AND '.join(where)}{group}", table


def clean_records() -> str:
    found = rules.COMPLETENESS | rules.FIELD_QUALITY
    return f"""SELECT count(*) FILTER (f = 0) AS clean_contacts, count(*) AS active_contacts,
        CAST(count(*) FILTER (f = 0) AS DOUBLE) / count(*) AS clean_record_pct
        FROM (SELECT contact_code, account_no, max(CASE WHEN r.s AND r.i THEN 1 ELSE 0 END) AS f FROM (
            SELECT contact_code, account_no, unnest([{", ".join(f"{{'s': ({s}), 'i': ({i})}}" for s, i in found.values())}]) AS r
            FROM contact_enriched) GROUP BY 1, 2)"""


def quality_index() -> str:
    flags = " OR ".join(f"coalesce(({s}) AND ({i}), false)" for s, i in rules.FIELD_QUALITY.values())
    phone = " OR ".join(
        f"coalesce(regexp_full_match({p}, '1?[2-9][0-9]{{2}}[2-9][0-9]{{6}}'), false)" for p in ("biz_phone", "priv_phone", "mob_phone"))
    zip_ok = (
        "CASE WHEN coalesce(country, 'US') = 'US' THEN coalesce(regexp_full_match(pcode, '[0-9]{5}|[0-9]{5}-[0-9]{4}|[0-9]{9}'), false) "
        "ELSE pcode IS NOT NULL END"
    )
    return f"""SELECT contact_type, count(*) AS contacts, {big("sum(score)")} AS score_sum, CAST(sum(score) AS DOUBLE) / count(*) AS quality_index
        FROM (SELECT contact_type,
            CASE WHEN CASE WHEN contact_type IN ('I', 'C') THEN first_name IS NOT NULL AND last_name IS NOT NULL
                ELSE company_name IS NOT NULL END THEN 25 ELSE 0 END
            + CASE WHEN street IS NOT NULL AND city IS NOT NULL AND length(state) = 2 AND {zip_ok} THEN 25 ELSE 0 END
            + CASE WHEN {phone} OR coalesce(regexp_matches(email, '@.+[.].+'), false) THEN 20 ELSE 0 END
            + CASE WHEN NOT ({flags}) THEN 20 ELSE 0 END
            + CASE WHEN EXISTS (SELECT 1 FROM links x WHERE upper(rtrim(x.cross_ref_number)) = upper(rtrim(contact_code)))
                OR {TIER} IN ('tier_1_strong', 'tier_2_partial') THEN 10 ELSE 0 END AS score
            FROM contact_enriched) GROUP BY 1"""


UNLINKED_CODES = (
    "(SELECT contact_code, contact_type, CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue FROM unlinked "
    "GROUP BY contact_code, contact_type)"
)


def specified() -> dict[str, tuple[str, dict[str, str]] | str]:
    name = "coalesce(company_name, concat_ws(' ', first_name, last_name))"
    keys = [
        ("phone", "biz_phone"), ("phone", "priv_phone"), ("phone", "mob_phone"), ("email", "upper(email)"),
        ("name_place", f"CASE WHEN {name} <> '' AND city IS NOT NULL AND state IS NOT NULL THEN upper({name} || '|' || city || '|' || state) END"),
        ("entity", "CASE WHEN ckc_id <> 999999998 THEN CAST(ckc_id AS VARCHAR) END"),
        ("second_id", "CASE WHEN cmp_ckc_id > 0 AND cmp_ckc_id <> 999999998 THEN CAST(cmp_ckc_id AS VARCHAR) END"),
    ]
    own = " UNION ".join(f"SELECT contact_code, '{k}' AS key_type, {e} AS key_value FROM contact_enriched WHERE {e} IS NOT NULL" for k, e in keys)
    b = path_b()
    return {
        "clean_record_pct": clean_records(),
        "quality_index": quality_index(),
        "parity_sum_check": (
            f"SELECT snapshot_date, {SLICE}, regexp_replace(metric_name, '_(match|mismatch|equip_only|registry_only|both_null)$', '') AS field_name, "
            f"{big('sum(numerator)')} AS outcomes, max(denominator) AS denominator FROM snapshots "
            f"WHERE metric_name NOT IN ({', '.join(literal(p) for p in PRIORITY)}) GROUP BY ALL "
            "HAVING sum(numerator) <> max(denominator)", snapshots(["parity"])),
        "snapshot_delta": (
            f"""SELECT coalesce(a.metric_category, b.metric_category) AS metric_category, coalesce(a.metric_name, b.metric_name) AS metric_name,
            coalesce(a.n, 0) AS numerator_before, coalesce(b.n, 0) AS numerator_after, coalesce(b.n, 0) - coalesce(a.n, 0) AS numerator_delta
            FROM (SELECT metric_category, metric_name, {big("sum(numerator)")} AS n FROM snapshots WHERE snapshot_date = DATE '{HISTORY[-2]}' GROUP BY 1, 2) a
            FULL JOIN (SELECT metric_category, metric_name, {big("sum(numerator)")} AS n FROM snapshots WHERE snapshot_date = DATE '{AS_OF}' GROUP BY 1, 2) b
            ON a.metric_category = b.metric_category AND a.metric_name = b.metric_name""", snapshots(days=[HISTORY[-2], AS_OF])),
        "snapshot_coverage": (
            "SELECT metric_category, metric_name, count(*) AS slices, count(*) FILTER (numerator > 0) AS reached_slices, "
            f"{big('sum(numerator)')} AS total, bool_or(numerator > 0) AS reached FROM snapshots GROUP BY 1, 2", snapshots(days=[AS_OF])),
        "prospect_customer_pairs": """SELECT * FROM (WITH pairs AS (SELECT p.crm_id AS p, c.crm_id AS c, p.comp_entity_id AS entity_id
                FROM crm_account p JOIN crm_account c ON c.erp_entity_id = p.comp_entity_id
                WHERE p.record_type = 'PROSPECT' AND c.record_type = 'CUSTOMER'),
            sizes AS (SELECT entity_id, count(DISTINCT p) AS prospects, count(DISTINCT c) AS customers FROM pairs GROUP BY 1)
            SELECT DISTINCT s.entity_id, 'PROSPECT' AS record_type, p AS crm_id, prospects, customers FROM pairs JOIN sizes s USING (entity_id)
            UNION ALL SELECT DISTINCT s.entity_id, 'CUSTOMER', c, prospects, customers FROM pairs JOIN sizes s USING (entity_id))""",
        "duplicate_candidates": f"""SELECT * FROM (WITH RECURSIVE members AS MATERIALIZED (
                SELECT key_type, key_value, contacts, contact_code, first_code FROM (
                    SELECT *, count(*) OVER k AS contacts, min(contact_code) OVER k AS first_code FROM ({own})
                    WINDOW k AS (PARTITION BY key_type, key_value)) WHERE contacts > 1),
            edges AS MATERIALIZED (
                SELECT contact_code AS a, first_code AS b FROM members UNION SELECT first_code, contact_code FROM members),
            grouped(code, least) USING KEY (code) AS (
                SELECT a, min(b) FROM edges GROUP BY a
                UNION (SELECT e.a, min(g.least) FROM grouped g JOIN edges e ON e.b = g.code JOIN recurring.grouped r ON r.code = e.a
                    WHERE g.least < r.least GROUP BY e.a))
            SELECT key_type, key_value, contacts, contact_code, least AS group_code FROM members JOIN grouped ON code = contact_code)""",
        "upload_batches": f"""SELECT contact_code, contact_type, total_revenue, pos AS upload_position,
            CAST(floor((pos - 1) / 60000) AS BIGINT) + 1 AS batch_no FROM (SELECT *, row_number() OVER (
                ORDER BY total_revenue DESC, contact_code) AS pos FROM {UNLINKED_CODES})""",
        "upload_validation": " UNION ALL ".join(
            f"SELECT '{n}' AS check_name, count(*) FILTER ({t}) AS failed_rows, count(*) AS checked_rows FROM ("
            f"SELECT *, count(*) OVER (PARTITION BY upper(dbs_customer_number)) AS same_code FROM ({b}))"
            for n, t in [
                ("country_not_two_capitals", "NOT regexp_full_match(country_code, '[A-Z]{2}')"),
                ("state_not_two_capitals", "NOT regexp_full_match(state_code, '[A-Z]{2}')"),
                ("blank_in_code", "dbs_customer_number LIKE '% %'"), ("repeated_code", "same_code > 1"),
            ]),
        "match_type_alignment": f"""SELECT contact_type, match_level, count(*) AS matches,
            match_level = CASE WHEN contact_type = 'C' THEN 'contact' ELSE 'entity' END AS aligned FROM (
                SELECT c.contact_type, CASE WHEN coalesce(t.contact_id, '0') = '0' THEN 'entity' ELSE 'contact' END AS match_level
                FROM tight_match t JOIN contact c ON upper(rtrim(c.contact_code)) = upper(rtrim(t.dbs_number))) GROUP BY 1, 2""",
        "contact_extract": """SELECT contact_code, contact_type, CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue,
            count(*) AS accounts, min(account_no) AS account_no, arg_min_null(branch, account_no) AS branch,
            min(creation_date) AS creation_date FROM unlinked
            WHERE creation_date >= DATE '2016-01-01' AND account_no IS NOT NULL GROUP BY 1, 2
            ORDER BY total_revenue DESC, contact_code LIMIT 500""",
        "path_delete_extract": """SELECT DISTINCT c.contact_code AS dbs_number FROM contact c WHERE c.inactive_indicator = 'I' AND EXISTS (
            SELECT 1 FROM xref x WHERE x.source_desc = 'DEALER XREF' AND upper(rtrim(x.cross_ref_number)) = upper(rtrim(c.contact_code)))""",
        "inactivation_candidates": """SELECT contact_code, account_no, branch, creation_date, last_tx_date FROM contact_enriched
            WHERE last_tx_date <= DATE '1999-08-15' AND (creation_date IS NULL OR creation_date < DATE '2020-01-01')""",
        "unlinked_recent_invoice": """SELECT u.contact_code, u.contact_type, u.account_no, max(CAST(i.invo_datetime AS DATE)) AS last_invoice_date
            FROM unlinked u JOIN invoice i ON i.bill_to_acc = u.account_no GROUP BY 1, 2, 3""",
        "linkage_progress": (
            f"SELECT snapshot_date, {total('numerator', 'linked_count')} AS linked, {total('numerator', 'unlinked_count')} AS unlinked "
            "FROM snapshots GROUP BY 1", snapshots(["linkage"])),
    }


def reports() -> dict[str, tuple[str, dict[str, str]] | str]:
    latest = snapshots(days=[AS_OF])
    found: dict = {
        f"measure_{m}": (f"SELECT {MEASURES[m]} AS {m} FROM snapshots", latest)
        for m in ("issue_rate", "issue_count", "record_count", "pct_linked", "stale_5yr", "match_ready")
    }
    found["measure_issue_rate_issues_only"] = (
        f"SELECT {MEASURES['issue_rate']} AS issue_rate FROM snapshots WHERE metric_name <> 'linked_count' AND "
        "metric_category NOT IN ('staleness', 'match_readiness') AND (metric_category <> 'parity' OR "
        "NOT regexp_matches(metric_name, '_(match|both_null)$'))", latest)
    found |= {f"rpt_{n}": visual(n) for n in REPORTS}
    found["rpt_2"] = clean_records()
    return found


def named_files() -> str:
    work = linkage_work()
    parts = [("match-upload", path_b(), "dbs_customer_number"), ("agree", work["split_agree"], "dbs_number"),
             ("disagree", work["split_disagree"], "dbs_number")]
    return " UNION ALL ".join(
        f"SELECT '{stem}-' || file_no || '-{AS_OF:%Y%m%d}-000000.csv' AS file_name, count(*) AS row_count, min({key}) AS first_code, "
        f"max({key}) AS last_code FROM (SELECT {key}, (row_number() OVER (ORDER BY {key}) - 1) // 100 + 1 AS file_no FROM ({sql})) GROUP BY file_no"
        for stem, sql, key in parts)


def weekly() -> str:
    none = "CAST(NULL AS BIGINT) AS total"
    lookups = [(n, len(rows)) for n, rows in DIMENSION_IDS.items()] + [("dim_metric", len(METRICS))]
    return " UNION ALL ".join([
        f"SELECT 'snapshot' AS target, snapshot_date, metric_category AS name, count(*) AS row_count, {big('sum(numerator)')} AS total "
        f"FROM ({union(section(c, d) for d in HISTORY[-2:] for c in CATEGORIES)}) GROUP BY 2, 3",
        f"SELECT 'issue map', snapshot_date, metric_name, count(*), {none} FROM ({issue_map()}) GROUP BY 2, 3",
        *(f"SELECT 'lookup', CAST(NULL AS DATE), '{n}', {rows}, {none}" for n, rows in lookups),
    ])


def io() -> dict[str, str]:
    work = linkage_work()
    return {
        "io_named_files": named_files(),
        "io_weekly_run": weekly(),
        "io_append_roundtrip": union(section("linkage", d) for d in HISTORY[-2:]),
        "io_overwrite_roundtrip": union(section("completeness", d) for d in HISTORY[-2:]),
        "io_csv_roundtrip": "SELECT dbs_number, CAST(entity_id AS VARCHAR) AS entity_id, coalesce(CAST(contact_id AS VARCHAR), '') AS contact_id "
            f"FROM ({work['path_a_extract']})",
        "io_match_reports": RECONCILED,
        "io_exclusion_file": split("AGREE"),
        "io_upload_files": f"""SELECT CAST((pos - 1) // 200 + 1 AS INTEGER) AS batch_no, count(*) AS contacts, min(pos) AS first_position,
            max(pos) AS last_position, CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue
            FROM (SELECT *, row_number() OVER (ORDER BY total_revenue DESC, contact_code) AS pos FROM {UNLINKED_CODES})
            GROUP BY 1""",
        "io_dimension_roundtrip": dimension("dim_contact_type", "contact_type", "contact_enriched"),
        "io_sql_scan": "SELECT contact_type, count(*) AS contacts, count(ckc_id) AS with_id FROM contact GROUP BY 1",
    }


def all_sql() -> dict[str, str]:
    found = {
        **stages(), **metrics(), **profiling(), **linkage_work(), **stored(), **reports(), **specified(), **io(),
    }
    return {
        name: with_relations(*sql) if isinstance(sql, tuple) else with_relations(sql) for name, sql in found.items()
    }
