"""Input relations derived from the test tables (see FIXTURES.md).

The test tables hold no contact data, so every input relation is a fixed
projection of ``customer``, ``supplier``, ``orders`` and ``lineitem``.
The expressions are plain SQL shared by Spark and the DuckDB check, so that a
difference between the two engines points at the operator under test.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from linkledger.functions.lists import UNIT_COSTS
from linkledger.sources.readers import without_padding

BASE_TABLES = ("customer", "supplier", "orders", "lineitem")

# Spellings that differ between the two engines.
SPARK = {
    "ts": "TIMESTAMP_NTZ",
    "levels": "LATERAL VIEW explode(array(0, 1, 2)) v AS lvl",
}
DUCKDB = {
    "ts": "TIMESTAMP",
    "levels": "CROSS JOIN (VALUES (0), (1), (2)) v(lvl)",
}

def nameless(value: str) -> str:
    """Some contacts have a name and nothing else."""
    return f"CASE WHEN c_custkey % 57 = 3 THEN NULL ELSE {value} END"


def quiet(customer: str, day: str) -> str:
    """Some customers have been quiet for two to more than five years."""
    steps = " ".join(f"WHEN {n} THEN {day} - INTERVAL '{days}' DAY" for n, days in ((4, 800), (5, 1200), (6, 1550), (7, 2000)))
    return f"CASE {customer} % 17 {steps} ELSE {day} END"


# relation -> (FROM clause, [(column, expression)])
RELATIONS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "contact": (
        "customer c",
        [
            ("k", "c_custkey"),
            ("contact_code", "concat(CASE WHEN c_custkey % 101 = 1 THEN 'cust' WHEN c_custkey % 2 = 0 THEN 'Cust' ELSE 'CUST' END, CASE WHEN c_custkey % 97 = 2 THEN ' ' WHEN c_custkey % 89 = 3 THEN '-' ELSE '' END, lpad(CAST(CASE WHEN c_custkey % 101 = 1 THEN c_custkey - 1 ELSE c_custkey END AS STRING), 7, '0'))"),
            ("contact_type", "CASE c_custkey % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'C' ELSE 'I' END"),
            ("inactive_indicator", "CASE WHEN c_custkey % 11 = 10 THEN 'I' WHEN c_custkey % 7 = 0 THEN NULL ELSE 'A' END"),
            ("inactive_reason", "CASE WHEN c_custkey % 11 <> 10 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Deceased' WHEN c_custkey % 3 = 1 THEN 'Out of Business' ELSE 'Other' END"),
            ("creation_date", "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE DATE '2012-01-15' + CAST((c_custkey * 37) % 5200 AS INT) END"),
            ("ckc_id", "CASE WHEN c_custkey % 499 = 7 THEN 999999998 WHEN c_custkey % 4 = 3 THEN NULL ELSE 500000000 + c_custkey END"),
            ("cmp_ckc_id", "CASE WHEN c_custkey % 5 <> 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE NULL END WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 0 WHEN c_custkey % 30 = 26 THEN 699999985 + c_custkey ELSE 700000000 + c_custkey END"),
            ("first_name", "CASE c_custkey % 29 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'Firstname' WHEN 3 THEN 'XXXX' WHEN 4 THEN '1234' WHEN 5 THEN 'Mr. Ann' WHEN 6 THEN 'John & Mary' WHEN 7 THEN 'Billy (Joe)' WHEN 8 THEN 'Deceased' WHEN 9 THEN 'Test' WHEN 10 THEN 'dr bob' ELSE concat(' Fn', CAST(c_custkey % 211 AS STRING), ' ') END"),
            ("last_name", "CASE c_custkey % 31 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'LNAME' WHEN 3 THEN '.....' WHEN 4 THEN 'Smith Jr.' WHEN 5 THEN 'Jones III' WHEN 6 THEN 'Do Not Use' WHEN 7 THEN '77' ELSE concat('Ln', CAST(c_custkey % 307 AS STRING)) END"),
            ("company_name", "CASE WHEN c_custkey % 5 > 1 AND c_custkey % 17 <> 0 THEN NULL WHEN c_custkey % 19 = 0 THEN ' ' WHEN c_custkey % 23 = 1 THEN 'Acme DBA Widgets' WHEN c_custkey % 23 = 2 THEN 'N/A' WHEN c_custkey % 23 = 3 THEN 'Farm OOB Supply' WHEN c_custkey % 23 = 4 THEN '999' WHEN c_custkey % 23 = 5 THEN 'ZZZ' ELSE concat('Co ', c_mktsegment, ' ', CAST(c_custkey % 401 AS STRING)) END"),
            ("street", nameless("CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'n/a' WHEN 3 THEN 'CLOSED 2 Elm' WHEN 4 THEN 'c/o Bob 5 Elm' WHEN 5 THEN 'Attn: Desk' ELSE concat(CAST(c_custkey % 900 + 1 AS STRING), ' Main St') END")),
            ("city", nameless("CASE c_custkey % 21 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown' WHEN 2 THEN '' ELSE concat('City', CAST(c_nationkey AS STRING)) END")),
            ("state", nameless("CASE c_custkey % 25 WHEN 0 THEN NULL WHEN 1 THEN 'Iowa' WHEN 2 THEN 'XX' WHEN 3 THEN 'zz' ELSE CASE WHEN c_nationkey % 2 = 0 THEN 'KY' ELSE 'TN' END END")),
            ("pcode", nameless("CASE c_custkey % 27 WHEN 0 THEN NULL WHEN 1 THEN '4210' WHEN 2 THEN '42101-1234' WHEN 3 THEN '421011234' WHEN 4 THEN 'K1A 0B1' WHEN 5 THEN NULL ELSE lpad(CAST(40000 + c_custkey % 3000 AS STRING), 5, '0') END")),
            ("country", "CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'USA' WHEN 3 THEN 'CA' ELSE 'US' END"),
            ("biz_phone", nameless("CASE c_custkey % 15 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '1234567890' WHEN 3 THEN '0000000000' WHEN 4 THEN '5551234' WHEN 5 THEN concat('1', CAST(2702005555 + c_custkey AS STRING)) ELSE CAST(2702005555 + c_custkey AS STRING) END")),
            ("priv_phone", nameless("CASE WHEN c_custkey % 3 = 1 THEN NULL WHEN c_custkey % 14 = 1 THEN '1112223333' WHEN c_custkey % 28 = 2 THEN '0000000000' WHEN c_custkey % 28 = 4 THEN '1234567890' WHEN c_custkey % 28 = 5 THEN '555123' WHEN c_custkey % 28 = 10 THEN '0152005555' WHEN c_custkey % 28 = 11 THEN '8888888888' ELSE CAST(6152005555 + c_custkey AS STRING) END")),
            ("mob_phone", nameless("CASE WHEN c_custkey % 4 <> 0 THEN NULL WHEN c_custkey % 16 = 0 THEN '5555555555' WHEN c_custkey % 48 = 4 THEN '1234567890' WHEN c_custkey % 48 = 8 THEN '0000000000' WHEN c_custkey % 48 = 20 THEN '93120' WHEN c_custkey % 48 = 28 THEN '0312005555' ELSE CAST(9312005555 + c_custkey AS STRING) END")),
            ("email", nameless("CASE c_custkey % 12 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'NoEmail@x.com' WHEN 3 THEN 'bad.at.example' WHEN 4 THEN 'user@nodot' WHEN 5 THEN 'emp@internal.example' WHEN 6 THEN NULL ELSE concat('User', CAST(c_custkey AS STRING), '@mail.example.com') END")),
            ("title", "CASE c_custkey % 6 WHEN 0 THEN 'Mr.' WHEN 1 THEN ' ms ' WHEN 2 THEN 'Farmer' ELSE NULL END"),
            ("generation", "CASE c_custkey % 33 WHEN 0 THEN 'Jr' WHEN 1 THEN 'III' WHEN 2 THEN '3rd' ELSE NULL END"),
            ("suffix", "CASE c_custkey % 35 WHEN 0 THEN 'MD' WHEN 1 THEN '123 Main St' ELSE NULL END"),
            ("doing_business_as", "CASE WHEN c_custkey % 10 = 1 THEN concat('Shop ', CAST(c_custkey % 90 AS STRING)) ELSE NULL END"),
            ("familiar_name", "CASE WHEN c_custkey % 7 = 2 THEN concat('Fam', CAST(c_custkey % 40 AS STRING)) ELSE NULL END"),
            ("middle_name", "CASE WHEN c_custkey % 12 = 9 THEN 'M' ELSE NULL END"),
            ("street_2", "CASE WHEN c_custkey % 11 = 4 THEN 'Unit 3' ELSE NULL END"),
            ("fax", "CASE WHEN c_custkey % 8 = 0 THEN CAST(8002005555 + c_custkey AS STRING) ELSE NULL END"),
        ],
    ),
    "account": (
        "contact c {levels} WHERE c.k % 13 <> 0 AND (v.lvl = 0 OR (v.lvl = 1 AND c.k % 23 = 4) OR (v.lvl = 2 AND c.k % 50 = 3))",
        [
            ("account_no", "c.k + 100000 + v.lvl * 10000000"),
            ("bill_to_acc", "CASE WHEN c.k % 499 = 0 THEN c.k + 99999 ELSE c.k + 100000 END + v.lvl * 10000000"),
            ("contact_code", "CASE WHEN v.lvl = 2 THEN 'Cust0000004' WHEN c.k % 6 = 1 THEN rpad(c.contact_code, 15, ' ') ELSE c.contact_code END"),
            ("branch", "CASE WHEN c.k % 17 = 0 THEN ' ' ELSE lpad(CAST((c.k * 7 + v.lvl) % 73 AS STRING), 2, '0') END"),
        ],
    ),
    "vendor": (
        "supplier s JOIN contact c ON c.k = s.s_suppkey * 13 + CASE WHEN s.s_suppkey % 10 = 0 THEN 1 ELSE 0 END",
        [
            ("vendor_no", "s.s_suppkey"),
            ("contact_code", "c.contact_code"),
        ],
    ),
    "technician": (
        "supplier s JOIN contact c ON c.k = s.s_suppkey * 7 + 3 WHERE s.s_suppkey % 5 = 0",
        [
            ("code", "CASE WHEN s.s_suppkey % 2 = 0 THEN rpad(c.contact_code, 15, ' ') ELSE c.contact_code END"),
            ("is_terminated", "CASE WHEN s.s_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END"),
        ],
    ),
    "salesperson": (
        "supplier s JOIN contact c ON c.k = s.s_suppkey * 11 + 5 WHERE s.s_suppkey % 4 = 1",
        [
            ("code", "c.contact_code"),
            ("is_terminated", "CASE WHEN s.s_suppkey % 3 = 0 THEN 'Y' ELSE 'N' END"),
        ],
    ),
    "linked_contact": (
        "contact WHERE k % 3 <> 0",
        [
            ("*", "*"),
            ("link_entity_id", "CASE WHEN k % 997 = 5 THEN 999999998 WHEN k % 10 = 5 THEN CASE WHEN (k - 1) % 2 = 0 THEN 100000000 ELSE 300000000 END + k - 1 WHEN k % 2 = 0 THEN 100000000 + k WHEN k % 4 = 1 THEN 300000000 + k ELSE 500000000 + k END"),
            ("link_contact_id", "CASE WHEN contact_type = 'C' THEN CASE k % 3 WHEN 1 THEN 0 ELSE 700000000 + k END WHEN k % 26 = 4 THEN 700000000 + k WHEN k % 26 = 7 THEN NULL ELSE 0 END"),
        ],
    ),
    "xref_linked": (
        "linked_contact",
        [
            ("k", "k"),
            ("entity_id", "link_entity_id"),
            ("contact_id", "link_contact_id"),
            ("cross_ref_number", "CASE WHEN k % 8 = 1 THEN rpad(upper(contact_code), 15, ' ') ELSE upper(contact_code) END"),
            ("source_desc", "CASE WHEN k % 23 = 0 THEN 'THIRD PARTY BUYERS' ELSE 'DEALER XREF' END"),
            ("dealer_id", "'120'"),
            ("created_ts", "CASE WHEN k % 29 = 0 THEN NULL ELSE CAST(DATE '2001-05-01' + CAST((k * 11) % 100 AS INT) AS {ts}) END"),
        ],
    ),
    "xref": (
        "(SELECT entity_id, contact_id, cross_ref_number, source_desc, dealer_id, created_ts FROM xref_linked UNION ALL SELECT 300900000 + s_suppkey, 0, concat('ORPHAN', CAST(s_suppkey AS STRING)), CASE WHEN s_suppkey % 3 = 0 THEN 'THIRD PARTY BUYERS' ELSE 'DEALER XREF' END, '120', NULL FROM supplier) x",
        [
            ("entity_id", "entity_id"),
            ("contact_id", "contact_id"),
            ("cross_ref_number", "cross_ref_number"),
            ("source_desc", "source_desc"),
            ("dealer_id", "dealer_id"),
            ("created_ts", "created_ts"),
        ],
    ),
    "profile": (
        "linked_contact c {levels} WHERE c.k % 10 <> 5 AND c.k % 43 <> 2 AND (v.lvl = 0 OR (v.lvl = 1 AND c.link_contact_id <> 0) OR (v.lvl = 2 AND (c.k % 31 = 1 OR c.k % 37 = 2)))",
        [
            ("entity_id", "c.link_entity_id"),
            ("contact_id", "CASE WHEN v.lvl = 1 THEN c.link_contact_id ELSE 0 END"),
            ("source_desc", "CASE WHEN v.lvl = 2 AND c.k % 31 = 1 THEN 'THIRD PARTY BUYERS' ELSE 'DEALER XREF' END"),
            ("reg_company_name", "CASE WHEN c.k % 6 = 0 THEN NULL ELSE upper(c.company_name) END"),
            ("reg_first_name", "CASE WHEN c.k % 8 = 0 THEN NULL WHEN c.k % 8 = 1 THEN 'Other' ELSE upper(c.first_name) END"),
            ("reg_last_name", "CASE WHEN c.k % 8 = 2 THEN ' ' WHEN c.k % 31 = 0 THEN 'KEPT' ELSE upper(c.last_name) END"),
            ("reg_email", "CASE WHEN c.k % 7 = 0 THEN 'reg@mail.example.com' WHEN c.k % 13 = 5 THEN NULL ELSE lower(c.email) END"),
            ("reg_biz_area", "CASE WHEN length(c.biz_phone) = 10 THEN substring(c.biz_phone, 1, 3) ELSE NULL END"),
            ("reg_biz_num", "CASE WHEN c.k % 30 = 1 THEN '2005555' WHEN length(c.biz_phone) = 10 AND c.k % 5 <> 0 THEN substring(c.biz_phone, 4, 7) ELSE NULL END"),
            ("reg_priv_area", "CASE WHEN c.k % 2 = 0 THEN '615' ELSE NULL END"),
            ("reg_priv_num", "CASE WHEN c.k % 2 = 0 THEN substring(c.priv_phone, 4, 7) ELSE NULL END"),
            ("reg_mob_area", "CASE WHEN c.k % 8 = 4 THEN substring(c.mob_phone, 1, 3) ELSE NULL END"),
            ("reg_mob_num", "CASE WHEN c.k % 8 = 4 THEN substring(c.mob_phone, 4, 7) WHEN c.k % 4 = 1 THEN '2005555' ELSE NULL END"),
            ("reg_street", "CASE WHEN c.k % 7 = 1 THEN '1 New Rd' WHEN c.k % 11 = 4 THEN NULL ELSE upper(c.street) END"),
            ("reg_city", "CASE WHEN c.k % 9 = 1 THEN 'ELSEWHERE' WHEN c.k % 9 = 4 THEN NULL ELSE upper(c.city) END"),
            ("reg_state", "CASE WHEN c.k % 9 = 2 THEN NULL ELSE c.state END"),
            ("reg_pcode", "CASE WHEN c.k % 12 = 7 OR c.pcode IS NULL THEN NULL WHEN c.k % 2 = 0 THEN concat(substring(c.pcode, 1, 5), '-0001') ELSE c.pcode END"),
            ("reg_country", "CASE WHEN c.k % 10 = 1 THEN NULL ELSE 'US' END"),
            ("postal_certified", "CASE WHEN c.k % 3 = 1 THEN 'CERTIFIED' WHEN c.k % 7 = 0 THEN 'NO MATCH' ELSE NULL END"),
            ("phys_undeliverable", "CASE WHEN c.k % 37 = 1 THEN 'Y' ELSE 'N' END"),
            ("mail_undeliverable", "CASE WHEN c.k % 39 = 1 THEN 'Y' ELSE NULL END"),
            ("out_of_business", "CASE WHEN v.lvl = 2 THEN 'Y' WHEN c.k % 20 = 10 THEN 'Y' WHEN c.k % 20 = 5 THEN NULL ELSE 'N' END"),
            ("deceased", "CASE WHEN c.k % 22 = 1 THEN 'Y' ELSE 'N' END"),
        ],
    ),
    "invoice": (
        "orders WHERE o_custkey % 19 <> 0",
        [
            ("document_no", "o_orderkey"),
            ("bill_to_acc", "o_custkey + 100000"),
            ("invo_type", "CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'C' ELSE 'X' END"),
            ("module_type", "CASE o_orderkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'W' ELSE 'R' END"),
            ("invo_datetime", f"{quiet('o_custkey', 'o_orderdate')} + INTERVAL '14' HOUR"),
            ("parts_sale", "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END"),
            ("labour_sale", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 5000 AS DECIMAL(12,2)) END"),
            ("sublet_sale", "CAST(o_orderkey % 70 AS DECIMAL(12,2))"),
            ("other_sale", "CASE WHEN o_orderkey % 6 = 0 THEN CAST(-25 AS DECIMAL(12,2)) ELSE NULL END"),
            ("parts_cost", "CAST(o_orderkey % 900 AS DECIMAL(12,2))"),
            ("labour_cost", "CAST(o_orderkey % 300 AS DECIMAL(12,2))"),
            ("sublet_cost", "CAST(o_orderkey % 50 AS DECIMAL(12,2))"),
        ],
    ),
    "unit_sale": (
        "lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN contact c ON c.k = o.o_custkey WHERE l.l_linenumber % 2 = 1 AND o.o_custkey % 19 <> 0",
        [
            ("unit_no", "l.l_orderkey * 10 + l.l_linenumber"),
            ("owner_code", "c.contact_code"),
            ("sales_date", f"CASE WHEN l.l_suppkey % 50 = 0 THEN NULL ELSE {quiet('o.o_custkey', 'l.l_shipdate')} END"),
            ("sales_value", "CASE WHEN l.l_partkey % 9 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END"),
            ("wholesale", "CAST(l.l_partkey AS DECIMAL(12,2))"),
            ("repair_cost", "CASE WHEN l.l_partkey % 2 = 0 THEN CAST(l.l_suppkey AS DECIMAL(12,2)) ELSE NULL END"),
            *((name, f"CASE WHEN l.l_partkey % {n} = 0 THEN CAST(l.l_suppkey % {n + 20} AS DECIMAL(12,2)) ELSE NULL END")
              for n, name in enumerate((c for c in UNIT_COSTS if c not in ("wholesale", "repair_cost")), start=3)),
        ],
    ),
    "unit_accessory": (
        "lineitem WHERE l_linenumber % 2 = 1 AND l_returnflag = 'R'",
        [
            ("unit_no", "l_orderkey * 10 + l_linenumber"),
            ("sale_value", "CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(12,2)) END"),
        ],
    ),
    "rental": (
        "lineitem WHERE l_linenumber % 2 = 0",
        [
            ("invoice_no", "l_orderkey"),
            ("rental_value", "CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END"),
            ("depr_book_value", "CAST(l_quantity AS DECIMAL(12,2))"),
        ],
    ),
    "crm_account": (
        "contact",
        [
            ("crm_id", "concat('CRM', CAST(k AS STRING))"),
            ("account_no", "CASE WHEN k % 12 = 11 THEN NULL ELSE k + 100000 END"),
            ("record_type", "CASE WHEN k % 12 = 11 THEN 'PROSPECT' WHEN k % 301 = 2 THEN 'OTHER' ELSE 'CUSTOMER' END"),
            ("comp_entity_id", "CASE WHEN k % 12 = 11 THEN 100000000 + k - 1 WHEN k % 6 = 0 THEN 100000000 + k WHEN k % 6 = 3 THEN 300000000 + k ELSE NULL END"),
            ("erp_entity_id", "CASE WHEN k % 12 = 11 OR k % 3 = 0 THEN NULL WHEN k % 50 = 1 THEN 123 WHEN k % 2 = 0 THEN 100000000 + k WHEN k % 4 = 1 THEN 300000000 + k ELSE 500000000 + k END"),
        ],
    ),
    "tight_match": (
        "contact c {levels} WHERE c.k % 3 = 0 AND c.k % 4 <> 1 AND (v.lvl = 0 OR (v.lvl = 1 AND c.k % 33 = 0))",
        [
            ("dbs_number", "lower(c.contact_code)"),
            ("entity_id", "CAST(CASE WHEN c.k % 30 = 0 THEN 999 ELSE CASE WHEN c.k % 6 = 0 THEN 100000000 ELSE 300000000 END + c.k END AS STRING)"),
            ("contact_id", "CASE WHEN c.k % 15 = 6 THEN CAST(700000000 + c.k AS STRING) ELSE '0' END"),
        ],
    ),
}


def select_text(name: str, dialect: dict[str, str]) -> str:
    """SELECT statement of one input relation in one engine's spelling."""
    source, columns = RELATIONS[name]
    items = ", ".join(c if c == e else f"{e} AS {c}" for c, e in columns)
    text = f"SELECT {items} FROM {source}"
    for key, value in dialect.items():
        text = text.replace("{" + key + "}", value)
    return text


def _inputs_of(text: str) -> list[str]:
    names = [*BASE_TABLES, *RELATIONS]
    return [n for n in names if re.search(rf"(FROM|JOIN) {n}\b", text)]


class FixtureTables:
    """Resolves relation names to DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def paths(self) -> list[str]:
        return [f"{self.folder}/{t}.parquet" for t in BASE_TABLES]

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = select_text(name, SPARK)
        inputs = _inputs_of(text)
        for n in inputs:
            text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
        return without_padding(self.spark.sql(text, **{n: self.table(n) for n in inputs}), name)
