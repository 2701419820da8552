"""Hot keys: results stay whole, and no group is gathered or paired."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from linkledger.config import Settings
from linkledger.functions import lists
from linkledger.operators import extracts, groups, issues, population, profiling, quality, revenue, sections

SETTINGS = Settings(as_of=dt.date(2001, 8, 15))


@pytest.fixture()
def hot(spark):
    """300 links, a third of them on one code and a third on one entity; codes in mixed case."""
    contact = spark.createDataFrame(
        [(f"C{i:03d}" if i % 2 else f"c{i:03d}", "BCI"[i % 3], i, None if i % 4 else 0) for i in range(120)],
        "contact_code string, contact_type string, ckc_id bigint, cmp_ckc_id bigint",
    )
    links = [(1000 + i, i % 2, "C001", "DEALER XREF") for i in range(100)]
    links += [(5, 0, f"C{i % 60:03d}", "DEALER XREF") for i in range(100)]
    links += [(2000 + i, None, f"C{i % 130:03d}", "DEALER XREF") for i in range(100)]
    xref = spark.createDataFrame(links, "entity_id bigint, contact_id bigint, cross_ref_number string, source_desc string")
    return contact, xref, links


def test_shared_entities_without_pairing(spark, hot):
    contact, xref, links = hot
    keyed = contact.withColumn("code_key", F.upper("contact_code"))
    kept = population.source_links(xref, SETTINGS)
    codes = {r[0].upper(): r[0] for r in contact.select("contact_code").collect()}
    members = Counter(e for e, _, code, _ in links if code in codes)
    shared = {e for e, n in members.items() if n > 1}
    expected = {codes[code] for e, _, code, _ in links if e in shared and code in codes}
    got = [r["contact_code"] for r in issues.shared_entity_issues(keyed, kept).collect()]
    assert sorted(got) == sorted(expected)

    rows = {r["metric_name"]: (r["numerator"], r["denominator"]) for r in sections.linkage_overall(keyed, kept).collect()}
    orphans = sum(1 for _, _, code, _ in links if code not in codes)
    assert rows == {"duplicate_entity_id": (len(shared), len(members)), "orphan_cross_ref": (orphans, len(links))}


def test_linkage_keeps_all_rows(hot):
    contact, xref, links = hot
    keyed = contact.selectExpr(
        "*", "upper(contact_code) AS code_key", "'D1' AS sales_decile", "'0-1yr' AS staleness_bucket",
        "cast(NULL AS string) AS branch", "'Unknown' AS creation_cohort",
    )
    kept = population.source_links(xref, SETTINGS)
    per_code = Counter(code for _, _, code, _ in links)
    codes = [r[0].upper() for r in contact.select("contact_code").collect()]
    linkage = population.contact_linkage(keyed, kept)
    assert linkage.count() == sum(max(1, per_code[c]) for c in codes)
    assert linkage.filter("is_linked = 0").count() == sum(1 for c in codes if not per_code[c])

    rows = sections.linkage_by_slice(population.with_link_counts(keyed, kept)).groupBy("metric_name").agg(
        F.sum("numerator").alias("n"), F.sum("denominator").alias("d")).collect()
    totals = {r["metric_name"]: (r["n"], r["d"]) for r in rows}
    assert totals["linked_count"] == (linkage.filter("is_linked = 1").count(), linkage.count())


def test_entity_list_by_member(hot, stage):
    contact, xref, links = hot
    codes = {r[0].upper() for r in contact.select("contact_code").collect()}
    expected = defaultdict(list)
    for e, _, code, _ in links:
        if code in codes:
            expected[e].append(code)
    expected = {e: sorted(c) for e, c in expected.items() if len(c) > 1}
    got = defaultdict(list)
    for r in profiling.duplicate_entity_list(contact, xref, stage).orderBy("entity_id", "member_no").collect():
        got[r["entity_id"]].append(r["cross_ref_number"])
        assert r["member_no"] == len(got[r["entity_id"]]) and r["dbs_count"] == len(expected[r["entity_id"]])
    assert got == expected


@pytest.mark.parametrize("members", [1000, 1001, 100_000])
def test_one_form_at_every_size(spark, stage, members):
    contact = spark.range(members).selectExpr(
        "concat('C', id) AS contact_code", "if(id % 2 = 0, 'B', 'I') AS contact_type", "id AS ckc_id", "id AS cmp_ckc_id")
    xref = contact.selectExpr("cast(7 AS bigint) AS entity_id", "cast(0 AS bigint) AS contact_id", "contact_code AS cross_ref_number")
    assert [tuple(r) for r in profiling.duplicate_type_combo(contact, xref).collect()] == [
        (f"B:{(members + 1) // 2}+I:{members // 2}", 1)]
    listed = profiling.duplicate_entity_list(contact, xref, stage)
    assert listed.columns == ["entity_id", "dbs_count", "member_no", "contact_type", "cross_ref_number"]
    sizes = listed.selectExpr("count(*)", "min(member_no)", "max(member_no)", "count(DISTINCT member_no)").first()
    assert tuple(sizes) == (members, 1, members, members)


def test_hot_account_code_and_vendors(spark):
    """One code owns very many accounts; a vendor stays only if it has an account."""
    contact = spark.createDataFrame([(f"C{i}", "A") for i in range(6)], "contact_code string, inactive_indicator string")
    none = spark.createDataFrame([("C5",)], "code string")
    account = spark.range(3000).selectExpr("if(id < 2990, 'C1', 'C2') AS contact_code", "id AS account_no", "'07' AS branch")
    vendor = spark.createDataFrame([("C2",), ("C3",)], "contact_code string")
    got = population.customers_and_leads(contact, none, none, account, vendor).groupBy("contact_code").count().collect()
    assert {r[0]: r[1] for r in got} == {"C0": 1, "C1": 2990, "C2": 10, "C4": 1}


def test_agreement_of_a_code_with_many_entities(spark):
    contact = spark.createDataFrame([(f"C{i}", "B", 1) for i in range(3)], "contact_code string, contact_type string, ckc_id bigint")
    account = spark.createDataFrame([(i, f"C{i}") for i in range(3)], "account_no bigint, contact_code string")
    crm = spark.createDataFrame([(f"R{i}", i % 3, "CUSTOMER", 100) for i in range(9)], "crm_id string, account_no bigint, record_type string, erp_entity_id bigint")
    xref = spark.range(500).selectExpr("if(id % 3 = 0, 'C0', 'C1') AS cross_ref_number", "CASE WHEN id < 490 THEN id END AS entity_id")
    got = profiling.crm_xref_agreement(crm, account, contact, xref, SETTINGS).first()
    c0 = [i if i < 490 else None for i in range(500) if i % 3 == 0]
    c1 = [i if i < 490 else None for i in range(500) if i % 3]
    links = 3 * (c0 + c1)
    assert got["customers_with_erp_id"] == len(links) + 3
    assert got["ids_agree"] == links.count(100) and got["no_cross_ref_found"] == links.count(None) + 3
    assert got["ids_disagree"] == len(links) - links.count(100) - links.count(None)


def test_repeated_registry_rows(spark):
    contact = spark.createDataFrame([("C1", "B", 5, None, "A")], "contact_code string, contact_type string, ckc_id bigint, cmp_ckc_id bigint, inactive_indicator string")
    xref = spark.createDataFrame([("X", 1)], "cross_ref_number string, entity_id bigint")
    profile = spark.range(2000).selectExpr(
        "cast(5 AS bigint) AS entity_id", "cast(0 AS bigint) AS contact_id", "'DEALER XREF' AS source_desc",
        "if(id = 7, 'Y', 'N') AS out_of_business", "cast(NULL AS string) AS deceased")
    rows = extracts.path_a_validation(contact, xref, profile, SETTINGS).collect()
    assert len(rows) == 1 and rows[0]["entity_out_of_business"] == "Y"


def test_hot_account_revenue(spark):
    """A third of the invoices on one account, one unit sold often, and a rental-heavy invoice."""
    account = spark.createDataFrame([(i, f"C{i}", i) for i in range(10)], "account_no bigint, contact_code string, bill_to_acc bigint")
    day = dt.datetime(2000, 1, 1, 14)
    bills = [(i, 1 if i % 3 == 0 else i % 10, "I" if i % 2 else "C", "IWR"[i % 3], day, 10, 2, 1, None, 1, 1, 1) for i in range(300)]
    money = ", ".join(f"{c} decimal(12,2)" for c in (
        "parts_sale", "labour_sale", "sublet_sale", "other_sale", "parts_cost", "labour_cost", "sublet_cost"))
    from decimal import Decimal
    invoice = spark.createDataFrame(
        [(*b[:5], *(None if v is None else Decimal(v) for v in b[5:])) for b in bills],
        f"document_no bigint, bill_to_acc bigint, invo_type string, module_type string, invo_datetime timestamp_ntz, {money}")
    rental = spark.createDataFrame(
        [(3, Decimal(2), Decimal(1))] * 50 + [(7, None, Decimal(1))],
        "invoice_no bigint, rental_value decimal(12,2), depr_book_value decimal(12,2)")
    unit = spark.createDataFrame(
        [(1, f"C{i % 2}", day, Decimal(100)) for i in range(30)] + [(2, "C5", None, Decimal(9))],
        "unit_no bigint, owner_code string, sales_date timestamp_ntz, sales_value decimal(12,2)")
    unit = unit.selectExpr("*", *(f"cast(NULL AS decimal(12,2)) AS {c}" for c in lists.UNIT_COSTS))
    accessory = spark.createDataFrame([(1, Decimal(5)), (1, None), (1, Decimal(6))], "unit_no bigint, sale_value decimal(12,2)")

    expected = defaultdict(int)
    for no, acc, _, module, *_ in bills:
        expected[acc] += {"I": 10, "W": 13, "R": 0}[module] + (100 if no == 3 else 0)
    for acc in (0, 1):
        expected[acc] += 15 * 100 + 11
    tables = (account, unit, accessory, invoice, rental)
    start, end = dt.date(1996, 8, 1), dt.date(2001, 7, 31)
    got = {r["account_no"]: int(r["total_revenue"]) for r in revenue.account_revenue(*tables, start, end).collect()}
    assert got == {k: v for k, v in expected.items() if k in got} and set(got) == set(expected)
    standing = {r["account_no"]: r for r in revenue.account_standing(*tables, SETTINGS.as_of).collect()}
    assert {k: int(r["total_revenue"]) for k, r in standing.items()} == got
    last = {r["account_no"]: r["last_tx_date"] for r in revenue.last_transaction(account, unit, invoice, rental).collect()}
    assert {k: r["last_tx_date"] for k, r in standing.items() if r["last_tx_date"]} == last


def test_standing_equals_its_parts(ws):
    both = revenue.account_standing(*ws.transactions(), ws.settings.as_of)
    apart = ws.account_revenue().select("account_no", "total_revenue").join(ws.last_transaction(), "account_no", "full")
    zero = lambda df: df.selectExpr("account_no", "coalesce(total_revenue, 0) AS r", "last_tx_date")
    assert zero(both).exceptAll(zero(apart)).count() == 0
    assert zero(apart).exceptAll(zero(both)).count() == 0


def test_upload_batches_cut(spark, stage):
    df = spark.range(250).selectExpr(
        "concat('C', id) AS contact_code", "'I' AS contact_type", "id AS account_no", "cast(0 AS decimal(18,2)) AS total_revenue")
    sizes = extracts.upload_batches(df, stage, 100).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [(r["batch_no"], r["count"]) for r in sizes] == [(1, 100), (2, 100), (3, 50)]


def test_one_upload_row_per_code(spark, stage):
    df = spark.createDataFrame([("A", "I", 1, 5), ("A", "I", 2, 6), ("B", "I", 3, 9)], "contact_code string, contact_type string, account_no bigint, r int")
    rows = extracts.upload_batches(df.selectExpr("*", "cast(r AS decimal(18,2)) AS total_revenue"), stage).collect()
    assert {(r["contact_code"], int(r["total_revenue"]), r["upload_position"]) for r in rows} == {("A", 11, 1), ("B", 9, 2)}


def test_duplicate_candidates_list_members(spark):
    fields = ("contact_code", "company_name", "first_name", "last_name", "city", "state", "email", "biz_phone", "priv_phone", "mob_phone")
    rows = [(f"C{i}", None, "Ann", "Lee", "Rome" if i < 5 else None, "KY", f"{i % 2}@X.y" if i < 4 else None, "1" if i % 3 == 0 else None,
             "1" if i == 0 else None, None) for i in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fields)).selectExpr(
        "*", "if(contact_code < 'C2', 999999998, NULL) AS ckc_id", "if(contact_code >= 'C8', 4, 0) AS cmp_ckc_id")
    got = quality.duplicate_candidates(df, SETTINGS).groupBy("key_type", "key_value", "contacts").count().collect()
    assert all(r["contacts"] == r["count"] for r in got)
    assert {(r["key_type"], r["key_value"]): r["count"] for r in got} == {
        ("phone", "1"): 10, ("name_place", "ANN LEE|ROME|KY"): 5, ("email", "0@X.Y"): 2, ("email", "1@X.Y"): 2,
        ("second_id", "4"): 2,
    }


def test_pairs_by_members(spark):
    rows = [(f"P{i}", "PROSPECT", 1, None) for i in range(50)] + [(f"C{i}", "CUSTOMER", None, 1) for i in range(40)]
    rows += [("P99", "PROSPECT", 2, None), ("C99", "CUSTOMER", None, 3), ("O", "OTHER", 1, 1)]
    crm = spark.createDataFrame(rows, "crm_id string, record_type string, comp_entity_id bigint, erp_entity_id bigint")
    got = extracts.prospect_customer_pairs(crm, SETTINGS).collect()
    assert len(got) == 90 and {(r["prospects"], r["customers"]) for r in got} == {(50, 40)}


def test_groups_through_several_keys(spark, stage):
    """Contacts that share a phone and, through another, a mail are one group; a hot phone is no row pairs."""
    fields = ("contact_code", "biz_phone", "priv_phone", "mob_phone", "email", "company_name", "first_name", "last_name",
              "city", "state")
    chain = [(f"X{i:02d}", f"{i // 2}", f"p{(i + 1) // 2}", None, None) for i in range(40)]
    hot = [(f"H{i:04d}", "hot", None, None, f"m{i}") for i in range(3000)]
    rows = [("A1", "1-1", None, None, "a"), ("A2", "1-1", None, None, "B"), ("A3", None, None, None, "b"), ("A4", "seven", None, None, "c"),
            ("H9999", None, None, None, "m17"), *chain, *hot]
    df = spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], ", ".join(f"{f} string" for f in fields))
    df = df.selectExpr("*", "cast(NULL AS bigint) AS ckc_id", "cast(NULL AS bigint) AS cmp_ckc_id")
    found = quality.duplicate_groups(quality.duplicate_candidates(df, SETTINGS), stage).collect()
    group = {r.contact_code: r.group_code for r in found}
    assert len(found) == len({(r.key_type, r.key_value, r.contact_code) for r in found})
    assert group["A1"] == group["A2"] == group["A3"] == "A1" and "A4" not in group
    assert {group[f"X{i:02d}"] for i in range(40)} == {"X00"}
    assert {group[c] for c in group if c[0] == "H"} == {"H0000"} and len([c for c in group if c[0] == "H"]) == 3001


def test_connected_nodes(spark, stage):
    rng = random.Random(2)
    for n, m in ((1, 0), (60, 50), (300, 280), (40, 400)):
        links = [(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)] + [(f"p{i}", f"p{i + 1}") for i in range(n)]
        least = {x: x for link in links for x in link}
        while any(least[a] != least[b] for a, b in links):
            for a, b in links:
                least[a] = least[b] = min(least[a], least[b])
        alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
        got = {r.node: r.least for r in groups.connected(spark.createDataFrame(links, "a string, b string"), stage).collect()}
        assert got == {x: y for x, y in least.items() if x not in alone}
