"""The test tables reach every rule and every way in which rows multiply."""

import pytest

from linkledger.operators import dimensions, reports
from linkledger.plans import catalog, snapshot
from linkledger.plans.fixture_run import SETTINGS, fresh_workspace

QUERIES = catalog.all_queries(SETTINGS)


@pytest.fixture(scope="module")
def wide(spark):
    space = fresh_workspace(spark, "/root/testdata/sf0.01")
    yield space
    space.release()


@pytest.mark.parametrize("section", ["dq_completeness", "dq_field_quality", "dq_parity", "dq_linkage"])
def test_every_rule_finds_something(wide, section):
    rows = QUERIES[section](wide).groupBy("metric_name").agg({"numerator": "sum"}).collect()
    assert [r[0] for r in rows if not r[1]] == []


def test_every_metric_is_reached(wide):
    """No metric is 0 in every slice, so no rule, outcome, bucket or tier is green for want of data."""
    rows = reports.coverage(snapshot.dq_snapshot(wide)).collect()
    assert len(rows) == len(dimensions.metric_rows(SETTINGS))
    assert [r.metric_name for r in rows if not r.reached or not r.total] == []


def test_coverage_names_what_is_missing(spark):
    rows = [("2001-01-01", "old", 5), ("2001-01-08", "old", 0), ("2001-01-08", "none", 0), ("2001-01-08", "some", 0), ("2001-01-08", "some", 3)]
    df = spark.createDataFrame(rows, "d string, metric_name string, numerator long").selectExpr(
        "cast(d AS date) AS snapshot_date", "'c' AS metric_category", "metric_name", "numerator")
    got = {r.metric_name: (r.slices, r.reached_slices, r.reached) for r in reports.coverage(df).collect()}
    assert got == {"none": (1, 0, False), "old": (1, 0, False), "some": (2, 1, True)}


def test_contacts_with_several_accounts(wide):
    sizes = {r["contact_code_count"]: r["account_count"] for r in QUERIES["account_cardinality"](wide).collect()}
    assert {1, 2} <= set(sizes) and max(sizes) > 20


def test_repeats_and_padding(spark, wide):
    assert wide.table("profile").groupBy("entity_id", "contact_id", "source_desc").count().filter("count > 1").count()
    assert wide.table("tight_match").groupBy("dbs_number").count().filter("count > 1").count()
    for name, column in (("account", "contact_code"), ("technician", "code"), ("xref", "cross_ref_number")):
        assert wide.table(name).filter(f"{column} <> rtrim({column})").count() == 0


def test_every_lineitem_has_a_role(wide):
    lines = wide.table("lineitem").join(wide.table("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey"), "l_orderkey")
    sold = lines.filter("l_linenumber % 2 = 1 AND o_custkey % 19 <> 0").count()
    assert wide.table("unit_sale").count() == sold
    assert wide.table("rental").count() == wide.table("lineitem").filter("l_linenumber % 2 = 0").count()


def test_upload_columns_hold_values(wide):
    rows = QUERIES["path_b_extract"](wide)
    filled = rows.selectExpr(*(f"count({c}) AS {c}" for c in rows.columns)).first().asDict()
    assert {c for c, n in filled.items() if not n} <= {"tax_type", "tax_id"}
