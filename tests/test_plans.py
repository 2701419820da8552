"""Plans: no row-pairing joins, no Python workers, filters and columns reach the scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkledger.operators import revenue
from linkledger.operators.rules import SCOPES, all_rules, checks
from linkledger.plans import catalog
from linkledger.plans.fixture_run import SETTINGS
from linkledger.plans.workspace import METHOD_BYTES

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")
NAMES = sorted(catalog.all_queries(SETTINGS))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("io_")])
def test_no_pairing_and_no_python(ws, name):
    plan = plan_of(catalog.all_queries(ws.settings)[name](ws))
    assert not [b for b in BAD if b in plan]


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "invoice")
    spark.range(10).selectExpr(
        "id AS document_no", "id AS bill_to_acc", "'I' AS invo_type", "'I' AS module_type",
        "timestamp_ntz'2000-01-01 14:00:00' AS invo_datetime", "cast(1 AS decimal(12,2)) AS parts_sale",
        "cast(1 AS decimal(12,2)) AS labour_sale", "cast(1 AS decimal(12,2)) AS unused",
    ).write.parquet(path)
    invoice = spark.read.parquet(path)
    rows = revenue.billed(invoice).filter(revenue.in_window("invo_datetime", dt.date(1999, 1, 1), dt.date(2001, 1, 1)))
    plan = plan_of(rows.groupBy("bill_to_acc").agg(F.expr(f"sum({revenue.money('parts_sale')}) AS x")))
    assert "GreaterThanOrEqual(invo_datetime" in plan and "In(invo_type" in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "unused" not in schema and "labour_sale" not in schema
    years = plan_of(invoice.filter(revenue.in_years("invo_datetime", 2000, 2001)))
    assert "GreaterThanOrEqual(invo_datetime" in years


def test_one_metric_reads_few_columns(ws):
    """Rules are judged once, when contacts are staged; counting one reads its word."""
    plan = plan_of(catalog.all_queries(ws.settings)["cp_missing_street"](ws))
    schema = plan[plan.index("ReadSchema"):]
    assert "rules_0" in schema and "rules_1" not in schema and "street" not in schema and "email" not in schema


def method_sizes(df) -> list[int]:
    found = df._jdf.queryExecution().debug().codegenToSeq()
    return [found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())]


@pytest.mark.parametrize("name", [
    "dq_snapshot", "dq_field_quality", "dq_completeness", "dq_parity", "issue_map", "issue_map_counts",
    "clean_record_pct", "quality_index", "rpt_2"])
def test_what_reads_outcomes_has_small_methods(ws, spark, name):
    """Of all rules, nothing but bits is left: every generated method is small enough to be compiled."""
    build = catalog.all_queries(ws.settings)[name]
    build(ws)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = method_sizes(build(ws))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < METHOD_BYTES
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= METHOD_BYTES


def test_bits_are_the_rules(ws):
    """Every bit against its rule's expressions, over all contacts; flags count the failed ones."""
    rules = all_rules(ws.settings, standalone=True)
    contacts = ws.enriched()
    wrong = contacts.selectExpr(*(
        f"count_if(({c.applies}) <> coalesce({SCOPES[r.scope]}, false) OR ({c.counts}) <> {r.failed}) AS {r.name}"
        for r, c in zip(rules, checks(ws.settings, rules)))).first().asDict()
    assert not {n: k for n, k in wrong.items() if k} and len(wrong) == len(rules)
    failed = " + ".join(f"cast({r.failed} AS int)" for r in rules)
    assert contacts.filter(f"flags <> {failed}").isEmpty() and not contacts.filter("flags > 2").isEmpty()


def test_contacts_are_shuffled_once(ws, spark):
    """Without broadcasts, the joins on the contact code share one layout of the contacts, and none is an outer join
    whose inner side a hot code could fill."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = ws.active()
        rows.write.format("noop").mode("overwrite").save()
        rows.collect()
        plan = plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = plan[: plan.index("== Initial Plan ==")]
    assert "LeftOuter" not in plan and "ReusedExchange" in plan


def test_months_of_accounts_are_summed_in_partitions_of_their_own(spark, ws):
    """The sums of a month are not also held in the tasks that join, and Spark does not merge the partitions."""
    plan = plan_of(catalog.all_queries(ws.settings)["account_sales_history"](ws))
    dealt = [line for line in plan.splitlines() if "hashpartitioning(account_no" in line and "REPARTITION_BY_NUM" in line]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    assert len(dealt) == 1 and "year" in dealt[0] and "month" in dealt[0] and f", {partitions})" in dealt[0]
    summed = [i for i, line in enumerate(plan.splitlines()) if "Aggregate(keys=[account_no" in line and "year" in line and "partial_sum" in line]
    assert all(i < plan.splitlines().index(dealt[0]) for i in summed)
