"""Invariants of the snapshot, the issue map and the stored tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkledger.config import SNAPSHOT_COLUMNS, r60_window
from linkledger.functions import lists
from linkledger.operators import dimensions, extracts, parity, reports
from linkledger.operators.rules import NEEDS_REPEAT_FLAG, all_rules
from linkledger.plans import catalog, snapshot, weekly
from linkledger.plans.fixture_run import SETTINGS, fresh_workspace, open_workspace
from linkledger.sources import readers, sinks
from linkledger import storage
from conftest import DATA

SLICE = ["contact_type", "sales_decile", "staleness_bucket", "branch", "creation_cohort"]


@pytest.fixture(scope="module")
def rows(ws):
    return snapshot.dq_snapshot(ws).cache()


def test_shape(rows):
    assert tuple(rows.columns) == SNAPSHOT_COLUMNS
    assert dict(rows.dtypes)["numerator"] == dict(rows.dtypes)["denominator"] == "bigint"
    assert rows.filter("numerator > denominator OR numerator < 0").count() == 0
    assert rows.groupBy("metric_name", *SLICE).count().filter("count > 1").count() == 0


def test_137_metrics(rows, ws):
    names = {r[0] for r in rows.select("metric_name").distinct().collect()}
    known = {r[0] for r in dimensions.metric_rows(ws.settings)}
    assert len(known) == 137 and names <= known


def test_linked_and_unlinked_make_up_everyone(rows):
    total = rows.filter("metric_name IN ('linked_count', 'unlinked_count')").groupBy(*SLICE).agg(
        F.sum("numerator").alias("n"), F.max("denominator").alias("d"))
    assert total.filter("n <> d").count() == 0


@pytest.mark.parametrize("category,names", [
    ("staleness", lists.STALENESS_BUCKETS), ("match_readiness", lists.MATCH_TIERS),
    *(("parity", tuple(f"{f.name}_{o}" for o in lists.PARITY_OUTCOMES)) for f in parity.FIELDS),
])
def test_parts_add_up(rows, category, names):
    whole = rows.filter((F.col("metric_category") == category) & F.col("metric_name").isin(*names)).groupBy(*SLICE).agg(
        F.sum("numerator").alias("n"), F.min("denominator").alias("lo"), F.max("denominator").alias("hi"), F.count("*").alias("k"))
    assert whole.count() > 0
    assert whole.filter(f"n <> lo OR lo <> hi OR k <> {len(names)}").count() == 0


def test_issue_map_counts_match_the_snapshot(rows, ws):
    """For rules, each failing contact is one row of the map, however many accounts it has."""
    rules = [r for r in all_rules(ws.settings) if r.name != NEEDS_REPEAT_FLAG]
    failed = ws.enriched().selectExpr(
        *(f"count(DISTINCT CASE WHEN {r.failed} THEN contact_code END) AS {r.name}" for r in rules)).first().asDict()
    names = [r.name for r in rules]
    mapped = {r["metric_name"]: r["n"] for r in weekly.issue_map(ws).groupBy("metric_name").agg(F.count("*").alias("n")).collect()}
    assert {n: mapped.get(n, 0) for n in names} == failed
    never = {"linked_count", "orphan_cross_ref", *lists.STALENESS_BUCKETS, *lists.MATCH_TIERS}
    assert not never & set(mapped)
    assert not [m for m in mapped if m.endswith("both_null") or (m.endswith("_match") and not m.endswith("mismatch"))]


def test_null_branch_survives(rows):
    assert rows.filter("metric_name = 'missing_street' AND branch IS NULL").count() > 0


def test_counts_agree_with_extract(ws):
    count = catalog.LINKAGE_WORK["path_a_count"](ws).first()["total"]
    assert count == catalog.LINKAGE_WORK["path_a_extract"](ws).count()


def test_window():
    assert r60_window(dt.date(2001, 8, 15)) == (dt.date(1996, 8, 1), dt.date(2001, 7, 31))
    assert r60_window(dt.date(2024, 3, 1)) == (dt.date(2019, 3, 1), dt.date(2024, 2, 29))
    assert r60_window(dt.date(2024, 1, 31)) == (dt.date(2019, 1, 1), dt.date(2023, 12, 31))


def test_same_date_twice_leaves_the_same_rows(ws, tmp_path):
    path = str(tmp_path / "snap")
    one, two = (snapshot.section(ws.at(d), "staleness") for d in SETTINGS.history[:2])
    sinks.append_snapshot(one, path)
    sinks.append_snapshot(two, path)
    before = readers.read_snapshot(ws.spark, path).count()
    sinks.replace_snapshot(two, path)
    stored = readers.read_snapshot(ws.spark, path)
    assert stored.count() == before == one.count() + two.count()
    assert reports.latest_date(stored) == SETTINGS.history[1]
    sinks.reset_snapshots(one, path)
    assert readers.read_snapshot(ws.spark, path).count() == one.count()


def test_snapshot_schema_grows(ws, tmp_path):
    path = str(tmp_path / "snap")
    one, two = (snapshot.section(ws.at(d), "staleness") for d in SETTINGS.history[:2])
    sinks.append_snapshot(one, path)
    sinks.append_snapshot(two.withColumn("note", F.lit("x")), path)
    stored = readers.read_snapshot(ws.spark, path)
    assert stored.filter("note IS NULL").count() == one.count()


def test_newest_snapshot_reads_one_partition(ws):
    plan = reports.latest(snapshot.stored_snapshots(ws))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("", "b,c")], "x string, y string")
    sinks.export_text(df, str(tmp_path / "t.csv"), headers={"x": "The X"})
    got = readers.read_csv(spark, str(tmp_path / "t.csv"))
    assert got.columns == ["The X", "y"] and sorted(map(tuple, got.collect())) == [("", "b,c"), ("a", "")]
    sinks.export_text(df, str(tmp_path / "t.tsv"), null_text="NULL")
    lines = {r[0] for r in spark.read.text(str(tmp_path / "t.tsv")).collect()}
    assert "a\tNULL" in lines and "x\ty" in lines


def test_upload_files_stay_small(ws, tmp_path):
    batches = extracts.upload_batches(ws.unlinked(), ws.scratch.stage, 10)
    sinks.export_batches(batches, str(tmp_path / "up"), 10)
    files = sorted((tmp_path / "up").glob("batch_no=*/*.csv"))
    sizes = [len(f.read_text().splitlines()) - 1 for f in files]
    codes = ws.unlinked().select("contact_code").distinct().count()
    assert len(files) == -(-codes // 10)
    assert max(sizes) <= 10 and sum(sizes) == codes


def test_export_name():
    name = sinks.export_name("a" * 60, ".csv", dt.datetime(2026, 1, 2, 3, 4, 5))
    assert len(name) == 50 and name.endswith("a-20260102-030405.csv")
    assert sinks.export_name("agree", ".csv", dt.datetime(2026, 1, 2, 3, 4, 5)) == "agree-20260102-030405.csv"


def test_exclusion_file(spark, tmp_path):
    (tmp_path / "codes.txt").write_text(" cust1 \n\nCUST2\n   \n")
    assert sorted(r[0] for r in readers.read_exclusions(spark, str(tmp_path / "codes.txt")).collect()) == ["CUST1", "CUST2"]


def test_dimensions_only_when_asked(spark, tmp_path):
    dims = {n: dimensions.dimension(spark, n) for n in dimensions.dimension_rows()}
    assert sinks.write_dimensions(dims, str(tmp_path)) == [] and not list(tmp_path.iterdir())
    assert len(sinks.write_dimensions(dims, str(tmp_path), enabled=True)) == 6


def test_named_tables(spark, tmp_path):
    path = str(tmp_path / "people")
    spark.createDataFrame([("a", "B")], "Code string, Kind string").write.parquet(path)
    tables = readers.NamedTables(spark, {"contact": path}, {"contact": {"contact_code": "Code", "contact_type": "Kind"}})
    assert tables.table("contact").columns == ["contact_code", "contact_type"]


def test_options_of_the_settings(spark, ws):
    """Empty country as US, decile by count, staleness in 365 day steps."""
    from dataclasses import replace

    from linkledger.plans.workspace import Workspace

    other = Workspace(spark, ws.tables, replace(
        ws.settings, parity_us_default=True, decile_method="ntile", staleness_step="365d"))
    assert ws.linked().filter("country IS NULL").count() > 0 == other.linked().filter("country IS NULL").count()
    assert other.enriched().count() == ws.enriched().count()
    sizes = [r["count"] for r in other.ranked_revenue().filter("raw_decile IS NOT NULL").groupBy("raw_decile").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1
    other.release()


def test_extract_filters(ws):
    everyone = extracts.contact_extract(ws.unlinked(), 10**6, dt.date(1900, 1, 1), with_account=False)
    assert everyone.count() == ws.unlinked().filter("creation_date IS NOT NULL").select("contact_code").distinct().count()
    branch = ws.unlinked().filter("branch IS NOT NULL").first()["branch"]
    one = extracts.contact_extract(ws.unlinked(), 3, dt.date(1900, 1, 1), branch=branch)
    assert 0 < one.count() <= 3 and {r["branch"] for r in one.collect()} == {branch}
    stale = extracts.inactivation_candidates(ws.enriched(), dt.date(2001, 8, 1), dt.date(2030, 1, 1), branch=branch)
    assert {r["branch"] for r in stale.collect()} <= {branch}


def test_slicers(ws):
    rows = reports.slicers(snapshot.stored_snapshots(ws), contact_type="B", metric_category="linkage")
    assert {r[0] for r in rows.select("contact_type").distinct().collect()} == {"B"}


def test_match_layout_has_all_upload_columns(ws):
    upload = catalog.LINKAGE_WORK["path_b_extract"](ws)
    assert upload.columns == list(extracts.MATCH_HEADERS) and len(upload.columns) == 24


def test_workspace_is_shared_until_data_change(spark):
    assert open_workspace(spark, DATA) is open_workspace(spark, DATA)
    assert fresh_workspace(spark, DATA) is not open_workspace(spark, DATA)


def test_staging_uses_the_folder_the_session_names(spark, ws):
    assert ws.scratch.folder.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session())


def test_release_deletes_the_staged_tables(spark):
    own = fresh_workspace(spark, DATA)
    own.enriched()
    fs, path = storage.hadoop_path(spark, own.scratch.folder)
    assert fs.exists(path)
    own.release()
    assert not fs.exists(path)


@pytest.mark.parametrize("name", ["dq_staleness", "rpt_24", "rpt_28"])
def test_buckets_come_in_their_order(ws, name):
    found = [lists.STALENESS_BUCKETS.index(r.metric_name) for r in catalog.all_queries(ws.settings)[name](ws).collect()]
    assert found == sorted(found) and len(set(found)) > 2


def test_delta_is_between_the_newest_stored_dates(ws, spark):
    stored = snapshot.stored_snapshots(ws)
    days = reports.stored_dates(stored)
    assert days == sorted(ws.settings.dates) and reports.latest_date(stored) == ws.settings.as_of
    got = {r.metric_name: (r.numerator_before, r.numerator_after) for r in reports.latest_delta(stored).collect()}
    for at, day in enumerate(days[-2:]):
        own = stored.filter(F.col("snapshot_date") == F.lit(day)).groupBy("metric_name").agg(F.sum("numerator").alias("n"))
        assert all(got[r.metric_name][at] == r.n for r in own.collect())
    only = reports.latest_delta(stored.filter(F.col("snapshot_date") == F.lit(days[0])).drop("branch").coalesce(1).cache())
    assert all(r.numerator_before + r.numerator_delta == r.numerator_after for r in only.collect())
