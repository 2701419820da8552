"""A run of several dates: what no date changes is computed once, and large categories are written in parts."""

from linkledger.operators import revenue
from linkledger.plans.fixture_run import SETTINGS, fresh_workspace
from linkledger.plans.workspace import Workspace
from linkledger.sources import sinks

DATA = "/root/testdata/sf0.001"


def test_dates_share_one_pass_over_transactions(spark, monkeypatch):
    space = fresh_workspace(spark, DATA)
    runs = [space.at(day) for day in SETTINGS.dates]
    passes, read = [], Workspace.transactions
    monkeypatch.setattr(Workspace, "transactions", lambda ws: passes.append(1) or read(ws))
    seen = [(run, run.enriched().select("account_no", "total_revenue", "last_tx_date")) for run in runs]
    assert len(passes) == 1
    for run, got in seen:
        own = revenue.account_standing(*read(run), run.settings.as_of)
        want = run.base().select("account_no").join(own, "account_no", "left").selectExpr(
            "account_no", "cast(coalesce(total_revenue, 0) AS decimal(18,2)) AS total_revenue", "last_tx_date")
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    space.release()


def test_large_category_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 8).selectExpr(
        "DATE '2001-08-15' AS snapshot_date", "if(id < 5, 'linkage', 'parity') AS metric_category", "sha2(cast(id AS string), 256) AS branch")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        sinks.append_snapshot(rows, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(str(tmp_path / "s"))
    files = stored.filter("metric_category = 'parity'").selectExpr("input_file_name() AS f").distinct().count()
    assert files > 1 and stored.count() == 400_000
