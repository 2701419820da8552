"""The recurring run, and the files of the upload tool."""

import datetime as dt

import pytest

from linkledger.operators import dimensions, reports
from linkledger.plans import weekly
from linkledger.sources import publishing, readers, schemas, sinks


def everything(spark, root):
    """All that readers see below a root."""
    found = {"snapshots": publishing.read_snapshots(spark, root), "issue map": publishing.read_issue_map(spark, root)}
    found |= {n: publishing.read_lookup(spark, root, n) for n in publishing.current(spark, root).lookups}
    return {n: sorted(map(str, df.collect())) for n, df in found.items()}


def test_run_twice(ws, spark, tmp_path):
    root = f"{tmp_path}/published"
    weekly.weekly_run(ws, root, lookups=True)
    first = everything(spark, root)
    weekly.weekly_run(ws, root, lookups=True)
    assert everything(spark, root) == first
    assert len(first["issue map"]) == weekly.issue_map(ws).count()
    assert len(first["dim_metric"]) == len(dimensions.metric_rows(ws.settings))
    assert publishing.dates(spark, root) == [ws.settings.as_of]


def test_names_must_agree(ws, tmp_path, monkeypatch):
    known = dimensions.metric_rows
    monkeypatch.setattr(dimensions, "metric_rows", lambda settings: known(settings)[1:])
    with pytest.raises(weekly.NamesDiffer, match="linked_count"):
        weekly.weekly_run(ws, f"{tmp_path}/published")
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("step", ["write_snapshot", "write_issue_map", "write_lookups", "publish", "verify"])
def test_a_run_that_breaks_leaves_the_one_before(ws, spark, tmp_path, monkeypatch, step):
    """Whatever a run has written when it stops, readers see the earlier run whole."""
    root = f"{tmp_path}/published"
    earlier = ws.at(ws.settings.dates[-2])
    weekly.weekly_run(earlier, root, lookups=True)
    first = everything(spark, root)

    def broken(*args, **kwargs):
        if step != "publish":
            done(*args, **kwargs)
        raise RuntimeError("executor lost")

    if step == "verify":
        monkeypatch.setattr(weekly, "_totals", lambda rows, seen=[]: seen.append(1) or len(seen))
    else:
        done = getattr(publishing.Run, step)
        monkeypatch.setattr(publishing.Run, step, broken)
    with pytest.raises((RuntimeError, weekly.NotStored)):
        weekly.weekly_run(ws, root, lookups=True)
    assert everything(spark, root) == first and publishing.dates(spark, root) == [earlier.settings.as_of]
    monkeypatch.undo()
    weekly.weekly_run(ws, root)
    after = everything(spark, root)
    assert publishing.dates(spark, root) == [earlier.settings.as_of, ws.settings.as_of]
    assert set(first["snapshots"]) < set(after["snapshots"]) and after["issue map"] != first["issue map"]
    assert after["dim_metric"] == first["dim_metric"]  # not asked for: those of the run before
    assert any(str(ws.settings.as_of) in r or "2001, 8, 15" in r for r in after["issue map"])


def small(spark, day, n, **more):
    columns = "".join(f", {v} AS {k}" for k, v in more.items())
    return spark.sql(f"SELECT DATE '{day}' AS snapshot_date, 'c' AS metric_category, 'm' AS metric_name, {n}L AS numerator{columns}")


def test_what_no_pointer_names_is_cleaned(spark, tmp_path):
    root = f"{tmp_path}/published"
    for n, day in enumerate(["2001-01-01", "2001-01-08", "2001-01-08", "2001-01-15"]):
        run = publishing.Run(spark, root)
        run.write_snapshot(small(spark, day, n))
        run.write_issue_map(spark.range(n))
        run.publish()
    broken = publishing.Run(spark, root)
    broken.write_snapshot(small(spark, "2001-01-22", 9))
    before = everything(spark, root)
    gone = publishing.clean(spark, root, keep=1)
    assert everything(spark, root) == before and publishing.current(spark, root).number == 4
    assert len([g for g in gone if g.startswith("_pointer")]) == 3 and len([g for g in gone if g.startswith("issue_map")]) == 3
    assert len([g for g in gone if g.startswith("snapshots")]) == 2
    assert sorted(r.numerator for r in publishing.read_snapshots(spark, root).collect()) == [0, 2, 3]
    with pytest.raises(publishing.NothingPublished):
        publishing.read_lookup(spark, root, "dim_metric")
    with pytest.raises(publishing.NothingPublished):
        publishing.read_snapshots(spark, f"{tmp_path}/empty")


def test_two_runs_at_once(spark, tmp_path):
    a, b = (publishing.Run(spark, str(tmp_path)) for _ in range(2))
    for run in (a, b):
        run.write_snapshot(small(spark, "2001-01-01", 1))
    a.publish()
    with pytest.raises(publishing.OtherRun):
        b.publish()


def test_columns_may_come_later(spark, tmp_path):
    """Earlier dates have nulls in a later column; no data file is opened to learn the columns."""
    root, path = f"{tmp_path}/published", f"{tmp_path}/plain"
    for n, (day, more) in enumerate([("2001-01-01", {}), ("2001-01-08", {"added": "'x'"}), ("2001-01-15", {})]):
        run = publishing.Run(spark, root)
        run.write_snapshot(small(spark, day, n, **more))
        run.publish()
        sinks.append_snapshot(small(spark, day, n, **more), path)
    for df in (publishing.read_snapshots(spark, root), readers.read_snapshot(spark, path)):
        assert [r.added for r in df.orderBy("snapshot_date").collect()] == [None, "x", None]
        assert [str(d) for d in reports.stored_dates(df)] == ["2001-01-01", "2001-01-08", "2001-01-15"]
    assert readers.stored_dates(spark, path) == reports.stored_dates(readers.read_snapshot(spark, path))
    sinks.replace_snapshot(small(spark, "2001-01-01", 7, added="'y'"), path)
    assert [r.added for r in readers.read_snapshot(spark, path).orderBy("snapshot_date").collect()] == ["y", "x", None]
    with pytest.raises(schemas.ColumnsDiffer, match="added"):
        sinks.append_snapshot(small(spark, "2001-01-22", 1, added="1"), path)
    with pytest.raises(schemas.ColumnsDiffer, match="added"):
        publishing.Run(spark, root).write_snapshot(small(spark, "2001-01-22", 1, added="1"))
    sinks.reset_snapshots(small(spark, "2001-01-22", 1), path)
    assert "added" not in readers.read_snapshot(spark, path).columns


def test_no_reader_merges_schemas():
    import pathlib

    import linkledger

    for file in pathlib.Path(linkledger.__file__).parent.rglob("*.py"):
        assert "mergeSchema" not in file.read_text(), file


def test_files_within_limits(spark, stage, tmp_path):
    rows = [(f"C{i:04d}", 'says "hi", ' * (i % 9), None) for i in range(500)]
    df = spark.createDataFrame(rows, "code string, note string, empty string").repartition(6)
    stamp = dt.datetime(2026, 1, 2, 3, 4, 5)
    sinks.export_files(df, str(tmp_path), "a-very-long-stem-for-a-file-that-is-cut-somewhere", stamp, ["code"], stage,
                       {"code": "The Code"}, file_rows=120, file_bytes=9000)
    files = sorted(tmp_path.glob("*.csv"))
    assert len(files) >= 5 and all(len(f.name) <= 50 and f.stat().st_size <= 9000 for f in files)
    assert all(f.read_text().startswith("The Code,note,empty\n") for f in files)
    back = readers.read_csv(spark, f"{tmp_path}/*.csv")
    assert sorted(r["The Code"] for r in back.collect()) == [r[0] for r in rows]
    ends = sorted((min(c), max(c)) for c in ([x.split(",")[0] for x in f.read_text().splitlines()[1:]] for f in files))
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("wide", [0, 1, 5])
def test_files_are_nearly_full(spark, stage, tmp_path, wide):
    """Real sizes cut files, so wide rows cost a file each and leave the rest full."""
    rows = [(f"C{i:05d}", "é" * (i % 40), '"' if i % 3 else None) for i in range(4000)]
    for k in range(wide):
        rows[700 * k + 13] = (rows[700 * k + 13][0], "w" * 18_000, None)
    df = spark.createDataFrame(rows, "code string, note string, mark string").repartition(5)
    stamp = dt.datetime(2026, 1, 2, 3, 4, 5)
    sinks.export_files(df, str(tmp_path), "wide", stamp, ["code"], stage, {}, file_bytes=20_000)
    files = sorted(tmp_path.glob("*.csv"), key=lambda f: int(f.name.split("-")[1]))
    assert [int(f.name.split("-")[1]) for f in files] == list(range(1, len(files) + 1))
    sizes = [f.stat().st_size for f in files]
    assert max(sizes) <= 20_000
    assert len(files) <= 1 + (sum(sizes) - 18_000 * wide) // (20_000 * 13 // 16) + 2 * wide
    read = [line.split(",")[0] for f in files for line in f.read_text().splitlines()[1:]]
    assert read == sorted(r[0] for r in rows)


def test_empty_file_has_a_header(spark, stage, tmp_path):
    df = spark.createDataFrame([], "code string")
    sinks.export_files(df, str(tmp_path), "none", dt.datetime(2026, 1, 2), ["code"], stage, {"code": "Code"})
    assert [f.read_text() for f in tmp_path.glob("*.csv")] == ["Code\n"]


def test_default_settings_run(spark, ws):
    """A workspace with nothing but a date can run what needs stored dates."""
    from linkledger.config import Settings
    from linkledger.plans import catalog
    from linkledger.plans.workspace import Workspace

    other = Workspace(spark, ws.tables, Settings(as_of=dt.date(2001, 8, 15)))
    found = catalog.all_queries(other.settings)
    for name in ("snapshot_delta", "io_overwrite_roundtrip", "io_append_roundtrip", "dq_field_quality", "tracking_totals"):
        assert found[name](other).count() > 0, name
    other.release()
