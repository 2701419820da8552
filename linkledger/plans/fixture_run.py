"""Workspaces over a folder of test tables."""

from __future__ import annotations

import atexit
import datetime as dt
import functools
import shutil
import tempfile

from pyspark.sql import SparkSession

from linkledger.config import Settings
from linkledger.plans.workspace import Workspace
from linkledger.sources.fixtures import FixtureTables
from linkledger.storage import fingerprint

AS_OF = dt.date(2001, 8, 15)
SETTINGS = Settings(
    as_of=AS_OF,
    history=(dt.date(2001, 6, 15), dt.date(2001, 7, 15), AS_OF),
    dealer_id="120",
    project_start=dt.date(2001, 7, 1),
    closed_branches=("03", "18", "29", "47"),
    internal_domains=("internal.example",),
)

_open: dict[tuple[str, str], tuple[tuple, Workspace]] = {}


@functools.cache
def _test_folder() -> str:
    folder = tempfile.mkdtemp(prefix="linkledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def with_folder(spark: SparkSession) -> None:
    """Name a folder for staged tables in a local session that has none; a cluster must name a shared one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", _test_folder())


def fresh_workspace(spark: SparkSession, folder: str) -> Workspace:
    """A workspace with nothing staged yet."""
    with_folder(spark)
    return Workspace(spark, FixtureTables(spark, folder), SETTINGS)


def open_workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of a folder; shared until the session or the data change."""
    key = (spark.sparkContext.applicationId, folder)
    mark = fingerprint(spark, FixtureTables(spark, folder).paths())
    known = _open.get(key)
    if known is None or known[0] != mark:
        if known is not None:
            known[1].release()
        _open[key] = (mark, fresh_workspace(spark, folder))
    return _open[key][1]
