"""Tables of a run under one root, which readers see all at once or not at all.

Every run writes into folders of its own, and nothing that a reader may be reading is changed. A pointer, a small file,
says which folders are current: one per snapshot date, and those of the issue map and of each lookup table. The last
step of a run is a new pointer with the next number; the reader takes the highest. A run that fails before leaves
folders that no pointer names, and the run before stays readable whole. ``clean`` deletes what no kept pointer names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from linkledger.sources import schemas, sinks
from linkledger.storage import folders, hadoop_path, read_text, write_text

_POINTER = "_pointer-"


class NothingPublished(Exception):
    """No run was published below the root."""


class OtherRun(Exception):
    """Another run was published meanwhile."""


@dataclass(frozen=True)
class Pointer:
    """What is current: folders below the root, and the columns of the snapshot table."""

    number: int = 0
    snapshots: dict[str, str] = field(default_factory=dict)  # by date
    issue_map: str | None = None
    lookups: dict[str, str] = field(default_factory=dict)    # by name
    columns: dict | None = None

    def named(self) -> set[str]:
        return {f for f in (*self.snapshots.values(), self.issue_map, *self.lookups.values()) if f}


def _numbers(spark: SparkSession, root: str) -> list[int]:
    found = (n.removeprefix(_POINTER).removesuffix(".json") for n in folders(spark, root)
             if n.startswith(_POINTER) and n.endswith(".json"))
    return sorted(map(int, found))


def _read(spark: SparkSession, root: str, number: int) -> Pointer:
    return Pointer(**json.loads(read_text(spark, f"{root}/{_POINTER}{number:08d}.json")))


def current(spark: SparkSession, root: str) -> Pointer:
    """The newest pointer; an empty one if nothing was published."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else Pointer()


class Run:
    """A run that is being written."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.before = current(spark, root)
        self.name = f"{self.before.number + 1:08d}-{uuid.uuid4().hex[:8]}"
        self.pointer = replace(self.before, number=self.before.number + 1)

    def write_snapshot(self, rows: DataFrame) -> DataFrame:
        """Write the rows of one or several dates, which replace those of the same dates; returns them read back."""
        columns = schemas.widened(
            StructType.fromJson(self.before.columns) if self.before.columns else None, rows.schema)
        sinks.write_snapshot(rows, f"{self.root}/snapshots/run={self.name}")
        days = [n for n in folders(self.spark, f"{self.root}/snapshots/run={self.name}") if n.startswith("snapshot_date=")]
        own = {day.partition("=")[2]: f"snapshots/run={self.name}/{day}" for day in days}
        self.pointer = replace(
            self.pointer, snapshots=self.before.snapshots | own, columns=json.loads(columns.json()))
        return _snapshots(self.spark, self.root, replace(self.pointer, snapshots=own))

    def write_issue_map(self, rows: DataFrame) -> None:
        folder = f"issue_map/run={self.name}"
        sinks.overwrite(rows, f"{self.root}/{folder}")
        self.pointer = replace(self.pointer, issue_map=folder)

    def write_lookups(self, tables: dict[str, DataFrame]) -> None:
        sinks.write_dimensions(tables, f"{self.root}/lookups/run={self.name}", enabled=True)
        own = {name: f"lookups/run={self.name}/{name}" for name in tables}
        self.pointer = replace(self.pointer, lookups=self.before.lookups | own)

    def publish(self) -> Pointer:
        """Make everything that was written current, in one step."""
        if self.pointer.number in _numbers(self.spark, self.root):
            raise OtherRun(f"number {self.pointer.number} below {self.root}")
        write_text(self.spark, f"{self.root}/{_POINTER}{self.pointer.number:08d}.json", json.dumps(asdict(self.pointer)))
        return self.pointer


def _snapshots(spark: SparkSession, root: str, pointer: Pointer) -> DataFrame:
    columns = StructType.fromJson(pointer.columns)
    paths = [f"{root}/{folder}" for _, folder in sorted(pointer.snapshots.items())]
    found = spark.read.schema(StructType([*columns.fields]).add("run", StringType())).option(
        "basePath", f"{root}/snapshots").parquet(*paths)
    return found.drop("run")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot table: the current rows of every date."""
    pointer = current(spark, root)
    if not pointer.snapshots:
        raise NothingPublished(root)
    return _snapshots(spark, root, pointer)


def dates(spark: SparkSession, root: str) -> list[dt.date]:
    """Dates of the snapshot table, the oldest first."""
    return sorted(map(dt.date.fromisoformat, current(spark, root).snapshots))


def read_issue_map(spark: SparkSession, root: str) -> DataFrame:
    pointer = current(spark, root)
    if not pointer.issue_map:
        raise NothingPublished(root)
    return spark.read.parquet(f"{root}/{pointer.issue_map}")


def read_lookup(spark: SparkSession, root: str, name: str) -> DataFrame:
    pointer = current(spark, root)
    if name not in pointer.lookups:
        raise NothingPublished(f"{name} below {root}")
    return spark.read.parquet(f"{root}/{pointer.lookups[name]}")


def clean(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` pointers, and all folders that these do not name. Not to be called while a run
    is being written, whose folders have no pointer yet."""
    numbers = _numbers(spark, root)
    kept = set().union(*(_read(spark, root, n).named() for n in numbers[-keep:]))
    gone = []
    for number in numbers[:-keep]:
        gone.append(f"{_POINTER}{number:08d}.json")
    for table in ("snapshots", "issue_map", "lookups"):
        for run in (n for n in folders(spark, f"{root}/{table}") if n.startswith("run=")):
            folder = f"{table}/{run}"
            if table == "issue_map" or not any(k.startswith(f"{folder}/") for k in kept):
                gone += [] if folder in kept else [folder]
            else:
                gone += [f for f in (f"{folder}/{n}" for n in folders(spark, f"{root}/{folder}"))
                         if f not in kept and not f.rsplit("/", 1)[1].startswith(("_", "."))]
    for path in gone:
        fs, at = hadoop_path(spark, f"{root}/{path}")
        fs.delete(at, True)
    return gone
