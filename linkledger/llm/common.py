"""Helpers the operators share: table reading, written stages, per-batch functions."""

from __future__ import annotations

import contextlib
import os
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


#: Rows whose values are Python objects at one time; and rows and bytes that go to Python workers together, where the
#: session leaves Spark's defaults. Texts are long rows, and a batch is held on both sides.
ROWS_AT_ONCE = 1000
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
            "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16m")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    visible_to_workers(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    for name, (default, ours) in _BATCHES.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, ours)


_in_use = None


def claimed(cache):
    """A cache of this process, after the one that another operator filled before is emptied: a worker that goes on
    from one operator to the next holds one of them at a time."""
    global _in_use
    if _in_use is not cache:
        if _in_use is not None:
            _in_use.clear()
        _in_use = cache
    return cache


def visible_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if it is not on their path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


class Stages:
    """Tables written below one folder of the shared storage, so that they outlive executors."""

    #: Lists that ``released`` keeps of what is opened inside it.
    _open: list[list[Stages]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        small_batches(spark)
        for held in Stages._open:
            held.append(self)

    def write(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, name: str) -> None:
        self._delete(f"{self.folder}/{name}")

    def release(self) -> None:
        """Delete all tables; results that were not written elsewhere can't be read any more."""
        self._delete(self.folder)


@contextlib.contextmanager
def released():
    """Delete the tables of all stages that are opened inside, at the end."""
    held: list[Stages] = []
    Stages._open.append(held)
    try:
        yield
    finally:
        Stages._open.remove(held)
        for stages in held:
            stages.release()


def with_columns(df: DataFrame, source: str, make, schema: str) -> DataFrame:
    """Append columns that ``make(values: list) -> list of lists`` derives from one column, batch by batch.

    All columns of ``df`` pass through unchanged, whatever their types and nulls. ``schema`` is the DDL of the
    new columns; their names must not occur in ``df``.
    """
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    new = StructType.fromDDL(schema)
    out = StructType(df.schema.fields + new.fields)
    at = df.columns.index(source)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in new.fields]
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                made = make(batch.column(at).to_pylist())
                arrays = [pa.array(v, k) for v, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [f.name for f in out.fields])

    return df.mapInArrow(run, out)


#: Rows of partial sums that one task adds up, and numbers in such a row.
FAN_IN, SLICE = 32, 1 << 14


def tree_sum(df: DataFrame, run, size: int, stages: Stages, name: str, kind: str = "<f8") -> np.ndarray:
    """The sum over all partitions of an array of a fixed size.

    ``run(batches)`` yields (array, last number) once per partition, more often, or not at all; the two together have
    ``size`` numbers. Sums are added in a tree of fan-in FAN_IN, slice by slice, so no task and not the driver holds more than a fixed number of arrays.
    """
    slices = -(-size // SLICE)

    def partial(batches):
        from pyspark import TaskContext

        total = None
        for array, last in run(batches):
            if total is None:
                total = np.zeros(slices * SLICE)
            total[: size - 1] += array
            total[size - 1] += last
        if total is None:
            return
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * slices, pa.int64()), "slice": pa.array(range(slices), pa.int64()),
            "sums": pa.array([total[i * SLICE: (i + 1) * SLICE].astype(kind).tobytes() for i in range(slices)], pa.binary()),
        })

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE)
        for sums in rows["sums"]:
            total += np.frombuffer(sums, kind)
        return rows.head(1).assign(sums=total.astype(kind).tobytes())

    schema = "part long, slice long, sums binary"
    sums = stages.write(df.mapInArrow(partial, schema), f"{name}-0")
    parts, level = (sums.selectExpr("max(part) + 1").first()[0] or 0), 0
    while parts > 1:
        level += 1
        groups = sums.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "slice")
        sums = stages.write(groups.applyInPandas(add, schema), f"{name}-{level}")
        stages.drop(f"{name}-{level - 1}")
        parts = -(-parts // FAN_IN)
    total = np.zeros(slices * SLICE)
    for row in sums.collect():  # one row per slice
        total[row.slice * SLICE: (row.slice + 1) * SLICE] += np.frombuffer(row.sums, kind)
    stages.drop(f"{name}-{level}")
    return total[:size]
