"""Writers for snapshots, issue maps, lookup tables and export files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from linkledger.operators.ranking import in_global_order
from linkledger.sources import schemas
from linkledger.storage import hadoop_path

# Limits of the upload tool.
NAME_LENGTH = 50
FILE_ROWS = 60_000
FILE_BYTES = 6_000_000


def write_snapshot(df: DataFrame, path: str) -> None:
    """The rows of a run, as a table of their own."""
    _by_category(df).write.partitionBy("snapshot_date").parquet(path)


def append_snapshot(df: DataFrame, path: str) -> None:
    """Add a run to the stored snapshots. It may have columns that earlier runs lack."""
    schemas.widen(df.sparkSession, path, df.schema)
    _by_category(df).write.mode("append").partitionBy("snapshot_date").parquet(path)


def _by_category(df: DataFrame) -> DataFrame:
    """Few files per date, instead of one per task of each section; a category of many rows is split."""
    return df.hint("rebalance", "snapshot_date", "metric_category")


def reset_snapshots(df: DataFrame, path: str) -> None:
    """Drop all stored snapshots and start with this run."""
    fs, at = hadoop_path(df.sparkSession, f"{path}/{schemas.FILE}")
    fs.delete(at, False)
    _by_category(df).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("snapshot_date").parquet(path)
    schemas.widen(df.sparkSession, path, df.schema)


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Write a run again; only the partitions of its dates are replaced."""
    schemas.widen(df.sparkSession, path, df.schema)
    _by_category(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Issue maps and lookup tables hold the newest run only."""
    df.write.mode("overwrite").parquet(path)


def write_dimensions(dims: dict[str, DataFrame], folder: str, enabled: bool = False) -> list[str]:
    """Write the lookup tables, only when asked to."""
    if not enabled:
        return []
    for name, df in dims.items():
        overwrite(df, f"{folder}/{name}")
    return list(dims)


def export_text(df: DataFrame, path: str, null_text: str = "", headers: dict[str, str] | None = None) -> None:
    """Text files with header: commas for a ``.csv`` path, tabs otherwise.

    Null is written as ``null_text``; empty text stays empty. Files are written
    by all tasks; nothing is gathered on the driver.
    """
    renamed = df.withColumnsRenamed(headers or {})
    (
        renamed.write.mode("overwrite")
        .option("header", True)
        .option("sep", "," if path.endswith(".csv") else "\t")
        .option("nullValue", null_text)
        .option("emptyValue", "")
        .csv(path)
    )


def export_batches(df: DataFrame, folder: str, file_rows: int) -> None:
    """One CSV file per ``batch_no``, of at most ``file_rows`` rows; batches are spread over the tasks."""
    (
        df.repartition("batch_no").sortWithinPartitions("batch_no", "upload_position")
        .write.mode("overwrite").partitionBy("batch_no")
        .option("header", True).option("maxRecordsPerFile", file_rows).option("emptyValue", "")
        .csv(folder)
    )


def export_name(stem: str, extension: str, stamp: dt.datetime, number: int | None = None) -> str:
    """File name with time stamp; the stem is cut so that the name fits."""
    tail = f"{'' if number is None else f'-{number}'}-{stamp:%Y%m%d-%H%M%S}{extension}"
    return stem[: NAME_LENGTH - len(tail)] + tail


def row_bytes(columns: list[str]) -> str:
    """Bytes of a row in a CSV file at most: a field may double its quotation marks and gets two around it and a comma."""
    return "1 + " + " + ".join(
        f"coalesce(octet_length(cast(`{c}` AS string)) + length(cast(`{c}` AS string)) "
        f"- length(replace(cast(`{c}` AS string), '\"', '')), 0) + 3" for c in columns
    )


#: A row above this part of a file's size is wide.
WIDE = 16


def with_file(df: DataFrame, order: list[str], stage, header: str, file_rows: int, file_bytes: int) -> DataFrame:
    """Add ``position`` and ``_file``, which grows with it: files hold ``file_rows`` rows and ``file_bytes`` bytes at most.

    A row's file follows from the bytes of all rows before it, so files are nearly full whatever their rows are like. A
    wide row has a file of its own: it may not share the space that the last row of a file needs. Only a row that is
    above the limit by itself makes a file above it.
    """
    room = file_bytes - len(header.encode()) - 2
    step = max(1, room - room // WIDE)
    sized = df.selectExpr("*", f"cast({row_bytes(df.columns)} AS bigint) AS _bytes")
    wide = f"_bytes > {room // WIDE}"
    # A wide row takes two steps: its own file is the one after the rows before, and the rows behind it have a third.
    taken = f"if({wide}, {2 * step}, _bytes)"
    placed = in_global_order(sized, order, stage, taken)
    return placed.withColumn("_file", F.expr(
        f"((position - 1) div {file_rows}) * {1 << 32}L "
        f"+ cast(running - {taken} + if({wide}, {step}, 0) AS bigint) div {step}")).drop("_bytes")


def export_files(df: DataFrame, folder: str, stem: str, stamp: dt.datetime, order: list[str], stage,
                 headers: dict[str, str], file_rows: int = FILE_ROWS, file_bytes: int = FILE_BYTES) -> None:
    """CSV files with the template's header, in order, named and within the limits of the upload tool.

    Rows are placed in a distributed order and every file is written by one task; the driver only renames files.
    An empty table gives one file with the header.
    """
    renamed = df.withColumnsRenamed(headers)
    placed = with_file(df, order, stage, ",".join(renamed.columns), file_rows, file_bytes)
    parts = f"{folder}/_parts-{stem}"
    (
        placed.repartition("_file").sortWithinPartitions("_file", "position")
        .select("_file", *df.columns).withColumnsRenamed(headers)
        .write.mode("overwrite").partitionBy("_file").option("header", True).option("emptyValue", "").csv(parts)
    )
    fs, at = hadoop_path(df.sparkSession, parts)
    written = {int(f.getPath().getName().partition("=")[2]): f.getPath() for f in fs.listStatus(at)
               if f.getPath().getName().startswith("_file=")}
    for number, file in enumerate(sorted(written), 1):
        part = next(f.getPath() for f in fs.listStatus(written[file]) if f.getPath().getName().endswith(".csv"))
        _, target = hadoop_path(df.sparkSession, f"{folder}/{export_name(stem, '.csv', stamp, number)}")
        fs.delete(target, False)
        fs.rename(part, target)
    fs.delete(at, True)
    if not written:
        _, target = hadoop_path(df.sparkSession, f"{folder}/{export_name(stem, '.csv', stamp, 1)}")
        out = fs.create(target, True)
        out.write(bytearray((",".join(renamed.columns) + "\n").encode()))
        out.close()
