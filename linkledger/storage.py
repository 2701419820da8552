"""Shared scratch space for staged tables.

A staged table is plain parquet under the checkpoint folder the session names,
so it outlives executors and is visible to all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) for a location, through Spark's own file layer."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, at = hadoop_path(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written aside and renamed. Another one of the name is replaced."""
    fs, at = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(at, False)
    if not fs.rename(aside, at):
        fs.delete(aside, False)
        raise OSError(f"{path} could not be written")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a folder; none if it does not exist."""
    fs, at = hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Length and change time of each input, to notice replaced data."""
    marks = []
    for path in paths:
        fs, jpath = hadoop_path(spark, path)
        status = fs.getFileStatus(jpath)
        files = fs.listStatus(jpath) if status.isDirectory() else [status]
        marks.extend((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    return tuple(sorted(marks))


class Scratch:
    """Writes staged tables below one run folder and reads them back."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/linkledger-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        fs, jpath = hadoop_path(self.spark, self.folder)
        fs.delete(jpath, True)
