"""Columns of a stored table, kept in a small file beside its data.

Runs may add columns. A reader takes the columns from the file, so it opens no data file to learn them, and rows of
earlier runs have nulls in columns that came later.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from linkledger.storage import read_text, write_text

# Spark passes over files whose names begin like this.
FILE = "_columns.json"


class ColumnsDiffer(Exception):
    """A run has another type for a column that is stored already."""


def known(spark: SparkSession, path: str) -> StructType | None:
    text = read_text(spark, f"{path}/{FILE}")
    return StructType.fromJson(json.loads(text)) if text else None


def widened(stored: StructType | None, new: StructType) -> StructType:
    """The stored columns, and those that the new rows add; all may be null."""
    out = {f.name: f.dataType for f in stored or []}
    for f in new:
        if out.setdefault(f.name, f.dataType) != f.dataType:
            raise ColumnsDiffer(f"{f.name}: {out[f.name].simpleString()} is stored, {f.dataType.simpleString()} comes")
    schema = StructType()
    for name, kind in out.items():
        schema.add(name, kind, True)
    return schema


def widen(spark: SparkSession, path: str, new: StructType) -> None:
    """Add the columns of new rows to the file; before the rows are written, so that no reader misses a column."""
    stored = known(spark, path)
    schema = widened(stored, new)
    if schema != stored:
        write_text(spark, f"{path}/{FILE}", schema.json())
