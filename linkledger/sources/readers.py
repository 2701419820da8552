"""Readers for tables, match reports, exclusion lists and stored snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkledger.sources import schemas
from linkledger.storage import folders

MATCH_REPORT_SCHEMA = "dbs_number string, entity_id string, contact_id string"


# Code columns are fixed-width in some sources: padding goes when a relation is read, so that all joins agree.
CODE_COLUMNS = {
    "contact": "contact_code", "account": "contact_code", "vendor": "contact_code", "technician": "code",
    "salesperson": "code", "xref": "cross_ref_number", "unit_sale": "owner_code", "tight_match": "dbs_number",
}


def without_padding(df: DataFrame, relation: str) -> DataFrame:
    code = CODE_COLUMNS.get(relation)
    return df.withColumn(code, F.rtrim(code)) if code in df.columns else df


class NamedTables:
    """Input relations from catalog tables or parquet paths.

    ``tables`` maps a relation to a table name or path; ``columns`` maps the
    relation's column names to the source's own, where they differ.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, str], columns: dict[str, dict[str, str]] | None = None):
        self.spark = spark
        self.tables = tables
        self.columns = columns or {}

    def table(self, name: str) -> DataFrame:
        source = self.tables[name]
        df = self.spark.read.parquet(source) if "/" in source else self.spark.read.table(source)
        named = df.withColumnsRenamed({theirs: ours for ours, theirs in self.columns.get(name, {}).items()})
        return without_padding(named, name)


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a query that a database runs itself."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every column as text; an empty field reads as empty text."""
    return spark.read.option("header", True).csv(path).na.fill("")


def read_match_reports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several match reports as one; their header row is skipped and the order of columns counts."""
    return spark.read.option("header", True).option("enforceSchema", True).schema(MATCH_REPORT_SCHEMA).csv(paths)


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """One code per line, trimmed, in upper case, blank lines dropped."""
    return spark.read.text(path).select(F.upper(F.trim("value")).alias("contact_code")).filter("contact_code <> ''")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The stored snapshots. Columns come from the file beside the table; those that later runs added read as null in
    earlier ones."""
    columns = schemas.known(spark, path)
    return (spark.read.schema(columns) if columns else spark.read).parquet(path)


def stored_dates(spark: SparkSession, path: str) -> list[dt.date]:
    """Dates of the stored snapshots, the oldest first, from the names of their folders."""
    names = (n.partition("=") for n in folders(spark, path))
    return sorted(dt.date.fromisoformat(day) for column, _, day in names if column == "snapshot_date")
