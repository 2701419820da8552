"""Labelled documents for classifiers: the training fold, as a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null ids count as the text ``null``."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit("null"))
    return F.crc32(text.cast("binary")) % divisor


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label, pick) of at most ``most`` labelled documents outside the held-out fold, picked by a hash
    of their id. Labels that are null, and ids that are null or contradict themselves, are left out. Of several rows
    with one id the text with the smallest hash is taken, so the bound holds for rows."""
    known = labels.filter(f"doc_id is not null and {label} in (0, 1)").groupBy("doc_id").agg(
        F.min(label).alias("label"), F.max(label).alias("other")).filter("label = other")
    known = known.filter(remainder("doc_id", 3) != 1).select(
        "doc_id", F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("pick"))
    known = known.orderBy("pick").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return rows.groupBy("doc_id", "label", "pick").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label", "pick")
