"""From raw documents to packed training sequences, in stages of the operators in ``linkledger.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept:

1. quality: documents that the classifier rejects go;
2. near duplicates: one document of each group stays;
3. decontamination: documents that hold a window of the benchmark go;
4. personal data: spans are masked in the texts, and ``n_chars`` follows;
5. packing: pieces of the documents and their places in sequences of 2048 tokens.

All but the last return the columns of the documents, in their order. Stages keep rows with null ids and texts unless
their rule says otherwise (see the operators); an empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkledger.llm import decontam, ngram_join, packing, pii, quality
from linkledger.llm.common import Stages, released
from linkledger.llm.queries import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs, "n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near duplicates", without_near_copies),
    ("decontamination", decontaminated),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: SQL cannot express the stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder; every stage is written and read again, and what it wrote
    itself is deleted then."""
    docs = table(spark, sf_dir, "documents")
    stages = Stages(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES, 1):
        with released():
            docs = stages.write(stage(spark, docs, sf_dir), f"stage-{number}")
        if number > 1:
            stages.drop(f"stage-{number - 1}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
