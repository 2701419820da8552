"""Lookup tables of the report model, and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkledger.config import Settings
from linkledger.functions import lists
from linkledger.functions.columns import COHORTS
from linkledger.operators import parity
from linkledger.operators.definitions import LINKAGE_TEXTS, PRIORITY_TEXTS, TIER_TEXTS, ratio, rule_definition
from linkledger.operators.rules import all_rules

LINKAGE_METRICS = (
    "linked_count", "unlinked_count", "ckc_id_no_cross_ref", "type_mismatch_linkage",
    "duplicate_entity_id", "orphan_cross_ref",
)
LABEL_SCHEMA = "id string, label string, description string, sort_order int"
METRIC_SCHEMA = (
    "metric_name string, metric_category string, label string, definition string, "
    "is_issue boolean, parity_field string, parity_outcome string"
)

TYPE_LABELS = {
    "B": ("Business", "A firm"), "C": ("Contact", "A person at a firm"),
    "I": ("Individual", "A person on their own"), "ALL": ("All Types", "Every contact type together"),
}
BUCKET_LABELS = {
    "0-1yr": "Within a year", "1-2yr": "One to two years ago", "2-3yr": "Two to three years ago",
    "3-4yr": "Three to four years ago", "4-5yr": "Four to five years ago", "5+yr": "Five years ago or longer",
    "never_transacted": "Account without activity", "no_account": "Without account",
}
OUTCOME_NOTES = {
    "match": "Both sides hold the same value", "mismatch": "The two sides hold different values",
    "equip_only": "Only the contact record holds a value", "registry_only": "Only the registry holds a value",
    "both_null": "Neither side holds a value",
}
OUTCOME_LABELS = {
    "match": "Match", "mismatch": "Mismatch", "equip_only": "Contact Only",
    "registry_only": "Registry Only", "both_null": "Both Null",
}
_ACRONYMS = {"id": "ID", "dba": "DBA", "oob": "OOB", "ckc": "CKC", "nanp": "NANP", "2char": "2-Char"}


def title_of(name: str) -> str:
    return " ".join(_ACRONYMS.get(w, w.capitalize()) for w in name.split("_"))


def _numbered(rows: list[tuple[str, str, str]]) -> list[tuple[str, str, str, int]]:
    return [(*row, i) for i, row in enumerate(rows, start=1)]


def dimension_rows() -> dict[str, list[tuple]]:
    """Rows of the six small lookup tables."""
    def decile(i: int) -> tuple[str, str, str]:
        return f"D{i}", f"Decile {i}", f"Accounts in tenth {i} of the 60-month revenue, highest first"

    def bucket(b: str) -> tuple[str, str, str]:
        return b, BUCKET_LABELS[b], f"Last account activity: {BUCKET_LABELS[b].lower()}"

    return {
        "dim_contact_type": _numbered([(k, *v) for k, v in TYPE_LABELS.items()]),
        "dim_sales_decile": _numbered(
            [decile(i) for i in range(1, 11)]
            + [("Unranked", "Unranked", "No positive revenue in the 60 months"), ("ALL", "All Deciles", "Every decile together")]
        ),
        "dim_staleness_bucket": _numbered(
            [bucket(b) for b in BUCKET_LABELS] + [("ALL", "All Buckets", "Every bucket together")]
        ),
        "dim_parity_field": _numbered(
            [(f.name, f.label, f"{f.label} on both sides; types {', '.join(f.types)}") for f in parity.FIELDS]
        ),
        "dim_parity_outcome": _numbered([(o, OUTCOME_LABELS[o], OUTCOME_NOTES[o]) for o in lists.PARITY_OUTCOMES]),
        "dim_creation_cohort": _numbered(
            [("Unknown", "Unknown", "Without creation date")]
            + [(label, label, f"Created in years {label}") for label, _ in COHORTS["current"]]
            + [("ALL", "All Cohorts", "Every cohort together")]
        ),
    }


def metric_rows(settings: Settings) -> list[tuple]:
    """One row per snapshot metric, derived from the registries."""
    rows = [
        (m, "linkage", title_of(m), ratio(*LINKAGE_TEXTS[m]), m != "linked_count", None, None)
        for m in LINKAGE_METRICS
    ]
    rows += [
        (f"{f.name}_{o}", "parity", f"{f.label}: {OUTCOME_LABELS[o]}",
         ratio(f"{f.label.lower()}: {OUTCOME_NOTES[o].lower()}", f"linked contacts of type {', '.join(f.types)}"),
         o not in ("match", "both_null"), f.name, o)
        for f in parity.FIELDS for o in lists.PARITY_OUTCOMES
    ]
    rows += [(m, "parity", title_of(m), ratio(*PRIORITY_TEXTS[m]), True, None, None) for m in parity.PRIORITY]
    rows += [
        (r.name, r.category, title_of(r.name), rule_definition(r.name, r.scope), True, None, None)
        for r in all_rules(settings)
    ]
    rows += [
        (b, "staleness", BUCKET_LABELS[b],
         ratio(f"contacts whose last account activity is: {BUCKET_LABELS[b].lower()}", "all active contacts"), False, None, None)
        for b in lists.STALENESS_BUCKETS
    ]
    rows += [
        (t, "match_readiness", title_of(t), ratio(TIER_TEXTS[t], "unlinked contacts"), False, None, None)
        for t in lists.MATCH_TIERS
    ]
    return rows


def dimension(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(dimension_rows()[name], LABEL_SCHEMA)


def dim_metric(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.createDataFrame(metric_rows(settings), METRIC_SCHEMA)


def dimension_usage(dim: DataFrame, contacts: DataFrame, column: str) -> DataFrame:
    """A lookup table with the number of contacts behind each id; 'ALL' counts everyone.

    Counts per id are a handful of rows, as ids come from the fixed list.
    """
    used = contacts.groupBy(F.col(column).alias("id")).agg(F.expr("count(*) AS contacts"))
    everyone = contacts.agg(F.expr("count(*) AS contacts")).selectExpr("'ALL' AS id", "contacts")
    return dim.join(used.unionByName(everyone), "id", "left").selectExpr(
        *dim.columns, "coalesce(contacts, 0) AS contacts"
    ).orderBy("sort_order")


def metric_usage(dim: DataFrame, snapshot: DataFrame) -> DataFrame:
    used = snapshot.groupBy("metric_name").agg(F.expr("count(*) AS snapshot_rows"))
    return dim.join(used, "metric_name", "left").selectExpr(*dim.columns, "coalesce(snapshot_rows, 0) AS snapshot_rows")


def metric_name_parity(snapshot: DataFrame, dim: DataFrame) -> DataFrame:
    """Names on one side only; an empty result is a pass."""
    facts, known = snapshot.select("metric_name").distinct(), dim.select("metric_name").distinct()
    return facts.subtract(known).selectExpr("metric_name", "'missing from dimension' AS finding").unionByName(
        known.subtract(facts).selectExpr("metric_name", "'not in snapshot' AS finding")
    )


def dim_calendar(snapshot: DataFrame) -> DataFrame:
    """Every day of the years the snapshots span."""
    span = snapshot.agg(F.expr("min(snapshot_date) AS lo"), F.expr("max(snapshot_date) AS hi"))
    days = span.selectExpr(
        "explode(sequence(make_date(year(lo), 1, 1), make_date(year(hi), 12, 31))) AS date"
    )
    return days.selectExpr(
        "date", "year(date) AS year", "month(date) AS month_no", "date_format(date, 'MMMM') AS month",
        "quarter(date) AS quarter_no", "concat('Qtr ', quarter(date)) AS quarter", "day(date) AS day",
    )
