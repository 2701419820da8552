"""Every query by name, as a function of a workspace."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from linkledger.config import r60_window
from linkledger.functions.columns import MATCH_TIER, lit
from linkledger.operators import (
    dimensions, extracts, parity, population, profiling, quality, reconcile, reports, revenue, tracking,
)
from linkledger.operators.rules import all_rules, checks, completeness_rules, field_quality_rules
from linkledger.plans import snapshot, weekly
from linkledger.plans.workspace import Workspace
from linkledger.sources import publishing, readers, sinks

Query = Callable[[Workspace], DataFrame]


def _t(ws: Workspace, *names: str) -> list[DataFrame]:
    return [ws.table(n) for n in names]


# Stages

def r60_window_volumes(ws: Workspace) -> DataFrame:
    """The revenue window with the billed invoices and sold units inside it."""
    start, end = r60_window(ws.settings.as_of)
    invoices = revenue.billed(ws.table("invoice")).selectExpr("1 AS invoices", "0 AS units", "invo_datetime AS happened")
    units = ws.table("unit_sale").selectExpr("0 AS invoices", "1 AS units", "sales_date AS happened")
    inside = invoices.unionByName(units).filter(revenue.in_window("happened", start, end))
    return inside.agg(
        *revenue.exprs("coalesce(sum(invoices), 0) AS invoices", "coalesce(sum(units), 0) AS units")
    ).selectExpr(f"{lit(start)} AS start_date", f"{lit(end)} AS end_date", "invoices", "units")


#: Columns of the contacts that serve other queries only.
INTERNAL = ("code_key", "links", "contact_level_links", "code_repeats", "flags", "compared", "priorities")


def _shown(contacts: DataFrame) -> DataFrame:
    return contacts.drop(*INTERNAL, *(c for c in contacts.columns if c.startswith(("rules_", "outcomes_"))))

STAGES: dict[str, Query] = {
    "r60_window": r60_window_volumes,
    "account_revenue": Workspace.account_revenue,
    "sales_decile_ntile": lambda ws: ws.ranked_revenue("ntile").filter("raw_decile IS NOT NULL"),
    "sales_decile_share": lambda ws: ws.ranked_revenue("share").filter("raw_decile IS NOT NULL"),
    "last_transaction": Workspace.last_transaction,
    "active_contacts": Workspace.active,
    "contact_enriched": lambda ws: _shown(ws.enriched()),
    "contact_linkage": lambda ws: population.contact_linkage(ws.enriched(), ws.links()),
    "unlinked_contacts": lambda ws: _shown(population.unlinked_contacts(ws.enriched(), ws.links())),
    "active_linked": lambda ws: _shown(ws.linked()).drop("creation_date"),
    "inactive_linked": Workspace.inactive_linked,
    "field_parity": lambda ws: parity.field_parity(ws.linked()),
    "linked_counts": lambda ws: population.linked_counts(ws.linked()),
    "dup_codes": lambda ws: population.dup_codes(ws.enriched()),
    "match_tier": lambda ws: ws.unlinked().selectExpr("contact_code", "contact_type", f"{MATCH_TIER} AS tier"),
    "dq_snapshot": snapshot.dq_snapshot,
}


# Metrics

def _metric(category: str, name: str) -> Query:
    return lambda ws: snapshot.metric(ws, category, name)


def metrics(settings) -> dict[str, Query]:
    found = {f"lk_{m}": _metric("linkage", m) for m in dimensions.LINKAGE_METRICS}
    found |= {f"pa_{f.name}": _metric("parity", f.name) for f in parity.FIELDS}
    found |= {f"pp_{m}": _metric("priority", m) for m in parity.PRIORITY}
    found |= {f"cp_{r.name}": _metric("completeness", r.name) for r in completeness_rules()}
    found |= {f"fq_{r.name}": _metric("field_quality", r.name) for r in field_quality_rules(settings)}
    found["sb_staleness"] = lambda ws: snapshot.section(ws, "staleness")
    found["sb_staleness_365d"] = lambda ws: snapshot.section(ws.with_staleness_step("365d"), "staleness")
    found["tr_tiers"] = lambda ws: snapshot.section(ws, "match_readiness")
    return found


# Profiling, each also with the exact-case join where it matters

_CONTACT_XREF = {
    "link_level_by_type": profiling.link_level_by_type,
    "id_agreement": profiling.id_agreement,
    "contact_entity_only": profiling.contact_entity_only,
    "duplicate_type_combo": profiling.duplicate_type_combo,
    "entity_range_by_type": profiling.entity_range_by_type,
}
_CRM_XREF = {
    "crm_xref_agreement": profiling.crm_xref_agreement,
    "crm_xref_disagreements": profiling.crm_xref_disagreements,
    "crm_without_xref": profiling.crm_without_xref,
}


def _case_variants() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for suffix, exact in (("", False), ("_exact_case", True)):
        for name, fn in _CONTACT_XREF.items():
            found[name + suffix] = lambda ws, fn=fn, exact=exact: fn(*_t(ws, "contact", "xref"), exact)
        found["duplicate_entity_list" + suffix] = lambda ws, exact=exact: profiling.duplicate_entity_list(
            *_t(ws, "contact", "xref"), ws.scratch.stage, exact
        )
        for name, fn in _CRM_XREF.items():
            found[name + suffix] = lambda ws, fn=fn, exact=exact: fn(
                *_t(ws, "crm_account", "account", "contact", "xref"), ws.settings, exact
            )
    return found


PROFILES: dict[str, Query] = {
    "contact_type_breakdown": lambda ws: profiling.contact_type_breakdown(ws.table("contact")),
    "account_cardinality": lambda ws: profiling.account_cardinality(ws.table("account")),
    "links_per_entity": lambda ws: profiling.links_per_entity(ws.table("xref")),
    "crm_breakdown": lambda ws: profiling.crm_breakdown(ws.table("crm_account"), ws.settings),
    "entity_range_profile": lambda ws: profiling.entity_range_profile(ws.table("profile")),
    "case_mismatch_sample": lambda ws: profiling.case_mismatch_sample(*_t(ws, "contact", "xref")),
    "case_false_positives": lambda ws: profiling.case_false_positives(*_t(ws, "contact", "xref"), ws.settings),
    "parent_lookup": lambda ws: profiling.parent_lookup(ws.table("contact")),
    "coded_value_listing": lambda ws: profiling.coded_value_listing(*_t(ws, "contact", "technician", "salesperson")),
    **_case_variants(),
}


# Extracts, checks, tracking and reconciliation

def _reconciled(ws: Workspace) -> DataFrame:
    ids = reconcile.crm_ids(*_t(ws, "crm_account", "account", "contact"), ws.settings)
    return reconcile.reconcile_matches(ws.table("tight_match"), ids)


def _split(status: str) -> Query:
    return lambda ws: reconcile.split_matches(
        _reconciled(ws), status, reconcile.employee_codes(*_t(ws, "contact", "technician", "salesperson"))
    )


def _history(ws: Workspace) -> DataFrame:
    return revenue.account_sales_history(*ws.transactions(), ws.settings.history_from, ws.settings.as_of.year)


LINKAGE_WORK: dict[str, Query] = {
    "path_a_extract": lambda ws: extracts.path_a_extract(*_t(ws, "contact", "technician", "salesperson", "xref"), ws.settings),
    "path_a_count": lambda ws: extracts.path_a_count(*_t(ws, "contact", "technician", "salesperson", "xref"), ws.settings),
    "path_a_validation": lambda ws: extracts.path_a_validation(*_t(ws, "contact", "xref", "profile"), ws.settings),
    "path_b_extract": lambda ws: extracts.path_b_extract(
        *_t(ws, "crm_account", "account", "contact", "technician", "salesperson"), ws.settings),
    "writeback_status": lambda ws: extracts.writeback_status(*_t(ws, "crm_account", "account", "contact", "xref"), ws.settings),
    "registry_status_check": lambda ws: extracts.registry_status_check(
        *_t(ws, "crm_account", "account", "contact", "technician", "salesperson", "profile"), ws.settings),
    "tracking_totals": lambda ws: tracking.tracking_totals(ws.table("xref"), ws.settings),
    "tracking_daily": lambda ws: tracking.tracking_daily(ws.table("xref"), ws.settings),
    "reconcile_matches": _reconciled,
    "reconcile_summary": lambda ws: reconcile.reconcile_summary(_reconciled(ws)),
    "split_agree": _split("AGREE"),
    "split_disagree": _split("DISAGREE"),
    "employee_codes": lambda ws: reconcile.employee_codes(*_t(ws, "contact", "technician", "salesperson")),
    "account_sales_decile": lambda ws: revenue.account_sales_decile(
        population.active_with_account(*_t(ws, "contact", "technician", "salesperson", "account")),
        ws.ranked_revenue("ntile"), ws.settings),
    "account_sales_history": _history,
    "last_goods_date": lambda ws: revenue.last_goods_date(ws.table("unit_sale")),
    "last_parts_date": lambda ws: revenue.last_parts_date(ws.table("invoice")),
    "last_service_date": lambda ws: revenue.last_service_date(ws.table("invoice")),
    "last_rental_date": lambda ws: revenue.last_rental_date(*_t(ws, "invoice", "rental")),
    "sales_by_decile": lambda ws: revenue.sales_by_decile(ws.ranked_revenue("share")),
}


# Issue map, dimensions, stored snapshots

def _usage(name: str, column: str) -> Query:
    return lambda ws: dimensions.dimension_usage(dimensions.dimension(ws.spark, name), ws.enriched(), column)


def _parity_usage(name: str, column: str) -> Query:
    return lambda ws: dimensions.dimension_usage(
        dimensions.dimension(ws.spark, name), parity.field_parity(ws.linked()), column
    )


def _older(fn: Query) -> Query:
    return lambda ws: fn(ws.with_cohorts("older"))


STORED: dict[str, Query] = {
    "issue_map": weekly.issue_map,
    "issue_map_counts": lambda ws: weekly.issue_map(ws).groupBy("metric_name").agg(F.count("*").alias("issue_rows")).orderBy("metric_name"),
    "snapshot_verification": lambda ws: reports.snapshot_verification(snapshot.stored_snapshots(ws)),
    "dim_metric": lambda ws: dimensions.metric_usage(dimensions.dim_metric(ws.spark, ws.settings), snapshot.stored_snapshots(ws)),
    "metric_name_parity": lambda ws: dimensions.metric_name_parity(snapshot.stored_snapshots(ws), dimensions.dim_metric(ws.spark, ws.settings)),
    "dim_contact_type": _usage("dim_contact_type", "contact_type"),
    "dim_sales_decile": _usage("dim_sales_decile", "sales_decile"),
    "dim_staleness_bucket": _usage("dim_staleness_bucket", "staleness_bucket"),
    "dim_parity_field": _parity_usage("dim_parity_field", "field_name"),
    "dim_parity_outcome": _parity_usage("dim_parity_outcome", "parity_result"),
    "dim_creation_cohort": _usage("dim_creation_cohort", "creation_cohort"),
    "dim_calendar": lambda ws: dimensions.dim_calendar(snapshot.stored_snapshots(ws)),
    **snapshot.STANDALONE_SECTIONS,
    **{f"{n}_older_cohorts": _older(fn) for n, fn in snapshot.STANDALONE_SECTIONS.items()},
}


# Measures and report rollups

def _measure(name: str) -> Query:
    return lambda ws: reports.latest(snapshot.stored_snapshots(ws)).agg(reports.measure(name))


def _report(visual: reports.Visual) -> Query:
    return lambda ws: reports.report(snapshot.stored_snapshots(ws), visual)


def clean_records(ws: Workspace) -> DataFrame:
    return quality.clean_record_pct(ws.enriched(), checks(ws.settings, all_rules(ws.settings)))


REPORTS: dict[str, Query] = {
    **{f"measure_{m}": _measure(m) for m in ("issue_rate", "issue_count", "record_count", "pct_linked", "stale_5yr", "match_ready")},
    "measure_issue_rate_issues_only": lambda ws: reports.issue_rate_of_issues(
        snapshot.stored_snapshots(ws), dimensions.dim_metric(ws.spark, ws.settings)),
    **{f"rpt_{n}": _report(v) for n, v in reports.VISUALS.items()},
    "rpt_2": clean_records,
}


# Specified in the docs of the workflow

FIELD_NAMES = [f.name for f in parity.FIELDS]

SPECIFIED: dict[str, Query] = {
    "clean_record_pct": clean_records,
    "quality_index": lambda ws: quality.quality_index(
        ws.enriched(), checks(ws.settings, [r for r in field_quality_rules(ws.settings) if r.in_snapshot])),
    "parity_sum_check": lambda ws: reports.parity_sum_check(snapshot.stored_snapshots(ws), FIELD_NAMES),
    "snapshot_delta": lambda ws: reports.latest_delta(snapshot.stored_snapshots(ws)),
    "snapshot_coverage": lambda ws: reports.coverage(snapshot.stored_snapshots(ws)),
    "prospect_customer_pairs": lambda ws: extracts.prospect_customer_pairs(ws.table("crm_account"), ws.settings),
    "duplicate_candidates": lambda ws: quality.duplicate_groups(
        quality.duplicate_candidates(ws.enriched(), ws.settings), ws.scratch.stage),
    "upload_batches": lambda ws: extracts.upload_batches(ws.unlinked(), ws.scratch.stage),
    "upload_validation": lambda ws: extracts.upload_validation(LINKAGE_WORK["path_b_extract"](ws)),
    "match_type_alignment": lambda ws: extracts.match_type_alignment(*_t(ws, "tight_match", "contact")),
    "contact_extract": lambda ws: extracts.contact_extract(ws.unlinked(), 500, dt.date(2016, 1, 1)),
    "path_delete_extract": lambda ws: extracts.path_delete_extract(*_t(ws, "contact", "xref"), ws.settings),
    "inactivation_candidates": lambda ws: extracts.inactivation_candidates(
        ws.enriched(), dt.date(1999, 8, 15), dt.date(2020, 1, 1)),
    "unlinked_recent_invoice": lambda ws: extracts.unlinked_recent_invoice(ws.unlinked(), ws.table("invoice")),
    "linkage_progress": lambda ws: reports.linkage_progress(snapshot.stored_snapshots(ws)),
}


# Writers and readers

def io_append_roundtrip(ws: Workspace) -> DataFrame:
    """Append two dates one after the other and read both back."""
    path = ws.scratch.path("append")
    for day in ws.settings.dates[-2:]:
        sinks.append_snapshot(snapshot.section(ws.at(day), "linkage"), path)
    return readers.read_snapshot(ws.spark, path)


def io_overwrite_roundtrip(ws: Workspace) -> DataFrame:
    """Reset, append another date, then write that date again: its rows stay single."""
    path = ws.scratch.path("overwrite")
    first, *later = [snapshot.section(ws.at(day), "completeness") for day in ws.settings.dates[-2:]]
    sinks.reset_snapshots(first, path)
    for rows in later:
        sinks.append_snapshot(rows, path)
    sinks.replace_snapshot(later[-1] if later else first, path)
    return readers.read_snapshot(ws.spark, path)


def io_csv_roundtrip(ws: Workspace) -> DataFrame:
    """Write the link upload as CSV, null as empty text, and read it as text."""
    path = ws.scratch.path("upload") + ".csv"
    upload = LINKAGE_WORK["path_a_extract"](ws)
    sinks.export_text(upload, path, headers=extracts.LINK_HEADERS)
    back = {theirs: ours for ours, theirs in extracts.LINK_HEADERS.items()}
    return readers.read_csv(ws.spark, path).withColumnsRenamed(back)


def io_match_reports(ws: Workspace) -> DataFrame:
    """Write the match report as two files, read both as one and reconcile."""
    paths = [ws.scratch.path(f"matches{i}") + ".csv" for i in (1, 2)]
    matches = ws.table("tight_match")
    for path, part in zip(paths, (matches.filter("contact_id = '0'"), matches.filter("contact_id <> '0'"))):
        sinks.export_text(part, path)
    ids = reconcile.crm_ids(*_t(ws, "crm_account", "account", "contact"), ws.settings)
    return reconcile.reconcile_matches(readers.read_match_reports(ws.spark, paths), ids)


def io_weekly_run(ws: Workspace) -> DataFrame:
    """Run for two dates, the later one twice, and profile what is current."""
    root = ws.scratch.path("weekly")
    days = ws.settings.dates[-2:]
    for day in (*days, days[-1]):
        weekly.weekly_run(ws.at(day), root, lookups=True)
    counts = publishing.read_snapshots(ws.spark, root).groupBy("snapshot_date", "metric_category").agg(
        *revenue.exprs("count(*) AS row_count", "sum(numerator) AS total")
    ).selectExpr("'snapshot' AS target", "snapshot_date", "metric_category AS name", "row_count", "total")
    mapped = publishing.read_issue_map(ws.spark, root).groupBy("snapshot_date", "metric_name").agg(
        F.expr("count(*) AS row_count")
    ).selectExpr("'issue map' AS target", "snapshot_date", "metric_name AS name", "row_count", "cast(NULL AS bigint) AS total")
    found = counts.unionByName(mapped)
    for name in weekly.lookup_tables(ws):
        found = found.unionByName(publishing.read_lookup(ws.spark, root, name).agg(
            *revenue.exprs("'lookup' AS target", "cast(NULL AS date) AS snapshot_date", f"{lit(name)} AS name",
                           "count(*) AS row_count", "cast(NULL AS bigint) AS total")))
    return found


def io_named_files(ws: Workspace) -> DataFrame:
    """Export the match layout and both outcomes of the reconciliation as named files; profile the files read back."""
    folder, stamp = ws.scratch.path("files"), dt.datetime.combine(ws.settings.as_of, dt.time())
    exports = {
        "match-upload": (LINKAGE_WORK["path_b_extract"](ws), "dbs_customer_number", extracts.MATCH_HEADERS),
        "agree": (LINKAGE_WORK["split_agree"](ws), "dbs_number", extracts.LINK_HEADERS),
        "disagree": (LINKAGE_WORK["split_disagree"](ws), "dbs_number", extracts.LINK_HEADERS),
    }
    for stem, (rows, key, headers) in exports.items():
        sinks.export_files(rows, folder, stem, stamp, [key], ws.scratch.stage, headers, file_rows=100)
    found = None
    for stem, (_, key, headers) in exports.items():
        read = readers.read_csv(ws.spark, f"{folder}/{stem}-*").withColumnRenamed(headers[key], "code").selectExpr(
            "element_at(split(input_file_name(), '/'), -1) AS file_name", "code")
        found = read if found is None else found.unionByName(read)
    return found.groupBy("file_name").agg(*revenue.exprs(
        "count(*) AS row_count", "min(code) AS first_code", "max(code) AS last_code"))


def io_upload_files(ws: Workspace) -> DataFrame:
    """Write upload batches of at most 200 contacts and profile the files read back."""
    folder = ws.scratch.path("batches")
    sinks.export_batches(extracts.upload_batches(ws.unlinked(), ws.scratch.stage, 200), folder, 200)
    return readers.read_csv(ws.spark, folder).groupBy("batch_no").agg(*revenue.exprs(
        "count(*) AS contacts", "min(cast(upload_position AS bigint)) AS first_position",
        "max(cast(upload_position AS bigint)) AS last_position",
        "cast(sum(cast(total_revenue AS decimal(18,2))) AS decimal(18,2)) AS total_revenue",
    )).orderBy("batch_no")


def io_exclusion_file(ws: Workspace) -> DataFrame:
    """Write employee codes one per line and split the agreeing matches with that file."""
    path = ws.scratch.path("employees")
    reconcile.employee_codes(*_t(ws, "contact", "technician", "salesperson")).write.text(path)
    return reconcile.split_matches(_reconciled(ws), "AGREE", readers.read_exclusions(ws.spark, path))


def io_dimension_roundtrip(ws: Workspace) -> DataFrame:
    """Write the lookup tables behind their flag; count contacts over one read back."""
    folder = ws.scratch.path("dimensions")
    dims = {n: dimensions.dimension(ws.spark, n) for n in dimensions.dimension_rows()}
    sinks.write_dimensions(dims, folder, enabled=True)
    dim = ws.spark.read.parquet(f"{folder}/dim_contact_type")
    return dimensions.dimension_usage(dim, ws.enriched(), "contact_type")


def io_sql_scan(ws: Workspace) -> DataFrame:
    """Scan by name in SQL."""
    return ws.sql(
        "SELECT contact_type, count(*) AS contacts, count(ckc_id) AS with_id FROM {contact} GROUP BY contact_type", "contact"
    )


IO: dict[str, Query] = {
    "io_append_roundtrip": io_append_roundtrip,
    "io_overwrite_roundtrip": io_overwrite_roundtrip,
    "io_csv_roundtrip": io_csv_roundtrip,
    "io_match_reports": io_match_reports,
    "io_exclusion_file": io_exclusion_file,
    "io_upload_files": io_upload_files,
    "io_named_files": io_named_files,
    "io_weekly_run": io_weekly_run,
    "io_dimension_roundtrip": io_dimension_roundtrip,
    "io_sql_scan": io_sql_scan,
}


def all_queries(settings) -> dict[str, Query]:
    return {
        **STAGES, **metrics(settings), **PROFILES, **LINKAGE_WORK, **STORED, **REPORTS, **SPECIFIED, **IO,
    }
