"""A run over one set of inputs: relations, shared stages and stored snapshots."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkledger.config import Settings, r60_window
from linkledger.functions.columns import creation_cohort, staleness_bucket
from linkledger.operators import parity, population, revenue
from linkledger.storage import Scratch


#: The JVM compiles no method above this size.
METHOD_BYTES = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Let Spark split the widest projections (all rules, all parity fields) into small methods rather than fuse a stage
    into one method that stays interpreted; a limit that the session sets itself is left alone."""
    name, default = "spark.sql.codegen.hugeMethodLimit", "65535"
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, str(METHOD_BYTES))


class Workspace:
    """Relations of one run. Stages that several sections read are written once.

    ``tables`` resolves relation names (see ``FixtureTables`` and ``NamedTables``).
    """

    def __init__(self, spark: SparkSession, tables, settings: Settings, scratch: Scratch | None = None):
        self.spark = spark
        self.tables = tables
        self.settings = settings
        self.scratch = scratch or Scratch(spark)
        compiled_methods(spark)
        self._stages: dict[str, DataFrame] = {}
        self._dated: dict[dt.date, Workspace] = {settings.as_of: self}
        self._variants: dict[str, Workspace] = {}
        self._dateless: dict[str, DataFrame] = {}
        self._standings: dict[tuple[dt.date, dt.date], DataFrame] = {}

    # Inputs

    def table(self, name: str) -> DataFrame:
        return self.tables.table(name)

    def sql(self, text: str, *names: str) -> DataFrame:
        """Run SQL over input relations, named in braces."""
        return self.spark.sql(text, **{n: self.table(n) for n in names})

    def at(self, as_of: dt.date) -> "Workspace":
        """The same inputs seen from another date."""
        if as_of not in self._dated:
            other = Workspace(self.spark, self.tables, self.settings.at(as_of), self.scratch)
            other._dated, other._dateless, other._standings = self._dated, self._dateless, self._standings
            self._dated[as_of] = other
        return self._dated[as_of]

    def with_cohorts(self, cohorts: str) -> "Workspace":
        """The same stages with other creation cohorts; nothing is written again."""
        return self._variant(cohorts, replace(self.settings, cohorts=cohorts), {
            "enriched": self.enriched, "linked": self.linked}, "creation_cohort", creation_cohort("creation_date", cohorts))

    def with_staleness_step(self, step: str) -> "Workspace":
        """The contacts with staleness in other steps; nothing is written again."""
        bucket = staleness_bucket("account_no", "last_tx_date", self.settings.as_of, step)
        return self._variant(
            step, replace(self.settings, staleness_step=step), {"enriched": self.enriched}, "staleness_bucket", bucket)

    def _variant(self, name: str, settings: Settings, stages: dict, column: str, value: str) -> "Workspace":
        if name not in self._variants:
            other = Workspace(self.spark, self.tables, settings, self.scratch)
            other._stages |= {stage: rows().withColumn(column, F.expr(value)) for stage, rows in stages.items()}
            self._variants[name] = other
        return self._variants[name]

    def once(self, name: str, build) -> DataFrame:
        """A relation of this run, built on first use."""
        if name not in self._stages:
            self._stages[name] = build()
        return self._stages[name]

    def staged(self, name: str, build) -> DataFrame:
        """A relation that several sections read, written once."""
        return self.once(name, lambda: self.scratch.stage(build(), name))

    # Revenue

    def transactions(self) -> list[DataFrame]:
        return [self.table(t) for t in ("account", "unit_sale", "unit_accessory", "invoice", "rental")]

    def account_revenue(self) -> DataFrame:
        return revenue.account_revenue(*self.transactions(), *r60_window(self.settings.as_of))

    def ranked_revenue(self, method: str | None = None) -> DataFrame:
        return revenue.with_sales_decile(
            self.account_revenue().select("account_no", "total_revenue"), self.scratch.stage,
            method or self.settings.decile_method,
        )

    def last_transaction(self) -> DataFrame:
        return revenue.last_transaction(*(self.table(t) for t in ("account", "unit_sale", "invoice", "rental")))

    def standing(self) -> DataFrame:
        """Window revenue and last date of every account; if a run has several dates, all their windows are summed in
        one pass over the transactions and written once."""
        if len(self._dated) == 1:
            return revenue.account_standing(*self.transactions(), self.settings.as_of)
        window = r60_window(self.settings.as_of)
        if window not in self._standings:
            wanted = {r60_window(day) for day, ws in self._dated.items() if "enriched" not in ws._stages}
            windows = sorted(wanted - set(self._standings))
            rows = self.scratch.stage(revenue.account_standings(*self.transactions(), windows), "standings")
            for i, known in enumerate(windows):
                self._standings[known] = rows.selectExpr("account_no", f"revenue_{i} AS total_revenue", "last_tx_date")
        return self._standings[window]

    # Populations

    def people(self) -> list[DataFrame]:
        return [self.table(t) for t in ("contact", "technician", "salesperson", "account", "vendor")]

    def active(self) -> DataFrame:
        return population.active_contacts(*self.people())

    def enriched(self) -> DataFrame:
        """Active contacts with staleness, decile, cohort and link counts; read by every section."""
        def build() -> DataFrame:
            ranked = revenue.with_sales_decile(self.standing(), self.scratch.stage, self.settings.decile_method)
            return population.contact_enriched(self.base(), ranked, self.settings)
        return self.staged("enriched", build)

    def base(self) -> DataFrame:
        """Contacts as far as no date changes them; written once if several dates of a run share it."""
        if "base" not in self._dateless:
            rows = population.active_base(*self.people(), self.links(), self.settings)
            if len(self._dated) == 1:
                return rows
            self._dateless["base"] = self.scratch.stage(rows, "base")
        return self._dateless["base"]

    def links(self) -> DataFrame:
        return self.once("links", lambda: population.source_links(self.table("xref"), self.settings))

    def profiles(self) -> DataFrame:
        return population.registry_profiles(self.table("profile"), self.settings)

    def linked(self) -> DataFrame:
        """Linked contacts with both systems' values and the outcomes of their comparison; read by all parity checks."""
        return self.staged(
            "linked", lambda: parity.judged(population.active_linked(
                self.enriched(), self.links(), self.profiles(), self.settings.parity_us_default))
        )

    def inactive_linked(self) -> DataFrame:
        return population.inactive_linked(*self.people(), self.links(), self.profiles(), self.settings)

    def unlinked(self) -> DataFrame:
        return self.enriched().filter("links = 0")

    def release(self) -> None:
        """Delete the staged tables of this run."""
        self.scratch.release()
        self._dateless.clear()
        self._standings.clear()
        for ws in self._dated.values():
            ws._stages.clear()
            ws._variants.clear()
