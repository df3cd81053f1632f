"""The dependency-ordered rebuild as plain function composition.

``Pipeline(inputs, rules, as_of)`` exposes every named stage as a property
holding a lazy DataFrame. The small stages several consumers read (account
aggregates, cleaned terms, terms calendar) are written once under
``spark.checkpoint.dir``, their independent chains as concurrent jobs
(``prepare``); everything else runs when an output is written or collected.
``materialize`` cuts any other stage the same way (``plans/run.py`` does it
for the report before writing its extracts).
"""

from __future__ import annotations

import threading
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import Calendar
from ..operators import balance, decisions, invoices, leads, partners, reports, terms
from ..rules import RuleSet
from ..session import materialize_shared
from ..sources import driver

# declared dependencies, in rebuild order
STAGES = (
    ("leads_enriched", ("leads",)),
    ("payment_terms", ("terms_sheet",)),
    ("payment_terms_calendar", ("payment_terms", "leads_enriched")),
    ("invoices_enriched", ("invoice", "invoice_line", "receipt", "receipt_line", "organization", "partner")),
    ("balance_report", ("leads_enriched", "payment_terms_calendar", "invoices_enriched", "partner", "contract",
                        "organization", "individual", "deposit_correction", "pm_correction")),
)

INPUT_TABLES = (
    "leads", "terms_sheet", "invoice", "invoice_line", "receipt", "receipt_line",
    "partner", "contract", "organization", "individual", "deposit_correction", "pm_correction",
)


class Inputs:
    """Named input tables, built on first use (a query touching two tables
    does not resolve the other ten)."""

    def __init__(self, factories: dict):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def __getitem__(self, k: str) -> DataFrame:
        if k not in self._built:
            with self._lock:
                if k not in self._built:
                    f = self._factories[k]
                    self._built[k] = f() if callable(f) else f
        return self._built[k]

    def __contains__(self, k: str) -> bool:
        return k in self._factories

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> "Inputs":
        return cls(dict(tables))


def driver_inputs(spark: SparkSession, sf_dir: str, rules: RuleSet) -> Inputs:
    d = driver
    inputs = Inputs(
        {
            "leads": lambda: d.leads(spark, sf_dir),
            "terms_sheet": lambda: d.terms_sheet(spark, sf_dir),
            "invoice": lambda: d.invoices(spark, sf_dir),
            "invoice_line": lambda: d.invoice_lines(spark, sf_dir, rules),
            "receipt": lambda: d.receipts(spark, sf_dir),
            "receipt_line": lambda: d.receipt_lines(spark, sf_dir),
            "partner": lambda: d.partners(spark, sf_dir),
            "contract": lambda: d.contracts(spark, sf_dir),
            "organization": lambda: d.organizations(spark, sf_dir),
            "individual": lambda: d.individuals(spark, sf_dir),
            "deposit_correction": lambda: d.deposit_corrections(spark, sf_dir),
            "pm_correction": lambda: d.pm_corrections(spark, sf_dir),
            "entity_documents": lambda: d.entity_documents(spark, sf_dir),
            "terms_sheet_lines": lambda: d.terms_sheet_lines(spark, sf_dir),
            "orders_raw": lambda: d._read(spark, sf_dir, "orders"),
        }
    )
    inputs.sf_dir = sf_dir
    return inputs


class Pipeline:
    """Lazily built stages; each property is one named DataFrame."""

    def __init__(self, inputs: Inputs, rules: RuleSet, as_of, cut_lineage: bool = True):
        self.inputs, self.rules, self.as_of = inputs, rules, as_of
        self.sf_dir = getattr(inputs, "sf_dir", None)
        self.cal = Calendar.of(as_of)
        self.cut_lineage = cut_lineage
        self._cache: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = defaultdict(threading.Lock)
        self._saved: set[str] = set()
        self.made: list[str] = []  # paths of this pipeline's written stages

    def use_saved(self, name: str, df: DataFrame) -> None:
        """Take a derived table from where it was saved: later stages
        aggregate from it instead of going through the facts again."""
        self._cache[name] = df
        self._saved.add(name)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        """Materialise a small stage read by several consumers, once, in the
        shared checkpoint folder (see ``session.materialize_shared``)."""
        return materialize_shared(df, name, self.made) if self.cut_lineage else df

    def _memo(self, name, fn):
        if name not in self._cache:
            with self._locks[name]:
                if name not in self._cache:
                    self._cache[name] = fn()
        return self._cache[name]

    # independent chains of shared stages, run as concurrent Spark jobs
    PREPARE_CHAINS = (
        ("terms_dedup",),
        ("lead_accounts", "payment_terms_calendar"),
        ("invoice_measures",),
    )

    def prepare(self, chains=PREPARE_CHAINS) -> None:
        """Materialise independent shared stages as concurrent Spark jobs.

        The lead and invoice fact pipelines meet only at the account level,
        and the terms sheet needs the leads only for its missing-client
        rows, so the three chains run side by side instead of one after
        the other (each chain in order; a stage another chain needs is
        waited for through its lock)."""
        todo = [[n for n in chain if n not in self._cache] for chain in chains]
        todo = [c for c in todo if c]
        if not todo:
            return
        if len(todo) < 2 or not self.cut_lineage:
            for chain in todo:
                for n in chain:
                    getattr(self, n)
            return

        def run(chain):
            for n in chain:
                getattr(self, n)

        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            for f in [pool.submit(run, c) for c in todo]:
                f.result()

    # leads
    @property
    def leads_keyed(self) -> DataFrame:
        return self._memo("leads_keyed", lambda: leads.enrich_leads(self.inputs["leads"], self.rules))

    @property
    def leads_enriched(self) -> DataFrame:
        return self._memo("leads_enriched", lambda: leads.flag_duplicates(self.leads_keyed))

    @property
    def first_leads(self) -> DataFrame:
        return self._memo("first_leads", lambda: leads.first_leads(self.leads_keyed))

    @property
    def lead_accounts(self) -> DataFrame:
        """Account-level leads aggregate: the one pass over the fact table.
        Read by the terms (W2) and by the report, so it is cut once."""
        if "leads_enriched" in self._saved:
            build = lambda: leads.leads_window_measures(leads.first_of_flagged(self.leads_enriched), self.cal)
        else:
            build = lambda: leads.lead_accounts(leads.lead_groups(self.leads_keyed), self.cal)
        return self._memo("lead_accounts", lambda: self._cut(build(), "lead_accounts"))

    # terms
    @property
    def payment_terms(self) -> DataFrame:
        return self._memo(
            "payment_terms", lambda: terms.clean_terms(self.inputs["terms_sheet"], self.rules)
        )

    @property
    def terms_dedup(self) -> DataFrame:
        return self._memo("terms_dedup", lambda: self._cut(terms.dedup_terms(self.payment_terms), "terms_dedup"))

    @property
    def latest_entity(self) -> DataFrame:
        if "leads_enriched" in self._saved and "lead_accounts" not in self._saved:
            return self._memo("latest_entity", lambda: leads.latest_entity_of_leads(self.leads_enriched))
        return self._memo("latest_entity", lambda: leads.latest_entity_of(self.lead_accounts))

    @property
    def missing_clients(self) -> DataFrame:
        return self._memo("missing_clients", lambda: terms.missing_clients(self.latest_entity, self.terms_dedup))

    @property
    def terms_all(self) -> DataFrame:
        return self._memo("terms_all", lambda: terms.terms_all(self.terms_dedup, self.missing_clients))

    @property
    def payment_terms_calendar(self) -> DataFrame:
        if "payment_terms_calendar" not in self._cache and "lead_accounts" not in self._cache:
            self.prepare((("terms_dedup",), ("lead_accounts",)))
        return self._memo(
            "payment_terms_calendar",
            lambda: self._cut(terms.terms_calendar(self.terms_all, self.cal), "payment_terms_calendar"),
        )

    # invoices
    @property
    def invoice_lines(self) -> DataFrame:
        """The lines as the line pick reads them; stored by invoice id they
        lie right."""
        lines = self.inputs["invoice_line"]
        if "live_receipt_line" in self.inputs:
            return lines
        return self._memo("invoice_lines", lambda: invoices.dealt_lines(lines))

    @property
    def receipts_by_invoice(self) -> DataFrame:
        def build():
            if "live_receipt_line" in self.inputs:  # stored by invoice id, see plans/layout.py
                return invoices.sum_receipts(self.inputs["live_receipt_line"])
            return invoices.receipts_by_invoice(self.inputs["receipt"], self.inputs["receipt_line"])

        return self._memo("receipts_by_invoice", build)

    @property
    def invoices_enriched(self) -> DataFrame:
        i = self.inputs
        return self._memo(
            "invoices_enriched",
            lambda: invoices.enrich_invoices(
                i["invoice"], self.invoice_lines, self.receipts_by_invoice, i["organization"], i["partner"], self.rules
            ),
        )

    @property
    def billable_invoices(self) -> DataFrame:
        """What the period aggregate reads; from the saved table if there is one."""
        if "invoices_enriched" in self._saved:
            return self.invoices_enriched
        i = self.inputs
        return self._memo(
            "billable_invoices",
            lambda: invoices.billable_invoices(
                i["invoice"], self.invoice_lines, self.receipts_by_invoice, i["partner"], self.rules
            ),
        )

    @property
    def leads_agg(self) -> DataFrame:
        return self._memo(
            "leads_agg", lambda: balance.leads_with_terms(self.lead_accounts, self.payment_terms_calendar)
        )

    @property
    def invoice_measures(self) -> DataFrame:
        """Account-level invoice measures for every window: the one pass over
        the invoice facts, cut like the leads aggregate."""
        return self._memo(
            "invoice_measures",
            lambda: self._cut(
                invoices.invoice_window_measures(self.billable_invoices, self.cal, self.rules), "invoice_measures"
            ),
        )

    @property
    def invoices_agg(self) -> DataFrame:
        self.prepare()
        return self._memo(
            "invoices_agg",
            lambda: invoices.pick_invoice_measures(self.invoice_measures, self.payment_terms_calendar),
        )

    @property
    def partners_pick(self) -> DataFrame:
        i = self.inputs
        return self._memo(
            "partners_pick",
            lambda: partners.pick_partners(i["partner"], i["contract"], i["organization"], i["individual"], self.rules),
        )

    # balance / report
    @property
    def balance_base(self) -> DataFrame:
        self.prepare()
        i = self.inputs
        return self._memo(
            "balance_base",
            lambda: balance.balance_base(
                self.leads_agg, self.invoices_agg, self.partners_pick,
                i["deposit_correction"], i["pm_correction"], self.rules,
            ),
        )

    @property
    def decided(self) -> DataFrame:
        return self._memo("decided", lambda: decisions.decision_columns(self.balance_base, self.rules))

    @property
    def balance_report(self) -> DataFrame:
        return self._memo("balance_report", lambda: reports.report_full(self.decided))

    def materialize(self, name: str) -> DataFrame:
        """Cut lineage of any named stage read by several outputs (written
        once under ``spark.checkpoint.dir``; survives executor loss)."""
        df = materialize_shared(getattr(self, name), name, self.made)
        self._cache[name] = df
        return df

    def outputs(self) -> dict[str, DataFrame]:
        """The named result sets."""
        rep = self.balance_report
        return {
            "invoice_report": reports.report_ordered(rep),
            "new_invoices": reports.report_new_invoices(rep),
            "errors": reports.report_errors(rep),
            "payment_terms": self.payment_terms_calendar,
        }
