"""All models over a set of raw tables, lazily or written layer by layer (3.1, S13, S14)."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import enforce_contract, tag_pii
from ..operators.scd2 import scd2_merge
from ..sources import calendar
from ..sources.layouts import month_of, write_bucketed, write_by_month, write_lookup
from ..sources.sinks import (
    high_water_mark,
    layer_path,
    read_if_exists,
    remove,
    replace_partitions,
    write_clustered,
    write_table,
)
from . import checks, intermediate, marts, staging
from .contracts import MART_SCHEMAS, PII
from .snapshots import BUCKETS, run_snapshot

_OLTP = {f"stg_oltp__{t}": t for t in staging.CDC_KEYS}
_CRM = {f"stg_crm__{t}": t for t in staging.SAAS_KEYS}
_IOT = {f"stg_iot__{m}": m for m in staging.TELEMETRY_MODELS}
_PARTNER = {
    "stg_partner__grid_usage": "grid_usage_readings",
    "stg_partner__installation_certifications": "installation_certifications",
    "stg_partner__product_catalog": "product_catalog_updates",
}
SNAPSHOTS = {
    "snp_customers": ("stg_oltp__customers", "customer_id"),
    "snp_contracts": ("stg_oltp__contracts", "contract_id"),
}
STAGED_TELEMETRY = "stg_iot__all_events"
CLUSTERED = {
    "fct_device_telemetry": "date_key",
    "fct_energy_usage_daily": "date_key",
    STAGED_TELEMETRY: "event_type",
}
# Read together by the invoice: lines and payments meet their invoice where they lie. One that is stored
# without the others has nothing to meet there, and is not sent to buckets.
BUCKETED = {
    "stg_oltp__invoices": "invoice_id",
    "stg_oltp__invoice_line_items": "invoice_id",
    "stg_oltp__payments": "invoice_id",
}
# Asked for spans of days: a folder per month, and in it by the key that single customers are found by.
MONTHLY = {
    "fct_invoices": ("invoice_date_key", "customer_sk"),
    "fct_payments": ("payment_date_key", "customer_sk"),
}
# What they are read from row by row, their rows without keys, and the keys: those are made in the folder, not sent there.
UNKEYED = {
    "fct_invoices": ("stg_oltp__invoice_line_items", marts.invoice_facts, marts.invoice_keys),
    "fct_payments": ("stg_oltp__payments", marts.payment_facts, marts.payment_keys),
}
# Asked for single customers.
LOOKED_UP = {"dim_customer": "customer_id", "dim_contract": "customer_id", "customer_360": "customer_id"}
# What facts have days of; the calendar covers them all unless a range is given.
DATED = (
    ("stg_oltp__invoices", "invoice_date"),
    ("stg_oltp__payments", "payment_date"),
    ("stg_oltp__contracts", "start_date"),
    ("stg_oltp__contracts", "end_date"),
    (STAGED_TELEMETRY, "event_timestamp"),
    ("stg_crm__cases", "created_date"),
    ("stg_crm__cases", "closed_date"),
)


class Warehouse:
    """``wh["customer_360"]`` is the lazy model; its inputs are built on demand.

    ``as_of`` stands for the wall clock, so that results can be repeated.
    ``snapshots`` may replace the snapshot tables (or give functions that make them), by
    default a first run over staging. ``store`` is a folder in the shared file system; with
    it, models that others share (``stored``) are written there when first needed and read
    back, so a mart over many of them computes none twice. Stored snapshots keep their open
    versions in ``buckets``, and stored models that are joined with one another lie in as many. Without ``first_day`` and
    ``last_day`` the calendar has the years that the facts lie in.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        as_of: Column | None = None,
        first_day: str | None = None,
        last_day: str | None = None,
        snapshots: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        store: str | None = None,
        stored: Collection[str] | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of if as_of is not None else F.localtimestamp()
        self.days = (first_day, last_day) if first_day and last_day else None
        self.store = store
        self.stored = STORED if stored is None else set(stored)
        self.snapshots = dict(snapshots or {})
        self.buckets = buckets
        self._models: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._models:
            model = self._build(name)
            if self.store and name in self.stored:
                model = self._write(name, model, layer_path(self.store, "shared", name))
            self._models[name] = model
        return self._models[name]

    def _inputs(self, name: str) -> tuple[str, ...]:
        """The models that a model is built from."""
        if name in _IOT:
            return (STAGED_TELEMETRY,)
        if name in SNAPSHOTS:
            return () if name in self.snapshots else (SNAPSHOTS[name][0],)
        if name == "dim_date":
            return () if self.days else tuple(dict.fromkeys(model for model, _ in DATED))
        return _MODELS[name][1] if name in _MODELS else ()

    def read_often(self, name: str) -> set[str]:
        """The models of ``STORED`` that one plan of ``name`` would hold more than once; to write others
        costs more than it saves, if nothing but ``name`` is asked for."""
        readers: dict[str, list[str]] = {name: []}
        waiting = [name]
        while waiting:
            model = waiting.pop()
            for read in self._inputs(model):
                if read not in readers:
                    readers[read] = []
                    waiting.append(read)
                readers[read].append(model)

        @cache
        def times(model: str) -> int:
            return sum(1 if r in STORED and times(r) > 1 else times(r) for r in readers[model]) or 1

        return {model for model in readers if model in STORED and times(model) > 1}

    def replace(self, name: str, df: DataFrame) -> None:
        """Use ``df`` for a model from now on, for example its written table."""
        self._models[name] = df

    def in_buckets(self, name: str) -> bool:
        """Whether a model is stored in buckets of a key."""
        together = self.stored & BUCKETED.keys() if self.store else set()
        return name in together and len(together) > 1

    def _write(self, name: str, model: DataFrame, path: str) -> DataFrame:
        """``model`` as a table, laid out for how it is read."""
        if name in CLUSTERED:
            return write_clustered(model, path, CLUSTERED[name])
        if self.in_buckets(name):
            return write_bucketed(model, path, BUCKETED[name], self.buckets)
        if name in MONTHLY:
            source, facts, keys = UNKEYED[name]
            rows = facts(*[self[i] for i in self._inputs(name)], in_buckets=self.in_buckets(source))
            return write_by_month(rows, path, *MONTHLY[name], keys(), model.columns)
        if name in LOOKED_UP:
            return write_lookup(model, path, LOOKED_UP[name])
        return write_table(model, path)

    def _build(self, name: str) -> DataFrame:
        if name in _OLTP:
            return staging.cdc_model(self.raw[_OLTP[name]], _OLTP[name])
        if name in _CRM:
            return staging.saas_model(self.raw[_CRM[name]], _CRM[name])
        if name == STAGED_TELEMETRY:
            return staging.telemetry_all(self.raw["telemetry_events"])
        if name in _IOT:
            # One type alone is cheaper out of the raw events, unless all are stored.
            if STAGED_TELEMETRY in self._models or (self.store and STAGED_TELEMETRY in self.stored):
                return staging.telemetry_of(self[STAGED_TELEMETRY], _IOT[name])
            return staging.telemetry_model(self.raw["telemetry_events"], _IOT[name])
        if name in _PARTNER:
            return staging.partner_model(self.raw[_PARTNER[name]], _PARTNER[name])
        if name in self.snapshots:
            given = self.snapshots[name]
            return given() if callable(given) else given
        if name in SNAPSHOTS:
            source, key = SNAPSHOTS[name]
            return scd2_merge(None, self[source], key)
        model, inputs = _MODELS[name]
        built = model(self, *[self[i] for i in inputs])
        if name in PII:
            built = tag_pii(built, PII[name])
        return built

    def mart(self, name: str) -> DataFrame:
        """A mart with its schema contract enforced. The folder column of a stored one is not part of it."""
        mart = self[name].drop(month_of(MONTHLY[name][0])) if name in MONTHLY else self[name]
        return enforce_contract(mart, MART_SCHEMAS[name])

    def snapshot(self, name: str, root: str) -> DataFrame:
        """Run one snapshot against its stored versions and store the outcome."""
        source, key = SNAPSHOTS[name]
        return run_snapshot(self[source], key, layer_path(root, "snapshots", name), self.buckets)

    def load_telemetry(self, root: str) -> DataFrame:
        """Add what was loaded since the last build to the staged events (T1), and return them all.

        A build reads raw events from the newest load before on, that instant included. Only the days
        they fall on are read again, folded to the newest delivery of each event, and rewritten.
        """
        path = layer_path(root, "staged", STAGED_TELEMETRY)
        marks, day = f"{path}.loads", "_event_day"
        mark = high_water_mark(self.spark, marks)  # one row per build
        since = None if mark is None else F.lit(mark).cast("timestamp_ntz")
        fresh = staging.telemetry_all(self.raw["telemetry_events"], since)
        columns = fresh.columns
        fresh = write_table(fresh.withColumn(day, F.to_date("event_timestamp")), f"{path}.fresh")
        staged = read_if_exists(self.spark, path)
        rows = fresh
        if staged is not None:
            # at most a value per calendar day
            days = [r[0] for r in fresh.select(day).distinct().collect()]
            touched = F.col(day).cast("date").eqNullSafe(F.lit(None).cast("date")) if None in days else F.lit(False)
            touched = touched | F.col(day).isin([d for d in days if d is not None])
            before = staged.filter(touched).select(*columns, F.col(day).cast("date").alias(day))
            rows = staging.latest_deliveries(before.unionByName(fresh))
        if staged is None or not fresh.isEmpty():
            replace_partitions(rows, path, [day], f"{path}.work", [CLUSTERED[STAGED_TELEMETRY]])
        newest = fresh.agg(F.max("_loaded_at").alias("_loaded_at")).filter("_loaded_at IS NOT NULL")
        newest.write.mode("append").parquet(marks)
        remove(self.spark, f"{path}.fresh")
        return self.spark.read.schema(fresh.schema).parquet(path).select(*columns)

    def build(self, root: str) -> dict[str, DataFrame]:
        """Write snapshots, shared models and all marts; later models read the files.

        Telemetry is staged from where the last build ended. Rows that fail a check of
        `checks.CHECKS` go to ``checks/failing_rows``, the marts' row counts are added to
        ``checks/row_counts``.
        """
        self.store = self.store or root
        self.replace(STAGED_TELEMETRY, self.load_telemetry(root))
        for name in SNAPSHOTS:
            self.replace(name, self.snapshot(name, root))
        written = {}
        for name in MART_SCHEMAS:
            self.replace(name, self._write(name, self.mart(name), layer_path(root, "marts", name)))
            written[name] = self.mart(name)
        checks.write_failing_rows(self, layer_path(root, "checks", "failing_rows"))
        counts = checks.row_counts(self, MART_SCHEMAS, self.as_of)
        counts.coalesce(1).write.mode("append").parquet(layer_path(root, "checks", "row_counts"))
        return written


# Models that several others read.
STORED = {
    "stg_oltp__customers",
    "stg_oltp__households",
    "stg_oltp__contracts",
    "stg_oltp__invoices",
    "stg_oltp__invoice_line_items",
    "stg_oltp__payments",
    "stg_crm__contacts",
    STAGED_TELEMETRY,
    "int_customer__unified_profile",
    "int_device__lifecycle",
    "int_device__telemetry_daily",
    "int_service__ticket_enriched",
}

# Model -> how it is built and from which models.
_MODELS = {
    "int_billing__invoice_enriched": (
        lambda wh, *m: intermediate.invoice_enriched(*m),
        ("stg_oltp__invoice_line_items", "stg_oltp__invoices", "stg_oltp__products", "stg_oltp__contracts"),
    ),
    "int_customer__unified_profile": (
        lambda wh, *m: intermediate.unified_profile(*m),
        ("stg_oltp__customers", "stg_crm__contacts", "stg_crm__accounts"),
    ),
    "int_device__lifecycle": (
        lambda wh, *m: intermediate.device_lifecycle(*m, wh.as_of),
        ("stg_oltp__devices", "stg_iot__device_status"),
    ),
    "int_device__telemetry_daily": (
        lambda wh, *m: intermediate.telemetry_daily(*m),
        ("stg_iot__energy_readings", "stg_iot__temperature_readings"),
    ),
    "int_service__ticket_enriched": (
        lambda wh, *m: intermediate.ticket_enriched(*m),
        ("stg_crm__cases", "stg_crm__case_comments", "stg_crm__contacts"),
    ),
    "dim_customer": (lambda wh, s: marts.dim_customer(s), ("snp_customers",)),
    "dim_contract": (lambda wh, s: marts.dim_contract(s), ("snp_contracts",)),
    "dim_device": (lambda wh, d: marts.dim_device(d), ("int_device__lifecycle",)),
    "dim_household": (lambda wh, h: marts.dim_household(h), ("stg_oltp__households",)),
    "dim_product": (lambda wh, p: marts.dim_product(p), ("stg_oltp__products",)),
    "dim_date": (
        lambda wh: calendar.date_dimension(wh.spark, *wh.days)
        if wh.days
        else calendar.dates_over([(wh[m], column) for m, column in DATED]),
        (),
    ),
    "dim_time": (lambda wh: calendar.time_dimension(wh.spark), ()),
    "dim_geography": (
        lambda wh, *m: marts.dim_geography(*m), ("stg_oltp__customers", "stg_oltp__households"),
    ),
    "bridge_household_device": (
        lambda wh, *m: marts.bridge_household_device(*m),
        ("int_device__lifecycle", "dim_household", "dim_device"),
    ),
    "fct_invoices": (
        lambda wh, *m: marts.fct_invoices(*m, in_buckets=wh.in_buckets("stg_oltp__invoice_line_items")),
        ("stg_oltp__invoice_line_items", "stg_oltp__invoices", "dim_customer", "dim_household",
         "dim_product", "dim_contract", "dim_date"),
    ),
    "fct_payments": (
        lambda wh, *m: marts.fct_payments(*m, in_buckets=wh.in_buckets("stg_oltp__payments")),
        ("stg_oltp__payments", "stg_oltp__invoices", "dim_customer", "dim_household", "dim_contract", "dim_date"),
    ),
    "fct_contract_lifecycle": (
        lambda wh, *m: marts.fct_contract_lifecycle(*m, wh.as_of),
        ("stg_oltp__contracts", "dim_customer", "dim_household", "dim_product", "dim_contract", "dim_date"),
    ),
    "fct_device_telemetry": (
        lambda wh, events, *dims: marts.fct_device_telemetry(marts.staged_events(events), *dims),
        (STAGED_TELEMETRY, "dim_device", "dim_household", "dim_date", "dim_time"),
    ),
    "fct_energy_usage_daily": (
        lambda wh, *m: marts.fct_energy_usage_daily(*m),
        ("int_device__telemetry_daily", "dim_device", "dim_household", "dim_customer", "dim_date"),
    ),
    "fct_service_ticket_lifecycle": (
        lambda wh, *m: marts.fct_service_ticket_lifecycle(*m), ("int_service__ticket_enriched", "dim_date"),
    ),
    "bridge_service_ticket_customer": (
        lambda wh, *m: marts.bridge_service_ticket_customer(*m),
        ("int_service__ticket_enriched", "int_customer__unified_profile", "dim_customer"),
    ),
    "customer_360": (
        lambda wh, *m: marts.customer_360(*m),
        ("int_customer__unified_profile", "stg_oltp__contracts", "int_device__lifecycle",
         "stg_oltp__households", "stg_oltp__invoices", "bridge_service_ticket_customer",
         "fct_service_ticket_lifecycle"),
    ),
}

MODELS = (*_OLTP, *_CRM, *_IOT, *_PARTNER, *SNAPSHOTS, *_MODELS)
