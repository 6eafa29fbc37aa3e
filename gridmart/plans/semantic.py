"""Metric layer: named measures and dimensions resolved into star queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.layouts import month_of

SUM, COUNT, AVG, COUNT_IF, RATIO = "sum", "count", "avg", "count_if", "ratio"


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``table.key`` refers to ``parent.parent_key``."""

    table: str
    key: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Dimension:
    name: str
    table: str
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Fact:
    name: str
    table: str
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    """``column`` and, for a ratio of sums, ``over`` are expressions over the table."""

    name: str
    table: str
    kind: str
    column: str
    synonyms: tuple[str, ...] = ()
    over: str = ""


@dataclass(frozen=True)
class SemanticModel:
    keys: Mapping[str, str]
    relationships: Sequence[Relationship]
    facts: Sequence[Fact]
    dimensions: Sequence[Dimension]
    metrics: Sequence[Metric]
    small: tuple[str, ...] = ("dates",)  # tables of a size fixed by construction
    _dimension_names: dict = field(default_factory=dict, compare=False)
    _metric_names: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        for d in self.dimensions:
            for name in (f"{d.table}.{d.name}", d.name, *d.synonyms):
                self._dimension_names.setdefault(name.lower(), d)
        for m in self.metrics:
            for name in (f"{m.table}.{m.name}", m.name, *m.synonyms):
                self._metric_names.setdefault(name.lower(), m)

    def dimension(self, name: str) -> Dimension:
        try:
            return self._dimension_names[name.lower()]
        except KeyError:
            raise ValueError(f"unknown dimension {name!r}") from None

    def metric(self, name: str) -> Metric:
        """By name or synonym. A word that names a fact and a metric means the metric;
        one that names a fact alone means its sum."""
        key = name.lower()
        if key in self._metric_names:
            return self._metric_names[key]
        for f in self.facts:
            if key in (f.name.lower(), f"{f.table}.{f.name}".lower(), *[s.lower() for s in f.synonyms]):
                return Metric(f.name, f.table, SUM, f.column)
        raise ValueError(f"unknown metric {name!r}")

    def path(self, table: str, parent: str) -> Relationship | None:
        """How ``table`` reaches ``parent``; None if it is that table itself."""
        if table == parent:
            return None
        for r in self.relationships:
            if r.table == table and r.parent == parent:
                return r
        raise ValueError(f"no relationship from {table} to {parent}")


def _values(metric: Metric) -> dict[str, Column]:
    """What one metric takes from a fact row. A count takes whether its column is there, not the column:
    that is mostly a key, which would travel through every join."""
    value = F.expr(metric.column)
    if metric.kind == RATIO:
        return {f"{metric.name}__value": value, f"{metric.name}__over": F.expr(metric.over)}
    return {f"{metric.name}__value": value.isNotNull() if metric.kind == COUNT else value}


def _partials(metric: Metric) -> dict[str, Column]:
    """What one metric needs per fact group; all of it adds up."""
    value = F.col(f"{metric.name}__value")
    if metric.kind == RATIO:
        return {f"{metric.name}__sum": F.sum(value), f"{metric.name}__count": F.sum(f"{metric.name}__over")}
    if metric.kind == SUM:
        return {f"{metric.name}__sum": F.sum(value)}
    if metric.kind in (COUNT, COUNT_IF):
        return {f"{metric.name}__count": F.count_if(value)}
    if metric.kind == AVG:
        return {f"{metric.name}__sum": F.sum(value), f"{metric.name}__count": F.count(value)}
    raise ValueError(f"unknown aggregate {metric.kind!r}")


def _final(metric: Metric) -> Column:
    if metric.kind == SUM:
        return F.sum(f"{metric.name}__sum")
    if metric.kind in (COUNT, COUNT_IF):
        return F.sum(f"{metric.name}__count")
    return F.try_divide(
        F.sum(f"{metric.name}__sum").cast("double"), F.sum(f"{metric.name}__count").cast("double")
    )


def _fact_partials(
    model: SemanticModel,
    tables: Mapping[str, DataFrame],
    fact: str,
    metrics: Sequence[Metric],
    dimensions: Sequence[Dimension],
    filters: Sequence[tuple[Dimension, Callable[[Column], Column]]],
) -> DataFrame:
    """Partial sums of one fact per requested dimension values.

    Filters come first: those on the fact's own columns reach its scan, and the keys that
    a filtered dimension leaves are semi-joined to the fact before anything is summed; if
    its columns are asked for too, the same join brings them. Dimensions of a fixed size are
    broadcast. If one foreign key is all that is left to group by, the fact is reduced to a row
    per key first, and its join needs no further shuffle. With more to group by, combinations
    are nearly as many as facts, and to reduce to them would only be one more shuffle: each
    dimension is then joined in one shuffle by its key, of which Spark splits a hot one. Only
    dimension tables that are named take part.
    """
    own = sorted({d.column for d in dimensions if d.table == fact})
    parents = list(dict.fromkeys(d.table for d in dimensions if d.table != fact))
    paths = {p: model.path(fact, p) for p in parents}

    def brought(parent: str, rows: DataFrame) -> DataFrame:
        columns = list(dict.fromkeys(d.column for d in dimensions if d.table == parent))
        return rows.select(
            F.col(paths[parent].parent_key).alias(f"_key_{parent}"),
            *[F.col(c).alias(f"{parent}__{c}") for c in columns],
        )

    rows = tables[fact]
    for d, test in filters:
        if d.table == fact:
            rows = rows.filter(test(F.col(d.column)))
    rows = rows.withColumns({n: c for m in metrics for n, c in _values(m).items()})
    joined = []
    for parent in dict.fromkeys(d.table for d, _ in filters if d.table != fact):
        r, kept = model.path(fact, parent), tables[parent]
        for d, test in filters:
            if d.table == parent:
                kept = kept.filter(test(F.col(d.column)))
        if parent in paths and parent not in model.small:
            rows = rows.join(brought(parent, kept), F.col(r.key) == F.col(f"_key_{parent}"))
            joined.append(parent)
            continue
        keys = kept.select(F.col(r.parent_key).alias(f"_kept_{parent}"))
        same = F.col(r.key) == F.col(f"_kept_{parent}")
        if month_of(r.key) in rows.columns:  # in folders by month: those without a kept day are not read
            keys = keys.withColumn("_kept_month", F.floor(F.col(f"_kept_{parent}") / 100).cast("int"))
            same = same & (F.col(month_of(r.key)) == F.col("_kept_month"))
        if parent in model.small:
            keys = F.broadcast(keys)
        rows = rows.join(keys, same, "left_semi")
    partials = {n: c for m in metrics for n, c in _partials(m).items()}
    sums = [c.alias(n) for n, c in partials.items()]
    outputs = [
        F.col(d.column if d.table == fact else f"{d.table}__{d.column}").alias(d.name)
        for d in dimensions
    ]
    reduced = not own and len(parents) == 1 and not joined and parents[0] not in model.small
    if reduced:
        rows = rows.groupBy(paths[parents[0]].key).agg(*sums)
    for parent in sorted(paths, key=lambda p: p not in model.small):
        if parent not in joined:
            # Facts without a parent are kept, unless a filter has dropped them.
            dim = brought(parent, tables[parent])
            dim = F.broadcast(dim) if parent in model.small else dim
            rows = rows.join(dim, F.col(paths[parent].key) == F.col(f"_key_{parent}"), "left")
    return rows.select(*outputs, *partials) if reduced else rows.groupBy(*outputs).agg(*sums)


def semantic_query(
    model: SemanticModel,
    tables: Mapping[str, DataFrame],
    metrics: Sequence[str],
    dimensions: Sequence[str] = (),
    filters: Mapping[str, Callable[[Column], Column]] | None = None,
    order_by: str | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions, each by name or synonym (M1).

    Metrics of several facts are reduced apart, so that no fact multiplies another, and
    add up in one group-by over their union, which lines up equal dimension values.
    """
    wanted = [model.metric(m) for m in metrics]
    by = [model.dimension(d) for d in dimensions]
    tests = [(model.dimension(d), test) for d, test in (filters or {}).items()]
    facts = list(dict.fromkeys(m.table for m in wanted))

    parts = [
        _fact_partials(model, tables, f, [m for m in wanted if m.table == f], by, tests)
        for f in facts
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    names = [d.name for d in by]
    result = rows.groupBy(*names).agg(*[_final(m).alias(m.name) for m in wanted])
    if order_by:
        # Ties are settled by the dimensions, so a limit always keeps the same rows.
        metric = F.col(model.metric(order_by).name)
        first = metric.desc_nulls_last() if descending else metric.asc_nulls_last()
        result = result.orderBy(first, *[F.col(n).asc_nulls_last() for n in names])
    return result.limit(limit) if limit is not None else result


# The billing model's tables, relationships, names and synonyms.
CONTRACT_REVENUE = SemanticModel(
    keys={
        "invoices": "invoice_line_sk",
        "payments": "payment_sk",
        "customers": "customer_sk",
        "contracts": "contract_sk",
        "products": "product_sk",
        "dates": "date_key",
    },
    relationships=(
        Relationship("invoices", "customer_sk", "customers", "customer_sk"),
        Relationship("invoices", "contract_sk", "contracts", "contract_sk"),
        Relationship("invoices", "product_sk", "products", "product_sk"),
        Relationship("invoices", "invoice_date_key", "dates", "date_key"),
        Relationship("payments", "customer_sk", "customers", "customer_sk"),
        Relationship("payments", "contract_sk", "contracts", "contract_sk"),
        Relationship("payments", "payment_date_key", "dates", "date_key"),
    ),
    facts=(
        Fact("revenue_amount", "invoices", "amount", ("revenue", "sales amount", "line amount")),
        Fact("quantity", "invoices", "quantity"),
        Fact("tax_amount", "invoices", "tax_amount"),
        Fact("net_amount", "invoices", "net_amount", ("net revenue", "after tax amount")),
        Fact("payment_amount", "payments", "payment_amount", ("payment", "amount paid", "cash received")),
    ),
    dimensions=(
        Dimension("customer_id", "customers", "customer_id"),
        Dimension("email", "customers", "email"),
        Dimension("segment", "customers", "segment", ("customer segment", "customer type")),
        Dimension("region", "customers", "region", ("area", "geography")),
        Dimension("country", "customers", "country"),
        Dimension("is_current", "customers", "is_current"),
        Dimension("contract_type", "contracts", "contract_type", ("type of contract", "contract category")),
        Dimension("status", "contracts", "status", ("contract status", "contract state")),
        Dimension("product_name", "products", "product_name", ("product", "item")),
        Dimension("category", "products", "category"),
        Dimension("pricing_tier", "products", "pricing_tier"),
        Dimension("revenue_classification", "invoices", "revenue_classification", ("revenue type", "revenue category")),
        Dimension("invoice_status", "invoices", "invoice_status"),
        Dimension("payment_method", "payments", "payment_method", ("how paid", "payment type")),
        Dimension("payment_status", "payments", "payment_status"),
        Dimension("is_late_payment", "payments", "is_late_payment", ("late payment", "overdue")),
        Dimension("full_date", "dates", "full_date", ("date", "day")),
        Dimension("month_name", "dates", "month_name", ("month",)),
        Dimension("quarter", "dates", "quarter"),
        Dimension("year", "dates", "year", ("yr",)),
        Dimension("fiscal_year", "dates", "fiscal_year"),
        Dimension("fiscal_quarter", "dates", "fiscal_quarter"),
    ),
    metrics=(
        Metric("total_revenue", "invoices", SUM, "amount", ("revenue", "total sales", "gross revenue")),
        Metric("total_payments", "payments", SUM, "payment_amount", ("cash collected", "total collected")),
        Metric("invoice_count", "invoices", COUNT, "invoice_line_sk", ("number of invoices", "invoice volume")),
        Metric("average_invoice_amount", "invoices", AVG, "amount", ("avg invoice", "mean invoice amount")),
        Metric("late_payment_count", "payments", COUNT_IF, "is_late_payment", ("overdue payments", "late payments")),
    ),
)


# Names and synonyms of the metrics outside billing are fixed values, formulas ours where none is given.
OPERATIONS = SemanticModel(
    keys={
        "usage": "energy_usage_daily_sk",
        "tickets": "service_ticket_sk",
        "profiles": "customer_360_sk",
        "customers": "customer_sk",
        "dates": "date_key",
    },
    relationships=(
        Relationship("usage", "customer_sk", "customers", "customer_sk"),
        Relationship("usage", "date_key", "dates", "date_key"),
        Relationship("tickets", "opened_date_key", "dates", "date_key"),
    ),
    facts=(Fact("total_kwh", "usage", "total_kwh", ("energy", "consumption")),),
    dimensions=(
        Dimension("customer_segment", "profiles", "segment"),
        Dimension("customer_region", "profiles", "region"),
        Dimension("match_status", "profiles", "match_status"),
        Dimension("segment", "customers", "segment"),
        Dimension("region", "customers", "region"),
        Dimension("priority", "tickets", "priority"),
        Dimension("severity", "tickets", "severity"),
        Dimension("ticket_status", "tickets", "ticket_status"),
        Dimension("month_name", "dates", "month_name", ("month",)),
        Dimension("quarter", "dates", "quarter"),
        Dimension("year", "dates", "year"),
    ),
    metrics=(
        Metric("average_daily_energy_consumption", "usage", AVG, "total_kwh"),
        Metric("average_first_response_time", "tickets", AVG, "time_to_first_response_hours"),
        Metric("active_customer_count", "profiles", COUNT_IF, "status = 'active'"),
        Metric("device_uptime_rate", "profiles", RATIO, "active_device_count", over="total_device_count"),
    ),
)


def revenue_by_category(tables: Mapping[str, DataFrame], year: int, quarter: int) -> DataFrame:
    """Total revenue by product category in one quarter (M11, question 1)."""
    return semantic_query(
        CONTRACT_REVENUE, tables, ["total_revenue"], ["category"],
        {"year": lambda c: c == year, "quarter": lambda c: c == quarter},
    )


def top_customers(tables: Mapping[str, DataFrame], year: int, limit: int = 10) -> DataFrame:
    """Customers with the most revenue in a year (question 2, L4)."""
    return semantic_query(
        CONTRACT_REVENUE, tables, ["total_revenue"], ["customer_id"],
        {"year": lambda c: c == year}, order_by="total_revenue", limit=limit,
    )


def late_payments_by_method(tables: Mapping[str, DataFrame], year: int, quarter: int) -> DataFrame:
    """Late payments by payment method in one quarter (question 3)."""
    return semantic_query(
        CONTRACT_REVENUE, tables, ["late_payment_count"], ["payment_method"],
        {"year": lambda c: c == year, "quarter": lambda c: c == quarter},
    )


def average_invoice(tables: Mapping[str, DataFrame], contract_type: str) -> DataFrame:
    """Mean invoice line of one contract type (question 4)."""
    return semantic_query(
        CONTRACT_REVENUE, tables, ["average_invoice_amount"], ["contract_type"],
        {"contract_type": lambda c: c == contract_type},
    )


def monthly_revenue_by_segment(tables: Mapping[str, DataFrame], year: int) -> DataFrame:
    """Revenue by month and customer segment in a year (question 5)."""
    return semantic_query(
        CONTRACT_REVENUE, tables, ["total_revenue"], ["month_name", "segment"],
        {"year": lambda c: c == year},
    )
