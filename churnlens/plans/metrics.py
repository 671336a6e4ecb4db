"""Metric layer re-aimed from the semantic view.

A registry of logical tables, each with a grain, dimensions, facts, metrics, synonyms
and named filters, all as Spark ``Column`` expressions. A request is planned against the
grain of its table (``plan_request``) before any job starts and is one of two kinds:

* aggregated: metrics and summed facts by dimensions, ONE ``groupBy(dims).agg(...)``;
* native: facts and dimensions of the table's own rows, no aggregation at all.

Anything else is refused (G7): both kinds at once, a native request whose selected and
pinned dimensions do not identify a row, a sum of a fact that is not additive, a sum over
a dimension the fact may not be summed over (segments of different dimensions hold
the same customers; a customer reaches many months), an unknown field.

Metrics are defined once (a metric is two-phase: integer parts aggregated with
partial aggregation, then one final expression), so a rate is never summed.
Unrounded metric values are single double divisions of exact integer parts,
identical in any engine.

Order belongs to the outermost query: a request's ``order`` sorts its result once, NULLs
last unless said otherwise, and the remaining dimensions break ties, so the order
is total and a ``limit`` (top k: every task keeps k rows) is well defined.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class MetricError(ValueError):
    """A request that the semantic model does not allow."""


@dataclass(frozen=True)
class Metric:
    name: str
    parts: dict          # part name -> aggregate Column (integer-valued)
    final: str           # SQL expression over the part names
    description: str = ""


@dataclass(frozen=True)
class NamedFilter:
    """A dimension held at one value."""
    dimension: str
    value: str


@dataclass
class LogicalTable:
    name: str
    grain: tuple[str, ...]                 # dimensions that identify a native row
    dimensions: dict[str, Column]
    facts: dict[str, Column]
    additive_facts: set[str]
    metrics: dict[str, Metric] = field(default_factory=dict)
    filters: dict[str, NamedFilter] = field(default_factory=dict)
    # additive fact -> dimensions it must not be summed over
    not_over: dict[str, tuple[str, ...]] = field(default_factory=dict)
    synonyms: dict[str, str] = field(default_factory=dict)
    money_facts: set[str] = field(default_factory=set)   # facts held as integer cents

    def resolve(self, word: str) -> str:
        """Field name for a name or business synonym (case-insensitive, per table)."""
        key = word.strip().lower()
        for f in list(self.dimensions) + list(self.facts) + list(self.metrics) + list(
                self.filters):
            if f.lower() == key:
                return f
        if key in self.synonyms:
            return self.synonyms[key]
        raise MetricError(f"unknown field {word!r} in logical table {self.name}")

    def predicate(self, name: str) -> Column:
        f = self.filters[name]
        return self.dimensions[f.dimension] == f.value


def _cents(c: str) -> Column:
    return (F.col(c) * 100).cast("bigint")


def _money_cents(c: str) -> Column:
    """A money value already rounded to cents (a double) back to exact integer cents."""
    return F.round(F.col(c) * 100).cast("bigint")


def _churned() -> Column:
    return F.col("churn_flag") == 1


def c360_metrics(unique_ids: bool = False) -> dict[str, Metric]:
    """Metrics of CUSTOMER_360_VIEW (the only logical table with metrics).

    With ids verified unique (``core.mark_unique_ids``) the distinct count is a
    plain count — same value, partial aggregation instead of an id shuffle.
    """
    ids = F.count("customer_id") if unique_ids else F.count_distinct("customer_id")
    return {m.name: m for m in [
    Metric("TOTAL_CUSTOMERS", {"n": ids}, "n",
           "Count of unique customers."),
    Metric("CHURNED_CUSTOMERS", {"c": F.count_if(_churned())}, "c",
           "Customers identified as churned in the snapshot."),
    Metric("CHURN_RATE", {"c": F.count_if(_churned()), "n": ids},
           "CAST(c AS DOUBLE) / NULLIF(n, 0)",
           "Churned customers / unique customers; snapshot-based, not period churn."),
    Metric("AVG_CLTV", {"s": F.sum("cltv"), "k": F.count("cltv")},
           "CAST(s AS DOUBLE) / NULLIF(k, 0)", "Source-provided CLTV indicator, averaged."),
    Metric("AVG_MONTHLY_CHARGE", {"s": F.sum(_cents("monthly_charge")),
                                  "k": F.count("monthly_charge")},
           "CAST(s AS DOUBLE) / NULLIF(k * 100, 0)", "Average monthly charge."),
    Metric("AVG_TENURE_MONTHS", {"s": F.sum("tenure_in_months"), "k": F.count("tenure_in_months")},
           "CAST(s AS DOUBLE) / NULLIF(k, 0)", "Average observed tenure in months."),
    Metric("TOTAL_MONTHLY_CHARGES", {"s": F.sum(_cents("monthly_charge"))},
           "CAST(s AS DOUBLE) / 100", "Current monthly charges of the population."),
    Metric("TOTAL_HISTORICAL_REVENUE", {"s": F.sum(_cents("total_revenue"))},
           "CAST(s AS DOUBLE) / 100", "Accumulated historical revenue, not period revenue."),
    ]}

_CHURN_RATE_SYN = ["attrition rate", "churn percentage", "customer churn", "customer loss rate"]
_CHURNED_SYN = ["churn volume", "customer attrition volume", "customers who churned",
                "lost customers"]


def _syn(pairs: dict[str, list[str]]) -> dict[str, str]:
    return {w.lower(): f for f, words in pairs.items() for w in words}


def _cols(names: list[str]) -> dict[str, Column]:
    return {n: F.col(n.lower()) for n in names}


def semantic_model(unique_ids: bool = False) -> dict[str, LogicalTable]:
    """The four logical tables of the semantic view (fixed names from the reference)."""
    c360 = LogicalTable(
        "CUSTOMER_360_VIEW", grain=("CUSTOMER_ID",),
        dimensions=_cols(["AGE_BAND", "CHURN_CATEGORY", "CHURN_FLAG", "CHURN_REASON", "CITY",
                          "CLTV", "CONTRACT", "CUSTOMER_ID", "CUSTOMER_STATUS",
                          "CUSTOMER_VALUE_SEGMENT", "INTERNET_SERVICE", "INTERNET_TYPE", "OFFER",
                          "PAYMENT_METHOD", "PREMIUM_TECH_SUPPORT", "SATISFACTION_SCORE", "STATE",
                          "TENURE_BAND", "TENURE_IN_MONTHS", "TOTAL_SERVICE_COUNT"]),
        facts={"MONTHLY_CHARGE": _cents("monthly_charge"),
               "TOTAL_REVENUE": _cents("total_revenue")},
        additive_facts={"MONTHLY_CHARGE", "TOTAL_REVENUE"},
        money_facts={"MONTHLY_CHARGE", "TOTAL_REVENUE"},
        metrics=c360_metrics(unique_ids),
        synonyms=_syn({
            "CUSTOMER_VALUE_SEGMENT": ["CLTV segment", "customer value tier", "value segment"],
            "TENURE_IN_MONTHS": ["customer age in months", "customer tenure",
                                 "months since joining", "tenure"],
            "TOTAL_SERVICE_COUNT": ["number of services", "product depth",
                                    "products per customer", "service depth"],
            "CHURN_RATE": _CHURN_RATE_SYN,
            "CHURNED_CUSTOMERS": _CHURNED_SYN,
            "TOTAL_HISTORICAL_REVENUE": ["accumulated revenue", "cumulative historical revenue",
                                         "customer historical revenue", "historical revenue"],
        }),
    )
    curve = LogicalTable(
        "VW_CHURN_BY_TENURE_SEGMENT", grain=("DIMENSION_NAME", "SEGMENT_VALUE", "TENURE_MONTH"),
        dimensions=_cols(["DIMENSION_NAME", "SEGMENT_VALUE", "TENURE_MONTH"]),
        facts=_cols(["CHURN_RATE_AT_TENURE", "CHURNED_AT_TENURE", "CUSTOMERS_REACHING_TENURE"]),
        additive_facts={"CHURNED_AT_TENURE", "CUSTOMERS_REACHING_TENURE"},
        not_over={"CHURNED_AT_TENURE": ("DIMENSION_NAME",),
                  "CUSTOMERS_REACHING_TENURE": ("DIMENSION_NAME", "TENURE_MONTH")},
        filters={"CHURN_BY_TENURE_PRODUCT_DEPTH": NamedFilter("DIMENSION_NAME", "Product Depth"),
                 "CONTRACT_CHURN_BY_TENURE": NamedFilter("DIMENSION_NAME", "Contract")},
        synonyms=_syn({
            "TENURE_MONTH": ["lifecycle month", "month of tenure", "tenure month"],
            "CHURN_RATE_AT_TENURE": ["churn at month", "churn by tenure", "lifecycle churn rate",
                                     "tenure churn rate"],
            "CUSTOMERS_REACHING_TENURE": ["customers reaching month", "customers reaching tenure",
                                          "customers with at least this tenure"],
        }),
    )
    segments = LogicalTable(
        "VW_CHURN_SEGMENTS", grain=("DIMENSION_NAME", "SEGMENT_VALUE"),
        dimensions=_cols(["CHURNED_CUSTOMERS", "DIMENSION_NAME", "SEGMENT_VALUE",
                          "TOTAL_CUSTOMERS"]),
        facts={**_cols(["AVG_CLTV", "AVG_MONTHLY_CHARGE", "CHURN_CONTRIBUTION", "CHURN_RATE"]),
               "CHURNED_HISTORICAL_REVENUE": _money_cents("churned_historical_revenue"),
               "CHURNED_MONTHLY_REVENUE": _money_cents("churned_monthly_revenue")},
        additive_facts={"CHURNED_HISTORICAL_REVENUE", "CHURNED_MONTHLY_REVENUE"},
        money_facts={"CHURNED_HISTORICAL_REVENUE", "CHURNED_MONTHLY_REVENUE"},
        not_over={"CHURNED_HISTORICAL_REVENUE": ("DIMENSION_NAME",),
                  "CHURNED_MONTHLY_REVENUE": ("DIMENSION_NAME",)},
        filters={"CHURN_SEGMENTS_BY_CUSTOMER_VALUE": NamedFilter("DIMENSION_NAME",
                                                                 "Customer Value")},
        synonyms=_syn({
            "CHURNED_CUSTOMERS": _CHURNED_SYN,
            "CHURN_CONTRIBUTION": ["churn mix", "contribution to churn", "share of churn",
                                   "share of total churn"],
        }),
    )
    adoption = LogicalTable(
        "VW_PRODUCT_ADOPTION", grain=("PRODUCT_NAME", "ADOPTION_STATUS"),
        dimensions=_cols(["ADOPTION_STATUS", "CHURNED_CUSTOMERS", "CUSTOMERS", "PRODUCT_NAME"]),
        facts=_cols(["AVG_CLTV", "AVG_MONTHLY_CHARGE", "AVG_TENURE_MONTHS", "AVG_TOTAL_REVENUE",
                     "CHURN_RATE", "CUSTOMER_SHARE"]),
        additive_facts=set(),
        filters={"NON_ADOPTED_CUSTOMERS": NamedFilter("ADOPTION_STATUS", "No")},
        synonyms=_syn({
            "ADOPTION_STATUS": ["adopted", "product adoption", "product usage status"],
            "CHURNED_CUSTOMERS": _CHURNED_SYN,
            "PRODUCT_NAME": ["product", "product type", "service"],
            "CHURN_RATE": _CHURN_RATE_SYN,
        }),
    )
    return {t.name: t for t in [c360, curve, segments, adoption]}


# --- G2: planning ------------------------------------------------------------------

@dataclass(frozen=True)
class Order:
    """One sort key: an output field, its direction and where NULLs go (last by default)."""
    field: str
    descending: bool = False
    nulls_first: bool = False

    @classmethod
    def parse(cls, text: str) -> Order:
        """``field [ASC|DESC] [NULLS FIRST|LAST]``."""
        m = re.fullmatch(r"(.+?)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?", text.strip(),
                         re.IGNORECASE | re.DOTALL)
        if m is None:
            raise MetricError("an empty order key")
        return cls(m[1], (m[2] or "").upper() == "DESC", (m[3] or "").upper() == "FIRST")

    def column(self, name: str) -> Column:
        c = F.col(name)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


@dataclass(frozen=True)
class Request:
    """A checked request: resolved names, predicates and the order of the result."""
    table: LogicalTable
    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]
    sum_facts: tuple[str, ...]
    facts: tuple[str, ...]
    predicates: tuple[Column, ...]
    pins: Mapping[str, object]              # dimension -> its one value
    order: tuple[tuple[str, Order], ...]    # output column, sort key
    limit: int | None
    position: str | None

    @property
    def native(self) -> bool:
        return not self.metrics and not self.sum_facts

    def outputs(self) -> list[str]:
        return [*[x.lower() for x in (*self.dimensions, *self.facts, *self.metrics)],
                *[f"total_{x.lower()}" for x in self.sum_facts]]


def _checked(lt: LogicalTable, words, known, kind: str) -> tuple[str, ...]:
    names = tuple(lt.resolve(w) for w in words)
    for n in names:
        if n not in known:
            raise MetricError(f"{n} is not a {kind} of {lt.name}")
    return names


def _where(lt: LogicalTable, where: Mapping) -> tuple[list[Column], dict[str, object]]:
    """Predicates on dimensions, and those that hold one at a single value. A list is any
    of its values; None, alone or in a list, is NULL."""
    predicates, pins = [], {}
    for word, value in where.items():
        name, = _checked(lt, [word], lt.dimensions, "dimension")
        values = list(value) if isinstance(value, list | tuple | set | frozenset) else [value]
        column = lt.dimensions[name]
        some = [v for v in values if v is not None]
        predicate = column.isin(some) if some else F.lit(False)
        if len(some) < len(values):
            predicate = column.isNull() | F.coalesce(predicate, F.lit(False))
        predicates.append(predicate)
        if len(values) == 1:
            pins[name] = values[0]
    return predicates, pins


def plan_request(lt: LogicalTable, metrics=(), dimensions=(), filters=(), sum_facts=(), facts=(),
                 where: Mapping | None = None, order=(), limit: int | None = None,
                 position: str | None = None) -> Request:
    """Check a request against the grain of its table; nothing runs here."""
    m = _checked(lt, metrics, lt.metrics, "metric")
    d = _checked(lt, dimensions, lt.dimensions, "dimension")
    named = _checked(lt, filters, lt.filters, "named filter")
    sums = _checked(lt, sum_facts, lt.facts, "fact")
    native = _checked(lt, facts, lt.facts, "fact")
    predicates, pins = _where(lt, where or {})
    for f in named:
        predicates.append(lt.predicate(f))
        pins[lt.filters[f].dimension] = lt.filters[f].value
    held = {*d, *pins}
    if native and (m or sums):
        raise MetricError("facts of native rows and aggregates do not go into one request")
    for s in sums:
        if s not in lt.additive_facts:
            raise MetricError(f"{s} is not additive; summing it would re-aggregate a rate")
        over = [x for x in lt.not_over.get(s, ()) if x not in held]
        if over:
            raise MetricError(f"{s} must not be summed over {', '.join(over)}: "
                              "select it or hold it at one value")
    if not m and not sums:
        if not native and not d:
            raise MetricError("nothing to compute: give metrics, facts or dimensions")
        missing = [x for x in lt.grain if x not in held]
        if missing:
            raise MetricError(f"rows of {lt.name} are not identified without {', '.join(missing)}: "
                              "select it, hold it at one value, or ask for metrics")
    request = Request(lt, d, m, sums, native, tuple(predicates), pins, (), limit, position)
    out = request.outputs()
    if len(set(out)) < len(out):
        raise MetricError("a field is asked for twice")
    keys = []
    for item in order:
        o = item if isinstance(item, Order) else Order.parse(item)
        name = o.field.strip().lower()
        if name not in out:
            name = lt.resolve(o.field).lower()
        if name not in out:
            raise MetricError(f"{o.field!r} is not in the result, so it cannot order it")
        keys.append((name, o))
    if (limit is not None or position) and not keys:
        raise MetricError("a limit or a position needs an order")
    if limit is not None and limit < 0:
        raise MetricError("a limit is not negative")
    if position and position.lower() in out:
        raise MetricError(f"{position!r} is a field of the result")
    if keys:            # the dimensions identify a row of either kind of result
        done = {name for name, _ in keys}
        keys += [(x.lower(), Order(x)) for x in d if x.lower() not in done]
    return Request(lt, d, m, sums, native, tuple(predicates), pins, tuple(keys), limit, position)


def _fact(lt: LogicalTable, name: str) -> Column:
    """A native fact: money facts are held as cents and shown in money units."""
    c = lt.facts[name]
    return c.cast("double") / F.lit(100.0) if name in lt.money_facts else c


def run_request(source: DataFrame, r: Request) -> DataFrame:
    lt, df = r.table, source
    for p in r.predicates:
        df = df.filter(p)
    dims = [lt.dimensions[d].alias(d.lower()) for d in r.dimensions]
    if r.native:
        out = df.select(*dims, *[_fact(lt, f).alias(f.lower()) for f in r.facts])
        return _ordered(out, r)
    parts, seen = [], {}
    for m in r.metrics:
        for pname, col in lt.metrics[m].parts.items():
            alias = f"_{m}_{pname}"
            parts.append(col.alias(alias))
            seen[(m, pname)] = alias
    for s in r.sum_facts:
        parts.append(F.sum(lt.facts[s]).alias(f"_sum_{s}"))
    g = df.groupBy(*dims).agg(*parts)
    out = [F.col(d.lower()) for d in r.dimensions]
    for m in r.metrics:
        expr = lt.metrics[m].final
        for pname in lt.metrics[m].parts:
            expr = _sub(expr, pname, seen[(m, pname)])
        out.append(F.expr(expr).alias(m.lower()))
    for s in r.sum_facts:
        col = F.col(f"_sum_{s}")
        if s in lt.money_facts:   # money facts are summed in exact cents
            col = col.cast("double") / F.lit(100.0)
        out.append(col.alias(f"total_{s.lower()}"))
    return _ordered(g.select(*out), r)


def _ordered(df: DataFrame, r: Request) -> DataFrame:
    """The one sort of a request. With a limit at most ``limit`` rows are numbered; without
    one positions come from ranges, so no task sees all rows."""
    if not r.order:
        return df
    keys = [o.column(name) for name, o in r.order]
    if r.limit is not None:
        df = df.orderBy(*keys).limit(r.limit)
        if r.position:
            df = df.withColumn(r.position, F.row_number().over(Window.orderBy(*keys)).cast("long"))
        return df
    if not r.position:
        return df.orderBy(*keys)
    from churnlens.operators.ranking import global_rank
    return global_rank(df, keys, "_rank", "_total").select(
        *df.columns, (F.col("_rank") + 1).alias(r.position))


def metric_query(source: DataFrame, table: str, metrics=(), dimensions=(), filters=(),
                 sum_facts=(), model: dict[str, LogicalTable] | None = None, **more) -> DataFrame:
    """Governed metrics by dimensions under named filters, or native rows.

    ``source`` is the DataFrame of the logical table ``table``. Words may be
    field names or synonyms of that table. ``sum_facts`` lists facts to SUM;
    only facts with a default aggregation (additive) may be summed. ``facts`` are facts of
    native rows, ``where`` maps dimensions to a value or a list of values, ``order`` lists sort
    keys (``Order`` or text), ``limit`` keeps the first rows, ``position`` names a column for
    the place in the order.
    """
    from churnlens.plans.core import ids_unique
    unique = "customer_id" in source.columns and ids_unique(source)
    lt = _table(table, model or semantic_model(unique))
    return run_request(source, plan_request(lt, metrics, dimensions, filters, sum_facts, **more))


def _table(name: str, model: dict[str, LogicalTable]) -> LogicalTable:
    lt = model.get(name.upper())
    if lt is None:
        raise MetricError(f"unknown logical table {name!r}")
    return lt


def ask(c360: DataFrame, table: str, **request) -> DataFrame:
    """``metric_query`` on a logical table built from the 360: a dimension or product held at
    one value builds that branch of its mart only (a filter above ``Expand`` is not pushed
    into it)."""
    from churnlens.plans import lifecycle, marts
    from churnlens.plans.core import ids_unique
    r = plan_request(_table(table, semantic_model(ids_unique(c360))), **request)

    def only(dimension: str, names) -> list[str] | None:
        return [r.pins[dimension]] if r.pins.get(dimension) in names else None

    name = r.table.name
    if name == "VW_CHURN_SEGMENTS":
        source = marts.churn_segments(c360, only=only("DIMENSION_NAME", marts.SEGMENT_DIMENSIONS))
    elif name == "VW_CHURN_BY_TENURE_SEGMENT":
        source = lifecycle.churn_by_tenure_segment(
            c360, only=only("DIMENSION_NAME", lifecycle.CURVE_DIMENSIONS))
    elif name == "VW_PRODUCT_ADOPTION":
        source = marts.product_adoption(c360, only=only("PRODUCT_NAME",
                                                        [p for p, _ in marts.PRODUCTS]))
    else:
        source = c360
    return run_request(source, r)


def _sub(expr: str, name: str, alias: str) -> str:
    return re.sub(rf"\b{re.escape(name)}\b", alias, expr)


# --- G1: metric values in long form -------------------------------------------------

# Limitation text per metric (paraphrasing the metric dictionary's usage rules).
LIMITATIONS = {
    "total_customers": "Unique customers in the snapshot.",
    "churned_customers": "Observed churn outcomes, not predictions.",
    "churn_rate": "Snapshot-based rate, not a beginning-of-period churn rate.",
    "avg_monthly_charge": "Current monthly charge, not forecast revenue.",
    "total_monthly_charges": "Current monthly charges, not forecast revenue.",
    "total_revenue": "Accumulated historical revenue, not current-period revenue.",
    "churned_monthly_revenue": "Charges of customers already churned; not revenue at risk.",
    "churned_historical_revenue": "Historical revenue of churned customers; not future loss.",
    "avg_cltv": "Source-provided indicator; its method is unknown.",
    "avg_tenure_months": "Observed tenure in months.",
    "avg_satisfaction_score": "Source-provided score.",
    "churn_contribution": "Share of all churned customers; not a rate.",
    "customer_share": "Share within the product, including 'Not Applicable'.",
    "customers_reaching_tenure": "Cross-sectional; not a cohort.",
    "churned_at_tenure": "Cross-sectional; not a cohort.",
    "churn_rate_at_tenure": "Cross-sectional approximation; not retention or survival.",
    "churn_index": "Segment rate relative to the overall rate; 1.0 = average.",
    "revenue_share": "Share of accumulated historical revenue.",
    "product_adoption_rate": "Adopters over eligible customers; 'Not Applicable' excluded.",
    "total_service_count": "Customers holding this many services (0-11).",
    "customer_value_segment": "Customers in this CLTV quartile segment; relative, not currency.",
}


def _limitation() -> Column:
    m = F.col("metric_name")
    expr = None
    for k, v in LIMITATIONS.items():
        expr = (F.when(m == k, v) if expr is None else expr.when(m == k, v))
    return expr


def _portfolio_parts(ids: Column) -> list[Column]:
    """Additive parts (with unique ids) from which all 21 metrics follow."""
    churned = _churned()
    mc, rev = _cents("monthly_charge"), _cents("total_revenue")
    averaged = {"mc": mc, "rev": rev, "cltv": F.col("cltv"), "ten": F.col("tenure_in_months"),
                "sat": F.col("satisfaction_score")}
    return [ids.alias("_n"), F.count(F.lit(1)).alias("_rows"), F.count_if(churned).alias("_c"),
            *[f(c).alias(f"_{k}_{name}") for name, c in averaged.items()
              for k, f in (("s", F.sum), ("k", F.count))],
            F.sum(F.when(churned, mc).otherwise(0)).alias("_c_mc"),
            F.sum(F.when(churned, rev).otherwise(0)).alias("_c_rev")]


def _metric_tally(c360: DataFrame, by: list[str]) -> DataFrame:
    """(by..., dimension_name, segment_value, parts, _all_n): the shared tally of all metrics.
    One scan with unique ids; otherwise customers are unpivoted, ids counted distinct and
    the distinct total comes from a second scan."""
    from churnlens.operators.reshape import unpivot_dimensions
    from churnlens.operators.tally import tally_dimensions
    from churnlens.plans.core import customer_count, ids_unique
    from churnlens.plans.marts import PRODUCTS, segment_dimensions
    segments = {**segment_dimensions(), "Total Service Count": F.col("total_service_count")}
    products = {name: F.coalesce(F.col(c), F.lit("Not Applicable")) for name, c in PRODUCTS}
    months = {"Tenure Month": F.col("tenure_in_months"), "Portfolio": F.lit("All")}
    parts = _portfolio_parts(customer_count(c360))
    # one name per column of `by`, apart from the columns the parts read
    base = c360.withColumns({f"_by{i}": F.col(c) for i, c in enumerate(by)})
    keys = [f"_by{i}" for i in range(len(by))]
    if ids_unique(c360):
        tally = tally_dimensions(base, [segments, products, months], parts, keys)
        whole = Window.partitionBy(*keys, "dimension_name")
        tally = tally.withColumn("_all_n", F.sum("_n").over(whole))
    else:
        keep = [*keys, "customer_id", "churn_flag", "monthly_charge", "total_revenue", "cltv",
                "tenure_in_months", "satisfaction_score"]
        long = unpivot_dimensions(base, {**segments, **products, **months}, keep)
        totals = base.groupBy(*keys).agg(F.count_distinct("customer_id").alias("_all_n"))
        tally = long.groupBy(*keys, "dimension_name", "segment_value").agg(*parts)
        if keys:
            same = [F.col(f"t.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
            tally = tally.alias("t").join(totals.alias("a"), same).select("t.*", "a._all_n")
        else:
            tally = tally.crossJoin(F.broadcast(totals))       # one row
    return tally.withColumnsRenamed(dict(zip(keys, by, strict=True)))


def metric_values(c360: DataFrame, by=()) -> DataFrame:
    """G1: (by..., dimension_name, segment_value, metric_name, metric_value, limitation).

    All 21 metrics of the metric dictionary in each group of the dimensions ``by`` (names or
    synonyms of CUSTOMER_360_VIEW; none: the whole portfolio): portfolio scalars, per-segment
    metrics, and the two column metrics (service count, value segment) as customer
    distributions. Shares, contributions and indexes are relative to the group's own total.
    Everything is derived from one grouped tally of the 360; windows see one dimension
    of one group.
    """
    from churnlens.functions.exact import avg2, avg_money, index2, money, ratio4
    from churnlens.plans.marts import PRODUCTS, SEGMENT_DIMENSIONS
    lt = semantic_model()["CUSTOMER_360_VIEW"]
    keys = [n.lower() for n in _checked(lt, by, lt.dimensions, "dimension")]
    if len(set(keys)) < len(keys):
        raise MetricError("a dimension is asked for twice")
    dimension, segment = F.col("dimension_name"), F.col("segment_value")
    whole = Window.partitionBy(*keys, "dimension_name")
    later = whole.orderBy(F.col("_month").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    status = {name: F.sum(F.when(segment == value, F.col("_n")).otherwise(0)).over(whole)
              for name, value in (("_yes", "Yes"), ("_no", "No"))}
    t = _metric_tally(c360, keys).withColumn(
        "_month", F.when(dimension == "Tenure Month", segment.cast("long")))
    t = t.withColumns({
        "_all_c": F.sum("_c").over(whole), "_sum_n": F.sum("_n").over(whole),
        "_all_rev": F.sum("_s_rev").over(whole), **status,
        "_reaching": F.sum("_rows").over(later),
        "_first": F.row_number().over(whole.orderBy(segment.asc_nulls_last())) == 1})

    def row(name: str, value: Column, shown: Column = segment) -> Column:
        return F.struct(shown.alias("segment_value"), F.lit(name).alias("metric_name"),
                        value.cast("double").alias("metric_value"))

    portfolio = [row(*x) for x in (
        ("total_customers", F.col("_n")), ("churned_customers", F.col("_c")),
        ("churn_rate", ratio4("_c", "_n")), ("avg_monthly_charge", avg_money("_s_mc", "_k_mc")),
        ("total_monthly_charges", money("_s_mc")), ("total_revenue", money("_s_rev")),
        ("churned_monthly_revenue", money("_c_mc")),
        ("churned_historical_revenue", money("_c_rev")), ("avg_cltv", avg2("_s_cltv", "_k_cltv")),
        ("avg_tenure_months", avg2("_s_ten", "_k_ten")),
        ("avg_satisfaction_score", avg2("_s_sat", "_k_sat")))]
    contribution = row("churn_contribution", ratio4("_c", "_all_c"))
    value = [contribution, row("revenue_share", ratio4("_s_rev", "_all_rev")),
             row("customer_value_segment", F.col("_n"))]
    depth = [row("churn_index", index2("_c", "_n", "_all_c", "_all_n")),
             row("total_service_count", F.col("_n"))]
    month = [row("customers_reaching_tenure", F.col("_reaching")),
             row("churned_at_tenure", F.col("_c")),
             row("churn_rate_at_tenure", ratio4("_c", "_reaching"))]
    share = row("customer_share", ratio4("_n", "_sum_n"))
    rate = row("product_adoption_rate", ratio4("_yes", "_yes + _no"), F.lit("Yes"))
    rows = F.when(dimension == "Portfolio", F.array(*portfolio)) \
        .when(dimension == "Customer Value", F.array(*value)) \
        .when(dimension.isin(SEGMENT_DIMENSIONS), F.array(contribution)) \
        .when(dimension == "Total Service Count", F.array(*depth)) \
        .when(F.col("_month").isNotNull(), F.array(*month)) \
        .when(dimension.isin([p for p, _ in PRODUCTS]),
              F.when(F.col("_first"), F.array(share, rate)).otherwise(F.array(share)))
    return t.select(*keys, "dimension_name", F.explode(rows).alias("_r")) \
        .select(*keys, "dimension_name", "_r.*").withColumn("limitation", _limitation())


# --- Product adoption rate (trap 10) --------------------------------------------------

def product_adoption_rate(adoption: DataFrame) -> DataFrame:
    """Adopters / eligible customers, eligible = status 'Yes' or 'No'.

    Unlike M3's customer share, 'Not Applicable' is outside the denominator.
    """
    st = F.col("adoption_status")
    g = adoption.groupBy("product_name").agg(
        F.sum(F.when(st == "Yes", F.col("customers")).otherwise(0)).alias("adopted_customers"),
        F.sum(F.when(st == "No", F.col("customers")).otherwise(0)).alias("not_adopted_customers"),
        F.sum(F.when(st == "Not Applicable", F.col("customers")).otherwise(0))
        .alias("not_applicable_customers"))
    from churnlens.functions.exact import ratio4
    return g.select(
        "product_name", "adopted_customers", "not_adopted_customers",
        (F.col("adopted_customers") + F.col("not_adopted_customers")).alias("eligible_customers"),
        "not_applicable_customers",
        ratio4("adopted_customers", "adopted_customers + not_adopted_customers")
        .alias("adoption_rate"))


# --- G4: named filters ------------------------------------------------------------------

def named_filter_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows matched by every named filter of every logical table given in ``sources``."""
    parts = []
    for tname, lt in semantic_model().items():
        if tname not in sources:
            continue
        for fname in lt.filters:
            parts.append(sources[tname].filter(lt.predicate(fname)).agg(
                F.count(F.lit(1)).alias("rows_matched")).select(
                F.lit(fname).alias("filter_name"), F.lit(tname).alias("logical_table"),
                "rows_matched"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- G6: field profile ------------------------------------------------------------------

TOP_K = 3

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _canonical(df: DataFrame, column: str) -> Column:
    """A value as text, the same in any engine: floating values with six decimals."""
    kind = dict(df.dtypes)[column]
    c = F.col(f"`{column}`")
    if kind in ("double", "float"):
        return F.coalesce(c.try_cast("decimal(38,6)").cast("string"), c.cast("string"))
    return c.cast("string")


def _numeric(df: DataFrame, column: str) -> bool:
    kind = dict(df.dtypes)[column]
    return kind in (*_WHOLE, "double", "float") or kind.startswith("decimal")


def field_tally(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field_name, value, n): rows per field and value, written once — all that a profile
    needs, from one scan."""
    from churnlens.session import materialize
    columns = {f: next(c for c in df.columns if c.lower() == f.lower()) for f in fields}
    long = df.select(*[_canonical(df, c).alias(f) for f, c in columns.items()]).unpivot(
        [], fields, "field_name", "value")
    return materialize(long.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n")),
                       f"field-tally-{uuid.uuid4().hex[:12]}")


def field_profile(df: DataFrame, fields: list[str] | None = None,
                  buckets: int | None = None) -> DataFrame:
    """Per field (all columns if none are named): rows, NULLs, distinct values, min, max and the 3
    most frequent values.

    One scan: everything comes from the materialised tally of (field, value). Minimum and maximum
    are those of the field's type (numbers compare as numbers). The top 3 is exact and
    distributed (``operators.topk``).
    """
    from churnlens.operators.topk import top_values
    fields = list(fields or df.columns)
    numeric = [f for f in fields
               if _numeric(df, next(c for c in df.columns if c.lower() == f.lower()))]
    tally = field_tally(df, fields)
    number = F.when(F.col("field_name").isin(numeric), F.col("value").try_cast("decimal(38,6)"))

    def end(by_number, by_text) -> Column:
        return F.when(F.col("field_name").isin(numeric), by_number("value", number)) \
            .otherwise(by_text("value"))

    stats = tally.groupBy("field_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_values"),
        F.count("value").alias("distinct_values"),
        end(F.min_by, F.min).alias("min_value"), end(F.max_by, F.max).alias("max_value"))
    top = top_values(tally, "field_name", TOP_K, buckets).groupBy("field_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))),
                                 lambda x: x["value"]), " | ").alias("top_values"))
    return stats.join(top, "field_name", "left").select(
        "field_name", "rows", "null_values", "distinct_values", "min_value", "max_value",
        "top_values")


def logical_profiles(sources: dict[str, DataFrame]) -> DataFrame:
    """``field_profile`` of all columns of every logical table given, with its name."""
    out = None
    for name, df in sources.items():
        part = field_profile(df).select(F.lit(name).alias("logical_table"), "*")
        out = part if out is None else out.unionByName(part)
    return out
