"""RAW data-quality checks (D1-D12) and CORE validation (V1-V5).

Generic forms (one aggregation pass per table, all measures of a table in one
``agg``; per-table one-row results are unioned):

* ``row_counts(tables)``                 D1
* ``uniqueness(tables, key)``            D2, V1
* ``null_keys(tables, key)``             D3
* ``completeness(base, others, key)``    D4
* ``distribution(df, cols, pct=True)``   D6-D8, V3
* ``ranges(df, cols)``                   D9
* ``null_profile(df, by, cols)``         D10
* ``domains(raw)``                       D12

Results are small (one row per table or per value) and never collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.exact import money, pct2

TABLE_ORDER = ["churn_demographics", "churn_location", "churn_population", "churn_services",
               "churn_status"]
KEYED = ["churn_demographics", "churn_location", "churn_services", "churn_status"]

# Fixed category domains stated by the reference's schema and metric docs.
YES_NO = ["Yes", "No"]
DOMAINS = {
    "churn_demographics": {"under_30": YES_NO, "senior_citizen": YES_NO, "married": YES_NO,
                           "dependents": YES_NO},
    "churn_services": {c: YES_NO for c in [
        "referred_a_friend", "phone_service", "multiple_lines", "internet_service",
        "online_security", "online_backup", "device_protection_plan", "premium_tech_support",
        "streaming_tv", "streaming_movies", "streaming_music", "unlimited_data",
        "paperless_billing"]},
    "churn_status": {"customer_status": ["Stayed", "Joined", "Churned"],
                     "churn_label": YES_NO, "churn_value": ["0", "1"],
                     "satisfaction_score": ["1", "2", "3", "4", "5"],
                     "quarter": ["Q1", "Q2", "Q3", "Q4"]},
}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _name(t: str):
    return F.lit(t.upper()).alias("table_name")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """D1 (and S2): rows per table."""
    return _union([tables[t].agg(F.count(F.lit(1)).alias("row_count"))
                   .select(_name(t), "row_count") for t in TABLE_ORDER if t in tables])


def uniqueness(tables: dict[str, DataFrame], key: str = "customer_id") -> DataFrame:
    """Rows, distinct keys, rows − distinct keys (NULL keys count as duplicates)."""
    parts = []
    for t, df in tables.items():
        g = df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_distinct(key).alias("distinct_customers"))
        parts.append(g.select(_name(t), "total_rows", "distinct_customers",
                              (F.col("total_rows") - F.col("distinct_customers"))
                              .alias("duplicate_rows")))
    return _union(parts)


def null_keys(tables: dict[str, DataFrame], key: str = "customer_id") -> DataFrame:
    """D3: NULL keys per table."""
    return _union([df.agg(F.count_if(F.col(key).isNull()).alias("null_customer_ids"))
                   .select(_name(t), "null_customer_ids") for t, df in tables.items()])


def completeness(base: DataFrame, others: dict[str, DataFrame],
                 key: str = "customer_id") -> DataFrame:
    """Rows of ``base`` LEFT JOIN every table in ``others`` on ``key``, and how
    many of those joined rows miss a partner in each table.

    Computed without the joins: all key columns are unioned with a source tag
    and counted per key (one partial-aggregated group-by). For a key with
    ``n_base`` base rows and ``n_t`` rows in table t, the reference's chain of
    LEFT JOINs yields ``n_base × Π max(n_t, 1)`` rows, and the rows missing t
    are those of keys with ``n_t = 0``; a NULL key never matches. Exactly the
    joins' counts, fan-out included, for one shuffle of the keys instead of a
    shuffle of both sides of every join.
    """
    parts = [base.select(F.col(key).alias("_k"), F.lit("_base").alias("_src"))]
    parts += [df.select(F.col(key).alias("_k"), F.lit(name).alias("_src"))
              for name, df in others.items()]
    g = _union(parts).groupBy("_k").agg(
        F.count_if(F.col("_src") == "_base").alias("_n_base"),
        *[F.count_if(F.col("_src") == name).alias(f"_n_{name}") for name in others])
    matched = {name: F.when(F.col("_k").isNull(), F.lit(0)).otherwise(F.col(f"_n_{name}"))
               for name in others}
    fan = F.col("_n_base").cast("bigint")
    for m in matched.values():
        fan = fan * F.greatest(m, F.lit(1))
    return g.agg(
        F.coalesce(F.sum(fan), F.lit(0)).cast("bigint").alias("demographics_customers"),
        *[F.coalesce(F.sum(F.when(m == 0, fan).otherwise(0)), F.lit(0)).cast("bigint")
          .alias(f"missing_{name}") for name, m in matched.items()])


def zip_reconciliation(location: DataFrame, population: DataFrame) -> DataFrame:
    """Customers whose ZIP has no population row."""
    pop = population.select(F.col("zip_code").alias("_pz"))
    j = location.select("zip_code").join(pop, F.col("zip_code") == F.col("_pz"), "left")
    return j.agg(F.count(F.lit(1)).alias("customer_rows"),
                 F.count_if(F.col("_pz").isNull()).alias("customers_without_population_match"))


def distribution(df: DataFrame, cols: list[str], pct: bool = True) -> DataFrame:
    """Rows per value combination, optionally with % of all rows.

    The percentage's denominator (the reference's ``SUM(COUNT(*)) OVER ()``) is a one-row
    aggregate that is broadcast: dirty labels may have any number of values, so no
    window gathers them in one task.
    """
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("customers"))
    if not pct:
        return g
    g = g.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("_all"))))
    return g.select(*cols, "customers", pct2("customers", "_all").alias("pct_customers"))


def ranges(services: DataFrame) -> DataFrame:
    """min/max of tenure, monthly charge and total revenue (one pass)."""
    return services.agg(
        F.min("tenure_in_months").alias("min_tenure"),
        F.max("tenure_in_months").alias("max_tenure"),
        F.min("monthly_charge").cast("double").alias("min_monthly_charge"),
        F.max("monthly_charge").cast("double").alias("max_monthly_charge"),
        F.min("total_revenue").cast("double").alias("min_total_revenue"),
        F.max("total_revenue").cast("double").alias("max_total_revenue"),
    )


def null_profile(status: DataFrame) -> DataFrame:
    """NULL churn category / reason per churn label."""
    return status.groupBy("churn_label").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("churn_category").isNull()).alias("null_churn_category"),
        F.count_if(F.col("churn_reason").isNull()).alias("null_churn_reason"),
    )


def quarters(services: DataFrame, status: DataFrame) -> DataFrame:
    """Rows per quarter in the two tables that carry one."""
    return _union([
        df.groupBy("quarter").agg(F.count(F.lit(1)).alias("row_count"))
        .select(_name(t), "quarter", "row_count")
        for t, df in [("churn_services", services), ("churn_status", status)]])


def domains(raw: dict[str, DataFrame]) -> DataFrame:
    """Per (table, column): rows, NULLs and non-NULL values outside the domain.

    One aggregation pass per table; the per-column measures are then unpivoted
    into rows with ``stack``.
    """
    parts = []
    for t, checks in DOMAINS.items():
        if t not in raw:
            continue
        df = raw[t]
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for c, allowed in checks.items():
            v = F.col(c).cast("string")
            aggs.append(F.count_if(v.isNull()).alias(f"n_{c}"))
            aggs.append(F.count_if(v.isNotNull() & ~v.isin(*allowed)).alias(f"o_{c}"))
        g = df.agg(*aggs)
        stack = ", ".join(f"'{c}', n_{c}, o_{c}" for c in checks)
        parts.append(g.select(
            _name(t), F.col("_rows").alias("rows_checked"),
            F.expr(f"stack({len(checks)}, {stack}) AS (column_name, null_values, "
                   f"out_of_domain)")))
    return _union(parts)


# Columns without a fixed list of values: their domain is what the data mostly hold.
DISCOVERED = {"churn_services": ["contract", "payment_method", "internet_type", "offer"]}
MEMBER_SHARE = 0.01       # of a column's non-NULL rows; so a domain has at most 100 values
REPORTED = 10             # out-of-domain values shown per column


def domain_discovery(raw: dict[str, DataFrame], columns: dict[str, list[str]] | None = None,
                     allowed: dict[str, list[str]] | None = None) -> DataFrame:
    """The values of columns whose domain is not fixed, and what lies outside it.

    A value belongs to a column's domain if it has at least ``MEMBER_SHARE`` of the non-NULL rows,
    or, for columns in ``allowed``, if it is listed there. Per column: rows, NULLs, the domain's
    values in order, rows and different values outside it, and the ``REPORTED`` most
    frequent of these with their counts. Empty columns have an empty domain.

    One scan per table: tuples of the columns are tallied, unpivoted and counted; the rest
    reads that tally, which grows with the different values only and is never in one task.
    """
    from churnlens.operators.tally import tally_dimensions
    from churnlens.operators.topk import top_values
    parts = []
    for t, names in (columns or DISCOVERED).items():
        if t not in raw:
            continue
        tally = tally_dimensions(raw[t], [{c: F.col(c) for c in names}],
                                 [F.count(F.lit(1)).alias("n")], name_col="column_name",
                                 value_col="value")
        totals = tally.groupBy("column_name").agg(
            F.sum("n").alias("rows_checked"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("known"))
        member = F.col("n") >= F.col("known") * F.lit(MEMBER_SHARE)
        for c, values in (allowed or {}).items():
            member = F.when(F.col("column_name") == c, F.col("value").isin(values)).otherwise(member)
        judged = tally.join(totals, "column_name").withColumn("member", member)
        inside = F.when(F.col("value").isNotNull() & F.col("member"), F.col("value"))
        outside = F.col("value").isNotNull() & ~F.col("member")
        stats = judged.groupBy("column_name").agg(
            F.max("rows_checked").alias("rows_checked"),
            (F.max("rows_checked") - F.max("known")).alias("null_values"),
            F.array_join(F.sort_array(F.collect_set(inside)), " | ").alias("domain_values"),
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("out_of_domain"),
            F.count_if(outside).alias("out_of_domain_values"))
        shown = F.concat("value", F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
        top = top_values(judged.filter(outside), "column_name", REPORTED).groupBy("column_name").agg(
            F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("place", shown.alias("shown")))),
                lambda x: x["shown"]), " | ").alias("reported"))
        parts.append(stats.join(top, "column_name", "left").select(
            _name(t), "column_name", "rows_checked", "null_values", "domain_values",
            "out_of_domain", "out_of_domain_values", F.coalesce("reported", F.lit("")).alias("reported")))
    return _union(parts)


# --- CORE validation -------------------------------------------------------------

def core_join_completeness(c360: DataFrame) -> DataFrame:
    """V2: one sentinel column per CORE table."""
    return c360.agg(
        F.count_if(F.col("gender").isNull()).alias("missing_profile"),
        F.count_if(F.col("zip_code").isNull()).alias("missing_location"),
        F.count_if(F.col("contract").isNull()).alias("missing_services"),
        F.count_if(F.col("customer_status").isNull()).alias("missing_snapshot"),
    )


def revenue_reconciliation(c360: DataFrame, raw_services: DataFrame) -> DataFrame:
    """V4: total revenue in the 360 vs the raw services table, one row.

    Both sides are one-row aggregates; the cross join is 1 × 1.
    """
    core = c360.agg(F.sum((F.col("total_revenue") * 100).cast("bigint")).alias("_core"))
    raw = raw_services.agg(F.sum((F.col("total_revenue") * 100).cast("bigint")).alias("_raw"))
    return core.crossJoin(F.broadcast(raw)).select(
        money("_core").alias("core_total_revenue"),
        money("_raw").alias("raw_total_revenue"),
        money("_core - _raw").alias("revenue_difference"),
    )


def value_segments(c360: DataFrame) -> DataFrame:
    """V5: n, min/avg/max CLTV per value segment (average unrounded: sum/count)."""
    return c360.groupBy("customer_value_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("cltv").alias("min_cltv"),
        (F.sum("cltv").cast("double") / F.count("cltv")).alias("avg_cltv"),
        F.max("cltv").alias("max_cltv"),
    )
