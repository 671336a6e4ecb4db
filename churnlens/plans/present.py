"""Dashboard tables (B1-B5); B6 formatting lives in ``functions.fmt``.

They return DataFrames; the caller decides when to collect (the dashboard
collects a handful of rows). Percent columns are the exact 4-dp rates × 100,
taken from the rate's integer ten-thousandths (the reference's tenure table
formats a fraction as a percentage without × 100 — trap 7 — here it is × 100
like every other table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def times100(col: str) -> Column:
    """A 4-dp rate as a 2-dp percentage, exactly."""
    return F.round(F.col(col) * 10000).cast("bigint").cast("double") / F.lit(100.0)


def kpi_strip(kpis: DataFrame) -> DataFrame:
    """B1: the five KPI tiles."""
    return kpis.select("total_customers", "churned_customers", "churn_rate", "avg_cltv",
                       "churned_monthly_revenue")


def rate_table(dim_rows: DataFrame, label: str) -> DataFrame:
    """One dimension's segments with rate and contribution in percent."""
    return dim_rows.select(
        F.col("segment_value").alias(label), "total_customers", "churned_customers",
        times100("churn_rate").alias("churn_rate_pct"),
        times100("churn_contribution").alias("churn_contribution_pct"))


def product_gap_table(gap: DataFrame) -> DataFrame:
    """Adoption gap with percentages."""
    gap_e4 = (F.round(F.col("adopted_churn_rate") * 10000).cast("bigint")
              - F.round(F.col("not_adopted_churn_rate") * 10000).cast("bigint"))
    return gap.select(
        "product_name", "adopted_customers",
        times100("adopted_churn_rate").alias("adopted_churn_rate_pct"),
        "not_adopted_customers",
        times100("not_adopted_churn_rate").alias("not_adopted_churn_rate_pct"),
        (gap_e4.cast("double") / F.lit(100.0)).alias("churn_rate_gap_pct"))


def tenure_table(curve_all: DataFrame) -> DataFrame:
    """The summed contract curve with the unrounded rate in percent."""
    return curve_all.select(
        "tenure_month", "customers_reaching_tenure", "churned_at_tenure",
        "churn_rate_at_tenure",
        (F.col("churn_rate_at_tenure") * F.lit(100.0)).alias("churn_rate_at_tenure_pct"))
