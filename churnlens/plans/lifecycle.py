"""Lifecycle marts M7-M9.

Cross-sectional approximation from ONE snapshot: customers observed at a
tenure and whether they have churned. It is not a cohort retention or survival
curve and must not be labelled as one.

The reference builds ``observed months × customers`` with a CROSS JOIN; here
the same numbers come from a tenure histogram and a reverse running sum
(``operators.curve``), O(customers) instead of O(months × customers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions import bands
from churnlens.functions.exact import avg2, avg_money, ratio4
from churnlens.operators.curve import (reaching, rolling_rate, support_level,
                                       tenure_histogram)
from churnlens.operators.reshape import unpivot_dimensions
from churnlens.plans.marts import with_cents

LIMITATION = ("Cross-sectional churn-by-tenure approximation from one snapshot; "
              "not a cohort retention or survival curve.")

# Fixed support thresholds of the reference.
CURVE_SUPPORT = (1000, 500)
SEGMENT_SUPPORT = (500, 200)
CURVE_DIMENSIONS = ["Contract", "Customer Value", "Premium Tech Support", "Product Depth"]


def churn_by_tenure(c360: DataFrame) -> DataFrame:
    """M7: one row per observed tenure month."""
    b = with_cents(c360)
    churned = F.col("churn_flag") == 1
    hist = tenure_histogram(b, "tenure_in_months", "churn_flag", extra=[
        F.sum(F.when(churned, F.col("mc_cents"))).alias("_s_mc"),
        F.count(F.when(churned, F.col("mc_cents"))).alias("_n_mc"),
        F.sum(F.when(churned, F.col("cltv"))).alias("_s_cltv"),
        F.count(F.when(churned, F.col("cltv"))).alias("_n_cltv"),
    ])
    # All churned rows, NULL tenure included, before the NULL group is dropped.
    hist = hist.withColumn("_all_churned", F.sum("churned_at_tenure").over(Window.partitionBy()))
    curve = reaching(hist)
    return curve.select(
        "tenure_month", "customers_reaching_tenure", "churned_at_tenure",
        ratio4("churned_at_tenure", "customers_reaching_tenure").alias("churn_rate_at_tenure"),
        ratio4("churned_at_tenure", "_all_churned").alias("churn_contribution"),
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge_churned"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv_churned"),
    )


def churn_by_tenure_enhanced(curve: DataFrame) -> DataFrame:
    """M8: M7 plus a centred 3-row mean of the rounded rate and a support level.

    Kept as in the reference, which marks it superseded by M9.
    """
    hi, med = CURVE_SUPPORT
    return curve.select(
        "tenure_month", "customers_reaching_tenure", "churned_at_tenure",
        "churn_rate_at_tenure", "churn_contribution",
        rolling_rate("churn_rate_at_tenure").alias("rolling_3m_churn_rate"),
        support_level("customers_reaching_tenure", hi, med).alias("base_support_level"),
        "avg_monthly_charge_churned", "avg_cltv_churned",
    )


def curve_dimensions() -> dict:
    return {
        "Contract": F.col("contract"),
        "Customer Value": F.col("customer_value_segment"),
        "Premium Tech Support": F.col("premium_tech_support"),
        "Product Depth": bands.depth_segment("total_service_count"),
    }


def churn_by_tenure_segment(c360: DataFrame, only: list[str] | None = None) -> DataFrame:
    """M9: the curve per (dimension, segment); NULL segments are dropped.

    The reference joins months to rows on the segment value, and NULL never
    equals NULL, so rows without a segment value drop out.
    """
    long = unpivot_dimensions(c360, curve_dimensions(),
                              ["customer_id", "tenure_in_months", "churn_flag"], only=only)
    long = long.filter(F.col("segment_value").isNotNull())
    by = ["dimension_name", "segment_value"]
    curve = reaching(tenure_histogram(long, "tenure_in_months", "churn_flag", by=by), by=by)
    hi, med = SEGMENT_SUPPORT
    rated = curve.select(
        *by, "tenure_month", "customers_reaching_tenure", "churned_at_tenure",
        ratio4("churned_at_tenure", "customers_reaching_tenure").alias("churn_rate_at_tenure"),
    )
    return rated.select(
        *by, "tenure_month", "customers_reaching_tenure", "churned_at_tenure",
        "churn_rate_at_tenure",
        rolling_rate("churn_rate_at_tenure", by=by).alias("rolling_3m_churn_rate"),
        support_level("customers_reaching_tenure", hi, med).alias("base_support_level"),
    )
