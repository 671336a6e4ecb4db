"""Verified questions (Q1-Q8) and the documented ad hoc analyses (A1-A3).

Each reads a mart (or the 360) and selects, filters or re-aggregates it. Where a
question asks for one dimension of an unpivoted mart, only that dimension is
built (a filter above ``Expand`` would not be pushed into it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.plans import lifecycle, marts
from churnlens.plans.core import customer_count


def cltv_range(c360: DataFrame) -> DataFrame:
    """Q1: customers, min / average / max CLTV per value segment (average unrounded)."""
    return c360.groupBy("customer_value_segment").agg(
        customer_count(c360).alias("customers"),
        F.min("cltv").alias("min_cltv"),
        (F.sum("cltv").cast("double") / F.count("cltv")).alias("avg_cltv"),
        F.max("cltv").alias("max_cltv"),
    )


def adopted_products(adoption: DataFrame) -> DataFrame:
    """Q2: adopted products with churn rate, charges, CLTV and tenure."""
    return adoption.filter(F.col("adoption_status") == "Yes").select(
        "product_name", "customers", "churn_rate", "avg_monthly_charge", "avg_cltv",
        "avg_tenure_months")


def peak_tenure(curve_segments: DataFrame) -> DataFrame:
    """Q3: per contract the tenure month with the highest rate.

    The reference's ``QUALIFY ROW_NUMBER()`` has no tie-break; the smallest
    month wins here. The window runs over the contract curve (a few hundred rows).
    """
    w = Window.partitionBy("segment_value").orderBy(
        F.col("churn_rate_at_tenure").desc_nulls_last(), F.col("tenure_month").asc())
    c = curve_segments.filter(F.col("dimension_name") == "Contract")
    return (c.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select(F.col("segment_value").alias("contract_type"), "tenure_month",
                    "customers_reaching_tenure", "churned_at_tenure", "churn_rate_at_tenure"))


def segments_by_churned_charge(segments: DataFrame) -> DataFrame:
    """Q4: every segment with its churned monthly charges."""
    return segments.select("dimension_name", "segment_value", "total_customers",
                           "churned_customers", "churn_rate", "churn_contribution",
                           "churned_monthly_revenue")


def dimension_churn(segments: DataFrame, dimension: str) -> DataFrame:
    """Q5 / Q7: rate and contribution of one dimension's segments."""
    return segments.filter(F.col("dimension_name") == dimension).select(
        "segment_value", "total_customers", "churned_customers", "churn_rate",
        "churn_contribution")


def adoption_gap(adoption: DataFrame) -> DataFrame:
    """Q6: adopted vs non-adopted churn per product.

    The reference self-joins the mart on product; a conditional aggregation over
    the (product, status) rows gives the same pairs in one pass. Products lacking
    either side drop out, as with the inner join. The gap subtracts two rates that
    were already rounded (trap 12).
    """
    yes = F.col("adoption_status") == "Yes"
    no = F.col("adoption_status") == "No"
    g = adoption.groupBy("product_name").agg(
        F.max(F.when(yes, F.col("customers"))).alias("adopted_customers"),
        F.max(F.when(yes, F.col("churn_rate"))).alias("adopted_churn_rate"),
        F.max(F.when(no, F.col("customers"))).alias("not_adopted_customers"),
        F.max(F.when(no, F.col("churn_rate"))).alias("not_adopted_churn_rate"),
        F.count_if(yes).alias("_y"), F.count_if(no).alias("_n"),
    ).filter((F.col("_y") > 0) & (F.col("_n") > 0))
    return g.select("product_name", "adopted_customers", "adopted_churn_rate",
                    "not_adopted_customers", "not_adopted_churn_rate",
                    (F.col("adopted_churn_rate") - F.col("not_adopted_churn_rate"))
                    .alias("churn_rate_gap"))


def tenure_all_contracts(curve_segments: DataFrame) -> DataFrame:
    """Q8: the contract curves summed per month; rate = SUM/SUM, unrounded."""
    c = curve_segments.filter(F.col("dimension_name") == "Contract")
    g = c.groupBy("tenure_month").agg(
        F.sum("customers_reaching_tenure").alias("customers_reaching_tenure"),
        F.sum("churned_at_tenure").alias("churned_at_tenure"))
    return g.withColumn("churn_rate_at_tenure",
                        F.col("churned_at_tenure").cast("double")
                        / F.nullif(F.col("customers_reaching_tenure"), F.lit(0)))


# --- Ad hoc analyses ------------------------------------------------------------

def payment_profile(segments: DataFrame) -> DataFrame:
    """A1: rate, size, average charge and CLTV by payment method."""
    return segments.filter(F.col("dimension_name") == "Payment Method").select(
        F.col("segment_value").alias("payment_method"), "total_customers",
        "churned_customers", "churn_rate", "avg_monthly_charge", "avg_cltv")


def above_average(segments: DataFrame, kpis: DataFrame) -> DataFrame:
    """A3: segments above BOTH averages (monthly charge and churn rate) of their quarter.

    ``segments`` is the mart by quarter, ``kpis`` has one row per quarter; each quarter's segments
    meet their own benchmark only. Segments of different dimensions overlap and must
    not be summed.
    """
    bench = kpis.select(F.col("snapshot_quarter").alias("_quarter"),
                        F.col("avg_monthly_charge").alias("benchmark_avg_monthly_charge"),
                        F.col("churn_rate").alias("benchmark_churn_rate"))
    j = segments.join(bench, F.col("snapshot_quarter").eqNullSafe(F.col("_quarter")))
    return j.filter((F.col("avg_monthly_charge") > F.col("benchmark_avg_monthly_charge"))
                    & (F.col("churn_rate") > F.col("benchmark_churn_rate"))).select(
        "snapshot_quarter", "dimension_name", "segment_value", "total_customers",
        "churned_customers", "churn_rate", "avg_monthly_charge", "benchmark_avg_monthly_charge",
        "benchmark_churn_rate")


def contract_curves(c360: DataFrame) -> DataFrame:
    return lifecycle.churn_by_tenure_segment(c360, only=["Contract"])


def one_dimension(c360: DataFrame, dimension: str) -> DataFrame:
    return marts.churn_segments(c360, only=[dimension])
