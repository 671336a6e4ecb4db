"""Marts on the customer 360 (M1-M6).

Each mart is one scan of the 360 and one grouped aggregation with partial
(map-side) aggregation; portfolio totals that the reference gets from a
one-row CTE CROSS JOIN are taken from the grouped result with a window over
it (a few hundred rows) whenever the groups partition all rows, so the 360 is
not scanned a second time.

Semantics kept from the reference (SURVEY §2.13): numerators count ROWS
(``count_if``), denominators count DISTINCT customer ids; NULL segment values
stay a group of their own except where the reference coalesces them.
All rounding is exact (``functions.exact``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.exact import avg2, avg_money, index2, money, ratio4
from churnlens.operators.reshape import unpivot_dimensions
from churnlens.operators.tally import tally_dimensions
from churnlens.plans.core import customer_count, ids_unique

# Fixed dimension and product names of the reference's marts.
SEGMENT_DIMENSIONS = ["Contract", "Payment Method", "Tenure Band", "Age Band", "Offer",
                      "Internet Type", "Customer Value", "Satisfaction"]
PRODUCTS = [
    ("Phone Service", "phone_service"),
    ("Multiple Lines", "multiple_lines"),
    ("Internet Service", "internet_service"),
    ("Online Security", "online_security"),
    ("Online Backup", "online_backup"),
    ("Device Protection Plan", "device_protection_plan"),
    ("Premium Tech Support", "premium_tech_support"),
    ("Streaming TV", "streaming_tv"),
    ("Streaming Movies", "streaming_movies"),
    ("Streaming Music", "streaming_music"),
    ("Unlimited Data", "unlimited_data"),
]


def _all():
    return Window.partitionBy()


def with_cents(c360: DataFrame) -> DataFrame:
    """Money columns as integer cents for exact sums."""
    return c360.withColumns({
        "mc_cents": (F.col("monthly_charge") * 100).cast("bigint"),
        "rev_cents": (F.col("total_revenue") * 100).cast("bigint"),
    })


def _churned():
    return F.col("churn_flag") == 1


def _avg_parts(col: str, name: str):
    """Sum and non-NULL count of a column (the two halves of an exact average)."""
    return [F.sum(col).alias(f"_s_{name}"), F.count(col).alias(f"_n_{name}")]


def executive_kpis(c360: DataFrame) -> DataFrame:
    """M1: one row per snapshot quarter, 17 KPIs."""
    b = with_cents(c360)
    g = b.groupBy("snapshot_quarter").agg(
        customer_count(c360).alias("total_customers"),
        F.count_if(F.col("customer_status") == "Stayed").alias("stayed_customers"),
        F.count_if(F.col("customer_status") == "Joined").alias("joined_customers"),
        F.count_if(_churned()).alias("churned_customers"),
        *_avg_parts("mc_cents", "mc"), *_avg_parts("rev_cents", "rev"),
        F.sum(F.when(_churned(), F.col("mc_cents")).otherwise(0)).alias("_ch_mc"),
        F.sum(F.when(_churned(), F.col("rev_cents")).otherwise(0)).alias("_ch_rev"),
        *_avg_parts("cltv", "cltv"),
        F.count_if(F.col("high_value_flag") == 1).alias("high_value_customers"),
        F.count_if((F.col("high_value_flag") == 1) & _churned()).alias("_hv_churned"),
        *_avg_parts("tenure_in_months", "ten"), *_avg_parts("satisfaction_score", "sat"),
    )
    return g.select(
        "snapshot_quarter", "total_customers", "stayed_customers", "joined_customers",
        "churned_customers",
        ratio4("churned_customers", "total_customers").alias("churn_rate"),
        money("_s_mc").alias("total_monthly_charges"),
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge"),
        money("_s_rev").alias("total_revenue"),
        avg_money("_s_rev", "_n_rev").alias("avg_total_revenue_per_customer"),
        money("_ch_mc").alias("churned_monthly_revenue"),
        money("_ch_rev").alias("churned_historical_revenue"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv"),
        "high_value_customers",
        ratio4("_hv_churned", "high_value_customers").alias("high_value_churn_rate"),
        avg2("_s_ten", "_n_ten").alias("avg_tenure_months"),
        avg2("_s_sat", "_n_sat").alias("avg_satisfaction_score"),
    )


def segment_dimensions() -> dict:
    return {
        "Contract": F.col("contract"),
        "Payment Method": F.col("payment_method"),
        "Tenure Band": F.col("tenure_band"),
        "Age Band": F.col("age_band"),
        "Offer": F.coalesce(F.col("offer"), F.lit("No Offer")),
        "Internet Type": F.coalesce(F.col("internet_type"), F.lit("No Internet")),
        "Customer Value": F.col("customer_value_segment"),
        "Satisfaction": F.col("satisfaction_band"),
    }


def _by_dimension(c360: DataFrame, dims: dict, keep: list[str], parts: list, only: list[str] | None,
                  name_col: str, value_col: str, by: list[str]) -> DataFrame:
    """``parts`` per group of ``by``, dimension and value. With ids verified unique all parts are additive, so
    tuples of the dimensions are tallied before the unpivot; otherwise customers are unpivoted
    and ids counted distinct."""
    b = with_cents(c360)
    if ids_unique(c360):
        chosen = {n: c for n, c in dims.items() if only is None or n in only}
        if not chosen:
            raise ValueError(f"no dimension selected from {list(dims)}")
        return tally_dimensions(b, [chosen], parts, by, name_col=name_col, value_col=value_col)
    long = unpivot_dimensions(b, dims, [*by, *keep], only=only, name_col=name_col,
                              value_col=value_col)
    return long.groupBy(*by, name_col, value_col).agg(*parts)


def _quarter(by_quarter: bool) -> list[str]:
    return ["snapshot_quarter"] if by_quarter else []


def churn_segments(c360: DataFrame, only: list[str] | None = None,
                   by_quarter: bool = False) -> DataFrame:
    """M2: churn by segment over eight dimensions (one scan), of the whole 360 or of each
    snapshot quarter (a first column; contributions are then the quarter's).

    Contribution denominator = all churned rows; every dimension covers every
    row once (NULL values form their own group), so the per-dimension sum of
    churned rows equals that total and comes from a window on the result.
    """
    by = _quarter(by_quarter)
    g = _by_dimension(
        c360, segment_dimensions(), ["customer_id", "churn_flag", "mc_cents", "rev_cents", "cltv"], [
            customer_count(c360).alias("total_customers"),
            F.count_if(_churned()).alias("churned_customers"),
            *_avg_parts("mc_cents", "mc"), *_avg_parts("cltv", "cltv"),
            F.sum(F.when(_churned(), F.col("mc_cents")).otherwise(0)).alias("_ch_mc"),
            F.sum(F.when(_churned(), F.col("rev_cents")).otherwise(0)).alias("_ch_rev"),
        ], only, "dimension_name", "segment_value", by,
    ).withColumn("_all_churned", F.sum("churned_customers").over(
        Window.partitionBy(*by, "dimension_name")))
    return g.select(
        *by, "dimension_name", "segment_value", "total_customers", "churned_customers",
        ratio4("churned_customers", "total_customers").alias("churn_rate"),
        ratio4("churned_customers", "_all_churned").alias("churn_contribution"),
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv"),
        money("_ch_mc").alias("churned_monthly_revenue"),
        money("_ch_rev").alias("churned_historical_revenue"),
    )


def product_adoption(c360: DataFrame, only: list[str] | None = None) -> DataFrame:
    """M3: 11 products × adoption status (NULL → 'Not Applicable').

    ``customer_share`` = customers / Σ customers of the product: a window over
    the grouped result partitioned by product (trap 10: 'Not Applicable' is in
    the denominator).
    """
    dims = {name: F.coalesce(F.col(col), F.lit("Not Applicable")) for name, col in PRODUCTS}
    g = _by_dimension(
        c360, dims, ["customer_id", "churn_flag", "mc_cents", "rev_cents", "cltv",
                     "tenure_in_months"], [
            customer_count(c360).alias("customers"),
            F.count_if(_churned()).alias("churned_customers"),
            *_avg_parts("mc_cents", "mc"), *_avg_parts("rev_cents", "rev"),
            *_avg_parts("cltv", "cltv"), *_avg_parts("tenure_in_months", "ten"),
        ], only, "product_name", "adoption_status", [],
    ).withColumn("_product_customers", F.sum("customers").over(
        Window.partitionBy("product_name")))
    return g.select(
        "product_name", "adoption_status", "customers",
        ratio4("customers", "_product_customers").alias("customer_share"),
        "churned_customers",
        ratio4("churned_customers", "customers").alias("churn_rate"),
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge"),
        avg_money("_s_rev", "_n_rev").alias("avg_total_revenue"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv"),
        avg2("_s_ten", "_n_ten").alias("avg_tenure_months"),
    )


def product_depth(c360: DataFrame) -> DataFrame:
    """M4: by total service count; churn index from unrounded rates.

    The overall rate's denominator is the DISTINCT customer count of the whole
    360. With ids verified unique every customer is in exactly one group, so
    the overall counts are sums over the grouped rows (a window over a dozen
    rows, no second scan). Otherwise a one-row aggregate of the 360 is
    broadcast (one row, size-proven).
    """
    b = with_cents(c360)
    g = b.groupBy("total_service_count").agg(
        customer_count(c360).alias("customers"),
        F.count_if(_churned()).alias("churned_customers"),
        *_avg_parts("tenure_in_months", "ten"), *_avg_parts("mc_cents", "mc"),
        *_avg_parts("rev_cents", "rev"), *_avg_parts("cltv", "cltv"),
    ).withColumn("_sum_customers", F.sum("customers").over(_all()))
    if ids_unique(c360):
        g = g.withColumns({"_all_churned": F.sum("churned_customers").over(_all()),
                           "_all_customers": F.col("_sum_customers")})
    else:
        overall = b.agg(F.count_if(_churned()).alias("_all_churned"),
                        customer_count(c360).alias("_all_customers"))
        g = g.crossJoin(F.broadcast(overall))
    return g.select(
        "total_service_count", "customers",
        ratio4("customers", "_sum_customers").alias("customer_share"),
        "churned_customers",
        ratio4("churned_customers", "customers").alias("churn_rate"),
        index2("churned_customers", "customers", "_all_churned", "_all_customers")
        .alias("churn_index"),
        avg2("_s_ten", "_n_ten").alias("avg_tenure_months"),
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge"),
        avg_money("_s_rev", "_n_rev").alias("avg_total_revenue"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv"),
    )


def customer_value(c360: DataFrame, by_quarter: bool = False) -> DataFrame:
    """M5: by value segment and quartile; contribution and revenue shares, of the whole 360 or
    of each snapshot quarter (a first column)."""
    b = with_cents(c360)
    by = _quarter(by_quarter)
    whole = Window.partitionBy(*by)        # at most a few quartile rows
    g = b.groupBy(*by, "customer_value_segment", "cltv_quartile").agg(
        customer_count(c360).alias("customers"),
        F.count_if(_churned()).alias("churned_customers"),
        *_avg_parts("cltv", "cltv"),
        F.min("cltv").alias("min_cltv"), F.max("cltv").alias("max_cltv"),
        *_avg_parts("mc_cents", "mc"), *_avg_parts("rev_cents", "rev"),
        F.sum(F.when(_churned(), F.col("mc_cents")).otherwise(0)).alias("_ch_mc"),
        *_avg_parts("tenure_in_months", "ten"),
    ).withColumns({
        "_all_churned": F.sum("churned_customers").over(whole),
        "_all_rev": F.sum("_s_rev").over(whole),
        "_all_ch_mc": F.sum("_ch_mc").over(whole),
    })
    return g.select(
        *by, "customer_value_segment", "cltv_quartile", "customers", "churned_customers",
        ratio4("churned_customers", "customers").alias("churn_rate"),
        ratio4("churned_customers", "_all_churned").alias("churn_contribution"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv"), "min_cltv", "max_cltv",
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge"),
        avg_money("_s_rev", "_n_rev").alias("avg_total_revenue"),
        money("_s_rev").alias("total_segment_revenue"),
        ratio4("_s_rev", "_all_rev").alias("revenue_share"),
        money("_ch_mc").alias("churned_monthly_revenue"),
        ratio4("_ch_mc", "_all_ch_mc").alias("churned_monthly_revenue_share"),
        avg2("_s_ten", "_n_ten").alias("avg_tenure_months"),
    )


def churn_reasons(c360: DataFrame) -> DataFrame:
    """M6: churned rows only; share = distinct customers / churned ROWS (trap 1)."""
    b = with_cents(c360).filter(_churned())
    g = b.groupBy("churn_category", "churn_reason").agg(
        customer_count(c360).alias("churned_customers"),
        F.count(F.lit(1)).alias("_rows"),
        *_avg_parts("tenure_in_months", "ten"), *_avg_parts("mc_cents", "mc"),
        *_avg_parts("rev_cents", "rev"), *_avg_parts("cltv", "cltv"),
        *_avg_parts("satisfaction_score", "sat"),
    )
    # reasons are free text, so the total is a one-row aggregate (broadcast), not a window
    g = g.crossJoin(F.broadcast(b.agg(F.count(F.lit(1)).alias("_all_rows"))))
    return g.select(
        "churn_category", "churn_reason", "churned_customers",
        ratio4("churned_customers", "_all_rows").alias("churn_share"),
        avg2("_s_ten", "_n_ten").alias("avg_tenure_months"),
        avg_money("_s_mc", "_n_mc").alias("avg_monthly_charge"),
        avg_money("_s_rev", "_n_rev").alias("avg_total_revenue"),
        avg2("_s_cltv", "_n_cltv").alias("avg_cltv"),
        avg2("_s_sat", "_n_sat").alias("avg_satisfaction_score"),
    )
