"""Registered queries: key → callable(spark, sf_dir) → DataFrame.

Every callable reads the driver's tables under ``sf_dir`` (through the
adapter and the CORE layer, materialised once per session by
``plans.layers``) and returns a lazy DataFrame. No result rows reach the
driver; the only value the build reads back is one scalar (whether customer
ids are unique), which selects the join-free 360 and plain id counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.plans import core as core_plans
from churnlens.plans import (lifecycle, marts, metrics, present, quality, reconcile,
                             responses, triage, verified)
from churnlens.plans.layers import layers_for, raw_for
from churnlens.sources.readers import load_star

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(key: str):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn
    return deco


def _c360(spark, sf):
    return layers_for(spark, sf).c360


# --- CORE (C1-C16) ----------------------------------------------------------

@register("core_profile")
def q_core_profile(spark, sf):
    return layers_for(spark, sf).profile


@register("core_location")
def q_core_location(spark, sf):
    return layers_for(spark, sf).location


@register("core_services")
def q_core_services(spark, sf):
    return layers_for(spark, sf).services


@register("core_snapshot")
def q_core_snapshot(spark, sf):
    return layers_for(spark, sf).snapshot


@register("customer_360")
def q_customer_360(spark, sf):
    return _c360(spark, sf)


@register("customer_360_joined")
def q_customer_360_joined(spark, sf):
    """C15 in the reference's form: profile ⋈ location ⋈ services ⋈ snapshot (inner joins),
    snapshot = status ⟕ services; must equal ``customer_360``."""
    from churnlens.plans.layers import joined_layers_for
    return joined_layers_for(spark, sf).c360


@register("cltv_quartile")
def q_cltv_quartile(spark, sf):
    """Quartile sizes and CLTV bounds: checks the distributed NTILE against SQL NTILE."""
    return (layers_for(spark, sf).snapshot.groupBy("cltv_quartile")
            .agg(F.count(F.lit(1)).alias("customers"), F.min("cltv").alias("min_cltv"),
                 F.max("cltv").alias("max_cltv"),
                 F.min("customer_id").alias("min_customer_id"),
                 F.max("customer_id").alias("max_customer_id")))


@register("depth_segment")
def q_depth_segment(spark, sf):
    c = core_plans.with_depth_segment(_c360(spark, sf))
    return c.groupBy("product_depth_segment", "total_service_count").agg(
        F.count(F.lit(1)).alias("customers"))


# --- Marts (M1-M9) ----------------------------------------------------------

@register("executive_kpis")
def q_executive_kpis(spark, sf):
    return marts.executive_kpis(_c360(spark, sf))


@register("churn_segments")
def q_churn_segments(spark, sf):
    return marts.churn_segments(_c360(spark, sf))


@register("product_adoption")
def q_product_adoption(spark, sf):
    return marts.product_adoption(_c360(spark, sf))


@register("product_depth")
def q_product_depth(spark, sf):
    return marts.product_depth(_c360(spark, sf))


@register("customer_value")
def q_customer_value(spark, sf):
    return marts.customer_value(_c360(spark, sf))


@register("churn_reasons")
def q_churn_reasons(spark, sf):
    return marts.churn_reasons(_c360(spark, sf))


@register("churn_by_tenure")
def q_churn_by_tenure(spark, sf):
    return lifecycle.churn_by_tenure(_c360(spark, sf))


@register("churn_by_tenure_enhanced")
def q_churn_by_tenure_enhanced(spark, sf):
    return lifecycle.churn_by_tenure_enhanced(lifecycle.churn_by_tenure(_c360(spark, sf)))


@register("churn_by_tenure_segment")
def q_churn_by_tenure_segment(spark, sf):
    return lifecycle.churn_by_tenure_segment(_c360(spark, sf))


# --- RAW data quality (S1-S2, D1-D12) and CORE validation (V1-V5) -------------

def _raw(spark, sf):
    return raw_for(spark, sf)


@register("raw_load_counts")
def q_raw_load_counts(spark, sf):
    """Raw tables written as header CSV (source-style headers), read back
    typed with header normalisation; rows and type failures per table."""
    import os
    import uuid

    from churnlens.session import ensure_checkpoint_dir
    from churnlens.sources.readers import load_report, read_raw, write_raw
    # a folder per call: an earlier call's DataFrame keeps its files
    folder = os.path.join(ensure_checkpoint_dir(spark), "raw-csv", uuid.uuid4().hex[:12])
    write_raw(_raw(spark, sf), folder, "csv")
    return load_report(read_raw(spark, folder, "csv", keep_failures=True))


@register("dq_row_counts")
def q_dq_row_counts(spark, sf):
    return quality.row_counts(_raw(spark, sf))


@register("dq_uniqueness")
def q_dq_uniqueness(spark, sf):
    r = _raw(spark, sf)
    return quality.uniqueness({t: r[t] for t in quality.KEYED})


@register("dq_null_ids")
def q_dq_null_ids(spark, sf):
    r = _raw(spark, sf)
    return quality.null_keys({t: r[t] for t in quality.KEYED})


@register("dq_join_completeness")
def q_dq_join_completeness(spark, sf):
    r = _raw(spark, sf)
    return quality.completeness(r["churn_demographics"], {
        "location": r["churn_location"], "services": r["churn_services"],
        "status": r["churn_status"]})


@register("dq_zip_reconciliation")
def q_dq_zip_reconciliation(spark, sf):
    r = _raw(spark, sf)
    return quality.zip_reconciliation(r["churn_location"], r["churn_population"])


@register("dq_churn_distribution")
def q_dq_churn_distribution(spark, sf):
    return quality.distribution(_raw(spark, sf)["churn_status"], ["churn_label", "churn_value"])


@register("dq_status_distribution")
def q_dq_status_distribution(spark, sf):
    return quality.distribution(_raw(spark, sf)["churn_status"], ["customer_status"])


@register("dq_label_consistency")
def q_dq_label_consistency(spark, sf):
    return quality.distribution(_raw(spark, sf)["churn_status"], ["churn_label", "churn_value"],
                                pct=False)


@register("dq_numeric_ranges")
def q_dq_numeric_ranges(spark, sf):
    return quality.ranges(_raw(spark, sf)["churn_services"])


@register("dq_churn_nulls")
def q_dq_churn_nulls(spark, sf):
    return quality.null_profile(_raw(spark, sf)["churn_status"])


@register("dq_quarters")
def q_dq_quarters(spark, sf):
    r = _raw(spark, sf)
    return quality.quarters(r["churn_services"], r["churn_status"])


@register("dq_domains")
def q_dq_domains(spark, sf):
    return quality.domains(_raw(spark, sf))


@register("dq_domain_discovery")
def q_dq_domain_discovery(spark, sf):
    """D12 for the columns without a fixed list, and for two with rare values."""
    return quality.domain_discovery(
        _raw(spark, sf), {**quality.DISCOVERED, "churn_demographics": ["age", "number_of_dependents"]})


@register("core_grain")
def q_core_grain(spark, sf):
    return quality.uniqueness({"customer_360_view": _c360(spark, sf)})


@register("core_join_completeness")
def q_core_join_completeness(spark, sf):
    return quality.core_join_completeness(_c360(spark, sf))


@register("core_churn_recon")
def q_core_churn_recon(spark, sf):
    return quality.distribution(_c360(spark, sf), ["churn_label", "churn_value"], pct=False)


@register("core_revenue_recon")
def q_core_revenue_recon(spark, sf):
    return quality.revenue_reconciliation(_c360(spark, sf), _raw(spark, sf)["churn_services"])


@register("core_value_segments")
def q_core_value_segments(spark, sf):
    return quality.value_segments(_c360(spark, sf))


# --- Verified questions (Q1-Q8), ad hoc (A1, A3), dashboard (B1-B6) ----------

@register("vq_cltv_range")
def q_vq_cltv_range(spark, sf):
    return verified.cltv_range(_c360(spark, sf))


@register("vq_adopted_products")
def q_vq_adopted_products(spark, sf):
    return verified.adopted_products(marts.product_adoption(_c360(spark, sf)))


@register("vq_peak_tenure")
def q_vq_peak_tenure(spark, sf):
    return verified.peak_tenure(verified.contract_curves(_c360(spark, sf)))


@register("vq_segments_by_churned_charge")
def q_vq_segments_by_churned_charge(spark, sf):
    return verified.segments_by_churned_charge(marts.churn_segments(_c360(spark, sf)))


@register("vq_contract_churn")
def q_vq_contract_churn(spark, sf):
    return verified.dimension_churn(verified.one_dimension(_c360(spark, sf), "Contract"),
                                    "Contract")


@register("vq_adoption_gap")
def q_vq_adoption_gap(spark, sf):
    return verified.adoption_gap(marts.product_adoption(_c360(spark, sf)))


@register("vq_value_churn")
def q_vq_value_churn(spark, sf):
    return verified.dimension_churn(
        verified.one_dimension(_c360(spark, sf), "Customer Value"), "Customer Value")


@register("vq_tenure_all_contracts")
def q_vq_tenure_all_contracts(spark, sf):
    return verified.tenure_all_contracts(verified.contract_curves(_c360(spark, sf)))


@register("adhoc_payment_profile")
def q_adhoc_payment_profile(spark, sf):
    return verified.payment_profile(verified.one_dimension(_c360(spark, sf), "Payment Method"))


@register("adhoc_above_average")
def q_adhoc_above_average(spark, sf):
    c = _c360(spark, sf)
    return verified.above_average(marts.churn_segments(c, by_quarter=True), marts.executive_kpis(c))


@register("dash_kpis")
def q_dash_kpis(spark, sf):
    return present.kpi_strip(marts.executive_kpis(_c360(spark, sf)))


@register("dash_contract")
def q_dash_contract(spark, sf):
    rows = verified.dimension_churn(verified.one_dimension(_c360(spark, sf), "Contract"),
                                    "Contract")
    return present.rate_table(rows, "contract_type")


@register("dash_value")
def q_dash_value(spark, sf):
    rows = verified.dimension_churn(
        verified.one_dimension(_c360(spark, sf), "Customer Value"), "Customer Value")
    return present.rate_table(rows, "value_segment")


@register("dash_product_gap")
def q_dash_product_gap(spark, sf):
    return present.product_gap_table(
        verified.adoption_gap(marts.product_adoption(_c360(spark, sf))))


@register("dash_tenure")
def q_dash_tenure(spark, sf):
    return present.tenure_table(
        verified.tenure_all_contracts(verified.contract_curves(_c360(spark, sf))))


@register("business_format")
def q_business_format(spark, sf):
    from churnlens.functions.fmt import business_format
    c = _c360(spark, sf)
    gap = verified.adoption_gap(marts.product_adoption(c))
    return business_format(gap)


@register("business_format_segments")
def q_business_format_segments(spark, sf):
    """B6 on the segment mart: percentages, counts, money and CLTV."""
    from churnlens.functions.fmt import business_format
    return business_format(marts.churn_segments(_c360(spark, sf)))


# --- Metric layer (G1-G7) and A2 -------------------------------------------------

C360_PROFILE_FIELDS = ["AGE_BAND", "CHURN_CATEGORY", "CHURN_FLAG", "CHURN_REASON", "CITY", "CLTV",
                       "CONTRACT", "CUSTOMER_ID", "CUSTOMER_STATUS", "CUSTOMER_VALUE_SEGMENT",
                       "INTERNET_SERVICE", "INTERNET_TYPE", "OFFER", "PAYMENT_METHOD",
                       "PREMIUM_TECH_SUPPORT", "SATISFACTION_SCORE", "STATE", "TENURE_BAND",
                       "TENURE_IN_MONTHS", "TOTAL_SERVICE_COUNT"]


@register("metric_values")
def q_metric_values(spark, sf):
    return metrics.metric_values(_c360(spark, sf))


@register("metric_values_by_contract")
def q_metric_values_by_contract(spark, sf):
    return metrics.metric_values(_c360(spark, sf), by=["CONTRACT"])


@register("metric_values_by_offer_value")
def q_metric_values_by_offer_value(spark, sf):
    """Two dimensions, one of them with NULLs, one through a synonym."""
    return metrics.metric_values(_c360(spark, sf), by=["OFFER", "value segment"])


@register("product_adoption_rate")
def q_product_adoption_rate(spark, sf):
    return metrics.product_adoption_rate(marts.product_adoption(_c360(spark, sf)))


@register("metric_query_contract")
def q_metric_query_contract(spark, sf):
    return metrics.metric_query(
        _c360(spark, sf), "CUSTOMER_360_VIEW",
        metrics=["TOTAL_CUSTOMERS", "CHURNED_CUSTOMERS", "CHURN_RATE", "AVG_CLTV",
                 "AVG_MONTHLY_CHARGE", "AVG_TENURE_MONTHS", "TOTAL_MONTHLY_CHARGES",
                 "TOTAL_HISTORICAL_REVENUE"],
        dimensions=["CONTRACT"])


@register("metric_query_two_dims")
def q_metric_query_two_dims(spark, sf):
    """Synonyms resolved within the table: 'attrition rate' → CHURN_RATE, etc."""
    return metrics.metric_query(
        _c360(spark, sf), "CUSTOMER_360_VIEW",
        metrics=["attrition rate", "lost customers", "TOTAL_CUSTOMERS"],
        dimensions=["product depth", "value segment"], sum_facts=["MONTHLY_CHARGE"])


@register("metric_query_segments_facts")
def q_metric_query_segments_facts(spark, sf):
    """Additive facts of the segment mart summed per dimension under no filter."""
    return metrics.metric_query(
        marts.churn_segments(_c360(spark, sf)), "VW_CHURN_SEGMENTS",
        dimensions=["DIMENSION_NAME"],
        sum_facts=["CHURNED_MONTHLY_REVENUE", "CHURNED_HISTORICAL_REVENUE"])


@register("metric_query_tenure_filtered")
def q_metric_query_tenure_filtered(spark, sf):
    """Named filter CONTRACT_CHURN_BY_TENURE + summed facts by tenure month (Q8's parts)."""
    return metrics.metric_query(
        lifecycle.churn_by_tenure_segment(_c360(spark, sf)), "VW_CHURN_BY_TENURE_SEGMENT",
        dimensions=["lifecycle month"], filters=["CONTRACT_CHURN_BY_TENURE"],
        sum_facts=["CHURNED_AT_TENURE", "customers reaching tenure"])


@register("mq_adopted_products")
def q_mq_adopted_products(spark, sf):
    """Q2 as a request for native rows: adopted products by churn rate."""
    return metrics.ask(
        _c360(spark, sf), "VW_PRODUCT_ADOPTION", dimensions=["product", "CUSTOMERS"],
        facts=["attrition rate", "AVG_MONTHLY_CHARGE", "AVG_CLTV", "AVG_TENURE_MONTHS"],
        where={"product usage status": "Yes"}, order=["churn percentage DESC"], position="place")


@register("mq_segments_by_churned_charge")
def q_mq_segments_by_churned_charge(spark, sf):
    """Q4: every segment, the highest churned monthly charges first."""
    return metrics.ask(
        _c360(spark, sf), "VW_CHURN_SEGMENTS",
        dimensions=["DIMENSION_NAME", "SEGMENT_VALUE", "TOTAL_CUSTOMERS", "lost customers"],
        facts=["CHURN_RATE", "churn mix", "CHURNED_MONTHLY_REVENUE"],
        order=["CHURNED_MONTHLY_REVENUE DESC"], position="place")


_CHURN_COLUMNS = dict(dimensions=["SEGMENT_VALUE", "TOTAL_CUSTOMERS", "CHURNED_CUSTOMERS"],
                      facts=["CHURN_RATE", "CHURN_CONTRIBUTION"])


@register("mq_contract_churn")
def q_mq_contract_churn(spark, sf):
    """Q5: contract types by churn rate."""
    return metrics.ask(_c360(spark, sf), "VW_CHURN_SEGMENTS", **_CHURN_COLUMNS,
                       where={"DIMENSION_NAME": "Contract"}, order=["CHURN_RATE DESC"],
                       position="place")


@register("mq_value_churn")
def q_mq_value_churn(spark, sf):
    """Q7: value segments by churn rate, NULLs last, through the named filter."""
    return metrics.ask(_c360(spark, sf), "VW_CHURN_SEGMENTS", **_CHURN_COLUMNS,
                       filters=["CHURN_SEGMENTS_BY_CUSTOMER_VALUE"],
                       order=["CHURN_RATE DESC NULLS LAST"], position="place")


@register("mq_top_customers")
def q_mq_top_customers(spark, sf):
    """Top k of native rows: the 50 customers of highest revenue, unknown revenue first."""
    return metrics.ask(
        _c360(spark, sf), "CUSTOMER_360_VIEW", dimensions=["CUSTOMER_ID", "CONTRACT", "value segment"],
        facts=["TOTAL_REVENUE", "MONTHLY_CHARGE"],
        order=["TOTAL_REVENUE DESC NULLS FIRST", "MONTHLY_CHARGE"], limit=50, position="place")


@register("mq_top_groups")
def q_mq_top_groups(spark, sf):
    """Top k of an aggregate: the ten (offer, tenure band) groups of highest churn rate."""
    return metrics.ask(
        _c360(spark, sf), "CUSTOMER_360_VIEW", metrics=["CHURN_RATE", "TOTAL_CUSTOMERS"],
        dimensions=["OFFER", "TENURE_BAND"], sum_facts=["TOTAL_REVENUE"],
        order=["CHURN_RATE DESC", "TOTAL_CUSTOMERS DESC"], limit=10, position="place")


@register("named_filters")
def q_named_filters(spark, sf):
    c = _c360(spark, sf)
    return metrics.named_filter_counts({
        "VW_CHURN_BY_TENURE_SEGMENT": lifecycle.churn_by_tenure_segment(c),
        "VW_CHURN_SEGMENTS": marts.churn_segments(c),
        "VW_PRODUCT_ADOPTION": marts.product_adoption(c)})


@register("field_profile")
def q_field_profile(spark, sf):
    return metrics.field_profile(_c360(spark, sf), C360_PROFILE_FIELDS)


@register("field_profiles")
def q_field_profiles(spark, sf):
    """G6 for all four logical tables, every column."""
    c = _c360(spark, sf)
    return metrics.logical_profiles({
        "CUSTOMER_360_VIEW": c,
        "VW_CHURN_BY_TENURE_SEGMENT": lifecycle.churn_by_tenure_segment(c),
        "VW_CHURN_SEGMENTS": marts.churn_segments(c),
        "VW_PRODUCT_ADOPTION": marts.product_adoption(c)})


@register("adhoc_payment_contract")
def q_adhoc_payment_contract(spark, sf):
    """A2: payment × contract, all combinations, no size cut-off (through G2)."""
    return metrics.metric_query(
        _c360(spark, sf), "CUSTOMER_360_VIEW",
        metrics=["TOTAL_CUSTOMERS", "CHURNED_CUSTOMERS", "CHURN_RATE"],
        dimensions=["PAYMENT_METHOD", "CONTRACT"])


# --- Reconciliation (R1, R2, R4) ---------------------------------------------------

# Metric layer name → (KPI mart column, tolerance of the mart's rounding).
RECON_PAIRS = [("TOTAL_CUSTOMERS", "total_customers", 0.0),
               ("CHURNED_CUSTOMERS", "churned_customers", 0.0),
               ("CHURN_RATE", "churn_rate", 0.00005),
               ("AVG_CLTV", "avg_cltv", 0.005),
               ("AVG_MONTHLY_CHARGE", "avg_monthly_charge", 0.005),
               ("AVG_TENURE_MONTHS", "avg_tenure_months", 0.005),
               ("TOTAL_MONTHLY_CHARGES", "total_monthly_charges", 0.005),
               ("TOTAL_HISTORICAL_REVENUE", "total_revenue", 0.005)]


@register("metric_reconciliation")
def q_metric_reconciliation(spark, sf):
    """The metric layer against the executive KPI mart, within rounding tolerance."""
    c = _c360(spark, sf)
    names = [m for m, _, _ in RECON_PAIRS]
    actual = metrics.metric_query(c, "CUSTOMER_360_VIEW", metrics=names).select(
        *[F.col(m.lower()).cast("double").alias(m) for m in names]).unpivot(
        [], names, "metric", "actual")
    k = marts.executive_kpis(c)
    expected = k.select(*[F.col(col).cast("double").alias(m) for m, col, _ in RECON_PAIRS]
                        ).unpivot([], names, "metric", "expected")
    tol = F.create_map(*[x for m, _, t in RECON_PAIRS for x in (F.lit(m), F.lit(t))])
    expected = expected.withColumn("tolerance", tol[F.col("metric")])
    return reconcile.reconcile(actual, expected)


@register("result_match")
def q_result_match(spark, sf):
    """R2: the pruned one-dimension mart vs the full mart filtered afterwards."""
    c = _c360(spark, sf)
    left = verified.dimension_churn(verified.one_dimension(c, "Contract"), "Contract")
    right = verified.dimension_churn(marts.churn_segments(c), "Contract")
    return reconcile.result_match(left, right)


@register("cross_layer_agreement")
def q_cross_layer_agreement(spark, sf):
    c = _c360(spark, sf)
    model = metrics.semantic_model(core_plans.ids_unique(c))
    model["CUSTOMER_360_VIEW"].dimensions["SNAPSHOT_QUARTER"] = F.col("snapshot_quarter")
    mq = metrics.metric_query(c, "CUSTOMER_360_VIEW",
                              metrics=["CHURNED_CUSTOMERS", "TOTAL_MONTHLY_CHARGES"],
                              dimensions=["SNAPSHOT_QUARTER"], where={"CHURN_FLAG": 1}, model=model)
    mq = mq.select("snapshot_quarter", "churned_customers",
                   F.col("total_monthly_charges").alias("total_monthly_charges_churned"))
    return reconcile.cross_layer(marts.executive_kpis(c), marts.churn_segments(c, by_quarter=True),
                                 marts.customer_value(c, by_quarter=True), mq)


@register("run_regressions")
def q_run_regressions(spark, sf):
    """Each nation's average order value, answered at yearly cut-offs, against the final one."""
    from churnlens.sources.runs import order_value_answers, order_value_expected
    star = _star(spark, sf)
    return reconcile.run_regressions(reconcile.judge_runs(order_value_answers(star),
                                                          order_value_expected(star)))


# --- Response logs (J1-J8) and triage (J9) ---------------------------------------

def _docs(spark, sf):
    from churnlens.sources.responses import response_documents
    return response_documents(_star(spark, sf)["conversations"])


def _star(spark, sf):
    """The given tables; what reads only them does not build the layers."""
    return load_star(spark, sf)


@register("json_safe_parse")
def q_json_safe_parse(spark, sf):
    s = _star(spark, sf)
    return responses.safe_parse_report(s["events"], s["conversations"])


@register("log_items")
def q_log_items(spark, sf):
    return responses.items(_docs(spark, sf))


@register("json_paths")
def q_json_paths(spark, sf):
    return responses.paths(_docs(spark, sf))


@register("log_last_item")
def q_log_last_item(spark, sf):
    return responses.last_items(_docs(spark, sf))


@register("log_sql_details")
def q_log_sql_details(spark, sf):
    return responses.sql_details(_docs(spark, sf))


@register("log_usage")
def q_log_usage(spark, sf):
    return responses.usage(_docs(spark, sf))


@register("log_wide")
def q_log_wide(spark, sf):
    return responses.wide(_docs(spark, sf))


@register("log_result_rows")
def q_log_result_rows(spark, sf):
    return responses.result_rows(_docs(spark, sf))


@register("question_triage")
def q_question_triage(spark, sf):
    """Every user turn and every question derived from the customers."""
    from churnlens.sources.questions import question_rows
    star = _star(spark, sf)
    turns = star["conversations"].filter(F.col("role") == "user").select("text")
    return triage.triage_summary(turns.unionByName(
        question_rows(star["customer"], star["nation"]).select("text")))
