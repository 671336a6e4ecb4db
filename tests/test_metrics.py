"""Metric layer: synonyms per table, guards before any job, metric values."""
import pytest
from conftest import c360_rows

from churnlens.plans.metrics import MetricError, metric_query, semantic_model


def _c(spark):
    rows = [{"customer_id": "a", "contract": "M", "churn_flag": 1, "cltv": 10,
             "monthly_charge": 1.25, "total_revenue": 10.0, "tenure_in_months": 3,
             "total_service_count": 2, "customer_value_segment": "Low Value"},
            {"customer_id": "b", "contract": "M", "churn_flag": 0, "cltv": 20,
             "monthly_charge": 2.5, "total_revenue": 5.0, "tenure_in_months": 4,
             "total_service_count": 2, "customer_value_segment": "Low Value"},
            {"customer_id": "c", "contract": "Y", "churn_flag": 0, "cltv": 30,
             "monthly_charge": 3.0, "total_revenue": 1.0, "tenure_in_months": 9,
             "total_service_count": 5, "customer_value_segment": "High Value"}]
    return c360_rows(spark, rows)


def test_synonyms_resolve_within_the_table():
    m = semantic_model()
    assert m["CUSTOMER_360_VIEW"].resolve("attrition rate") == "CHURN_RATE"
    assert m["CUSTOMER_360_VIEW"].resolve("Product Depth") == "TOTAL_SERVICE_COUNT"
    assert m["VW_PRODUCT_ADOPTION"].resolve("service") == "PRODUCT_NAME"
    with pytest.raises(MetricError):
        m["VW_CHURN_SEGMENTS"].resolve("product depth")


def test_metric_query_values(spark):
    got = {r.contract: r for r in metric_query(
        _c(spark), "CUSTOMER_360_VIEW", ["churn rate".replace(" ", "_").upper(), "AVG_CLTV",
                                         "TOTAL_MONTHLY_CHARGES"], ["contract"]).collect()}
    assert got["M"].churn_rate == 0.5 and got["M"].avg_cltv == 15.0
    assert got["M"].total_monthly_charges == 3.75
    assert got["Y"].churn_rate == 0.0


def test_guards_fail_before_running(spark):
    c = _c(spark)
    with pytest.raises(MetricError):
        metric_query(c, "CUSTOMER_360_VIEW", ["NOT_A_METRIC"])
    with pytest.raises(MetricError):
        metric_query(c, "CUSTOMER_360_VIEW", ["CHURN_RATE"], ["CHURN_CONTRIBUTION"])
    with pytest.raises(MetricError):
        metric_query(c, "VW_CHURN_SEGMENTS", sum_facts=["CHURN_RATE"])
    with pytest.raises(MetricError):
        metric_query(c, "VW_CHURN_SEGMENTS", metrics=["CHURN_RATE"])
    with pytest.raises(MetricError):
        metric_query(c, "NO_SUCH_TABLE", ["CHURN_RATE"])


def test_named_filter_applies(spark):
    from churnlens.plans import lifecycle
    curve = lifecycle.churn_by_tenure_segment(_c(spark))
    out = metric_query(curve, "VW_CHURN_BY_TENURE_SEGMENT", dimensions=["tenure month"],
                       filters=["CONTRACT_CHURN_BY_TENURE"], sum_facts=["CHURNED_AT_TENURE"])
    assert {r.tenure_month: r.total_churned_at_tenure for r in out.collect()} == {3: 1, 4: 0, 9: 0}
