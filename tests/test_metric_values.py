"""Metric values by dimensions from one tally; tuples tallied before the unpivot."""
import pytest
from conftest import c360_rows
from pyspark.sql import functions as F

from churnlens.operators.reshape import unpivot_dimensions
from churnlens.operators.tally import tally_dimensions
from churnlens.plans import marts
from churnlens.plans.core import mark_unique_ids
from churnlens.plans.metrics import LIMITATIONS, MetricError, metric_values


@pytest.fixture(scope="module")
def plain(spark):
    rows = [{"customer_id": f"c{i:02}", "contract": ["M", "Y", None][i % 3], "churn_flag": int(i % 4 == 0),
             "cltv": None if i == 3 else 10 * i, "monthly_charge": 1.25 * (i % 5),
             "total_revenue": i, "tenure_in_months": None if i == 5 else i % 6,
             "total_service_count": i % 3, "offer": ["A", None][i % 2], "satisfaction_score": i % 5,
             "phone_service": [None, "Yes", "No"][i % 3],
             "customer_value_segment": ["Low Value", "High Value"][i % 2]} for i in range(30)]
    return c360_rows(spark, rows).cache()


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("by", [(), ("CONTRACT",), ("offer", "value segment")])
def test_tally_and_distinct_counts_agree(plain, by):
    unique = mark_unique_ids(plain.select("*"))
    got = metric_values(unique, by)
    assert _set(got) == _set(metric_values(plain, by))
    assert {r.metric_name for r in got.collect()} == set(LIMITATIONS)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1 and plan.count("Expand") == 1


def test_each_group_is_its_own_portfolio(plain):
    by = {(r.contract, r.dimension_name, r.segment_value, r.metric_name): r.metric_value
          for r in metric_values(mark_unique_ids(plain.select("*")), ["contract"]).collect()}
    for contract in ("M", "Y", None):
        part = plain.filter(F.col("contract").eqNullSafe(F.lit(contract)))
        alone = {(contract, r.dimension_name, r.segment_value, r.metric_name): r.metric_value
                 for r in metric_values(part).collect()}
        assert alone == {k: v for k, v in by.items() if k[0] == contract}
    assert by["M", "Portfolio", "All", "total_customers"] == 10
    contribution = [v for k, v in by.items() if k[0] == "M" and k[1] == "Offer"
                    and k[3] == "churn_contribution"]
    assert sum(contribution) == pytest.approx(1.0)


def test_unknown_dimension_is_refused(plain):
    with pytest.raises(MetricError):
        metric_values(plain, ["SHOE_SIZE"])
    with pytest.raises(MetricError):
        metric_values(plain, ["OFFER", "offer"])


def test_repeated_ids_are_counted_once(plain):
    twice = plain.union(plain)
    got = {(r.dimension_name, r.segment_value, r.metric_name): r.metric_value
           for r in metric_values(twice).collect()}
    assert got["Portfolio", "All", "total_customers"] == 30
    assert got["Portfolio", "All", "churned_customers"] == 16          # rows


def test_marts_before_and_after_the_tally(plain):
    unique = mark_unique_ids(plain.select("*"))
    assert _set(marts.churn_segments(unique)) == _set(marts.churn_segments(plain))
    assert _set(marts.product_adoption(unique)) == _set(marts.product_adoption(plain))
    only = marts.churn_segments(unique, only=["Offer"])
    assert {r.dimension_name for r in only.collect()} == {"Offer"}
    for mart in (marts.churn_segments, marts.product_adoption):
        plan = mart(unique)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and plan.count("InMemoryRelation") == 1


def test_tally_of_families_equals_unpivot(plain):
    dims = {"c": F.col("contract"), "o": F.col("offer")}, {"t": F.col("tenure_in_months")}
    parts = [F.count(F.lit(1)).alias("n"), F.sum("cltv").alias("s")]
    got = tally_dimensions(plain, list(dims), parts, ["customer_value_segment"])
    long = unpivot_dimensions(plain, {**dims[0], **dims[1]}, ["customer_value_segment", "cltv"])
    want = long.groupBy("customer_value_segment", "dimension_name", "segment_value").agg(*parts)
    assert _set(got) == _set(want)
