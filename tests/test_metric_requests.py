"""Requests against the grain of a logical table: native rows, refusals, order and limits."""
import pytest
from conftest import c360_rows

from churnlens.plans import lifecycle, marts, verified
from churnlens.plans.metrics import (MetricError, Order, ask, metric_query, plan_request,
                                     semantic_model)

SEGMENTS, CURVE, ADOPTION, C360 = (
    "VW_CHURN_SEGMENTS", "VW_CHURN_BY_TENURE_SEGMENT", "VW_PRODUCT_ADOPTION", "CUSTOMER_360_VIEW")


@pytest.fixture(scope="module")
def c360(spark):
    rows = [{"customer_id": f"c{i:02}", "contract": "MYT"[i % 3], "churn_flag": int(i % 4 == 0),
             "cltv": 10 * i, "monthly_charge": 1.25 * (i % 5), "total_revenue": None if i == 7 else i,
             "tenure_in_months": i % 6, "total_service_count": i % 9, "phone_service":
             [None, "Yes", "No"][i % 3], "customer_value_segment": ["Low Value", "High Value"][i % 2]}
            for i in range(24)]
    return c360_rows(spark, rows).cache()


def _rows(df, *drop):
    return [tuple(r) for r in df.drop(*drop).collect()]


def test_verified_questions_are_native_requests(c360):
    rate = dict(dimensions=["SEGMENT_VALUE", "TOTAL_CUSTOMERS", "CHURNED_CUSTOMERS"],
                facts=["CHURN_RATE", "CHURN_CONTRIBUTION"], order=["CHURN_RATE DESC"])
    segments = marts.churn_segments(c360)
    for dimension, extra in (("Contract", {"where": {"DIMENSION_NAME": "Contract"}}),
                             ("Customer Value", {"filters": ["CHURN_SEGMENTS_BY_CUSTOMER_VALUE"]})):
        got = _rows(ask(c360, SEGMENTS, **rate, **extra))
        want = _rows(verified.dimension_churn(segments, dimension))
        assert sorted(got) == sorted(want) and [r[3] for r in got] == sorted(
            (r[3] for r in want), reverse=True)
        # the same request on a mart built beforehand
        assert _rows(metric_query(segments, SEGMENTS, **rate, **extra)) == got
    adopted = ask(c360, ADOPTION, dimensions=["product", "CUSTOMERS"],
                  facts=["CHURN_RATE", "AVG_MONTHLY_CHARGE", "AVG_CLTV", "AVG_TENURE_MONTHS"],
                  where={"adopted": "Yes"})
    assert _rows(adopted) == _rows(verified.adopted_products(marts.product_adoption(c360)))
    money = ask(c360, SEGMENTS, dimensions=["DIMENSION_NAME", "SEGMENT_VALUE", "TOTAL_CUSTOMERS",
                                            "CHURNED_CUSTOMERS"],
                facts=["CHURN_RATE", "CHURN_CONTRIBUTION", "CHURNED_MONTHLY_REVENUE"])
    assert sorted(_rows(money), key=str) == sorted(
        _rows(verified.segments_by_churned_charge(segments)), key=str)


def test_only_the_pinned_branch_is_built(c360):
    def plan(**where):
        df = ask(c360, SEGMENTS, dimensions=["DIMENSION_NAME", "SEGMENT_VALUE"],
                 facts=["CHURN_RATE"], **where)
        return df._jdf.queryExecution().optimizedPlan().toString()
    assert "Satisfaction" in plan() and "Satisfaction" not in plan(where={"DIMENSION_NAME": "Contract"})
    # an unknown value is an empty result, not an error
    assert ask(c360, SEGMENTS, dimensions=["SEGMENT_VALUE"], facts=["CHURN_RATE"],
               where={"DIMENSION_NAME": "Shoe Size"}).count() == 0


REFUSED = [
    # native rows that the selection does not identify
    (SEGMENTS, dict(dimensions=["SEGMENT_VALUE"], facts=["CHURN_RATE"])),
    (SEGMENTS, dict(facts=["CHURN_RATE"], where={"DIMENSION_NAME": "Contract"})),
    (SEGMENTS, dict(dimensions=["SEGMENT_VALUE"], facts=["CHURN_RATE"],
                    where={"DIMENSION_NAME": ["Contract", "Offer"]})),
    (ADOPTION, dict(dimensions=["PRODUCT_NAME"], facts=["CHURN_RATE"])),
    (CURVE, dict(dimensions=["SEGMENT_VALUE"], facts=["CHURN_RATE_AT_TENURE"],
                 filters=["CONTRACT_CHURN_BY_TENURE"])),
    (C360, dict(dimensions=["CONTRACT"], facts=["MONTHLY_CHARGE"])),
    (C360, dict(dimensions=["CONTRACT"])),
    # both kinds at once; nothing; twice
    (C360, dict(dimensions=["CUSTOMER_ID"], facts=["MONTHLY_CHARGE"], metrics=["CHURN_RATE"])),
    (C360, dict()),
    (C360, dict(metrics=["CHURN_RATE", "attrition rate"])),
    # sums of rates, over overlapping segments, over months a customer passes through
    (SEGMENTS, dict(dimensions=["DIMENSION_NAME"], sum_facts=["CHURN_RATE"])),
    (SEGMENTS, dict(dimensions=["SEGMENT_VALUE"], sum_facts=["CHURNED_MONTHLY_REVENUE"])),
    (CURVE, dict(sum_facts=["CHURNED_AT_TENURE"])),
    (CURVE, dict(dimensions=["DIMENSION_NAME"], sum_facts=["CUSTOMERS_REACHING_TENURE"])),
    (ADOPTION, dict(dimensions=["PRODUCT_NAME"], sum_facts=["AVG_CLTV"])),
    # order and limit
    (C360, dict(dimensions=["CONTRACT"], metrics=["CHURN_RATE"], order=["AVG_CLTV"])),
    (C360, dict(dimensions=["CONTRACT"], metrics=["CHURN_RATE"], limit=3)),
    (C360, dict(dimensions=["CONTRACT"], metrics=["CHURN_RATE"], position="place")),
    (C360, dict(dimensions=["CONTRACT"], metrics=["CHURN_RATE"], order=["CONTRACT"], limit=-1)),
    (C360, dict(dimensions=["CONTRACT"], metrics=["CHURN_RATE"], order=["CONTRACT"],
                position="contract")),
    (C360, dict(metrics=["CHURN_RATE"], where={"MONTHLY_CHARGE": 1})),
]


@pytest.mark.parametrize("table,request_", REFUSED)
def test_refused_before_any_job(spark, table, request_):
    with pytest.raises(MetricError):
        plan_request(semantic_model()[table], **request_)


def test_sums_over_held_dimensions(c360):
    curve = lifecycle.churn_by_tenure_segment(c360)
    got = metric_query(curve, CURVE, dimensions=["SEGMENT_VALUE"], sum_facts=["CHURNED_AT_TENURE"],
                       filters=["CONTRACT_CHURN_BY_TENURE"], order=["SEGMENT_VALUE"])
    want = {}
    for r in c360.collect():
        want[r.contract] = want.get(r.contract, 0) + r.churn_flag
    assert _rows(got) == sorted(want.items())


def test_order_is_total_and_nulls_are_placed(c360):
    def ids(*order, **more):
        return [r.customer_id for r in ask(c360, C360, dimensions=["CUSTOMER_ID", "CONTRACT"],
                                           facts=["TOTAL_REVENUE", "MONTHLY_CHARGE"],
                                           order=list(order), **more).collect()]
    assert ids("TOTAL_REVENUE DESC")[:2] == ["c23", "c22"] and ids("TOTAL_REVENUE DESC")[-1] == "c07"
    assert ids("total_revenue desc nulls first")[0] == "c07"
    assert ids("TOTAL_REVENUE")[-1] == "c07" and ids("TOTAL_REVENUE NULLS FIRST")[0] == "c07"
    tied = ids(Order("MONTHLY_CHARGE"), Order("CONTRACT", descending=True))
    key = {r.customer_id: (r.monthly_charge, -ord(r.contract), r.customer_id)
           for r in c360.collect()}
    assert tied == sorted(key, key=key.get)
    top = ask(c360, C360, dimensions=["CUSTOMER_ID"], facts=["TOTAL_REVENUE"],
              order=["TOTAL_REVENUE DESC"], limit=5, position="place")
    assert _rows(top)[0][::2] == ("c23", 1) and [r.place for r in top.collect()] == [1, 2, 3, 4, 5]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    every = ask(c360, C360, dimensions=["CUSTOMER_ID"], facts=["TOTAL_REVENUE"],
                order=["TOTAL_REVENUE DESC"], position="place")
    assert {r.customer_id: r.place for r in top.collect()}.items() <= {
        r.customer_id: r.place for r in every.collect()}.items()
    assert sorted(r.place for r in every.collect()) == list(range(1, 25))


def test_where_lists_and_null(c360):
    def n(**where):
        return ask(c360, C360, metrics=["TOTAL_CUSTOMERS"], where=where).collect()[0][0]
    assert n(CONTRACT=["M", "Y"]) == 16 and n(CONTRACT=[]) == 0
    assert n(OFFER=None) == 24 and n(CONTRACT=["M", None]) == 8 and n(tenure=0) == 4
