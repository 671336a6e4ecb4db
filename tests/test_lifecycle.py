"""Tenure curve (histogram + reverse running sum) equals the reference's cross join."""
import random

from conftest import c360_rows
from pyspark.sql import functions as F

from churnlens.plans import lifecycle


def _brute(rows):
    months = sorted({r["tenure_in_months"] for r in rows if r["tenure_in_months"] is not None})
    total_ch = sum(1 for r in rows if r["churn_flag"] == 1)
    out = {}
    for m in months:
        reach = sum(1 for r in rows if r["tenure_in_months"] is not None
                    and r["tenure_in_months"] >= m)
        ch = sum(1 for r in rows if r["churn_flag"] == 1 and r["tenure_in_months"] == m)
        out[m] = (reach, ch, total_ch)
    return out


def test_curve_matches_cross_join_with_nulls_and_gaps(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        t = None if rnd.random() < 0.05 else rnd.choice([0, 1, 2, 5, 9, 10, 30, 72])
        rows.append({"customer_id": f"c{i}", "tenure_in_months": t,
                     "churn_flag": 1 if rnd.random() < 0.3 else 0,
                     "monthly_charge": 10.5, "cltv": rnd.randint(1, 9)})
    got = lifecycle.churn_by_tenure(c360_rows(spark, rows)).collect()
    exp = _brute(rows)
    assert sorted(r.tenure_month for r in got) == sorted(exp)
    for r in got:
        reach, ch, total = exp[r.tenure_month]
        assert (r.customers_reaching_tenure, r.churned_at_tenure) == (reach, ch)
        assert r.churn_rate_at_tenure == round(ch / reach + 1e-12, 4)
        assert r.churn_contribution == round(ch / total + 1e-12, 4)


def test_avg_of_churned_is_null_when_none_churned(spark):
    rows = [{"customer_id": "a", "tenure_in_months": 3, "churn_flag": 0, "cltv": 5},
            {"customer_id": "b", "tenure_in_months": 4, "churn_flag": 1, "cltv": 7,
             "monthly_charge": 20.0}]
    got = {r.tenure_month: r for r in lifecycle.churn_by_tenure(c360_rows(spark, rows)).collect()}
    assert got[3].avg_cltv_churned is None and got[3].avg_monthly_charge_churned is None
    assert got[4].avg_cltv_churned == 7.0 and got[4].avg_monthly_charge_churned == 20.0


def test_rolling_mean_uses_rows_not_calendar_months(spark):
    # observed months 1, 2, 5: the window around 2 averages months 1, 2 and 5
    rows = []
    for m, n, c in [(1, 4, 1), (2, 4, 2), (5, 4, 4)]:
        for i in range(n):
            rows.append({"customer_id": f"m{m}_{i}", "tenure_in_months": m,
                         "churn_flag": 1 if i < c else 0})
    curve = lifecycle.churn_by_tenure(c360_rows(spark, rows))
    got = {r.tenure_month: r for r in lifecycle.churn_by_tenure_enhanced(curve).collect()}
    rates = {m: got[m].churn_rate_at_tenure for m in got}
    assert rates == {1: round(1 / 12, 4), 2: round(2 / 8, 4), 5: 1.0}
    assert got[2].rolling_3m_churn_rate == round((rates[1] + rates[2] + rates[5]) / 3, 4)
    assert got[1].rolling_3m_churn_rate == round((rates[1] + rates[2]) / 2 + 1e-12, 4)
    assert all(r.base_support_level == "Low Support" for r in got.values())


def test_segment_curve_drops_null_segments(spark):
    rows = [{"customer_id": "a", "tenure_in_months": 3, "churn_flag": 1, "contract": None,
             "total_service_count": 2},
            {"customer_id": "b", "tenure_in_months": 3, "churn_flag": 0, "contract": "X",
             "total_service_count": 9}]
    got = lifecycle.churn_by_tenure_segment(c360_rows(spark, rows)).filter(
        F.col("dimension_name") == "Contract").collect()
    assert [(r.segment_value, r.customers_reaching_tenure) for r in got] == [("X", 1)]
