"""Mart semantics on hand-made 360 rows (traps of SURVEY §2.13)."""
from conftest import c360_rows
from churnlens.plans import marts, verified


def _base(**kw):
    return {"snapshot_quarter": "Q3", "customer_status": "Stayed", "churn_flag": 0,
            "monthly_charge": 10.0, "total_revenue": 100.0, "cltv": 100,
            "tenure_in_months": 5, "satisfaction_score": 3, **kw}


def test_rows_in_numerator_distinct_ids_in_denominator(spark):
    # duplicate customer id: the rate numerator counts rows, the denominator ids
    rows = [_base(customer_id="a", churn_flag=1, contract="M"),
            _base(customer_id="a", churn_flag=1, contract="M"),
            _base(customer_id="b", churn_flag=0, contract="M")]
    k = marts.executive_kpis(c360_rows(spark, rows)).first()
    assert (k.total_customers, k.churned_customers, k.churn_rate) == (2, 2, 1.0)


def test_null_contract_is_its_own_group(spark):
    rows = [_base(customer_id="a", contract=None, churn_flag=1),
            _base(customer_id="b", contract="One Year")]
    seg = marts.churn_segments(c360_rows(spark, rows), only=["Contract"]).collect()
    assert sorted((r.segment_value or "", r.total_customers) for r in seg) == [
        ("", 1), ("One Year", 1)]


def test_offer_and_internet_coalesced(spark):
    rows = [_base(customer_id="a", offer=None, internet_type=None)]
    seg = {r.dimension_name: r.segment_value for r in
           marts.churn_segments(c360_rows(spark, rows), only=["Offer", "Internet Type"]).collect()}
    assert seg == {"Offer": "No Offer", "Internet Type": "No Internet"}


def test_no_churn_gives_null_contribution_and_empty_reasons(spark):
    rows = [_base(customer_id="a", contract="M"), _base(customer_id="b", contract="M")]
    c = c360_rows(spark, rows)
    seg = marts.churn_segments(c, only=["Contract"]).first()
    assert seg.churn_rate == 0.0 and seg.churn_contribution is None
    assert marts.churn_reasons(c).count() == 0
    assert marts.product_depth(c).first().churn_index is None


def test_adoption_gap_drops_products_with_one_side(spark):
    rows = [_base(customer_id="a", phone_service="Yes", online_backup="Yes"),
            _base(customer_id="b", phone_service="No", online_backup="Yes", churn_flag=1)]
    gap = verified.adoption_gap(marts.product_adoption(c360_rows(spark, rows))).collect()
    names = {r.product_name for r in gap}
    assert "Phone Service" in names and "Online Backup" not in names
    ph = [r for r in gap if r.product_name == "Phone Service"][0]
    assert (ph.adopted_churn_rate, ph.not_adopted_churn_rate, ph.churn_rate_gap) == (0.0, 1.0, -1.0)


def test_customer_share_includes_not_applicable(spark):
    rows = [_base(customer_id="a", streaming_tv="Yes"), _base(customer_id="b", streaming_tv=None)]
    pa = marts.product_adoption(c360_rows(spark, rows), only=["Streaming TV"]).collect()
    assert sorted((r.adoption_status, r.customer_share) for r in pa) == [
        ("Not Applicable", 0.5), ("Yes", 0.5)]


def test_peak_month_unique_and_tied(spark):
    rows = [_base(customer_id="a", contract="X", tenure_in_months=3, churn_flag=1),
            _base(customer_id="b", contract="X", tenure_in_months=3, churn_flag=0),
            _base(customer_id="c", contract="X", tenure_in_months=7, churn_flag=1),
            _base(customer_id="d", contract="X", tenure_in_months=8, churn_flag=0)]
    # month 3: 1 churned / 4 reaching = 0.25; month 7: 1 / 2 = 0.5; month 8: 0 / 1
    peak = verified.peak_tenure(verified.contract_curves(c360_rows(spark, rows))).first()
    assert (peak.contract_type, peak.tenure_month, peak.churn_rate_at_tenure) == ("X", 7, 0.5)
    tie = [_base(customer_id="s", contract="T", tenure_in_months=4, churn_flag=1),
           _base(customer_id="t", contract="T", tenure_in_months=4, churn_flag=1),
           _base(customer_id="u", contract="T", tenure_in_months=9, churn_flag=1),
           _base(customer_id="v", contract="T", tenure_in_months=9, churn_flag=0)]
    # month 4: 2 / 4 = 0.5; month 9: 1 / 2 = 0.5 → tie; the smaller month wins
    peak = verified.peak_tenure(verified.contract_curves(c360_rows(spark, tie))).first()
    assert (peak.tenure_month, peak.churn_rate_at_tenure) == (4, 0.5)
