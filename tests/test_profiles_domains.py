"""Field profiles, discovered domains, distributions, run history, triage conditions, quarters."""
import datetime
import random
from collections import Counter

import pytest
from conftest import c360_rows
from pyspark.sql import functions as F

from churnlens.operators.topk import top_values
from churnlens.plans import marts, metrics, quality, reconcile, verified
from churnlens.plans.core import mark_unique_ids
from churnlens.plans.triage import CONDITIONS, DEFAULT, RULES, triage
from churnlens.sources import questions, runs
from churnlens.sources.schema import SERVICES


def test_top_values_are_exact_in_any_number_of_buckets(spark):
    rng = random.Random(1)
    counts = {(k, f"v{i}"): rng.randint(1, 9) for k in "ab" for i in range(40)}
    rows = [(k, v, n) for (k, v), n in counts.items()] + [("a", None, 99)]
    df = spark.createDataFrame(rows, "f string, value string, n long")
    for buckets in (1, 3, 64):
        got = {(r.f, r.place): (r.value, r.n) for r in top_values(df, "f", 5, buckets).collect()}
        for k in "ab":
            want = sorted(((v, n) for (f, v), n in counts.items() if f == k),
                          key=lambda x: (-x[1], x[0]))[:5]
            assert [got[k, i] for i in range(1, 6)] == want


def test_profile_compares_by_type_and_scans_once(spark):
    df = spark.createDataFrame(
        [(2, 2.5, "b", None), (10, 10.25, "a", None), (10, None, "a", None), (None, -1.0, "c", None)],
        "Whole int, floating double, text string, nothing string")
    got = {r.field_name: tuple(r)[1:] for r in metrics.field_profile(df).collect()}
    assert got["Whole"] == (4, 1, 2, "2", "10", "10 | 2")
    assert got["floating"] == (4, 1, 3, "-1.000000", "10.250000", "-1.000000 | 10.250000 | 2.500000")
    assert got["text"] == (4, 0, 3, "a", "c", "a | b | c")
    assert got["nothing"] == (4, 4, 0, None, None, None)
    assert metrics.field_profile(df.limit(0)).count() == 0
    assert {r.field_name for r in metrics.field_profile(df, ["WHOLE"]).collect()} == {"WHOLE"}
    both = metrics.logical_profiles({"A": df, "B": df.select("text")})
    assert Counter(r.logical_table for r in both.collect()) == {"A": 4, "B": 1}


def _services(spark, rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in SERVICES.fields) for r in rows],
                                 SERVICES)


def test_a_dirty_value_shows(spark):
    rows = [{"contract": ["One Year", "Two Year"][i % 2], "offer": None} for i in range(300)]
    rows += [{"contract": "one yr"}, {"contract": "one yr"}, {"contract": "?"}, {"contract": None}]
    raw = {"churn_services": _services(spark, rows)}
    got = {r.column_name: r for r in quality.domain_discovery(raw).collect()}
    c = got["contract"]
    assert (c.rows_checked, c.null_values, c.out_of_domain, c.out_of_domain_values) == (304, 1, 3, 2)
    assert c.domain_values == "One Year | Two Year" and c.reported == "one yr (2) | ? (1)"
    assert got["offer"].null_values == 304 and got["offer"].domain_values == ""
    listed = quality.domain_discovery(raw, allowed={"contract": ["Two Year", "?"]})
    c = {r.column_name: r for r in listed.collect()}["contract"]
    assert c.out_of_domain == 152 and c.reported == "One Year (150) | one yr (2)"
    many = _services(spark, [{"offer": f"o{i:03}"} for i in range(250)])
    o = {r.column_name: r for r in quality.domain_discovery({"churn_services": many}).collect()}
    assert o["offer"].out_of_domain_values == 250 and o["offer"].reported.count("|") == 9


def test_distribution_has_no_window_over_all_values(spark):
    df = spark.createDataFrame([("x",)] * 3 + [(None,)], "v string")
    out = quality.distribution(df, ["v"])
    assert {r.v: r.pct_customers for r in out.collect()} == {"x": 75.0, None: 25.0}
    for plan in (out, marts.churn_reasons(c360_rows(spark, [{"customer_id": "a", "churn_flag": 1}]))):
        assert "Window" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_run_history(spark):
    answers = spark.createDataFrame(
        [("r1", 1, "a", 1.0), ("r1", 1, "b", 5.0), ("r2", 2, "a", 9.0), ("r2", 2, "b", 2.0),
         ("r3", 3, "a", None), ("r3", 3, "b", 2.05), ("r3", 3, "c", 0.0)],
        "run_id string, run_order int, question_id string, actual double")
    expected = spark.createDataFrame([("a", 1.0, 0.0), ("b", 2.0, 0.1)],
                                     "question_id string, expected double, tolerance double")
    judged = reconcile.judge_runs(answers, expected)
    assert {(r.run_id, r.question_id) for r in judged.collect() if r.passed} == {
        ("r1", "a"), ("r2", "b"), ("r3", "b")}
    got = {r.run_id: (r.questions, r.passed, r.regressions, r.fixes)
           for r in reconcile.run_regressions(judged).collect()}
    assert got == {"r1": (2, 1, 0, 0), "r2": (2, 1, 1, 1), "r3": (3, 1, 0, 0)}


def test_run_history_from_orders(spark):
    def day(y):
        return datetime.datetime(y, 6, 1)
    star = {
        "orders": spark.createDataFrame(
            [(1, 10.0, day(2000)), (1, 20.0, day(2001)), (2, 5.0, day(2000)), (1, 30.0, None)],
            "o_custkey long, o_totalprice double, o_orderdate timestamp"),
        "customer": spark.createDataFrame([(1, 0), (2, 1)], "c_custkey long, c_nationkey long"),
        "nation": spark.createDataFrame([(0, "N"), (1, "M")], "n_nationkey long, n_name string")}
    got = {(r.run_id, r.question_id): r.actual for r in runs.order_value_answers(star).collect()}
    assert got == {("until-2000", "N"): 10.0, ("until-2001", "N"): 15.0, ("until-2000", "M"): 5.0}
    assert {r.question_id: r.expected for r in runs.order_value_expected(star).collect()} == {
        "N": 20.0, "M": 5.0}


@pytest.mark.parametrize("text,category", [
    ("Which contract has the highest churn?", "unclear_measure"),
    ("Rank segments by attrition", "unclear_measure"),
    ("Which contract has the highest churn rate?", "supported"),
    ("Which contract has the most churned customers?", "supported"),
    ("Which offer brings the highest churn contribution?", "supported"),
    ("Show churn by contract", "supported"),                    # compares nothing
    ("What will the weather be?", "out_of_scope"),
    ("", "out_of_scope"), (None, "out_of_scope"),
    ("customerships in the agenda", "out_of_scope"),            # no whole word
    ("Average satisfaction by city?", "supported"),
    ("Which request id ranked churn highest?", "meta_question")])   # earlier rules win
def test_conditions(spark, text, category):
    df = spark.createDataFrame([(text,)], "text string")
    r = triage(df).first()
    assert r.category == category
    assert r.needs_sql == (category not in {c[0] for c in CONDITIONS} | {"meta_question"})


def test_derived_questions_reach_every_category(spark):
    customer = spark.createDataFrame([(i, i % 3, "BUILDING") for i in range(40)] + [(40, None, None)],
                                     "c_custkey long, c_nationkey long, c_mktsegment string")
    nation = spark.createDataFrame([(0, "PERU"), (1, "CHAD")], "n_nationkey long, n_name string")
    q = questions.question_rows(customer, nation)
    assert q.count() == 41 and q.filter(F.col("text").contains("$")).count() == 0
    assert {r.category for r in triage(q).select("category").distinct().collect()} == {
        *[r[0] for r in RULES], *[c[0] for c in CONDITIONS], DEFAULT[0]}


@pytest.mark.parametrize("unique", [True, False])
def test_two_quarters(spark, unique):
    rows = [{"customer_id": f"{q}{i}", "snapshot_quarter": q, "contract": "MY"[i % 2],
             "churn_flag": int(i < n), "monthly_charge": charge * (1 + i % 2), "total_revenue": 1,
             "cltv_quartile": 1 + i % 2, "customer_value_segment": "ab"[i % 2]}
            for q, n, charge in (("Q3", 2, 1), ("Q4", 7, 100), (None, 1, 5)) for i in range(10)]
    c = c360_rows(spark, rows)
    c = mark_unique_ids(c) if unique else c
    segments, kpis = marts.churn_segments(c, by_quarter=True), marts.executive_kpis(c)
    above = verified.above_average(segments, kpis).collect()
    # every quarter against its own benchmark: Y pays more; it churns more than average in Q4 only
    rates = {r.snapshot_quarter: (r.avg_monthly_charge, r.churn_rate) for r in kpis.collect()}
    assert rates["Q3"] == (1.5, 0.2) and rates["Q4"] == (150.0, 0.7)
    want = {(r.snapshot_quarter, r.dimension_name, r.segment_value) for r in segments.collect()
            if r.avg_monthly_charge > rates[r.snapshot_quarter][0]
            and r.churn_rate > rates[r.snapshot_quarter][1]}
    assert {(r.snapshot_quarter, r.dimension_name, r.segment_value) for r in above} == want
    assert all(r.benchmark_avg_monthly_charge == rates[r.snapshot_quarter][0] for r in above)
    model = metrics.semantic_model(unique)
    model["CUSTOMER_360_VIEW"].dimensions["SNAPSHOT_QUARTER"] = F.col("snapshot_quarter")
    totals = metrics.metric_query(c, "CUSTOMER_360_VIEW", ["CHURNED_CUSTOMERS", "TOTAL_MONTHLY_CHARGES"],
                                  ["SNAPSHOT_QUARTER"], where={"CHURN_FLAG": 1}, model=model) \
        .withColumnRenamed("total_monthly_charges", "total_monthly_charges_churned")
    value = marts.customer_value(c, by_quarter=True)
    assert {r.churn_contribution for r in value.collect() if r.snapshot_quarter == "Q3"} == {0.5}
    got = reconcile.cross_layer(kpis, segments, value, totals).collect()
    assert len(got) == 3 * 2 * (3 + 8) and all(r.agrees for r in got)
    assert {r.value for r in got if r.snapshot_quarter == "Q4" and r.metric == "churned_customers"} == {7.0}
    wrong = kpis.withColumn("churned_customers", F.col("churned_customers") + 1)
    off = reconcile.cross_layer(wrong, segments, value, totals)
    assert {r.layer for r in off.collect() if not r.agrees} == {"segments", "customer_value",
                                                               "metric_layer"}
