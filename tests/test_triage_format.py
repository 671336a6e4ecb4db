"""Question triage on the evaluation questions; business formatting."""
from churnlens.functions.fmt import business_format
from churnlens.plans.triage import triage, triage_summary

# The evaluation questions and the category their rule assigns.
QUESTIONS = [
    ("What is the overall churn rate and how many customers churned?", "supported"),
    ("Which contract type has the highest churn rate and what share of total churn does it "
     "contribute?", "supported"),
    ("How does churn rate, number of churned customers, and churn contribution differ across "
     "customer value segments?", "supported"),
    ("Among customers who adopted each product, which products are associated with the highest "
     "customer churn rates?", "supported"),
    ("At which observed tenure month is churn highest for each contract type, and how many "
     "customers reached those tenure months?", "lifecycle_small_sample"),
    ("For each product, compare the customer churn rate between customers who adopted the "
     "product and customers who did not. Calculate the churn rate gap as adopted churn rate "
     "minus non-adopted churn rate, and rank products from the most negative to the most "
     "positive gap.", "supported"),
    ("What is our biggest churn problem?", "ambiguous_measure"),
    ("What revenue is at risk from churn?", "forward_revenue_risk"),
    ("Show me the cohort retention curve.", "cohort_retention"),
    ("What was the churn rate last year?", "historical_period"),
    ("Which customers are most likely to churn?", "churn_prediction"),
    ("Does Online Security reduce churn?", "causal"),
    ("How is CLTV calculated?", "cltv_methodology"),
    ("Which products are customers canceling the most?", "product_cancellation"),
    # the documented ad hoc questions, all answerable
    ("Among customers with different payment methods, which groups have the highest observed "
     "churn rate and how do they compare in customer count, average monthly charge, and average "
     "CLTV?", "supported"),
    ("How does observed churn vary by payment method and contract type? Identify the "
     "combinations with the highest churn rate and include the customer population supporting "
     "each result.", "supported"),
    ("Which customer segments combine above-average monthly charges with above-average observed "
     "churn, and how large is each customer segment?", "supported"),
]


def test_evaluation_questions(spark):
    df = spark.createDataFrame([(q,) for q, _ in QUESTIONS], "text string")
    got = [(r.category, r.needs_sql) for r in triage(df).collect()]
    assert [c for c, _ in got] == [c for _, c in QUESTIONS]
    no_sql = {c for c, s in got if not s}
    assert "ambiguous_measure" in no_sql and "supported" not in no_sql and "causal" not in no_sql


def test_business_format(spark):
    df = spark.createDataFrame(
        [("Month-to-Month", 3610, 0.4584, 65.59, 4109.7, -0.0123, "n/a")],
        "segment_value string, total_customers long, churn_rate double, "
        "avg_monthly_charge double, avg_cltv double, churn_rate_gap double, other string")
    r = business_format(df).first().asDict()
    assert r == {"Segment": "Month-to-Month", "Total Customers": "3,610", "Churn Rate": "45.84%",
                 "Average Monthly Charge": "$65.59", "Average CLTV": "4,109.70",
                 "Churn Rate Gap": "-1.23%", "other": "n/a"}
    bad = spark.createDataFrame([("abc",)], "churn_rate string")
    assert business_format(bad).first()[0] == ""


def test_triage_deals_the_texts_out(spark):
    """A table in one split is judged by as many tasks as a shuffle has."""
    import contextlib
    import io

    one = spark.createDataFrame([("Why did customers churn in Peru?",)] * 50, "text string").coalesce(1)
    with contextlib.redirect_stdout(io.StringIO()) as said:
        triage_summary(one).explain()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f"RoundRobinPartitioning({n})" in said.getvalue()
    assert [(r["category"], r["questions"]) for r in triage_summary(one).collect()] == [
        ("reported_reasons", 50)]


def test_triage_query_builds_no_layers(spark, monkeypatch):
    """It reads three given tables; the customer layers are not built for it."""
    from churnlens import catalog

    monkeypatch.setattr(catalog, "layers_for", lambda *_: 1 / 0)
    got = catalog.REGISTRY["question_triage"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["questions"] for r in got) > 0
