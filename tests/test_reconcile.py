"""Result-set comparison (FIXTURES §6) and run regressions."""
from churnlens.plans.reconcile import reconcile, result_match, run_regressions


def _m(spark, a, b):
    return result_match(a, b).first()


def test_result_match_cases(spark):
    base = spark.createDataFrame([("x", 1, 0.25), ("y", 2, 0.5)], "seg string, n long, r double")
    assert _m(spark, base, base).match
    reordered = spark.createDataFrame([(0.5, 2, "y"), (0.25, 1, "x")], "r double, n long, seg string")
    assert _m(spark, base, reordered).match
    extra_col = base.withColumnRenamed("r", "r").selectExpr("*", "1 AS extra")
    m = _m(spark, extra_col, base)
    assert not m.match and m.extra_columns == "extra"
    renamed = base.withColumnRenamed("n", "customers")
    m = _m(spark, renamed, base)
    assert not m.match and m.missing_columns == "n" and m.extra_columns == "customers"
    missing = base.filter("seg = 'x'")
    m = _m(spark, missing, base)
    assert (m.missing_rows, m.extra_rows, m.match) == (1, 0, False)
    dup = base.unionByName(base.filter("seg = 'x'"))
    m = _m(spark, dup, base)
    assert (m.missing_rows, m.extra_rows, m.match) == (0, 1, False)
    digit = spark.createDataFrame([("x", 1, 0.2501), ("y", 2, 0.5)], "seg string, n long, r double")
    assert not _m(spark, digit, base).match
    empty = base.limit(0)
    assert _m(spark, empty, empty).match


def test_run_regressions_on_published_history(spark):
    # published evaluation history: 4/8, then 7/8 with one regression, then 8/8
    v1 = [True, True, False, False, True, False, True, False]
    v11 = [True, True, True, True, True, True, False, True]
    v12 = [True] * 8
    rows = [(run, order, f"Q{i + 1}", p) for run, order, res in
            [("v1", 1, v1), ("v1.1", 2, v11), ("v1.2", 3, v12)] for i, p in enumerate(res)]
    df = spark.createDataFrame(rows, "run_id string, run_order int, question_id string, passed boolean")
    got = {r.run_id: r for r in run_regressions(df).collect()}
    assert (got["v1"].passed, got["v1"].accuracy) == (4, 0.5)
    assert (got["v1.1"].passed, got["v1.1"].accuracy, got["v1.1"].regressions) == (7, 0.875, 1)
    assert (got["v1.2"].passed, got["v1.2"].accuracy, got["v1.2"].regressions) == (8, 1.0, 0)


def test_reconcile_reference_anchors(spark):
    actual = spark.createDataFrame([("churn_rate", 0.2654), ("total_customers", 7043.0),
                                    ("mtm_rate", 0.4584)], "metric string, actual double")
    expected = spark.createDataFrame([("churn_rate", 0.2654, 0.00005),
                                      ("total_customers", 7043.0, 0.0),
                                      ("stayed", 4720.0, 0.0)],
                                     "metric string, expected double, tolerance double")
    got = {r.metric: r.status for r in reconcile(actual, expected).collect()}
    assert got == {"churn_rate": "PASS", "total_customers": "PASS", "mtm_rate": "MISSING",
                   "stayed": "MISSING"}
