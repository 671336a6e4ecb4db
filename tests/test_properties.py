"""Property tests: curve rewrite = cross join, NTILE bucket sizes, unpivot = union."""
from conftest import c360_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.operators.ranking import ntile_by_boundaries, scalable_ntile
from churnlens.plans import lifecycle, marts

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.booleans(),
                          st.sampled_from(["A", "B", None])), min_size=1, max_size=40)
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(ROWS)
def test_segment_curve_equals_cross_join(spark, rows):
    data = [{"customer_id": f"c{i}", "tenure_in_months": t, "churn_flag": int(ch), "contract": c}
            for i, (t, ch, c) in enumerate(rows)]
    got = {(r.segment_value, r.tenure_month): (r.customers_reaching_tenure, r.churned_at_tenure)
           for r in lifecycle.churn_by_tenure_segment(c360_rows(spark, data), only=["Contract"])
           .collect()}
    exp = {}
    for seg in {c for _, _, c in rows if c is not None}:
        months = {t for t, _, c in rows if c == seg and t is not None}
        for m in months:
            reach = sum(1 for t, _, c in rows if c == seg and t is not None and t >= m)
            ch = sum(1 for t, f, c in rows if c == seg and f and t == m)
            exp[(seg, m)] = (reach, ch)
    assert got == exp


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-3, 6)), min_size=0, max_size=60),
       st.integers(2, 6))
def test_ntile_bucket_sizes_differ_by_at_most_one(spark, cltvs, k):
    df = spark.createDataFrame([(f"c{i:03d}", v) for i, v in enumerate(cltvs)],
                               "customer_id string, cltv long")
    order = [F.col("cltv").asc_nulls_last(), F.col("customer_id").asc_nulls_last()]
    for out in (scalable_ntile(df, k, order, "q", partitions=3),
                ntile_by_boundaries(df, k, ["cltv", "customer_id"], "q", partitions=3)):
        sizes = {r.q: r.n for r in out.groupBy("q").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert sum(sizes.values()) == len(cltvs)
        if sizes:
            assert max(sizes.values()) - min(sizes.values()) <= 1
            assert sorted(sizes) == list(range(1, len(sizes) + 1))
            assert sorted(sizes.values(), reverse=True) == [sizes[q] for q in sorted(sizes)]


@SETTINGS
@given(ROWS)
def test_each_dimension_sums_to_the_portfolio(spark, rows):
    data = [{"customer_id": f"c{i}", "tenure_in_months": t, "churn_flag": int(ch), "contract": c,
             "cltv": i, "snapshot_quarter": "Q3"}
            for i, (t, ch, c) in enumerate(rows)]
    c360 = c360_rows(spark, data)
    total = sum(1 for _, ch, _ in rows if ch)
    seg = marts.churn_segments(c360).groupBy("dimension_name").agg(
        F.sum("churned_customers").alias("c"), F.sum("total_customers").alias("n")).collect()
    assert len(seg) == 8
    assert all(r.c == total and r.n == len(rows) for r in seg)
