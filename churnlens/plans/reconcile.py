"""Reconciliation and regression.

* ``reconcile``        actual vs expected values with a tolerance → PASS/FAIL (R1)
* ``result_match``     order-insensitive, bag-semantics comparison of two
                       result sets with a schema diff (R2)
* ``run_regressions``  accuracy per evaluation run and passed→failed counts
                       between consecutive runs (R3)
* ``cross_layer``      the same metric from the mart, segment, value and metric
                       layers; every dimension must sum to the portfolio (R4)

All comparisons are joins and ``exceptAll`` on DataFrames; nothing is
collected. The reports are one row per metric / per run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``actual(metric, actual)`` ⋈ ``expected(metric, expected, tolerance)``.

    A metric missing on either side is reported as MISSING (full outer join).
    """
    j = actual.join(expected, "metric", "full_outer")
    return j.select("metric", "actual", "expected", "tolerance",
                    _difference().alias("abs_difference"), _status().alias("status"))


def _difference():
    return F.abs(F.col("actual") - F.col("expected"))


def _status():
    return F.when(F.col("actual").isNull() | F.col("expected").isNull(), "MISSING") \
        .when(_difference() <= F.col("tolerance"), "PASS").otherwise("FAIL")


def result_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """R2: one row describing how two result sets differ.

    Columns are compared by name (order ignored); rows as multisets over the
    shared columns: both sides are grouped by all shared columns with their
    multiplicities, joined, and the surplus on each side is summed. This is a
    partial aggregation plus one join of distinct rows — unlike ``exceptAll``,
    which re-generates every surplus copy of a row inside one task.
    ``match`` is true only when both schemas and both bags are equal.
    """
    lc, rc = set(left.columns), set(right.columns)
    shared = sorted(lc & rc)
    missing = sorted(rc - lc)   # expected (right) columns absent from left
    extra = sorted(lc - rc)
    lg = left.groupBy(*shared).agg(F.count(F.lit(1)).alias("_l"))
    rg = right.groupBy(*shared).agg(F.count(F.lit(1)).alias("_r"))
    cond = [lg[c].eqNullSafe(rg[c]) for c in shared]
    j = lg.join(rg, cond, "full_outer") if shared else lg.crossJoin(rg)
    l_n, r_n = F.coalesce(F.col("_l"), F.lit(0)), F.coalesce(F.col("_r"), F.lit(0))
    r = j.agg(
        F.sum(l_n).alias("left_rows"), F.sum(r_n).alias("right_rows"),
        F.sum(F.greatest(r_n - l_n, F.lit(0))).alias("missing_rows"),
        F.sum(F.greatest(l_n - r_n, F.lit(0))).alias("extra_rows"))
    r = r.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                   for c in ["left_rows", "right_rows", "missing_rows", "extra_rows"]])
    return r.select(
        "left_rows", "right_rows", "missing_rows", "extra_rows",
        F.lit(", ".join(missing)).alias("missing_columns"),
        F.lit(", ".join(extra)).alias("extra_columns"),
        ((F.col("missing_rows") == 0) & (F.col("extra_rows") == 0)
         & F.lit(not missing and not extra)).alias("match"))


def judge_runs(answers: DataFrame, expected: DataFrame) -> DataFrame:
    """``answers(run_id, run_order, question_id, actual)`` against
    ``expected(question_id, expected, tolerance)`` by the rule of R1 →
    (run_id, run_order, question_id, passed). An answer that is NULL, or to a question without
    an expected value, has not passed. Expected values are one row per question, so no
    question's answers multiply."""
    j = answers.join(expected, "question_id", "left")
    return j.select("run_id", "run_order", "question_id", (_status() == "PASS").alias("passed"))


def run_regressions(results: DataFrame) -> DataFrame:
    """``results(run_id, run_order, question_id, passed)`` → one row per run.

    Accuracy = passed / questions; regressions = questions that passed in the
    previous run and fail in this one; fixes the other way round.
    """
    w = Window.partitionBy("question_id").orderBy("run_order")
    prev = results.withColumn("_prev", F.lag("passed").over(w))
    g = prev.groupBy("run_id", "run_order").agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(F.col("_prev") & ~F.col("passed")).alias("regressions"),
        F.count_if(~F.col("_prev") & F.col("passed")).alias("fixes"),
    )
    return g.select("run_id", "run_order", "questions", "passed",
                    F.expr("CAST((CAST(passed AS DECIMAL(38,0)) * 20000 + questions) DIV "
                           "(2 * questions) AS DOUBLE) / 10000").alias("accuracy"),
                    "regressions", "fixes")


def cross_layer(kpis: DataFrame, segments: DataFrame, value: DataFrame,
                metric_totals: DataFrame) -> DataFrame:
    """Churned customers and churned monthly charges from four layers, per quarter.

    All inputs have ``snapshot_quarter``. Returns (snapshot_quarter, layer, scope, metric, value,
    portfolio, agrees). Each of the eight segment dimensions covers every row of a
    quarter once, so its sum must equal that quarter's portfolio value; the
    value-segment mart and the metric layer must agree too. A quarter that the KPI mart
    lacks has no portfolio value and does not agree.
    """
    measures = ["churned_customers", "churned_monthly_revenue"]

    def summed(df: DataFrame, layer: str, scope) -> DataFrame:
        """A quarter's sums: counts, and money in exact cents."""
        return df.groupBy("snapshot_quarter", scope.alias("scope")).agg(
            F.sum("churned_customers").cast("double").alias("churned_customers"),
            (F.sum(F.round(F.col("churned_monthly_revenue") * 100).cast("bigint"))
             .cast("double") / 100).alias("churned_monthly_revenue")
        ).withColumn("layer", F.lit(layer))

    every = F.lit("All")
    layers = reduce(lambda a, b: a.unionByName(b), [
        summed(kpis, "executive_kpis", every),
        summed(segments, "segments", F.col("dimension_name")),
        summed(value, "customer_value", every),
        summed(metric_totals.withColumnRenamed("total_monthly_charges_churned",
                                               "churned_monthly_revenue"), "metric_layer", every)])
    long = layers.unpivot(["snapshot_quarter", "layer", "scope"], measures, "metric", "value")
    portfolio = kpis.select(F.col("snapshot_quarter").alias("_quarter"),
                            *[F.col(m).cast("double").alias(m) for m in measures]) \
        .unpivot("_quarter", measures, "_metric", "portfolio")
    j = long.join(portfolio, F.col("snapshot_quarter").eqNullSafe(F.col("_quarter"))
                  & (F.col("metric") == F.col("_metric")), "left")
    agrees = F.coalesce(F.abs(F.col("value") - F.col("portfolio")) < F.lit(0.005), F.lit(False))
    return j.select("snapshot_quarter", "layer", "scope", "metric", "value", "portfolio",
                    agrees.alias("agrees"))
