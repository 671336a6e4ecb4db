"""Evaluation runs derived from the star tables: stand-in input of the run history.

The question of a nation is its average order value. A run is a cut-off: it answers from the
orders up to the end of one year, as a report of that time would have. The expected answer is that
of all orders, within a tolerance. Only sums and counts per nation and year leave the
orders; nothing here judges an answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE = 0.005        # of the expected value


def _per_year(star: dict[str, DataFrame]) -> DataFrame:
    orders = star["orders"].select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("run_order"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    per_customer = orders.groupBy("c_custkey", "run_order").agg(
        F.sum("cents").alias("s"), F.count("cents").alias("k"))
    where = star["customer"].select("c_custkey", F.col("c_nationkey").alias("n_nationkey")) \
        .join(star["nation"].select("n_nationkey", F.col("n_name").alias("question_id")),
              "n_nationkey")
    return per_customer.join(where, "c_custkey").groupBy("question_id", "run_order").agg(
        F.sum("s").alias("s"), F.sum("k").alias("k"))


def _average(s: str, k: str):
    return F.col(s).cast("double") / F.nullif(F.col(k) * 100, F.lit(0))


def order_value_answers(star: dict[str, DataFrame]) -> DataFrame:
    """(run_id, run_order, question_id, actual)."""
    so_far = Window.partitionBy("question_id").orderBy("run_order")
    years = _per_year(star).filter(F.col("run_order").isNotNull()).withColumns(
        {c: F.sum(c).over(so_far) for c in ("s", "k")})
    return years.select(F.concat(F.lit("until-"), F.col("run_order").cast("string")).alias("run_id"),
                        "run_order", "question_id", _average("s", "k").alias("actual"))


def order_value_expected(star: dict[str, DataFrame]) -> DataFrame:
    """(question_id, expected, tolerance)."""
    all_years = _per_year(star).groupBy("question_id").agg(F.sum("s").alias("s"), F.sum("k").alias("k"))
    return all_years.select("question_id", _average("s", "k").alias("expected")) \
        .withColumn("tolerance", F.col("expected") * F.lit(TOLERANCE))
