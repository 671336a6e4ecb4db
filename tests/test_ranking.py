"""The distributed NTILE equals Spark's single-partition NTILE row by row."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnlens.operators.ranking import ntile_by_boundaries, scalable_ntile


def _check(spark, rows, k=4, partitions=5):
    df = spark.createDataFrame(rows, "customer_id string, cltv long")
    order = [F.col("cltv").asc_nulls_last(), F.col("customer_id").asc_nulls_last()]
    ours = scalable_ntile(df, k, order, "q", partitions=partitions)
    ref = df.withColumn("q_ref", F.ntile(k).over(Window.orderBy(*order)))
    j = ours.join(ref, "customer_id")
    assert j.count() == len(rows)
    assert j.filter(F.col("q") != F.col("q_ref")).count() == 0
    return {r.customer_id: r.q for r in ours.collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 1501])
def test_matches_sql_ntile_with_ties_and_nulls(spark, n):
    rnd = random.Random(n)
    rows = [(f"c{i:05d}", None if rnd.random() < 0.05 else rnd.randint(0, 40)) for i in range(n)]
    _check(spark, rows)


def test_fixture_ties_broken_by_customer_id(spark):
    # 6 customers with CLTV 1,1,1,1,2,2 → buckets of 2,2,1,1 rows; ties by customer_id
    rows = [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 2), ("f", 2)]
    q = _check(spark, rows, partitions=3)
    assert q == {"a": 1, "b": 1, "c": 2, "d": 2, "e": 3, "f": 4}


def test_fewer_rows_than_buckets(spark):
    q = _check(spark, [("a", 5), ("b", 3)])
    assert q == {"b": 1, "a": 2}


def test_no_single_partition_exchange_over_the_rows(spark):
    """Spark's NTILE funnels all rows into one partition; ours only the P counts."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("customer_id"),
                                  (F.col("id") % 7).alias("cltv"))
    order = [F.col("cltv"), F.col("customer_id")]
    out = scalable_ntile(df, 4, order, "q", partitions=4)
    ours = out._jdf.queryExecution().executedPlan().treeString().splitlines()
    ref = df.withColumn("q", F.ntile(4).over(Window.orderBy(*order)))
    theirs = ref._jdf.queryExecution().executedPlan().treeString()
    assert "SinglePartition" in theirs

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    for i, line in enumerate(ours):
        if "SinglePartition" in line:
            above = [ln for ln in ours[:i] if "BroadcastExchange" in ln and depth(ln) < depth(line)]
            assert above, "a SinglePartition exchange outside the broadcast of the counts"
    assert out.count() == 1000


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 17, 1501])
def test_boundary_ntile_matches_sql_ntile_for_unique_keys(spark, n):
    rnd = random.Random(100 + n)
    rows = [(f"c{i:05d}", None if rnd.random() < 0.05 else rnd.randint(-5, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id string, cltv long")
    order = [F.col("cltv").asc_nulls_last(), F.col("customer_id").asc_nulls_last()]
    ours = ntile_by_boundaries(df, 4, ["cltv", "customer_id"], "q", partitions=3)
    ref = df.withColumn("q_ref", F.ntile(4).over(Window.orderBy(*order)))
    j = ours.join(ref, "customer_id")
    assert j.count() == n
    assert j.filter(F.col("q") != F.col("q_ref")).count() == 0
