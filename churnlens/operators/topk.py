"""The most frequent values per key, without sorting all values of a key in one task.

The top k is exact: first the top k inside (key, hash(value) mod B) — each bucket a window
partition of its own — then the top k of those at most k x B candidates per key. A key
with a billion distinct values is never sorted in one task. Ties go to the smaller value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_BUCKETS = 64


def top_values(counted: DataFrame, key: str, k: int, buckets: int | None = None) -> DataFrame:
    """``counted(key, value, n)``, one row per key and value → (key, value, n, place), the k values
    of highest ``n`` per key; NULL values have no place.

    The number of buckets follows the session's shuffle partitions, so it grows with
    the cluster."""
    if buckets is None:
        buckets = max(MIN_BUCKETS, int(counted.sparkSession.conf.get(
            "spark.sql.shuffle.partitions", str(MIN_BUCKETS))))
    order = [F.col("n").desc(), F.col("value").asc()]
    values = counted.select(key, "value", "n").filter(F.col("value").isNotNull()) \
        .withColumn("_bucket", F.pmod(F.hash("value"), F.lit(buckets)))
    for keys in ([key, "_bucket"], [key]):
        values = values.withColumn("place", F.row_number().over(
            Window.partitionBy(*keys).orderBy(*order))).filter(F.col("place") <= k)
    return values.drop("_bucket")
