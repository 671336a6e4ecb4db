"""Tenure curve: "reaching month m" and "churned at month m" without a cross join.

The reference writes ``observed months × customers`` as a CROSS JOIN and
counts ``tenure >= month`` per pair: O(months × customers) work. The same
numbers follow from a histogram of tenure (one partial-aggregated group-by)
and a reverse running sum over the histogram:

    reaching(m) = Σ_{t ≥ m} n(t)       churned_at(m) = c(m)

Only months that occur (non-NULL) are reported; rows with NULL tenure never
count as reaching but do count in the all-rows churn total.

The windows run on the histogram — at most a few hundred rows per segment —
so their single-partition or per-segment sorts stay small however many
customers there are, and a hot segment is one short histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tenure_histogram(df: DataFrame, tenure: str, flag: str, by: list[str] | None = None,
                     extra: list[Column] | None = None) -> DataFrame:
    """Rows and churned rows per (by..., tenure), NULL tenure kept as its own group."""
    by = by or []
    return df.groupBy(*by, F.col(tenure).alias("tenure_month")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col(flag) == 1).alias("churned_at_tenure"),
        *(extra or []),
    )


def reaching(hist: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Add ``customers_reaching_tenure``; drop the NULL-tenure group."""
    by = by or []
    w = (Window.partitionBy(*by).orderBy(F.col("tenure_month").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    observed = hist.filter(F.col("tenure_month").isNotNull())
    return observed.withColumn("customers_reaching_tenure", F.sum("_rows").over(w))


def rolling_rate(rate_col: str, by: list[str] | None = None) -> Column:
    """Centred 3-row mean of a 4-dp rate, rounded to 4 dp exactly.

    Rows, not calendar months: gaps between observed months are not bridged
    (the reference's ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING).
    """
    w = Window.partitionBy(*(by or [])).orderBy("tenure_month").rowsBetween(-1, 1)
    e4 = F.round(F.col(rate_col) * 10000).cast("bigint")
    s, n = F.sum(e4).over(w), F.count(e4).over(w)
    q = F.floor((s * 2 + n) / (n * 2))  # s, n small: exact in double
    return (q.cast("double") / F.lit(10000.0))


def support_level(col: str, high: int, medium: int) -> Column:
    c = F.col(col)
    return (F.when(c >= high, "High Support").when(c >= medium, "Medium Support")
            .otherwise("Low Support"))
