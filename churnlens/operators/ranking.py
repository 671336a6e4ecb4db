"""Global ranking without a single-partition window.

``F.ntile(k).over(Window.orderBy(...))`` has no partition key, so Spark moves
every row into ONE task (``Exchange SinglePartition``). At a billion customers
that task is the whole job. Here the global 0-based rank is computed in a
distributed way:

1. range-partition on the order key into P partitions and sort inside each,
   tag every row with ``monotonically_increasing_id`` (partition index in the
   high bits, position in the partition in the low 33 bits);
2. cut lineage by writing the tagged rows once to the checkpoint folder
   (``session.materialize``) so the counts of step 3 and the ranks of step 4
   see the same partitions even if an executor is lost (range bounds come from
   sampling and would differ on a recomputation). A written table is computed
   once, whereas an eager ``checkpoint()`` of an unpersisted plan computes it
   twice (once to count, once to write);
3. count rows per partition — P rows — and turn them into start offsets with a
   window over those P rows;
4. broadcast the P offsets (bounded by the partition count) and add them to
   the position inside the partition.

NTILE(k) then follows from the rank r and the total N exactly like the SQL
function: the first N mod k buckets hold one extra row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import uuid

from churnlens.session import materialize

_LOW_BITS = 33
_MASK = (1 << _LOW_BITS) - 1


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "_rank",
                total_col: str = "_total", partitions: int | None = None) -> DataFrame:
    """Add the 0-based global position under ``order`` and the row total.

    The tagged rows are always written (step 2): counting and ranking must read
    the same partitions, which an unmaterialised range partitioning does not
    guarantee.
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(p, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, f"rank-{uuid.uuid4().hex[:12]}")
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", _LOW_BITS))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias(total_col),
    )
    ranked = tagged.join(F.broadcast(offsets), "_pid")
    return ranked.select(
        *[c for c in df.columns],
        (F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_MASK))).alias(rank_col),
        F.col(total_col),
    )


def ntile_from_rank(k: int, rank_col: str = "_rank", total_col: str = "_total") -> Column:
    """NTILE(k) of a row with 0-based rank r among N rows (SQL semantics)."""
    r, n = rank_col, total_col
    q = f"({n} DIV {k})"
    m = f"({n} % {k})"
    big = f"({m} * ({q} + 1))"
    return F.expr(
        f"CAST(CASE WHEN {r} < {big} THEN {r} DIV ({q} + 1) + 1 "
        f"ELSE {m} + ({r} - {big}) DIV NULLIF({q}, 0) + 1 END AS INT)")


def scalable_ntile(df: DataFrame, k: int, order: list[Column], out_col: str,
                   partitions: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (ORDER BY order)`` without funnelling rows into one task."""
    ranked = global_rank(df, order, partitions=partitions)
    return ranked.withColumn(out_col, ntile_from_rank(k)).drop("_rank", "_total")


def _order_key(cols: list[str]) -> Column:
    """A struct that sorts like ``cols`` ascending with NULLs last, with no NULL fields."""
    parts = []
    for c in cols:
        parts.append(F.col(c).isNull())
        parts.append(F.coalesce(F.col(c), F.lit(0) if c != "customer_id" else F.lit("")))
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def ntile_by_boundaries(df: DataFrame, k: int, key_cols: list[str], out_col: str,
                        partitions: int | None = None) -> DataFrame:
    """NTILE(k) ordered by ``key_cols`` (ascending, NULLs last) when the key is unique.

    Only the narrow key is range-partitioned and ranked (``global_rank``); the
    rows at the k-1 bucket starts (rank (b-1)·q + min(b-1, m)) become ONE row of
    boundary keys, broadcast to the full rows — a size-proven broadcast of k-1
    keys. A row's bucket is 1 + the number of boundaries not after it. The wide
    rows are never shuffled. With a non-unique key two equal rows may sit on a
    bucket start, so callers use this only after verifying uniqueness and fall
    back to ``scalable_ntile`` otherwise.
    """
    keyed = df.withColumn("_key", _order_key(key_cols))
    narrow = keyed.select("_key")
    ranked = global_rank(narrow, [F.col("_key")], partitions=partitions)
    q = F.expr(f"_total DIV {k}")
    m = F.expr(f"_total % {k}")
    starts = {b: (F.lit(b - 1) * q + F.least(F.lit(b - 1), m)) for b in range(2, k + 1)}
    is_start = None
    for s in starts.values():
        cond = F.col("_rank") == s
        is_start = cond if is_start is None else is_start | cond
    bounds = ranked.filter(is_start).agg(
        *[F.max(F.when(F.col("_rank") == s, F.col("_key"))).alias(f"_b{b}")
          for b, s in starts.items()])
    # one row: cut its lineage so later queries do not re-run the ranking stages
    bounds = materialize(bounds, f"bounds-{uuid.uuid4().hex[:12]}")
    j = keyed.crossJoin(F.broadcast(bounds))
    bucket = F.lit(1)
    for b in starts:
        bucket = bucket + F.when(F.col("_key") >= F.col(f"_b{b}"), 1).otherwise(0)
    return j.withColumn(out_col, bucket.cast("int")).drop("_key", *[f"_b{b}" for b in starts])
