"""Tally the tuples of several dimensions first, unpivot the few tuples afterwards.

``unpivot`` before a group-by multiplies every input row by the number of dimensions. Additive
measures (counts, sums) need not: one group-by on the tuple of all dimensions combines in the
map tasks, and only its result — at most the product of the dimensions' values, however many
input rows there are — is unpivoted and summed again. Dimensions whose product would be large go
into different families; all families are grouping sets of the same scan, so a row is
expanded once per family instead of once per dimension.

Distinct counts are not additive; callers use this only for measures that are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tally_dimensions(df: DataFrame, families: list[dict[str, Column]], parts: list[Column],
                     by: list[str] | None = None, *, name_col: str = "dimension_name",
                     value_col: str = "segment_value") -> DataFrame:
    """(by..., name, value as a string, parts...) with one row per value of each dimension.

    ``parts`` are aliased aggregates whose sums over disjoint rows are their values over all of them
    (``count``, ``sum``, ``count_if``); NULL values form their own group.
    """
    by = by or []
    families = [f for f in families if f]
    columns = {n: f"_d{i}" for i, n in enumerate(n for f in families for n in f)}
    base = df.withColumns({columns[n]: c.cast("string") for f in families for n, c in f.items()})
    sets = [[*by, *[columns[n] for n in f]] for f in families]
    cols = [*by, *columns.values()]
    if len(families) == 1:
        tuples = base.groupBy(*cols).agg(*parts).withColumn("_set", F.lit(0).cast("long"))
        marks = [0]
    else:
        tuples = base.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]) \
            .agg(F.grouping_id().alias("_set"), *parts)
        # a bit per column, the first one highest; set where the column is not grouped
        marks = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets]
    pairs = None
    for mark, f in zip(marks, families, strict=True):
        array = F.array(*[F.struct(F.lit(n).alias("n"), F.col(columns[n]).alias("v")) for n in f])
        when = F.col("_set") == F.lit(mark).cast("long")
        pairs = F.when(when, array) if pairs is None else pairs.when(when, array)
    measures = [c for c in tuples.columns if c not in {*cols, "_set"}]
    long = tuples.select(*by, F.explode(pairs).alias("_p"), *measures)
    return long.groupBy(*by, F.col("_p.n").alias(name_col), F.col("_p.v").alias(value_col)) \
        .agg(*[F.sum(m).alias(m) for m in measures])
