"""Unpivot named dimensions into (dimension_name, segment_value) rows.

The reference emulates grouping sets with a UNION ALL of one SELECT per
dimension over the same base; Spark would scan the base once per branch.
``DataFrame.unpivot`` produces one ``Expand`` over a single scan. A filter on
``dimension_name`` above an ``Expand`` is not pushed into it, so callers that
want a subset pass ``only=[...]`` and only those branches are built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def unpivot_dimensions(df: DataFrame, dims: dict[str, Column], keep: list[str], *,
                       only: list[str] | None = None, name_col: str = "dimension_name",
                       value_col: str = "segment_value") -> DataFrame:
    """One row per (input row, dimension) with the dimension's value as a string."""
    chosen = [(n, c) for n, c in dims.items() if only is None or n in only]
    if not chosen:
        raise ValueError(f"no dimension selected from {list(dims)}")
    projected = df.select(*keep, *[c.cast("string").alias(n) for n, c in chosen])
    return projected.unpivot(keep, [n for n, _ in chosen], name_col, value_col)
