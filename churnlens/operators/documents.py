"""Semi-structured document operators on Spark's VARIANT type.

* ``safe_parse``     bad JSON → NULL instead of a failed job (``try_parse_json``)
* ``flatten``        an array inside each document → one row per item with its
                     0-based index and type (``posexplode_outer`` over
                     ``array<variant>``; documents without the array keep a row)
* ``get``            typed path extraction (string, boolean, number, array index)
* ``last_per_type``  count, index and value of the last item of each type per
                     document, computed inside the row (no group-by)
* ``last_of_type``   the last item of a type inside the row (higher-order
                     ``filter`` + last element) — a projection, no shuffle

All work is per document; a document is one row, so nothing depends on how
many documents there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_parse(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c)


def get(v: str | Column, path: str, dtype: str = "string") -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.try_variant_get(c, path, dtype)


def flatten(df: DataFrame, keys: list[str], vcol: str, path: str,
            keep: list[str] | None = None) -> DataFrame:
    """(keys..., keep..., pos, item, item_type) — one row per array element."""
    arr = get(vcol, path, "array<variant>")
    out = df.select(*keys, *(keep or []), F.posexplode_outer(arr).alias("pos", "item"))
    return out.withColumns({"pos": F.col("pos").cast("bigint"),
                            "item_type": get("item", "$.type", "string")})


def item_value(item: str | Column = "item") -> Column:
    """The headline value of an item of any known type (text, title, spec, tool, query)."""
    return F.coalesce(get(item, "$.text"), get(item, "$.table.title"),
                      get(item, "$.chart.chart_spec"), get(item, "$.tool_result.name"),
                      get(item, "$.suggested_queries[0].query"))


def last_per_type(df: DataFrame, keys: list[str], vcol: str, path: str = "$.content") -> DataFrame:
    """Per document and item type: number of items, index and value of the last one.

    Computed inside each row with higher-order functions — the distinct types
    of the document's array, then per type the count, the last index and the
    last item's value — and only that per-type summary is exploded. No
    group-by, no shuffle: the work is bounded by one document.
    """
    arr = items_array(vcol, path)
    typed = F.transform(arr, lambda x, i: F.struct(i.cast("bigint").alias("i"),
                                                   get(x, "$.type").alias("t"),
                                                   item_value(x).alias("v")))
    types = F.array_distinct(F.filter(F.transform(typed, lambda e: e["t"]),
                                      lambda t: t.isNotNull()))

    def summary(t):
        of_type = F.filter(typed, lambda e: e["t"] == t)
        last = F.try_element_at(of_type, F.lit(-1))
        return F.struct(t.alias("item_type"), F.size(of_type).cast("bigint").alias("items"),
                        last["i"].alias("last_index"), last["v"].alias("last_value"))

    per = df.select(*keys, F.explode(F.transform(types, summary)).alias("_p"))
    return per.select(*keys, "_p.*")


def items_array(v: str | Column, path: str = "$.content") -> Column:
    return get(v, path, "array<variant>")


def last_of_type(arr: Column, item_type: str, extra=None) -> Column:
    """Row-wise: the last element of ``arr`` whose ``$.type`` is ``item_type``.

    A higher-order ``filter`` plus ``try_element_at(-1)`` inside the row — no
    explode, no grouping, no shuffle; works unchanged on a stream.
    """
    def keep(x):
        cond = get(x, "$.type", "string") == item_type
        return cond if extra is None else cond & extra(x)
    return F.try_element_at(F.filter(arr, keep), F.lit(-1))
