"""Bulk analysis of response logs (J1-J8), one row per document or item.

The reference parses one live reply and CROSS JOINs six one-row CTEs, so a
reply without, say, a chart loses its whole row. ``wide`` keeps every response
(row-wise "last item of a type" over the content array); ``require_all=True``
restores the reference's behaviour. Only J2/J4/J8, whose output is per item
or per item type, explode an array; none groups or shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.documents import (flatten, get, items_array, last_of_type,
                                            last_per_type, safe_parse)
from churnlens.sources.responses import SQL_TOOL

KEYS = ["conv_id", "turn"]
USAGE = "$.metadata.usage.tokens_consumed[0]"


def parsed(docs: DataFrame) -> DataFrame:
    return docs.select(*KEYS, "role", safe_parse("response").alias("v"))


def safe_parse_report(events: DataFrame, conversations: DataFrame) -> DataFrame:
    """Validity of JSON columns in the given tables and a typed value from them."""
    ev = events.select(F.lit("events").alias("source"), F.col("event_id").alias("record_id"),
                       F.lit(None).cast("bigint").alias("sub_id"), safe_parse("props").alias("v"))
    cv = conversations.select(F.lit("conversations").alias("source"),
                              F.col("conv_id").alias("record_id"), F.col("turn").alias("sub_id"),
                              safe_parse("text").alias("v"))
    both = ev.unionByName(cv)
    return both.select("source", "record_id", "sub_id", F.col("v").isNotNull().alias("is_valid"),
                       get("v", "$.k", "bigint").alias("k"))


def items(docs: DataFrame) -> DataFrame:
    """(conv_id, turn, item_index, item_type) for every content item."""
    return flatten(parsed(docs), KEYS, "v", "$.content").select(
        *KEYS, F.col("pos").alias("item_index"), "item_type")


def paths(docs: DataFrame) -> DataFrame:
    """Typed path extraction — string, boolean, number, nested array index."""
    p = parsed(docs)
    return p.select(
        *KEYS,
        get("v", "$.content[0].type", "string").alias("first_item_type"),
        get("v", "$.content[1].tool_result.content[0].json.verified_query_used", "boolean")
        .alias("verified_query_used"),
        get("v", f"{USAGE}.input_tokens.total", "bigint").alias("input_tokens"),
        get("v", "$.content[2].table.result_set.data[0][1]", "string").alias("first_row_chars"),
        get("v", "$.content[2].table.result_set.resultSetMetaData.rowType[1].name", "string")
        .alias("second_column_name"),
    )


def last_items(docs: DataFrame) -> DataFrame:
    """Per response and item type, the count, index and value of the last item."""
    return last_per_type(parsed(docs), KEYS, "v")


def sql_details(docs: DataFrame) -> DataFrame:
    """The last executed-SQL tool result of each response (row-wise, no shuffle)."""
    p = parsed(docs).withColumn("_sql", _last_sql(items_array("v")))
    base = "$.tool_result.content[0].json"
    return p.filter(F.col("_sql").isNotNull()).select(
        *KEYS,
        get("_sql", f"{base}.sql", "string").alias("generated_sql"),
        get("_sql", f"{base}.verified_query_used", "boolean").alias("verified_query_used"),
        get("_sql", f"{base}.query_id", "string").alias("query_id"))


def _last_sql(arr):
    return last_of_type(arr, "tool_result",
                        extra=lambda x: get(x, "$.tool_result.name", "string") == SQL_TOOL)


def usage(docs: DataFrame) -> DataFrame:
    """Token usage; missing model → 'N/A', missing counts → 0 (as the app shows them)."""
    p = parsed(docs)

    def n(path):
        return F.coalesce(get("v", f"{USAGE}.{path}", "bigint"), F.lit(0).cast("bigint"))

    return p.select(
        *KEYS,
        F.coalesce(get("v", f"{USAGE}.model_name", "string"), F.lit("N/A")).alias("model_name"),
        n("input_tokens.total").alias("input_tokens"),
        n("input_tokens.cache_read").alias("cache_read_tokens"),
        n("input_tokens.cache_write").alias("cache_write_tokens"),
        n("input_tokens.uncached").alias("uncached_input_tokens"),
        n("output_tokens.total").alias("output_tokens"),
    )


ROW_TYPE = "$.table.result_set.resultSetMetaData.rowType"


def _columns(row_type, name: str):
    """Column names of a result set as a JSON array."""
    return F.to_json(F.transform(row_type, lambda x: get(x, "$.name", "string"))).alias(name)


def wide(docs: DataFrame, require_all: bool = False) -> DataFrame:
    """One row per response with the last artifact of each kind and the usage.

    Row-wise over the content array (higher-order ``filter`` + last element),
    so it is a projection: no explode, no group-by, no shuffle, no state when
    run on a stream. A response lacking an artifact keeps its row with NULLs;
    ``require_all=True`` drops it as the reference's CROSS JOIN of one-row
    CTEs does.
    """
    arr = items_array("v")
    sqlj = "$.tool_result.content[0].json"
    p = parsed(docs).select(*KEYS, "v", _last_sql(arr).alias("_sql"))
    out = p.select(
        *KEYS,
        get(last_of_type(arr, "text"), "$.text", "string").alias("final_answer"),
        get(last_of_type(arr, "table"), "$.table.title", "string").alias("table_title"),
        _columns(get(last_of_type(arr, "table"), ROW_TYPE, "array<variant>"), "table_columns"),
        F.to_json(get(last_of_type(arr, "table"), "$.table.result_set.data", "variant"))
        .alias("table_content"),
        get(last_of_type(arr, "chart"), "$.chart.chart_spec", "string").alias("chart_spec"),
        F.to_json(F.transform(
            get(last_of_type(arr, "suggested_queries"), "$.suggested_queries", "array<variant>"),
            lambda x: get(x, "$.query", "string"))).alias("suggested_queries"),
        get("_sql", f"{sqlj}.sql", "string").alias("generated_sql"),
        get("_sql", f"{sqlj}.verified_query_used", "boolean").alias("verified_query_used"),
        get("_sql", f"{sqlj}.query_id", "string").alias("query_id"),
        get("v", f"{USAGE}.model_name", "string").alias("model_name"),
        get("v", f"{USAGE}.input_tokens.total", "bigint").alias("input_tokens"),
        get("v", f"{USAGE}.input_tokens.cache_read", "bigint").alias("cache_read_tokens"),
        get("v", f"{USAGE}.input_tokens.cache_write", "bigint").alias("cache_write_tokens"),
        get("v", f"{USAGE}.input_tokens.uncached", "bigint").alias("uncached_input_tokens"),
        get("v", f"{USAGE}.output_tokens.total", "bigint").alias("output_tokens"),
    )
    if require_all:
        needed = ["final_answer", "table_title", "chart_spec", "suggested_queries",
                  "generated_sql", "model_name"]
        cond = None
        for c in needed:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        out = out.filter(cond)
    return out


def result_rows(docs: DataFrame) -> DataFrame:
    """Every cell of every table item's result set, whatever its shape, as text with
    the column's name from the metadata (NULL where it names none)."""
    it = flatten(parsed(docs), KEYS, "v", "$.content").filter(F.col("item_type") == "table")
    names = F.transform(get("item", ROW_TYPE, "array<variant>"),
                        lambda x: get(x, "$.name", "string"))
    rows = it.select(*KEYS, F.col("pos").alias("item_index"), names.alias("names"),
                     F.posexplode(get("item", "$.table.result_set.data", "array<variant>"))
                     .alias("row_index", "row"))
    cells = rows.select(*KEYS, "item_index", "names", F.col("row_index").cast("bigint")
                        .alias("row_index"),
                        F.posexplode(get("row", "$", "array<variant>"))
                        .alias("column_index", "cell"))
    return cells.select(*KEYS, "item_index", "row_index",
                        F.col("column_index").cast("bigint").alias("column_index"),
                        F.get("names", "column_index").alias("column_name"),
                        get("cell", "$", "string").alias("value"))
