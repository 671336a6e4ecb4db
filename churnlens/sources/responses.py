"""Response-log documents derived from the ``conversations`` table.

The reference analyses JSON replies of an agent (an ordered ``content`` array
of text / tool_result / table / chart / suggested_queries items plus token
usage metadata). The driver's data has no such replies, so one document per
conversation turn is derived from the turn itself — row by row, bounded by
the size of that row, never by the size of a conversation:

* every turn: a text item with the turn's whole text;
* assistant turns: a ``system_execute_sql`` tool result, a table whose result
  set has one row per line of the text (line number, characters), a chart,
  a second (summary) text item — so "last text wins" is exercised — and
  suggested queries;
* system turns: a tool result of another tool name and NO usage metadata;
* user and assistant turns: usage metadata (model, input / cache / output tokens).

Each item is serialised with ``to_json`` and the content array is joined as
text, because the items have different shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SQL_TOOL = "system_execute_sql"


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols))


def response_documents(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, response) with ``response`` a JSON document string."""
    c = conversations
    is_asst = F.col("role") == "assistant"
    is_sys = F.col("role") == "system"
    lines = F.split(F.col("text"), "\n")
    turn_s = F.col("turn").cast("string")
    conv_s = F.col("conv_id").cast("string")

    text_item = _json(F.lit("text").alias("type"), F.col("text").alias("text"))
    sql_item = _json(
        F.lit("tool_result").alias("type"),
        F.struct(F.lit(SQL_TOOL).alias("name"), F.array(F.struct(F.struct(
            F.concat(F.lit("SELECT line, chars FROM turn_"), turn_s).alias("sql"),
            (F.col("turn") % 2 == 1).alias("verified_query_used"),
            F.concat(F.lit("q-"), conv_s, F.lit("-"), turn_s).alias("query_id"),
        ).alias("json"))).alias("content")).alias("tool_result"))
    table_item = _json(
        F.lit("table").alias("type"),
        F.struct(
            F.concat(F.lit("Lines of turn "), turn_s).alias("title"),
            F.struct(
                F.transform(lines, lambda x, i: F.array((i + 1).cast("string"),
                                                        F.length(x).cast("string")))
                .alias("data"),
                F.struct(F.array(F.struct(F.lit("LINE").alias("name")),
                                 F.struct(F.lit("CHARS").alias("name"))).alias("rowType"))
                .alias("resultSetMetaData"),
            ).alias("result_set"),
        ).alias("table"))
    chart_item = _json(F.lit("chart").alias("type"), F.struct(
        F.concat(F.lit('{"mark":"bar","n":'), F.size(lines).cast("string"), F.lit("}"))
        .alias("chart_spec")).alias("chart"))
    summary_item = _json(F.lit("text").alias("type"), F.concat(
        F.lit("Summary of "), F.size(lines).cast("string"), F.lit(" lines")).alias("text"))
    suggest_item = _json(F.lit("suggested_queries").alias("type"), F.array(F.struct(
        F.concat(F.lit("Show turn "), (F.col("turn") + 1).cast("string")).alias("query")))
        .alias("suggested_queries"))
    other_tool_item = _json(F.lit("tool_result").alias("type"), F.struct(
        F.lit("other_tool").alias("name"),
        F.array(F.struct(F.struct(F.lit("n/a").alias("sql")).alias("json"))).alias("content"))
        .alias("tool_result"))

    items = F.array(
        text_item,
        F.when(is_asst, sql_item), F.when(is_asst, table_item), F.when(is_asst, chart_item),
        F.when(is_asst, summary_item), F.when(is_asst, suggest_item),
        F.when(is_sys, other_tool_item),
    )
    content = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    n_lines = F.size(lines)
    usage = _json(F.struct(F.array(F.struct(
        F.concat(F.lit("model-"), F.col("role")).alias("model_name"),
        F.struct(F.length("text").cast("bigint").alias("total"),
                 n_lines.cast("bigint").alias("cache_read"),
                 F.lit(0).cast("bigint").alias("cache_write"),
                 (F.length("text") - n_lines).cast("bigint").alias("uncached"))
        .alias("input_tokens"),
        F.struct((F.col("turn") + 1).cast("bigint").alias("total")).alias("output_tokens"),
    )).alias("tokens_consumed")).alias("usage"))
    meta = F.when(is_sys, F.lit("")).otherwise(F.concat(F.lit(',"metadata":'), usage))
    doc = F.concat(F.lit('{"content":'), content, meta, F.lit("}"))
    return c.select("conv_id", "turn", "role", doc.alias("response"))
