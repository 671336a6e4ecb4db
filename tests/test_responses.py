"""Response-log analysis on the fixture documents of FIXTURES §4."""
import json

from churnlens.plans import responses

COMPLETE = {
    "content": [
        {"type": "text", "text": "first"},
        {"type": "tool_result", "tool_result": {"name": "system_execute_sql", "content": [
            {"json": {"sql": "SELECT 1", "verified_query_used": True, "query_id": "q1"}}]}},
        {"type": "table", "table": {"title": "T", "result_set": {
            "data": [["1", "0.4584", "Month-to-Month"], ["2", None, "Two Year"]],
            "resultSetMetaData": {"rowType": [{"name": "N"}, {"name": "RATE"}]}}}},
        {"type": "chart", "chart": {"chart_spec": "{}"}},
        {"type": "text", "text": "last"},
        {"type": "suggested_queries", "suggested_queries": [{"query": "next?"}, {"query": "and \"then\"?"}]},
    ],
    "metadata": {"usage": {"tokens_consumed": [{"model_name": "m", "input_tokens": {
        "total": 10, "cache_read": 1, "cache_write": 2, "uncached": 7},
        "output_tokens": {"total": 3}}]}},
}
NO_CHART = {"content": [c for c in COMPLETE["content"] if c["type"] != "chart"]}
OTHER_TOOL = {"content": [{"type": "tool_result", "tool_result": {"name": "web", "content": [
    {"json": {"sql": "x"}}]}}]}


def _docs(spark):
    docs = [(1, json.dumps(COMPLETE)), (2, "{not json"), (3, json.dumps({"content": []})),
            (4, json.dumps(NO_CHART)), (5, json.dumps(OTHER_TOOL))]
    return spark.createDataFrame([(i, 0, "assistant", d) for i, d in docs],
                                 "conv_id long, turn long, role string, response string")


def test_wide_keeps_rows_without_artifacts(spark):
    got = {r.conv_id: r for r in responses.wide(_docs(spark)).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    assert got[1].final_answer == "last" and got[1].generated_sql == "SELECT 1"
    assert got[1].verified_query_used is True and got[1].input_tokens == 10
    assert json.loads(got[1].table_columns) == ["N", "RATE"]
    assert json.loads(got[1].table_content) == [["1", "0.4584", "Month-to-Month"],
                                                ["2", None, "Two Year"]]
    assert json.loads(got[1].suggested_queries) == ["next?", 'and "then"?']
    assert (got[1].cache_read_tokens, got[1].cache_write_tokens,
            got[1].uncached_input_tokens) == (1, 2, 7)
    assert got[4].chart_spec is None and got[4].final_answer == "last"
    assert got[5].generated_sql is None
    assert got[2].final_answer is None
    strict = {r.conv_id for r in responses.wide(_docs(spark), require_all=True).collect()}
    assert strict == {1}


def test_items_usage_sql_and_rows(spark):
    d = _docs(spark)
    items = [(r.conv_id, r.item_index, r.item_type) for r in responses.items(d).collect()
             if r.conv_id == 1]
    assert [t for _, _, t in sorted(items)] == ["text", "tool_result", "table", "chart", "text",
                                                "suggested_queries"]
    u = {r.conv_id: r for r in responses.usage(d).collect()}
    assert (u[1].model_name, u[1].cache_write_tokens) == ("m", 2)
    assert (u[2].model_name, u[2].input_tokens) == ("N/A", 0)
    sql = {r.conv_id: r.query_id for r in responses.sql_details(d).collect()}
    assert sql == {1: "q1", 4: "q1"}
    rows = {(r.row_index, r.column_index): (r.column_name, r.value)
            for r in responses.result_rows(d).collect() if r.conv_id == 1}
    assert rows == {(0, 0): ("N", "1"), (0, 1): ("RATE", "0.4584"), (0, 2): (None, "Month-to-Month"),
                    (1, 0): ("N", "2"), (1, 1): ("RATE", None), (1, 2): (None, "Two Year")}
    last = {(r.conv_id, r.item_type): (r.last_index, r.last_value)
            for r in responses.last_items(d).collect()}
    assert last[(1, "text")] == (4, "last")
    assert last[(1, "tool_result")] == (1, "system_execute_sql")
    assert last[(5, "tool_result")] == (0, "web")


def test_safe_parse_never_fails(spark):
    ev = spark.createDataFrame([(1, '{"k": 5}'), (2, "oops"), (3, '{"k": "x"}')],
                               "event_id long, props string")
    conv = spark.createDataFrame([(0, 0, "user", "hello")],
                                 "conv_id long, turn long, role string, text string")
    got = {(r.source, r.record_id): (r.is_valid, r.k)
           for r in responses.safe_parse_report(ev, conv).collect()}
    assert {r.sub_id for r in responses.safe_parse_report(ev, conv).collect()} == {None, 0}
    assert got[("events", 1)] == (True, 5)
    assert got[("events", 2)] == (False, None)
    assert got[("events", 3)] == (True, None)
    assert got[("conversations", 0)] == (False, None)
