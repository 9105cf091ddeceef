"""Payloads of both families on small inputs with known results."""

import json

import pytest

from foliospark.functions import payloads as P


def payloads(spark, *data):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for i, d in enumerate(data)], "message int, payload string")


CONTENT = {
    "responseId": "r1", "modelVersion": "m", "usageMetadata": {"totalTokenCount": 30},
    "candidates": [{
        "finishReason": "STOP", "groundingMetadata": {"groundingChunks": [{"web": {"uri": "https://example.com", "title": "Source"}}, {"web": {"uri": "https://example.com", "title": "Source"}}, {"web": {}}, None]},
        "urlContextMetadata": {"urlMetadata": [{"retrievedUrl": "https://read.example"}]}, "citationMetadata": {"citationSources": [{"uri": "https://cited.example"}]},
        "content": {"parts": [
            {"thought": True, "text": "Public summary", "thoughtSignature": "private signature"}, {"functionCall": {"id": "call1", "name": "lookup", "args": {"q": "test"}}},
            {"functionResponse": {"id": "call1", "name": "lookup", "response": {"value": 42}}}, {"executableCode": {"language": "PYTHON", "code": "print(42)"}},
            {"codeExecutionResult": {"outcome": "OUTCOME_OK", "output": "42"}}, {"text": "Answer"}, {"inlineData": {"mimeType": "image/png", "data": "AAAA"}}, {"fileData": {"mimeType": "application/pdf", "fileUri": "f"}},
        ]},
    }],
}
STEPS = {
    "status": "completed", "usage": {"total_tokens": 123, "total_input_tokens": "7", "total_output_tokens": -1, "total_tool_use_tokens": 4},
    "steps": [
        {"type": "thought", "signature": "private", "content": "never expose", "summary": [{"type": "text", "text": "Public summary"}]},
        {"type": "code_execution_call", "id": "c1", "code": "print(1)", "headers": {"Authorization": "secret"}},
        {"type": "code_execution_result", "call_id": "c1", "output": "fixture-super-secret 1"},
        {"type": "model_output", "content": [{"type": "text", "text": "Done"}, {"type": "image", "uri": "u"}]},
    ],
}


def parts_of(snapshot):
    return [json.loads(r["part"]) for r in sorted(snapshot[0].collect(), key=lambda r: (r["message"], r["place"])) if r["kept"]]


def test_snapshot_of_candidates(spark):
    snap = P.snapshots(payloads(spark, CONTENT), P.CANDIDATES)
    parts = parts_of(snap)
    assert [p["type"] for p in parts] == ["reasoning", "tool-call", "tool-result", "tool-call", "tool-result", "text", "artifact", "artifact"]
    assert parts[1]["data"]["args"]["q"] == "test" and parts[1]["id"] == "c0p1functionCall" and parts[3]["name"] == "code_execution"
    assert parts[6]["data"] == {"mimeType": "image/png", "uri": "", "inline": True}
    (capture,) = snap[1].collect()
    meta = json.loads(capture["metadata"])
    assert meta["candidates"][0]["groundingMetadata"]["groundingChunks"][0]["web"]["title"] == "Source" and meta["usageMetadata"]["totalTokenCount"] == 30
    assert "private signature" not in json.dumps(parts) + capture["metadata"] and (capture["total_parts"], capture["omitted_parts"], capture["truncated"]) == (8, 0, False)


def test_snapshot_of_steps(spark):
    parts, captures = P.snapshots(payloads(spark, STEPS, {"steps": [{"type": "thought", "signature": "x"}]}, {}, "no json"), P.INTERACTIONS, ["fixture-super-secret"])
    rows = [json.loads(r["part"]) for r in sorted(parts.collect(), key=lambda r: (r["message"], r["place"]))]
    assert [p["type"] for p in rows] == ["reasoning", "tool-call", "tool-result", "text", "artifact", "reasoning"]
    assert rows[2]["callId"] == "c1" and rows[-1]["text"] == "" and rows[3]["id"] == "s3p0"
    raw = json.dumps(rows)
    assert not any(s in raw for s in ("never expose", "fixture-super-secret", "private", "Authorization")) and "[REDACTED]" in raw
    assert {r["message"]: r["total_parts"] for r in captures.collect()} == {0: 5, 1: 1, 2: 0, 3: 0}


def test_budgets_say_what_they_left_out(spark):
    big = {"steps": [{"type": "function_call", "name": "shell", "arguments": "中" * 100_000} for _ in range(40)] + [{"type": "text", "text": "small"}], "usage": {"x": ["y" * 60_000] * 3}}
    many = {"candidates": [{"content": {"parts": [{"text": str(i)} for i in range(600)]}}]}
    parts, captures = P.snapshots(payloads(spark, big), P.INTERACTIONS)
    rows = sorted(parts.collect(), key=lambda r: r["place"])
    (c,) = captures.collect()
    assert c["truncated"] and c["omitted_parts"] == sum(not r["kept"] for r in rows) > 0 and c["total_parts"] == 41
    assert rows[-1]["kept"] and not rows[20]["kept"]  # a small part still fits
    assert json.loads(c["metadata"])["usage"] == P.OMITTED
    whole = {"version": 1, "protocol": P.INTERACTIONS, "parts": [json.loads(r["part"]) for r in rows if r["kept"]], "metadata": json.loads(c["metadata"]), "capture": {"totalParts": 41, "omittedParts": c["omitted_parts"], "truncated": True}}
    assert len(json.dumps(whole, ensure_ascii=False).encode()) <= P.MOST_BYTES
    parts, captures = P.snapshots(payloads(spark, many), P.CANDIDATES)
    assert parts.filter("kept").count() == 500 and captures.first()["omitted_parts"] == 100


def shown(spark, protocol, *data, secrets=None):
    rows = P.display_parts(payloads(spark, *data), protocol, secrets)
    return rows, [r.asDict() for r in sorted(rows.collect(), key=lambda r: (r["message"], r["sequence"]))]


def test_parts_are_cleaned_once_and_budgets_kept_for_many_messages_at_once(spark):
    parts, captures = P.snapshots(payloads(spark, CONTENT), P.CANDIDATES)
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (parts, captures)]
    assert not any("content.parts" in p or "FlatMapGroups" in p for p in plans)
    rows = [(m, p, 10 * (p % 3 + 1)) for m in range(50) for p in range(m % 9)]
    shells = [(m, m) for m in range(50)]
    got = P.within(spark.createDataFrame(rows, "message long, place int, bytes long"), spark.createDataFrame(shells, "message long, shell_bytes long"), 7, 90)
    want = set()
    for m, size in shells:
        for _, place, own in (r for r in rows if r[0] == m):
            fits = place < 7 and size + own + 2 <= 90
            size += own + 2 if fits else 0
            want.add((m, place, fits))
    assert {tuple(r) for r in got.collect()} == want


def test_display_of_candidates(spark):
    rows, parts = shown(spark, P.CANDIDATES, CONTENT)
    assert [(p["sequence"], p["type"], p["tool_name"], p["status"]) for p in parts] == [
        (1, "reasoning", None, None), (2, "tool", "lookup", "completed"), (3, "server_tool", "code_execution", "completed"), (4, "text", None, None), (5, "image", None, None), (6, "document", None, None)
    ]
    assert json.loads(parts[1]["input"]) == {"q": "test"} and json.loads(parts[1]["output"]) == {"value": 42}
    assert json.loads(parts[2]["output"]) == {"outcome": "OUTCOME_OK", "output": "42"} and parts[2]["tool_call_id"] == "c0p3:code_execution"
    assert (parts[4]["mime"], parts[4]["inline"], parts[5]["uri"], parts[5]["inline"]) == ("image/png", True, "f", False)
    (run,) = P.code_executions(rows).collect()
    assert (run["language"], run["code"], run["outcome"], run["output"], run["status"]) == ("PYTHON", "print(42)", "OUTCOME_OK", "42", "completed")
    cited = [(r["title"], r["url"]) for r in P.annotations(payloads(spark, CONTENT), P.CANDIDATES).orderBy("place").collect()]
    assert cited == [("Source", "https://example.com"), ("https://read.example", "https://read.example"), ("https://cited.example", "https://cited.example")]


def test_payloads_are_parsed_once_for_display(spark):
    found = P.display_parts(spark.createDataFrame([(1, '{"candidates":[]}')], "message long, payload string"), P.CANDIDATES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "payload" not in plan and "FlatMapGroups" not in plan and found.count() == 0


def test_unmatched_calls_and_results_stay_in_place(spark):
    call = lambda i, **k: {"functionCall": {"id": i, "name": "f", **k}}
    result = lambda i: {"functionResponse": {"id": i, "name": "f", "response": {"i": i}}}
    data = {"candidates": [{"content": {"parts": [result("a"), call("a"), {"text": "t"}, call("a"), result("a"), result("a"), {"codeExecutionResult": {"outcome": "OUTCOME_FAILED"}}, {"toolCall": {"toolType": "T", "args": [1]}}, {"toolResponse": {"toolType": "T", "response": "r"}}, {"toolResponse": {"toolType": "U"}}, {"executableCode": {"id": "x", "code": "1"}}, {"codeExecutionResult": {"outcome": "OUTCOME_OK"}}]}}]}
    _, parts = shown(spark, P.CANDIDATES, data)
    assert [(p["type"], p["tool_call_id"], p["status"], p["output"] is None) for p in parts] == [
        ("tool", "a", "completed", False), ("tool", "a", "in_progress", True), ("text", None, None, True), ("tool", "a", "completed", False), ("tool", "a", "completed", False),
        ("server_tool", "c0p6:code_execution", "failed", False), ("server_tool", "c0p7:T", "completed", False), ("server_tool", "c0p9:U", "completed", True), ("server_tool", "x", "completed", False),
    ]
    assert parts[0]["input"] == "{}" and json.loads(parts[6]["input"]) == [1] and json.loads(parts[6]["output"]) == "r"


def test_display_of_steps(spark):
    more = {"outputs": [
        {"type": "function_call", "name": "f", "call_id": "1", "arguments": "raw"}, {"type": "function_result", "call_id": "2", "result": {"a": 1}}, {"type": "function_result", "call_id": "1", "output": "text"},
        {"type": "web_call", "server_name": "s", "query": "q", "signature": "x"}, {"type": "web_result", "call_id": "?", "is_error": True, "x": 1}, {"type": "web_result", "call_id": "?"}, {"type": "odd"}, "x",
        {"type": "text", "text": "bare"}, {"type": "code_execution_result", "exit_code": 3, "stdout": "o", "result": "r"},
    ]}
    rows, parts = shown(spark, P.INTERACTIONS, STEPS, more, secrets=["fixture-super-secret"])
    assert [(p["message"], p["type"], p["tool_call_id"], p["tool_name"], p["status"]) for p in parts] == [
        (0, "reasoning", None, None, None), (0, "server_tool", "c1", "code_execution", "completed"), (0, "text", None, None, None), (0, "image", None, None, None),
        (1, "tool", "1", "f", "completed"), (1, "tool", "2", "function", "completed"), (1, "server_tool", "step-3:s", "s", "failed"), (1, "server_tool", "?", "web", "completed"),
        (1, "text", None, None, None), (1, "server_tool", "step-9:code_execution", "code_execution", "failed"),
    ]
    assert parts[4]["input"] == "raw" or json.loads(parts[4]["input"]) == "raw"
    assert "fixture-super-secret" not in parts[1]["output"] and "Authorization" not in parts[1]["input"] and "signature" not in parts[6]["input"]
    runs = {r["call_id"]: r.asDict() for r in P.code_executions(rows).collect()}
    assert runs["c1"]["code"] == "print(1)" and runs["step-9:code_execution"] | {} and runs["step-9:code_execution"]["exit_code"] == 3 and runs["step-9:code_execution"]["output"] == "r" and runs["step-9:code_execution"]["code"] == ""
    calls = {r["call_id"]: (r["kind"], r["status"]) for r in P.tool_calls(rows).collect()}
    assert calls["1"] == ("client", "completed") and calls["step-3:s"] == ("server", "failed")


@pytest.mark.parametrize(
    ("data", "reply", "error"),
    [
        (STEPS, "Done", ""),
        ({"output_text": "said", "steps": STEPS["steps"], "status": "incomplete"}, "said", P.SAID["incomplete"]),
        ({"output_text": " ", "outputs": [{"type": "text", "text": "a"}, {"type": "x", "text": "n"}, {"type": "text", "text": "b"}], "status": "completed"}, "a\nb", ""),
        ({"status": "failed", "error": {"message": "m" * 1200}}, "", P.SAID["failed"] + "m" * 1000),
        ({"status": "failed", "error": "why"}, "", P.SAID["failed"] + "why"),
        ({"status": "requires_action"}, "", P.SAID["failed"] + P.SAID["external"]),
        ({"status": "failed"}, "", P.SAID["failed"] + P.SAID["no detail"]),
        ({"status": "canceled", "output_text": "x"}, "x", P.SAID["cancelled"]),
        ({"status": "completed"}, "", P.SAID["no text"]),
        ({}, "", P.SAID["empty"]),
    ],
)
def test_interaction_results(spark, data, reply, error):
    row = P.interaction_results(payloads(spark, data)).first()
    assert (row["reply"], row["error"]) == (reply, error)
    assert row["finish_reason"] == data.get("status", "").upper()


def test_usage_of_interactions(spark):
    row = P.interaction_results(payloads(spark, STEPS)).first()
    assert row["usage"] == {"totalTokenCount": 123, "toolUseTokenCount": 4} and row["tool_calls"] == {"code_execution_call": 1} and row["step_count"] == 4
    with pytest.raises(Exception, match="2 MiB"):
        P.interaction_results(payloads(spark, {"output_text": "é" * (1 << 20) + "x"})).collect()
