"""Paces, retirements, run logs, summaries and traces on small inputs with known results."""

import json
import random
import re

from foliospark.functions import classify as C
from foliospark.operators import runs
from foliospark.streaming import traces
from pyspark.sql import functions as F


def test_pace_by_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [("a", i, rnd.choice([200, 200, 200, 429, 429, 503])) for i in range(700)] + [("b", 0, 503), ("c", 0, 429), ("d", 0, 200)] + [("e", i, 429) for i in range(30)]
    want = {}
    for b, _, s in rows:
        x = want.get(b, 1.0)
        want[b] = min(8.0, x * 1.5) if s == 429 else max(1.0, x * 0.95) if s == 200 else x
    for block in (4096, 7):
        monkeypatch.setattr(runs, "BLOCK", block)
        got = {r["b"]: r["pace"] for r in runs.pace(spark.createDataFrame(rows, "b string, i int, s int").repartition(4), "b", "i", "s").collect()}
        assert {b: round(x, 9) for b, x in got.items()} == {b: round(x, 9) for b, x in want.items() if b != "b"}


def test_retirements(spark):
    tokens = spark.createDataFrame([("r", "secret"), ("r", "secret-long"), ("q", "t")], "run string, token string")
    rows = spark.createDataFrame([("r", 1, "secret", "bad secret-long"), ("r", 2, "secret", "again"), ("r", 3, "secret-long", "secret"), ("q", 1, "t", "t!")], "run string, seq int, token string, reason string")
    got = [tuple(r) for r in runs.retirements(rows, tokens).orderBy("run", "seq").collect()]
    assert got == [("q", 1, "t", "fatal", 1, "[REDACTED]!"), ("r", 1, "secret", "retired", 1, "bad [REDACTED]"), ("r", 2, "secret", "retired", 1, "again"), ("r", 3, "secret-long", "fatal", 2, "[REDACTED]")]


def test_run_metrics(spark):
    lines = [
        "2026-01-01T00:00:01.5Z [config] x", "2026-01-01T00:01:01.75Z [quota] action complete keys=1 requests=12 y", "[quota] other", '[performance] {"p50_seconds": 1.5, "p95_seconds": null, "429": 2, "503": 0}',
        "[hedge] a", "x [hedge] b", "[done] 001.md (source=ocr+model 3s)", "[done] 002.md (model)", "[done] no",
    ]
    (r,) = runs.run_metrics(spark.createDataFrame([("a", x) for x in lines], "run string, line string")).collect()
    assert r.asDict() == {"run": "a", "wall_seconds": 60.25, "requests": 12, "hedges": 2, "p50_seconds": 1.5, "p95_seconds": None, "http_429": 2, "http_503": 0, "pages": 2, "both_sources": 1, "ocr": None}


def test_summary_of_an_empty_run(spark):
    progress = json.dumps({"state": "running", "completed_chunks": 1, "success_chunks": 1, "blank_chunks": 0, "failed_chunks": 0, "total_pages": 4, "percent": 25.0, "elapsed_seconds": 3})
    rows = runs.job_summary(spark.createDataFrame([("r", progress, "{}", "{}"), ("n", progress, None, None)], "run string, progress string, usage string, requests string"))
    got = [r["result"] for r in rows.filter("run = 'r'").orderBy("place").collect()]
    assert got == ["running", "1/4 (25.0%)", "1 / 0 / 0", "0 / 0 / 0", "off", "off", "0 / 0", "None / None", "0", "0 / 0", "0", "off", "0–0", "3", "0 / 0"]
    assert got == [r["result"] for r in rows.filter("run = 'n'").orderBy("place").collect()]
    text = runs.summary_markdown(rows).filter("run = 'r'").first()["text"]
    assert text.startswith("## File conversion\n\n| Metric | Result |\n| --- | --- |\n| State | running |\n") and text.count("\n") == 19


def events(*rows):
    return [("s", i, float(t), kind, json.dumps(data)) for i, (t, kind, data) in enumerate(rows)]


EVENTS = "stream string, arrival int, at double, event string, data string"
STEP = lambda i, kind, **k: {"index": i, "step": {"type": kind, **k}}


def test_trace_of_tools(spark):
    rows = events(
        (0, "step.delta", {"index": 0, "delta": {"text": "early"}}), (1, "step.start", STEP(0, "code_call", id="k", name="py")), (2, "step.delta", {"index": 0, "delta": {"type": "text", "text": "a", "code": "b"}}),
        (3, "step.delta", {"index": 0, "delta": {"text": "c" * 20_000}}), (4, "step.start", STEP(1, "code_call")), (5, "step.stop", {"index": 0}), (6, "step.start", STEP(2, "code_result", call_id="k")), (8, "step.stop", {"index": 2}),
        (9, "step.start", STEP(3, "code_result")), (10, "step.stop", {"index": 3}), (11, "step.start", STEP(4, "thought")), (12, "step.delta", {"index": 4, "delta": {"type": "thought_summary", "content": {"type": "text", "text": "think"}}}),
        (13, "step.start", STEP(0, "web_call")), (14, "step.start", STEP(5, "file_result")), (15, "step.stop", {"index": 5}), (50, "step.stop", {"index": 99}), (51, "other", {"index": 200_000}),
    )
    df = spark.createDataFrame(rows, EVENTS)
    steps = {(r["index"], r["start"]): r for r in traces.trace_steps(df).collect()}
    first = steps[0, 1]
    assert (first["type"], first["name"], first["seconds"], first["delta_chars"]) == ("code_call", "py", 4.0, 20_002) and first["capture"] == "ab" + "c" * 15_998
    assert steps[4, 10]["summary"] == "think" and steps[4, 10]["capture"] == "" and steps[4, 10]["seconds"] is None and (0, 12) in steps and len(steps) == 7
    tools = sorted((r["call_index"], r["result_index"], r["type"], r["association"], r["seconds"]) for r in traces.finished_tools(traces.trace_steps(df)).collect())
    assert tools == [(0, 2, "code_call", "call_id", 7.0), (1, 3, "code_call", "type_fifo_estimate", 6.0)]
    looks = [(r["tick"], r["idle"], r["open_steps"]) for r in traces.diagnostics(df).orderBy("tick").collect()]
    assert looks == [(20.0, 5.0, [1, 4, 0]), (40.0, 25.0, [1, 4, 0]), (60.0, 9.0, [1, 4, 0])]


def test_job_rules(spark):
    df = spark.createDataFrame([(None, " ", "r", "r"), (None, None, "r", "j"), ("h", None, None, None), (None, None, "r", ""), (None, None, None, None)], "h string, p string, r string, i string")
    assert [r[0] for r in df.select(C.is_continuation(*map(F.col, "hpri"))).collect()] == [False, True, True, False, False]
    df = spark.createDataFrame([(400, "invalid_request", "Precondition check failed."), (400, "invalid_request", "Precondition check failed"), (401, "invalid_request", "Precondition check failed."), (400, None, "Precondition check failed.")], "s int, c string, m string")
    assert [r[0] for r in df.select(C.is_precondition_error(*map(F.col, "scm"))).collect()] == [True, False, False, False]


def test_looks_at_many_open_steps(spark, tmp_path):
    """Sixty steps that never stop and some that do; the last ten by start are listed, and no table of ticks is broadcast."""
    rows = [(s, i, float(i * 7), "step.stop" if i % 4 == 3 else "step.start", json.dumps({"index": 99 if i % 4 > 1 else i % 5, "step": {"type": "thought"}})) for s in (1, 2) for i in range(80 + s)]
    spark.createDataFrame(rows, "stream long, arrival long, at double, event string, data string").write.parquet(f"{tmp_path}/events")
    found = traces.diagnostics(spark.read.parquet(f"{tmp_path}/events"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[stream#\d+L?, n#", plan)
    got = {(r["stream"], r["tick"]): r["open_steps"] for r in found.collect()}
    for (s, tick), listed in got.items():
        steps = []
        for _, i, at, event, data in (r for r in rows if r[0] == s):
            index = json.loads(data)["index"]
            if event == "step.start":
                steps.append([at, index, None])
            else:
                of = [x for x in steps if x[1] == index]
                if of:
                    of[-1][2] = at
        number = lambda t: max(0, -int(-t // 20.0)) if t is not None else None
        n, last = round(tick / 20), number(rows[-1][2] if s == 2 else float(80 * 7))
        own = [x[:2] for x in steps if max(1, number(x[0])) <= n <= (last if x[2] is None else number(x[2]) - 1)]
        assert listed == [i for _, i in sorted(own)[-10:]], (s, tick)


def test_a_long_silence_costs_no_rows_but_its_own(spark, monkeypatch):
    """Steps are ranked once between two events, not at each of 30,000 ticks: no stage shuffles a row for each tick. Pieces of a stretch give each tick once."""
    rows = [(s, i, float(i), "step.start", json.dumps({"index": i, "step": {"type": "thought"}})) for s in ("a", "b") for i in range(14)]
    rows += [("a", 14, 9.0, "step.stop", '{"index": 13}'), ("a", 15, 200_000.0, "step.stop", '{"index": 8}'), ("b", 14, 400_000.0, "step.stop", '{"index": 0}'), (None, 0, 0.0, "step.start", '{"index": 1}'), (None, 1, 30.0, "step.stop", '{"index": 1}')]
    events = spark.createDataFrame(rows, EVENTS).repartition(3)
    for piece in (1000, 4096):
        monkeypatch.setattr(traces, "PIECE", piece)
        spark.sparkContext.setJobGroup(f"looks {piece}", "")
        got = [(r["stream"], r["tick"], r["idle"], r["open_steps"]) for r in traces.diagnostics(events).collect()]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        status, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
        stages = {k for job in status.getJobIdsForGroup(f"looks {piece}") for k in status.getJobInfo(job).stageIds if status.getStageInfo(k) and status.getStageInfo(k).numCompletedTasks}
        assert stages and max(store.lastStageAttempt(k).shuffleWriteRecords() for k in stages) < 1000
        want = [("a", 20.0 * n, 20.0 * n - 13 if n < 10_000 else 0.0, list(range(3, 13)) if n < 10_000 else [2, 3, 4, 5, 6, 7, 9, 10, 11, 12]) for n in range(1, 10_001)]
        want += [("b", 20.0 * n, 20.0 * n - 13 if n < 20_000 else 0.0, list(range(4, 14))) for n in range(1, 20_001)] + [(None, 20.0 * n, None, []) for n in (1, 2)]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_looks_at_steps_that_stop_and_start_anew(spark, monkeypatch):
    """Random starts and stops of few and of many indexes, several in a tick, against a plain reading."""
    monkeypatch.setattr(traces, "PIECE", 2)
    rnd, rows = random.Random(4), []
    for s, most in (("few", 4), ("many", 60)):
        at = 100.0
        for i in range(150):
            at += rnd.choice([0, 0.5, 3, 20, 90])
            rows.append((s, i, at, rnd.choice(["step.start", "step.start", "step.stop", "step.delta"]), json.dumps({"index": rnd.randrange(most)})))
    got = {(r["stream"], r["tick"]): (r["idle"], r["open_steps"]) for r in traces.diagnostics(spark.createDataFrame(rows, EVENTS).repartition(3)).collect()}
    want = {}
    for s in ("few", "many"):
        own = [r for r in rows if r[0] == s]
        first, last = own[0][2], own[-1][2]
        number = lambda t: -int(-(t - first) // 20.0)  # noqa: B023, E731
        steps = []
        for _, _, at, kind, data in own:
            index = json.loads(data)["index"]
            if kind == "step.start":
                steps.append([at, index, None])
            elif kind == "step.stop" and (of := [x for x in steps if x[1] == index]):
                of[-1][2] = at
        for n in range(1, max(1, number(last)) + 1):
            told = [x[:2] for x in steps if max(1, number(x[0])) <= n and (x[2] is None or n < number(x[2]))]
            seen = max(r[2] for r in own if max(1, number(r[2])) <= n)
            want[s, first + n * 20.0] = (first + n * 20.0 - seen, [i for _, i in sorted(told)[-10:]])
    assert got == want
