"""Answers of agents and judges."""

import json

import pytest
from pyspark.sql import functions as F

from statuta.functions import answers


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"k long, c {kind}")
    return [r.x for r in rows.select("k", f(F.col("c")).alias("x")).orderBy("k").collect()]


def test_fences(spark):
    assert column(spark, ['```json\n{"a":1}\n```', " ```\nx```\n", "plain", "", None], answers.without_fences) == ['{"a":1}', "x", "plain", "", None]


def test_verdicts(spark):
    texts = ['```json\n{"covered":3,"total":4,"faithful":true,"reason":"ok"}\n```', '{"covered":9,"total":4}', '{"covered":-2,"faithful":false}', '{"covered":1}', "no JSON", "[1]", None, '{"covered":1,"total":0}']
    got = column(spark, texts, lambda c: answers.verdict(c, F.lit(2)))
    assert [g and (g.faithful, g.reason, g.point_recall) for g in got] == [(True, "ok", 0.75), (False, "", 1.0), (False, "", 0.0), (False, "", 0.5), None, None, None, (False, "", 0.5)]
    assert column(spark, ['{"covered":1}'], lambda c: answers.verdict(c, F.lit(0)))[0].point_recall == 0.0


def test_states(spark):
    assert column(spark, ["completed", "paused", "requires-input", "skipped", "", None, "queued", "odd"], answers.state_class) == ["completed", "clarification", "clarification", "failed", "in progress", "in progress", "in progress", "unknown"]


def test_runs(spark):
    bodies = [
        json.dumps({"runs": [{"id": "a", "status": "completed", "summary": {"final_response": "svar"}}, {"id": "b", "status": "failed", "error_message": "  "}]}),
        json.dumps({"data": [{"id": "c", "status": "completed", "summary": {"x": 1}}, {"id": "d", "summary": None}]}),
    ]
    got = column(spark, bodies, answers.runs)
    assert [tuple(r) for r in got[0]] == [("a", "completed", "no error message", "svar"), ("b", "failed", "no error message", None)]
    assert [tuple(r) for r in got[1]] == [("c", "completed", "no error message", '{"x":1}'), ("d", "", "no error message", None)]


def part(*texts):
    return [{"text": t} for t in texts]


def sse(*events):
    return "".join(f"data: {json.dumps(e)}\n\n: comment\n" for e in events) + "data: [DONE]\n"


TASK = {"task": {"id": "t", "status": {"state": "working"}, "history": [{"role": "user", "parts": part("q")}, {"role": "agent", "parts": part("from history")}]}}


@pytest.mark.parametrize("body, want", [
    (sse(TASK, {"artifactUpdate": {"taskId": "t", "artifact": {"artifactId": "a", "parts": part("one ")}}}, {"artifactUpdate": {"taskId": "t", "artifact": {"artifactId": "a", "parts": part("two")}, "append": True}}, {"statusUpdate": {"taskId": "t", "status": {"state": "completed"}}}), ("one two", None)),
    (sse(TASK, {"artifactUpdate": {"taskId": "t", "artifact": {"artifactId": "a", "parts": part("old")}}}, {"artifactUpdate": {"taskId": "t", "artifact": {"artifactId": "a", "parts": part("new")}}}, {"statusUpdate": {"taskId": "t", "status": {"state": "completed"}}}), ("new", None)),
    (sse(TASK, {"statusUpdate": {"taskId": "other", "status": {"state": "failed"}}}, {"statusUpdate": {"taskId": "t", "status": {"state": "completed"}}}), ("from history", None)),
    (sse({"statusUpdate": {"taskId": "n", "status": {"state": "input-required", "message": {"role": "agent", "parts": part("which?")}}}}), (None, "asked for clarification: which?")),
    (sse({"message": {"role": "agent", "parts": part("a", "b")}}), ("ab", None)),
    (sse({"task": {"id": "t", "status": {"state": "failed"}}}), (None, "ended in state failed: failed")),
    (json.dumps({"message": {"parts": part("hi")}}), ("hi", None)), (json.dumps({"task": {"id": "t", "status": {"state": "completed"}, "artifacts": [{"parts": part("x")}, {"parts": part("y")}]}}), ("xy", None)),
    ("{}", (None, "neither a task nor a message")), ("<html>", (None, "unrecognised response")), ("data:\n", (None, "neither a task nor a message")),
])
def test_responses(spark, body, want):
    assert tuple(column(spark, [body], lambda c: answers.response(F.lit(None).cast("string"), c))[0]) == want
