"""Answers of agents and judges as columns: fenced JSON, verdicts, run states, event streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# States of runs by what they mean. An empty state is one of work in progress.
CLARIFYING = ["input-required", "input_required", "paused", "awaiting-input", "awaiting_input", "requires-input"]
FAILED = ["failed", "cancelled", "skipped"]
WORKING = ["working", "pending", "queued", "running", "submitted", "started", ""]
VERDICT = "covered bigint, total bigint, faithful boolean, reason string"
PART = "struct<text: string>"
MESSAGE = f"struct<role: string, parts: array<{PART}>>"
ARTIFACT = f"struct<artifactId: string, parts: array<{PART}>>"
STATUS = f"struct<state: string, message: {MESSAGE}>"
TASK = f"struct<id: string, contextId: string, status: {STATUS}, artifacts: array<{ARTIFACT}>, history: array<{MESSAGE}>>"
EVENT = (
    f"struct<task: {TASK}, message: {MESSAGE}, statusUpdate: struct<taskId: string, contextId: string, status: {STATUS}>, "
    f"artifactUpdate: struct<taskId: string, contextId: string, artifact: {ARTIFACT}, append: boolean>>"
)


def without_fences(c: Column) -> Column:
    """Text without the Markdown fence around it, if there is one."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), "^```(?:json)?", ""), "```$", ""), F.lit(" \t\r\n"))


def verdict(c: Column, gold_points: Column) -> Column:
    """(faithful, reason, point_recall) of a judge's answer; null where it is no JSON object. The recall is covered by total, or by the
    number of gold points where the verdict names no total, clipped to [0, 1]; 0 without points."""
    v = F.from_json(without_fences(c), VERDICT, {"mode": "PERMISSIVE"})
    total = F.when(v["total"] > 0, v["total"]).otherwise(gold_points.cast("long"))
    share = F.when(total > 0, F.least(F.lit(1.0), F.greatest(F.coalesce(v["covered"], F.lit(0)), F.lit(0)) / F.when(total > 0, total))).otherwise(0.0)
    made = F.struct(F.coalesce(v["faithful"], F.lit(False)).alias("faithful"), F.coalesce(v["reason"], F.lit("")).alias("reason"), share.alias("point_recall"))
    return F.when(F.coalesce(F.schema_of_variant(F.try_parse_json(without_fences(c))).startswith("OBJECT"), F.lit(False)), made)


def state_class(c: Column) -> Column:
    """completed, clarification, failed, in progress or unknown."""
    s = F.coalesce(c, F.lit(""))
    return F.when(s == "completed", s).when(s.isin(CLARIFYING), "clarification").when(s.isin(FAILED), "failed").when(s.isin(WORKING), "in progress").otherwise("unknown")


def runs(c: Column) -> Column:
    """(id, status, error, answer) of each run in a response, which lists them as runs or as data; the answer of a completed run is its
    summary's final response, or the whole summary."""
    kind = "array<struct<id: string, status: string, error_message: string, summary: variant>>"
    parsed = F.from_json(c, f"runs {kind}, data {kind}")
    listed = F.when(F.size(parsed["runs"]) > 0, parsed["runs"]).otherwise(parsed["data"])

    def one(r: Column) -> Column:
        final, whole = F.try_variant_get(r["summary"], "$.final_response", "string"), F.to_json(r["summary"])
        answer = F.coalesce(F.when(final != "", final), F.when(~F.is_variant_null(r["summary"]), whole))
        return F.struct(r["id"].alias("id"), F.coalesce(r["status"], F.lit("")).alias("status"), F.coalesce(F.when(F.trim(r["error_message"]) != "", F.trim(r["error_message"])), F.lit("no error message")).alias("error"), F.when(r["status"] == "completed", answer).alias("answer"))

    return F.transform(listed, one)


def response_format(content_type: Column, body: Column) -> Column:
    """json, sse or unknown: by how the body begins, then by the content type."""
    b, t = F.regexp_replace(body, r"^\s+", ""), F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(b.startswith("{"), "json").when(b.startswith("data:"), "sse").when(t.contains("json"), "json").when(t.contains("event-stream"), "sse").otherwise("unknown")


def frames(body: Column) -> Column:
    """The events of a stream's data lines, in order."""
    lines = F.transform(F.filter(F.split(body, "\r?\n"), lambda x: x.startswith("data:")), lambda x: F.trim(F.substring(x, F.lit(6), F.char_length(x)), F.lit(" \t\r")))
    return F.transform(F.filter(lines, lambda x: (x != "") & (x != "[DONE]")), lambda x: F.from_json(x, EVENT))


def message_text(message: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(message["parts"], lambda p: p["text"]), ""), F.lit(""))


def _task(events: Column) -> Column:
    """The task at the end of a stream: a task replaces what was before, updates of a state or an artifact change it or begin one."""
    def task(id_: Column, context: Column, status: Column, artifacts: Column, history: Column) -> Column:
        return F.struct(id_.alias("id"), context.alias("contextId"), status.alias("status"), artifacts.alias("artifacts"), history.alias("history"))

    def merged(artifacts: Column, new: Column, append: Column) -> Column:
        mine = lambda a: F.coalesce((a["artifactId"] == new["artifactId"]) & (new["artifactId"] != ""), F.lit(False))
        joined = lambda a: F.when(append, F.struct(a["artifactId"].alias("artifactId"), F.concat(F.coalesce(a["parts"], F.array().cast(f"array<{PART}>")), F.coalesce(new["parts"], F.array().cast(f"array<{PART}>"))).alias("parts"))).otherwise(new)
        held = F.coalesce(artifacts, F.array().cast(f"array<{ARTIFACT}>"))
        return F.when(F.exists(held, mine), F.transform(held, lambda a: F.when(mine(a), joined(a)).otherwise(a))).otherwise(F.concat(held, F.array(new)))

    def step(t: Column, e: Column) -> Column:
        now = F.when(e["task"].isNotNull(), e["task"]).otherwise(t)
        s, a = e["statusUpdate"], e["artifactUpdate"]
        empty = (F.lit(None).cast(f"array<{ARTIFACT}>"), F.lit(None).cast(f"array<{MESSAGE}>"))
        now = F.when(s.isNotNull() & now.isNull(), task(s["taskId"], s["contextId"], s["status"], *empty)).when(s.isNotNull() & (now["id"] == s["taskId"]), task(now["id"], now["contextId"], s["status"], now["artifacts"], now["history"])).otherwise(now)
        base = F.when(now["id"] == a["taskId"], now).otherwise(task(a["taskId"], a["contextId"], F.lit(None).cast(STATUS), *empty))
        return F.when(a.isNotNull(), task(base["id"], base["contextId"], base["status"], merged(base["artifacts"], a["artifact"], F.coalesce(a["append"], F.lit(False))), base["history"])).otherwise(now)

    return F.aggregate(events, F.lit(None).cast(TASK), step)


def _answer(task: Column) -> Column:
    """(answer, problem) of a task: the text of its artifacts, or of what the agent said, if it is completed."""
    state = F.coalesce(task["status"]["state"], F.lit(""))
    said = F.coalesce(F.when(message_text(task["status"]["message"]) != "", message_text(task["status"]["message"])), state)
    text = lambda x, part: F.coalesce(F.array_join(F.transform(F.flatten(F.transform(x, part)), lambda p: p["text"]), ""), F.lit(""))
    shown = text(task["artifacts"], lambda a: a["parts"])
    talked = text(F.filter(task["history"], lambda m: m["role"].isin("agent", "ROLE_AGENT")), lambda m: m["parts"])
    done = state.isin("completed", "TASK_STATE_COMPLETED")
    asks, failed = state.isin("input-required", "TASK_STATE_INPUT_REQUIRED"), state.isin("failed", "canceled", "TASK_STATE_FAILED", "TASK_STATE_CANCELED")
    problem = F.when(asks, F.concat(F.lit("asked for clarification: "), said)).when(failed, F.concat(F.lit("ended in state "), state, F.lit(": "), said)).when(~done, F.concat(F.lit("not completed: "), state))
    return F.struct(F.when(done, F.when(shown != "", shown).otherwise(talked)).alias("answer"), problem.alias("problem"))


def response(content_type: Column, body: Column) -> Column:
    """(answer, problem) of an agent's response: one JSON object, or a stream of events of which the last task or message counts."""
    kind = response_format(content_type, body)
    events = F.when(kind == "json", F.array(F.from_json(body, EVENT))).when(kind == "sse", frames(body)).otherwise(F.array().cast(f"array<{EVENT}>"))

    def of(e: Column) -> Column:
        task = _task(e)
        messages = F.filter(F.transform(e, lambda x: x["message"]), lambda m: m.isNotNull())
        last = F.get(messages, F.size(messages) - 1)
        said = F.struct(message_text(last).alias("answer"), F.lit(None).cast("string").alias("problem"))
        nothing = F.struct(F.lit(None).cast("string").alias("answer"), F.when(kind == "unknown", "unrecognised response").otherwise("neither a task nor a message").alias("problem"))
        return F.when(task.isNotNull(), _answer(task)).when(last.isNotNull(), said).otherwise(nothing)

    return F.element_at(F.transform(F.array(events), of), 1)
