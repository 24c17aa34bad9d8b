import json
import random

import duckdb
import pytest

from statuta.llm import chat

MESSAGE = "conv_id long, turn long, role string, text string"


def call(id_, name, **arguments):
    return {"id": id_, "name": name, "arguments": arguments}


def said(*calls):
    return json.dumps({"tool_calls": list(calls)})


def result(of, content="ok"):
    return json.dumps({"tool_call_id": of, "content": content})


@pytest.fixture(scope="module")
def tools(spark):
    return spark.createDataFrame([("add", [("a", "integer", True), ("b", "number", False), ("o", "object", False)])], "name string, params array<struct<name string, type string, required boolean>>")


def linked(spark, tools, rows):
    return chat.link(chat.parse(spark.createDataFrame(rows, MESSAGE)), tools).collect()


def test_links_statuses_and_order(spark, tools):
    rows = [
        (1, 0, "user", "hi \"x\"\n"), (1, 2, "assistant", said(call("k1", "add", b=2.5, a=1))), (1, 1, "tool", result("k1")), (1, 3, "assistant", said(call("k2", "add", a={"$ref": "k1"}))),
        (1, 4, "assistant", said(call("k3", "sub", a=1))), (1, 5, "assistant", said(call("k1", "add", a=1))), (1, 6, "tool", result("none")), (1, 7, "assistant", said(call("k4", "add", a=1, z=2))), (1, 8, "assistant", said(call("k5", "add", a=1))),
        (2, 0, "assistant", said(call("p", "add", a=1, o={"$ref": "q"}))), (2, 1, "assistant", said(call("q", "add", a=1, o={"$ref": "p"}))),
    ]
    got = {(r.conv_id, r.turn): r for r in linked(spark, tools, rows)}
    status = {k: r.status for k, r in got.items()}
    assert status == {(1, 0): None, (1, 2): "ok", (1, 1): "ok", (1, 3): "invalid arguments", (1, 4): "unknown tool", (1, 5): "duplicate id", (1, 6): "no call", (1, 7): "invalid arguments", (1, 8): "no result", (2, 0): "cycle", (2, 1): "cycle"}
    assert got[1, 1].linked_turn == 2 and got[1, 2].linked_turn == 1 and got[1, 1].position > got[1, 2].position
    assert got[1, 1].level > got[1, 2].level and got[1, 3].position > got[1, 1].position
    assert got[1, 2].json == '{"role":"assistant","tool_calls":[{"arguments":{"a":1,"b":2.5},"id":"k1","name":"add"}]}'
    assert json.loads(got[1, 0].json) == {"content": 'hi "x"\n', "role": "user"}
    assert got[1, 1].json == '{"content":"ok","role":"tool","tool_call_id":"k1"}'


def test_dependencies_across_rounds(spark, tools):
    rows = [(1, k, "assistant", said(call(f"k{k}", "add", a=1, **({"o": {"$ref": f"k{k - 1}"}} if k else {})))) for k in range(4)]
    got = sorted(linked(spark, tools, rows), key=lambda r: r.turn)
    assert [r.level for r in got] == [0, 0, 0, 0] and [r.position for r in got] == [0, 1, 2, 3]
    turned = [(c, 9 - t, *rest) for c, t, *rest in rows]
    got = sorted(linked(spark, tools, turned), key=lambda r: -r.turn)
    assert [r.level for r in got] == [0, 1, 2, 3] and [r.position for r in got] == [0, 1, 2, 3]


def test_long_chains_take_few_rounds(spark, tools, monkeypatch):
    """A chain of 300 calls, each of which names the next, and one of calls that name the two before."""
    n, made, one = 300, [], chat.table
    monkeypatch.setattr(chat, "table", lambda *a: made.append(1) or one(*a))
    rows = [(1, k, "assistant", said(call(f"k{k}", "add", a=1, **({"o": {"$ref": f"k{k + 1}"}} if k + 1 < n else {})))) for k in range(n)]
    rows += [(2, k, "assistant", said(call(f"k{k}", "add", a=1, o=[{"$ref": f"k{j}"} for j in (k - 1, k - 2) if j >= 0]))) for k in range(n)]
    got = {(r.conv_id, r.turn): (r.position, r.level) for r in linked(spark, tools, rows)}
    assert [got[1, k] for k in range(n)] == [(n - 1 - k, n - 1 - k) for k in range(n)] and [got[2, k] for k in range(n)] == [(k, 0) for k in range(n)]
    assert len(made) < 25


def test_awkward(spark, tools):
    rows = [(None, None, None, None), (None, 0, "user", "{not json"), (1, None, "assistant", said(call("a", "add", a=1))), (1, 0, "user", ""), (1, 0, "user", ""), (1, 1, "tool", result("a", "x" * 100_000)), (1, 2, "assistant", '{"tool_calls": null}')]
    got = linked(spark, tools, rows)
    assert len(got) == len(rows) and all(json.loads(r.json) is not None for r in got)
    assert chat.link(chat.parse(spark.createDataFrame([], MESSAGE)), tools).count() == 0


def test_positions_with_references_to_later_turns(spark, tools):
    """A call that names a later call's result comes after that result; so do calls of one message, and chains of such."""
    ref = lambda x: {"$ref": x}
    rows = [
        (1, 1, "assistant", said(call("b", "add", a=1, o=ref("a")))), (1, 2, "tool", result("b")), (1, 3, "assistant", said(call("a", "add", a=1))), (1, 4, "tool", result("a")), (1, 5, "user", "end"),
        (2, 0, "assistant", said(call("x", "add", a=1, o=ref("z")), call("y", "add", a=1))), (2, 1, "tool", result("y")), (2, 2, "assistant", said(call("z", "add", a=1, o=ref("w")))), (2, 3, "assistant", said(call("w", "add", a=1))),
        (3, 0, "assistant", said(call("s", "add", a=1, o=ref("s")))), (3, 1, "assistant", said(call("t", "add", a=1, o={"deep": [[ref("s")]]}))),
    ]
    got = {(r.conv_id, r.turn): r for r in linked(spark, tools, rows)}
    at = {k: r.position for k, r in got.items()}
    assert at[1, 3] < at[1, 4] < at[1, 1] < at[1, 2] and at[1, 2] < at[1, 5]
    assert at[2, 3] < at[2, 2] < at[2, 0] < at[2, 1]
    assert got[3, 0].status == got[3, 1].status == "cycle" and got[2, 0].level == 2


def brute(messages):
    """Levels and places of the calls of one conversation by trying again until nothing changes. messages: (turn, [(id, refs)], result_of)."""
    owner, answered = {}, {}
    for turn, calls, of in messages:
        for k, (i, _) in enumerate(calls):
            owner[i] = min(owner.get(i, (turn, k)), (turn, k))
        if of is not None:
            answered[of] = min(answered.get(of, turn), turn)
    needs = {t: {(owner[r][0], answered.get(r)) for _, refs in calls for r in refs if r in owner} for t, calls, _ in messages if calls}
    merged = {t: {r: max((a for x, a in n if x == r and a is not None), default=None) for r, _ in n} for t, n in needs.items()}
    done = {t: (t, 0) for t, n in merged.items() if not n}

    def result_of(r, a):
        p, l = done[r]
        return (p, l) if a is None else (a, 0) if a > p else (p, l + 1)

    while True:
        new = {}
        for t, n in merged.items():
            if t not in done and all(r in done for r in n):
                p, l = max(result_of(r, a) for r, a in n.items())
                new[t] = (t, 0) if t > p else (p, l + 1)
        if not new:
            break
        done |= new
    keys = {}
    for turn, calls, of in messages:
        if calls:
            keys[turn] = done.get(turn, (turn, 0))
        elif of in owner:
            p, l = done.get(owner[of][0], (owner[of][0], 0))
            keys[turn] = (turn, 0) if turn > p else (p, l + 1)
        else:
            keys[turn] = (turn, 0)
    return {t: (k[1], sum(o < k for o in keys.values())) for t, k in keys.items()}


def test_order_equals_brute_force(spark, tools):
    rng, rows, want = random.Random(3), [], {}
    for conv in range(40):
        names, messages = [f"n{k}\"\u00e9\\" for k in range(rng.randint(1, 6))], []
        for turn in range(rng.randint(1, 12)):
            if rng.random() < 0.6:
                made = [(rng.choice(names), rng.sample(names, rng.choice([0, 0, 1, 2]) if len(names) > 1 else 0)) for _ in range(rng.choice([1, 1, 2]))]
                messages.append((turn, made, None))
                rows.append((conv, turn, "assistant", said(*(call(i, "add", a=1, o=[{"$ref": r} for r in refs]) for i, refs in made))))
            else:
                messages.append((turn, [], rng.choice(names)))
                rows.append((conv, turn, "tool", "  " + result(messages[-1][2])))
        want |= {(conv, t): x for t, x in brute(messages).items()}
    got = {(r.conv_id, r.turn): (r.level, r.position) for r in linked(spark, tools, rows)}
    assert got == want and max(x[0] for x in want.values()) >= 3


def test_references_in_text_are_none(spark, tools):
    """What looks like a reference inside a string is text; escaped names and keys are names and keys."""
    rows = [
        (1, 0, "assistant", said(call('a"b\\', "add", a=1))), (1, 1, "assistant", said(call("k", "add", a=1, o={"t": '{"$ref":"k"}', "$ref": 'a"b\\'}))),
        (1, 2, "assistant", '{"tool_calls":[{"id":"m","name":"add","arguments":{"a":1,"o":{"\\u0024ref":"k"}}}]}'),
    ]
    turned = [(c, 5 - t, *rest) for c, t, *rest in rows]
    assert [r.level for r in sorted(linked(spark, tools, turned), key=lambda r: -r.turn)] == [0, 1, 2]


def test_conversations_equal_sql(spark):
    from statuta.llm.queries import op7_chat

    con = duckdb.connect()
    con.sql("create view conversations as select * from '/root/testdata/sf0.001/conversations.parquet'")
    want = con.sql(chat.ORACLE)
    got = op7_chat(spark, "/root/testdata/sf0.001").select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert {r.status for r in got} >= {None, "ok", "cycle", "duplicate id", "unknown tool", "invalid arguments", "no result"} and max(r.level for r in got) >= 2
