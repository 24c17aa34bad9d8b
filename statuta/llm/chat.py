"""Chat formatting: tool calls linked with their results, ordered topologically, validated and written as canonical JSON.

``parse`` reads messages whose text is a JSON object, blanks around it or not: ``{"tool_calls": [{"id", "name", "arguments"}]}`` holds calls,
``{"tool_call_id", "content"}`` a result; any other text is plain. ``link`` hash-joins calls and results by conversation and
identifier, checks each call's arguments against the schema of its tool, orders a conversation so that a call precedes its
result and follows the results that its arguments name (``{"$ref": id}``), and gives one canonical JSON line for each message:
keys sorted at every depth, no blanks, absent values left out.

Order: a message stands at its turn, but not before what it depends on: a result not before its call, a call not before the results
that its arguments name, wherever their turns are. Of messages at one place the ``level``, the steps of dependencies among them,
says which come first. ``position`` counts the messages of the conversation that come before, equal for messages equal in place
and level; it comes from counts by place, so no conversation's messages need to meet in one task. Conversations in which every
name points back to results that are there already keep their turns. In the others place and level run along the references: a
message that names one message is a function of it, and such functions are joined by doubling, so a chain of any length takes
rounds in proportion to its logarithm; messages that name several follow in Kahn's order. A message on or behind a cycle of
references stands at its turn, at level 0.

Status of a call: ``ok``, ``no result``, ``invalid arguments``, ``unknown tool``, ``duplicate id`` (all but the first of an id)
or ``cycle``; of a result: ``ok`` or ``no call``; null for plain messages. Defined results: null conversation, turn, role and
text are values like others and match nothing as identifiers; repeated rows are kept; extra columns are ignored. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, table, words_count

_MESSAGE = "tool_calls array<struct<id string, name string, arguments variant>>, tool_call_id string, content string"


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, calls (array of id, name, arguments as JSON), result_of, content of every message."""
    found = F.when(F.ltrim(F.col("text"), F.lit(" \t\r\n")).startswith("{"), F.from_json("text", _MESSAGE, {"mode": "PERMISSIVE"}))
    calls = F.transform(F.col("__m.tool_calls"), lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), F.to_json(c["arguments"]).alias("arguments")))
    rows = messages.select("conv_id", "turn", "role", "text", found.alias("__m"))
    return rows.select("conv_id", "turn", "role", "text", F.filter(calls, lambda c: c["id"].isNotNull()).alias("calls"), F.col("__m.tool_call_id").alias("result_of"), F.col("__m.content").alias("content"))


def canonical(json: Column) -> Column:
    """JSON with sorted keys and no blanks: a variant keeps its fields in order; null where it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def _kind_of(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer").when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "number").otherwise("null")
    )


def validated(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """calls with __known and __valid. tools: name, params (array of name, type, required); other parameters are not allowed."""
    own = tools.select(F.col("name").alias("__tool"), F.col("params").alias("__params"))
    given = F.from_json("arguments", "map<string, variant>")
    rows = calls.join(own, F.col("name") == F.col("__tool"), "left").withColumn("__given", given)

    def fits(p: Column) -> Column:
        value, kind = F.element_at("__given", p["name"]), _kind_of(F.element_at("__given", p["name"]))
        return F.when(value.isNull(), ~p["required"]).otherwise((kind == p["type"]) | ((p["type"] == "number") & (kind == "integer")))

    names = F.transform("__params", lambda p: p["name"])
    valid = F.col("__given").isNotNull() & F.forall("__params", fits) & (F.size(F.array_except(F.map_keys("__given"), names)) == 0)
    return rows.withColumns({"__known": F.col("__tool").isNotNull(), "__valid": F.coalesce(valid, F.lit(False))}).drop("__tool", "__params", "__given")


def references(arguments: Column) -> Column:
    """The identifiers that arguments name as {"$ref": id}, at any depth: found in canonical JSON and decoded as JSON strings."""
    quoted = F.regexp_extract_all(canonical(arguments), F.lit(r'"\$ref":("(?:[^"\\]|\\.)*")'), F.lit(1))
    return F.from_json(F.concat(F.lit("["), F.array_join(F.array_distinct(quoted), ","), F.lit("]")), "array<string>")


# How place and level of a call follow from those (p, l) of a call that it names: (p, l + s) if p is c or later, else (c, k).
# c is its own turn or the turn of the result, if that is later; such functions, one after the other, are of the same kind.


def _after(first: str, then: str) -> dict[str, Column]:
    """c, k, s of a function (columns that begin with first) followed by another (then)."""
    c1, k1, s1, c2, k2, s2 = (F.col(f"{x}{name}") for x in (first, then) for name in ("c", "k", "s"))
    return {"c": F.greatest(c1, c2), "k": F.when(c1 >= c2, k1 + s2).otherwise(k2), "s": s1 + s2}


def _applied() -> dict[str, Column]:
    """place, level from c, k, s and __p, __l of what is named."""
    stays = F.col("__p") >= F.col("c")
    return {"__at": F.when(stays, F.col("__p")).otherwise(F.col("c")), "__level": F.when(stays, F.col("__l") + F.col("s")).otherwise(F.col("k"))}


def _doubled(single: DataFrame) -> DataFrame:
    """conv_id, __n, __ref, c, k, s of messages that name one message, as functions of the first on their way that names none or several;
    those that lead into a cycle still name one of their kind after as many rounds as the longest way takes."""
    longest = single.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        on = single.select("conv_id", F.col("__n").alias("__ref"), F.col("__ref").alias("__next"), *(F.col(x).alias(f"n_{x}") for x in "cks"))
        both = single.join(on, ["conv_id", "__ref"], "left").withColumnsRenamed({x: f"o_{x}" for x in "cks"})
        goes = F.col("__next").isNotNull()
        new = both.select("conv_id", "__n", F.coalesce("__next", "__ref").alias("__ref"), *(F.when(goes, f).otherwise(F.col(f"o_{x}")).alias(x) for x, f in _after("n_", "o_").items()))
        new = table(new, "ways")
        drop(single)
        single = new
    return single


def _placed(calls: DataFrame, owners: DataFrame, results: DataFrame) -> DataFrame:
    """conv_id, __n, __level, __at of call messages that refer or are referred to where a reference points to what isn't there yet; null on
    or behind a cycle."""
    edges = calls.select("conv_id", "__n", "turn", F.explode(references(F.col("arguments"))).alias("id"))
    edges = edges.join(owners.select("conv_id", "id", F.col("__first.turn").alias("__ref_turn"), F.col("__first.__n").alias("__ref")), ["conv_id", "id"]).join(results, ["conv_id", "id"], "left")
    edges = table(edges.groupBy("conv_id", "__n", "__ref").agg(F.min("turn").alias("turn"), F.min("__ref_turn").alias("__ref_turn"), F.max("__answered").alias("__answered")), "refs")
    late = edges.where(F.greatest("__ref_turn", "__answered") >= F.col("turn")).select("conv_id").distinct()
    answered, turn = F.col("__answered"), F.col("turn")
    function = [F.greatest(turn, answered).alias("c"), F.coalesce(answered >= turn, F.lit(False)).cast("int").alias("k"), F.when(answered.isNull(), 1).otherwise(2).alias("s")]
    degree = edges.groupBy("conv_id", "__n").agg(F.count("*").alias("__names"))
    own = table(edges.join(late, "conv_id", "left_semi").join(degree, ["conv_id", "__n"]).select("conv_id", "__n", "__ref", "__ref_turn", "__names", *function), "late")
    drop(edges)
    nodes = own.select("conv_id", F.col("__n").alias("__ref")).distinct()
    roots = own.select("conv_id", "__ref", "__ref_turn").distinct().join(nodes, ["conv_id", "__ref"], "left_anti")
    done = table(roots.select("conv_id", F.col("__ref").alias("__n"), F.col("__ref_turn").alias("__at"), F.lit(0).alias("__level")), "placed")
    ways = _doubled(table(own.where("__names = 1").select("conv_id", "__n", "__ref", "c", "k", "s"), "ways"))

    # Messages that name several: each name leads to a root or to another such message.
    on = ways.select("conv_id", F.col("__n").alias("__ref"), F.col("__ref").alias("__next"), *(F.col(x).alias(f"n_{x}") for x in "cks"))
    several = own.where("__names > 1").withColumnsRenamed({x: f"o_{x}" for x in "cks"}).join(on, ["conv_id", "__ref"], "left")
    goes = F.col("__next").isNotNull()
    several = table(several.select("conv_id", "__n", "__names", F.coalesce("__next", "__ref").alias("__to"), *(F.when(goes, f).otherwise(F.col(f"o_{x}")).alias(x) for x, f in _after("n_", "o_").items())), "several")
    best = F.struct("__at", "__level")
    front, all_done, met = done, [done], None
    while several.limit(1).count() and front.limit(1).count():
        value = front.select("conv_id", F.col("__n").alias("__to"), F.col("__at").alias("__p"), F.col("__level").alias("__l"))
        new = several.join(value, ["conv_id", "__to"]).withColumns(_applied()).groupBy("conv_id", "__n", "__names").agg(F.count("*").alias("__met"), F.max(best).alias("__best"))
        if met is not None:
            new = met.union(new).groupBy("conv_id", "__n", "__names").agg(F.sum("__met").alias("__met"), F.max("__best").alias("__best"))
        new = table(new, "met")
        front = table(new.where("__met = __names").select("conv_id", "__n", "__best.__at", "__best.__level"), "placed")
        all_done.append(front)
        met = new.where("__met < __names")
    for part in all_done[1:]:
        done = done.union(part)
    value = done.select("conv_id", F.col("__n").alias("__ref"), F.col("__at").alias("__p"), F.col("__level").alias("__l"))
    alone = ways.join(value, ["conv_id", "__ref"], "left").withColumns(_applied()).select("conv_id", "__n", *(F.when(F.col("__p").isNotNull(), F.col(c)).alias(c) for c in ("__at", "__level")))
    open_ = several.select("conv_id", "__n").distinct().join(done.select("conv_id", "__n"), ["conv_id", "__n"], "left_anti")
    out = done.select("conv_id", "__n", "__at", "__level").union(alone).union(open_.select("conv_id", "__n", F.lit(None).cast(done.schema["__at"].dataType), F.lit(None).cast("int")))
    return table(out, "order")


def link(parsed: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, turn, role, call_id, linked_turn, status, level, position, json of every message of parse().

    A message of several calls gets the worst of their statuses and the first of their identifiers.
    """
    rows = table(parsed.withColumn("__n", F.xxhash64("conv_id", "turn", "role", "text")), "messages")
    calls = rows.where(F.size("calls") > 0).select("conv_id", "turn", "__n", F.posexplode("calls").alias("__k", "__c")).select("conv_id", "turn", "__n", "__k", "__c.*")
    owners = calls.groupBy("conv_id", "id").agg(F.min(F.struct("turn", "__k", "__n")).alias("__first"))
    results = rows.where(F.col("result_of").isNotNull()).groupBy("conv_id", F.col("result_of").alias("id")).agg(F.min("turn").alias("__answered"))
    order = _placed(calls, owners, results)
    judged = validated(calls, tools).join(owners, ["conv_id", "id"], "left").join(results, ["conv_id", "id"], "left")
    judged = judged.join(order.withColumn("__in", F.lit(True)), ["conv_id", "__n"], "left")
    status = (
        F.when(F.struct("turn", "__k", "__n") != F.col("__first"), "duplicate id").when(F.col("__in") & F.col("__level").isNull(), "cycle")
        .when(~F.col("__known"), "unknown tool").when(~F.col("__valid"), "invalid arguments").when(F.col("__answered").isNull(), "no result").otherwise("ok")
    )
    judged = table(judged.withColumn("__status", status), "calls")
    worst = F.max(F.when(F.col("__status") != "ok", F.col("__status")))
    per = judged.groupBy(F.col("conv_id").alias("__cc"), F.col("turn").alias("__ct"), F.col("__n").alias("__cn")).agg(
        F.coalesce(worst, F.lit("ok")).alias("__call_status"), F.min_by("id", "__k").alias("__call"), F.min("__answered").alias("__answer"),
        F.coalesce(F.max("__level"), F.lit(0)).alias("__call_level"), F.max("__at").alias("__call_at"),
    )
    asked = owners.select("conv_id", "id", "__first", F.col("__first.turn").alias("__asked"), F.col("__first.__n").alias("__n")).join(order, ["conv_id", "__n"], "left")
    asked = asked.select(F.col("conv_id").alias("__ac"), F.col("id").alias("__ai"), "__asked", F.coalesce("__level", F.lit(0)).alias("__asked_level"), F.greatest("__first.turn", "__at").alias("__asked_at"))
    same = F.col("conv_id").eqNullSafe(F.col("__cc")) & F.col("turn").eqNullSafe(F.col("__ct")) & (F.col("__n") == F.col("__cn"))
    out = rows.join(per, same, "left").join(asked, (F.col("conv_id") == F.col("__ac")) & (F.col("result_of") == F.col("__ai")), "left")
    out = out.withColumns({
        "call_id": F.coalesce("result_of", "__call"),
        "linked_turn": F.coalesce("__asked", "__answer"),
        "status": F.coalesce("__call_status", F.when(F.col("result_of").isNotNull(), F.when(F.col("__ai").isNull(), "no call").otherwise("ok"))),
        "__place": F.greatest("turn", "__asked_at", "__call_at"),
    })
    # A result one level after its call if both stand at one place; a call's level counts where it still stands at the place it was found for.
    stands = F.when(F.col("__call_at").isNull() | (F.col("__place") == F.col("__call_at")), F.col("__call_level")).otherwise(0)
    follows = F.when(F.col("__place") > F.col("__asked_at"), 0).otherwise(F.col("__asked_level") + 1)
    out = out.withColumn("level", F.coalesce(F.when(F.col("__call_level").isNotNull(), stands), F.when(F.col("__asked_at").isNotNull(), follows), F.lit(0)).cast("long"))
    key = ["conv_id", "__place", "level"]
    counts = out.groupBy(*key).agg(F.count("*").alias("__same"))
    before = F.coalesce(F.sum("__same").over(Window.partitionBy("conv_id").orderBy("__place", "level").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = counts.withColumn("position", before).select(*(F.col(c).alias(f"__p{k}") for k, c in enumerate(key)), "position")
    out = out.join(places, F.col("conv_id").eqNullSafe(F.col("__p0")) & F.col("__place").eqNullSafe(F.col("__p1")) & F.col("level").eqNullSafe(F.col("__p2")))
    listed = F.transform("calls", lambda c: F.concat(F.lit('{"arguments":'), F.coalesce(canonical(c["arguments"]), F.lit("null")), F.lit(',"id":'), F.to_json(c["id"].cast("variant")), F.lit(',"name":'), F.coalesce(F.to_json(c["name"].cast("variant")), F.lit("null")), F.lit("}")))
    said = F.when(F.col("result_of").isNotNull(), F.col("content")).when(F.size("calls") > 0, F.lit(None)).otherwise(F.col("text"))
    fields = [("content", F.to_json(said.cast("variant"))), ("role", F.to_json(F.col("role").cast("variant"))), ("tool_call_id", F.to_json(F.col("result_of").cast("variant"))), ("tool_calls", F.when(F.size("calls") > 0, F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]"))))]
    json = F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{k}":'), v) for k, v in fields)), F.lit("}"))
    return out.select("conv_id", "turn", "role", "call_id", "linked_turn", "status", "level", "position", json.alias("json"))


PARAMS = "array<struct<name string, type string, required boolean>>"
TOOLS = [("ask", [("text", "string", True), ("after", "object", False), ("before", "object", False)]), ("tell", [("text", "string", True), ("after", "object", False), ("words", "integer", True)])]


def as_messages(conversations: DataFrame) -> DataFrame:
    """Plain conversations as messages of parse(): a user's turn is a call, the assistant's turn after it is the result.

    What a conversation's calls look like follows from conv_id modulo 7. 0, 5 and 6: each names the result of the call before it,
    6 also of the one before that. 1: each names the result of the call after it. 2: as 0, but the first names the last's too, a
    cycle if there are two. 3: as 0, with identifiers that begin again after two calls. 4: calls of an unknown tool, or without
    text. Texts of even length are told with their words counted, others asked; other turns, and null ones, stay as they are.
    """
    conv, turn, kind = F.col("conv_id"), F.col("turn"), F.pmod("conv_id", F.lit(7))
    users = conversations.where("role = 'user'").groupBy(F.col("conv_id").alias("__c")).agg(F.min("turn").alias("__first"), F.max("turn").alias("__last"))
    quoted = lambda x: F.to_json(x.cast("variant"))
    name = lambda t: F.concat(F.lit("c\u00e9\\"), conv.cast("string"), F.lit("-"), F.when(kind == 3, F.pmod(t, F.lit(4))).otherwise(t).cast("string"))
    ref = lambda t: F.concat(F.lit('{"$ref":'), quoted(name(t)), F.lit("}"))
    told = F.pmod(F.char_length("text"), F.lit(2)) == 0
    after = (
        F.when(kind == 1, F.when(turn < F.col("__last"), ref(turn + 2)))
        .when((kind == 2) & (turn == F.col("__first")), F.when(turn < F.col("__last"), ref(F.col("__last"))))
        .when((kind == 6) & (turn - 4 >= F.col("__first")), F.concat(F.lit('{"both":['), ref(turn - 2), F.lit(","), ref(turn - 4), F.lit("]}")))
        .when((turn - 2 >= F.col("__first")) & (kind != 4), ref(turn - 2))
    )
    said = F.when((kind != 4) | told, quoted(F.col("text")))
    arguments = F.concat_ws(", ", F.concat(F.lit('"text" : '), said), F.concat(F.lit('"after":'), after), F.when(told, F.concat(F.lit('"words":'), words_count(F.col("text")).cast("string"))))
    tool = F.when((kind == 4) & told, "shout").when(told, "tell").otherwise("ask")
    call = F.concat(F.lit(' {"tool_calls":[{"name":"'), tool, F.lit('","id":'), quoted(name(turn)), F.lit(',"arguments":{'), arguments, F.lit("}}]}"))
    result = F.concat(F.lit('{"tool_call_id":'), quoted(name(turn - 1)), F.lit(',"content":'), quoted(F.col("text")), F.lit("}"))
    out = conversations.join(users, conv == F.col("__c"), "left")
    text = F.when((F.col("role") == "user") & F.col("text").isNotNull(), call).when((F.col("role") == "assistant") & F.col("text").isNotNull(), result)
    return out.select("conv_id", "turn", "role", F.coalesce(text, F.col("text")).alias("text"))


ORACLE = r"""
with recursive spread as (
  select conv_id, turn, role, text, conv_id % 7 as kind, length(text) % 2 = 0 as told,
    min(turn) filter (where role = 'user') over (partition by conv_id) as first_turn, max(turn) filter (where role = 'user') over (partition by conv_id) as last_turn
  from conversations),
m as (
  select *, 'cé\' || conv_id || '-' || case when kind = 3 then ((turn % 4) + 4) % 4 else turn end as own,
    'cé\' || conv_id || '-' || case when kind = 3 then ((turn + 3) % 4) else turn - 1 end as before,
    role = 'user' and text is not null as calls, role = 'assistant' and text is not null as answers from spread),
refs as (
  select conv_id, turn, unnest(case
      when kind = 1 then case when turn < last_turn then [turn + 2] end
      when kind = 2 and turn = first_turn then case when turn < last_turn then [last_turn] end
      when kind = 6 and turn - 4 >= first_turn then [turn - 2, turn - 4]
      when kind <> 4 and turn - 2 >= first_turn then [turn - 2] end) as to_turn, kind from m where calls),
owners as (
  select conv_id, own, min(turn) as turn from m where calls group by 1, 2),
answered as (
  select conv_id, before as own, min(turn) as answered from m where answers group by 1, 2),
edges as (
  select distinct r.conv_id, r.turn, o.turn as ref, a.answered
  from refs r join owners o on r.conv_id = o.conv_id and o.own = 'cé\' || r.conv_id || '-' || case when r.kind = 3 then r.to_turn % 4 else r.to_turn end
  left join answered a on a.conv_id = o.conv_id and a.own = o.own),
looped as (
  select distinct conv_id, turn from edges where conv_id % 7 = 2 and conv_id in (select conv_id from edges group by 1 having max(ref) > min(turn))
  union select e.conv_id, e.turn from edges e where e.conv_id % 7 = 3 and e.turn = e.ref),
paths as (
  select conv_id, turn, 0 as level, turn as place from owners o
  where (conv_id, turn) not in (select conv_id, turn from edges) and (conv_id, turn) not in (select conv_id, turn from looped)
  union
  select conv_id, turn, case when turn > there then 0 when answered is null then level + 1 when answered > place then 1 else level + 2 end, greatest(turn, there)
  from (select e.conv_id, e.turn, p.level, p.place, e.answered, greatest(p.place, e.answered) as there
    from paths p join edges e on p.conv_id = e.conv_id and p.turn = e.ref where (e.conv_id, e.turn) not in (select conv_id, turn from looped))),
placed as (
  select conv_id, turn, max({'p': place, 'l': level}).l as level, max(place) as place from paths group by 1, 2),
j as (
  select m.*, o.turn as owner, n.answered, a.turn as asked,
    case when m.calls then coalesce(p.level, 0) when m.turn > greatest(a.turn, q.place) then 0 when a.turn is not null then coalesce(q.level, 0) + 1 else 0 end as level,
    greatest(m.turn, p.place, a.turn, q.place) as place, (m.conv_id, m.turn) in (select conv_id, turn from looped) as cyclic
  from m left join owners o on m.calls and m.conv_id = o.conv_id and m.own = o.own
  left join answered n on m.calls and m.conv_id = n.conv_id and m.own = n.own
  left join owners a on m.answers and m.conv_id = a.conv_id and m.before = a.own
  left join placed p on m.calls and m.conv_id = p.conv_id and m.turn = p.turn
  left join placed q on a.conv_id = q.conv_id and a.turn = q.turn),
ref_json as (
  select *, '{"$ref":"cé\\' || conv_id || '-' as ref, case when kind = 3 then ((turn - 2) % 4) else turn - 2 end as back from j)
select conv_id, turn, role, case when calls then own when answers then before end as call_id,
  case when calls then answered when answers then asked end as linked_turn,
  case when calls then case when owner <> turn then 'duplicate id' when cyclic then 'cycle' when kind = 4 and told then 'unknown tool'
      when kind = 4 then 'invalid arguments' when answered is null then 'no result' else 'ok' end
    when answers then case when asked is null then 'no call' else 'ok' end end as status,
  level::bigint as level, (rank() over (partition by conv_id order by place, level) - 1)::bigint as position,
  case when calls then '{"role":"user","tool_calls":[{"arguments":{' || concat_ws(',',
      '"after":' || case when kind = 1 then case when turn < last_turn then ref || (turn + 2) || '"}' end
        when kind = 2 and turn = first_turn then case when turn < last_turn then ref || last_turn || '"}' end
        when kind = 6 and turn - 4 >= first_turn then '{"both":[' || ref || (turn - 2) || '"},' || ref || (turn - 4) || '"}]}'
        when kind <> 4 and turn - 2 >= first_turn then ref || back || '"}' end,
      case when kind <> 4 or told then '"text":' || to_json(text)::varchar end,
      case when told then '"words":' || len(regexp_extract_all(text, '[^ 	-
]+')) end)
      || '},"id":"cé\\' || substr(own, 4) || '","name":"' || case when kind = 4 and told then 'shout' when told then 'tell' else 'ask' end || '"}]}'
    when answers then '{"content":' || to_json(text)::varchar || ',"role":"assistant","tool_call_id":"cé\\' || substr(before, 4) || '"}'
    else '{"content":' || to_json(text)::varchar || ',"role":' || to_json(role)::varchar || '}' end as json
from ref_json
"""
