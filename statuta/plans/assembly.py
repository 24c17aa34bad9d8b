"""Queries on answers, exam items, crawls and EU texts made from the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import answers, eu
from statuta.operators import crawl, exams
from statuta.sources import eu_bodies, sinks
from statuta.sources.corpus import read

_STATES = ["completed", "input-required", "paused", "failed", "cancelled", "skipped", "working", "queued", "", "done", "awaiting_input", "submitted"]
_COURSES = ["JUS1111", "JUS2111", "JUS3220", "JUS4213", "JUR3000", "MAT1100", "jus1111", ""]


def _pick(values: list[str], k) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), k)


def judge_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts in and out of fences, with and without a total, on each order."""
    k = F.col("o_orderkey")
    total = F.when(k % 5 > 0, F.concat(F.lit(', "total": '), (k % 5).cast("string"))).otherwise("")
    body = F.concat(F.lit('{"covered": '), (k % 7 - 1).cast("string"), total, F.lit(', "faithful": '), (k % 2 == 0).cast("string"), F.lit("}"))
    said = F.when(k % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k % 3 == 1, F.concat(F.lit("  "), body)).otherwise(F.when(k % 4 == 0, "Sorry.").otherwise(body))
    return read(spark, sf_dir, "orders").select(k.alias("id"), answers.verdict(said, F.lit(3)).alias("v")).select("id", "v.faithful", F.round("v.point_recall", 9).alias("point_recall"))


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(_pick(_STATES, F.col("o_orderkey") % len(_STATES)).alias("state"))
    return rows.groupBy(answers.state_class(F.col("state")).alias("class")).agg(F.count("*").alias("n"), F.count_distinct("state").alias("states"))


def agent_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as streams of events: a task, its assistant's turns as parts of an artifact, and a last state that one in five lacks."""
    c = read(spark, sf_dir, "conversations")
    quoted = F.to_json(F.coalesce("text", F.lit("")).cast("variant"))
    part = F.concat(F.lit('data: {"artifactUpdate":{"taskId":"t","append":true,"artifact":{"artifactId":"a","parts":[{"text":'), quoted, F.lit('}]}}}\n\n'))
    streams = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", part.alias("part"))))).alias("parts"))
    begin = F.lit('data: {"task":{"id":"t","status":{"state":"working"},"history":[{"role":"user","parts":[{"text":"x"}]},{"role":"agent","parts":[{"text":"nothing"}]}]}}\n\n')
    end = F.when(F.col("conv_id") % 5 == 0, "data: [DONE]\n").otherwise('data: {"statusUpdate":{"taskId":"t","status":{"state":"completed"}}}\n\ndata: [DONE]\n')
    body = F.concat(begin, F.array_join(F.transform("parts", lambda p: p["part"]), ""), end)
    return streams.select("conv_id", answers.response(F.lit("text/event-stream"), body).alias("r")).select("conv_id", "r.answer", "r.problem")


def exam_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of courses, and what documents lack."""
    k = F.col("o_orderkey")
    course, semester, kind = _pick(_COURSES, k % len(_COURSES)), F.when(k % 3 > 0, "h20"), F.when(k % 5 > 0, "oppgave").otherwise("")
    rows = read(spark, sf_dir, "orders").select(exams.legal_area(course).alias("area"), exams.problem(course, semester, kind).alias("problem"))
    return rows.groupBy("area", "problem").agg(F.count("*").alias("n"))


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 500 pages of a site in which page k leads to 2k + 1, 2k and 1."""
    base = "https://www.uio.no/studier/emner/jus/jus/JUS1111/"
    k = F.col("p_partkey")
    to = F.posexplode(F.array(2 * k + 1, 2 * k, F.lit(1))).alias("position", "n")
    links = read(spark, sf_dir, "part").select(F.concat(F.lit(base), k.cast("string")).alias("page"), to)
    links = links.select("page", "position", F.concat(F.lit(base), F.col("n").cast("string")).alias("href"), F.lit("").alias("text"))
    pages = crawl.visited(links, [f"{base}1"], "uio.no", ["/emner/jus/"])
    return pages.select(F.substring_index("url", "/", -1).cast("long").alias("page"), F.col("place").cast("long").alias("place"))


def journal_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal references of documents numbered by part: series, issue, date or year, page."""
    k = F.col("p_partkey")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    document = F.concat(F.lit("oj:JO"), _pick(["L", "C"], k % 2), F.lit("_"), (F.lit(1990) + k % 30).cast("string"), F.lit("_"), pad(k % 400, 3), F.lit("_R_"), pad(k % 9000 + 1, 4), F.lit("_01"))
    date = F.when(k % 4 > 0, F.concat((F.lit(1990) + k % 30).cast("string"), F.lit("-"), pad(k % 12 + 1, 2), F.lit("-"), pad(k % 28 + 1, 2)))
    return read(spark, sf_dir, "part").select(k.alias("part"), eu.journal_reference(F.when(k % 11 > 0, document).otherwise("other"), date).alias("reference"))


def eu_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part chosen of each act's parts, and the Markdown of those in the XML form."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    fill, number = F.lit(" " * 1000), n.cast("string")
    formex = F.concat(F.lit("<ACT><ARTICLE><TI.ART>Article "), number, F.lit("</TI.ART><ALINEA>Text  of\n<B>"), k.cast("string"), F.lit("</B> here</ALINEA><P>tiny</P></ARTICLE></ACT>"), fill)
    journal = F.concat(F.lit('<html><p class="oj-hd-lg">'), F.when(n == 3, "EN").otherwise("FR"), F.lit('</p><p class="oj-ti-art">1</p>'), fill)
    body = F.when((k + n) % 4 == 0, formex).when((k + n) % 4 == 1, journal).when((k + n) % 4 == 2, F.concat(F.lit("<html><TXT_TE>"), fill)).otherwise("<html>short")
    best = eu_bodies.chosen(read(spark, sf_dir, "lineitem").select(k.cast("string").alias("id"), n.alias("seq"), body.alias("body")).distinct())
    return best.select("id", "format", F.when(F.col("format") == "formex", eu_bodies.formex_body(F.col("body"))).alias("content"))


def json_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ways to write an order, of which some differ in a value."""
    k = F.col("o_orderkey")
    a = F.concat(F.lit('{"key": '), k.cast("string"), F.lit(', "list": [1, 2.50], "status": "'), F.col("o_orderstatus"), F.lit('"}'))
    b = F.concat(F.lit('{"status":"'), F.col("o_orderstatus"), F.lit('","list":[1.0,2.5'), F.when(k % 4 == 0, ",3").otherwise(""), F.lit('],"key":'), k.cast("string"), F.lit("}"))
    return read(spark, sf_dir, "orders").select(k.alias("id"), sinks.same_json(a, F.when(k % 9 > 0, b)).alias("same"))


def case_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item of each conversation: its longest later turn as the holding."""
    c = read(spark, sf_dir, "conversations")
    rows = c.select("conv_id", F.col("conv_id").alias("number"), F.col("turn").alias("pos"), F.col("text").alias("sentence"), F.when(F.col("turn") > 0, F.char_length("text")).otherwise(0).alias("score"), F.lit("").alias("summary"), F.col("role").alias("question"))
    out = exams.case_items(rows, "conv_id", "number", "hold")
    return out.select("id", "question", F.get("gold_points", F.lit(0)).alias("point"), "answerable")


QUERIES = {f.__name__: f for f in (judge_verdicts, run_states, agent_answers, exam_problems, crawl_pages, journal_references, eu_texts, json_equal, case_items)}

ORACLE_SQL = {
    "judge_verdicts": """select o_orderkey as id, case when ok then o_orderkey % 2 = 0 end as faithful,
      case when ok then round(least(1.0, greatest(o_orderkey % 7 - 1, 0)::double / case when o_orderkey % 5 > 0 then o_orderkey % 5 else 3 end), 9) end as point_recall
      from (select o_orderkey, not (o_orderkey % 3 = 2 and o_orderkey % 4 = 0) as ok from orders)""",
    "run_states": """with s as (select o_orderkey % 12 as k from orders)
      select case when k = 0 then 'completed' when k in (1, 2, 10) then 'clarification' when k in (3, 4, 5) then 'failed' when k in (6, 7, 8, 11) then 'in progress' else 'unknown' end as class, count(*) as n, count(distinct k) as states from s group by 1""",
    "agent_answers": """with a as (select conv_id, coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '') as said from conversations group by 1)
      select conv_id, case when conv_id % 5 > 0 then case when said = '' then 'nothing' else said end end as answer, case when conv_id % 5 = 0 then 'not completed: working' end as problem from a""",
    "exam_problems": """with o as (select ['privatrett', 'statsforfatningsrett', 'rettshistorie', 'strafferett', 'privatrett', '', '', ''][o_orderkey % 8 + 1] as area,
        case when o_orderkey % 8 = 7 then 'missing course' when o_orderkey % 3 = 0 then 'missing semester' when o_orderkey % 5 = 0 then 'missing kind' else '' end as problem from orders)
      select area, problem, count(*) as n from o group by all""",
    "crawl_pages": """with recursive parts as (select max(p_partkey) as n from part),
      tree as (select 1::bigint as page, 0 as depth, '' as path union all select 2 * page + 1 - x.b, depth + 1, path || x.b from tree, (values (0), (1)) x(b) where depth < 8 and page <= (select n from parts))
      select page, (row_number() over (order by depth, path) - 1)::bigint as place from tree qualify place < 500""",
    "journal_references": """select p_partkey as part, case when p_partkey % 11 = 0 then '' else 'OJ ' || ['L', 'C'][p_partkey % 2 + 1] || ' ' || case when p_partkey % 400 = 0 then y else (p_partkey % 400)::varchar end || ', '
        || case when p_partkey % 4 > 0 then (p_partkey % 28 + 1) || '.' || (p_partkey % 12 + 1) || '.' || y else y end || ', p. ' || (p_partkey % 9000 + 1) end as reference
      from (select *, (1990 + p_partkey % 30)::varchar as y from part)""",
    "eu_texts": """with l as (select distinct l_orderkey as k, l_linenumber as n, (l_orderkey + l_linenumber) % 4 as f from lineitem where (l_orderkey + l_linenumber) % 4 < 3),
      b as (select * from l qualify row_number() over (partition by k order by case when f = 1 and n = 3 then 0 when f < 2 then 1 else 2 end, n) = 1)
      select k::varchar as id, ['formex', 'oj', 'legacy'][f + 1] as format, case when f = 0 then '## Article ' || n || chr(10) || chr(10) || 'Text of ' || k || ' here' end as content from b""",
    "json_equal": "select o_orderkey as id, o_orderkey % 9 > 0 and o_orderkey % 4 > 0 as same from orders",
    "case_items": """with s as (select conv_id, turn, text, role, case when turn > 0 then length(text) else 0 end as score from conversations),
      h as (select conv_id, min_by(role, turn) as question, case when max(score) > 0 then trim(max_by(text, (score, -turn))) else '' end as point from s group by 1)
      select 'hold-' || lpad(conv_id::varchar, 5, '0') as id, question, nullif(point, '') as point, point <> '' as answerable from h""",
}
