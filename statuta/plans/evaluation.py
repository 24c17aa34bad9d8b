"""Queries on evaluation sets and scores, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.functions import refs
from statuta.operators import evals, sampling
from statuta.sources import corpus
from statuta.sources.corpus import read


def _laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws named after the parts: the brand in brackets, the type as short title."""
    p = read(spark, sf_dir, "part")
    name = F.when(F.col("p_partkey") % 13 == 0, F.concat(F.lit("Lov om endring av "), "p_name")).otherwise(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    return p.select(F.concat(F.lit("lov/"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("key"), F.col("p_type").alias("short_title"), name.alias("name"))


def abbreviation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evals.abbreviations(_laws(spark, sf_dir))


def exam_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References in answers of several lines: after names and keys on the line, inside a link, after a hyphen, under a heading line,
    after words that name no act, and without an act."""
    o = read(spark, sf_dir, "orders")
    n = lambda m: (F.col("o_orderkey") % m).cast("string")
    content = F.concat(
        F.lit("Etter strl. § "), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit(" og lov/2000-01-01-"), n(50), F.lit(" § 2-3\r\n"),
        F.when(F.col("o_orderkey") % 2 == 0, "Om avtaleloven:\n\n§ 36 gjelder").otherwise("Fritt.\n\n§ 36 gjelder"),
        F.lit("\nSe [denne](/objects/forskrift/2006-02-17-"), n(7), F.lit(") § 4 bokstav a, jf. § 5.\nJan Mayen-STRL § "), n(11), F.lit("-1a, sktstrl § 8 og lov om avtaler § 9.\nAvtalen § 1 og loven § 2."),
    )
    known = spark.createDataFrame([("strl", "lov/2005-05-20-28"), ("avtaleloven", "lov/1918-05-31-4"), ("lov om avtaler", "lov/1918-05-31-4"), ("mayen-x", "lov/1-x")], "token string, key string")
    return evals.exam_refs(o.select(F.col("o_orderkey").alias("doc_id"), content.alias("content")), known)


def candidate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of the references that the answers name."""
    p = corpus.paragraphs(spark, sf_dir)
    acts = corpus.acts(spark, sf_dir).where("ord % 10 <> 0")
    index = p.select(F.col("law_ref_id").alias("act"), refs.paragraph_number(F.col("paragraph_num")).alias("token"))
    rows = corpus.acts(spark, sf_dir).select(F.col("key").alias("act"), F.explode(F.array(F.lit("1"), F.lit("7"), F.lit("9"))).alias("token"))
    out = evals.resolve_candidates(rows, acts, index)
    return out.groupBy(F.coalesce("reason", F.lit("resolved")).alias("reason")).agg(F.count("*").alias("n"))


def pair_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("source", F.when(F.col("lang") == "fr", "nb").otherwise(F.col("lang")).alias("language"), F.col("doc_id").alias("id"))
    return evals.pair(d.where("id % 2 = 0"), d.where("id % 2 = 1"), ["source"])


def retrieval_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty numbered questions on provisions drawn by hash order."""
    p = corpus.paragraphs(spark, sf_dir).groupBy("key").agg(F.min("law_ref_id").alias("law"), F.min("paragraph_num").alias("num"), F.min("section_id").alias("section"))
    drawn = sampling.seeded(p, "key", 40, "retrieval")
    ref = refs.paragraph_ref(F.col("law"), F.col("num"), F.col("section"))
    number = F.row_number().over(Window.orderBy("key"))
    return drawn.select(F.concat(F.lit("ret-"), F.lpad(number.cast("string"), 5, "0")).alias("id"), F.concat(F.lit("Hva sier "), "num", F.lit(" i "), "law", F.lit("?")).alias("question"), ref.alias("gold_ref"), F.col("key").alias("doc_ref"))


def synthetic_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answerable items on drawn provisions, then unanswerable ones: a made-up section of a real act, or a made-up act."""
    yes, no = sampling.split_answerable(50, 0.7)
    p = corpus.paragraphs(spark, sf_dir).groupBy("key").agg(F.min("law_ref_id").alias("law"), F.min("paragraph_num").alias("num"), F.min("section_id").alias("section"))
    n = F.row_number().over(Window.orderBy("key"))
    good = sampling.seeded(p, "key", yes, "synthetic").select(n.alias("n"), refs.paragraph_ref(F.col("law"), F.col("num"), F.col("section")).alias("ref"), F.lit(True).alias("answerable"))
    acts = sampling.seeded(corpus.acts(spark, sf_dir).select("key"), "key", no, "acts").select((F.row_number().over(Window.orderBy("key")) - 1).alias("k"), "key")
    bad = acts.select((F.col("k") + yes + 1).cast("int").alias("n"), F.when(F.col("k") % 2 == 0, F.concat("key", F.lit("#§ 999-"), F.col("k").cast("string"))).otherwise(F.concat(F.lit("lov/2099-01-01-"), F.col("k").cast("string"))).alias("ref"), F.lit(False).alias("answerable"))
    return good.union(bad).select(F.concat(F.lit("syn-"), F.lpad(F.col("n").cast("string"), 5, "0")).alias("id"), "ref", "answerable")


def gold_holding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's longest turn after the first, else its first."""
    c = read(spark, sf_dir, "conversations")
    score = F.when((F.col("turn") > 0) & (F.col("conv_id") % 3 != 0), F.char_length("text")).otherwise(0)
    rows = c.select("conv_id", F.col("turn").alias("pos"), F.col("text").alias("sentence"), score.alias("score"), F.col("text").alias("summary"))
    return evals.gold_holding(rows, "conv_id")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").withColumn("act", F.concat(F.lit("lov/"), (F.col("l_suppkey") % 7).cast("string")))
    ref = F.concat("act", F.lit("#§"), F.col("l_linenumber").cast("string"))
    rows = l.select("l_orderkey", ref.alias("ref"), (F.col("l_partkey") % 3 != 0).alias("is_cited"), (F.col("l_partkey") % 4 != 0).alias("is_gold"), (F.col("l_partkey") % 5 != 0).alias("is_known"))
    put = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("ref"))))
    return rows.groupBy("l_orderkey").agg(put(F.col("is_cited")).alias("cited"), put(F.col("is_gold")).alias("gold"), put(F.col("is_cited") & F.col("is_known")).alias("resolved"))


def citation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = evals.scores(_items(spark, sf_dir))
    return s.select("l_orderkey", F.col("hallucinated").cast("long").alias("hallucinated"), *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "resolution_rate")))


def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means overall, by priority and by status in one pass."""
    s = evals.scores(_items(spark, sf_dir)).join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    r = s.select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).otherwise("").alias("area"), F.col("o_orderstatus").alias("difficulty"), (F.col("o_orderkey") % 8 != 0).alias("answerable"),
        "f1", "recall", "precision", "resolution_rate", F.when(F.col("o_orderkey") % 3 == 0, F.col("recall")).alias("point_recall"), (F.col("hallucinated") == 0).alias("refusal_correct"),
    )
    return evals.report(r).select("grouping", "items", "refusals", "refusals_correct", *(F.round(c, 6).alias(c) for c in ("f1", "recall", "precision", "resolution_rate", "point_recall")))


QUERIES = {f.__name__: f for f in (abbreviation_map, exam_refs, candidate_reasons, pair_documents, retrieval_items, synthetic_items, gold_holding, citation_scores, eval_report)}

_SCORES = """rows as (select l_orderkey, 'lov/' || (l_suppkey % 7) || '#§' || l_linenumber as ref, 'lov/' || (l_suppkey % 7) as act, l_partkey % 3 <> 0 as c, l_partkey % 4 <> 0 as g, l_partkey % 5 <> 0 as k from lineitem),
  cited as (select distinct l_orderkey, ref, act from rows where c), gold as (select distinct l_orderkey, ref, act from rows where g),
  known as (select l_orderkey, count(distinct ref) as n from rows where c and k group by 1),
  best_c as (select c.l_orderkey, c.ref, max(case when g.ref = c.ref then 1.0 when g.act = c.act then 0.5 else 0.0 end) as s from cited c left join gold g on c.l_orderkey = g.l_orderkey group by 1, 2),
  best_g as (select g.l_orderkey, g.ref, max(case when g.ref = c.ref then 1.0 when g.act = c.act then 0.5 else 0.0 end) as s from gold g left join cited c on c.l_orderkey = g.l_orderkey group by 1, 2),
  p as (select l_orderkey, avg(s)::double as p, count(*) as n from best_c group by 1), r as (select l_orderkey, avg(s)::double as r from best_g group by 1),
  m as (select o.l_orderkey, coalesce(p, 0.0) as precision, coalesce(r, 1.0) as recall, coalesce(p.n, 0) - coalesce(known.n, 0) as hallucinated,
    case when p.n is null then 1.0 else coalesce(known.n, 0) / p.n end as resolution_rate
    from (select distinct l_orderkey from lineitem) o left join p using (l_orderkey) left join r using (l_orderkey) left join known using (l_orderkey)),
  scored as (select *, case when precision + recall = 0 then 0.0 else 2 * precision * recall / (precision + recall) end as f1 from m)"""

ORACLE_SQL = {
    "abbreviation_map": r"""with laws as (select 'lov/' || lpad(p_partkey::varchar, 7, '0') as key, p_type as st, p_name || ' (' || p_brand || ')' as name, p_brand as b, p_name as n from part where p_partkey % 13 <> 0),
      t as (select key, trim(lower(trim(regexp_replace(x, '\s+', ' ', 'g'))), ' .') as token, 2 as rank from (select key, unnest([st, name, b]) as x from laws)
        union all select key, trim(lower(trim(regexp_replace(x, '\s+', ' ', 'g'))), ' .'), 1 from (select key, unnest(regexp_split_to_array(st, '[–—()\[\],-]')) as x from laws
          union all select key, unnest(regexp_split_to_array(name, '[–—()\[\],-]')) from laws) where trim(x) <> '')
      select token, key from t where length(token) >= 3 and token not in (select unnest(string_split('lov loven lova lovene avtale avtalen avtalene forskrift forskriften forskrifta konvensjon konvensjonen direktiv direktivet paragraf paragrafen kapittel kapittelet ledd stk nr mv m.v mfl m.fl jf se og om i av for den det de som til med på er innledning formål virkeområde', ' ')))
      qualify row_number() over (partition by token order by rank desc, key) = 1""",
    "exam_refs": """with o as (select o_orderkey as k from orders), r as (
      select k, unnest([
        {'l': 0, 'r': 0, 'a': 'lov/2005-05-20-28', 't': (k % 9 + 1)::varchar}, {'l': 0, 'r': 1, 'a': 'lov/2000-01-01-' || k % 50, 't': '2-3'},
        {'l': 3, 'r': 0, 'a': case when k % 2 = 0 then 'lov/1918-05-31-4' end, 't': '36'},
        {'l': 4, 'r': 0, 'a': 'forskrift/2006-02-17-' || k % 7, 't': '4'}, {'l': 4, 'r': 1, 'a': 'forskrift/2006-02-17-' || k % 7, 't': '5'},
        {'l': 5, 'r': 0, 'a': 'lov/2005-05-20-28', 't': k % 11 || '-1a'}, {'l': 5, 'r': 1, 'a': 'lov/2005-05-20-28', 't': '8'}, {'l': 5, 'r': 2, 'a': 'lov/2005-05-20-28', 't': '9'}]) as x from o)
      select k as doc_id, x.l as line_no, x.r as ref_no, x.a as act, x.t as token from r where x.a is not null""",
    "candidate_reasons": f"""with {corpus.SQL}, c as (select key, ord, t from acts, (values (1), (7), (9)) v(t)),
      j as (select case when c.ord % 10 = 0 then 'unknown act' when p.law_ref_id is null then 'unknown section' else 'resolved' end as reason from c left join (select distinct law_ref_id, position from paragraphs) p on p.law_ref_id = c.key and p.position = c.t)
      select reason, count(*) as n from j group by 1""",
    "pair_documents": """with d as (select source, case when lang = 'fr' then 'nb' else lang end as language, doc_id as id from documents),
      p as (select source, id as paper, language as paper_language from d where id % 2 = 0 qualify row_number() over (partition by source order by language <> 'nb', language, id) = 1)
      select p.source, paper, paper_language, g.id as guide, g.language as guide_language from p left join (select * from d where id % 2 = 1) g on p.source = g.source
      qualify row_number() over (partition by p.source order by coalesce(g.language <> p.paper_language, true), g.language <> 'nb', g.language, g.id) = 1""",
    "retrieval_items": f"""with {corpus.SQL}, p as (select key, min(law_ref_id) as law, min(position) as n from paragraphs group by 1), d as (select * from p order by md5('retrieval' || key), key limit 40)
      select 'ret-' || lpad((row_number() over (order by key))::varchar, 5, '0') as id, 'Hva sier § ' || n || ' i ' || law || '?' as question, law || '#§' || n as gold_ref, key as doc_ref from d""",
    "synthetic_items": f"""with {corpus.SQL}, p as (select key, min(law_ref_id) as law, min(position) as n from paragraphs group by 1), d as (select * from p order by md5('synthetic' || key), key limit 35),
      a as (select key, row_number() over (order by key) - 1 as k from (select key from acts order by md5('acts' || key), key limit 15))
      select 'syn-' || lpad((row_number() over (order by key))::varchar, 5, '0') as id, law || '#§' || n as ref, true as answerable from d
      union all select 'syn-' || lpad((k + 36)::varchar, 5, '0'), case when k % 2 = 0 then key || '#§ 999-' || k else 'lov/2099-01-01-' || k end, false from a""",
    "gold_holding": """with s as (select conv_id, turn, text, case when turn > 0 and conv_id % 3 <> 0 then length(text) else 0 end as score from conversations)
      select conv_id, case when max(score) > 0 then max_by(text, (score, -turn)) else min_by(text, turn) end as holding from s group by 1""",
    "citation_scores": f"with {_SCORES} select l_orderkey, hallucinated::bigint as hallucinated, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, round(resolution_rate, 9) as resolution_rate from scored",
    "eval_report": f"""with {_SCORES}, e as (select s.*, case when o_orderkey % 10 <> 0 then o_orderpriority else 'unknown' end as area, o_orderstatus as difficulty, o_orderkey % 8 <> 0 as yes, case when o_orderkey % 3 = 0 then recall end as pr
    from scored s join orders on l_orderkey = o_orderkey)
  select case grouping(area, difficulty) when 3 then 'overall' when 1 then 'area=' || area else 'difficulty=' || difficulty end as "grouping",
    count_if(yes)::bigint as items, count_if(not yes)::bigint as refusals, count_if(not yes and hallucinated = 0)::bigint as refusals_correct,
    round(coalesce(avg(f1) filter (yes), 0), 6) as f1, round(coalesce(avg(recall) filter (yes), 0), 6) as recall, round(coalesce(avg(precision) filter (yes), 0), 6) as precision,
    round(coalesce(avg(resolution_rate) filter (yes), 0), 6) as resolution_rate, round(avg(pr) filter (yes), 6) as point_recall
  from e group by grouping sets ((), (area), (difficulty))""",
}
