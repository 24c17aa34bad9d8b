"""Queries on citations over the derived corpus, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import refs
from statuta.operators import cite, sampling
from statuta.sources import corpus
from statuta.sources.corpus import read

_ORDER = ["ord", "ord2"]


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = corpus.paragraphs(spark, sf_dir)
    rows = p.select(F.col("law_ref_id").alias("key"), "content")
    return cite.resolve(cite.section_citations(rows), cite.provision_index(p, _ORDER))


def citation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section references found and resolved over all paragraphs."""
    out = cite.audit(_resolved(spark, sf_dir))
    return out.select("found", "resolved", F.round("rate", 9).alias("rate"))


def citation_unresolved_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty unresolved references, spread evenly over all in order."""
    open_ = _resolved(spark, sf_dir).where("paragraph is null").select("act", "token").distinct().withColumn("ref", F.concat("act", F.lit("#§"), "token"))
    return sampling.even_spread(open_, ["ref"], 20).select("ref", "place")


def resolve_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every act at its paragraphs 1 to 3, as the provisions found."""
    wanted = corpus.acts(spark, sf_dir).select(F.explode(F.array(F.concat("key", F.lit("#§ 1")), F.concat("key", F.lit("#§2")), F.concat("key", F.lit("#paragraf-3")))).alias("ref"))
    return cite.targets(wanted, corpus.paragraphs(spark, sf_dir))


def resolve_whole_act(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All provisions of each act."""
    wanted = corpus.acts(spark, sf_dir).select(F.col("key").alias("ref"))
    return cite.targets(wanted, corpus.paragraphs(spark, sf_dir))


def _printed() -> Column:
    """An act's key as prose prints it: numbers have four digits at most."""
    return F.concat(F.substring("key", 1, 14), F.lit("-"), (F.col("ord") % 9973).cast("string"))


def attribute_cross_act(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The act that a section reference after another act's name belongs to, by the distance between them."""
    a = corpus.acts(spark, sf_dir)
    gap = F.expr("repeat('x', cast(ord % 7 as int) * 20)")
    line = F.concat(F.lit("Jf. "), _printed(), F.lit(" "), gap, F.lit(" § 4-3 og § 5 a."))
    rows = a.select(F.concat(F.lit("eier-"), F.col("ord").cast("string")).alias("key"), line.alias("content"))
    return cite.section_citations(rows).select("key", "ref_no", "act", "token")


def explicit_act_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts named by key in amendment lines, and whether they exist."""
    a = corpus.acts(spark, sf_dir)
    rows = a.select("key", F.concat(F.lit("# lov/1900-01-01-1\nEndret ved "), _printed(), F.lit(", jf. forskrift/2001-06-15-599.")).alias("content"))
    known = a.select(_printed().alias("__k")).distinct()
    found = cite.act_citations(rows).join(known, F.col("act") == F.col("__k"), "left")
    return found.groupBy(F.substring_index("act", "/", 1).alias("kind")).agg(F.count("*").alias("found"), F.count("__k").alias("resolved"))


def verify_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts and the documents that hold them."""
    quotes = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote"))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return cite.find_texts(quotes, docs)


def quote_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each act's own quote the first provision that holds it, with an excerpt."""
    p = corpus.paragraphs(spark, sf_dir).select(F.col("law_ref_id").alias("ref"), "key", "content").distinct()
    quotes = corpus.acts(spark, sf_dir).select(F.col("key").alias("ref"), F.concat(F.lit("§ "), (F.col("ord") % 9 + 1).cast("string"), F.lit("  og §§")).alias("quote"))
    return cite.verify_quotes(quotes, p).select("ref", "quote", "provision", "excerpt")


def closest_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each conversation's first turn the later turn that shares most words with it."""
    c = read(spark, sf_dir, "conversations")
    quotes = c.where("turn = 0").select(F.col("conv_id").alias("ref"), F.col("text").alias("quote"))
    later = c.where("turn > 0").select(F.col("conv_id").alias("ref"), F.col("turn").alias("key"), F.col("text").alias("content"))
    return cite.closest(quotes, later).select(F.col("ref").alias("conv_id"), F.col("provision").alias("turn"), F.col("score").cast("long").alias("score"))


_TOKENS = """
found as (
  select law_ref_id as act, unnest(regexp_extract_all(regexp_replace(content, '§§[^§]*', '', 'g'), '§\\s*(\\d+)', 1)) as token from paragraphs),
idx as (
  select law_ref_id as act, position::varchar as token, max_by(key, (ord, ord2)) as paragraph from paragraphs group by all),
resolved as (
  select f.act, f.token, i.paragraph from found f left join idx i on f.act = i.act and f.token = i.token)
"""

QUERIES = {f.__name__: f for f in (citation_audit, citation_unresolved_sample, resolve_section, resolve_whole_act, attribute_cross_act, explicit_act_refs, verify_quote, quote_excerpt, closest_document)}

ORACLE_SQL = {
    "citation_audit": f"with {corpus.SQL}, {_TOKENS} select count(*) as found, count(paragraph) as resolved, round(count(paragraph) / count(*), 9) as rate from resolved",
    "citation_unresolved_sample": f"""with {corpus.SQL}, {_TOKENS},
      o as (select ref, row_number() over (order by ref) - 1 as place, count(*) over () as total from (select distinct act || '#§' || token as ref from resolved where paragraph is null))
      select ref, place::bigint as place from o where total <= 20 or place in (select (i * total // 20) from range(20) r(i), (select max(total) as total from o))""",
    "resolve_section": f"""with {corpus.SQL}
      select a.key || x.suffix as ref, p.key as paragraph from acts a, (values ('#§ 1', 1), ('#§2', 2), ('#paragraf-3', 3)) x(suffix, n)
      join (select distinct key, law_ref_id, position from paragraphs) p on p.position = x.n where p.law_ref_id = a.key""",
    "resolve_whole_act": f"with {corpus.SQL} select distinct a.key as ref, p.key as paragraph from acts a join paragraphs p on p.law_ref_id = a.key",
    "attribute_cross_act": f"""with {corpus.SQL}
      select 'eier-' || ord as key, 0 as ref_no, case when (ord % 7) * 20 + 2 <= 80 then substr(key, 1, 14) || '-' || (ord % 9973) else 'eier-' || ord end as act, '4-3' as token from acts
      union all select 'eier-' || ord, 1, 'eier-' || ord, '5' from acts""",
    "explicit_act_refs": f"with {corpus.SQL} select 'lov' as kind, count(*) as found, count(*) as resolved from acts union all select 'forskrift', count(*), 0 from acts",
    "verify_quote": r"""with q as (select item_id as quote_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as q from benchmark),
      d as (select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as d from documents) select quote_id, doc_id from q, d where contains(d, q)""",
    "quote_excerpt": f"""with {corpus.SQL},
      q as (select key as ref, '§ ' || (ord % 9 + 1) || '  og §§' as quote, '§ ' || (ord % 9 + 1) || ' og §§' as q from acts)
      select q.ref, q.quote, min(p.key) as provision, 'Se § ' || substr(q.q, 3, 1) || ' og §§ 8, 9.' as excerpt from q join paragraphs p on p.law_ref_id = q.ref and contains(p.content, q.q) group by all""",
    "closest_document": r"""with c as (select conv_id, turn, list_distinct(list_filter(string_split_regex(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), lambda x: x <> '')) as w from conversations),
      s as (select b.conv_id, b.turn, len(list_intersect(a.w, b.w)) as score from c a join c b on a.conv_id = b.conv_id and a.turn = 0 and b.turn > 0)
      select conv_id, turn, score::bigint as score from s qualify row_number() over (partition by conv_id order by score desc, turn) = 1""",
}
