"""Queries on the domain parsers, over prose made from the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import eu, prep, text
from statuta.operators import graph, sampling
from statuta.sources import corpus
from statuta.sources.corpus import read

_YEAR, _NUM = "cast(1995 + p_partkey % 25 as int)", "cast(p_partkey % 997 + 1 as int)"
_PROSE = f"""case p_partkey % 4 when 0 then concat('Loven gjennomfører direktiv ', {_YEAR}, '/', {_NUM}, '/EF. Den gjelder.')
  when 1 then concat('Vedlegg II; forskriften viser til forordning (EF) nr. ', {_NUM}, '/', {_YEAR}, ' artikkel 6.1.a, 13-15; slutt')
  when 2 then concat('Dette er i samsvar med forordning (EU) ', {_YEAR}, '/', {_NUM}, ' og direktiv 93/13/EØF')
  else concat('Opphevet ved beslutning nr. ', {_NUM}, '/', {_YEAR}, '/EF. Jf. art. 6.') end"""

# Sentences and their reference types.
SENTENCES = [
    "Loven gjennomfører direktiv 2009/103/EF.", "Reglene bygger på gjennomføring av direktivet.", "Forskriften supplerer forordningen.", "Forskriften utfyller direktivet.",
    "Forordningen gjelder direkte i norsk rett.", "Forordningen får direkte anvendelse her.", "Forordningen anvendes direkte.", "Dette er i samsvar med direktivet.", "Loven oppfyller kravene.",
    "Loven etterlever forpliktelsene.", "Dette er et fravik fra direktivet.", "Direktivet er endret ved direktiv 2014/40/EU.", "Endring av direktivet trer i kraft.",
    "Direktivet er opphevet ved direktiv 2015/1535/EU.", "Oppheving av direktivet trer i kraft.", "Loven viser til direktivet.", "Loven henviser til forordningen.", "Loven refererer til direktivet.",
    "En helt nøytral setning uten EU-henvisning.",
]
ARTICLES = [
    "Jf. artikkel 6.1.a.", "Jf. art. 6.", "Jf. artikkel 6 nr. 1 bokstav a.", "Jf. artikkel 6 nr. 1 bokstav a og c.", "Jf. artikkel 13-15.", "Jf. artikkel 6, 7, 8.", "Jf. artikkel 6.1.a, 6.1.c.",
    "Jf. direktivets artikler generelt.", "Ingen henvisning her.", "artikkel 13-15 og art. 6 og artikkel 6.1.a og art. 6",
]


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.expr(_PROSE).alias("prose"))


def celex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select("p_partkey", F.array_join(F.array_sort(eu.celex_ids(F.col("prose"))), ",").alias("celex"))


def celex_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, community, number and address of the acts named."""
    ids = _parts(spark, sf_dir).select(F.explode(eu.celex_ids(F.col("prose"))).alias("celex")).distinct()
    c = F.col("celex")
    return ids.select("celex", eu.celex_year(c).alias("year"), eu.community(c).alias("community"), eu.number_of(c).alias("number"), eu.eli_url(c).alias("url"))


def _pick(sentences: list[str], key: str):
    return F.element_at(F.array(*map(F.lit, sentences)), (F.col(key) % len(sentences) + 1).cast("int"))


def eu_reference_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "part").select("p_partkey", _pick(SENTENCES, "p_partkey").alias("s"))
    t = s.select("p_partkey", eu.reference_type(F.col("s")).alias("t"))
    return t.groupBy(F.col("t.type").alias("type"), F.col("t.keyword").alias("keyword")).agg(F.count("*").alias("n"), F.max(F.col("t.type").isin(eu.PRIMARY)).alias("is_primary"))


def eu_reference_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clause around the first act named."""
    found = F.regexp_extract("prose", eu.REFERENCE, 0)
    return _parts(spark, sf_dir).select("p_partkey", eu.clause_around(F.col("prose"), found).alias("context"))


def eu_articles_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "part").select("p_partkey", _pick(ARTICLES, "p_partkey").alias("s"))
    return s.groupBy(F.array_join(eu.articles(F.col("s")), " ").alias("articles")).agg(F.count("*").alias("n"))


def amendment_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, date and act of notes; junk notes without either are dropped, and notes on acts that are gone."""
    o = read(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    month = F.element_at(F.array(*map(F.lit, prep.MONTHS)), F.month(d))
    short = F.element_at(F.array(*map(F.lit, prep.SHORT_MONTHS)), F.month(d))
    verb = F.element_at(F.array(*map(F.lit, ("Endret ved lov ", "Endra ved lov ", "Opphevet ved lov ", "Tilføyd ved lov ", "Ny lydelse ved lov "))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    dated = F.concat(verb, F.dayofmonth(d).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ". ").otherwise(" "), F.when(F.col("o_orderkey") % 3 == 0, short).otherwise(month), F.lit(" "), F.year(d).cast("string"), F.lit(" nr. "), (F.col("o_orderkey") % 99 + 1).cast("string"))
    note = F.when(F.col("o_orderkey") % 7 == 0, F.lit("Ny lydelse skal lyde:")).when(F.col("o_orderkey") % 11 == 0, F.lit("En helt vanlig setning.")).otherwise(dated)
    rows = o.select("o_orderkey", "o_custkey", note.alias("note")).withColumn("n", prep.note(F.col("note"))).where("n is not null and not (n.date = '' and n.act = '')")
    known = read(spark, sf_dir, "customer").where("c_nationkey % 5 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    return rows.join(known, "o_custkey", "left_semi").select("o_orderkey", F.col("n.kind").alias("kind"), F.col("n.date").alias("date"), F.col("n.act").alias("act"))


def amendment_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and names of amendment records, law changed by the customer's act before."""
    e = corpus.relationships(spark, sf_dir).where("type = 'AMENDED_BY'")
    return e.select(graph.amendment_key(F.col("src_key"), F.col("dst_key"), F.lit("§ 1-2 æ"), F.lit("metadata")).alias("key"), F.concat("dst_key", F.lit(" (2024)")).alias("name"))


_SLUG = """concat(case o_orderkey % 8 when 0 then 'otprp-76' when 1 then 'prop-71-ls' when 2 then 'inns-s-196' when 3 then 'lovvedtak-10' when 4 then 'stprp-130' when 5 then 'meld-st-29'
  when 6 then 'dok21' else 'representantforslag-136' end, '-', year(o_orderdate), lpad(cast((year(o_orderdate) + 1) % 100 as string), 2, '0'))"""


def prep_work_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "orders").select(F.expr(_SLUG).alias("slug")).distinct()
    return s.select("slug", prep.classify(F.col("slug")).alias("c")).select("slug", "c.*")


def prep_work_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works by type and era; each slug's first name counts."""
    o = read(spark, sf_dir, "orders").select(F.expr(_SLUG).alias("slug"), "o_orderkey")
    first = o.groupBy("slug").agg(F.min("o_orderkey").alias("first_ord"))
    c = first.select(prep.classify(F.col("slug")).alias("c"), "first_ord")
    return c.groupBy(F.col("c.type").alias("type"), prep.era(F.col("c.year")).alias("era")).agg(F.count("*").alias("n"), F.min("first_ord").alias("first_ord"))


_SOURCE = """case o_orderkey % 5 when 0 then concat('Prop. ', o_custkey % 300 + 1, ' L (', year(o_orderdate), '–', year(o_orderdate) + 1, ')') when 1 then concat('Ot.prp. nr. ', o_custkey % 300 + 1, ' (', year(o_orderdate), '-2009)')
  when 2 then concat('St.meld. nr. ', o_custkey % 300 + 1, ' (', year(o_orderdate), '-2005)') when 3 then concat('Innst. ', o_custkey % 300 + 1, ' S (', year(o_orderdate), ')') else concat('NOU ', year(o_orderdate), ':', o_custkey % 30 + 1) end"""


def kildedok_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(_SOURCE).alias("s"))
    return s.select("o_orderkey", F.explode(prep.source_slugs(F.col("s"))).alias("slug"))


def derives_from_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works that name a source which is in the corpus and isn't themselves."""
    s = kildedok_slugs(spark, sf_dir)
    own = F.concat(F.lit("nou-"), (F.lit(1992) + F.col("o_orderkey") % 7).cast("string"), F.lit("-"), (F.col("o_orderkey") % 30 + 1).cast("string"))
    works = read(spark, sf_dir, "orders").where("o_orderkey % 5 = 4").select(own.alias("slug"))
    edges = s.withColumn("src", own).join(works.distinct(), "slug", "left_semi").where("src <> slug")
    return edges.groupBy("slug").agg(F.count("*").alias("n"))


def humanize_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber").cast("string")
    ids = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("kapittel-"), line, F.lit("-kapittel-"), line, F.lit("-ledd-2"))).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("kapittel-"), line, F.lit("-paragraf-4"))).otherwise(F.concat(F.lit("vedlegg-del-"), line, F.lit("-nummer")))
    return read(spark, sf_dir, "lineitem").select(ids.alias("section_id")).distinct().select("section_id", text.section_label(F.col("section_id")).alias("label"))


def collapse_cartesian_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an order of the lines' and flags' cross product: first value for scalars, sorted distinct values for lists."""
    l = read(spark, sf_dir, "lineitem")
    rows = l.select("l_orderkey", "l_returnflag", "l_linenumber").join(l.select("l_orderkey", "l_linestatus"), "l_orderkey")
    return rows.groupBy("l_orderkey").agg(
        F.min(text.blank_null(F.col("l_returnflag"))).alias("flag"), F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), "; ").alias("lines"),
        F.array_join(F.array_sort(F.collect_set("l_linestatus")), ",").alias("statuses"),
    )


def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name with its rank in digit-aware order, from 1."""
    p = read(spark, sf_dir, "part").select(F.concat(F.lit("art-"), (F.col("p_partkey") % 1201).cast("string"), F.lit("."), F.col("p_size").cast("string")).alias("name")).distinct()
    keyed = p.select("name", text.natural_key(F.col("name")).alias("__key"))
    return sampling.with_place(keyed, ["__key", "name"]).select("name", (F.col("place") + 1).alias("place"))


QUERIES = {
    f.__name__: f
    for f in (
        celex_extract, celex_meta, eu_reference_type, eu_reference_context, eu_articles_sorted, amendment_notes, amendment_keys, prep_work_classify, prep_work_summary, kildedok_slugs,
        derives_from_edges, humanize_section, collapse_cartesian_rows, natural_order,
    )
}

_P = "p as (select p_partkey, 1995 + p_partkey % 25 as y, p_partkey % 997 + 1 as n, p_partkey % 4 as k from part)"
_IDS = """ids as (select p_partkey, case k when 0 then '3' || y || 'L' || lpad(n::varchar, 4, '0') when 3 then '3' || y || 'D' || lpad(n::varchar, 4, '0') else '3' || y || 'R' || lpad(n::varchar, 4, '0') end as celex from p
  union all select p_partkey, '31993L0013' from p where k = 2)"""


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TYPED = [("implements", "gjennomfører"), ("implements", "gjennomføring"), ("supplements", "supplerer"), ("supplements", "utfyller"), ("applies", "gjelder direkte"), ("applies", "får direkte anvendelse"), ("applies", "anvendes direkte"), ("complies_with", "i samsvar med"), ("complies_with", "oppfyller"), ("complies_with", "etterlever"), ("derogates_from", "fravik"), ("amended_by", "endret ved"), ("amended_by", "endring av"), ("repealed_by", "opphevet ved"), ("repealed_by", "oppheving av"), ("references", "viser til"), ("references", "henviser til"), ("references", "refererer til"), ("references", "")]
_ARTS = ["6.1.a", "6", "6.1.a", "6.1.a 6.1.c", "13-15", "6 7 8", "6.1.a 6.1.c", "", "", "6 6.1.a 13-15"]
_DUCK_SLUG = """(case o_orderkey % 8 when 0 then 'otprp-76' when 1 then 'prop-71-ls' when 2 then 'inns-s-196' when 3 then 'lovvedtak-10' when 4 then 'stprp-130' when 5 then 'meld-st-29'
  when 6 then 'dok21' else 'representantforslag-136' end) || '-' || year(o_orderdate) || lpad(((year(o_orderdate) + 1) % 100)::varchar, 2, '0')"""
_WORK = f"""w as (select {_DUCK_SLUG} as slug, o_orderkey % 8 as k, year(o_orderdate) as y, o_orderkey from orders),
  c as (select slug, min(o_orderkey) as first_ord, any_value(['proposisjon', 'proposisjon', 'innstilling', 'lovvedtak', 'proposisjon', 'melding', 'dok', 'representantforslag'][k + 1]) as type,
    any_value(y || '-' || (y + 1)) as session, any_value(['76', '71', '196', '10', '130', '29', '', '136'][k + 1]) as number, any_value(y::varchar) as year from w group by slug)"""
_KILDE = """k as (select o_orderkey, case o_orderkey % 5 when 0 then 'prop-' || (o_custkey % 300 + 1) || '-l-' || t when 1 then 'otprp-' || (o_custkey % 300 + 1) || '-' || t when 2 then 'meld-st-' || (o_custkey % 300 + 1) || '-' || t
  when 3 then 'inns-' || (o_custkey % 300 + 1) || '-s-' || t else 'nou-' || year(o_orderdate) || '-' || (o_custkey % 30 + 1) end as slug
  from (select *, year(o_orderdate) || lpad(((year(o_orderdate) + 1) % 100)::varchar, 2, '0') as t from orders))"""

ORACLE_SQL = {
    "celex_extract": f"with {_P}, {_IDS} select p_partkey, string_agg(distinct celex, ',' order by celex) as celex from ids group by 1",
    "celex_meta": f"""with {_P}, {_IDS} select distinct celex, substr(celex, 2, 4)::int as year, case when substr(celex, 2, 4) <= '1993' then 'EØF' when substr(celex, 2, 4) <= '2009' then 'EF' else 'EU' end as community,
      substr(celex, 7)::int::varchar as number, 'https://eur-lex.europa.eu/eli/' || case substr(celex, 6, 1) when 'L' then 'dir' when 'R' then 'reg' else 'dec' end || '/' || substr(celex, 2, 4) || '/' || substr(celex, 7)::int || '/oj' as url from ids""",
    "eu_reference_type": f"""select {_list([t for t, _ in _TYPED])}[p_partkey % 19 + 1] as type, {_list([k for _, k in _TYPED])}[p_partkey % 19 + 1] as keyword, count(*) as n, p_partkey % 19 < 4 as is_primary from part group by 1, 2, 4""",
    "eu_reference_context": f"""with {_P} select p_partkey, case k when 0 then 'Loven gjennomfører direktiv ' || y || '/' || n || '/EF' when 1 then 'forskriften viser til forordning (EF) nr. ' || n || '/' || y || ' artikkel 6.1.a, 13-15'
      when 2 then 'Dette er i samsvar med forordning (EU) ' || y || '/' || n || ' og direktiv 93/13/EØF' else 'Opphevet ved beslutning nr. ' || n || '/' || y || '/EF' end as context from p""",
    "eu_articles_sorted": f"select {_list(_ARTS)}[p_partkey % 10 + 1] as articles, count(*) as n from part group by 1",
    "amendment_notes": """with o as (select *, strftime(o_orderdate, '%Y-%m-%d') as d from orders where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 and o_custkey in (select c_custkey from customer where c_nationkey % 5 <> 0))
      select o_orderkey, ['endret', 'endret', 'opphevet', 'tilfoyd', 'ny_lydelse'][o_orderkey % 5 + 1] as kind, d as date, 'lov/' || d || '-' || (o_orderkey % 99 + 1) as act from o""",
    "amendment_keys": f"""with {corpus.SQL} select 'amend_' || replace(replace(src_key, '/', '_'), '-', '_') || '_' || replace(replace(dst_key, '/', '_'), '-', '_') || '___1_2___metadata' as key, dst_key || ' (2024)' as name from relationships where type = 'AMENDED_BY'""",
    "prep_work_classify": f"with {_WORK} select slug, type, session, number, year from c",
    "prep_work_summary": f"with {_WORK} select type, case when year < '1999' then 'pre_1999' else '1999_plus' end as era, count(*) as n, min(first_ord) as first_ord from c group by 1, 2",
    "kildedok_slugs": f"with {_KILDE} select o_orderkey, slug from k",
    "derives_from_edges": f"""with {_KILDE}, own as (select o_orderkey, 'nou-' || (1992 + o_orderkey % 7) || '-' || (o_orderkey % 30 + 1) as src from orders)
      select slug, count(*) as n from k join own using (o_orderkey) where slug in (select src from own where o_orderkey % 5 = 4) and src <> slug group by 1""",
    "humanize_section": """select distinct case when l_linenumber % 3 = 0 then 'kapittel-' || l_linenumber || '-kapittel-' || l_linenumber || '-ledd-2' when l_linenumber % 3 = 1 then 'kapittel-' || l_linenumber || '-paragraf-4' else 'vedlegg-del-' || l_linenumber || '-nummer' end as section_id,
      case when l_linenumber % 3 = 0 then 'Kapittel ' || l_linenumber || ', ledd 2' when l_linenumber % 3 = 1 then 'Kapittel ' || l_linenumber || ', paragraf 4' else 'Vedlegg, del ' || l_linenumber || ', nr.' end as label from lineitem""",
    "collapse_cartesian_rows": """select l_orderkey, min(l_returnflag) as flag, string_agg(distinct l_linenumber::varchar, '; ' order by l_linenumber::varchar) as lines, string_agg(distinct l_linestatus, ',' order by l_linestatus) as statuses from lineitem group by 1""",
    "natural_order": "select name, row_number() over (order by a, b)::bigint as place from (select distinct 'art-' || (p_partkey % 1201) || '.' || p_size as name, p_partkey % 1201 as a, p_size as b from part)",
}
