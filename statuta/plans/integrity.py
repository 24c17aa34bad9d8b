"""Queries on graph building and integrity, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import dates
from statuta.operators import checks, coverage, graph, sampling
from statuta.sources import corpus
from statuta.sources.corpus import read


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """type, key of acts, paragraphs, ministries and areas."""
    a, p = corpus.acts(spark, sf_dir), corpus.paragraphs(spark, sf_dir)
    nations = read(spark, sf_dir, "nation").select(F.lit("Ministry").alias("type"), F.concat(F.lit("ministry_"), F.col("n_nationkey").cast("string")).alias("key"))
    areas = a.select(F.lit("LegalArea").alias("type"), F.concat(F.lit("area_"), F.substring("area", 1, 1)).alias("key")).distinct()
    return a.select(F.lit("Law").alias("type"), "key").union(p.select(F.lit("LegalParagraph").alias("type"), "key")).union(nations).union(areas)


def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.type_counts(_objects(spark, sf_dir))


def relationship_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.type_counts(corpus.relationships(spark, sf_dir))


def v1_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.v1_duplicate_keys(read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key")))


def v2_dangling_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends that are gone once every eleventh act is."""
    live = corpus.acts(spark, sf_dir).where("ord % 11 <> 0").select("key").union(_objects(spark, sf_dir).where("type <> 'Law'").select("key"))
    return checks.v2_dangling(corpus.relationships(spark, sf_dir), live).groupBy("check", "detail").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


def v3_self_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers tied to each other by key within a nation."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("src_key"), F.col("c_nationkey").alias("n"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("dst_key"), F.col("s_nationkey").alias("n"))
    return checks.v3_self_loops(c.join(s, "n").select(F.lit("TRADES_IN").alias("type"), "src_key", "dst_key"))


def v4_paragraph_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = corpus.paragraphs(spark, sf_dir)
    broken = p.select(F.when(F.col("ord") % 13 == 0, F.concat("key", F.lit("x"))).otherwise(F.col("key")).alias("key"), "law_ref_id", F.when(F.col("ord") % 17 != 0, F.col("section_id")).alias("section_id"))
    found = checks.v4_structure(broken, corpus.acts(spark, sf_dir).where("ord % 5 <> 0"))
    return found.groupBy("check", "detail").agg(F.count("*").alias("n"))


def v5_has_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the derived corpus, some of which point at another act's paragraph, some are missing."""
    p = corpus.paragraphs(spark, sf_dir).select("key", "law_ref_id", "position").distinct()
    edges = p.where("position <> 4").select(F.lit("HAS_PARAGRAPH").alias("type"), F.when(F.col("position") == 5, F.lit("lov/1900-01-01-1")).otherwise(F.col("law_ref_id")).alias("src_key"), F.when(F.col("position") == 6, F.concat("key", F.lit("y"))).otherwise(F.col("key")).alias("dst_key"))
    return checks.v5_has_paragraph(edges, p).groupBy("check", "detail").agg(F.count("*").alias("n"))


def v6_ref_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = corpus.acts(spark, sf_dir).select("key", F.when(F.col("ord") % 6 == 0, F.concat("key", F.lit("/§23"))).when(F.col("ord") % 6 == 1, F.regexp_replace("key", r"-\d+$", "")).otherwise(F.col("key")).alias("ref_id"))
    urls = read(spark, sf_dir, "pages").select(F.col("url").alias("key"), F.col("url").alias("ref_id"))
    return checks.v6_ref_ids(a.union(urls))


def _date_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 8
    forms = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-MM-dd HH:mm")).when(k == 2, F.date_format(d, "dd.MM.yyyy")).when(k == 3, F.date_format(d, "MM/dd/yyyy"))
    forms = forms.when(k == 4, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 5, F.lit("2051-01-01")).when(k == 6, F.concat(F.lit("Inntektsåret "), F.date_format(d, "yyyy"))).otherwise(F.date_format(d, "yyyy-02-30"))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"), forms.alias("date_in_force"))


def v7_date_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.v7_dates(_date_strings(spark, sf_dir), ["date_in_force"])


def v8_count_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = object_inventory(spark, sf_dir).where("type <> 'Ministry'").select("type", F.when(F.col("type") == "Law", F.col("n") + 1).otherwise(F.col("n")).alias("expected"))
    manifest = manifest.union(spark.range(1).select(F.lit("EUDirective").alias("type"), F.lit(3).cast("long").alias("expected")))
    return checks.v8_counts(object_inventory(spark, sf_dir), manifest)


def declared_minus_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = spark.range(1).select(F.explode(F.array(*map(F.lit, ("click", "view", "purchase", "signup", "export", "recall")))).alias("event_type"))
    return checks.declared_not_emitted(declared, read(spark, sf_dir, "events"), "event_type")


def dedupe_objects_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key"), "doc_id", "source", "lang")
    return graph.dedupe_first(d, ["key"], ["doc_id"])


def dedupe_edges_merge_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each user and event type the first value of each property, in event order."""
    e = read(spark, sf_dir, "events")
    entries = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("value"), F.floor(F.col("value") * 100).cast("string"))
    rows = e.select("user_id", "event_type", "event_id", F.explode(entries).alias("prop", "val"))
    return graph.merge_properties(rows, ["user_id", "event_type"], "prop", "val", ["event_id"])


def endpoint_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = corpus.acts(spark, sf_dir).where("ord % 3 <> 0").select("key").union(corpus.paragraphs(spark, sf_dir).select("key"))
    return graph.endpoint_filter(corpus.relationships(spark, sf_dir), live).select("type", "src_key", "dst_key")


def stubs_for_missing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    return graph.stubs(read(spark, sf_dir, "lineitem"), known, "l_partkey")


def language_variant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.md5("text").alias("variant"), "doc_id")
    return graph.variant_pairs(d, "variant", "doc_id").select("variant", "source", "target")


def traverse_two_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acts amended by acts of each ministry."""
    hops = graph.two_hop(corpus.relationships(spark, sf_dir), "AMENDED_BY", "ADMINISTERED_BY")
    return hops.groupBy("end").agg(F.count("*").alias("paths"), F.countDistinct("start").alias("starts"))


def bounded_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, nations and suppliers within three steps of customer 1."""
    c = read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("a"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("b"))
    s = read(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("a"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("b"))
    n = read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("a"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("b"))
    edges = c.union(s).union(n).union(n.select(F.col("b").alias("a"), F.col("a").alias("b")))
    start = spark.range(1).select(F.lit("c1").alias("node"))
    return graph.reach(edges, start, 3)


def primary_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each act's first area by name."""
    edges = corpus.relationships(spark, sf_dir).where("type = 'IN_LEGAL_AREA' and startswith(dst_key, 'area_')")
    return edges.groupBy("src_key").agg(F.min("dst_key").alias("area"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by language."""
    from statuta.functions.text import tokens

    d = read(spark, sf_dir, "documents").select("lang", F.size(tokens(F.col("text"))).alias("n"))
    return d.groupBy("lang").agg(F.sum("n").alias("tokens"), F.count("*").alias("documents"))


def token_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens of each turn of a conversation the turn after it has."""
    c = read(spark, sf_dir, "conversations")
    key = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit("-"), t.cast("string")).alias("turn_key")
    out = coverage.token_recall(c.select(key(F.col("turn")), "text"), c.select(key(F.col("turn") - 1), "text"), "turn_key")
    return out.select("turn_key", "total", "kept", F.round("coverage", 9).alias("coverage"))


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the part of their text before the first line break."""
    d = read(spark, sf_dir, "documents")
    return coverage.token_recall(d.select("doc_id", "text"), d.select("doc_id", F.substring_index("text", "\n", 1).alias("text")), "doc_id")


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = coverage.summary(_covered(spark, sf_dir))
    return out.select("documents", F.round("mean", 6).alias("mean"), F.round("least", 6).alias("least"), "below_99", "below_95")


def worst_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.worst(_covered(spark, sf_dir), "coverage", "doc_id", 10).select("doc_id", F.round("coverage", 9).alias("coverage"))


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.seeded(read(spark, sf_dir, "documents"), "doc_id", 25, "seed-7").select("doc_id", "source")


QUERIES = {
    f.__name__: f
    for f in (
        object_inventory, relationship_inventory, v1_duplicate_keys, v2_dangling_endpoints, v3_self_loops, v4_paragraph_structure, v5_has_paragraph, v6_ref_pattern, v7_date_sanity,
        v8_count_crosscheck, declared_minus_emitted, dedupe_objects_first_wins, dedupe_edges_merge_props, endpoint_filter, stubs_for_missing_targets, language_variant_pairs, traverse_two_hop,
        bounded_bfs, primary_area, token_counts, token_coverage, coverage_summary, worst_coverage, seeded_sample,
    )
}

_INVENTORY = """select 'Law' as type, count(*) as n from acts union all select 'LegalParagraph', count(*) from paragraphs
  union all select 'Ministry', count(*) from nation union all select 'LegalArea', count(distinct substr(area, 1, 1)) from acts"""
_DATES = """forms as (select o_orderkey::varchar as key, case o_orderkey % 8 when 0 then strftime(o_orderdate, '%Y-%m-%d') when 1 then strftime(o_orderdate, '%Y-%m-%d %H:%M')
  when 2 then strftime(o_orderdate, '%d.%m.%Y') when 3 then strftime(o_orderdate, '%m/%d/%Y') when 4 then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') when 5 then '2051-01-01'
  when 6 then 'Inntektsåret ' || strftime(o_orderdate, '%Y') else strftime(o_orderdate, '%Y') || '-02-30' end as d from orders)"""
_TOK = r"list_filter(regexp_split_to_array(lower({0}), '[^\pL\p{{Nd}}]+'), lambda x: x <> '')"
_RECALL = f"""a as (select doc_id, t, count(*) as n from (select doc_id, unnest({_TOK.format("text")}) as t from documents) group by all),
  b as (select doc_id, t, count(*) as n from (select doc_id, unnest({_TOK.format("string_split(text, chr(10))[1]")}) as t from documents) group by all),
  per as (select a.doc_id, sum(a.n) as total, sum(least(a.n, coalesce(b.n, 0))) as kept from a left join b on a.doc_id = b.doc_id and a.t = b.t group by 1),
  cov as (select d.doc_id, coalesce(kept / total, 1.0) as coverage from (select distinct doc_id from documents) d left join per using (doc_id))"""

ORACLE_SQL = {
    "object_inventory": f"with {corpus.SQL} {_INVENTORY}",
    "relationship_inventory": f"with {corpus.SQL} select type, count(*) as n from relationships group by 1",
    "v1_duplicate_keys": "select 'V1' as \"check\", sha256(text) as key, 'occurs ' || count(*) || ' times' as detail from documents group by 2 having count(*) > 1",
    "v2_dangling_endpoints": f"""with {corpus.SQL},
      live as (select key from acts where ord % 11 <> 0 union select key from paragraphs union select 'ministry_' || n_nationkey from nation union select 'area_' || substr(area, 1, 1) from acts),
      ends as (select src_key as key, type || ' source' as detail from relationships union all select dst_key, type || ' target' from relationships)
      select 'V2' as "check", detail, count(*) as n, count(distinct key) as keys from ends where key not in (select key from live) group by detail""",
    "v3_self_loops": "select 'V3' as \"check\", c_custkey::varchar as key, 'TRADES_IN' as detail from customer join supplier on c_nationkey = s_nationkey and c_custkey = s_suppkey",
    "v4_paragraph_structure": f"""with {corpus.SQL},
      p as (select case when ord % 13 = 0 then key || 'x' else key end as key, law_ref_id, case when ord % 17 <> 0 then section_id end as section_id from paragraphs),
      j as (select case when coalesce(section_id, '') = '' then 'empty section_id' when p.key <> law_ref_id || '#' || section_id then 'key mismatch' when a.key is null then 'missing parent' end as detail
        from p left join (select key from acts where ord % 5 <> 0) a on p.law_ref_id = a.key)
      select 'V4' as "check", detail, count(*) as n from j where detail is not null group by detail""",
    "v5_has_paragraph": f"""with {corpus.SQL}, p as (select distinct key, law_ref_id, position from paragraphs)
      select 'V5' as "check", 'orphan paragraph' as detail, count(*) as n from p where position in (4, 6) having count(*) > 0
      union all select 'V5', 'source is not the parent', count(*) from p where position = 5 having count(*) > 0
      union all select 'V5', 'target is no paragraph', count(*) from p where position = 6 having count(*) > 0""",
    "v6_ref_pattern": f"""with {corpus.SQL} select 'V6' as "check", key, key || '/§23' as detail from acts where ord % 6 = 0 union all select 'V6', url, url from pages where not regexp_matches(url, '^(lov|forskrift)/')""",
    "v7_date_sanity": f"""with {_DATES} select 'V7' as "check", key, 'date_in_force ' || case when not regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then 'format' when try_strptime(d, '%Y-%m-%d') is null then 'calendar' else 'year' end as detail
      from forms where not regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') or try_strptime(d, '%Y-%m-%d') is null or year(try_strptime(d, '%Y-%m-%d')) > 2050""",
    "v8_count_crosscheck": f"""with {corpus.SQL}, inv as ({_INVENTORY})
      select 'V8' as "check", type as key, 'manifest ' || (n + 1) || ', actual ' || n as detail from inv where type = 'Law'
      union all select 'V8', type, 'not in manifest, actual ' || n from inv where type = 'Ministry' union all select 'V8', 'EUDirective', 'manifest 3, actual 0'""",
    "declared_minus_emitted": "select event_type from (values ('click'), ('view'), ('purchase'), ('signup'), ('export'), ('recall')) v(event_type) except select event_type from events",
    "dedupe_objects_first_wins": "select sha256(text) as key, doc_id, source, lang from documents qualify row_number() over (partition by sha256(text) order by doc_id) = 1",
    "dedupe_edges_merge_props": """with p as (select user_id, event_type, event_id, 'k' as prop, json_extract_string(props, '$.k') as val from events
        union all select user_id, event_type, event_id, 'value', floor(value * 100)::bigint::varchar from events)
      select user_id, event_type, prop, val from p where val is not null qualify row_number() over (partition by user_id, event_type, prop order by event_id) = 1""",
    "endpoint_filter": f"""with {corpus.SQL}, live as (select key from acts where ord % 3 <> 0 union select key from paragraphs)
      select type, src_key, dst_key from relationships where src_key <> dst_key and src_key in (select key from live) and dst_key in (select key from live)""",
    "stubs_for_missing_targets": "select distinct l_partkey from lineitem where l_partkey not in (select p_partkey from part where p_size <= 25)",
    "language_variant_pairs": "select md5(a.text) as variant, a.doc_id as source, b.doc_id as target from documents a join documents b on a.text = b.text and a.doc_id < b.doc_id",
    "traverse_two_hop": f"""with {corpus.SQL} select b.dst_key as "end", count(*) as paths, count(distinct a.src_key) as starts from relationships a join relationships b on a.dst_key = b.src_key
      where a.type = 'AMENDED_BY' and b.type = 'ADMINISTERED_BY' group by 1""",
    "bounded_bfs": """with recursive e as (select 'c' || c_custkey as a, 'n' || c_nationkey as b from customer union all select 'n' || s_nationkey, 's' || s_suppkey from supplier
        union all select 'n' || n_nationkey, 'r' || n_regionkey from nation union all select 'r' || n_regionkey, 'n' || n_nationkey from nation),
      walk as (select 'c1' as node, 0 as depth union select e.b, depth + 1 from walk join e on e.a = node where depth < 3) select node, min(depth)::int as depth from walk group by node""",
    "primary_area": f"with {corpus.SQL} select src_key, min(dst_key) as area from relationships where type = 'IN_LEGAL_AREA' group by 1",
    "token_counts": f"select lang, sum(len({_TOK.format('text')}))::bigint as tokens, count(*) as documents from documents group by 1",
    "token_coverage": f"""with a as (select conv_id || '-' || turn as k, t, count(*) as n from (select conv_id, turn, unnest({_TOK.format("text")}) as t from conversations) group by all),
      b as (select conv_id || '-' || (turn - 1) as k, t, count(*) as n from (select conv_id, turn, unnest({_TOK.format("text")}) as t from conversations) group by all),
      per as (select a.k, sum(a.n)::bigint as total, sum(least(a.n, coalesce(b.n, 0)))::bigint as kept from a left join b on a.k = b.k and a.t = b.t group by 1)
      select c.k as turn_key, coalesce(total, 0) as total, coalesce(kept, 0) as kept, round(coalesce(kept / total, 1.0), 9) as coverage from (select distinct conv_id || '-' || turn as k from conversations) c left join per using (k)""",
    "coverage_summary": f"with {_RECALL} select count(*) as documents, round(avg(coverage), 6) as mean, round(min(coverage), 6) as least, count_if(coverage < 0.99)::bigint as below_99, count_if(coverage < 0.95)::bigint as below_95 from cov",
    "worst_coverage": f"with {_RECALL} select doc_id, round(coverage, 9) as coverage from cov order by cov.coverage, doc_id limit 10",
    "seeded_sample": "select doc_id, source from documents order by md5('seed-7' || doc_id), doc_id limit 25",
}
