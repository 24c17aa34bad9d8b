"""Queries on pages, conversations and events, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import text, urls
from statuta.sources import pages as tree
from statuta.sources.corpus import read
from statuta.streaming import fold


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.file_name(u).alias("file"))


def classify_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, semester and language of exam papers named after the pages."""
    k = F.col("page_id") % 4
    name = F.when(k == 0, "sensorveiledning-jus1111-v26-nynorsk.pdf").when(k == 1, "eksamensoppgave_h25.docx").when(k == 2, "av26b.pdf").otherwise("side.html")
    url = F.concat(F.lit("https://jus.example.org/studier/emner/jus/jus/JUS"), (F.col("page_id") % 900 + 1000).cast("string"), F.lit("/oppgaver/"), name)
    rows = read(spark, sf_dir, "pages").select("page_id", url.alias("u"), F.when(k == 3, F.lit("Sensorveiledning v24")).otherwise(F.lit("")).alias("a"))
    c = rows.select("page_id", "u", urls.classify(F.col("u"), F.col("a")).alias("c"))
    return c.select("page_id", "c.*", urls.course(F.col("u")).alias("course"), urls.is_document(F.col("u")).alias("is_document"), urls.is_followable(F.col("u"), "example.org", ["/oppgaver/"]).alias("is_followable"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each page, by the tree."""
    p = tree.pages(read(spark, sf_dir, "pages"))
    return p.groupBy("page_id").agg(F.sum(F.size("links")).alias("n"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, title and the characters of text and Markdown of each page."""
    p = tree.pages(read(spark, sf_dir, "pages"))
    return p.select("page_id", "lang", "title", F.char_length("text").alias("text_chars"), F.size(F.split("markdown", "\n\n")).alias("blocks"), "unavailable")


def refusal_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    said = F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit("Dette FINNER IKKE grunnlag: "), "text")).otherwise(F.col("text"))
    return c.select("conv_id", "turn", text.is_refusal(said).alias("refusal")).groupBy("turn").agg(F.count("*").alias("n"), F.count_if("refusal").alias("refusals"))


def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last status and the artifacts so far, as events fold into them."""
    return fold.fold_batch(read(spark, sf_dir, "events")).select("user_id", "status", "events", F.floor("total").alias("total"))


def json_lenient_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property k of the events, if it is a string or a number; absent ones are empty."""
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    return read(spark, sf_dir, "events").select("event_id", F.coalesce(v, F.lit("")).alias("k"))


def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that guide-like texts fall into."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Innledning\n1. "), F.element_at(F.split("text", "\n"), 1), F.lit("\nvidere\na) to\n\nSide 1 av 2\n\n§ 3 tre")).alias("t"))
    return d.select("doc_id", F.size(text.points(F.col("t"))).alias("n"), F.get(text.points(F.col("t")), F.lit(2)).alias("third"))


QUERIES = {f.__name__: f for f in (url_parts, classify_document, page_links, page_text, refusal_check, stream_fold, json_lenient_property, split_points)}

ORACLE_SQL = {
    "url_parts": r"""select page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) as host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path,
      regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) as file from pages""",
    "classify_document": """select page_id, case when page_id % 4 in (0, 3) then 'veiledning' else 'oppgave' end as kind, ['v26', 'h25', '', 'v24'][page_id % 4 + 1] as semester,
      case when page_id % 4 = 0 then 'nn' else 'nb' end as language, 'JUS' || (page_id % 900 + 1000) as course, page_id % 4 < 3 as is_document, page_id % 4 = 3 as is_followable from pages""",
    "page_links": r"select page_id, sum(len(regexp_extract_all(html, '<a [^>]*href=\"[^\"]+\"')))::bigint as n from pages group by 1",
    "refusal_check": "select turn, count(*) as n, count_if(conv_id % 5 = 0)::bigint as refusals from conversations group by 1",
    "stream_fold": "select user_id, max_by(event_type, (ts, event_id)) as status, count(*) as events, floor(sum(round(value, 6)::decimal(18, 6)))::bigint as total from events group by 1",
    "json_lenient_property": "select event_id, coalesce(json_extract_string(props, '$.k'), '') as k from events",
    "split_points": "select doc_id, 4 as n, 'a) to' as third from documents",
}
