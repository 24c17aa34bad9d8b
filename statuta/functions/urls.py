"""URL rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Lower-cased host without port and trailing dot."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"\.$", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def file_name(url: Column) -> Column:
    """The last segment of the path, decoded where it can be."""
    last = F.substring_index(path(url), "/", -1)
    return F.coalesce(F.try_url_decode(F.regexp_replace(last, r"\+", "%2B")), last)


def is_document(url: Column) -> Column:
    low = F.lower(path(url))
    return F.endswith(low, F.lit(".pdf")) | F.endswith(low, F.lit(".docx"))


def is_followable(url: Column, domain: str, marks: list[str]) -> Column:
    """Whether a crawl follows a link: on the domain, no document, and a mark in its path."""
    low, h = F.lower(path(url)), host(url)
    marked = F.exists(F.array(*(F.lit(m) for m in marks)), lambda m: F.contains(low, m))
    return ~is_document(url) & ((h == domain) | F.endswith(h, F.lit(f".{domain}"))) & marked


def course(url: Column) -> Column:
    exact = F.regexp_extract(path(url), r"/emner/jus/jus/([A-Za-z0-9]+)/", 1)
    return F.upper(F.when(exact != "", exact).otherwise(F.regexp_extract(path(url), r"([A-Z]{2,}[0-9]{2,4}[A-Za-z]?)", 1)))


def semester(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"(?i)(?<![A-Za-z0-9])([vh][0-9]{2})(?![A-Za-z0-9])", 1))


def classify(url: Column, anchor: Column) -> Column:
    """(kind, semester, language) of an exam document; its file name counts before the link's text."""
    name, said = F.lower(file_name(url)), F.lower(F.coalesce(anchor, F.lit("")))
    guide = F.contains(name, F.lit("sensorveiledning")) | F.contains(name, F.lit("sens_veiledning"))
    paper = F.contains(name, F.lit("eksamensoppg")) | F.contains(name, F.lit("eksamensopg"))
    kind = F.when(guide, "veiledning").when(paper, "oppgave").when(F.contains(said, F.lit("sensorveiledning")), "veiledning").otherwise("oppgave")
    when = F.when(semester(name) != "", semester(name)).otherwise(semester(said))
    language = F.when(F.contains(name, F.lit("nynorsk")) | F.contains(said, F.lit("nynorsk")), "nn").otherwise("nb")
    return F.struct(kind.alias("kind"), when.alias("semester"), language.alias("language"))


def cache_name(c: Column) -> Column:
    """A name safe for file systems; "_" for an empty one."""
    s = F.translate(c, '/\\:*?"<>|', "_________")
    return F.when(F.trim(s) == "", "_").otherwise(s)
