"""A bounded crawl over pages that are already rows: breadth first, with a cap on pages, a limit on documents, documents once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import urls

MAX_PAGES = 500
BROADCAST_PAGES = 10_000  # a crawl of so many pages at most goes to the links; of more, both are sorted
LAW_COURSE = "/emner/jus/jus/"


def visited(links: DataFrame, seeds: list[str], domain: str, marks: list[str], max_pages: int = MAX_PAGES) -> DataFrame:
    """url, place of the pages that a crawl visits, in its order: by depth, then by the place of the page that leads there and of the link
    on it. links: page, position, href, text. The cap is the crawl's own, so what is ranked is never more than it and its links. Links
    never go to the driver, however small their files are."""
    spark = links.sparkSession
    follow = F.when(F.col("place") >= 0, urls.is_followable(F.col("href"), domain, marks))  # by place, so that no round tests the links of other pages
    new = spark.createDataFrame([(u, k) for k, u in enumerate(dict.fromkeys(seeds))], "url string, place int").limit(max_pages)
    seen, n = new, min(len(dict.fromkeys(seeds)), max_pages)
    written = spark.conf.get("spark.checkpoint.dir", None) is not None
    how = "broadcast" if max_pages <= BROADCAST_PAGES else "merge"
    while n < max_pages:
        step = links.join(new.withColumnRenamed("url", "page").hint(how), "page").where(follow).groupBy(F.col("href").alias("url")).agg(F.min(F.struct("place", "position")).alias("first"))
        step = step.join(seen.select("url").hint(how), "url", "left_anti")
        rank = F.row_number().over(Window.orderBy("first", "url")) + F.lit(n - 1)
        new = step.select("url", rank.alias("place")).where(F.col("place") < max_pages)
        new = new.checkpoint() if written else new
        found = new.count()
        if not found:
            break
        seen, n = seen.union(new), n + found
    return seen


def documents(links: DataFrame, pages: DataFrame, limit: int = 0) -> DataFrame:
    """url, course, semester, kind, language, source_url of the documents on a crawl's pages of law courses, each at its first place;
    limit: so many at most, the first."""
    rows = links.join(pages.select(F.col("url").alias("page"), "place"), "page").where(urls.is_document(F.col("href")) & F.contains(F.lower(urls.path(F.col("page"))), F.lit(LAW_COURSE)))
    rows = rows.withColumn("course", urls.course(F.col("page"))).where("course <> ''")
    first = rows.groupBy(F.col("href").alias("url")).agg(F.min_by(F.struct("course", "page", "text"), F.struct("place", "position")).alias("f"), F.min(F.struct("place", "position")).alias("at"))
    kind = urls.classify(F.col("url"), F.col("f.text"))
    out = first.select("url", F.col("f.course").alias("course"), kind.alias("k"), F.col("f.page").alias("source_url"), "at")
    out = out.orderBy("at").limit(limit) if limit > 0 else out
    return out.select("url", "course", "k.semester", "k.kind", "k.language", "source_url")
