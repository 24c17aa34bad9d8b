"""Citations: extraction from lines, attribution, resolution against provisions, audit, quote verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions import refs, text

from .graph import dedupe_first


def section_citations(documents: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """key, line_no, ref_no, act, token of every section reference outside headings, attributed to an act."""
    lines = documents.select(F.col(key).alias("key"), F.posexplode(F.split(F.col(content), "\n")).alias("line_no", "line")).where(~text.is_heading(F.col("line")))
    found = lines.where(F.contains("line", F.lit("§"))).select("key", "line_no", F.posexplode(refs.attributed(F.col("line"), F.col("key"))).alias("ref_no", "r"))
    return found.select("key", "line_no", "ref_no", F.col("r.act").alias("act"), F.col("r.token").alias("token"))


def act_citations(documents: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """key, act of every explicit act reference outside headings."""
    lines = documents.select(F.col(key).alias("key"), F.explode(F.split(F.col(content), "\n")).alias("line")).where(~text.is_heading(F.col("line")))
    return lines.select("key", F.explode(refs.act_refs(F.col("line"))).alias("act"))


def provision_index(paragraphs: DataFrame, order: list[str]) -> DataFrame:
    """act, token, paragraph: of the provisions with one number the last counts."""
    one = paragraphs.withColumn("token", refs.paragraph_number(F.col("paragraph_num"))).where("token <> ''")
    return one.groupBy(F.col("law_ref_id").alias("act"), "token").agg(F.max_by("key", F.struct(*order)).alias("paragraph"))


def resolve(citations: DataFrame, index: DataFrame) -> DataFrame:
    """citations with the paragraph found, null if none."""
    i = index.select(F.col("act").alias("__a"), F.col("token").alias("__t"), "paragraph")
    return citations.join(i, (F.col("act") == F.col("__a")) & (F.col("token") == F.col("__t")), "left").drop("__a", "__t")


def audit(resolved: DataFrame) -> DataFrame:
    """found, resolved, rate; the rate is 0 if nothing was found."""
    found, ok = F.count("*"), F.count("paragraph")
    return resolved.agg(found.alias("found"), ok.alias("resolved"), F.when(found > 0, ok / F.when(found > 0, found)).otherwise(0.0).alias("rate"))


def targets(references: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """ref, paragraph of every provision that a reference names: a whole act, a number, or a section id."""
    parts = references.select("ref", refs.act_of(F.col("ref")).alias("act"), refs.fragment_of(F.col("ref")).alias("frag"))
    p = paragraphs.select(F.col("law_ref_id").alias("act"), F.col("key").alias("paragraph"), "section_id", refs.paragraph_number(F.col("paragraph_num")).alias("token")).distinct()
    numbered = F.startswith("frag", F.lit("§"))
    whole = parts.where("frag = ''").join(p, "act")
    by_number = parts.where(numbered).withColumn("__n", refs.paragraph_number(F.col("frag"))).join(p.withColumnRenamed("token", "__n"), ["act", "__n"])
    by_section = parts.where((F.col("frag") != "") & ~numbered).join(p.withColumnRenamed("section_id", "frag"), ["act", "frag"])
    return whole.select("ref", "paragraph").union(by_number.select("ref", "paragraph")).union(by_section.select("ref", "paragraph")).distinct()


def verify_quotes(quotes: DataFrame, provisions: DataFrame) -> DataFrame:
    """ref, quote, provision, excerpt: the first provision of each reference, by key, that holds its quote. Joined by ref."""
    both = quotes.join(provisions, "ref")
    content, quote = text.squeeze(F.col("content")), text.squeeze(F.col("quote"))
    hits = both.withColumns({"__c": content, "__q": quote}).where(F.contains("__c", F.col("__q")))
    first = dedupe_first(hits, ["ref", "quote"], ["key"])
    return first.select("ref", "quote", F.col("key").alias("provision"), text.excerpt(F.col("__c"), F.col("__q")).alias("excerpt"))


def find_texts(quotes: DataFrame, documents: DataFrame, words: int = 5) -> DataFrame:
    """quote_id, doc_id of every document that holds a quote, white space aside.

    A quote may begin and end inside a word of the document; the words between are whole. Quotes with five or more such words
    meet documents by hashes of the first five, others by their longest whole word, in equi-joins of 64-bit numbers that scale with
    matches; the containment itself is checked on the joined pairs. Quotes of one or two words have no whole word for sure: where there
    are any, they are compared with each document.
    """
    q = quotes.withColumn("__q", text.squeeze(F.col("quote"))).withColumn("__w", F.split("__q", " "))
    d = documents.withColumn("__d", text.squeeze(F.col("content")))
    inner = F.slice("__w", F.lit(2), F.greatest(F.size("__w") - 2, F.lit(0)))
    longest = F.element_at(F.array_sort(F.transform(inner, lambda w: F.struct((-F.char_length(w)).alias("n"), w.alias("w")))), 1)["w"]
    long, middle = F.size(inner) >= words, (F.size(inner) > 0) & (F.size(inner) < words)
    few = dict(q.groupBy(F.when(long, "long").when(middle, "middle").otherwise("short").alias("kind")).count().collect())
    pairs = None
    for kind, rows, key in (("long", q.where(long), _run_hashes(F.slice(inner, F.lit(1), F.lit(words)), words)[0]), ("middle", q.where(middle), F.xxhash64(longest))):
        if few.get(kind):
            own = F.split("__d", " ")
            held = F.explode(F.array_distinct(_run_hashes(own, words) if kind == "long" else F.transform(own, lambda w: F.xxhash64(w))))
            met = rows.select("quote_id", key.alias("__k")).join(d.select("doc_id", held.alias("__k")), "__k").select("quote_id", "doc_id").distinct()
            pairs = met if pairs is None else pairs.union(met)
    found = q.where("false").select("quote_id").join(d.select("doc_id").where("false")) if pairs is None else pairs
    if pairs is not None:
        found = pairs.join(q.select("quote_id", "__q"), "quote_id").join(d.select("doc_id", "__d"), "doc_id").where(F.contains("__d", F.col("__q"))).select("quote_id", "doc_id")
    if few.get("short"):
        found = found.union(q.where(~long & ~middle).join(d, F.contains("__d", F.col("__q"))).select("quote_id", "doc_id"))
    return found


def _run_hashes(words: Column, n: int) -> Column:
    """Hashes of every run of n words."""
    out = single = F.transform(words, lambda w: F.xxhash64(w))
    for k in range(1, n):
        out = F.zip_with(out, F.slice(single, F.lit(k + 1), F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.xxhash64(a, b)))
    return F.filter(out, lambda x: x.isNotNull())


def closest(quotes: DataFrame, provisions: DataFrame) -> DataFrame:
    """ref, quote, provision, score: the provision of a reference that shares most distinct words; the first of equals."""
    both = quotes.join(provisions, "ref")
    score = F.size(F.array_intersect(F.array_distinct(text.words(F.col("content"))), F.array_distinct(text.words(F.col("quote")))))
    best = both.withColumn("score", score).groupBy("ref", "quote").agg(F.min_by(F.struct("key", "score"), F.struct(-F.col("score"), F.col("key"))).alias("b"))
    return best.select("ref", "quote", F.col("b.key").alias("provision"), F.col("b.score").alias("score"))
