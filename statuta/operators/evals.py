"""Evaluation sets and scores: abbreviations, exam references, items, pairing, citation metrics, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import refs, text

# Words that name no act by themselves.
GENERIC = [
    "lov", "loven", "lova", "lovene", "avtale", "avtalen", "avtalene", "forskrift", "forskriften", "forskrifta", "konvensjon", "konvensjonen", "direktiv", "direktivet",
    "paragraf", "paragrafen", "kapittel", "kapittelet", "ledd", "stk", "nr", "mv", "m.v", "mfl", "m.fl", "jf", "se", "og", "om", "i", "av", "for", "den", "det", "de", "som",
    "til", "med", "på", "er", "innledning", "formål", "virkeområde",
]
# How names of acts begin that only change others.
AMENDING = ["lov om endring", "lov om endringar", "lov om oppheving", "lov om opphevelse", "lov om ikraftsetting", "midlertidig lov om endring", "lov om gjennomføring av endring"]
EXACT, FRAGMENT = 2, 1


def act_token(c: Column) -> Column:
    return F.btrim(F.lower(text.squeeze(c)), F.lit(" ."))


def is_amending(name: Column) -> Column:
    low = F.lower(F.trim(name))
    return F.exists(F.array(*(F.lit(p) for p in AMENDING)), lambda p: F.startswith(low, p))


def abbreviations(laws: DataFrame) -> DataFrame:
    """token, key: titles, names and bracketed parts rank before fragments of them; of equals the smallest key. laws: key, short_title, name."""

    def fragments(c: Column) -> Column:
        parts = F.filter(F.transform(F.split(c, r"[–—()\[\],-]"), lambda p: F.trim(p)), lambda p: p != "")
        return F.coalesce(parts, F.array().cast("array<string>"))

    brackets = F.coalesce(F.regexp_extract_all("name", F.lit(r"[(\[]([^)\]]*)[)\]]"), F.lit(1)), F.array().cast("array<string>"))
    exact = F.transform(F.concat(F.array("short_title", "name"), brackets), lambda x: F.struct(act_token(x).alias("token"), F.lit(EXACT).alias("rank")))
    frag = F.transform(F.concat(fragments(F.col("short_title")), fragments(F.col("name"))), lambda x: F.struct(act_token(x).alias("token"), F.lit(FRAGMENT).alias("rank")))
    rows = laws.where(~F.coalesce(is_amending(F.col("name")), F.lit(False))).select("key", F.explode(F.concat(exact, frag)).alias("t")).select("key", "t.*")
    rows = rows.where((F.char_length("token") >= 3) & ~F.col("token").isin(GENERIC))
    return rows.groupBy("token").agg(F.min_by("key", F.struct(-F.col("rank"), F.col("key"))).alias("key"))


SECTION = r"(§\s*\d+(?:\s*[-–—]\s*\d+)?[a-zæøå]*)"
CHUNKS = r"(\x{E000}[^\x{E001}]*\x{E001}|[^\s\x{E000}\x{E001}]+)"
PIECES = r"([\p{L}\p{Nd}]+|[^\p{L}\p{Nd}]+)"
ONE_WORD = r"^[^\p{L}\p{Nd}]*([\p{L}\p{Nd}]+)[^\p{L}\p{Nd}]*$"
ACT_KEY = r"^(lov|forskrift)/\d{4}-\d{2}-\d{2}-\d+$"
KEY_WORDS = 5


def _names(chunk: Column, words: int) -> Column:
    """(at, to, name) of what can be an act's name in a text without blanks: up to so many of its words, from piece at to piece to.

    Pieces are words and what lies between. A name that goes on after a point is none.
    """

    def of(p: Column) -> Column:
        def name(at: Column, n: Column) -> Column:
            return F.struct(at.alias("at"), (at + 2 * n).alias("to"), F.array_join(F.slice(p, at + 1, 2 * n + 1), "").alias("name"))

        first = F.when(F.get(p, F.lit(0)).rlike(r"^[\p{L}\p{Nd}]"), 0).otherwise(1)
        spans = F.flatten(F.transform(F.sequence(first, F.size(p) - 1, F.lit(2)), lambda k: F.transform(F.sequence(F.lit(0), F.least(F.lit(words - 1), F.floor((F.size(p) - 1 - k) / 2).cast("int"))), lambda n: name(k, n))))
        return F.filter(spans, lambda x: ~F.coalesce((F.get(p, x["to"] + 1) == ".") & F.get(p, x["to"] + 2).isNotNull(), F.lit(False)))

    return F.element_at(F.transform(F.array(F.regexp_extract_all(chunk, F.lit(PIECES), F.lit(1))), of), 1)


def exam_refs(documents: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """doc_id, line_no, ref_no, act, token of section references that an act can be found for: the nearest mention before the
    reference, else the line's only act, else the act of a heading line right before (one mention and no reference).

    Mentions are names in a line that equal an abbreviation without blanks, the longest of those that begin first, and act keys as
    written, also inside a link; names are found by an equi-join. Names of several words are not looked for. ref_no counts the
    references of a line from 0.
    """
    texts = F.filter(F.transform(F.split(F.regexp_replace("content", "\r\n", "\n"), "\n"), lambda x, k: F.struct(k.alias("line_no"), x.alias("line"))), lambda x: F.trim(x["line"]) != "")
    lines = documents.select("doc_id", F.posexplode(texts).alias("k", "l")).select("doc_id", "k", "l.*")
    known = abbreviations.where(~F.contains("token", F.lit(" ")) & (F.char_length("token") >= 2)).select(F.col("token").alias("__t"), F.col("key").alias("__key"))
    most = known.agg(F.max(F.size(F.regexp_extract_all("__t", F.lit(r"([\p{L}\p{Nd}]+)"), F.lit(1))))).first()[0] or 1
    marked = F.regexp_replace("line", SECTION, "\ue000$1\ue001")
    chunks = lines.select("doc_id", "k", "line_no", F.posexplode(F.regexp_extract_all(marked, F.lit(CHUNKS), F.lit(1))).alias("c", "chunk"))
    is_ref, alone, at = F.startswith("chunk", F.lit("\ue000")), F.regexp_extract("chunk", ONE_WORD, 1), F.shiftleft(F.col("c").cast("long"), 20)
    simple = chunks.select("doc_id", "k", "line_no", is_ref.alias("is_ref"), at.alias("at"), at.alias("to"), F.when(is_ref, F.btrim("chunk", F.lit("\ue000\ue001"))).otherwise(alone).alias("name")).where("name <> ''")
    spread = chunks.where(~is_ref & (alone == "") & F.col("chunk").rlike(r"[\p{L}\p{Nd}]")).select("doc_id", "k", "line_no", at.alias("base"), F.inline(_names(F.col("chunk"), max(most, KEY_WORDS))))
    words = simple.union(spread.select("doc_id", "k", "line_no", F.lit(False), F.col("base") + F.col("at"), F.col("base") + F.col("to"), "name"))
    joined = words.join(known, ~F.col("is_ref") & (F.lower("name") == F.col("__t")), "left")
    joined = joined.withColumn("explicit", F.when(F.lower("name").rlike(ACT_KEY), F.lower("name"))).where("is_ref or __key is not null or explicit is not null")

    # Of overlapping names the one that begins first stays, of those the longest; an act key counts where no name begins.
    per = joined.repartition("doc_id").groupBy("doc_id", "k").agg(
        F.min("line_no").alias("line_no"),
        F.array_sort(F.collect_list(F.when(F.col("__key").isNotNull(), F.struct("at", (-F.col("to")).alias("back"), F.col("__key").alias("act"))))).alias("named"),
        F.array_sort(F.collect_list(F.when(F.col("explicit").isNotNull(), F.struct("at", (-F.col("to")).alias("back"), F.col("explicit").alias("act"))))).alias("keys"),
        F.array_sort(F.collect_list(F.when(F.col("is_ref"), F.struct("at", "name")))).alias("refs"),
    )
    free = lambda done, x: (F.size(done) == 0) | (x["at"] > -F.element_at(done, -1)["back"])
    kept = lambda c: F.when(F.size(c) < 2, F.col(c)).otherwise(F.aggregate(c, F.slice(F.col(c), 1, 0), lambda done, x: F.when(free(done, x), F.concat(done, F.array(x))).otherwise(done)))
    per = per.withColumns({"named": kept("named"), "keys": kept("keys")})
    keys = F.filter("keys", lambda k: ~F.exists("named", lambda n: n["at"] == k["at"]))
    per = per.withColumn("mentions", F.transform(F.array_sort(F.concat("named", keys)), lambda m: F.struct(m["at"].alias("at"), m["act"].alias("act"))))
    heading = F.when((F.size("mentions") == 1) & (F.size("refs") == 0), F.element_at("mentions", 1)["act"])
    before_it = F.lag(F.struct(F.col("k").alias("k"), heading.alias("act"))).over(Window.partitionBy("doc_id").orderBy("k"))
    heads = per.withColumn("last", before_it).withColumn("carried", F.when(F.col("last.k") == F.col("k") - 1, F.col("last.act"))).where(F.size("refs") > 0)
    acts = F.array_distinct(F.transform("mentions", lambda m: m["act"]))

    def owner(r: Column) -> Column:
        before = F.filter("mentions", lambda m: m["at"] < r["at"])
        return F.coalesce(F.get(before, F.size(before) - 1)["act"], F.when(F.size(acts) == 1, F.get(acts, F.lit(0))), F.col("carried"))

    found = heads.select("doc_id", "line_no", F.posexplode(F.transform("refs", lambda r: F.struct(owner(r).alias("act"), r["name"].alias("name")))).alias("ref_no", "r"))
    token = refs.section_token(F.regexp_replace("r.name", r"^§\s*", ""))
    return found.where("r.act is not null").select("doc_id", "line_no", "ref_no", F.col("r.act").alias("act"), token.alias("token"))


def resolve_candidates(candidates: DataFrame, acts: DataFrame, index: DataFrame) -> DataFrame:
    """act, token, ref or reason of distinct candidates: "unknown act", "unknown section" or resolved."""
    a = acts.select(F.col("key").alias("__act")).distinct()
    i = index.select(F.col("act").alias("__ia"), F.col("token").alias("__it")).distinct()
    rows = candidates.select("act", "token").distinct().join(a, F.col("act") == F.col("__act"), "left").join(i, (F.col("act") == F.col("__ia")) & (F.col("token") == F.col("__it")), "left")
    reason = F.when(F.col("__act").isNull(), "unknown act").when(F.col("__ia").isNull(), "unknown section")
    return rows.select("act", "token", reason.alias("reason"), F.when(reason.isNull(), F.concat("act", F.lit("#§"), "token")).alias("ref"))


def pair(papers: DataFrame, guides: DataFrame, group: list[str]) -> DataFrame:
    """Each group's paper with its guide: the preferred language first, then the first language; a guide in the paper's language first."""
    first = Window.partitionBy(*group).orderBy(F.col("language") != "nb", "language", "id")
    paper = papers.withColumn("__r", F.row_number().over(first)).where("__r = 1").select(*group, F.col("id").alias("paper"), F.col("language").alias("paper_language"))
    joined = paper.join(guides.select(*group, F.col("id").alias("guide"), "language"), group, "left")
    best = Window.partitionBy(*group).orderBy(F.coalesce(F.col("language") != F.col("paper_language"), F.lit(True)), F.col("language") != "nb", "language", "guide")
    return joined.withColumn("__r", F.row_number().over(best)).where("__r = 1").select(*group, "paper", "paper_language", "guide", F.col("language").alias("guide_language"))


def scores(items: DataFrame) -> DataFrame:
    """items (cited, gold, resolved as arrays of canonical references) with precision, recall, f1, resolution_rate, hallucinated."""
    p, r = refs.precision(F.col("cited"), F.col("gold")), refs.recall(F.col("cited"), F.col("gold"))
    rate = F.when(F.size("cited") == 0, 1.0).otherwise(F.size("resolved") / F.size("cited"))
    out = items.withColumns({"precision": p, "recall": r, "resolution_rate": rate, "hallucinated": F.size(F.array_except("cited", "resolved"))})
    return out.withColumn("f1", refs.f1(F.col("precision"), F.col("recall")))


def report(results: DataFrame) -> DataFrame:
    """Means overall, by area and by difficulty in one pass of grouping sets; blank groups are "unknown".

    results: area, difficulty, answerable, f1, recall, precision, resolution_rate, point_recall, refusal_correct.
    """
    named = results.withColumns({c: F.coalesce(text.blank_null(F.col(c)), F.lit("unknown")) for c in ("area", "difficulty")})
    yes = F.col("answerable")
    mean = lambda c: F.coalesce(F.avg(F.when(yes, F.col(c))), F.lit(0.0))
    out = named.groupingSets([[], [F.col("area")], [F.col("difficulty")]], F.col("area"), F.col("difficulty")).agg(
        F.grouping_id().alias("__g"), F.count_if(yes).alias("items"), mean("f1").alias("f1"), mean("recall").alias("recall"), mean("precision").alias("precision"),
        mean("resolution_rate").alias("resolution_rate"), F.avg(F.when(yes, F.col("point_recall"))).alias("point_recall"),
        F.count_if(~yes).alias("refusals"), F.count_if(~yes & F.col("refusal_correct")).alias("refusals_correct"),
    )
    name = F.when(F.col("__g") == 3, "overall").when(F.col("__g") == 1, F.concat(F.lit("area="), "area")).otherwise(F.concat(F.lit("difficulty="), "difficulty"))
    return out.select(name.alias("grouping"), "items", "f1", "recall", "precision", "resolution_rate", "point_recall", "refusals", "refusals_correct")


def gold_holding(rows: DataFrame, key: str) -> DataFrame:
    """key, holding: the sentence of highest score, the first of equals, if any score is above 0; else the summary.

    rows: key, pos, sentence, score, summary."""
    best = rows.groupBy(key).agg(F.max("score").alias("__top"), F.max_by("sentence", F.struct("score", -F.col("pos"))).alias("__s"), F.min_by("summary", "pos").alias("__sum"))
    return best.select(key, F.when(F.col("__top") > 0, F.col("__s")).otherwise(F.col("__sum")).alias("holding"))
