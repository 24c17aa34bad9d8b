"""EU reference rules as columns: act identifiers, reference types, clauses, article lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how prose names an EU act.
REFERENCE = r"(?iu)(direktiv|forordning|beslutning)\s*(?:\([A-ZØÆÅ]{1,4}\)\s*)?(nr\.?\s*)?(\d{1,4})/(\d{1,4})"
CONTEXT = 240

# Reference types and their terms, first match wins; a term of one word stands for all words it begins.
TYPES = [
    ("implements", ["gjennomfør", "gjennomføring"]), ("supplements", ["suppler", "utfyll"]),
    ("applies", ["gjelder direkte", "får direkte anvendelse", "anvendes direkte"]),
    ("complies_with", ["i samsvar med", "oppfyller", "etterlever"]), ("derogates_from", ["fravik"]),
    ("amended_by", ["endret ved", "endring av"]), ("repealed_by", ["opphevet ved", "oppheving av"]),
    ("references", ["viser til", "henviser til", "refererer til"]),
]
PRIMARY = ["implements", "supplements"]
COMMUNITIES = [("1958", "1993", "EØF"), ("1994", "2009", "EF"), ("2010", "2100", "EU")]


def full_year(y: Column) -> Column:
    """Two-digit years are of the 20th century."""
    return F.when(y < 100, y + 1900).otherwise(y)


def celex(kind: Column, year: Column, number: Column) -> Column:
    return F.format_string("3%04d%s%04d", year, kind, number)


def mentions(text: Column) -> Column:
    """(celex, raw) of the acts that prose names, in order, each act's first mention; implausible years and numbers are none."""
    groups = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(f"({REFERENCE})" if k == 0 else REFERENCE), F.lit(k if k else 0)) for k in range(5)))

    def one(x: Column) -> Column:
        kind, a, b = F.lower(x["1"]), x["3"].cast("int"), x["4"].cast("int")
        number_first = (x["2"] != "") & (kind != "direktiv")
        year, number = full_year(F.when(number_first, b).otherwise(a)), F.when(number_first, a).otherwise(b)
        letter = F.when(kind == "direktiv", "L").when(kind == "forordning", "R").otherwise("D")
        return F.when(year.between(1950, 2100) & number.between(1, 9999), F.struct(celex(letter, year, number).alias("celex"), x["0"].alias("raw")))

    found = F.filter(F.transform(groups, one), lambda x: x.isNotNull())
    first = F.aggregate(
        found, F.array().cast("array<struct<celex string, raw string>>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: y["celex"] == x["celex"]), acc).otherwise(F.concat(acc, F.array(x))),
    )
    return F.coalesce(first, F.array().cast("array<struct<celex string, raw string>>"))


def celex_ids(text: Column) -> Column:
    """Identifiers of the acts that prose names, distinct, in order of first mention."""
    return F.transform(mentions(text), lambda m: m["celex"])


def reference_meta(text: Column) -> Column:
    """Context, keyword and articles of each act that prose names, by identifier."""

    def one(m: Column) -> Column:
        clause = F.coalesce(clause_around(text, m["raw"]), F.lit(""))
        return F.struct(m["celex"], F.struct(clause.alias("context"), reference_type(clause)["keyword"].alias("keyword"), articles(clause).alias("articles")))

    return F.map_from_entries(F.transform(mentions(text), one))


def celex_of(ref: Column) -> Column:
    """The identifier of one reference: an identifier itself, or year/number of a directive; null if neither."""
    s = F.upper(F.trim(ref))
    a, b = F.try_to_number(F.regexp_extract(s, r"^(\d{1,4})/(\d{1,4})(?:/|$)", 1), F.lit("9999")), F.regexp_extract(s, r"^(\d{1,4})/(\d{1,4})(?:/|$)", 2)
    parts = s.rlike(r"^\d{1,4}/\d{1,4}(/|$)")
    return F.when(s.rlike(r"^3\d{4}[A-Z]\d{1,4}$"), s).when(parts, celex(F.lit("L"), full_year(a.cast("int")), F.when(parts, b).otherwise("0").cast("int")))


def celex_year(id_: Column) -> Column:
    return F.when(id_.rlike(r"^\d{5}"), F.substring(id_, 2, 4).cast("int"))


def community(id_: Column) -> Column:
    y = celex_year(id_).cast("string")
    out = F.when(y.between(*COMMUNITIES[0][:2]), COMMUNITIES[0][2])
    for lo, hi, name in COMMUNITIES[1:]:
        out = out.when(y.between(lo, hi), name)
    return out


def number_of(id_: Column) -> Column:
    """The act's number without leading zeros; 0 if only zeros."""
    n = F.regexp_replace(F.regexp_extract(id_, r"^3\d{4}[A-Z](\d+)$", 1), "^0+(?=.)", "")
    return F.when(n != "", n)


def eli_url(id_: Column) -> Column:
    kind = F.substring(id_, 6, 1)
    word = F.when(kind == "L", "dir").when(kind == "R", "reg").when(kind == "D", "dec")
    return F.concat(F.lit("https://eur-lex.europa.eu/eli/"), word, F.lit("/"), celex_year(id_).cast("string"), F.lit("/"), number_of(id_), F.lit("/oj"))


def concept_suffix(uri: Column) -> Column:
    """The last segment of a concept's address."""
    return F.substring_index(F.regexp_replace(uri, "/+$", ""), "/", -1)


def journal_date(iso: Column) -> Column:
    """2003-02-14 as 14.2.2003; anything else as it is."""
    p = F.split(iso, "-")
    bare = lambda k: F.regexp_replace(F.get(p, F.lit(k)), "^0+", "")
    return F.when(F.size(p) == 3, F.concat_ws(".", bare(2), bare(1), F.get(p, F.lit(0)))).otherwise(iso)


def journal_reference(document: Column, date: Column) -> Column:
    """A journal document's id, as oj:JOL_2003_041_R_0026_01, and its date as "OJ L 41, 14.2.2003, p. 26"; without a date the year
    stands there, without an issue the year as well; empty for other ids."""
    p = F.split(F.regexp_replace(document, "^oj:", ""), "_")
    part = lambda k: F.get(p, F.lit(k))
    bare = lambda k: F.regexp_replace(part(k), "^0+", "")
    day = F.when(F.coalesce(date, F.lit("")) != "", journal_date(date)).otherwise(part(1))
    made = F.concat(F.lit("OJ "), F.substring(part(0), F.lit(3), F.char_length(part(0))), F.lit(" "), F.when(bare(2) != "", bare(2)).otherwise(part(1)), F.lit(", "), day, F.lit(", p. "), bare(4))
    return F.when((F.size(p) >= 5) & part(0).startswith("JO"), made).otherwise("")


def reference_type(clause: Column) -> Column:
    """(type, keyword) of a clause: the first term of the table that begins at a word; ("references", "") if none does."""
    low = F.lower(clause)
    found = []
    for kind, terms in TYPES:
        for term in terms:
            tail = "" if " " in term else "[a-zæøå]*"
            word = F.regexp_extract(low, f"(?<![a-zæøå])({term}{tail})", 1)
            found.append(F.when(word != "", F.struct(F.lit(kind).alias("type"), word.alias("keyword"))))
    return F.coalesce(*found, F.struct(F.lit("references").alias("type"), F.lit("").alias("keyword")))


def clause_between(left: Column, ref: Column, right: Column) -> Column:
    """The clause that holds ref, which stands between left and right: between line breaks, semicolons and sentence ends; at most
    CONTEXT long."""
    start = F.regexp_replace(left, r"(?s)^.*(?:[\n;]|\.(?=[ \t\n]))", "")
    end = F.regexp_extract(right, r"(?s)^((?:(?!\.(?:[ \t\n]|$))[^\n;])*)", 1)
    return F.substring(F.trim(F.concat(start, ref, end)), 1, CONTEXT)


def clause_around(text: Column, ref: Column) -> Column:
    """The clause that holds the first occurrence of ref."""
    at = F.instr(text, ref)
    clause = clause_between(F.substring(text, F.lit(1), at - 1), ref, F.substring(text, at + F.char_length(ref), F.char_length(text)))
    return F.when(at > 0, clause)


_PROSE = r"\d{1,4}\s+(?:nr\.?|nummer)\s+\d{1,4}\s+bokstav(?:en)?\s+[a-zæøå](?:\s*(?:,|og)\s*[a-zæøå](?![a-zæøå]))?"
_ITEM = rf"(?:{_PROSE}|\d{{1,4}}\s*[-–]\s*\d{{1,4}}|\d{{1,4}}(?:\.\d+)*(?:\.[a-zæøå](?![a-zæøå]))?)"


def articles(clause: Column) -> Column:
    """Article references of a clause, normalised, distinct, in natural order: "6.1.a", "13-15", comma lists, prose forms."""
    from .text import natural_key

    lists = F.regexp_extract_all(clause, F.lit(rf"(?iu)(?<![A-Za-z0-9_])(?:artikkel|art\.)\s*({_ITEM}(?:\s*,\s*{_ITEM})*)"), F.lit(1))
    items = F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit(f"(?iu)({_ITEM})"), F.lit(1))))

    def normal(x: Column) -> Column:
        prose = r"(?iu)^(\d+)\s+(?:nr\.?|nummer)\s+(\d+)\s+bokstav(?:en)?\s+([a-zæøå])(?:\s*(?:,|og)\s*([a-zæøå]))?$"
        head = F.concat(F.regexp_extract(x, prose, 1), F.lit("."), F.regexp_extract(x, prose, 2), F.lit("."))
        more = F.regexp_extract(x, prose, 4)
        spelled = F.concat(F.array(F.concat(head, F.regexp_extract(x, prose, 3))), F.when(more != "", F.array(F.concat(head, more))).otherwise(F.array().cast("array<string>")))
        plain = F.array(F.regexp_replace(x, r"\s*[-–]\s*", "-"))
        return F.when(x.rlike(prose), spelled).otherwise(plain)

    found = F.array_distinct(F.flatten(F.transform(items, normal)))
    keyed = F.array_sort(F.transform(found, lambda x: F.struct(natural_key(x).alias("k"), x.alias("v"))))
    return F.transform(keyed, lambda x: x["v"])
