"""Rules for amendment notes and preparatory works as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONTHS = ["januar", "februar", "mars", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "desember"]
SHORT_MONTHS = ["jan", "feb", "mar", "apr", "mai", "jun", "jul", "aug", "sep", "okt", "nov", "des"]
NOTE_KINDS = [("endret", ["endret ved lov", "endra ved lov"]), ("opphevet", ["opphevet ved lov"]), ("tilfoyd", ["tilføyd"]), ("ny_lydelse", ["ny lydelse", "ny ordlyd"])]
NOTE_DATE = rf"(?iu)(\d{{1,2}})\.?\s+({'|'.join(MONTHS + SHORT_MONTHS)})\s+(\d{{4}})\s+nr\.?\s*(\d+)"
NOTE_TEXT = r"(?iu)((?:endret|endra|opphevet|tilføyd)\s+ved\s+lov[^\n.;]{0,120}|ny\s+(?:lydelse|ordlyd)[^\n.;]{0,120})"
WORKS = [
    ("otprp", "proposisjon"), ("prop", "proposisjon"), ("inns", "innstilling"), ("innb", "innstilling"), ("inno", "innstilling"),
    ("lovvedtak", "lovvedtak"), ("stprp", "proposisjon"), ("representantforslag", "representantforslag"),
]


def note_kind(text: Column) -> Column:
    low, out = F.lower(text), None
    for kind, terms in NOTE_KINDS:
        for t in terms:
            hit = F.contains(low, F.lit(t))
            out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def note(text: Column) -> Column:
    """(kind, date, act) of an amendment note; null if the text has none, empty date and act if the note names none."""
    names = {n: k for table in (MONTHS, SHORT_MONTHS) for k, n in enumerate(table, 1)}
    months = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))

    def parts(t: Column) -> Column:
        day, name, year, number = (F.regexp_extract(t, NOTE_DATE, k) for k in range(1, 5))
        return F.struct(note_kind(t).alias("kind"), F.lpad(day, 2, "0").alias("day"), F.try_element_at(months, F.lower(name)).alias("month"), year.alias("year"), number.alias("number"))

    def whole(p: Column) -> Column:
        date = F.when(p["day"].between("01", "31"), F.concat_ws("-", p["year"], F.lpad(p["month"].cast("string"), 2, "0"), p["day"])).otherwise("")
        return F.when(p["kind"].isNotNull(), F.struct(p["kind"].alias("kind"), date.alias("date"), F.when(date != "", F.concat(F.lit("lov/"), date, F.lit("-"), p["number"])).otherwise("").alias("act")))

    # Bound step by step: written out, the generated code would grow with each use of a part.
    return F.get(F.transform(F.transform(F.array(text), parts), whole), F.lit(0))


def note_text(text: Column) -> Column:
    return F.trim(F.regexp_extract(text, NOTE_TEXT, 1))


def slug_of(href: Column) -> Column:
    """The slug of a link to a preparatory work; null for other links."""
    s = F.regexp_extract(F.trim(href), r"^/?forarbeid/([^/#]+)", 1)
    return F.when(s != "", s)


def session_of(code: Column) -> Column:
    """"199900" as "1999-2000"; empty for what is no session code."""
    y = F.when(code.rlike("^[0-9]{6}$"), F.substring(code, 1, 4)).cast("int")
    return F.coalesce(F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string")), F.lit(""))


def session_tail(year: Column) -> Column:
    return F.lpad(((year.cast("int") + 1) % 100).cast("string"), 2, "0")


def classify(slug: Column) -> Column:
    """(type, session, number, year) of a preparatory work's slug; what the slug doesn't say is empty."""
    parts = F.split(slug, "-")
    n, prefix = F.size(parts), F.substring_index(slug, "-", 1)
    last = session_of(F.substring_index(slug, "-", -1))
    middle = F.filter(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), lambda p: p.rlike("^[0-9]+$"))
    number = F.coalesce(F.get(middle, F.lit(0)), F.lit(""))

    def of(kind: Column | str, session: Column, num: Column, year: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("type"), session.alias("session"), num.alias("number"), year.alias("year"))

    none = F.lit("")
    table = F.create_map(*(F.lit(x) for pair in WORKS for x in pair))
    plain = F.try_element_at(table, prefix)
    second = F.coalesce(F.get(parts, F.lit(1)), none)
    third = F.coalesce(F.get(parts, F.lit(2)), none)
    return (
        F.when(plain.isNotNull() & (n >= 3), of(plain, last, number, F.substring(last, 1, 4)))
        .when((prefix == "nou") & (n >= 3), of("nou", none, third, second))
        .when(F.startswith(prefix, F.lit("meld")), F.when(n >= 3, of("melding", last, number, F.substring(last, 1, 4))).otherwise(of("melding", none, none, none)))
        .when(F.startswith(prefix, F.lit("dok")), F.when(n >= 2, of("dok", last, none, F.substring(last, 1, 4))).otherwise(of("dok", none, none, none)))
        .when(F.startswith(prefix, F.lit("lovanm")), F.when(n >= 3, of("lovanm", session_of(second), third, F.substring(session_of(second), 1, 4))).otherwise(of("lovanm", none, none, none)))
        .otherwise(of("unknown", none, none, none))
    )


def era(year: Column) -> Column:
    return F.when(year == "", "unknown").when(year < "1999", "pre_1999").otherwise("1999_plus")


def source_slugs(text: Column) -> Column:
    """Slugs of the works that a source line names, distinct and sorted."""
    pattern = r"(?iu)(ot\.prp\.|prop\.|st\.meld\.|st\.prp\.|innst\.)\s*(?:nr\.?\s*)?(\d{1,4})\s*(?:([A-ZÆØÅ]{1,3})(?![A-Za-z0-9_]))?\s*(?:\(|–|\s)\s*(\d{4})"
    zipped = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in range(1, 5)))

    def one(x: Column) -> Column:
        kind = F.lower(x["0"])
        head = F.when(kind == "ot.prp.", "otprp").when(kind == "prop.", "prop").when(kind == "st.meld.", "meld-st").when(kind == "st.prp.", "stprp").otherwise("inns")
        variant = F.when(kind.isin("prop.", "innst.") & (F.coalesce(x["2"], F.lit("")) != ""), F.concat(F.lit("-"), F.lower(x["2"]))).otherwise("")
        return F.concat(head, F.lit("-"), x["1"], variant, F.lit("-"), x["3"], session_tail(x["3"]))

    reports = F.regexp_extract_all(text, F.lit(r"(?iu)(?<![A-Za-z0-9_])nou\s*(\d{4}\s*[:/\s]\s*\d{1,3})"), F.lit(1))
    named = F.transform(reports, lambda r: F.concat(F.lit("nou-"), F.regexp_replace(r, r"\s*[:/\s]\s*", "-")))
    return F.array_sort(F.array_distinct(F.concat(F.transform(zipped, one), named)))


def candidates(slug: Column) -> Column:
    """Publication ids to try for a committee report's slug, in order."""
    from .text import pad3

    parts = F.split(slug, "-")
    middle = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    numbers, variants = F.filter(middle, lambda p: p.rlike("^[0-9]+$")), F.filter(middle, lambda p: ~p.rlike("^[0-9]+$"))
    number, variant = F.when(F.size(numbers) == 1, pad3(F.get(numbers, F.lit(0)))), F.lower(F.coalesce(F.get(variants, F.size(variants) - 1), F.lit("")))
    plain = F.concat(F.lit("inns-"), F.element_at(parts, -1), F.lit("-"), number)
    out = F.when(variant == "o", F.array(F.concat(F.lit("inno-"), F.element_at(parts, -1), F.lit("-"), number))).when(variant.isin("l", "s"), F.array(F.concat(plain, variant), plain)).otherwise(F.array(plain))
    return F.when(F.startswith(slug, F.lit("inn")) & (F.size(parts) >= 4) & number.isNotNull(), out)
