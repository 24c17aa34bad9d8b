"""String rules as columns. Words, white space and boundaries follow the corpus conventions, not Java's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
REFUSALS = [
    "kan ikke", "ikke kan", "kan dessverre ikke", "finner ikke", "ikke finne", "har ikke", "ikke har", "inneholder ikke",
    "ikke inneholder", "kan ikke besvare", "ikke besvare", "kan ikke svare", "ikke svare", "ikke tilgjengelig", "ikke mulig",
    "ikke dekket", "utenfor", "cannot find", "does not contain", "not contain", "not available", "no answer", "ikke finner",
    "ikke har grunnlag",
]
SECTION_WORDS = {
    "kapittel": "Kapittel", "paragraf": "paragraf", "ledd": "ledd", "nummer": "nr.", "punkt": "punkt", "del": "del",
    "avsnitt": "avsnitt", "dokumentendring": "dokumentendring", "endring": "endring",
}
RETRYABLE = ["timeout", "connection reset", "connection refused", "eof", "429", "500", "502", "503", "504", "too many requests"]


def blank_null(c: Column) -> Column:
    """Null for a null or blank string."""
    return F.when(F.trim(c) != "", c)


def squeeze(c: Column) -> Column:
    """Unicode white space as single spaces, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def byte_length(c: Column) -> Column:
    return F.octet_length(c)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{Nd}]+"), lambda t: t != "")


def words(c: Column) -> Column:
    return F.filter(F.split(squeeze(c), " "), lambda t: t != "")


def contains_any(c: Column, terms: list[str]) -> Column:
    """Whether the lower-cased text holds any of a few fixed terms."""
    low = F.lower(c)
    return F.exists(F.array(*(F.lit(t) for t in terms)), lambda t: F.contains(low, t))


def is_refusal(c: Column) -> Column:
    return contains_any(c, REFUSALS)


def is_retryable(c: Column) -> Column:
    return contains_any(c, RETRYABLE)


def is_digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def pad3(c: Column) -> Column:
    """At least three digits."""
    return F.when(F.length(c) < 3, F.lpad(c, 3, "0")).otherwise(c)


def key_part(c: Column) -> Column:
    """A-Z lower-cased, any other character but a-z and 0-9 as one underscore."""
    plain = F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(plain, "[^a-z0-9]", "_")


def is_heading(c: Column) -> Column:
    return F.startswith(F.trim(c), F.lit("#"))


def strip_heading(c: Column) -> Column:
    """Without the heading line that a provision's text begins with."""
    return F.trim(F.regexp_replace(c, "^###[^\n]*\n?", ""))


def cap(c: Column, n: int) -> Column:
    """At most n characters, with an ellipsis if cut."""
    return F.when(F.char_length(c) > n, F.concat(F.rtrim(F.substring(c, 1, n)), F.lit("…"))).otherwise(c)


def first_sentence(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, r"^([^.!?\n]*[.!?]?)", 1))


def short_title(c: Column) -> Column:
    """A title cut before a bracket that comes after 20 bytes, and at 120."""
    head = F.when(F.octet_length(F.substring_index(c, "(", 1)) > 20, F.substring_index(c, "(", 1)).otherwise(c)
    return F.trim(F.substring(F.trim(head), 1, 120))


def excerpt(content: Column, quote: Column, margin: int = 80, limit: int = 320) -> Column:
    """The quote with a margin of characters at either side, marked where text is left out; else the text's start."""
    at = F.instr(content, quote)
    begin = F.greatest(F.lit(1), at - margin)
    end = F.least(F.char_length(content), at + F.char_length(quote) - 1 + margin)
    cut = F.concat(F.when(begin > 1, "…").otherwise(""), F.substring(content, begin, end - begin + 1), F.when(end < F.char_length(content), "…").otherwise(""))
    start = F.when(F.char_length(content) > limit, F.concat(F.substring(content, 1, limit), F.lit("…"))).otherwise(content)
    return F.when(at > 0, cut).otherwise(start)


def section_label(section_id: Column) -> Column:
    """A readable position from a structural id: "kapittel-3-ledd-2" gives "Kapittel 3, ledd 2"; equal neighbours collapse."""
    table = F.create_map(*(F.lit(x) for pair in SECTION_WORDS.items() for x in pair))
    named = F.filter(F.split(F.regexp_replace(section_id, r"-(?=[0-9]+(-|$))", " "), "-"), lambda s: s != "")

    def label(s: Column) -> Column:
        word = F.substring_index(s, " ", 1)
        return F.concat(F.coalesce(F.try_element_at(table, F.lower(word)), F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1 << 20))), F.substring(s, F.char_length(word) + 1, F.char_length(s)))

    labels = F.transform(named, label)
    kept = F.zip_with(labels, F.concat(F.array(F.lit(None).cast("string")), labels), lambda a, b: F.when(a.eqNullSafe(b), F.lit(None)).otherwise(a))
    return F.array_join(F.filter(kept, lambda x: x.isNotNull()), ", ")


def points(c: Column) -> Column:
    """Guide text as points: parts between blank lines, cut again before numbered or lettered lines; page noise left out."""
    bullet = r"^\s*(?:[a-zæøå][).](?:[ \t]|$)|(?:§[ \t]*)?[0-9][0-9.]*(?:[). \t]))"
    text = F.regexp_replace(c, "\r\n", "\n")
    marked = F.transform(F.split(text, "\n\n"), lambda b: F.array_join(F.transform(F.split(b, "\n"), lambda x: F.when(x.rlike(bullet), F.concat(F.lit("\u0001"), x)).otherwise(x)), " "))
    parts = F.flatten(F.transform(marked, lambda b: F.split(b, "\u0001")))
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: (p != "") & ~is_noise(p))


def is_noise(c: Column) -> Column:
    low = F.lower(c)
    return (F.contains(low, F.lit("sensorveiledning")) & (F.octet_length(c) < 60)) | (F.contains(low, F.lit("side ")) & F.contains(low, F.lit(" av "))) | c.isin("1", "2", "3")


def natural_key(c: Column) -> Column:
    """A string whose order is that of c with runs of digits, however long, compared as numbers: by their length, then by digit."""

    def part(x: Column) -> Column:
        digits = F.regexp_replace(x, "^0+(?=.)", "")
        return F.when(is_digits(x), F.concat(F.lit("0"), F.lpad(F.char_length(digits).cast("string"), 10, "0"), digits)).otherwise(F.concat(F.lit("1"), x))

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)), part), "")
