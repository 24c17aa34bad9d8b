"""Citation rules as columns: act and section references, provision keys, reference matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACT = r"(?:lov|forskrift)/\d{4}-\d{2}-\d{2}(?:-\d{1,4})?"
SECTION = r"(?<!§)§\s*(\d+(?:\s*[-–—]\s*\d+)?[a-zæøå]*)"
REF_ID = r"^(lov|forskrift)/\d{4}-\d{2}-\d{2}(-\d+)?$"
WINDOW = 80


def act_refs(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(f"({ACT})"), F.lit(1))


def section_token(raw: Column) -> Column:
    """Dashes as hyphens, blanks dropped."""
    return F.translate(raw, "–— \t", "--")


def section_refs(line: Column) -> Column:
    """Normalised tokens of the single section references of a line; plural "§§" is none."""
    return F.transform(F.regexp_extract_all(line, F.lit(SECTION), F.lit(1)), section_token)


def paragraph_number(c: Column) -> Column:
    """A printed paragraph number without its sign, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^(?:§\s*)+", ""), r"(?U)\s+", " "))


def attributed(line: Column, owner: Column) -> Column:
    """(token, act) of each section reference of a line: the first act reference that ends at most WINDOW bytes before it with
    no other section reference between, else the owner."""
    pieces = F.split(F.concat(F.lit(" "), line), r"(?<!§)(?=§\s*\d)")
    # A piece starts at a section reference; only the piece before it can hold an act reference without one between.
    numbered = F.zip_with(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda piece, before: F.struct(piece.alias("piece"), before.alias("before")))

    def act(before: Column) -> Column:
        near = F.filter(
            F.transform(act_refs(before), lambda a: F.struct(a.alias("act"), F.octet_length(F.element_at(F.split(before, F.concat(F.lit(r"\Q"), a, F.lit(r"\E(?!\d)"))), -1)).alias("gap"))),
            lambda x: x["gap"] <= WINDOW,
        )
        return F.get(near, F.lit(0))["act"]

    found = F.transform(numbered, lambda x: F.struct(section_token(F.regexp_extract(x["piece"], r"^§\s*(\d+(?:\s*[-–—]\s*\d+)?[a-zæøå]*)", 1)).alias("token"), F.coalesce(act(x["before"]), owner).alias("act")))
    return F.filter(found, lambda x: x["token"] != "")


def act_of(ref: Column) -> Column:
    return F.substring_index(ref, "#", 1)


def fragment_of(ref: Column) -> Column:
    """What follows the first #; empty if none."""
    return F.when(F.contains(ref, F.lit("#")), F.substring(ref, F.instr(ref, F.lit("#")) + 1, F.char_length(ref))).otherwise("")


def paragraph_ref(act: Column, number: Column, section: Column) -> Column:
    """act#§number, else act#section, else act."""
    n = paragraph_number(number)
    return F.when(n != "", F.concat(act, F.lit("#§"), n)).when(section != "", F.concat(act, F.lit("#"), section)).otherwise(act)


def canonical_ref(ref: Column) -> Column:
    n = paragraph_number(fragment_of(ref))
    return F.when(n == "", act_of(ref)).otherwise(F.concat(act_of(ref), F.lit("#§"), n))


def match_score(a: Column, b: Column) -> Column:
    """1 for the same act and section, 0.5 for the same act, else 0."""
    same = act_of(a) == act_of(b)
    return F.when(same & (paragraph_number(fragment_of(a)) == paragraph_number(fragment_of(b))), 1.0).when(same, 0.5).otherwise(0.0)


def best_match(ref: Column, others: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(others, lambda o: match_score(ref, o))), F.lit(0.0))


def mean_best(refs: Column, others: Column) -> Column:
    return F.aggregate(refs, F.lit(0.0), lambda s, r: s + best_match(r, others)) / F.size(refs)


def precision(cited: Column, gold: Column) -> Column:
    return F.when(F.size(cited) == 0, 0.0).otherwise(mean_best(cited, gold))


def recall(cited: Column, gold: Column) -> Column:
    return F.when(F.size(gold) == 0, 1.0).otherwise(mean_best(gold, cited))


def f1(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))
