r"""Line dedup: content-defined chunks of lines; globally repeated multi-line chunks are removed after byte comparison.

A hash rolls over the hashes of two neighbouring lines. A chunk ends after each line whose rolling hash is lower than that of the
line before it and not higher than that of the line after it, so chunks have two lines or more, three on average, and an
insertion shifts no boundary but those beside it. A run of equal lines has no such place inside and is one chunk's part. The first
line and the last but one end no chunk, so that no line stands alone but a text's only one.

Chunks that occur again, anywhere, are removed but for their first occurrence, by (doc_id, place). Places are matched by two 64-bit
hashes; the least and the greatest text of each group of hashes tell whether all are equal byte by byte, as they must be for a
chunk to go, and groups in which texts differ are matched by text. Only places and hashes are shuffled to find what repeats;
texts move once to meet their places, and those of repeated chunks once more, combined before, to be compared.

Defined results: every row is returned; a null text stays null, a text whose chunks all repeat becomes empty; a text of one line
stays. Rows with equal doc_id and text are one document and stay alike; a null doc_id comes first. Other columns pass untouched,
whatever their names; an input column removed_chunks is replaced. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, plain, table

ROLL, MODULUS = 31, 1_000_003
_NEVER = MODULUS + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body names it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _starts(lines: Column) -> Column:
    """The place of the first line of each chunk, and at the end the number of lines."""
    shifted = lambda x, by, fill: F.concat(F.array(F.lit(fill)), x) if by < 0 else F.concat(F.slice(x, F.lit(2), F.size(x)), F.array(F.lit(fill)))

    def of(rolled: Column) -> Column:
        low = F.zip_with(F.slice(shifted(rolled, -1, _NEVER), F.lit(1), F.size(rolled)), rolled, lambda a, b: b < a)
        ends = F.zip_with(F.zip_with(rolled, shifted(rolled, 1, -1), lambda a, b: a <= b), low, lambda a, b: a & b)
        places = F.filter(F.transform(ends, lambda e, i: F.when(e & (i > 0) & (i < F.size(rolled) - 2), i + 1)), lambda p: p.isNotNull())
        return F.concat(F.array(F.lit(0)), places, F.array(F.size(rolled)))

    def rolling(hashes: Column) -> Column:
        before = F.slice(shifted(hashes, -1, 0), F.lit(1), F.size(hashes))
        return F.transform(F.zip_with(hashes, before, lambda a, b: (a + ROLL * b) % MODULUS), lambda r, i: F.when(i == 0, F.lit(_NEVER).cast("long")).otherwise(r))

    return _let(rolling(F.transform(lines, _line_hash)), of)


def chunks(text: Column) -> Column:
    """(at, to, chunk) of the chunks of two lines or more: lines from at on, up to the line before to."""

    def of(lines: Column) -> Column:
        def ranges(starts: Column) -> Column:
            each = F.zip_with(F.slice(starts, F.lit(1), F.size(starts) - 1), F.slice(starts, F.lit(2), F.size(starts) - 1), lambda a, b: F.struct(a.alias("at"), b.alias("to")))
            return F.transform(F.filter(each, lambda r: r["to"] - r["at"] > 1), lambda r: F.struct(r["at"].alias("at"), r["to"].alias("to"), F.array_join(F.slice(lines, r["at"] + 1, r["to"] - r["at"]), "\n").alias("chunk")))

        return _let(_starts(lines), ranges)

    return _let(F.split(text, "\n"), of)


def _without(text: Column, cut: Column) -> Column:
    """text without the lines of cut, an array of disjoint (at, to): the lines between are taken as slices, in one go."""

    def of(lines: Column) -> Column:
        def between(sorted_: Column) -> Column:
            begins = F.concat(F.array(F.lit(0)), F.transform(sorted_, lambda r: r["to"]))
            ends = F.concat(F.transform(sorted_, lambda r: r["at"]), F.array(F.size(lines)))
            return F.array_join(F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(lines, a + 1, b - a))), "\n")

        return _let(F.array_sort(cut), between)

    return _let(F.split(text, "\n"), of)


def _hashes(chunk: Column) -> dict[str, Column]:
    return {"h": F.xxhash64(chunk), "g": F.xxhash64(F.lit("again"), chunk)}


def dedup(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns, with repeated chunks cut out of the text, and the number cut as removed_chunks."""
    docs, names = plain(documents, without=["removed_chunks"])
    t, i = (F.col(names[c]) for c in (text, doc_id))
    row = F.xxhash64(t)
    place = F.struct("id", "row", "at")

    pieces = docs.where(t.isNotNull()).select(i.alias("id"), row.alias("row"), F.inline(chunks(t)))
    places = table(pieces.select("id", "row", "at", "to", *(v.alias(k) for k, v in _hashes(F.col("chunk")).items())), "places")
    first = places.groupBy("h", "g").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = table(first.where(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "first")  # apart, so that the join can split hot chunks
    again = places.join(first, ["h", "g"]).withColumn("is_first", place.eqNullSafe(F.col("first")))
    again = again.groupBy("id", "row").agg(F.collect_set(F.struct("at", "to", "h", "g", "is_first")).alias("again")).withColumnsRenamed({"id": "of", "row": "of_row"})
    held = table(docs.withColumn("row", row).join(again, i.eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left").drop("of", "of_row"), "held")
    drop(places, first)

    lines = F.split(t, "\n")
    chunk = _let(lines, lambda x: F.transform("again", lambda r: F.struct(r["at"].alias("at"), r["to"].alias("to"), r["h"].alias("h"), r["g"].alias("g"), F.array_join(F.slice(x, r["at"] + 1, r["to"] - r["at"]), "\n").alias("chunk"))))
    repeated = held.where("again is not null").select(i.alias("id"), "row", F.inline(chunk))
    differ = table(repeated.groupBy("h", "g").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).where("lo <> hi").select("h", "g"), "differ")
    cut = F.transform(F.filter("again", lambda r: ~r["is_first"]), lambda r: F.struct(r["at"].alias("at"), r["to"].alias("to")))
    held = held.withColumn("cut", cut)
    if differ.limit(1).count():  # equal hashes, other bytes: these are matched by their text
        other = repeated.join(differ, ["h", "g"])
        true = other.groupBy("h", "g", "chunk").agg(F.min(place).alias("first"))
        other = other.join(true, ["h", "g", "chunk"]).groupBy("id", "row").agg(
            F.collect_set(F.struct("at", "to")).alias("judged"),
            F.collect_set(F.when(~place.eqNullSafe(F.col("first")), F.struct("at", "to"))).alias("gone"),
        ).withColumnsRenamed({"id": "of", "row": "of_row"})
        held = held.join(other, i.eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
        held = held.withColumn("cut", F.when(F.col("judged").isNull(), F.col("cut")).otherwise(F.array_union(F.array_except("cut", "judged"), F.col("gone"))))
    some = F.size("cut") > 0  # false or null: nothing goes
    new = F.when(some, _without(t, F.col("cut"))).otherwise(t)
    out = [(new if c == text else F.col(p)).alias(c) for c, p in names.items()]
    return held.select(*out, F.when(some, F.size("cut")).otherwise(0).cast("long").alias("removed_chunks"))


ORACLE = f"""
with lines as (
  select doc_id, unnest(l) as line, generate_subscripts(l, 1) as pos, len(l) as n
  from (select doc_id, string_split(text, chr(10)) as l from documents where text is not null)),
hashed as (
  select *, cast('0x' || substr(md5(line), 1, 8) as bigint) as h from lines),
rolled as (
  select *, case when pos > 1 then (h + {ROLL} * lag(h) over w) % {MODULUS} else {_NEVER} end as r from hashed window w as (partition by doc_id order by pos)),
bounded as (
  select *, coalesce(pos > 1 and pos < n - 1 and r < lag(r) over w and r <= lead(r) over w, false) as ends from rolled window w as (partition by doc_id order by pos)),
placed as (
  select *, coalesce(sum(ends::int) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as k from bounded),
chunk as (
  select doc_id, k, string_agg(line, chr(10) order by pos) as chunk, count(*) as n from placed group by doc_id, k),
marked as (
  select *, n >= 2 and row_number() over (partition by chunk order by doc_id, k) > 1 as again from chunk),
rest as (
  select doc_id, string_agg(chunk, chr(10) order by k) filter (where not again) as text, count(*) filter (where again) as removed_chunks
  from marked group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(r.text, '') end as text, coalesce(r.removed_chunks, 0)::bigint as removed_chunks
from documents d left join rest r using (doc_id)
"""
