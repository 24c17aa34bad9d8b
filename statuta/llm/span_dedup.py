r"""Substring dedup: sliding spans of consecutive sentences; sentences covered by any span that isn't its first are removed.

A sentence goes to the end of the next run of ``. ! ?`` and line breaks and of the blanks after it; sentences join to the text
again without loss. At each sentence a span begins that goes on until it has ``RUN`` sentences and ``WORDS`` words, or ``LONG``
words in any number of sentences, whichever is first; the last span of a text goes on to its end, and a text too short for any
is one span. So short phrases that repeat by chance are lengthened by what follows them, none is left out, and a long sentence
is a span of its own. A passage that is cut in the middle of sentences at its edges is found by the whole sentences in it.

Spans, their sentences trimmed, are hashed to 128 bits and met globally by hash. Of the spans of one hash within a few thousand
documents all but the first are known not to be the first before any shuffle, so a span that a third of all documents hold
sends a few rows from each task. A stream over the sorted rest holds one span at a time. The first occurrence, by
(doc_id, place), stays.

Defined results: every row is returned; a null text stays null, a text that only repeats becomes empty. Rows with equal doc_id and
text are one document and stay alike; a null doc_id comes first. Other columns pass untouched, whatever their names; an input
column removed_sentences is replaced. No group is gathered but the spans cut in one text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

RUN, WORDS, LONG = 2, 20, 30
SENTENCE = r"[^.!?\n]+[.!?\n]*[ \t\r]*|[.!?\n]+[ \t\r]*"
AT_ONCE = 1 << 16
_SENTENCE = re.compile(SENTENCE.encode())


def runs(words: list[int]) -> list[tuple[int, int]]:
    """(first sentence, the one after the last) of the spans of a text whose sentences have so many words."""
    out, n, e, total = [], len(words), 0, 0
    for k in range(n):
        if e < k:
            e, total = k, 0
        while e < n and not (total >= WORDS and e - k >= RUN or total >= LONG):
            total += words[e]
            e += 1
        if not (total >= WORDS and e - k >= RUN or total >= LONG):
            break
        # The last sentence may have come too early for this shorter run: it ends as soon as it may.
        while total - words[e - 1] >= LONG or (total - words[e - 1] >= WORDS and e - 1 - k >= RUN):
            e -= 1
            total -= words[e]
        out.append((k, e))
        total -= words[k]
    if not out:
        return [(0, n)] if n else []
    return out if out[-1][1] == n else [*out, (out[-1][0], n)]


def spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends in bytes, and two hashes, of the spans of a text."""
    units = [m.span() for m in _SENTENCE.finditer(raw)]
    trimmed = [raw[b:e].strip(b" \t\r\n") for b, e in units]
    joined, offsets = b"\n".join(trimmed), np.concatenate([[0], np.cumsum([len(t) + 1 for t in trimmed], dtype=np.int64)]).tolist()
    found = runs([len(t.split()) for t in trimmed])
    digests = b"".join(hashlib.blake2b(joined[offsets[k] : offsets[e] - 1], digest_size=16).digest() for k, e in found)
    return np.array([units[k][0] for k, _ in found], dtype=np.int64), np.array([units[e - 1][1] for _, e in found], dtype=np.int64), np.frombuffer(digests, dtype="<i8").reshape(-1, 2)


def _combined(ids: pa.Array, rows: np.ndarray, at: list, begins: list, ends: list, hashes: list) -> pa.RecordBatch:
    """Spans of a few documents: of each hash the first one, to meet others, and the rest as known repeats (again)."""
    at, begins, ends, hashes = (np.concatenate(x) for x in (at, begins, ends, hashes))
    rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)[at]
    row = rows[at]
    order = np.lexsort((begins, row, rank, hashes[:, 1], hashes[:, 0]))
    h, g = hashes[order, 0], hashes[order, 1]
    head = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    same = (rank[order] == rank[first]) & (row[order] == row[first]) & (begins[order] == begins[first])
    keep = head | ~same  # rows that are equal in doc_id and text stand at one place
    order, again, h, g = order[keep], ~head[keep], h[keep], g[keep]
    key = np.where(again, C.mix(row[order].view(np.uint64)).view(np.int64), h)
    columns = [pa.array(key), pa.array(again), pa.array(h), pa.array(g), ids.take(pa.array(at[order])), pa.array(row[order]), pa.array(begins[order]), pa.array(ends[order])]
    return pa.RecordBatch.from_arrays(columns, names=["key", "again", "h", "g", "id", "row", "at", "to"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of (id, row, text)."""
    for b in batches:
        ids, rows, size = b.column(0), b.column(1).to_numpy(zero_copy_only=False), 0
        raw, offsets = C.text_buffer(b.column(2))
        found: tuple[list, ...] = ([], [], [], [])
        for k in range(b.num_rows):
            begins, ends, hashes = spans(raw[offsets[k] : offsets[k + 1]].tobytes())
            for x, y in zip(found, (np.full(len(begins), k), begins, ends, hashes), strict=True):
                x.append(y)
            size += len(begins)
            if size >= AT_ONCE:
                yield _combined(ids, rows, *found)
                found, size = ([], [], [], []), 0
        if size:
            yield _combined(ids, rows, *found)
    C.trim()


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash and place, those that aren't the first of their hash, and those known as repeats."""
    held: tuple = (None, None, None, None, None)  # hashes and place of the first of the last hash
    for b in batches:
        if not b.num_rows:
            continue
        again, h, g = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        like = np.zeros(len(h), dtype=bool)
        like[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1]) & ~again[1:] & ~again[:-1]
        like[0] = not again[0] and (h[0], g[0]) == held[:2]
        out = again.copy()
        place = [b.column(k) for k in (4, 5, 6)]
        for k in np.flatnonzero(like).tolist():
            if not like[k - 1] and k:
                held = (h[k - 1], g[k - 1], *(p[k - 1].as_py() for p in place))
            out[k] = tuple(p[k].as_py() for p in place) != held[2:]
        last = len(h) - 1
        if not again[last] and not like[last]:
            held = (h[last], g[last], *(p[last].as_py() for p in place))
        yield pa.RecordBatch.from_arrays([b.column(k) for k in (4, 5, 6, 7)], names=["id", "row", "at", "to"]).filter(pa.array(out))
    C.trim()


def without(raw: bytes, cuts: list[tuple[int, int]]) -> tuple[str, int]:
    """The text left, and how many sentences were cut."""
    kept, last, removed = [], 0, 0
    for b, e in sorted(cuts):
        if e > last:
            kept.append(raw[last : max(b, last)])
            removed += sum(1 for _ in _SENTENCE.finditer(raw, max(b, last), e))
            last = e
    return b"".join([*kept, raw[last:]]).decode(), removed


def dedup(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns, with repeated sentences cut out of the text, and the number cut as removed_sentences."""
    docs, names = C.plain(documents, without=["removed_sentences"])
    t, i = F.col(names[text]), F.col(names[doc_id])
    row, kind = F.xxhash64(t).alias("row"), docs.schema[names[doc_id]].dataType.simpleString()
    rows = docs.where(t.isNotNull()).select(i.alias("id"), row, t.alias("text"))
    found = rows.mapInArrow(_spread, f"key long, again boolean, h long, g long, id {kind}, row long, at long, to long")
    met = found.repartition("key").sortWithinPartitions("key", "again", "h", "g", "id", "row", "at")
    cut = met.mapInArrow(_repeats, f"id {kind}, row long, at long, to long")
    cut = cut.groupBy(F.col("id").alias("of"), F.col("row").alias("of_row")).agg(F.collect_set(F.struct("at", "to")).alias("cuts"))
    cut = C.table(cut.select("of", "of_row", F.transform("cuts", lambda x: x["at"]).alias("begins"), F.transform("cuts", lambda x: x["to"]).alias("ends")), "cuts")
    joined = docs.withColumn("row", row).join(cut, i.eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left").select(*names.values(), "begins", "ends")
    where, n = list(names).index(text), len(names)

    def cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.flatnonzero(b.column(n).is_valid().to_numpy(zero_copy_only=False))
            removed, old = np.zeros(b.num_rows, dtype=np.int64), b.column(where)
            if len(at):
                new = old.to_pylist()
                for k in at.tolist():
                    new[k], removed[k] = without(new[k].encode(), list(zip(b.column(n)[k].as_py(), b.column(n + 1)[k].as_py())))
                old = pa.array(new, old.type)
            columns = [*b.columns[:where], old, *b.columns[where + 1 : n], pa.array(removed)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names.values(), "removed"])
        C.trim()

    schema = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(names.values(), docs.schema, strict=True)) + ", removed long"
    return joined.mapInArrow(cutting, schema).toDF(*names, "removed_sentences")


ORACLE = f"""
with units as (
  select doc_id, unnest(u) as s, generate_subscripts(u, 1) as pos, len(u) as n
  from (select doc_id, regexp_extract_all(text, '{SENTENCE}') as u from documents where text is not null)),
counted as (
  select *, trim(s, ' ' || chr(9) || chr(13) || chr(10)) as t, len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) as words from units),
summed as (
  select *, sum(words) over (partition by doc_id order by pos) as total from counted),
marks as (
  select doc_id, pos, total from summed where words > 0),
ends as (
  select a.doc_id, a.pos, a.n, case when b.pos is not null then greatest(b.pos, a.pos + {RUN - 1}) end as least_end, c.pos as long_end
  from (select *, total - words + {WORDS} as to_words, total - words + {LONG} as to_long from summed) a
  asof left join marks b on a.doc_id = b.doc_id and a.to_words <= b.total
  asof left join marks c on a.doc_id = c.doc_id and a.to_long <= c.total),
spans as (
  select doc_id, pos, n, least(case when least_end <= n then least_end end, long_end) as e from ends),
latest as (
  select doc_id, max(n) as n, max(pos) filter (where e is not null) as pos, arg_max(e, pos) filter (where e is not null) as e from spans group by doc_id),
every as (
  select doc_id, pos, e from spans where e is not null
  union all select doc_id, coalesce(pos, 1), n from latest where pos is null or e < n),
texts as (
  select doc_id, list(t order by pos) as ts from counted group by doc_id),
marked as (
  select doc_id, pos, e, row_number() over (partition by list_slice(ts, pos, e) order by doc_id, pos) > 1 as again from every join texts using (doc_id)),
gone as (
  select distinct u.doc_id, u.pos from units u join marked m on u.doc_id = m.doc_id and m.again and u.pos between m.pos and m.e),
rest as (
  select u.doc_id, string_agg(u.s, '' order by u.pos) filter (where g.pos is null) as text, count(g.pos) as removed
  from units u left join gone g on u.doc_id = g.doc_id and u.pos = g.pos group by u.doc_id)
select d.doc_id, case when d.text is null then null else coalesce(r.text, '') end as text, coalesce(r.removed, 0)::bigint as removed_sentences
from documents d left join rest r using (doc_id)
"""
