"""Mixing sources to target weights: hash-random keys, range-sorted within each source, cut at each source's exact budget.

Sources in order of code point, null last, weigh 5, 2, 1, repeating. Together they are to give ``SHARE`` times all words; a
target stops at ``EPOCHS`` times its source's words, and the excess is shared by weight among the rest until none is above.
Each document gets a key from a hash of its id and text, so that rows without an id spread too; keys fall into equal ranges of about ``RANGE`` documents within their source,
so no source's rows need to meet in one task. Range totals give each range's start, a window inside a range the start of each
document, and a document gives whole epochs and then what is left of the budget at its start, so that a source's taken words
add up to its target, rounded down.

Targets come from a table of one row for each source, which one task orders.

Defined results: every row is returned; a null text has size 0. Rows that are equal in doc_id and text may trade their taken
words. A corpus without words has targets 0. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, words_count

SHARE, EPOCHS, RANGE, SEED = 1.5, 2, 4096, "mix"
#: So many sources are broadcast; more are joined by their rank, which adaptive execution splits where it is skewed.
FEW_SOURCES = 50_000


def _targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, budget and the number of ranges of each source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("__rank", F.row_number().over(ordered)).withColumn("__w", F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.col("__rank") - 1) % 3 + 1))
    every, filled = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("__w"), "__rank")
    by = by.withColumns({
        "__cap": F.col("source_size") * EPOCHS,
        "__all": F.sum("source_size").over(every) * F.lit(SHARE),
        "__before": F.coalesce(F.sum(F.col("source_size") * EPOCHS).over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__rest": F.sum("__w").over(filled.rowsBetween(0, Window.unboundedFollowing)),
    })
    by = by.withColumn("__full", (F.col("__all") - F.col("__before")) / F.col("__rest") * F.col("__w") > F.col("__cap"))
    by = by.withColumns({"__given": F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0)).over(every), "__open": F.sum(F.when(F.col("__full"), 0).otherwise(F.col("__w"))).over(every)})
    share = (F.col("__all") - F.col("__given")) / F.when(F.col("__open") > 0, F.col("__open")) * F.col("__w")
    target = F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(F.least(share, F.col("__cap").cast("double")))
    return by.select("source", "source_size", "__rank", target.alias("target"), F.floor(target).alias("__budget"), F.ceil(F.col("__rows") / RANGE).alias("__ranges"))


def mix(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce("text", F.lit("")))))
    sizes = table(documents.select("doc_id", "source", words_count(F.col("text")).alias("size"), key.alias("__key")), "sizes")
    targets = table(_targets(sizes), "targets")
    mine = targets.withColumnRenamed("source", "__source")
    placed = sizes.join(F.broadcast(mine) if targets.count() <= FEW_SOURCES else mine, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    at = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32)) * F.col("__ranges"))
    placed = placed.withColumn("__range", at)
    totals = placed.groupBy("__rank", "__range").agg(F.sum("size").alias("__total"))
    before = F.coalesce(F.sum("__total").over(Window.partitionBy("__rank").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select("__rank", "__range", before.alias("__start"))
    inside = Window.partitionBy("__rank", "__range").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("__budget") / F.col("source_size"))).otherwise(0)
    left = F.col("__budget") - F.col("__whole") * F.col("source_size")
    rows = placed.join(starts, ["__rank", "__range"]).withColumns({"__start": start, "__whole": whole})
    taken = F.col("__whole") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("__start")))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


ORACLE = f"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         md5('{SEED}|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))) as key from documents),
by_source as (
  select *, [5, 2, 1][((rank - 1) % 3 + 1)::int] as w from (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank from sizes group by source)),
filled as (
  select *, {SHARE} * sum(source_size) over () as total, source_size * {EPOCHS} as cap,
    coalesce(sum(source_size * {EPOCHS}) over (order by source_size::double / w, rank rows between unbounded preceding and 1 preceding), 0) as before,
    sum(w) over (order by source_size::double / w, rank rows between current row and unbounded following) as rest from by_source),
judged as (
  select *, (total::double - before::double) / rest::double * w > cap as is_full from filled),
shared as (
  select *, sum(case when is_full then cap else 0 end) over () as given, sum(case when is_full then 0 else w end) over () as open from judged),
targets as (
  select source, source_size, case when is_full then cap::double else least((total::double - given::double) / nullif(open, 0)::double * w, cap::double) end as target from shared),
placed as (
  select s.doc_id, s.source, s.size, t.source_size, t.target, floor(t.target)::bigint as budget,
    coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sizes s join targets t on s.source is not distinct from t.source),
cut as (
  select *, case when source_size > 0 then budget // source_size else 0 end as whole from placed)
select doc_id, source, size, source_size, target, (whole * size + greatest(0, least(size, budget - whole * source_size - start)))::bigint as taken from cut
"""
