"""Sinks: portable dumps, manifests, items, idempotent upserts, audit gates."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.operators import graph


def canonical_json(row: str = "properties"):
    """A map as JSON with sorted keys, nulls left out."""
    kept = F.map_filter(row, lambda _, v: v.isNotNull())
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


class GateError(RuntimeError):
    """Raised before anything is written."""


def same_json(a, b):
    """Whether two JSON texts hold the same value, whatever the order of their keys, blanks and the way that numbers are written."""

    def plain(c):
        text = F.to_json(F.try_parse_json(c))
        return F.regexp_replace(text, r'((?:^|[:\[,])-?\d+)(?:\.0+|(\.\d*[1-9])0+)(?=[,\]}]|$)', "$1$2")

    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.coalesce(plain(a) == plain(b), F.lit(False)))


def in_files(rows: DataFrame, max_bytes: int) -> DataFrame:
    """rows dealt out by type so that a file of one type holds about so many bytes of JSON at most; types are few."""
    size = F.octet_length(F.to_json(F.struct(*rows.columns))) + 1
    parts = [(r[0], max(1, -(-r[1] // max_bytes))) for r in rows.groupBy("type").agg(F.sum(size)).orderBy("type").collect()]
    if not parts:
        return rows
    begins = [sum(n for _, n in parts[:k]) for k in range(len(parts))]
    table = F.create_map(*(x for (t, n), b in zip(parts, begins) for x in (F.lit(t), F.struct(F.lit(b).alias("begin"), F.lit(n).alias("parts")))))
    mine = F.element_at(table, F.col("type"))
    return rows.repartitionById(sum(n for _, n in parts), (mine["begin"] + F.pmod(F.xxhash64(*[c for c in rows.columns if c != "properties"]), mine["parts"])).cast("int"))


def changes(old: dict | None, new: dict) -> dict[str, tuple[int, int]]:
    """Counts by type that differ between two manifests; without an old one all do."""
    a, b = ((m or {}).get("counts", {}).get("by_type", {}) for m in (old, new))
    return {t: (a.get(t, 0), b.get(t, 0)) for t in sorted(a.keys() | b.keys()) if a.get(t, 0) != b.get(t, 0)}


def dump(objects: DataFrame, edges: DataFrame, path: str, *, max_bytes: int = 50_000_000, coverage: DataFrame | None = None, least: float | None = None) -> dict:
    """Writes objects and edges as JSON lines by type, after dedupe and endpoint filter, and returns the manifest's counts.

    The coverage gate is checked first; a stale dump is overwritten as a whole.
    """
    if coverage is not None and least is not None:
        bad = coverage.agg(F.min("coverage")).first()[0]
        if bad is not None and bad < least:
            raise GateError(f"coverage {bad:.4f} is below {least}")
    first = graph.dedupe_first(objects, ["key"], ["ord"]).drop("ord")
    kept = graph.endpoint_filter(edges, first).drop("ord")
    for rows, name in ((first, "objects"), (kept, "relationships")):
        in_files(rows, max_bytes).write.mode("overwrite").option("ignoreNullFields", True).partitionBy("type").json(f"{path}/{name}")
    spark = objects.sparkSession
    by = {name: {r[0]: r[1] for r in graph.type_counts(spark.read.json(f"{path}/{name}")).collect()} for name in ("objects", "relationships")}
    return {"counts": {"objects": sum(by["objects"].values()), "relationships": sum(by["relationships"].values()), "by_type": dict(sorted((by["objects"] | by["relationships"]).items()))}}


def write_manifest(rows: DataFrame, manifest: dict, path: str) -> None:
    """One indented JSON file with sorted keys, by Spark's own writer so that any store will do."""
    spark = rows.sparkSession
    spark.createDataFrame([(json.dumps(manifest, indent=2, sort_keys=True, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_items(items: DataFrame, unresolved: DataFrame, path: str) -> None:
    items.coalesce(1).write.mode("overwrite").json(f"{path}/items")
    unresolved.coalesce(1).write.mode("overwrite").json(f"{path}/unresolved")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The latest row of each key of both."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.groupBy(*keys).agg(F.max_by(F.struct(*both.columns), order).alias("__r")).select("__r.*")


def not_yet_written(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed load still has to write."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def push(rows: DataFrame, send: Callable[[list[dict]], None], batch: int = 100, retries: int = 1) -> None:
    """Sends rows in batches from the executors; a batch that fails is tried again. send must be idempotent by key, as tasks may rerun."""

    def each(part):
        held: list[dict] = []

        def flush() -> None:
            for k in range(retries + 1):
                try:
                    send(held)
                    break
                except Exception:
                    if k == retries:
                        raise
            held.clear()

        for r in part:
            held.append(r.asDict(recursive=True))
            if len(held) >= batch:
                flush()
        if held:
            flush()

    rows.foreachPartition(each)


class Conflict(RuntimeError):
    """Raised by a store that has one of a batch's keys already."""


def pushed(rows: DataFrame, key: str, send: Callable[[list[dict]], list[str]], lookup: Callable[[str], str | None], batch: int = 100, retries: int = 1) -> DataFrame:
    """key, id, problem of every row after it was sent: batches go out from the executors and are tried again; after a conflict each row of
    the batch goes alone, and one that is there already gets the id that the store has for it. Failed rows say why and may be sent again.

    What is returned is the id map and the log of failures of a load: write it, and resume with not_yet_written().
    """
    from collections.abc import Iterator

    import pandas as pd

    kind = rows.schema[key].dataType.simpleString()

    def attempt(part: list[dict]) -> list[tuple]:
        problem = ""
        for _ in range(retries + 1):
            try:
                return [(r[key], i, None) for r, i in zip(part, send(part), strict=True)]
            except Conflict:
                if len(part) > 1:
                    return [x for r in part for x in attempt([r])]
                held = lookup(part[0][key])
                return [(part[0][key], held, None if held is not None else "conflict, not found")]
            except Exception as e:
                problem = f"{type(e).__name__}: {e}"
        return [(r[key], None, problem) for r in part]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            records = f.to_dict("records")
            for lo in range(0, len(records), batch):
                yield pd.DataFrame(attempt(records[lo : lo + batch]), columns=[key, "id", "problem"])

    return rows.mapInPandas(run, f"{key} {kind}, id string, problem string")
