"""Quality classifier: importance resampling with hashed n-gram models of target and raw text, sampled by Gumbel top-k.

A text's tokens are its words, cut between punctuation and anything else; a token that repeats the one before it is written as
one sign. Its features are its distinct n-grams of 1 to ``ORDER`` tokens and the first ``PREFIX`` bytes of its tokens, hashed
into two tables. Two generative models count the documents that show a feature: all documents (raw), and those that half of the
labelled rows call good and not toxic (target). A cell's log weight is log p_target / p_raw, moved to zero as far as chance may
explain (``SIGMAS`` standard errors); a feature's is the nearer to zero of its two cells', and zero if they differ in sign, so
that a feature doesn't suffer from another one in its cell. A document's log weight is the sum over its n features, over
sqrt(1 + n / ``LONG``) as what chance leaves adds up in long texts.

The other half of the labelled rows says at which log weight good and bad part best. k, the size of the draw, is the number of
documents with that log weight or more; k documents are drawn without replacement by Gumbel top-k: the k largest of
``log_weight / TEMPERATURE + Gumbel(doc_id)``, found by an exact radix selection. Another seed draws other documents near the cut.

Defined results: a text without words (null, empty) is rejected; documents with equal keys at the cut are all kept; without
good labelled rows, or without bad ones, every text with words is kept. Repeated rows are kept or rejected together. Extra
columns pass through ``filter_documents`` untouched. The labelled rows used are at most ``max_labelled``, those of smallest
hash; every count and score covers all documents and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

BITS = 20
BLOCK = 1 << 15
MAX_LABELLED = 100_000
ORDER, PREFIX = 3, 5
SIGMAS = 3.0
TEMPERATURE = 0.2
LONG = 1000
UNIT = 1 << 20
FLUSH = 60_000
_REPEAT = np.uint64(0x5851F42D4C957F2D)


@dataclass
class Model:
    """Log weight of each cell, the log weight that parts good from bad, the least key kept (None: all)."""

    weights: np.ndarray
    cut: float
    least_key: int | None
    seed: int
    temperature: float


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, row of each feature from 0 on, its cells in both tables): each feature of a row once."""
    for row, to, h, at, heads in C.hashed(column, PREFIX, split=True):
        owner = np.repeat(np.arange(to - row, dtype=np.uint64), np.diff(at))
        token = h.copy()
        if len(h):
            token[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])] = _REPEAT
        keys, gram = [(owner << np.uint64(2 * BITS)) | (C.mix(heads + np.uint64(77)) >> np.uint64(64 - 2 * BITS))], np.zeros(len(h), np.uint64)
        for n in range(min(ORDER, len(h))):
            gram = gram[: len(h) - n] * np.uint64(0xC2B2AE3D27D4EB4F) + token[n:] + np.uint64(n + 1)
            whole = owner[: len(gram)] == owner[n:]
            keys.append((owner[: len(gram)][whole] << np.uint64(2 * BITS)) | (C.mix(gram[whole]) >> np.uint64(64 - 2 * BITS)))
        keys = np.sort(np.concatenate(keys))
        if len(keys):
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        low = np.uint64((1 << BITS) - 1)
        yield row, to, (keys >> np.uint64(2 * BITS)).astype(np.int32), ((keys >> np.uint64(BITS)) & low).astype(np.int32), (keys & low).astype(np.int32) + (1 << BITS)


def feature_weights(weights: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Of the weights of a feature's two cells the one nearer to zero; zero if they differ in sign."""
    a, b = weights[one], weights[two]
    return np.where(a * b > 0, np.where(np.abs(a) < np.abs(b), a, b), np.float32(0))


def _scores(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Log weights; not a number where there are no words."""
    out = np.full(len(column), np.nan)
    for row, to, rows, one, two in _features(column):
        n = np.bincount(rows, minlength=to - row)
        out[row:to] = np.where(n > 0, np.bincount(rows, feature_weights(weights, one, two), minlength=to - row) / np.sqrt(1 + n / LONG), np.nan)
    return out


def _labelled(labels: DataFrame, most: int) -> dict[int, bool]:
    """Good or bad by doc_id, of at most so many documents; bad if any of a document's rows says so; nulls are skipped."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(F.expr("quality = 1 and coalesce(toxic, 0) = 0")).alias("good"))
    rank = F.shiftrightunsigned(F.xxhash64(F.lit("labels"), "doc_id"), 11)
    if (n := one.count()) > most:  # only those that can be among the smallest reach the sort
        one = one.where(rank < F.lit(int((most + 6 * most**0.5 + 100) / n * (1 << 53))))
    return {r[0]: r[1] for r in one.orderBy(rank, "doc_id").limit(most).collect()}


def _trains(doc_id: int) -> bool:
    return int(C.mix(np.array([doc_id], dtype=np.int64).view(np.uint64))[0]) & 1 == 1


def weigh(documents: DataFrame, labelled: dict[int, bool]) -> np.ndarray:
    """Log weights of the cells from one pass over all documents."""
    target = {k for k, good in labelled.items() if good and _trains(k)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen, waiting, size = np.zeros((2 << BITS, 2), dtype=np.uint16), 0, ([], []), 0

        def add() -> None:
            for side in (0, 1):
                if waiting[side]:
                    at, times = np.unique(np.concatenate(waiting[side]), return_counts=True)
                    cells[at, side] += times.astype(np.uint16)
                    waiting[side].clear()

        for b in batches:
            chosen = np.array([x in target for x in b.column(0).to_pylist()], dtype=bool)
            for row, to, rows, one, two in _features(b.column(1)):
                if seen + to - row > FLUSH:  # no cell can overflow
                    add()
                    yield C.block_rows(cells, BLOCK)
                    cells[:], seen, size = 0, 0, 0
                seen, size = seen + to - row, size + len(one)
                mine = chosen[row:to][rows]
                waiting[0].extend([one, two])
                waiting[1].extend([one[mine], two[mine]])
                if size >= 1 << 20:
                    add()
                    size = 0
        add()
        yield C.block_rows(cells, BLOCK)
        C.trim()

    rows = documents.select("doc_id", "text").mapInArrow(count, "block int, cells binary")
    raw, wanted = np.zeros(2 << BITS, np.float32), np.zeros(2 << BITS, np.float32)
    for k, cells in C.blocks(C.add_blocks(rows, "uint16", "int64"), "int64"):
        raw[k * BLOCK : (k + 1) * BLOCK], wanted[k * BLOCK : (k + 1) * BLOCK] = cells[0::2], cells[1::2]
    out = log_weights(raw, wanted)
    C.trim()
    return out


def log_weights(raw: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log weights of cells from their counts in both models, a block at a time."""
    out = np.zeros(len(raw), np.float32)
    if not (total := wanted.sum(dtype=np.float64)):
        return out
    share = total / raw.sum(dtype=np.float64)
    for lo in range(0, len(raw), BLOCK):
        part = slice(lo, lo + BLOCK)
        seen, expected = wanted[part].astype(np.float64), np.maximum(raw[part] * share, 1e-9)
        error = SIGMAS * np.sqrt(seen + 1) + 1
        most, least = seen + error, np.maximum(seen - error, 1e-9)
        out[part] = np.where(most < expected, np.log(most / expected), np.where(least > expected, np.log(least / expected), 0.0))
    return out


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, log_weight (null: no words) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(_scores(b.column(1), weights), pa.float64(), from_pandas=True)], names=["doc_id", "log_weight"])
        C.trim()

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, log_weight double")


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight with the largest sum of the shares of good above and of bad below, in the middle of its gap."""
    if not len(good) or not len(bad):
        return -np.inf
    x = np.concatenate([good, bad])
    y = np.concatenate([np.full(len(good), -1.0 / len(good)), np.full(len(bad), 1.0 / len(bad))])
    order = np.argsort(x, kind="stable")
    x, y = x[order], np.cumsum(y[order])
    y[:-1][x[:-1] == x[1:]] = -np.inf
    best = int(np.argmax(y))
    return float(x[best] + x[min(best + 1, len(x) - 1)]) / 2 if y[best] > 0 else -np.inf


def gumbel_key(seed: int, temperature: float) -> Column:
    """The sampling key in units of 1 / UNIT, from doc_id and log_weight."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.round((F.col("log_weight") / F.lit(temperature) - F.log(-F.log(u))) * F.lit(UNIT)).cast("long")


def kth_largest(keys: DataFrame, k: int, column: str) -> int:
    """The k-th largest value of a long column, exactly: histograms of at most 65,537 bins, each over one bin of the last."""
    lo, hi = keys.agg(F.min(column), F.max(column)).first()
    while lo < hi:
        shift = max(0, (hi - lo).bit_length() - 16)
        inside = keys.where(F.col(column).between(lo, hi))
        bins = inside.groupBy(F.shiftright(F.col(column) - F.lit(lo), shift).alias("bin")).count().collect()
        for b, n in sorted(bins, reverse=True):
            if k <= n:
                break
            k -= n
        lo, hi = lo + (b << shift), min(hi, lo + ((b + 1) << shift) - 1)
    return lo


def fit(documents: DataFrame, labels: DataFrame, *, seed: int = 7, temperature: float = TEMPERATURE, max_labelled: int = MAX_LABELLED) -> tuple[Model, DataFrame]:
    """The model, and the table doc_id, log_weight, gumbel_key of all rows with words."""
    labelled = _labelled(labels, max_labelled)
    weights = weigh(documents, labelled)
    scored = C.table(score(documents, weights).where("log_weight is not null").withColumn("gumbel_key", gumbel_key(seed, temperature)), "scores")
    held = [k for k in labelled if not _trains(k)]
    cut = -np.inf
    if held:
        spark = documents.sparkSession
        mine = F.broadcast(spark.createDataFrame([(k, labelled[k]) for k in held], "doc_id long, good boolean"))
        rows = scored.join(mine, "doc_id").groupBy("doc_id").agg(F.min("log_weight"), F.first("good")).collect()
        cut = best_cut(np.array([r[1] for r in rows if r[2]]), np.array([r[1] for r in rows if not r[2]]))
    k = scored.where(F.col("log_weight") >= F.lit(cut)).count() if np.isfinite(cut) else 0
    least = kth_largest(scored, k, "gumbel_key") if k else None
    return Model(weights, cut, least, seed, temperature), scored


def select(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, log_weight, gumbel_key of the rows kept."""
    model, scored = fit(documents, labels, **options)
    return scored if model.least_key is None else scored.where(F.col("gumbel_key") >= F.lit(model.least_key))


def filter_documents(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows kept, with all their columns: the model is applied again as the rows stream by, so texts aren't shuffled."""
    model, scored = fit(documents, labels, **options)
    C.drop(scored)
    weights, at = model.weights, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = pa.array(_scores(b.column(at), weights), pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*b.columns, s], names=[*(f"c{i}" for i in range(b.num_columns)), "w"])
        C.trim()

    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(documents.schema))
    out = documents.mapInArrow(run, f"{schema}, w double").where("w is not null")
    if model.least_key is not None:
        key = gumbel_key(model.seed, model.temperature)
        here = out.withColumnsRenamed({f"c{documents.columns.index('doc_id')}": "doc_id", "w": "log_weight"})
        out = here.where(key >= F.lit(model.least_key)).withColumnsRenamed({"doc_id": f"c{documents.columns.index('doc_id')}"})
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)))
