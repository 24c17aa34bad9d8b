"""Shared ground of the training-text operators: tables in the shared folder, word hashing, streamed groups.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; A-Z are lower-cased and nothing else is.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim
except (OSError, AttributeError):  # another C library
    _libc = None

_made: list[tuple[SparkSession, str]] = []
_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one where it is unset on one machine (tests)."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="statuta-"))
    return f"file://{_local[0]}"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the shared folder is cleared with the application
        pass


@atexit.register
def _clear() -> None:
    while _made:
        _delete(*_made.pop())


ROWS_A_FILE = 200_000


def table(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df, computed once, as a table in the shared folder: its lineage is cut and any executor can be lost.

    rows: at most so many, which are cheap to make; they go to as many tasks and files as they fill.
    """
    df = df if rows is None else df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/statuta-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._statuta_path = path
    return back


def drop(*tables: DataFrame) -> None:
    """Deletes tables of table() that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_statuta_path", None):
            _delete(t.sparkSession, path)
            _made[:] = [x for x in _made if x[1] != path]


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """make()'s rows as a table; the tables made on the way are deleted."""
    before = len(_made)
    out = table(make(), name)
    for t in [x for x in _made[before:] if x[1] != out._statuta_path]:
        _delete(*t)
        _made.remove(t)
    return out


def trim() -> None:
    """Gives memory that is free back to the system, so that workers that wait for their next task hold little."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, without: list[str] = []) -> tuple[DataFrame, dict[str, str]]:  # noqa: B006
    """df with columns c0, c1, ... and their names: no column of a caller can clash with an operator's own. without: left out."""
    df = df.drop(*without)
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def words_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


# Word hashing without a Python object for each word.

_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PUNCTUATION = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
PIECE = 1 << 19
_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 64)
        for k, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(raw: np.ndarray, begins: np.ndarray, head: int = 0, split: bool = False) -> tuple[np.ndarray, ...]:
    """Hashes of the words of raw (bytes), and where each begins. begins: offsets at which a text begins, so a word too.

    head: also hashes of the words' first so many bytes. split: words are also cut between punctuation and anything else.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), *([np.zeros(0, np.uint64)] * bool(head))
    up, down = _tables(n)
    ink = ~_SPACE[raw]
    edge = np.ones(n + 1, dtype=bool)
    edge[1:n] = ~ink[:-1]
    edge[begins[begins < n]] = True
    turn = np.zeros(n, dtype=bool)
    if split:
        marks = _PUNCTUATION[raw]
        turn[1:] = marks[1:] != marks[:-1]
        edge[:n] |= turn
    starts = np.flatnonzero(ink & edge[:n])
    last = edge.copy()
    last[1:n] = ~ink[1:]
    last[begins[begins < n]] = True
    last[:n] |= turn
    last[n] = True
    ends = np.flatnonzero(ink & last[1:]) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LOWER[raw] * up[:n], out=total[1:])
    def of(to: np.ndarray) -> np.ndarray:
        return mix((total[to] - total[starts]) * down[starts] + (to - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    return of(ends), starts, *([of(np.minimum(ends, starts + head))] if head else [])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def hashed(column: pa.Array, head: int = 0, split: bool = False, piece: int = PIECE) -> Iterator[tuple]:
    """(first row, row after the last, word hashes, offsets of the rows in them), in pieces of some 0.5 MB of text.

    head, split: as in hash_words; hashes of heads come last. piece: so many bytes of text instead.
    """
    raw, at = text_buffer(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(at, at[row] + piece, side="right")) - 1)
        lo, hi = int(at[row]), int(at[to])
        if hi - lo <= piece:
            h, starts, *heads = hash_words(raw[lo:hi], at[row:to] - lo, head, split)
            yield row, to, h, np.searchsorted(starts, at[row : to + 1] - lo), *heads
        else:  # one long text, cut where white space is
            found, cut = [], lo
            while cut < hi:
                end = min(hi, cut + piece)
                while end < hi:
                    gap = np.flatnonzero(_SPACE[raw[end : end + 4096]])
                    if len(gap):
                        end += int(gap[0])
                        break
                    end = min(hi, end + 4096)
                found.append(hash_words(raw[cut:end], np.zeros(1, np.int64), head, split))
                cut = end
            h, _, *heads = (np.concatenate(x) for x in zip(*found, strict=True))
            yield row, to, h, np.array([0, len(h)]), *heads
        row = to


def runs(h: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of width words inside a row, and the offsets of the rows in them; a row of fewer words has none."""
    n = np.maximum(np.diff(at) - width + 1, 0)
    out = np.concatenate([[0], np.cumsum(n)])
    if len(h) < width:
        return np.zeros(0, np.uint64), out
    s = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for k in range(width):
        s = s * np.uint64(0xC2B2AE3D27D4EB4F) + h[k : k + len(s)]
    row = np.repeat(np.arange(len(n)), np.diff(at))
    return mix(s[row[: len(s)] == row[width - 1 :]]), out


# Sums of fixed-size vectors over all partitions, without one row for each cell and without the driver adding anything up.


def block_rows(values: np.ndarray, block: int) -> pa.RecordBatch:
    """The blocks of a vector that aren't all zero, as rows (block, cells)."""
    parts = values.reshape(-1, block, *values.shape[1:])
    keep = [k for k in range(len(parts)) if parts[k].any()]
    return pa.record_batch([pa.array(keep, pa.int32()), pa.array([zlib.compress(parts[k].tobytes(), 1) for k in keep], pa.binary())], names=["block", "cells"])


def add_blocks(rows: DataFrame, dtype: str, sum_dtype: str) -> DataFrame:
    """rows (block, cells), summed by block: dealt out by block, then added up in a stream; a task holds its blocks' sums only."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, cells in zip(b.column(0).to_pylist(), b.column(1)):
                v = np.frombuffer(zlib.decompress(cells.as_buffer()), dtype=dtype)
                if k in sums:
                    sums[k] += v
                else:
                    sums[k] = v.astype(sum_dtype)
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary())], names=["block", "cells"])

    return rows.repartition("block").mapInArrow(add, "block int, cells binary")


def blocks(summed: DataFrame, dtype: str) -> Iterator[tuple[int, np.ndarray]]:
    """(block, cells) of the summed vector, one block at a time on the driver; packed, they are small whatever the input."""
    rows = summed.collect()
    while rows:
        k, cells = rows.pop()
        yield k, np.frombuffer(zlib.decompress(cells), dtype=dtype)


def collect_blocks(summed: DataFrame, shape: tuple[int, ...], block: int, dtype: str) -> np.ndarray:
    """The summed vector on the driver: its size is fixed by shape, whatever the input."""
    out = np.zeros(shape, dtype=dtype)
    for k, cells in blocks(summed, dtype):
        out[k * block : (k + 1) * block] = cells.reshape(block, *shape[1:])
    return out
