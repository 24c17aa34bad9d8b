"""Benchmark decontamination: latent semantic retrieval, then longest common subsequence and answer checks.

1. Passages of ``PASSAGE`` words are rows of a TF-IDF matrix A over hashed words; document frequencies come from all passages.
2. Randomised SVD: the range finder Y = A Omega takes ``WIDE`` Gaussian columns. One pass sums Y' Y (``WIDE`` x ``WIDE``) and Y' A
   (``WIDE`` x features) over all partitions; both have a fixed size, whatever the input. With Y' Y = R' R the rows of
   Q = Y R^-1 are an orthonormal basis, B = Q' A = R'^-1 Y' A, and the SVD B = U S V' gives A's ``LATENT`` leading right singular
   vectors V and values S. A text a has the latent coordinates V' a, each scaled down by its singular value to the weight of
   the last, so that what a whole language shares doesn't decide; and ``RESIDUAL`` coordinates G' (I - V V') a with Gaussian G,
   for the words that no leading direction holds, by which paraphrases of rare words are told apart. (Latent coordinates alone
   found 97 % of planted paraphrases with 40 times the candidates; both together find all, see tests/llm.) Coordinates are sums
   over a text's words, so those of any window follow from sums of steps; windows of equal words have equal sums wherever they stand.
3. Candidates: for each benchmark item, every window of documents, ``STEP`` words apart and just long enough for the item
   at any place, whose cosine with the item is ``COSINE`` or more.
4. A candidate is a leak if the longest common subsequence of words has ``COPY`` of the item's words; or ``PARAPHRASE`` of them
   and ``ANSWER`` of its answer's, the words of its last sentence (of its last third if it has one sentence). An item of
   fewer than ``SHORT`` words must occur word by word. Before, a count of the item's words in the window, never below what they
   share, leaves out the candidates that can't be leaks, many at a time.

Items are searched in blocks of ``ITEMS``, so a benchmark of any size has bounded memory; documents are never shuffled.

Defined results: null and empty texts hold no leak; items without words are in no document; a row without doc_id is searched
like any other and reported with null. Repeated rows are reported alike. ``clean`` passes all columns through.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BITS = 15
PASSAGE, STEP = 64, 8
WIDE, LATENT, RESIDUAL = 48, 24, 72
COSINE = 0.35
COPY, PARAPHRASE, ANSWER, SHORT = 0.8, 0.6, 0.8, 8
ITEMS = 4096
MERGED, SLICE = 16, 1 << 11
PIECE, RUN, CHUNK, COLUMNS = 1 << 17, 32, 512, 1 << 12
SEED = 11


def _features(h: np.ndarray) -> np.ndarray:
    return (C.mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def _cuts(at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins of pieces of width words, the last of each row shorter, and the offsets of the rows in them; empty rows have none."""
    n = -(-np.diff(at) // width)
    to = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(at[:-1], n) + (np.arange(to[-1]) - np.repeat(to[:-1], n)) * width, to


def _grid(f: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Features in pieces of width words, the last of each row filled up with the feature 1 << BITS; the offsets of the rows."""
    begins, to = _cuts(at, width)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    grid = np.full(to[-1] * width, 1 << BITS, dtype=np.int64)
    grid[np.arange(len(f)) - at[row] + to[row] * width] = f
    return grid.reshape(-1, width), to


def _gather(vectors: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Sums of the vectors of each piece; vectors end with a row of zeros."""
    out = vectors.take(grid[:, 0], axis=0)
    more = np.empty_like(out)
    for k in range(1, grid.shape[1]):
        out += vectors.take(grid[:, k], axis=0, out=more, mode="clip")
    return out


def _run_sums(vectors: np.ndarray, which: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of vectors[which[start : start + count]] of each run; all runs of so many or more take their k-th row at once."""
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    out = vectors.take(which[starts], axis=0)
    more = np.empty_like(out)
    for k in range(1, int(counts[0]) if len(counts) else 0):
        n = int(np.searchsorted(-counts, -k, side="left"))
        out[:n] += vectors.take(which[starts[:n] + k], axis=0, out=more[:n], mode="clip")
    back = more  # its rows aren't needed any more
    back[order] = out
    return back


def _frequencies(documents: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages each feature occurs, and the number of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << (BITS + 1), dtype=np.int64)  # the first cell of the second half counts passages
        for b in batches:
            for _, _, h, at in C.hashed(b.column(0), piece=PIECE):
                begins, to = _cuts(at, PASSAGE)
                owner = np.repeat(np.arange(to[-1]), np.diff(np.append(begins, len(h))))
                keys = np.sort((owner << BITS) | _features(h))
                if len(keys):
                    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
                cells[: 1 << BITS] += np.bincount(keys & ((1 << BITS) - 1), minlength=1 << BITS)
                cells[1 << BITS] += to[-1]
        yield C.block_rows(cells, 1 << 12)

    total = C.collect_blocks(C.add_blocks(documents.select("text").mapInArrow(run, "block int, cells binary"), "int64", "int64"), (1 << (BITS + 1),), 1 << 12, "int64")
    return total[: 1 << BITS], int(total[1 << BITS])


def _add_products(total: np.ndarray, grid: np.ndarray, y: np.ndarray) -> None:
    """Adds to each feature's row of total the rows of y whose passages hold it, as often as they do."""
    for lo in range(0, len(grid), 1024):
        flat = grid[lo : lo + 1024].astype(np.uint16).ravel()
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        begins, to = _cuts(np.append(np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])), len(flat)), RUN)
        sums = _run_sums(y, lo + order // grid.shape[1], begins, np.diff(np.append(begins, len(flat))))
        total[flat[begins[to[:-1]]]] += _run_sums(sums, np.arange(len(sums)), to[:-1], np.diff(to))


def svd_of_sketch(gram: np.ndarray, product: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors (features x rank) from Y' Y and A' Y: those of B = R'^-1 Y' A."""
    squares, vectors = np.linalg.eigh(gram)
    held = squares > squares[-1] * 1e-10
    root = vectors[:, held] / np.sqrt(squares[held])  # R^-1 up to a rotation, without directions that Y doesn't have
    b = product @ root.astype(product.dtype)  # B'
    values, u = np.linalg.eigh(sum(x.T @ x for x in (b[k : k + 4096].astype(np.float64) for k in range(0, len(b), 4096))))
    values, u = np.sqrt(np.maximum(values[::-1][:rank], 0)), u[:, ::-1][:, :rank]
    kept = values > (values[0] if len(values) else 0) * 1e-6
    return values[kept], b @ (u[:, kept] / values[kept]).astype(b.dtype)


def _in_few(documents: DataFrame) -> DataFrame:
    """documents in partitions that make one large sum each: some for each core, each of at most ``MERGED`` partitions."""
    n = documents.rdd.getNumPartitions()
    return documents.coalesce(max(1, min(n, max(documents.sparkSession.sparkContext.defaultParallelism, -(-n // MERGED)))))


def _directions(documents: DataFrame) -> np.ndarray:
    """Latent coordinates of each feature, times its inverse document frequency."""
    seen, passages = _frequencies(documents)
    idf = (np.log((passages + 1.0) / (seen + 1.0)) + 1).astype(np.float32)
    omega = np.random.default_rng(SEED).standard_normal((1 << BITS, WIDE), dtype=np.float32) * idf[:, None]
    omega, squared = np.vstack([omega, np.zeros((1, WIDE), np.float32)]), np.append(idf**2, np.float32(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, product = np.zeros((WIDE, WIDE)), np.zeros(((1 << BITS) + 1, WIDE), dtype=np.float32)
        for b in batches:
            for _, _, h, at in C.hashed(b.column(0), piece=PIECE):
                grid, _ = _grid(_features(h), at, PASSAGE)
                if len(grid):
                    length = (np.sqrt(squared[grid].sum(axis=1)) + np.float32(1e-6))[:, None]
                    y = _gather(omega, grid) / length
                    gram += y.T @ y
                    _add_products(product, grid, y / length)
        parts = [C.block_rows(gram.astype(np.float32), WIDE), C.block_rows(product[:-1], SLICE)]
        for k, part in enumerate(parts):  # the Gram matrix is block -1
            yield part if k else pa.record_batch([pa.array([-1] * len(part), pa.int32()), part.column(1)], names=["block", "cells"])
        C.trim()

    rows = _in_few(documents.select("text")).mapInArrow(run, "block int, cells binary")
    gram, product = np.zeros((WIDE, WIDE)), np.zeros((1 << BITS, WIDE), dtype=np.float32)
    for k, cells in C.blocks(C.add_blocks(rows, "float32", "float64"), "float64"):
        if k < 0:
            gram += cells.reshape(WIDE, WIDE)
        else:
            product[k * SLICE : (k + 1) * SLICE] = cells.reshape(SLICE, WIDE)
    if not gram.any():
        return np.zeros(((1 << BITS) + 1, 1), dtype=np.float32)
    values, vectors = svd_of_sketch(gram, product * idf[:, None], LATENT)
    gauss = np.random.default_rng(SEED + 1).standard_normal((1 << BITS, RESIDUAL), dtype=np.float32) / np.float32(RESIDUAL**0.5)
    gauss -= vectors @ (vectors.T @ gauss)
    out = np.zeros(((1 << BITS) + 1, len(values) + RESIDUAL), dtype=np.float32)
    out[:-1, : len(values)] = vectors * (values[-1] / values).astype(np.float32)
    out[:-1, len(values) :] = gauss
    out[:-1] *= idf[:, None]
    C.trim()
    return out


def _lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a machine word for each word of b at a time."""
    where: dict[int, int] = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    row, every = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        if u := row & where.get(x, 0):
            row = ((row + u) | (row - u)) & every
    return len(a) - row.bit_count()


def _columns(h: np.ndarray) -> np.ndarray:
    """Where words are counted: words that share a column only make a count of shared words larger."""
    return _features(h) & (COLUMNS - 1)


def _answer(text: str, words: int) -> int:
    """How many of an item's words are its answer."""
    last = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s.split()][-1:]
    n = len(last[0].encode().split()) if last else 0
    return n if 0 < n < words else -(-words // 3)


class _Items:
    """A block of benchmark items: word hashes, answers, and unit vectors by the steps that a window for them has."""

    def __init__(self, rows: list[tuple], directions: np.ndarray):
        self.ids, self.words, self.counts, self.answers, by = [], [], [], [], defaultdict(list)
        for item, text in rows:
            for _, _, h, _ in C.hashed(pa.array([text or ""], pa.string())):
                if len(h):
                    n = -(-(len(h) - 1) // STEP) + 1
                    grain = max(2, 1 << max(0, n.bit_length() - 3))  # items of like length share windows
                    by[-(-n // grain) * grain].append((len(self.ids), directions[_features(h)].sum(axis=0)))
                    self.ids.append(item)
                    self.words.append(h.tolist())
                    self.counts.append(Counter(self.words[-1]))
                    self.answers.append(_answer(text, len(h)))
        self.needs = np.array([self._need(len(a)) for a in self.words])
        self.weights = np.zeros((len(self.ids), COLUMNS), dtype=np.min_scalar_type(max((len(a) for a in self.words), default=0)))
        for k, c in enumerate(self.counts):
            np.add.at(self.weights[k], _columns(np.array(list(c), dtype=np.uint64)), np.array(list(c.values()), dtype=self.weights.dtype))
        self.by = {n: (np.array([k for k, _ in x]), np.array([v / (np.linalg.norm(v) + 1e-12) for _, v in x], dtype=np.float32)) for n, x in by.items()}

    @staticmethod
    def _need(words: int) -> float:
        return words if words < SHORT else PARAPHRASE * words

    def leak(self, k: int, window: list[int]) -> tuple[int, float] | None:
        """LCS and share of the answer if the window holds item k."""
        a, counts = self.words[k], self.counts[k]
        need = self._need(len(a))
        if sum(map(counts.__getitem__, counts.keys() & set(window))) < need or (n := _lcs(a, window)) < need:
            return None
        if len(a) < SHORT and not any(window[i : i + len(a)] == a for i in range(len(window))):
            return None
        answer = a[-self.answers[k] :]
        share = _lcs(answer, window) / len(answer)
        return (n, share) if n >= COPY * len(a) or share >= ANSWER else None


def _window_sums(steps: np.ndarray, widths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, sums of n steps from each step on) for each of the widths, from sums of 1, 2, 4, ... steps: equal steps, equal sums."""
    doubled = [steps]
    for n in widths:
        if n > len(steps):
            continue
        while 2 << (len(doubled) - 1) <= n:
            last, k = doubled[-1], 1 << (len(doubled) - 1)
            doubled.append(last[:-k] + last[k:])
        k = n.bit_length() - 1
        out, done = doubled[k][: len(steps) - n + 1], 1 << k
        for k in range(k - 1, -1, -1):
            if n >> k & 1:
                out = out + doubled[k][done : done + len(steps) - n + 1]
                done += 1 << k
        yield n, out


def _where(values: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Flat places of the values that are at least those of their rows; few are, so eight at a time are passed over."""
    hits = np.zeros(-(-values.size // 8) * 8, dtype=bool)
    np.greater_equal(values, least[:, None], out=hits[: values.size].reshape(values.shape))
    eights = np.flatnonzero(hits.view(np.uint64) != 0)
    k, bit = np.nonzero(hits.reshape(-1, 8)[eights])
    return eights[k] * 8 + bit


def _search(column: pa.Array, items: _Items, directions: np.ndarray) -> Iterator[tuple[int, int, float, int, float]]:
    """(row, item, cosine, LCS, share of the answer) of the best window of each row and item that leak."""
    widths = sorted(items.by)
    for row, _, h, at in C.hashed(column, piece=PIECE):
        grid, to = _grid(_features(h), at, STEP)
        if not len(grid) or not widths:
            continue
        owner = np.repeat(np.arange(len(to) - 1), np.diff(to))
        columns = _columns(h)
        order = np.argsort(columns.astype(np.uint16), kind="stable")
        before = np.full(len(h), -1)  # the last word of the same column
        before[order[1:]] = np.where(columns[order[1:]] == columns[order[:-1]], order[:-1], -1)
        best: dict[tuple[int, int], tuple] = {}
        near: dict[int, list[tuple]] = defaultdict(list)

        def check(n: int) -> None:
            """Compares the words of windows of n steps and of items that are near; first by a count of what they may share."""
            if not (parts := near.pop(n, [])):
                return
            r, first, k, cosine = (np.concatenate(x) for x in zip(*parts, strict=True))
            last = np.minimum(at[r + 1], first + n * STEP)
            many = max(1, (1 << 16) // (n * STEP))
            for lo in range(0, len(r), many):
                begin, end, which = first[lo : lo + many, None], last[lo : lo + many, None], k[lo : lo + many]
                places = begin + np.arange(n * STEP)
                new = places < end
                np.minimum(places, len(h) - 1, out=places)
                new &= before[places] < begin
                shared = (items.weights[which[:, None], columns[places]] * new).sum(axis=1)
                for i in (lo + np.flatnonzero(shared >= items.needs[which])).tolist():
                    if found := items.leak(k[i], h[first[i] : last[i]].tolist()):
                        value, key = (found[0], float(cosine[i]), found[1]), (int(r[i]), int(k[i]))
                        best[key] = max(best.get(key, value), value)

        def look(n: int, v: np.ndarray, r: np.ndarray, first: np.ndarray, held: np.ndarray | None = None) -> None:
            which, vectors = items.by[n]
            for lo in range(0, len(v), step := max(64, (1 << 21) // len(which))):  # windows at once: the more items, the fewer
                part = v[lo : lo + step]
                product, length = part @ vectors.T, np.sqrt(np.einsum("ij,ij->i", part, part)) + np.float32(1e-12)
                least = np.float32(COSINE) * length
                if held is not None:
                    least[~held[lo : lo + step]] = np.inf
                if len(found := _where(product, least)):
                    w, k = np.divmod(found, len(which))
                    near[n].append((r[lo + w], first[lo + w], which[k], product[w, k] / length[w]))
                    if sum(len(x[0]) for x in near[n]) >= 1 << 14:
                        check(n)

        chunk = max(CHUNK, 4 * widths[-1])
        for lo in range(0, len(grid), chunk):
            r = owner[lo : lo + chunk]
            first = at[r] + (np.arange(lo, lo + len(r)) - to[r]) * STEP
            for n, v in _window_sums(_gather(directions, grid[lo : lo + chunk + widths[-1] - 1]), widths):
                m = min(len(r), len(v))
                look(n, v[:m], r[:m], first[:m], r[:m] == owner[lo + n - 1 : lo + n - 1 + m])
        short = np.flatnonzero((np.diff(to) < widths[-1]) & (np.diff(to) > 0))  # in no window of some width
        whole = _run_sums(directions, _features(h), at[short], np.diff(at)[short])
        for n in widths:
            if len(rows := np.flatnonzero(np.diff(to)[short] < n)):
                look(n, whole[rows], short[rows], at[short[rows]])
        for n in widths:
            check(n)
        for (r, k), (n, cosine, share) in sorted(best.items()):
            yield row + r, k, cosine, n, share


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    block = []
    for r in benchmark.select("item_id", F.col("text").cast("string")).orderBy("item_id", "text").toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == ITEMS:
            yield block
            block = []
    if block:
        yield block


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs_words, item_words, answer_share of every document and item that it holds."""
    d, i = (t.schema[c].dataType.simpleString() for t, c in ((documents, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {d}, item_id {i}, cosine double, lcs_words int, item_words int, answer_share double"
    out, directions = documents.sparkSession.createDataFrame([], schema), None
    for block in _blocks(benchmark):
        directions = _directions(documents) if directions is None else directions

        def run(batches: Iterator[pa.RecordBatch], block: list[tuple] = block, directions: np.ndarray = directions) -> Iterator[pa.RecordBatch]:
            items = _Items(block, directions)
            for b in batches:
                found = list(_search(b.column(1), items, directions))
                ids = b.column(0).take(pa.array([x[0] for x in found], pa.int64()))
                columns = [
                    ids, pa.array([items.ids[x[1]] for x in found]).cast(pa.int64() if i == "bigint" else pa.array(items.ids).type),
                    pa.array([round(x[2], 6) for x in found], pa.float64()), pa.array([x[3] for x in found], pa.int32()),
                    pa.array([len(items.words[x[1]]) for x in found], pa.int32()), pa.array([round(x[4], 6) for x in found], pa.float64()),
                ]
                yield pa.record_batch(columns, names=["doc_id", "item_id", "cosine", "lcs_words", "item_words", "answer_share"])

        out = out.union(documents.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema))
    return out


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    out, directions, at = documents, None, documents.columns.index("text")
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(documents.schema))
    for block in _blocks(benchmark):
        directions = _directions(documents) if directions is None else directions

        def run(batches: Iterator[pa.RecordBatch], block: list[tuple] = block, directions: np.ndarray = directions) -> Iterator[pa.RecordBatch]:
            items = _Items(block, directions)
            for b in batches:
                keep = np.ones(b.num_rows, dtype=bool)
                keep[[x[0] for x in _search(b.column(at), items, directions)]] = False
                yield pa.RecordBatch.from_arrays(b.columns, names=[f"c{k}" for k in range(b.num_columns)]).filter(pa.array(keep))

        out = out.mapInArrow(run, schema)
    return out.toDF(*documents.columns)
