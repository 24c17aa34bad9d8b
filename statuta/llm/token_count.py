"""Token counts: byte-pair merging with a heap and a linked list, counting only.

A piece starts as one symbol for each byte; the adjacent pair of lowest rank, the leftmost of equals, is popped from a heap and
merged in a linked list until no pair has a rank. The count is the initial symbols minus the merges; no identifier is emitted.
Pieces come from the tokenizer's own split; counts of recent pieces are kept in a dictionary of at most ``KEPT`` entries.

Defined results: null and empty texts have 0 bytes and 0 tokens; a special string inside a text is one token, as is the
library's default; repeated rows count alike; other columns are ignored. Long texts are split lazily, so memory follows a text's
size and not the number of its pieces.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import text_buffer

LIMIT = 512
KEPT = 400_000
LONG = 1 << 20


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class PairMerger:
    """Counts the tokens of texts with the merges of a byte-level BPE file for the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols: dict[str, int] = byte_symbols()
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merged = symbols.setdefault(a + b, len(symbols))
            self.ranks[symbols[a], symbols[b]] = rank, merged
        self.pieces = regex.compile(pattern)
        self.special = regex.compile("|".join(map(regex.escape, sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True))) or r"(?!)")
        self.kept: dict[str, int] = {}

    def count_piece(self, piece: bytes) -> int:
        symbols: list[int] = list(piece)
        n = left = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(found[0], k) for k in range(n - 1) if (found := ranks.get((symbols[k], symbols[k + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            to = after[k]
            if symbols[k] < 0 or to >= n or (found := ranks.get((symbols[k], symbols[to]))) is None or found[0] != rank:
                continue  # one of the two has been merged since
            symbols[k], symbols[to] = found[1], -1
            left -= 1
            after[k] = after[to]
            if after[k] < n:
                before[after[k]] = k
                if found := ranks.get((symbols[k], symbols[after[k]])):
                    heapq.heappush(heap, (found[0], k))
            if before[k] >= 0 and (found := ranks.get((symbols[before[k]], symbols[k]))):
                heapq.heappush(heap, (found[0], before[k]))
        return left

    def count(self, text: str) -> int:
        total, at, kept = 0, 0, self.kept
        for end, here in [*((m.start(), m.end()) for m in self.special.finditer(text)), (len(text), None)]:
            part = text[at:end] if at or end < len(text) else text
            for piece in self.pieces.findall(part) if len(part) < LONG else (m[0] for m in self.pieces.finditer(part)):
                n = kept.get(piece)
                if n is None:
                    n = self.count_piece(piece.encode())
                    if len(kept) >= KEPT:
                        kept.clear()
                    if len(piece) < 64:
                        kept[piece] = n
                total += n
            total, at = total + (here is not None), here or 0
        return total


def count_tokens(documents: DataFrame, path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = PairMerger(path, pattern)
        for b in batches:
            _, at = text_buffer(b.column(1))
            n = [merger.count(t.as_py() or "") for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(at[1:] - at[:-1]), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents.select("doc_id", documents["text"].cast("string").alias("text")).mapInArrow(run, schema)
