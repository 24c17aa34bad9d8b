"""N-gram Jaccard join: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, by a prefix-tree join.

A node is a distinct set, named by a 64-bit hash of it, as shingles are by 60 bits; exact copies are one node from the start.

1. One pass counts all shingles in a sketch of fixed size. Cells that stand out from chance are common; the global order is
   rarity level, then hash, so common shingles come last. What the sketch can't tell apart touches the speed only.
   Two linked sets share a shingle among the first n - ceil(0.8 n) + 1 of either.
2. Those prefix shingles are dealt out by shingle and sorted; a stream over them gives each node the smallest node of
   like size with that shingle as its leader, and holds one run's leader at a time, however many nodes share the shingle.
   Each node goes to the one leader that most of its shingles name, so a round costs one check each node.
3. A node's sign is the parity of its shingles in a few hundred bits. Where the signs of two nodes differ in d bits, their sets
   differ in d shingles at least, which excludes most candidates without a look at their texts and no pair that is linked.
   The texts of what is left are fetched, and a leader's set walks a prefix tree of its candidates' ordered sets, in blocks of
   ``BLOCK``: what sets share at their start is compared once, and a subtree is left as soon as its overlap so far and what
   remains of either side can't reach the bound.
4. Links give components. Only shingles whose nodes lie in different components matter further: ``ROUNDS`` more rounds
   give each of them another leader, which joins what one leader's set was too far from.
5. What is still apart is checked in full: of the nodes of each such shingle, those outside its largest component are held
   against all that lie in another component, sign by sign, in blocks of ``SIGNS`` and inside a task, so that only pairs that a
   sign doesn't exclude exist as rows; these walk trees as before. Shingles that the same nodes share stand for one. Where signs
   exclude so few that a block's pairs outnumber its rows, the block is crowded: its texts are fetched, once for each row, and all its
   probes walk the tree of all that it stores. Of links only those that join two groups of a block leave a task.

So no link between different components is lost, exact and near copies of one text cost a few checks each rather than one
each pair, and there is no cap on partners or candidates. Of a node's documents only the one of smallest doc_id is fetched.

Defined results: a document without words has 0 shingles and is its own component; with fewer words than ``WIDTH`` its whole
sequence is its one shingle. doc_id may be of any type that has an order. Each row counts as a document by its own text, so
rows of equal doc_id and different texts may differ in component. A row without doc_id has no component and no links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

WIDTH, PERCENT = 5, 80
TOKEN_BITS, LEVELS = 60, 8
SKETCH = 22
SKETCH_BLOCK = 1 << 16
BLOCK, SIGNS = 64, 512
CROWDED = 512
BITS = 4
ROUNDS = 2
MARKS = 24


def prefix_length(n: np.ndarray | int):
    """How many of a set's n shingles, rarest first, must be looked at."""
    return n - (PERCENT * n + 99) // 100 + 1


def linked(overlap, a, b):
    return (100 + PERCENT) * overlap >= PERCENT * (a + b)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its sorted distinct shingles) of every row with words."""
    spare = np.uint64(64 - TOKEN_BITS)
    for row, to, h, at in C.hashed(column):
        s, o = C.runs(h, at, WIDTH)
        s = s >> spare
        for k in range(to - row):
            if o[k + 1] > o[k]:
                one = np.sort(s[o[k] : o[k + 1]])
                fresh = np.empty(len(one), dtype=bool)
                fresh[0] = True
                np.not_equal(one[1:], one[:-1], out=fresh[1:])
                yield row + k, one[fresh]
            elif at[k + 1] > at[k]:
                one = np.array([at[k + 1] - at[k]], dtype=np.uint64)
                for x in h[at[k] : at[k + 1]]:
                    one = C.mix(one * np.uint64(0xC2B2AE3D27D4EB4F) + x)
                yield row + k, one >> spare


def name_of(s: np.ndarray) -> int:
    """The node of a set: a hash that doesn't depend on any order."""
    total = np.array([C.mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)
    return int(C.mix(total).view(np.int64)[0])


def sign_of(s: np.ndarray) -> bytes:
    """The parity of a set's shingles in ``BITS`` bits for each, rounded up to a power of two, 64 at least."""
    bits = max(64, 1 << (BITS * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def folded(signs: np.ndarray, words: int) -> np.ndarray:
    """Rows of signs (64-bit words) as signs of fewer words."""
    return np.bitwise_xor.reduce(signs.reshape(len(signs), -1, words), axis=1)


def may_link(difference: np.ndarray, a: int, b: np.ndarray) -> np.ndarray:
    """Whether sets of a and b shingles that differ in so many at least can be linked."""
    return linked(np.minimum((a + b - difference) // 2, np.minimum(a, b)), a, b)


def _cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(TOKEN_BITS - SKETCH)).astype(np.int64)


def ordered(s: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A set in the global order, each shingle with its level above it."""
    return np.sort((level[_cells(s)].astype(np.uint64) << np.uint64(TOKEN_BITS)) | s)


def levels(cells: np.ndarray) -> np.ndarray:
    """0 for cells that hold no more than chance explains, then one level for each fourfold of that."""
    mean = float(cells.mean())
    chance = mean + 6 * mean**0.5 + 8
    return np.where(cells > chance, np.minimum(1 + np.log2(np.maximum(cells, 1) / chance) // 2, LEVELS - 1), 0).astype(np.uint8)


def _count(documents: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Size, node and sign of every document's set, and the levels of the sketch's cells."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, waiting, size, kind = np.zeros(1 << SKETCH, dtype=np.uint32), [], 0, None

        def add() -> None:
            at, times = np.unique(np.concatenate(waiting), return_counts=True)
            cells[at] += times.astype(np.uint32)
            waiting.clear()

        names = ["block", "cells", "doc_id", "n", "node", "sign"]
        for b in batches:
            kind = b.column(0).type
            n, node, sign = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=np.int64), [None] * b.num_rows
            for row, s in shingle_sets(b.column(1)):
                n[row], node[row], sign[row] = len(s), name_of(s), sign_of(s)
                waiting.append(_cells(s).astype(np.int32))
                size += len(s)
                if size >= 1 << 20:
                    add()
                    size = 0
            yield pa.record_batch([pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary()), b.column(0), pa.array(n), pa.array(node, mask=n == 0), pa.array(sign, pa.binary())], names=names)
        if waiting:
            add()
        if kind is not None:
            found = C.block_rows(cells, SKETCH_BLOCK)
            yield pa.record_batch([*found.columns, pa.nulls(len(found), kind), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.binary())], names=names)
        C.trim()

    both = C.table(documents.mapInArrow(run, f"block int, cells binary, doc_id {id_type}, n long, node long, sign binary"), "sizes")
    cells = np.zeros(1 << SKETCH, dtype=np.float32)
    for k, total in C.blocks(C.add_blocks(both.where("block is not null").select("block", "cells"), "uint32", "int64"), "int64"):
        cells[k * SKETCH_BLOCK : (k + 1) * SKETCH_BLOCK] = total
    return both.where("block is null").select("doc_id", "n", "node", "sign"), levels(cells)


def _prefixes(documents: DataFrame, level: np.ndarray) -> DataFrame:
    """token, node, size and place (in one long) of every prefix shingle; copies that meet in a task are given once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        found, size = ([], [], []), 0

        def out() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(np.concatenate(x)) for x in found], names=["token", "node", "sized"])
            for x in found:
                x.clear()
            return made

        for b in batches:
            for _, s in shingle_sets(b.column(0)):
                if (node := name_of(s)) in seen:
                    continue
                seen.add(node)
                p = prefix_length(len(s))
                found[0].append(ordered(s, level)[:p].view(np.int64))
                found[1].append(np.full(p, node, dtype=np.int64))
                found[2].append((np.int64(len(s)) << 32) | np.arange(p, dtype=np.int64))
                size += p
                if size >= 50_000:
                    yield out()
                    size = 0
        if size:
            yield out()
        C.trim()

    return documents.select("text").mapInArrow(run, "token long, node long, sized long")


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and size, those with another node of like size beside them, each with its leader.

    The leader is the first row of its token that is large enough; null where places in the order exclude a link.
    """
    held: tuple | None = None  # the last row, not yet given out: token, node, sized, whether it has company
    leader = (0, 0)

    def place(node: int, sized: int) -> int | None:
        n, at, m, to = sized >> 32, sized & 0xFFFFFFFF, leader[1] >> 32, leader[1] & 0xFFFFFFFF
        return leader[0] if node != leader[0] and linked(min(at, to) + 1 + min(n - at, m - to) - 1, n, m) else None

    def close(a: int, b: int) -> bool:
        return 100 * (a >> 32) >= PERCENT * (b >> 32)

    names = ["token", "node", "sized", "leader"]
    for batch in batches:
        t, d, z = (batch.column(k).to_numpy() for k in range(3))
        if not len(t):
            continue
        same = t[1:] == t[:-1]
        busy = np.zeros(len(t), dtype=bool)
        busy[1:] |= same
        busy[:-1] |= same
        busy[0] |= held is not None and held[0] == t[0]
        busy[-1] = True
        at = np.flatnonzero(busy)
        out: tuple[list, ...] = ([], [], [], [])
        for token, node, sized in zip(t[at].tolist(), d[at].tolist(), z[at].tolist(), strict=True):
            if held is not None and held[0] == token and held[1] == node:
                continue  # a copy
            beside = held is not None and held[0] == token and close(held[2], sized)
            if held is not None and (held[3] or beside):
                for x, y in zip(out, (*held[:3], held[4]), strict=True):
                    x.append(y)
            if held is None or held[0] != token or not close(leader[1], sized):
                leader = (node, sized)
            held = (token, node, sized, beside, place(node, sized))
        yield pa.record_batch([pa.array(x, pa.int64()) for x in out], names=names)
    if held is not None and held[3]:
        yield pa.record_batch([pa.array([x], pa.int64()) for x in (*held[:3], held[4])], names=names)


class PrefixTree:
    """Ordered sets in a tree that stores what they share at their start once."""

    def __init__(self, sets: list[np.ndarray]):
        keyed = sorted((s.astype(">u8").tobytes(), k) for k, s in enumerate(sets))
        order = [k for _, k in keyed]
        self.nodes: list[tuple] = []  # shared shingles, depth after them, least and most size below, sets that end here, children
        self.roots: list[int] = []
        todo = [(0, len(order), 0, self.roots)]
        while todo:
            lo, hi, depth, siblings = todo.pop()
            while lo < hi:  # one child: the sets that go on with the same shingle
                first = sets[order[lo]]
                to = lo + 1
                while to < hi and sets[order[to]][depth] == first[depth]:
                    to += 1
                last = sets[order[to - 1]]
                m = min(len(first), len(last))
                differ = np.flatnonzero(first[depth:m] != last[depth:m])
                end = depth + int(differ[0]) if len(differ) else m
                sizes = [len(sets[order[k]]) for k in range(lo, to)]
                ends = [order[k] for k in range(lo, to) if len(sets[order[k]]) == end]
                children: list[int] = []
                siblings.append(len(self.nodes))
                self.nodes.append((first[depth:end], end, min(sizes), max(sizes), ends, children))
                if to - lo > len(ends):
                    todo.append((lo + len(ends), to, end, children))
                lo = to

    def walk(self, probe: np.ndarray) -> Iterator[int]:
        """The sets that are linked with probe."""
        n, todo = len(probe), [(k, 0) for k in self.roots]
        while todo:
            k, overlap = todo.pop()
            shared, depth, least, most, ends, children = self.nodes[k]
            at = np.searchsorted(probe, shared)
            overlap += int(np.count_nonzero(probe[np.minimum(at, n - 1)] == shared))
            rest = n - int(np.searchsorted(probe, shared[-1], side="right"))
            if not linked(overlap + min(most - depth, rest), n, least):
                continue
            for s in ends:
                if linked(overlap, n, depth):
                    yield s
            todo += [(c, overlap) for c in children]


def _verify(level: np.ndarray):
    """Links (probe, stored) among rows sorted by unit, block and kind: a block's stored texts fill a tree, then its probes walk it.

    Only links that join groups which the block's links before have not: fewer than it has groups, with the same components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets, tree, hits, up = None, [], [], None, [], {}

        def root(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = x = up.get(y, y)
            return x

        for b in batches:
            units, blocks, probe, node, group = (b.column(k).to_pylist() for k in range(5))
            for k, s in shingle_sets(b.column(5)):
                s = ordered(s, level)
                if (here := (units[k], blocks[k])) != key:
                    key, nodes, sets, tree, up = here, [], [], None, {}
                if not probe[k]:
                    nodes.append((node[k], group[k]))
                    sets.append(s)
                elif sets:
                    tree = tree or PrefixTree(sets)
                    for other, of in sorted({nodes[j] for j in tree.walk(s)}):
                        if (x := root(of)) != (y := root(group[k])):
                            up[x] = y
                            hits.append((node[k], other))
                    if len(hits) >= 50_000:
                        yield _pairs(hits)
        yield _pairs(hits)
        C.trim()

    return run


def _pairs(hits: list[tuple[int, int]]) -> pa.RecordBatch:
    made = pa.record_batch([pa.array([h[k] for h in hits], pa.int64()) for k in (0, 1)], names=["a", "b"])
    hits.clear()
    return made


def _compare(batches: Iterator[pa.RecordBatch], most: int = CROWDED) -> Iterator[pa.RecordBatch]:
    """Pairs (probe, stored) of different groups whose signs don't exclude a link, among rows sorted by unit, block and kind.

    A block with more than ``most`` pairs and more pairs than rows is given as (unit, block), for a look at all its texts, and no more pairs.
    """
    key, stored, by, hits, crowded, rows, made = None, [], {}, [], [], 0, 0

    def out() -> pa.RecordBatch:
        pairs = [(*h, None, None) for h in hits] + [(None, None, *c) for c in crowded]
        hits.clear()
        crowded.clear()
        return pa.record_batch([pa.array([p[k] for p in pairs], pa.int32() if k == 3 else pa.int64()) for k in range(4)], names=["a", "b", "unit", "block"])

    def look(node: int, group: int, n: int, sign: np.ndarray) -> None:
        for words, (nodes, groups, sizes, signs) in by.items():
            few = min(words, len(sign))
            apart = np.bitwise_count(folded(signs, few) ^ folded(sign[None], few)).sum(axis=1, dtype=np.int64)
            hits.extend((node, x) for x in nodes[may_link(apart, n, sizes) & (groups != group)].tolist())

    for b in batches:
        units, blocks, probe, node, group, n = (b.column(k).to_pylist() for k in range(6))
        for k, raw in enumerate(b.column(6)):
            sign = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
            if (here := (units[k], blocks[k])) != key:
                key, stored, by, rows, made = here, [], {}, 0, 0
            rows += 1
            if made is None:  # crowded
                continue
            if not probe[k]:
                stored.append((len(sign), node[k], group[k], n[k], sign))
                continue
            if stored:
                for words in {x[0] for x in stored}:
                    mine = [x for x in stored if x[0] == words]
                    by[words] = (*(np.array([x[c] for x in mine]) for c in (1, 2, 3)), np.stack([x[4] for x in mine]))
                stored = []
            before = len(hits)
            look(node[k], group[k], n[k], sign)
            made += len(hits) - before
            if made > max(rows, most):
                crowded.append(key)
                made = None
            if len(hits) >= 50_000:
                yield out()
    yield out()
    C.trim()


@dataclass
class _Sets:
    """What checks read: documents, the nodes that share a prefix shingle (node, doc_id, n, sign), the levels of the order."""

    documents: DataFrame
    signs: DataFrame
    level: np.ndarray

    def texts(self, nodes: DataFrame) -> DataFrame:
        """node, text of nodes and of few others: a bit map of fixed size, made on executors, holds back nearly all other documents."""
        mark = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - MARKS)
        wanted = self.signs.join(nodes, "node", "left_semi").select(mark.alias("m"))
        found = wanted.groupBy(F.shiftright("m", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(m & 63))")).alias("bits")).toArrow()
        marks = np.zeros(1 << (MARKS - 6), dtype=np.uint64)
        marks[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                m = b.column(0).to_numpy(zero_copy_only=False)
                texts = b.column(1).filter(pa.array((marks[m >> 6] >> (m & 63).astype(np.uint64)) & np.uint64(1) == 1))
                rows, named = [], []
                for k, s in shingle_sets(texts):
                    rows.append(k)
                    named.append(name_of(s))
                yield pa.record_batch([pa.array(named, pa.int64()), texts.take(pa.array(rows, pa.int64()))], names=["node", "text"])
            C.trim()

        return self.documents.select(mark.alias("m"), "text").mapInArrow(run, "node long, text string")

    def near(self, stored: DataFrame, probes: DataFrame, units: int, name: str) -> tuple[DataFrame, DataFrame | None]:
        """a, b: probes and what is stored in the same unit and another group (unit, node, group), if signs don't exclude a link, and the
        links of blocks that are too crowded for pairs; units: at most so many."""
        dealt = _dealt(stored, probes, SIGNS, units)
        rows = dealt.join(self.signs.drop("doc_id"), "node").select("unit", "block", "probe", "node", "group", "n", "sign")
        most = CROWDED
        found = C.table(_met(rows).mapInArrow(lambda batches: _compare(batches, most), "a long, b long, unit long, block int"), f"{name}-compared")
        crowded, links = found.where("unit is not null").select("unit", "block").distinct(), None
        if crowded.limit(1).count():
            here = C.table(dealt.join(crowded, ["unit", "block"], "left_semi"), f"{name}-crowded")
            links = self._walked(here, f"{name}-crowded-links")
            C.drop(here)
        return found.where("unit is null").select("a", "b"), links

    def _walked(self, rows: DataFrame, name: str) -> DataFrame:
        """The links of rows (unit, block, probe, node, group), as a table."""
        texts = self.texts(rows.select("node").distinct())
        rows = rows.join(texts, "node").select("unit", "block", "probe", "node", "group", "text")
        return C.table(_met(rows).mapInArrow(_verify(self.level), "a long, b long"), name)

    def links(self, near: DataFrame, more: DataFrame | None, name: str) -> DataFrame:
        """The links among pairs (a, b), as a table of such, and more links."""
        near = C.table(near, f"{name}-near")
        pair = [F.col(c).alias("node") for c in "ab"]
        sides = near.select(F.col("a").alias("unit"), pair[1]), near.select(F.col("a").alias("unit"), pair[0]).distinct()
        found = self._walked(_dealt(*(x.withColumn("group", F.col("node")) for x in sides), BLOCK, near.count()), f"{name}-links")
        C.drop(near)
        if more is None:
            return found
        both = C.table(found.union(more), f"{name}-all-links")
        C.drop(found, more)
        return both

    def by_leader(self, pairs: DataFrame, name: str, rows: int) -> DataFrame:
        """The links among at most so many pairs (leader, node): a leader walks its candidates."""
        pairs = C.table(pairs, f"{name}-pairs", rows)
        sides = [pairs.select(F.col("leader").alias("unit"), F.col(c).alias("node"), F.col(c).alias("group")) for c in ("node", "leader")]
        links = self.links(*self.near(sides[0], sides[1].distinct(), rows, name), name)
        C.drop(pairs)
        return links


def _dealt(stored: DataFrame, probes: DataFrame, block: int, units: int) -> DataFrame:
    """unit, block, probe, node, group: what is stored by unit in blocks of about so many, and each probe in all blocks of its unit."""
    blocks = C.table(stored.groupBy("unit").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "blocks", units)  # apart, so that joins can split hot units
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    rows = stored.join(blocks, "unit").select("unit", mine, F.lit(False).alias("probe"), "node", "group")
    return rows.union(probes.join(blocks, "unit").select("unit", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("probe"), "node", "group"))


def _met(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit", "block").sortWithinPartitions("unit", "block", "probe")


def _one_leader(rows: DataFrame) -> DataFrame:
    """leader, node: of each node's leaders the one that most of its shingles name."""
    counts = rows.groupBy("node", "leader").agg(F.count("*").alias("times"))
    return counts.groupBy("node").agg(F.max_by("leader", F.struct("times", "leader")).alias("leader")).select("leader", "node")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, label) after more links (a, b)."""
    of = labels.select(F.col("node").alias("x"), F.col("label").alias("lx"))
    over = links.join(of, F.col("a") == F.col("x"), "left").select("a", F.coalesce("lx", "a").alias("la"), "b")
    n, m = labels.count(), links.count()
    over = C.table(over.join(of, F.col("b") == F.col("x"), "left").select("a", "la", "b", F.coalesce("lx", "b").alias("lb")), "over", m)
    joined = components(over.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()).withColumnsRenamed({"node": "old", "label": "new"})
    nodes = labels.union(over.select("a", "la")).union(over.select("b", "lb")).distinct()
    out = nodes.join(joined, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label"))
    out = C.table(out.groupBy("node").agg(F.min("label").alias("label")), "labels", n + 2 * m)
    C.drop(over, labels)
    return out


def _mixed(own: DataFrame, rows: int) -> DataFrame:
    """Rows, of at most so many, of shingles that different components share."""
    both = own.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("token")
    return C.table(own.join(both, "token", "left_semi"), "mixed", rows)


def _regroup(own: DataFrame, labels: DataFrame) -> DataFrame:
    new = labels.withColumnRenamed("label", "new")
    return own.join(new, "node", "left").withColumn("group", F.coalesce("new", "group")).select("token", "node", "n", "central", "group")


def _apart(own: DataFrame, sets: _Sets, rows: int) -> tuple[DataFrame, DataFrame | None]:
    """a, b: all pairs of nodes in different groups that share a prefix shingle and that their signs don't exclude, and the links of crowded
    blocks. own: of at most so many rows."""
    hashes = [F.sum(F.xxhash64(F.lit(k), "node").cast("decimal(20,0)")).alias(f"sum{k}") for k in range(2)]
    units = own.groupBy("token").agg(*hashes).select("token", F.xxhash64("sum0", "sum1").alias("unit"))  # equal for shingles of the same nodes
    met = C.table(own.join(units, "token").select("unit", "node", "group").distinct(), "units", rows)
    largest = C.table(met.groupBy("unit", "group").agg(F.count("*").alias("size")).groupBy("unit").agg(F.max_by("group", F.struct("size", "group")).alias("most")), "largest", rows)
    others = met.join(largest, "unit").where("group <> most").select("unit", "node", "group")
    near, links = sets.near(met, others, rows, "apart")
    found = C.table(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "apart")
    C.drop(met, largest)
    return found, links


def _labels(documents: DataFrame, sizes: DataFrame, level: np.ndarray) -> DataFrame:
    """node, label of every node that is linked with another."""
    runs = _prefixes(documents.where("doc_id is not null"), level).repartition("token").sortWithinPartitions("token", F.shiftright("sized", 32), "node")
    shared = C.table(runs.mapInArrow(_lead, "token long, node long, sized long, leader long"), "shared")
    n = shared.count()
    first = sizes.where("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(shared.select("node").distinct(), "node", "left_semi")
    sets = _Sets(documents, C.table(sizes.join(first, ["node", "doc_id"]).select("node", "doc_id", "n", "sign"), "signs"), level)
    links = sets.by_leader(_one_leader(shared.where("leader is not null")), "first", n)
    labels = components(links)
    count = shared.groupBy("node").agg(F.count("*").alias("shares"))
    size = F.shiftright("sized", 32).cast("long")
    own = shared.join(count, "node").select("token", "node", size.alias("n"), (F.col("shares") / (size - F.ceil(size * PERCENT / 100) + 1)).alias("central"), F.col("node").alias("group"))
    own = _mixed(C.table(_regroup(own, labels), "own", n), n)
    C.drop(shared, links)
    for k in range(ROUNDS):
        n = own.count()
        # First the node with most shared shingles leads, as it is nearest to the others; then any.
        rank = F.struct(-F.col("central") if k == 0 else F.lit(0.0), F.xxhash64(F.lit(k), "node"))
        first = own.groupBy("token").agg(F.min_by(F.struct(F.col("node").alias("leader"), F.col("group").alias("of"), F.col("n").alias("m")), rank).alias("l")).select("token", "l.*")
        near = own.join(first, "token").where((F.col("group") != F.col("of")) & (F.col("n") * 100 >= F.col("m") * PERCENT) & (F.col("m") * 100 >= F.col("n") * PERCENT))
        links = sets.by_leader(_one_leader(near), f"round{k}", n)
        if not links.limit(1).count():
            C.drop(links)
            break
        labels = _merge(labels, links)
        new = _mixed(_regroup(own, labels), n)
        C.drop(own, links)
        own = new
    near, crowded = _apart(own, sets, own.count())
    more = sets.links(near, crowded, "last")
    if more.limit(1).count():
        labels = _merge(labels, more)
    C.drop(own, near, more, sets.signs)
    return labels


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    documents = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    sizes, level = _count(documents)
    labels, rows = _labels(documents, sizes, level), sizes.count()
    first = sizes.where("doc_id is not null and node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    first = C.table(first.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "first", rows)
    least = C.table(first.groupBy("label").agg(F.min("first").alias("least")), "least", rows)
    found = first.join(least, "label").select(F.col("node").alias("of"), "least")
    out = sizes.join(found, F.col("node") == F.col("of"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def keep_first(documents: DataFrame) -> DataFrame:
    """The documents that are the smallest doc_id of their component, with all their columns; those without doc_id stay.

    Of rows of equal doc_id all go or all stay; they go if each of them does.
    """
    rows = join(documents).groupBy(F.col("doc_id").alias("__gone")).agg(F.min(F.col("component_id") != F.col("doc_id")).alias("__all"))
    gone = C.table(rows.where("__all").select("__gone"), "gone")
    return documents.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
