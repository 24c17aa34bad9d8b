import random

import numpy as np
import pyarrow as pa
import pytest

from statuta.llm import ngram_join as J
from statuta.llm.components import components

from .data import AWKWARD, WORDS, documents, text


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def rows(seed):
    rng = random.Random(seed)
    out, n = [], 0
    boiler = text(rng, 4)
    for _ in range(25):
        base = (text(rng, rng.randint(1, 14)) + (" " + boiler if rng.random() < 0.5 else "")).split()
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            if rng.random() < 0.3:
                base = w  # a chain of copies of copies
            out.append((n, " ".join(w).upper() if rng.random() < 0.2 else "  ".join(w)))
            n += 1
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    made = rows(seed) + [(1000 + k, boilerless) for k, boilerless in enumerate(["a b c", "A B C", "a b", "x"])]
    docs = documents(spark, [*made, *((i + 2000, t) for i, t in AWKWARD if i is not None), (None, made[0][1])]).selectExpr("*", "0 as token", "1 as doc")
    got = J.join(docs).collect()
    want = brute([*made, *((i + 2000, t) for i, t in AWKWARD if i is not None)])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(len(shingles(made[0][1])), None)]
    assert len(got) == docs.count()


def test_small_blocks_and_hot_leaders(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 3)
    rng = random.Random(4)
    base = text(rng, 12).split()
    made = []
    for k in range(60):
        w = list(base)
        w[rng.randrange(len(w))] = rng.choice(WORDS)
        made.append((k, " ".join(w if k % 3 else base)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.join(documents(spark, made)).collect()} == brute(made)


def test_prefix_tree():
    rng = np.random.default_rng(1)
    for _ in range(60):
        pool = np.unique(rng.integers(0, 1 << 62, 40, dtype=np.uint64))
        sets = [np.sort(rng.choice(pool, rng.integers(1, len(pool)), replace=False)) for _ in range(30)]
        sets += [sets[0], sets[1][:-1] if len(sets[1]) > 1 else sets[1]]
        probe = sets[rng.integers(0, len(sets))]
        want = sorted(k for k, s in enumerate(sets) if J.linked(len(np.intersect1d(s, probe)), len(s), len(probe)))
        assert sorted(J.PrefixTree(sets).walk(probe)) == want


def test_signs_exclude_no_linked_pair():
    rng = np.random.default_rng(2)
    excluded = 0
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        keep = a[rng.random(len(a)) < rng.uniform(0.3, 1)]
        b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 60, int(rng.integers(0, max(1, n // 3) + 1)), dtype=np.uint64)]))
        if len(b):
            x, y = (np.frombuffer(J.sign_of(s), dtype=np.uint64) for s in (a, b))
            few = min(len(x), len(y))
            apart = np.bitwise_count(J.folded(x[None], few) ^ J.folded(y[None], few)).sum(axis=1, dtype=np.int64)
            true = J.linked(len(np.intersect1d(a, b)), len(a), len(b))
            may = bool(J.may_link(apart, len(a), np.array([len(b)]))[0])
            assert may or not true
            excluded += not may
    assert excluded > 100


def test_one_large_group_and_a_common_shingle(spark):
    """A group of hundreds of near copies, and hundreds of other documents that share its first passage."""
    rng = random.Random(8)
    passage, base, made = text(rng, 2).split(), text(rng, 14).split(), []
    for k in range(700):
        w = passage + (list(base) if k % 2 else text(rng, 6).split())
        for _ in range(3):
            w[rng.randrange(len(passage), len(w))] = rng.choice(WORDS)
        made.append((k, " ".join(w)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.join(documents(spark, made)).collect()} == brute(made)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 50), (50, 60), (70, 70)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 50, 50: 50, 60: 50, 70: 70}


def test_keep_first_and_empty(spark):
    made = rows(5)
    docs = documents(spark, made)
    want = brute(made)
    assert sorted(r.doc_id for r in J.keep_first(docs).collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert J.join(docs.where("false")).count() == 0 and J.keep_first(docs.where("false")).columns == docs.columns


def test_crowded_blocks(spark, monkeypatch):
    """Many texts around the bound: pairs that signs don't exclude don't grow with the square, and no link is lost."""
    monkeypatch.setattr(J, "CROWDED", 0)
    monkeypatch.setattr(J, "ROUNDS", 0)
    rng, made = random.Random(9), []
    base = text(rng, 14).split()
    for k in range(110):
        w = list(base)
        for at in rng.sample(range(len(w)), 1 + k % 3):
            w[at] = f"w{rng.randrange(10**9)}"
        made.append((k, " ".join(w)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.join(documents(spark, made)).collect()} == brute(made)


def test_pairs_of_a_block_do_not_grow_with_the_square():
    signs = [J.sign_of(np.arange(50, dtype=np.uint64))] * 400
    rows = pa.record_batch(
        [pa.array([7] * 800, pa.int64()), pa.array([0] * 800, pa.int32()), pa.array([False] * 400 + [True] * 400), pa.array([*range(400)] * 2, pa.int64()), pa.array([*range(400)] * 2, pa.int64()), pa.array([50] * 800, pa.int64()), pa.array(signs * 2, pa.binary())],
        names=["unit", "block", "probe", "node", "group", "n", "sign"],
    )
    out = [r for b in J._compare(iter([rows])) for r in b.to_pylist()]
    assert len(out) < 2000 and [(r["unit"], r["block"]) for r in out if r["unit"] is not None] == [(7, 0)]
