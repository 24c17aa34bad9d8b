import random
from collections import defaultdict

from statuta.llm import mixing

from .data import AWKWARD, documents, text


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    out, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        if not full:
            return out | {s: share * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= set(full)
    return out


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 16)
    rng = random.Random(3)
    rows = [(k, text(rng, rng.randint(1, 30)), rng.choice(["a", "a", "a", "b", "c", "d", None, "é"])) for k in range(400)] + [(1000 + k, t, "z") for k, (_, t) in enumerate(AWKWARD)] + [(None, None, "empty")]
    got = mixing.mix(documents(spark, rows).selectExpr("*", "1 as size", "2 as rank")).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    want = targets(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_words(spark):
    docs = documents(spark, [(1, "a b c\x0b\x0cd\te\n f "), (2, None), (3, " ")])
    assert {r.doc_id: r["size"] for r in mixing.mix(docs).collect()} == {1: 5, 2: 0, 3: 0}


def test_no_words_and_no_rows(spark):
    docs = documents(spark, [(1, ""), (2, None)])
    assert [(r.target, r.taken) for r in mixing.mix(docs).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix(docs.where("false")).count() == 0


def test_rows_without_ids_spread(spark):
    """Keys of rows without doc_id differ by text, so they fall into many ranges; the sum still meets the target."""
    rng = random.Random(2)
    docs = documents(spark, [(None, text(rng, 2), "s") for _ in range(300)])
    rows = mixing.mix(docs).collect()
    assert sum(r.taken for r in rows) == int(rows[0].target) and len({r.taken - r["size"] for r in rows}) > 2
