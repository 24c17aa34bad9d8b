import hashlib
import random

import duckdb

from statuta.llm import line_dedup as L

from .data import AWKWARD, documents, sentence


def h(line):
    return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)


def cut(text):
    lines = text.split("\n")
    hashes = [h(line) for line in lines]
    rolled = [L._NEVER] + [(b + L.ROLL * a) % L.MODULUS for a, b in zip(hashes, hashes[1:])]
    ends = [k for k in range(1, len(lines) - 2) if rolled[k] < rolled[k - 1] and rolled[k] <= rolled[k + 1]]
    starts = [0, *(k + 1 for k in ends), len(lines)]
    return [lines[a:b] for a, b in zip(starts, starts[1:])]


def brute(rows):
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if t is None:
            out.append((i, None, 0))
            continue
        kept, gone = [], 0
        for k, c in enumerate(cut(t)):
            body = "\n".join(c)
            if len(c) > 1 and seen.setdefault(body, (i, k)) != (i, k):
                gone += 1
            else:
                kept.append(body)
        out.append((i, "\n".join(kept), gone))
    return sorted(out, key=str)


def rows():
    rng = random.Random(6)
    lines = [sentence(rng, 4) for _ in range(60)]
    shared = [lines[k : k + 9] for k in (0, 20, 40)]
    made = [(100 + k, "\n".join([sentence(rng, 5) for _ in range(rng.randint(0, 6))] + rng.choice(shared) + [sentence(rng, 5)] * rng.randint(0, 3))) for k in range(60)]
    return [*made, (200, made[0][1]), (201, made[0][1]), (202, "\n\n\n\n"), (203, "\n1 a\n0 b\n1\n0"), (204, "\n1 a\n0 b\n1\n0"), *AWKWARD]


def test_equals_brute_force(spark):
    docs = documents(spark, rows())
    got = sorted(((r.doc_id, r.text, r.removed_chunks) for r in L.dedup(docs).collect()), key=str)
    assert got == brute(rows()) and any(r[2] for r in got)


def test_equals_sql(spark):
    some = [r for r in dict(rows()).items() if r[0] is not None]
    con = duckdb.connect()
    documents = __import__("pandas").DataFrame(some, columns=["doc_id", "text"])
    con.register("documents", documents)
    want = sorted(con.sql(L.ORACLE).fetchall(), key=str)
    from .data import documents as made

    assert sorted(((r.doc_id, r.text, r.removed_chunks) for r in L.dedup(made(spark, some)).collect()), key=str) == want


def test_columns_and_empty_table(spark):
    docs = documents(spark, rows()).selectExpr("*", "1 as __at", "'x' as `__chunk`", "2 as __first")
    out = L.dedup(docs)
    assert out.columns == [*docs.columns, "removed_chunks"] and out.count() == docs.count()
    assert L.dedup(docs.where("false")).count() == 0


def test_insertion_moves_no_other_boundary():
    rng = random.Random(8)
    lines = [sentence(rng, 5) for _ in range(200)]
    a, b = cut("\n".join(lines)), cut("\n".join([*lines[:50], "new", *lines[50:]]))
    assert len({tuple(c) for c in a} - {tuple(c) for c in b}) <= 3


def test_chunks_have_two_lines_or_more_and_three_on_average():
    rng = random.Random(9)
    for n in (2, 3, 4, 50):
        assert all(len(c) > 1 for c in cut("\n".join(sentence(rng, 5) for _ in range(n))))
    assert 2.5 < 3000 / len(cut("\n".join(sentence(rng, 5) for _ in range(3000)))) < 3.5


def test_planted_blocks_and_runs_of_equal_lines(spark):
    """Recall of the chunks: repeated blocks by length, and a run of one line over and over."""
    rng = random.Random(10)
    lost, made = {n: [] for n in (4, 6, 9, 14)}, []
    for n in lost:
        for k in range(40):
            block = [sentence(rng, 6) for _ in range(n)]
            host = lambda: [sentence(rng, 6) for _ in range(7)]
            made += [(n * 1000 + 2 * k, "\n".join(host() + block + host())), (n * 1000 + 2 * k + 1, "\n".join(host() + block + host()))]
            lost[n].append((n * 1000 + 2 * k + 1, set(block)))
    made += [(50_000 + k, "\n".join([sentence(rng, 6) for _ in range(5)] + ["the same line"] * 9 + [sentence(rng, 6) for _ in range(5)])) for k in range(2)]
    got = {r.doc_id: r for r in L.dedup(documents(spark, made)).collect()}
    found = {n: sum(bool(block - set(got[i].text.split("\n"))) for i, block in rows) / len(rows) for n, rows in lost.items()}
    lines = {n: sum(len(block - set(got[i].text.split("\n"))) / len(block) for i, block in rows) / len(rows) for n, rows in lost.items()}
    print("share of planted blocks that lose lines, and of their lines lost:", found, lines)
    assert found[9] >= 0.9 and found[14] == 1.0 and lines[14] > 0.6
    assert all(r.removed_chunks == 0 for i, r in got.items() if i % 2 == 0)


def test_equal_hashes_of_other_bytes(spark, monkeypatch):
    """With hashes that nearly always collide, texts decide."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(L, "_hashes", lambda c: {"h": F.pmod(F.xxhash64(c), F.lit(3)), "g": F.lit(0).cast("long")})
    got = sorted(((r.doc_id, r.text, r.removed_chunks) for r in L.dedup(documents(spark, rows())).collect()), key=str)
    assert got == brute(rows())


def test_clashing_names(spark):
    docs = documents(spark, rows()).selectExpr("*", "5 as __row", "6 as row", "7 as id", "8 as removed_chunks", "9 as c0", "10 as cut", "array(11) as again", "12 as h")
    out = L.dedup(docs)
    assert out.columns == [*(c for c in docs.columns if c != "removed_chunks"), "removed_chunks"]
    assert {(r["__row"], r.row, r.id, r.c0, r.cut, tuple(r.again), r.h) for r in out.collect()} == {(5, 6, 7, 9, 10, (11,), 12)}


def test_long_texts_take_linear_time(spark):
    import time

    rng, took = random.Random(12), []
    for n in (20_000, 40_000):
        lines = "\n".join(sentence(rng, 4) for _ in range(n))
        docs = documents(spark, [(1, lines), (2, lines)])
        began = time.time()
        assert [r.text for r in L.dedup(docs).orderBy("doc_id").collect()] == [lines, ""]
        took.append(time.time() - began)
    assert took[1] < 2.5 * took[0] + 2
