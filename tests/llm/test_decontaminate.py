import random

import numpy as np
import pyarrow as pa
import pytest

from statuta.llm import decontaminate as D

from .data import AWKWARD, WORDS, documents, sentence, text


def brute(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_lcs():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 80))] for _ in range(2))
        assert D._lcs(a, b) == brute(a, b)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    items = [(k, " ".join(sentence(rng, rng.randint(8, 25)) for _ in range(2))) for k in range(30)]
    rows, truth = [(100 + k, text(rng, 40)) for k in range(150)], set()
    for k, item in items[:20]:
        host = text(rng, 30)
        cut = rng.randint(0, len(host))
        rows.append((k, host[:cut] + " " + item + " " + host[cut:]))
        truth.add((k, k))
    words = items[20][1].split()
    gone = {3, 9, 14} if len(words) > 20 else {3}
    rows.append((50, text(rng, 20) + " " + " ".join(w for i, w in enumerate(words) if i not in gone) + " " + text(rng, 20)))
    truth.add((50, 20))
    rows.append((60, items[21][1].upper()))
    truth.add((60, 21))
    return documents(spark, [*rows, *((i and i + 500, t) for i, t in AWKWARD)]), spark.createDataFrame([*items, (90, None), (91, ""), (92, "zzz yyy xxx")], "item_id long, text string"), truth


def test_svd_of_sketch():
    """Against a full SVD of a matrix with a decaying spectrum."""
    rng = np.random.default_rng(1)
    u, _ = np.linalg.qr(rng.standard_normal((300, 60)))
    v, _ = np.linalg.qr(rng.standard_normal((90, 60)))
    a = u * 2.0 ** -np.arange(60) @ v.T
    y = a @ rng.standard_normal((90, 30))
    values, vectors = D.svd_of_sketch(y.T @ y, a.T @ y, 8)
    _, true, right = np.linalg.svd(a)
    assert np.allclose(values, true[:8], rtol=1e-3)
    assert np.allclose(np.abs(np.sum(vectors * right[:8].T, axis=0)), 1, atol=1e-2)


def test_directions_equal_a_dense_svd(spark):
    """The latent directions of a small corpus span what a dense SVD of its TF-IDF passages spans."""
    rng = random.Random(6)
    topics = [[rng.choice(WORDS) for _ in range(12)] for _ in range(3)]
    docs = documents(spark, [(k, " ".join(rng.choice(topics[k % 3]) for _ in range(90))) for k in range(60)])
    seen, passages = D._frequencies(docs)
    idf = np.log((passages + 1.0) / (seen + 1.0)) + 1
    rows = []
    for r in docs.collect():
        for _, _, h, _ in D.C.hashed(pa.array([r.text])):
            f = D._features(h)
            for lo in range(0, len(f), D.PASSAGE):
                x = np.bincount(f[lo : lo + D.PASSAGE], minlength=1 << D.BITS) * idf
                rows.append(x / np.linalg.norm(np.unique(f[lo : lo + D.PASSAGE], return_counts=True)[1] ** 0.5 * idf[np.unique(f[lo : lo + D.PASSAGE])]))
    assert len(rows) == passages
    _, _, right = np.linalg.svd(np.array(rows), full_matrices=False)
    got = D._directions(docs)[:-1, :2] / idf[:, None]
    got /= np.linalg.norm(got, axis=0)
    assert np.linalg.norm(right[:2] @ got, axis=0).min() > 0.98


def test_recall_of_the_search_against_all_windows(spark, monkeypatch):
    """Of planted paraphrases that the checks accept in some window, the cosine search finds 0.98 or more, short items too."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    directions = D._directions(docs)
    rows = [(r.item_id, r.text) for r in bench.collect()]
    items, rng = D._Items(rows, directions), random.Random(1)
    hosts = [r.text.split() for r in docs.limit(400).collect() if r.text]
    words = [w for h in hosts for w in h]
    texts, which = [], []
    for _ in range(1 + 400 // len(rows)):
        for item, t in rows:
            host = rng.choice(hosts)[:200]
            cut = rng.randint(0, len(host))
            texts.append(" ".join([*host[:cut], *(x if rng.random() > 0.36 else rng.choice(words) for x in t.split()), *host[cut:]]))
            which.append(items.ids.index(item))
    got = {(r, k) for r, k, *_ in D._search(pa.array(texts), items, directions)}
    monkeypatch.setattr(D, "COSINE", -1.0)
    truth, every = set(), items.by
    for row, (t, k) in enumerate(zip(texts, which)):  # each text against its own item, all windows
        items.by = {n: (x[0][x[0] == k], x[1][x[0] == k]) for n, x in every.items() if (x[0] == k).any()}
        truth |= {(row, k) for _ in D._search(pa.array([t]), items, directions)}
    short = {(r, k) for r, k in truth if len(items.words[k]) < 20}
    print(f"recall {len(got & truth) / len(truth):.3f} of {len(truth)}, of items under 20 words {len(got & short) / max(1, len(short)):.3f} of {len(short)}")
    assert len(truth) > 50 and len(got & truth) >= 0.98 * len(truth) and len(got & short) >= 0.95 * len(short)


def test_finds_planted_and_nothing_else(planted):
    docs, items, truth = planted
    assert {(r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()} == truth


def test_clean_keeps_rows_and_columns(planted):
    docs, items, truth = planted
    out = D.clean(docs.selectExpr("*", "7 as c0"), items)
    assert out.columns == [*docs.columns, "c0"]
    left = [r.doc_id for r in out.collect()]
    assert len(left) == docs.count() - len(truth) and not {d for d, _ in truth} & set(left)


def test_blocks_of_items(planted, monkeypatch):
    docs, items, truth = planted
    monkeypatch.setattr(D, "ITEMS", 7)
    assert {(r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()} == truth


def test_empty_tables(planted):
    docs, items, _ = planted
    assert D.leaks(docs.where("false"), items).count() == 0 and D.leaks(docs, items.where("false")).count() == 0
    assert D.clean(docs, items.where("false")).count() == docs.count()


def test_run_sums():
    rng = np.random.default_rng(3)
    vectors, which = rng.integers(0, 9, (50, 4)).astype(np.float32), rng.integers(0, 50, 400)
    counts = np.array([1, 7, 1, 90, 33, 2])
    starts = np.array([5, 0, 399, 300, 40, 11])
    got = D._run_sums(vectors, which, starts, counts)
    assert np.array_equal(got, [vectors[which[s : s + n]].sum(axis=0) for s, n in zip(starts, counts)])
    assert D._run_sums(vectors, which, starts[:0], counts[:0]).shape == (0, 4)


def test_products_equal_dense_ones():
    rng = np.random.default_rng(4)
    grid, y = np.minimum(rng.geometric(0.02, (1500, D.PASSAGE)), 1 << D.BITS), rng.integers(-4, 5, (1500, 3)).astype(np.float32)
    got, true = np.zeros(((1 << D.BITS) + 1, 3), np.float32), np.zeros(((1 << D.BITS) + 1, 3), np.float32)
    D._add_products(got, grid, y)
    np.add.at(true, grid.ravel(), np.repeat(y, D.PASSAGE, axis=0))
    assert np.array_equal(got, true)


def test_window_sums():
    steps = np.random.default_rng(5).integers(0, 9, (40, 3)).astype(np.float32)
    got = dict(D._window_sums(steps, [1, 4, 7, 13, 40, 41]))
    assert list(got) == [1, 4, 7, 13, 40]
    for n, v in got.items():
        assert np.array_equal(v, [steps[k : k + n].sum(axis=0) for k in range(41 - n)])


def test_copies_have_one_cosine_wherever_they_stand(spark):
    rng = random.Random(8)
    docs = [text(rng, 60) for _ in range(1200)]
    item = " ".join(sentence(rng, 12) for _ in range(3))
    copy = f"{text(rng, 20)} {item} {text(rng, 20)}"
    directions = D._directions(documents(spark, [(k, t) for k, t in enumerate(docs[:200])]))
    texts = [copy if k % 100 == 0 else t for k, t in enumerate(docs)]
    found = list(D._search(pa.array(texts), D._Items([(0, item)], directions), directions))
    assert [r for r, *_ in found] == list(range(0, 1200, 100))
    assert max(c for _, _, c, *_ in found) - min(c for _, _, c, *_ in found) <= 1e-6


def test_few_windows_are_compared_word_by_word(spark, monkeypatch):
    """Those that may share enough words; with all near windows compared the rows are the same."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    directions = D._directions(docs)
    items = D._Items([(r.item_id, r.text) for r in bench.collect()], directions)
    texts = pa.array([r.text for r in docs.collect()] + [r.text for r in bench.collect()])
    calls, leak = [], D._Items.leak

    def counted(self, k, window):
        found = sum(n for w, n in self.counts[k].items() if w in set(window))
        calls.append(found >= (len(self.words[k]) if len(self.words[k]) < D.SHORT else D.PARAPHRASE * len(self.words[k])))
        return leak(self, k, window)

    monkeypatch.setattr(D._Items, "leak", counted)
    got = list(D._search(texts, items, directions))
    assert len(got) >= len(items.ids) and sum(calls) >= 0.5 * len(calls)
    few, calls[:] = len(calls), []
    items.needs = np.zeros(len(items.ids))
    assert list(D._search(texts, items, directions)) == got and len(calls) > few
