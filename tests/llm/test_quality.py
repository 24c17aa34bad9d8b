import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from statuta.llm import quality as Q

from .data import AWKWARD, documents, text


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.choice([rng.randint(-(10**15), 10**15), 5, -7]) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "k long")
    order = sorted(values, reverse=True)
    for k in (1, 2, 700, 1500, 3000):
        assert Q.kth_largest(rows, k, "k") == order[k - 1]


def test_best_cut():
    assert Q.best_cut(np.array([1.0, 2.0]), np.array([-1.0])) == 0.0
    assert Q.best_cut(np.array([1.0]), np.array([])) == -np.inf


def corpus(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(3000):
        t, bad = text(rng, 6), k % 8 == 0
        if bad and k % 16 == 0:
            words = t.split()
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(["scumword", "hateword"]))
            t = " ".join(words)
        elif bad:
            t = "buy now " * 60
        rows.append((k, t))
        if k % 2 == 0 or k % 8 == 0:
            labels.append((k, 0 if bad and k % 16 else 1, int(bad and k % 16 == 0)))
    return documents(spark, [*rows, *((None if i is None else i + 9000, t) for i, t in AWKWARD)]), spark.createDataFrame([*labels, (None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")


def test_keeps_clean_and_rejects_the_rest(spark):
    docs, labels = corpus(spark)
    kept = {r.doc_id for r in Q.select(docs, labels).collect()}
    bad = set(range(0, 3000, 8))
    clean = set(range(3000)) - bad
    assert len(kept & bad) <= 0.02 * len(bad) and len(clean - kept) <= 0.02 * len(clean)
    assert not {9001, 9002, 9003} & kept


def test_filter_equals_selection(spark):
    docs, labels = corpus(spark)
    more = docs.selectExpr("*", "1 as log_weight", "array(1) as w")
    out = Q.filter_documents(more, labels)
    assert out.columns == more.columns
    assert sorted((r.doc_id or -1) for r in out.collect()) == sorted((r.doc_id or -1) for r in Q.select(docs, labels).collect())


def tokens(text):
    """Tokens by a plain pattern, repeats as one sign."""
    found = re.findall(r"[!-/:-@\[-`{-~]+|[^\s!-/:-@\[-`{-~]+", text, re.ASCII)
    found = ["".join(c.lower() if c.isascii() else c for c in t) for t in found]
    return found, [t if not k or t != found[k - 1] else None for k, t in enumerate(found)]


def names(text):
    plain, signs = tokens(text)
    return {tuple(signs[k : k + n]) for n in range(1, Q.ORDER + 1) for k in range(len(signs) - n + 1)} | {("head", t.encode()[: Q.PREFIX]) for t in plain}


def test_features_and_weights_equal_brute_force(spark):
    """Distinct features of each text, counts of both models in both tables, log weights, scores."""
    rng = random.Random(3)
    texts = [text(rng, 4) + rng.choice(["", " bad!! bad!! bad!!", " na na na na"]) for _ in range(200)] + ["", "x", "a a a", "Zß !!"]
    by, cells = {}, {}
    for row, to, rows, one, two in Q._features(pa.array(texts)):
        for r, a, b in zip(rows.tolist(), one.tolist(), two.tolist()):
            by.setdefault(row + r, []).append((a, b))
    for k, t in enumerate(texts):
        mine = names(t)
        assert len(by.get(k, [])) == len(mine) == len(set(by.get(k, [])))
        for n in mine:
            cells.setdefault(n, []).append(set(by[k]))
    assert all(set.intersection(*x) for x in cells.values())  # a feature has the same cells wherever it occurs
    labelled = {k: k % 3 > 0 for k in range(200)}
    got = Q.weigh(documents(spark, list(enumerate(texts))), labelled)
    raw, wanted = np.zeros(2 << Q.BITS), np.zeros(2 << Q.BITS)
    for k, found in by.items():
        for x in np.array(found).ravel():
            raw[x] += 1
            wanted[x] += bool(labelled.get(k)) and Q._trains(k)
    for x in {x for found in by.values() for p in found for x in p}:
        expected, error = raw[x] * wanted.sum() / raw.sum(), Q.SIGMAS * math.sqrt(wanted[x] + 1) + 1
        want = math.log((wanted[x] + error) / expected) if wanted[x] + error < expected else math.log((wanted[x] - error) / expected) if wanted[x] - error > expected else 0.0
        assert abs(got[x] - want) < 1e-4
    w = np.random.default_rng(1).standard_normal(2 << Q.BITS).astype(np.float32)
    scores = Q._scores(pa.array(texts), w)
    for k in range(len(texts)):
        pairs = [(w[a], w[b]) for a, b in by.get(k, [])]
        want = sum(min(p, key=abs) if p[0] * p[1] > 0 else 0 for p in pairs) / math.sqrt(1 + len(pairs) / Q.LONG) if pairs else math.nan
        assert math.isnan(want) and math.isnan(scores[k]) or abs(scores[k] - want) < 1e-3


def test_gumbel_top_k(spark):
    """The draw is the k largest keys of those with words; weights have either sign; seeds differ, and keys follow Gumbel's law."""
    docs, labels = corpus(spark)
    model, scored = Q.fit(docs, labels)
    rows = scored.collect()
    k = sum(r.log_weight >= model.cut for r in rows)
    want = sorted((r.gumbel_key for r in rows), reverse=True)[:k]
    got = Q.select(docs, labels).collect()
    assert sorted((r.gumbel_key for r in got), reverse=True)[:k] == want and len(got) >= k
    noise = np.array([r.gumbel_key / Q.UNIT - r.log_weight / Q.TEMPERATURE for r in rows if r.doc_id is not None])
    assert abs(noise.mean() - 0.5772) < 0.1 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.1
    spread = spark.range(4000).selectExpr("id as doc_id", "(id % 100) / 50.0 - 1.0 as log_weight")
    draws = []
    for seed in (7, 8):
        keyed = spread.withColumn("gumbel_key", Q.gumbel_key(seed, Q.TEMPERATURE))
        draws.append({r.doc_id for r in keyed.where(F.col("gumbel_key") >= Q.kth_largest(keyed, 2000, "gumbel_key")).collect()})
    assert all(len(d) == 2000 for d in draws) and 100 < len(draws[0] - draws[1]) < 1000


def test_held_out_labels(spark):
    """On half of a given table's labels, none of which the model has seen."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in Q.select(docs, labels).collect()}
    truth = {r.doc_id: (r.quality, r.toxic) for r in labels.collect() if not Q._trains(r.doc_id)}
    share = lambda *kinds: sum(i in kept for i, t in truth.items() if t in kinds) / sum(t in kinds for t in truth.values())
    print("kept of clean, toxic, low-quality:", share((1, 0)), share((1, 1), (0, 1)), share((0, 0)))
    assert share((1, 0)) >= 0.97 and share((0, 0)) <= 0.08


def test_without_labels_or_rows(spark):
    docs, labels = corpus(spark)
    assert Q.select(docs, labels.where("false")).count() == docs.where(F.length(F.trim(F.regexp_replace("text", r"\s", ""))) > 0).count()
    assert Q.select(docs.where("false"), labels).count() == 0
