import random
import re

import duckdb
import pandas as pd

from statuta.llm import span_dedup as S

from .data import AWKWARD, documents, sentence, text


def windows(units):
    """Spans by trying all ends."""
    n, w, out = len(units), [len(u.split()) for u in units], []
    for k in range(n):
        ends = [e for e in range(k + 1, n + 1) if sum(w[k:e]) >= S.LONG or sum(w[k:e]) >= S.WORDS and e - k >= S.RUN]
        out += [(k, ends[0])] if ends else []
    if not out:
        return [(0, n)] if n else []
    return out if out[-1][1] == n else [*out, (out[-1][0], n)]


def brute(rows):
    cut = {}
    for i, t in rows:
        units = re.findall(S.SENTENCE, t) if t is not None else []
        trimmed = [u.strip(" \t\r\n") for u in units]
        cut[i] = (t, units, [(k, e, "\n".join(trimmed[k:e])) for k, e in windows(trimmed)])
    first, out = {}, []
    for i in sorted(cut, key=lambda x: (x is not None, x or 0)):
        t, units, runs = cut[i]
        gone = set()
        for k, e, r in runs:
            if first.setdefault(r, (i, k)) != (i, k):
                gone |= set(range(k, e))
        out.append((i, None if t is None else "".join(u for k, u in enumerate(units) if k not in gone), len(gone)))
    return sorted(out, key=str)


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        words = [rng.choice([0, 1, 2, 5, 9, 14, 25, 40]) for _ in range(rng.randint(0, 12))]
        assert S.runs(words) == windows([" ".join("x" * n) for n in words])


def rows():
    rng = random.Random(7)
    passages = [" ".join(sentence(rng, rng.randint(5, 15)) for _ in range(6)) for _ in range(5)]
    out = []
    for k in range(70):
        host = text(rng, rng.randint(1, 10)).replace(". ", rng.choice([". ", ".\n", "! ", "... "]))
        at = rng.randint(0, len(host))
        out.append((100 + k, host[:at] + rng.choice([" ", "\n"]) + rng.choice(passages) + " " + host[at:] if rng.random() < 0.6 else host))
    return [*out, (300, out[0][1]), (301, out[0][1]), (302, "One sentence without an end that is long enough to count"), (303, "One sentence without an end that is long enough to count"), (304, "...!?\n\n. ."), (305, "Er. Er. Er. Er.")]


def test_equals_brute_force(spark):
    made = [*rows(), *dict(AWKWARD).items()]
    got = sorted(((r.doc_id, r.text, r.removed_sentences) for r in S.dedup(documents(spark, made)).collect()), key=str)
    assert got == brute(made) and sum(r[2] > 0 for r in got) > 20


def test_equals_sql(spark):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows(), columns=["doc_id", "text"]))
    assert sorted(((r.doc_id, r.text, r.removed_sentences) for r in S.dedup(documents(spark, rows())).collect()), key=str) == sorted(con.sql(S.ORACLE).fetchall(), key=str)


def test_planted_passages_stay_once(spark):
    rng = random.Random(11)
    passage = " ".join(sentence(rng, 11) for _ in range(6))
    made = [(k, text(rng, 5) + " " + passage + " " + text(rng, 5)) for k in range(12)] + [(50 + k, text(rng, 9)) for k in range(20)]
    got = {r.doc_id: r for r in S.dedup(documents(spark, made)).collect()}
    inner = passage.split(". ", 1)[1]
    assert [k for k in range(12) if inner in got[k].text] == [0] and all(got[50 + k].removed_sentences == 0 for k in range(20))


def test_small_steps_give_equal_results(spark, monkeypatch):
    """Spans met in tiny groups before the shuffle, and one that all documents hold."""
    monkeypatch.setattr(S, "AT_ONCE", 50)
    hot = " ".join(sentence(random.Random(1), 12) for _ in range(4))
    made = [*rows(), *((1000 + k, hot + f" The {k} end.") for k in range(200))]
    assert sorted(((r.doc_id, r.text, r.removed_sentences) for r in S.dedup(documents(spark, made)).collect()), key=str) == brute(made)


def test_short_phrases_and_long_sentences(spark):
    """Texts of very short sentences that repeat a passage lose it; one long sentence that repeats goes; chance repeats stay."""
    rng = random.Random(4)
    short = " ".join(sentence(rng, 2) for _ in range(30))
    long = " ".join(f"word{k}" for k in range(60)) + "."
    made = [(1, short), (2, text(rng, 4) + " " + short), (3, text(rng, 4) + " " + long), (4, text(rng, 4) + "\n" + long + "\n" + text(rng, 4)), (5, text(rng, 4) + " En. Le. " + text(rng, 4)), (6, text(rng, 4) + " En. Le. " + text(rng, 4))]
    got = {r.doc_id: r for r in S.dedup(documents(spark, made)).collect()}
    assert short not in got[2].text and "word30" not in got[4].text and "word30" in got[3].text and not got[5].removed_sentences and not got[6].removed_sentences


def test_long_texts_take_linear_time(spark):
    import time

    took = []
    for n in (20_000, 40_000):
        rng = random.Random(12)
        whole = " ".join(sentence(rng, 4) for _ in range(n))
        docs = documents(spark, [(1, whole), (2, whole)])
        began = time.time()
        assert [r.text for r in S.dedup(docs).orderBy("doc_id").collect()] == [whole, ""]
        took.append(time.time() - began)
    assert took[1] < 2.5 * took[0] + 2


def test_clashing_names(spark):
    docs = documents(spark, rows()).selectExpr("*", "5 as __row", "6 as row", "7 as id", "8 as removed_sentences", "9 as c0", "10 as begins")
    out = S.dedup(docs)
    assert out.columns == [*(c for c in docs.columns if c != "removed_sentences"), "removed_sentences"]
    assert {(r["__row"], r.row, r.id, r.c0, r.begins) for r in out.collect()} == {(5, 6, 7, 9, 10)}
    assert sorted(((r.doc_id, r.text, r.removed_sentences) for r in out.collect()), key=str) == brute(rows())


def test_repeated_rows_columns_and_empty(spark):
    docs = documents(spark, [*rows(), *rows()[:3], *AWKWARD]).selectExpr("*", "1 as __run", "2 as count")
    out = S.dedup(docs)
    assert out.columns == [*docs.columns, "removed_sentences"] and out.count() == docs.count()
    assert S.dedup(docs.where("false")).count() == 0
