"""Queries that answer for all rows, and orders that many tasks make together."""

import random

from pyspark.sql import functions as F

from statuta.functions import text
from statuta.operators import cite, graph, sampling
from statuta.plans import registry
from statuta.sources import corpus

SF = "/root/testdata/sf0.001"


def test_every_act_is_resolved(spark):
    acts = {r.key for r in corpus.acts(spark, SF).select("key").collect()}
    has = {r.law_ref_id for r in corpus.paragraphs(spark, SF).where("position <= 3").select("law_ref_id").distinct().collect()}
    got = {r.ref.split("#")[0] for r in registry.QUERIES["resolve_section"](spark, SF).collect()}
    assert got == acts & has


def test_every_name_is_ranked(spark):
    got = sorted((r.place, r.name) for r in registry.QUERIES["natural_order"](spark, SF).collect())
    names = [n for _, n in got]
    assert [p for p, _ in got] == list(range(1, len(got) + 1)) and names == sorted(names, key=lambda n: tuple(map(int, n[4:].split("."))))


def test_digits_of_any_length(spark):
    names = ["a2", "a10", "a010b", "a9999999999", "a10000000000000000000000", "a", "b1", "", "12", "2", "0", "00"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").withColumn("k", text.natural_key(F.col("name")))
    by = {r.name: r.k for r in rows.collect()}
    assert by["a2"] < by["a10"] < by["a010b"] < by["a9999999999"] < by["a10000000000000000000000"] < by["b1"] and by["0"] == by["00"] < by["2"] < by["12"] < by["a"]


def test_places_in_any_number_of_ranges(spark):
    rng = random.Random(1)
    values = [rng.choice([None, "x", *(f"{rng.random()}" for _ in range(5))]) for _ in range(500)]
    rows = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "v string, k long").repartition(5)
    got = sorted((r.place, r.v is not None, r.v or "", r.k) for r in sampling.with_place(rows, ["v", "k"]).collect())
    assert [g[0] for g in got] == list(range(500)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert sampling.with_place(rows.where("false"), ["v"]).count() == 0


def test_places_come_from_no_single_task(spark):
    plan = sampling.with_place(spark.range(1000).toDF("v"), ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and plan.count("SinglePartition") <= 1  # one row a range


def test_quotes_of_all_lengths(spark):
    rng = random.Random(2)
    words = ["al", "be", "gam", "delta", "eps", "zeta", "eta"]
    docs = {k: "  ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for k in range(120)}
    quotes = {}
    for k in range(150):
        d = " ".join(docs[rng.randrange(120)].split())
        a = rng.randint(0, max(0, len(d) - 1))
        quotes[k] = d[a : a + rng.choice([2, 4, 7, 12, 20, 35, 60])].replace(" ", rng.choice([" ", "\n "]))
    want = {(q, i) for q, t in quotes.items() for i, d in docs.items() if " ".join(t.split()) in " ".join(d.split())}
    made = lambda x, c: spark.createDataFrame(list(x.items()), c)
    for kinds in (lambda t: True, lambda t: len(t.split()) > 8, lambda t: len(t.split()) < 3):
        some = {q: t for q, t in quotes.items() if kinds(t)}
        got = cite.find_texts(made(some, "quote_id long, quote string"), made(docs, "doc_id long, content string")).collect()
        assert sorted(map(tuple, got)) == sorted(x for x in want if x[0] in some)


def test_reach_equals_a_walk(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(60)]
    depth, front = {0: 0}, {0}
    for k in range(1, 5):
        front = {b for a, b in edges if a in front} - set(depth)
        depth |= dict.fromkeys(front, k)
    got = graph.reach(spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame([(0,)], "node long"), 4)
    assert {r.node: r.depth for r in got.collect()} == depth
