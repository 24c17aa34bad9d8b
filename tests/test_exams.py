"""Exam items and the crawl that finds their documents."""

from pyspark.sql import functions as F

from statuta.operators import crawl, exams

DOC = "id long, course string, semester string, language string, url string, source_url string, text string"


def test_areas_and_problems(spark):
    rows = spark.createDataFrame([("JUS1111", "h20", "oppgave"), ("JUS4211", "", "x"), ("XYZ", "v21", None), (None, "v21", "x")], "course string, semester string, kind string")
    got = rows.select(exams.legal_area(F.col("course")).alias("a"), exams.problem(F.col("course"), F.col("semester"), F.col("kind")).alias("p")).collect()
    assert [tuple(r) for r in got] == [("privatrett", ""), ("strafferett", "missing semester"), ("", "missing kind"), ("", "missing course")]


def test_items_and_statistics(spark):
    papers = spark.createDataFrame([(1, "JUS1111", "h20", "nn", "p1", "s", " Oppgåve "), (2, "JUS1111", "h20", "nb", "p2", "s", " Oppgave "), (3, "JUS3211", "v21", "nb", "p3", "s", None)], DOC)
    guides = spark.createDataFrame([(4, "JUS1111", "h20", "nb", "g1", "s", "Første punkt om avtl § 36.\n\nAndre punkt, avtl § 99 og ukjl § 1."), (5, "JUS9999", "v21", "nb", "g2", "s", "x")], DOC)
    names = spark.createDataFrame([("avtl", "lov/1918-05-31-4"), ("ukjl", "lov/1900-01-01-1")], "token string, key string")
    acts = spark.createDataFrame([("lov/1918-05-31-4",)], "key string")
    index = spark.createDataFrame([("lov/1918-05-31-4", "36")], "act string, token string")
    items, unresolved = exams.items(papers, guides, names, acts, index, "uio")
    got = {r.id: r for r in items.collect()}
    a, b = got["uio-jus1111-h20"], got["uio-jus3211-v21"]
    assert (a.question, a.language, a.legal_area, a.gold_refs, a.answerable, a.veiledning_url, a.oppgave_url) == ("Oppgave", "nb", "privatrett", ["lov/1918-05-31-4#§36"], True, "g1", "p2") and len(a.gold_points) == 2
    assert (b.question, b.gold_points, b.gold_refs, b.answerable, b.needs_curation, b.veiledning_url) == ("", [], [], False, True, None) and len(got) == 2
    assert sorted((r.act, r.token, r.reason) for r in unresolved.collect()) == [("lov/1900-01-01-1", "1", "unknown act"), ("lov/1918-05-31-4", "99", "unknown section")]
    assert exams.statistics(items, unresolved).first().asDict() == {"exam_papers": 2, "veiledninger": 1, "items": 2, "with_gold_points": 1, "no_veiledning": 1, "resolved_refs": 1, "unresolved_refs": 2}


def test_case_items(spark):
    rows = spark.createDataFrame([("c1", 3, "Hva?", 0, "nei", 0.1, "s"), ("c1", 3, "Hva?", 1, "ja", 0.9, "s"), ("c2", 4, "Når?", 0, "x", 0.0, "  ")], "k string, n int, question string, pos int, sentence string, score double, summary string")
    got = {r.id: (r.question, r.gold_points, r.answerable) for r in exams.case_items(rows, "k", "n", "hold").collect()}
    assert got == {"hold-00003": ("Hva?", ["ja"], True), "hold-00004": ("Når?", [], False)}


def graph():
    """A small site as (page, position, href, text)."""
    base = "https://www.uio.no/studier/emner/jus/jus/"
    page = lambda c, x="eksamen": f"{base}{c}/{x}/"
    return base, page, [
        ("https://www.uio.no/studier/emner/jus/", 0, page("JUS2111"), "a"), ("https://www.uio.no/studier/emner/jus/", 1, page("JUS1111"), "b"), ("https://www.uio.no/studier/emner/jus/", 2, "https://x.no/emner/jus/", "out"),
        ("https://www.uio.no/studier/emner/jus/", 3, "https://www.uio.no/d0-h19.pdf", "no law course page"), (page("JUS2111"), 0, page("JUS1111"), "again"), (page("JUS2111"), 1, f"{base}JUS2111/sensorveiledning-h20.pdf", "x"),
        (page("JUS2111"), 2, page("JUS3111"), "c"), (page("JUS1111"), 0, f"{base}JUS2111/sensorveiledning-h20.pdf", "seen"), (page("JUS1111"), 1, f"{base}JUS1111/eksamensoppgave-v21-nynorsk.pdf", "y"), (page("JUS3111"), 0, "https://www.uio.no/studier/emner/jus/", "back"),
    ]


def test_crawl(spark):
    base, page, rows = graph()
    links = spark.createDataFrame(rows, "page string, position int, href string, text string")
    seed, marks = "https://www.uio.no/studier/emner/jus/", ["/emner/jus/"]
    every = crawl.visited(links, [seed, seed], "uio.no", marks)
    assert [r.url for r in every.orderBy("place").collect()] == [seed, page("JUS2111"), page("JUS1111"), page("JUS3111")]
    assert [r.url for r in crawl.visited(links, [seed], "uio.no", marks, 2).orderBy("place").collect()] == [seed, page("JUS2111")]
    docs = {r.url: tuple(r)[1:] for r in crawl.documents(links, every).collect()}
    assert docs == {f"{base}JUS2111/sensorveiledning-h20.pdf": ("JUS2111", "h20", "veiledning", "nb", page("JUS2111")), f"{base}JUS1111/eksamensoppgave-v21-nynorsk.pdf": ("JUS1111", "v21", "oppgave", "nn", page("JUS1111"))}
    assert [r.kind for r in crawl.documents(links, every, 1).collect()] == ["veiledning"]


def test_crawl_broadcasts_no_links(spark, monkeypatch):
    """Links by the hundred thousand come from small files; what goes to the driver are the pages of the crawl."""
    frame = type(spark.range(0))
    plans, checkpoint = [], frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a: (plans.append(self._jdf.queryExecution().sparkPlan().toString()), checkpoint(self, *a))[1])
    base = "https://www.uio.no/emner/jus/"
    links = spark.range(40_000).select(F.concat(F.lit(base), F.col("id").cast("string")).alias("page"), F.lit(0).alias("position"), F.concat(F.lit(base), (F.col("id") + 1).cast("string")).alias("href"), F.lit("").alias("text"))
    monkeypatch.setattr(crawl, "BROADCAST_PAGES", 3, raising=False)
    for most in (3, 4):
        got = crawl.visited(links, [f"{base}39996"], "uio.no", ["/emner/jus/"], most).orderBy("place").collect()
        assert [r.url for r in got] == [f"{base}{k}" for k in range(39_996, 40_001)][:most]
    joins = [x for p in plans for x in p.splitlines() if "Join" in x]
    assert any("BroadcastHashJoin" in x for x in joins) and any("SortMergeJoin" in x for x in joins)
    assert not any("BuildLeft" in x for x in joins)  # the links stand on the left
