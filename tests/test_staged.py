"""Staged files, the cache of what was parsed, acts and labels to fetch."""

import hashlib

from statuta.sources import staged


def test_files_and_publications(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "inns-1.xml").write_text("<Innstilling><a>æ</a></Innstilling>")
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    got = {r.name: r for r in staged.files(spark, str(tmp_path)).collect()}
    assert got["b.pdf"].sha256 == hashlib.sha256(b"%PDF").hexdigest() and got["b.pdf"].bytes == 4 and got["b.pdf"].cache_name == "b.pdf" and len(got) == 2
    assert [tuple(r) for r in staged.publications(spark, str(tmp_path)).collect()] == [("inns-1", "<Innstilling><a>æ</a></Innstilling>")]


def test_cache(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert staged.cached(spark, str(tmp_path / "c"), make).count() == 3
    assert len(made) == 1


def test_acts_and_labels(spark):
    docs = spark.createDataFrame([(["32014l0040", "32009R0469"],), (["32014L0040", ""],), (None,)], "celex array<string>")
    assert sorted(r.id for r in staged.acts_to_fetch(docs).collect()) == ["32009R0469", "32014L0040"] and [r.id for r in staged.acts_to_fetch(docs, 1).collect()] == ["32009R0469"]
    acts = spark.createDataFrame([([f"{k:03d}" for k in range(120)],), (["000"],)], "eurovoc array<string>")
    got = sorted((r.batch, r.ids) for r in staged.label_batches(acts).collect())
    assert [len(i) for _, i in got] == [50, 50, 20] and sum((i for _, i in got), []) == [f"{k:03d}" for k in range(120)]
