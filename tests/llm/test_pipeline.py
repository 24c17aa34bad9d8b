"""The pipeline's stages in sequence on a small table, each against what it says it does."""

import ast
import pathlib

import pytest

import corpus_pipeline as P
from statuta.llm import common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, f in P.STAGES:
        new = common.table(f(spark, docs, SF), "test")
        out.append((docs, new))
        docs = new
    return out


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.count() <= before.count()
    assert stages[-1][1].count() == stages[-1][0].count()


def test_line_dedup_follows_its_input(stages):
    from .test_line_dedup import brute

    before, after = stages[1]
    got = sorted(((r.doc_id, r.text) for r in after.collect()), key=str)
    assert got == sorted(((i, t) for i, t, _ in brute([(r.doc_id, r.text) for r in before.collect()])), key=str)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicates_keep_one_each(stages):
    from .test_ngram_join import brute

    before, after = stages[2]
    want = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_decontamination_removes_verbatim_items(spark, stages):
    before, after = stages[3]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r.doc_id for r in before.collect() if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == held


def test_run_equals_stages(spark, stages):
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, stages[-1][1].collect()))


def test_native_operators_use_no_python():
    """The operators asked for as DataFrame code define no functions for the executors."""
    for name in ("mixing", "line_dedup", "chat"):
        tree = ast.parse((pathlib.Path(common.__file__).parent / f"{name}.py").read_text())
        used = {n.attr for n in ast.walk(tree) if isinstance(n, ast.Attribute)}
        assert not used & {"mapInArrow", "mapInPandas", "applyInPandas", "applyInArrow", "udf", "pandas_udf", "rdd", "localCheckpoint", "collect"}
