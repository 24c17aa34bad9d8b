"""Every registered query of the engine against its SQL, and what its plan must not hold."""

import os

import duckdb
import pytest

from statuta.plans import registry

SF = "/root/testdata/sf0.001"
PYTHON = {"page_links", "page_text"}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    key = lambda r: [(x is None, str(x)) for x in r]
    return sorted((tuple(None if x is None or x != x else round(x, 9) if isinstance(x, float) else str(x) if isinstance(x, bool) else x for x in r) for r in frame.where(frame.notna(), None).itertuples(index=False, name=None)), key=key)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, tables, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), tables.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - PYTHON))
def test_plan_stays_in_the_jvm(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "CartesianProduct"))


def test_same_rows_with_other_partitions(spark):
    def rows():
        return [sorted(map(str, registry.QUERIES[n](spark, SF).collect())) for n in ("citation_unresolved_sample", "synthetic_items", "dedupe_objects_first_wins")]

    before = rows()
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert rows() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
