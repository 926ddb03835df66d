"""The resolver's queries against DuckDB on the provided tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from kinfold import queries as Q
from kinfold import run_queries as R

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
#: One query of each area; the driver runs all.
SOME = ["alias_set", "country_keys", "metaphone_codes", "downblock_keys", "match_edges", "golden_json", "load_order", "job_gating"]


@pytest.mark.parametrize("name", SOME)
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("customer", "part", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = E.queries()[name](spark, SF).toPandas(), con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = lambda df: sorted(tuple(map(str, r)) for r in df[cols].itertuples(index=False))
    assert rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(Q.oracle_sql()) | set(R.oracle_sql()) == set(Q.QUERIES) | set(R.QUERIES)


def test_profiles_are_written_by_all_tasks(spark):
    from kinfold.sources.files import Files
    from kinfold.sources.profiles import load_profiles

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = R._written(spark, SF)
        assert all(len([n for n in Files(spark, out).names(k) if ".jsonl" in n]) > 1 for k in ("a/deep", "a-x", "b"))
        rows = load_profiles(spark, out).profiles.select("idx", "full_name").orderBy("idx").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    v = sorted((r.idx % 3, r.idx, r.full_name) for r in Q._view(spark, SF).collect())
    assert [(r.idx, r.full_name) for r in rows] == [(i, name) for i, (_, _, name) in enumerate(v)]
