"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from genoweave import queries
from genoweave.fixtures import Tables
from genoweave.operators import pairs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return None if x is None or isinstance(x, float) and math.isnan(x) else x


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_are_those_of_the_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    expected = duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    found = [tuple(map(plain, r)) for r in df.select(*columns).collect()]
    assert sorted(found, key=str) == sorted((tuple(map(plain, r)) for r in expected), key=str)


def test_queries_without_sql(spark):
    from genoweave.functions.names import slug_text

    rows = queries.QUERIES["slug_nfkd"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.slug == slug_text(texts[r.doc_id]) for r in rows) and len(rows) == len(texts)
    assert set(queries.QUERIES) - set(queries.ORACLE_SQL) == {"slug_nfkd"}


def test_runs_meet_stored_windows_where_they_lie(spark):
    """Windows have their true size in the plan, so no run is dealt and sorted by the few tiles; pairs alone are."""
    t = Tables(spark, SF)
    plan = pairs.profiles(queries._profile(t)[1], t.mapped(), track="srx")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["jaccard_pairs_topk", "pairs_csr", "pairs_indptr", "pairs_without_generic"])
def test_pairs_read_peaks_for_profiles_alone(spark, name):
    """Weights come from the stored profiles; no second scan of all peaks makes a table of all their tracks."""
    assert "lineitem" not in queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_profiles_broadcast_no_accessions(spark, monkeypatch):
    """Pairs meet the accessions by a join that deals both; only windows are broadcast."""
    kept = []
    monkeypatch.setattr(queries, "checkpointed", lambda df: kept.append(df) or df)
    queries._profile(Tables(spark, SF))
    plan = kept[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
