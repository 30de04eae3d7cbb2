"""Differential tests: every registered query against its DuckDB oracle on the
smallest driver tables; rows-only queries must run and keep their schema."""

import hashlib
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from echolens.plans import catalog
from echolens.sources.tables import TEST_TABLES

from conftest import SF_SMALL

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def _check_plan(name, df):
    """Scale properties every registered plan must keep: no cross products and no Python."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
    assert not re.search("ArrowEvalPython|BatchEvalPython|MapInPandas|InPandas", plan), name


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["theme", "theme_desc", "n"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    _check_plan(name, df)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    _check_plan(name, df)
    assert df.count() >= 0 and df.columns


def test_model_query_invariants(spark):
    """Rows-only queries still obey their contracts on the driver tables."""
    sc = QUERIES["emotion_scores"](spark, SF_SMALL).toPandas()
    ok = sc[sc.score_status == "ok"]
    assert len(ok) > 0 and set(sc.score_status) <= {"ok", "skipped"}
    assert ((ok[["anger", "joy", "optimism", "sadness"]].sum(axis=1) - 1).abs() <= 0.005).all()
    assert sc[sc.score_status == "skipped"][["anger", "joy"]].isna().all().all()
    prev = QUERIES["lda_prevalence"](spark, SF_SMALL).toPandas()
    assert abs(prev.pct.sum() - 100) < 1e-6 and prev.num_topic.between(0, 19).all()
    coh = QUERIES["coherence"](spark, SF_SMALL).toPandas()
    assert coh.c_v.between(-1, 1).all() and (coh.topic == -1).sum() == 1
    clf = QUERIES["account_classifier"](spark, SF_SMALL).toPandas()
    assert clf.p_true.between(0, 1).all()


def test_document_features_are_stored_before_a_fit_reads_them(spark):
    """A fit and its predictions read stored rows: nothing is tokenised again."""
    from echolens.plans.queries import _common as C
    plan = C._doc_features(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "Relation" in plan
