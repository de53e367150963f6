"""Every query with an oracle equals its DuckDB SQL on the driver tables
(the driver's correctness gate, run here on sf0.001 and a subset on sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tabforge.plans.queries import all_queries
from tabforge.sources.tables import TABLES

from .conftest import SF_ORACLE, SF_SMALL

ORACLES = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


def _duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def duck_small():
    return _duck(SF_SMALL)


def _compare(spark, con, name, sf_dir):
    df = E.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    want = [tuple(dict(zip(ocols, r))[c] for c in cols) for r in res.fetchall()]
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_small(spark, duck_small, name):
    _compare(spark, duck_small, name, SF_SMALL)


@pytest.mark.parametrize("name", ["split_train", "downsample_balanced", "pr_auc", "roc_auc",
                                  "median_values", "cumulative_selection", "missing_plan_full"])
def test_oracle_sf001(spark, name):
    _compare(spark, _duck(SF_ORACLE), name, SF_ORACLE)


def test_every_query_has_oracle_or_is_model_based():
    model_based = {"gbt_importance", "gbt_history", "gbt_score", "search_trials", "pca_variance",
                   "pca_scores", "pca_quality", "hist_booster_history", "hist_booster_score",
                   "order_submission", "weight_sweep"}
    missing = set(all_queries()) - set(ORACLES) - model_based
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["split", "label", "n"]
