"""The whole job on both backends: select, search, fit, evaluate, submit, stored models."""

import pytest

from tabforge.operators import hist, metrics
from tabforge.operators.prep import MissingPlan
from tabforge.plans import fixtures, jobs
from tabforge.operators import sample

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def splits(spark):
    orders = fixtures.order_features(spark, SF_SMALL).checkpoint(eager=True)
    labelled, test = sample.split_exact(orders, "id", 0.8)
    return (*sample.split_exact(labelled, "id", 0.8), test.drop("label"))


def test_booster_job_on_gaps(spark, splits, tmp_path):
    cfg = jobs.TrainConfig(
        label="label", key="id", backend="hist", categorical=["status", "priority"], min_features=3, select_cut=0.9,
        importance_params={"n_estimators": 2, "max_depth": 2},
        params={"n_estimators": 4, "max_depth": 2, "learning_rate": 0.5, "reg_lambda": 1.0, "reg_alpha": 0.1, "gamma": 0.1},
        search_trials=1, search_space={"reg_lambda": ("logfloat", 0.1, 2.0)}, patience=2)
    out = jobs.train_select_tune(spark, cfg, *splits, out_dir=str(tmp_path))
    assert out["summary_dict"]["validation_roc_auc"] > 0.9
    assert 3 <= out["summary_dict"]["num_features_used"] < 7
    assert out["submission"].count() == splits[2].count()
    stored = hist.HistModel.load(spark, str(tmp_path / "model"))
    val = out["val_scores"].orderBy("id").collect()
    assert len(val) == splits[1].count() and stored.best_iteration == out["model"].best_iteration
    assert any(isinstance(s[1], (list, tuple)) for t in stored.trees for s in t.splits.values())  # a category set
    assert (tmp_path / "submission").exists() and (tmp_path / "summary").exists()


def test_mllib_job(spark, splits):
    cfg = jobs.TrainConfig(
        label="label", key="id", categorical=["status", "priority"], min_features=3, patience=2,
        plan=MissingPlan(exclude=["id", "label"], zero_contains=["discount"], sentinel_cols=["max_tax"],
                         categorical_cols=["status", "priority"]),
        importance_params={"n_estimators": 2, "max_depth": 2}, params={"n_estimators": 3, "max_depth": 2})
    out = jobs.train_select_tune(spark, cfg, *splits)
    assert out["submission"].columns == ["id", "label"] and out["class_report"].count() == 5


def test_three_hundred_categories_split_as_sets(spark):
    rows = [(i, i % 300 if i % 31 else None, int((i % 300) % 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, c int, y int")
    model = hist.fit_hist(df, ["c"], "y", "id", params=hist.HistParams(n_rounds=1, max_depth=1, min_child_weight=0.0),
                          categorical=["c"])
    assert len(model.trees[0].splits[0][1]) == 150  # every other code, not a range
    scored = model.predict_proba(df.filter("c is not null"), ["id", "y"])
    assert metrics.roc_auc(scored, "y", "p").first()[0] == 1.0
