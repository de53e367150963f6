"""Hand-computed unit checks for the operators (FIXTURES.md §A5 edge rows)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import columns as C
from tabforge.operators import history, metrics, prep, profile, sample, select, tune
from tabforge.operators.encode import CategoryEncoder
from tabforge.operators.quantiles import median_map


@pytest.fixture(scope="module")
def gappy(spark):
    # NULL and NaN in one column, an all-missing column, a constant column,
    # a category only in val, a gap only in val.
    rows = [
        (1, 1.0, None, 5.0, "a", 10.0, 0, "train"),
        (2, float("nan"), None, 5.0, "b", 20.0, 0, "train"),
        (3, None, None, 5.0, None, 30.0, 1, "train"),
        (4, 4.0, None, 5.0, "a", 40.0, 0, "train"),
        (5, 2.0, None, 5.0, "c", None, 1, "val"),
        (6, None, None, 5.0, "z", 60.0, 0, "val"),
    ]
    return spark.createDataFrame(rows, "id long, x double, allnull double, const double, cat string, "
                                       "valgap double, y int, split string")


def test_missing_counts_null_and_nan(gappy):
    got = {r["column_name"]: r["n_missing"] for r in profile.missing_counts(gappy).collect()}
    assert got == {"x": 3, "allnull": 6, "cat": 1, "valgap": 1}


def test_label_distribution_and_class_weight(gappy):
    rows = profile.label_distribution(gappy, "y").collect()
    assert [(r["y"], r["n"]) for r in rows] == [(0, 4), (1, 2)]
    cw = profile.class_weight(gappy, "y").first()
    assert (cw["n_neg"], cw["n_pos"], cw["scale_pos_weight"]) == (4, 2, 2.0)


def test_class_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert profile.class_weight(df, "y").first()["scale_pos_weight"] is None


def test_exact_median_even_odd_nan(spark, gappy):
    train = gappy.filter("split = 'train'")
    med = median_map(train, ["x", "allnull", "const", "valgap"])
    assert med["x"] == (2.5, 2)          # {1, 4}; NaN and NULL ignored
    assert med["allnull"] == (None, 0)
    assert med["const"] == (5.0, 4)
    assert med["valgap"] == (25.0, 4)
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4]], "v double")
    assert median_map(df, ["v"])["v"][0] == 2.5   # MLlib's Imputer says 2.0
    hot = spark.createDataFrame([(7.0,)] * 50 + [(1.0,)] * 10 + [(9.0,)] * 10, "v double")
    assert median_map(hot, ["v"], accuracy=10)["v"][0] == 7.0


def test_median_imputer_fits_only_train_gaps(gappy):
    train, val = gappy.filter("split = 'train'"), gappy.filter("split = 'val'")
    m = prep.fit_median_imputer(train, ["x", "allnull", "const", "valgap"])
    assert m.values == {"x": 2.5}        # valgap has no gap in train (quirk Q6), allnull has no median
    out = {r["id"]: r for r in m.transform(val).collect()}
    assert out[6]["x"] == 2.5 and out[5]["valgap"] is None


def test_mean_imputer_drops_all_missing(gappy):
    m = prep.fit_mean_imputer(gappy, ["x", "allnull"])
    assert m.dropped == ["allnull"]
    assert m.values["x"] == pytest.approx((1 + 4 + 2) / 3)


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(float(v), 3.0) for v in [1, 2, 3, 4]], "a double, c double")
    m = prep.fit_standard_scaler(df, ["a", "c"])
    assert m.std["a"] == pytest.approx(math.sqrt(1.25))
    out = m.transform(df).collect()
    assert [r["c"] for r in out] == [0.0] * 4
    assert out[0]["a"] == pytest.approx((1 - 2.5) / math.sqrt(1.25))


def test_missing_plan_order_and_tokens(gappy):
    plan = prep.MissingPlan(exclude=["id", "y", "split"], drop_cols=["allnull"], zero_contains=["const"],
                            sentinel_cols=["valgap"], categorical_cols=["cat"])
    model = plan.fit(gappy.filter("split = 'train'"))
    assert model.dropped == ["allnull"] and model.zero == ["const"] and model.sentinel == ["valgap"]
    assert model.token_cols == ["cat"] and model.medians == {"x": 2.5}
    out = {r["id"]: r for r in model.transform(gappy).collect()}
    assert out[3]["cat"] == "MISSING" and out[5]["valgap"] == 999999.0 and out[2]["x"] == 2.5
    assert "allnull" not in model.transform(gappy).columns


def test_missing_plan_requires_columns(gappy):
    model = prep.MissingPlan(exclude=["id", "y", "split"], sentinel_cols=["valgap"]).fit(gappy)
    with pytest.raises(ValueError):
        model.transform(gappy.drop("valgap"))


def test_category_encoder_unseen_and_order(gappy):
    train, val = gappy.filter("split = 'train'"), gappy.filter("split = 'val'")
    for lookup in ("index", "join"):
        model = CategoryEncoder(["cat"], lookup=lookup).fit(train)
        d = {(r["value"], r["code"]) for r in model.dictionary.collect()}
        assert d == {("a", 0), ("b", 1)}
        enc = {r["id"]: r["cat"] for r in model.transform(gappy).collect()}
        assert enc[1] == 0 and enc[2] == 1 and enc[3] is None and enc[5] is None and enc[6] is None
        unseen = {r["feature"]: r["n_unseen"] for r in model.unseen_counts(val).collect()}
        assert unseen == {"cat": 2}


def test_column_rules(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0, 4.0)],
                               "`買超第1名券商代號` int, `買超第1名均價` double, `季IFRS財報_Z等級` string, "
                               "`買賣力_a` double, `買超第2名張數` double")
    assert C.select_cols(df, suffix="券商代號") == ["買超第1名券商代號"]
    assert C.select_cols(df, contains_any=["買賣力"]) == ["買賣力_a"]
    assert C.select_cols(df, contains_any=["買超第", "賣超第"], not_suffix=["券商代號", "均價"]) == ["買超第2名張數"]
    assert C.present(df, ["買賣力_a", "nope", "買賣力_a"]) == ["買賣力_a"]
    assert C.numeric_cols(df) == ["買超第1名券商代號", "買超第1名均價", "買賣力_a", "買超第2名張數"]
    with pytest.raises(ValueError):
        C.check_required(df, ["missing"])


def test_split_is_exact_disjoint_and_complete(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "k")
    train, val = sample.split_exact(df, "k", 0.8, 42)
    t = {r["k"] for r in train.collect()}
    v = {r["k"] for r in val.collect()}
    assert len(t) == round(0.8 * 1001) and not (t & v) and len(t | v) == 1001
    # same rows as the full-sort definition
    rows = df.select("k", F.md5(F.concat(F.lit("42:"), F.col("k").cast("string"))).alias("h")).collect()
    first = {r["k"] for r in sorted(rows, key=lambda r: (r["h"], r["k"]))[:801]}
    assert t == first


def test_stratified_and_downsample(spark):
    df = spark.createDataFrame([(i, 1 if i % 10 == 0 else 0) for i in range(200)], "k long, y int")
    half = sample.stratified_fraction(df, "y", "k", 0.5).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in half} == {0: 90, 1: 10}
    bal = sample.downsample_majority(df, "y", "k").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in bal} == {0: 20, 1: 20}


def test_single_class_split(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)], "k long, y int")
    bal = sample.downsample_majority(df, "y", "k")
    assert bal.count() == 0


def test_metrics_hand_computed(spark):
    # y, p: ties across classes at 0.5
    rows = [(1, 0.9), (0, 0.8), (1, 0.5), (0, 0.5), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, p double")
    pa = metrics.pr_auc(df, "y", "p").first()["pr_auc"]
    # points: (r=1/3, p=1), (1/3, 1/2), (2/3, 1/2), (1, 3/5), (1, 1/2); anchor (0, 1)
    want = (1 / 3) * (1 + 1) / 2 + 0 + (1 / 3) * (0.5 + 0.5) / 2 + (1 / 3) * (0.5 + 0.6) / 2 + 0
    assert pa == pytest.approx(want)
    ra = metrics.roc_auc(df, "y", "p").first()["roc_auc"]
    # Mann-Whitney with ties as 1/2
    pos, neg = [0.9, 0.5, 0.2], [0.8, 0.5, 0.1]
    mw = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / 9
    assert ra == pytest.approx(mw)
    one = spark.createDataFrame([(0, 0.3), (0, 0.4)], "y int, p double")
    assert metrics.roc_auc(one, "y", "p").first()["roc_auc"] is None
    scored = df.withColumn("pred", metrics.threshold("p", 0.5))   # strict >
    m = metrics.binary_metrics(scored, "y", "pred").first()
    assert (m["precision"], m["recall"]) == (pytest.approx(0.5), pytest.approx(1 / 3))
    cm = {(r["y"], r["pred"]): r["n"] for r in metrics.confusion_matrix(scored, "y", "pred").collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 2, (1, 1): 1}
    ll = metrics.log_loss(df, "y", "p").first()["log_loss"]
    ys, ps = [r[0] for r in rows], [r[1] for r in rows]
    assert ll == pytest.approx(-np.mean([y * math.log(p) + (1 - y) * math.log(1 - p) for y, p in zip(ys, ps)]))


def test_precision_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, pred int")
    m = metrics.binary_metrics(df, "y", "pred").first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_cumulative_selection_floor_cap_and_dominant(spark):
    imp = spark.createDataFrame([("a", 0.995)] + [(f"f{i:02d}", 0.005 / 60) for i in range(60)],
                                "feature string, importance double")
    sel = select.cumulative_selection(imp, 0.99, min_features=50, max_features=2000)
    chosen = select.selected_names(sel)
    assert len(chosen) == 50 and chosen[0] == "a"   # one feature crosses the cut: floor applies
    few = spark.createDataFrame([(f"g{i}", float(10 - i)) for i in range(10)], "feature string, importance double")
    assert len(select.selected_names(select.cumulative_selection(few, 0.5, 50, 2000))) == 10
    cap = select.cumulative_selection(few, 0.99, min_features=1, max_features=3)
    assert select.selected_names(cap) == ["g0", "g1", "g2"]


def test_early_stopping_patience_edges(spark):
    vals = [0.1, 0.3, 0.2, 0.3, 0.25, 0.29, 0.31, 0.1]
    h = spark.createDataFrame(list(enumerate(vals)), "round int, value double")
    r = history.early_stopping(h, patience=3).first()
    # equal value (0.3 at round 3) is not an improvement; stop at 1 + 3 = 4
    assert (r["best_round"], r["stop_round"]) == (1, 4)
    r = history.early_stopping(h, patience=10).first()
    assert (r["best_round"], r["stop_round"], r["n_rounds"]) == (6, 7, 8)
    r = history.early_stopping(h, patience=2, maximize=False).first()
    assert r["best_round"] == 0 and r["stop_round"] == 2


def test_trial_params_deterministic_and_in_range():
    a = [tune.suggest(tune.XGB_SPACE, t, 42) for t in range(30)]
    b = [tune.suggest(tune.XGB_SPACE, t, 42) for t in range(30)]
    assert a == b
    for p in a:
        assert 1e-3 <= p["learning_rate"] <= 0.2 and 3 <= p["max_depth"] <= 10
        assert 0.5 <= p["subsample"] <= 1.0 and 1e-8 <= p["reg_alpha"] <= 10.0


def test_threshold_sweep_best_first_wins(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.6), (0, 0.4)], "y int, p double")
    t = tune.threshold_sweep(df, "y", "p", [0.2, 0.3, 0.7])
    best = tune.best_trial(t, "f1").first()
    assert best["trial"] == 0 and best["f1"] == pytest.approx(0.8)   # tie with trial 1: first wins


def test_round_report_only_touches_floats(spark):
    from tabforge.sources.sinks import round_report
    df = spark.createDataFrame([("a", 3, 0.123456, 2.00005)], "name string, n int, x double, y double")
    r = round_report(df).first()
    assert (r["name"], r["n"], r["x"], r["y"]) == ("a", 3, 0.1235, 2.0001)


def test_grouped_ordinal_spans_partitions(spark):
    from tabforge.operators.running import grouped_ordinal
    rows = [("a", f"v{i:04d}") for i in range(1000)] + [("b", "x"), ("b", "m"), ("c", "z")]
    df = spark.createDataFrame(rows, "feature string, value string")
    got = {(r["feature"], r["value"]): r["code"] for r in grouped_ordinal(df, "feature", "value", 8).collect()}
    want = {}
    for g in ("a", "b", "c"):
        for i, v in enumerate(sorted(v for f, v in rows if f == g)):
            want[(g, v)] = i
    assert got == want


def test_exact_median_band_narrowing(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    a = rng.normal(size=3001).round(2)                 # odd n, many ties
    b = np.concatenate([np.full(1500, 4.0), rng.uniform(0, 10, 1701)])   # a hot value
    rows = [(float(x), float(y)) for x, y in zip(a, b[:3001])]
    df = spark.createDataFrame(rows, "a double, b double")
    for limit, acc in ((40, 50), (200, 1000)):
        med = median_map(df, ["a", "b"], accuracy=acc, band_limit=limit)
        assert med["a"] == (float(np.median(a)), 3001)
        assert med["b"] == (float(np.median(b[:3001])), 3001)
