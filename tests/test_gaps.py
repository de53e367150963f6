"""Nothing is lost in silence: gaps, odd names, many groups, wide tables, rejects."""

import time

import pytest
from pyspark.sql import functions as F

from tabforge.operators import hist, learn, metrics, prep, profile, sample, tune
from tabforge.operators.encode import CategoryEncoder
from tabforge.operators.reduce import PCAPathModel, fit_pca_path
from tabforge.plans import jobs
from tabforge.sources import sinks, tables


def test_a_null_key_stops_the_sampler(spark):
    df = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "k long")
    with pytest.raises(Exception, match="NULL in sampling key"):
        train, _ = sample.split_exact(df, "k")
        train.collect()


def test_split_plan_is_one_filter(spark, tmp_path):
    spark.range(500).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    train, val = sample.split_exact(spark.read.parquet(str(tmp_path / "t")), "k")
    for part in (train, val):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Window" not in plan and "Union" not in plan and "Join" not in plan
    assert train.count() == 400 and val.count() == 100


def test_many_groups_and_exact_totals(spark):
    df = spark.range(4500).select(F.col("id").alias("k"), (F.col("id") % 1500).alias("g"))
    assert sample.stratified_fraction(df, "g", "k", 0.5).count() == 2250
    small = spark.createDataFrame([(i, int(i < 3)) for i in range(10)], "k long, y int")
    assert sample.stratified_fraction(small, "y", "k", 0.5).count() == 5
    nulls = spark.createDataFrame([(i, None if i < 4 else 1) for i in range(8)], "k long, y int")
    assert sample.stratified_fraction(nulls, "y", "k", 0.5).count() == 4


def test_one_rule_for_gaps_in_metrics(spark):
    nan = float("nan")
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (None, 0.95), (1, None), (0, nan)]
    df = spark.createDataFrame(rows, "y int, s double")
    whole = df.filter("y is not null and s is not null and not isnan(s)")
    for f in (metrics.roc_auc, metrics.pr_auc, metrics.log_loss, metrics.curve_metrics):
        assert f(df, "y", "s").first() == f(whole, "y", "s").first()
    assert metrics.roc_auc(df, "y", "s").first()[0] == 0.75
    assert tuple(metrics.left_out(df, "y", "s").first()) == (7, 1, 2)
    end = [r for r in metrics.pr_curve(df, "y", "s").collect() if r["threshold"] is None]
    assert [(r["precision"], r["recall"]) for r in end] == [(1.0, 0.0)]


def test_a_value_that_misses_the_schema_is_rejected_or_stops(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    (tmp_path / "in.csv").write_text("x,y\n" + "\n".join(f"{i},a" for i in range(3000)) + "\n1.5,b\n")
    assert spark.read.csv(path).count() == 3002
    df = tables.read_csv(spark, path)
    assert df.schema["x"].dataType.simpleString() == "double" and df.filter("x is null").count() == 0
    pinned = spark.createDataFrame([], "x int, y string").schema
    with pytest.raises(Exception):
        tables.read_csv(spark, path, pinned).filter("x > 5").collect()
    out = str(tmp_path / "out")
    (tmp_path / "bad.csv").write_text("k,label,v\n" + "\n".join(f"{i},{i % 2},{i}" for i in range(100)))
    labels, counts = jobs.ingest_csv(spark, str(tmp_path / "bad.csv"), out, "label", "k")
    assert {r["label"]: r["n"] for r in labels.collect()} == {0: 50, 1: 50}
    assert [tuple(r) for r in counts.collect()] == [("labelled", 100, 0)]
    assert tables.read_split(spark, out + "/train.parquet").count() == 80
    assert tables.read_split(spark, out + "/nothing", required=False) is None
    with pytest.raises(FileNotFoundError):
        tables.read_split(spark, out + "/nothing")


def test_unsupported_parameters_stop(spark):
    with pytest.raises(ValueError):
        learn.gbt_params({"reg_lambda": 1.0})
    with pytest.raises(ValueError):
        learn.gbt_params({"gamma": 0.5})
    assert not set(tune.GBT_SPACE) & {"gamma", "reg_alpha", "reg_lambda"}


def test_more_categories_than_bins_train(spark):
    df = spark.createDataFrame([(i, i % 41 if i % 50 else None, int(i % 41 < 9)) for i in range(800)], "id long, c int, y int")
    ready = learn.assemble(df, [], {"c": 41})
    model = learn.fit_gbt(ready, "y", params={"n_estimators": 2, "max_depth": 2})
    assert model.transform(ready).filter("prediction = y").count() > 600


def test_odd_names_and_quotes(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0)], "id long, `a.b` string, `it's` double")
    model = CategoryEncoder(["a.b"]).fit(df)
    assert {r["id"]: r["a.b"] for r in model.transform(df).collect()} == {1: 0, 2: 1, 3: None}
    assert {r["feature"]: r["n_unseen"] for r in model.unseen_counts(df).collect()} == {"a.b": 0}
    assert {r["column_name"]: r["n_missing"] for r in profile.missing_counts(df).collect()} == {"a.b": 1, "it's": 1}
    assert prep.fit_median_imputer(df, ["it's"]).values == {"it's": 2.0}


def test_a_column_without_values_is_named(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert prep.fit_median_imputer(df, ["v"]).unfilled == ["v"]


def test_two_thousand_columns(spark):
    width = 2000
    df = spark.range(200).select("id", *[(F.when(F.col("id") % 7 != j % 7, F.rand(j))).alias(f"c{j}") for j in range(width)])
    df = df.checkpoint(eager=True)
    cols = [f"c{j}" for j in range(width)]
    began = time.time()
    counts = profile.missing_counts(df, cols).collect()
    assert len(counts) == width and time.time() - began < 60
    began = time.time()
    assert len(prep.fit_mean_imputer(df, cols).values) == width and time.time() - began < 60
    began = time.time()
    assert len(prep.fit_median_imputer(df, cols, only_missing=False).values) == width and time.time() - began < 60
    began = time.time()
    cuts = hist.fit_bins(df, cols, 8)
    bins = hist.apply_bins(df, cols, cuts, ["id"]).select(F.size("bins")).distinct().collect()
    assert bins[0][0] == width and time.time() - began < 60


def booster_rows(spark):
    rows = [(i, float(i % 9), None, 5.0, int(i % 9 < 3)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, a double, gone double, same double, y int")


def test_missing_and_constant_columns_train(spark, tmp_path):
    df = booster_rows(spark)
    p = hist.HistParams(n_rounds=3, max_depth=2, max_bins=8)
    model = hist.fit_hist(df, ["a", "gone", "same"], "y", "id", params=p)
    scored = model.predict_proba(df, ["id", "y"])
    assert metrics.roc_auc(scored, "y", "p").first()[0] == 1.0
    model.save(spark, str(tmp_path / "m"))
    again = hist.HistModel.load(spark, str(tmp_path / "m")).predict_proba(df, ["id", "y"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))
    alone = hist.fit_hist(df, ["gone"], "y", "id", params=hist.HistParams(n_rounds=1, max_depth=2))
    assert alone.trees[0].leaves  # the root is a leaf, not a tree that adds nothing


def test_weight_sweep_takes_the_best_f1(spark):
    rows = [(i, [float(i % 10), float(i % 3)], int(i % 10 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int")
    from pyspark.ml.functions import array_to_vector
    df = df.select("id", array_to_vector("x").alias("features"), "y")
    table, best, model = tune.weight_sweep(df, df, "y", "id", [1.0, 9.0], 0.5, {"n_estimators": 2, "max_depth": 2}, patience=2)
    got = {r["weight"]: r["f1"] for r in table.collect()}
    assert set(got) == {1.0, 9.0} and got[best] == max(got.values()) and "roc_auc" in table.columns
    assert model.n_trees_used >= 1


def test_pca_is_stored(spark, tmp_path):
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(40)], "id long, x array<double>")
    df = df.select("id", array_to_vector("x").alias("v"))
    model = fit_pca_path(df, "v", 2)
    model.save(spark, str(tmp_path / "pca"))
    again = PCAPathModel.load(spark, str(tmp_path / "pca"))
    assert np.allclose(again.components, model.components) and np.allclose(again.mean, model.mean)


def test_submission_is_one_file_with_one_mark(spark, tmp_path):
    df = spark.range(40).repartition(4).select(F.col("id").alias("ID"), F.lit(1).alias("y"))
    sinks.write_submission_csv(df, str(tmp_path / "s"))
    parts = list((tmp_path / "s").glob("part-*.csv"))
    raw = parts[0].read_bytes()
    assert len(parts) == 1 and raw.startswith(b"\xef\xbb\xbfID,y\n") and raw.count(b"\xef\xbb\xbf") == 1
    assert len(raw.splitlines()) == 41


def test_category_lookup_joins_unless_bounded(spark, monkeypatch):
    from tabforge.operators import encode
    from tabforge.plans.jobs import TrainConfig
    df = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "id long, c string")
    monkeypatch.setattr(encode, "INDEX_VALUES", 4)
    assert encode.CategoryEncoder(["c"]).lookup == TrainConfig(label="y", key="id").lookup == "join"
    coded = encode.CategoryEncoder(["c"]).fit(df).transform(df)
    assert sorted((r["id"], r["c"]) for r in coded.collect()) == [(i, i) for i in range(5)]
    with pytest.raises(ValueError):
        encode.CategoryEncoder(["c"], lookup="index").fit(df).transform(df)


def test_six_hundred_category_columns(spark, monkeypatch):
    from tabforge.operators import encode
    width = 600
    df = spark.range(400).select("id", *[
        F.when(F.col("id") % 11 != j % 11, F.concat(F.lit("v"), (F.xxhash64("id", F.lit(j)) % 4).cast("string"))).alias(f"c{j}")
        for j in range(width)]).checkpoint(eager=True)
    cols = [f"c{j}" for j in range(width)]
    began = time.time()
    model = CategoryEncoder(cols).fit(df.filter("id < 350"))
    coded = model.transform(df)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: r for r in coded.collect()}
    assert time.time() - began < 60 and "Join" not in plan
    for r in df.filter("id % 37 = 0").collect():
        for j in (0, 7, 599):
            values = sorted(set(x[0] for x in df.filter("id < 350").select(f"c{j}").collect()) - {None})
            assert got[r["id"]][f"c{j}"] == (values.index(r[f"c{j}"]) if r[f"c{j}"] in values else None)
    # The same codes where a column passes a bound and is joined; nulls, unseen and hot values included.
    rows = [(i, "hot" if i % 3 else f"x{i}", f"v{i % 3}" if i % 5 else None) for i in range(900)]
    few = spark.createDataFrame(rows, "id long, many string, few string")
    together = CategoryEncoder(["many", "few"]).fit(few.filter("id < 800"))
    expected = sorted(map(tuple, together.transform(few).collect()), key=lambda r: r[0])
    monkeypatch.setattr(encode, "INDEX_VALUES", 100)
    joined = CategoryEncoder(["many", "few"]).fit(few.filter("id < 800"))
    assert set(joined.small()) == {"few"}
    assert sorted(map(tuple, joined.transform(few).collect()), key=lambda r: r[0]) == expected
