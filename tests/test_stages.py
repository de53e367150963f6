"""A stored pipeline scores in another session like in the one that fitted it."""

import json
import os
import subprocess
import sys

import pytest

from tabforge.operators import sample
from tabforge.operators.prep import MissingPlan
from tabforge.plans import fixtures, jobs, stages

from .conftest import SF_SMALL

OTHER = """
import json, sys
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from tabforge.plans import stages
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
found = {}
for name in sys.argv[2:]:
    model = PipelineModel.load(f"{sys.argv[1]}/{name}/pipeline")
    rows = stages.submission(model, spark.read.parquet(f"{sys.argv[1]}/test"), "id", "label", 0.4).collect()
    scored = model.transform(spark.read.parquet(f"{sys.argv[1]}/test")).select("id", "p").collect()
    found[name] = [sorted(map(list, rows)), sorted(map(list, scored))]
print("FOUND" + json.dumps(found))
"""


@pytest.mark.parametrize("backends", [("hist", "mllib")])
def test_a_stored_pipeline_scores_alike_in_another_session(spark, tmp_path, backends):
    orders = fixtures.order_features(spark, SF_SMALL).checkpoint(eager=True)
    labelled, test = sample.split_exact(orders, "id", 0.8)
    train, val = sample.split_exact(labelled, "id", 0.8)
    test = test.drop("label")
    test.write.parquet(str(tmp_path / "test"))
    want = {}
    for backend in backends:
        cfg = jobs.TrainConfig(
            label="label", key="id", backend=backend, categorical=["status", "priority"], min_features=3, patience=2, threshold=0.4,
            plan=MissingPlan(exclude=["id", "label"], zero_contains=["discount"], sentinel_cols=["max_tax"],
                             categorical_cols=["status", "priority"]),
            importance_params={"n_estimators": 2, "max_depth": 2}, params={"n_estimators": 3, "max_depth": 2})
        out = jobs.train_select_tune(spark, cfg, train, val, test, out_dir=str(tmp_path / backend))
        scored = out["pipeline"].transform(test).select("id", "p").collect()
        want[backend] = [sorted(map(list, out["submission"].collect())), sorted(map(list, scored))]
        here = stages.submission(out["pipeline"], test, "id", "label", 0.4).collect()
        assert sorted(map(list, here)) == want[backend][0]
    env = dict(os.environ, PYTHONPATH=os.pathsep.join([os.getcwd(), *sys.path]))
    done = subprocess.run([sys.executable, "-c", OTHER, str(tmp_path), *backends], capture_output=True, text=True, env=env,
                          cwd=str(tmp_path), timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    got = json.loads(next(line for line in done.stdout.splitlines() if line.startswith("FOUND"))[5:])
    assert got == want
