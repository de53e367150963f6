"""The training job's steps as ``pyspark.ml`` stages: one saved ``PipelineModel`` scores in any session
(SCO1, SNK6, FEA2, FEA9, FEA13).

    model = Pipeline(stages=[PlanStage(plan), CategoryStage(cols), SelectStage(features), BoosterStage(...)]).fit(train)
    model.write().overwrite().save(path)
    PipelineModel.load(path).transform(test)     # adds the probability ``p``

A fitted stage is its class, a JSON state and, where its size follows the data (the category dictionary), a
Parquet table, all in the folder that ``pyspark.ml`` gives it.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import hist, learn
from ..operators.encode import CategoryEncoder, CategoryEncoderModel
from ..operators.prep import MissingPlan, MissingPlanModel


class _Writer(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sc)
        spark = self.sparkSession
        text = json.dumps(self.stage.state(), ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/state")
        self.stage.save_tables(spark, path)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        state = json.loads(self.sparkSession.read.text(f"{path}/state").first()["value"])
        stage = self.cls.restore(state, self.sparkSession, path)
        stage._resetUid(metadata["uid"])
        return stage


class Stored(MLWritable, MLReadable):
    """A stage that is saved as a JSON state and tables."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def save_tables(self, spark: SparkSession, path: str) -> None:
        """Nothing beside the state."""


class PlanStage(Estimator):
    """FEA2: the missing-value plan."""

    def __init__(self, plan: MissingPlan):
        super().__init__()
        self.plan = plan

    def _fit(self, dataset: DataFrame) -> PlanModelStage:
        return PlanModelStage(self.plan.fit(dataset))


class PlanModelStage(Model, Stored):
    def __init__(self, fitted: MissingPlanModel):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset)

    def state(self) -> dict:
        return asdict(self.fitted)

    @classmethod
    def restore(cls, state: dict, spark: SparkSession, path: str) -> PlanModelStage:
        return cls(MissingPlanModel(**state))


class CategoryStage(Estimator):
    """FEA9: the train dictionary; columns that a table does not have are left out."""

    def __init__(self, cols: list[str], lookup: str = "join"):
        super().__init__()
        self.cols, self.lookup = cols, lookup

    def _fit(self, dataset: DataFrame) -> CategoryModelStage:
        return CategoryModelStage(CategoryEncoder(C.present(dataset, self.cols), self.lookup).fit(dataset))


class CategoryModelStage(Model, Stored):
    def __init__(self, fitted: CategoryEncoderModel):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset) if self.fitted.cols else dataset

    def state(self) -> dict:
        return {"cols": self.fitted.cols, "lookup": self.fitted.lookup}

    def save_tables(self, spark: SparkSession, path: str) -> None:
        if self.fitted.cols:
            self.fitted.dictionary.write.parquet(f"{path}/dictionary")

    @classmethod
    def restore(cls, state: dict, spark: SparkSession, path: str) -> CategoryModelStage:
        dictionary = spark.read.parquet(f"{path}/dictionary") if state["cols"] else None
        return cls(CategoryEncoderModel(cols=state["cols"], dictionary=dictionary, lookup=state["lookup"]))


class SelectStage(Transformer, Stored):
    """FEA13: the chosen features, which a table must have (CHK2), beside its other columns."""

    def __init__(self, features: list[str], among: list[str]):
        super().__init__()
        self.features, self.among = features, among

    def _transform(self, dataset: DataFrame) -> DataFrame:
        C.check_required(dataset, self.features, "input of the feature selection")
        dropped = set(self.among) - set(self.features)
        return C.project(dataset, [c for c in dataset.columns if c not in dropped])

    def state(self) -> dict:
        return {"features": self.features, "among": self.among}

    @classmethod
    def restore(cls, state: dict, spark: SparkSession, path: str) -> SelectStage:
        return cls(state["features"], state["among"])


class BoosterStage(Estimator):
    """LRN2: the histogram booster on columns; early stopping on ``val`` if given, which has to be prepared like the
    rows that reach this stage."""

    def __init__(self, cols: list[str], label: str, key: str, params: hist.HistParams, weight: str | None = None,
                 categorical: list[str] | None = None, val: DataFrame | None = None):
        super().__init__()
        self.args = (cols, label, key, weight, params, val, categorical)

    def _fit(self, dataset: DataFrame) -> BoosterModelStage:
        return BoosterModelStage(hist.fit_hist(dataset, *self.args))


class BoosterModelStage(Model, Stored):
    """Adds the probability ``p``."""

    def __init__(self, fitted: hist.HistModel):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.predict_proba(dataset, [f"`{c}`" for c in dataset.columns])

    def state(self) -> dict:
        return self.fitted.to_dict()

    @classmethod
    def restore(cls, state: dict, spark: SparkSession, path: str) -> BoosterModelStage:
        return cls(hist.HistModel.from_dict(state))


class TreesModelStage(Model, Stored):
    """MLlib trees scored up to their best iteration; adds the probability ``p``."""

    def __init__(self, fitted: learn.BoostedModel, numeric: list[str], cards: dict):
        super().__init__()
        self.fitted, self.numeric, self.cards = fitted, numeric, cards

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ready = learn.assemble(dataset, self.numeric, self.cards, out="_features")
        model = self.fitted.model.copy()
        model.setFeaturesCol("_features")
        return learn.final_scores(ready, model, self.fitted.leaves, [f"`{c}`" for c in dataset.columns],
                                  self.fitted.n_trees_used, "_features")

    def state(self) -> dict:
        return {"leaves": self.fitted.leaves.values.tolist(), "best_iteration": self.fitted.best_iteration,
                "numeric": self.numeric, "cards": self.cards}

    def save_tables(self, spark: SparkSession, path: str) -> None:
        self.fitted.model.write().save(f"{path}/trees")

    @classmethod
    def restore(cls, state: dict, spark: SparkSession, path: str) -> TreesModelStage:
        import numpy as np

        leaves = learn.LeafTable(np.array(state["leaves"]))
        fitted = learn.BoostedModel(GBTClassificationModel.load(f"{path}/trees"), leaves, state["best_iteration"])
        return cls(fitted, state["numeric"], state["cards"])


def scorer(stages: list) -> PipelineModel:
    """Fitted stages as one model."""
    return PipelineModel([s for s in stages if s is not None])


def submission(model: PipelineModel, df: DataFrame, key: str, label: str, threshold: float) -> DataFrame:
    """SCO1: ``(key, label)`` with the decision at ``threshold`` (strictly above)."""
    return model.transform(df).select(key, (F.col("p") > threshold).cast("int").alias(label))
