"""Boosted regression trees on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.encoding import CODE, SLOTS, code_sums, code_table, season_code
from ..operators.features import features_of
from ..operators.splits import trainable
from ..schemas import KEYS, SeriesModel
from ..session import checkpoint_folder, fresh_path, materialize
from .base import tails
from .recursion import recursive_forecast
from .seriestrees import SeriesBoostedLearner


def _assembler(config: SeriesModel, coded: bool = False) -> VectorAssembler:
    return VectorAssembler(inputCols=[*config.feature_cols, *([CODE] if coded else [])], outputCol="features")


def _regressor(config: SeriesModel) -> GBTRegressor:
    return GBTRegressor(
        labelCol="y",
        featuresCol="features",
        predictionCol="z",
        lossType="squared",
        maxIter=config.trees.n_estimators,
        maxDepth=config.trees.max_depth,
        stepSize=config.trees.learning_rate,
        subsamplingRate=config.trees.subsample,
        featureSubsetStrategy="all" if config.trees.colsample_bytree >= 1 else str(config.trees.colsample_bytree),
        minInstancesPerNode=config.trees.min_child_weight,
        maxBins=64,
        checkpointInterval=10,
        seed=config.trees.seed,
    )


def tree_arrays(model: GBTRegressionModel, spark) -> dict[str, np.ndarray]:
    """A model's trees as padded arrays, read from its saved node table.

    Their size is set by the number and depth of the trees, not by the data.
    """
    path = fresh_path(spark, "trees")
    model.write().save(path)
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            "nodeData.id",
            "nodeData.prediction",
            "nodeData.leftChild",
            "nodeData.rightChild",
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        )
        .toPandas()
    )
    trees, width = int(nodes["treeID"].max()) + 1, int(nodes["id"].max()) + 1
    out = {}
    for name, kind, blank in (
        ("prediction", float, 0.0),
        ("leftChild", int, -1),
        ("rightChild", int, -1),
        ("feature", int, 0),
        ("threshold", float, 0.0),
    ):
        grid = np.full((trees, width), blank, dtype=kind)
        grid[nodes["treeID"], nodes["id"]] = nodes[name].fillna(blank)
        out[name] = grid
    out["weight"] = np.asarray(model.treeWeights)
    return out


def walk(trees: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Weighted sum of the leaves that the rows of ``x`` reach."""
    count = len(trees["weight"])
    tree = np.arange(count)[:, None]
    row = np.arange(len(x))[None, :]
    node = np.zeros((count, len(x)), dtype=int)
    while True:
        left = trees["leftChild"][tree, node]
        inner = left >= 0
        if not inner.any():
            break
        goes_left = x[row, trees["feature"][tree, node]] <= trees["threshold"][tree, node]
        node = np.where(inner, np.where(goes_left, left, trees["rightChild"][tree, node]), node)
    return trees["weight"] @ trees["prediction"][tree, node]


class BoostedLearner:
    """Squared-error boosted trees.

    ``scope="pooled"`` fits one model on the scaled rows of all series, so training is
    spread by rows however many series there are or however long one of them is.  With ``coded`` the
    pooled model also sees what is usual for a row's series and season slot (``season_code``), so
    it can tell series apart.  ``scope="series"`` fits one model per series, all side by side
    (``SeriesBoostedLearner``).
    """

    info_cols = ("train_rows", "n_features")
    splits = True

    def __init__(self, scope: str = "pooled", coded: bool = False):
        if scope not in ("pooled", "series"):
            raise ValueError("scope is either 'pooled' or 'series'")
        if coded and scope == "series":
            raise ValueError("a model of one series needs no code for it")
        self.scope, self.coded = scope, coded
        self._own = SeriesBoostedLearner() if scope == "series" else None

    def trainable(self, config: SeriesModel) -> Column:
        return trainable(config)

    def fit(self, features: DataFrame, config: SeriesModel) -> PipelineModel:
        """One model on all given feature rows."""
        checkpoint_folder(features.sparkSession)
        assembler = _assembler(config, self.coded)
        rows = assembler.transform(features).select("features", "y")
        return PipelineModel([assembler, _regressor(config).fit(rows)])

    def fit_predict(
        self, train: DataFrame, test: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS
    ) -> DataFrame:
        """Test rows with their prediction ``z``."""
        if self._own:
            return self._own.fit_predict(train, test, config, keys)
        if train.isEmpty():
            return test.withColumn("z", F.lit(None).cast("double")).limit(0)
        if self.coded:
            sums = code_sums(train, config, keys)
            train, test = season_code(train, sums, config, keys), season_code(test, sums, config, keys, own_fold=False)
        return self.fit(train, config).transform(test).drop("features", CODE)

    def prepare(self, scaled: DataFrame, config: SeriesModel, keys: Sequence[str] = KEYS) -> DataFrame:
        """Feature rows, written once for all settings that are fitted on them."""
        return materialize(features_of(scaled, config, list(keys)), "features")

    def forecast_stages(
        self, scaled: DataFrame, profile: DataFrame, horizon: int, config: SeriesModel, stages: Sequence[int],
        keys: Sequence[str] = KEYS, features: DataFrame | None = None,
    ) -> tuple[dict[int, DataFrame], DataFrame]:
        """Paths after each number of trees in ``stages``, from one fit of the largest, and training information."""
        keys = list(keys)
        if self._own:
            return self._own.forecast_stages(scaled, profile, horizon, config, stages, keys, features)
        rows = self.prepare(scaled, config, keys) if features is None else features
        states = tails(scaled, config.reach, config, keys)
        info = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).cast("double").alias("train_rows"),
            F.lit(float(len(config.feature_cols) + self.coded)).alias("n_features"),
        )
        if rows.isEmpty():
            nothing = states.select(*keys, F.lit(1).alias("step_no"), F.lit(0.0).alias("z")).limit(0)
            return dict.fromkeys(stages, nothing), info
        if self.coded:
            sums = code_sums(rows, config, keys)
            rows, states = season_code(rows, sums, config, keys), states.join(code_table(sums, config, keys), keys)
        trees = tree_arrays(self.fit(rows, config).stages[-1], rows.sparkSession)
        step = lambda n: _stepper({name: part[:n] for name, part in trees.items()}, config, self.coded)
        return {n: recursive_forecast(states, horizon, config, step(n), keys) for n in stages}, info

    def forecast(
        self,
        scaled: DataFrame,
        profile: DataFrame,
        horizon: int,
        config: SeriesModel,
        keys: Sequence[str] = KEYS,
        features: DataFrame | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        count = config.trees.n_estimators
        paths, info = self.forecast_stages(scaled, profile, horizon, config, [count], keys, features)
        return paths[count], info


def _stepper(trees: dict[str, np.ndarray], config: SeriesModel, coded: bool):
    at = config.feature_cols.index(SLOTS[config.resolution][0]) if coded else 0

    def step(batch: pd.DataFrame, x: np.ndarray) -> np.ndarray:
        if coded:
            codes = np.stack([np.asarray(c, dtype=float) for c in batch[CODE]])
            x = np.column_stack([x, codes[np.arange(len(x)), x[:, at].astype(int)]])
        return walk(trees, x)

    return step
