"""Lifetime value model: features, exact split, forest, metrics, run record.

The order count times the average order value is the target itself. The warehouse
has always trained on these features, so the leak is kept; read the scores as such.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.operators.hashing import key_hash, nth_by_hash, up_to
from marketmill.sources.tables import Warehouse

# Target and forest settings.
TARGET = "lifetime_value"
TREES = 100
DEPTH = 5
SEED = 42

RUN_SCHEMA = (
    "run_id string, experiment string, params map<string,string>, "
    "metrics map<string,double>, finished_at timestamp"
)


@dataclass(frozen=True)
class Experiment:
    name: str
    model_name: str
    key: str
    features: tuple[str, ...]
    test_rows: Callable[[int], int]


# The two experiments. The first holds out a whole number of rows and at
# least one; the second rounds a fifth of the rows up.
CUSTOMERS = Experiment(
    name="lifetime_value_prediction",
    model_name="lifetime_value_model",
    key="customer_id",
    features=("total_orders", "avg_order_value", "completed_orders", "cancelled_orders"),
    test_rows=lambda rows: max(1, int(rows * 0.2)),
)
MARKETPLACE = Experiment(
    name="olist_lifetime_value_prediction",
    model_name="olist_lifetime_value_model",
    key="customer_unique_id",
    features=("total_orders", "avg_order_value", "delivered_orders", "cancelled_orders"),
    test_rows=lambda rows: math.ceil(rows * 0.2),
)


def training_rows(mart: DataFrame, experiment: Experiment) -> DataFrame:
    """Key, features and target as doubles; no other column of the mart is read."""
    return mart.select(
        experiment.key,
        *(F.col(name).cast("double").alias(name) for name in (*experiment.features, TARGET)),
    )


def with_features(rows: DataFrame, experiment: Experiment) -> DataFrame:
    return VectorAssembler(inputCols=list(experiment.features), outputCol="features").transform(
        rows
    )


def split(rows: DataFrame, experiment: Experiment, seed: int = SEED) -> DataFrame:
    """Adds `is_test`, true for exactly the wanted number of rows.

    Test rows come first in the order of a seeded hash of the key, so a row's side
    depends on the data alone and not on how it is partitioned or recomputed.
    """
    hashed = key_hash([experiment.key], salt=str(seed))
    wanted = experiment.test_rows(rows.select(F.count(F.lit(1))).first()[0])
    last = nth_by_hash(rows, hashed, experiment.key, wanted)
    return rows.withColumn("is_test", up_to(hashed, experiment.key, last))


def fit(train: DataFrame, seed: int = SEED) -> RandomForestRegressionModel:
    """Forest over `features`; every split looks at all of them."""
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=TARGET,
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=seed,
        featureSubsetStrategy="all",
    )
    return forest.fit(train)


def scores(predicted: DataFrame) -> DataFrame:
    """(mae, r2, rows) in one pass over the predictions.

    R² needs the spread of the target around its mean; one test row has none, which
    leaves it NULL.
    """
    error = F.col(TARGET) - F.col("prediction")
    spread = F.var_pop(TARGET) * F.count(TARGET)
    return predicted.agg(
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
        F.count(F.lit(1)).alias("rows"),
    )


@dataclass(frozen=True)
class Run:
    run_id: str
    model: RandomForestRegressionModel
    predictions: DataFrame
    metrics: dict[str, float]


def train(mart: DataFrame, experiment: Experiment, seed: int = SEED) -> Run:
    """Fit on the training side, score the test side."""
    rows = with_features(
        split(training_rows(mart, experiment), experiment, seed), experiment
    )
    training, test = rows.where(~F.col("is_test")), rows.where("is_test")
    model = fit(training, seed)
    predictions = model.transform(test)
    found = scores(predictions).first()
    metrics = {
        "mae": found["mae"],
        "r2": found["r2"],
        "train_rows": float(training.select(F.count(F.lit(1))).first()[0]),
        "test_rows": float(found["rows"]),
    }
    return Run(uuid.uuid4().hex, model, predictions, metrics)


def run_record(
    warehouse: Warehouse, run: Run, experiment: Experiment, finished_at: datetime
) -> DataFrame:
    """The one-row record of a run."""
    params = {
        "n_estimators": str(TREES),
        "max_depth": str(DEPTH),
        "random_state": str(SEED),
        "features": ",".join(experiment.features),
    }
    row = (run.run_id, experiment.name, params, run.metrics, finished_at)
    return warehouse.spark.createDataFrame([row], RUN_SCHEMA)


def model_path(warehouse: Warehouse, experiment: Experiment, run_id: str) -> str:
    return f"{warehouse.root}/models/{experiment.model_name}/{run_id}"


def train_and_record(
    warehouse: Warehouse, mart: DataFrame, experiment: Experiment, finished_at: datetime
) -> Run:
    """Train, store the model under its run id and append the run to `ml_runs`."""
    run = train(mart, experiment)
    run.model.write().overwrite().save(model_path(warehouse, experiment, run.run_id))
    warehouse.append(run_record(warehouse, run, experiment, finished_at), "ml", "ml_runs")
    return run
