"""Exact split, forest, metrics and run records."""

from __future__ import annotations

import hashlib
import math
from datetime import datetime

import pytest
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from marketmill.operators import hashing
from marketmill.plans import training
from tests.plans import plan


def mart(spark, rows, key="customer_id"):
    return spark.range(rows).selectExpr(
        f"id AS {key}",
        "id % 7 + 1 AS total_orders",
        "CAST(id % 50 AS double) AS avg_order_value",
        "id % 3 AS completed_orders",
        "id % 3 AS delivered_orders",
        "id % 2 AS cancelled_orders",
        "CAST((id % 7 + 1) * (id % 50) AS decimal(20,2)) AS lifetime_value",
        "'unused' AS note",
    )


def hash_of(key):
    return hashlib.md5(f"{key}|42".encode()).hexdigest()


@pytest.mark.parametrize("rows", [1, 3, 10, 997])
def test_split_size(spark, rows):
    for experiment, wanted in (
        (training.CUSTOMERS, max(1, int(rows * 0.2))),
        (training.MARKETPLACE, math.ceil(rows * 0.2)),
    ):
        df = training.training_rows(mart(spark, rows, experiment.key), experiment)
        sides = training.split(df, experiment)
        test = {r[0] for r in sides.where("is_test").select(experiment.key).collect()}
        assert test == set(sorted(range(rows), key=hash_of)[:wanted])


def test_split_does_not_depend_on_partitions(spark):
    df = training.training_rows(mart(spark, 500), training.CUSTOMERS)

    def test_side(rows):
        return {r[0] for r in training.split(rows, training.CUSTOMERS).where("is_test").collect()}

    assert test_side(df.repartition(7)) == test_side(df.coalesce(1))


def test_place_is_found_through_several_passes(spark, monkeypatch):
    monkeypatch.setattr(hashing, "HEX_STEP", 1)
    monkeypatch.setattr(hashing, "SMALL_BUCKET", 2)
    df = spark.range(3000).withColumnRenamed("id", "k")
    ordered = sorted(range(3000), key=hash_of)
    hashed = hashing.key_hash(["k"], salt="42")
    for n in (1, 2, 1500, 2999, 3000):
        assert hashing.nth_by_hash(df, hashed, "k", n) == (hash_of(ordered[n - 1]), ordered[n - 1])
    assert hashing.nth_by_hash(df, hashed, "k", 0) is None
    with pytest.raises(ValueError):
        hashing.nth_by_hash(df, hashed, "k", 3001)


def test_split_needs_no_shuffle(spark, tmp_path):
    mart(spark, 100).write.parquet(str(tmp_path / "mart"))
    df = training.training_rows(spark.read.parquet(str(tmp_path / "mart")), training.CUSTOMERS)
    text = plan(training.split(df, training.CUSTOMERS))
    assert "Exchange" not in text
    assert "note" not in text


def test_train_and_record(spark, warehouse):
    at = datetime(2024, 6, 1)
    df = mart(spark, 300)
    runs = [training.train_and_record(warehouse, df, training.CUSTOMERS, at) for _ in range(2)]
    first = runs[0]
    assert first.metrics == runs[1].metrics  # same data, same seed
    assert first.metrics["train_rows"] == 240 and first.metrics["test_rows"] == 60
    assert first.model.getNumTrees == 100 and first.model.getOrDefault("maxDepth") == 5
    assert first.model.getOrDefault("featureSubsetStrategy") == "all"

    table = warehouse.read("ml", "ml_runs")
    recorded = {r["run_id"]: r for r in table.collect()}
    assert set(recorded) == {run.run_id for run in runs}
    row = recorded[first.run_id]
    assert row["experiment"] == "lifetime_value_prediction"
    assert row["params"] == {
        "n_estimators": "100",
        "max_depth": "5",
        "random_state": "42",
        "features": "total_orders,avg_order_value,completed_orders,cancelled_orders",
    }
    assert row["metrics"] == first.metrics

    path = training.model_path(warehouse, training.CUSTOMERS, first.run_id)
    again = RandomForestRegressionModel.load(path).transform(
        first.predictions.drop("prediction")
    )
    assert sorted(again.select("customer_id", "prediction").collect()) == sorted(
        first.predictions.select("customer_id", "prediction").collect()
    )


def test_metrics_by_hand(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (3.0, 3.0), (8.0, 5.0)], "lifetime_value double, prediction double"
    )
    found = training.scores(df).first()
    spread = sum((y - 4) ** 2 for y in (1, 3, 8))
    assert found["mae"] == pytest.approx(4 / 3)
    assert found["r2"] == pytest.approx(1 - 10 / spread)
    assert found["rows"] == 3
    assert training.scores(df.limit(1)).first()["r2"] is None


def test_ten_rows_train(spark):
    run = training.train(mart(spark, 10), training.CUSTOMERS)
    assert run.metrics["test_rows"] == 2 and math.isfinite(run.metrics["mae"])
    assert run.predictions.where(F.col("prediction").isNull()).count() == 0
