from __future__ import annotations

import json
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepkit.operators.train import train_model
from prepkit.plans.bounds import shared_dir
from prepkit.sources.tables import read_model


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=600), rng.normal(size=600)
    rows = [(i, float(u), float(v), "pq"[int(v > 0)], float(3 * u - 2 * v + 1), int(u + v > 0), "xyz"[int(u > -0.5) + int(u > 0.5)])
            for i, (u, v) in enumerate(zip(a, b))]
    return spark.createDataFrame(
        rows, "id int, a double, b double, word string, line double, flag int, kind string").cache()


@pytest.mark.parametrize("model,target", [
    ("random_forest", "flag"), ("random_forest", "kind"), ("logistic_regression", "flag"),
    ("logistic_regression", "kind"), ("svm", "flag"), ("svm", "kind"), ("xgboost", "flag"), ("xgboost", "kind"),
])
def test_classifiers_learn(data, model, target):
    done = train_model(data, "classification", target, model, features=["a", "b"], key_cols="id",
                       n_estimators=10, max_depth=4)
    got = done.metrics.first()
    # Separate margins per class cannot single out the middle one of three.
    floor = 0.6 if (model, target) == ("svm", "kind") else 0.85
    assert got["accuracy"] > floor and got["roc_auc"] > 0.7
    assert done.name == f"{model}_classification_{target}"
    assert done.test.count() == 120


@pytest.mark.parametrize("model", ["random_forest", "xgboost", "linear_regression"])
def test_regressors_learn(data, model):
    done = train_model(data, "regression", "line", model, features=["a", "b"], key_cols="id",
                       n_estimators=20, max_depth=5)
    got = done.metrics.first()
    assert got["r2"] > (0.999 if model == "linear_regression" else 0.8)
    if model == "linear_regression":
        fit = done.model.stages[-1]
        assert [*fit.coefficients, fit.intercept] == pytest.approx([3, -2, 1])


def test_saved_model_predicts_the_same(spark, data):
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    gaps = data.withColumn("b", F.when(F.col("id") % 5 != 0, F.col("b")))
    done = train_model(gaps, "classification", "flag", "logistic_regression", features=["a", "b", "word"],
                       key_cols="id", auto_encode=True, artifacts_dir=folder, model_name="mine")
    again = read_model(f"{folder}/mine").transform(done.test)
    first = done.model.transform(done.test)
    assert first.select("id", "predicted").exceptAll(again.select("id", "predicted")).count() == 0
    assert {r[0] for r in first.select("predicted").distinct().collect()} <= {"0", "1"}
    saved = json.loads(spark.read.text(f"{folder}/mine_metrics").first()[0])
    assert saved["accuracy"] == done.metrics.first()["accuracy"]


def test_default_target_is_the_last_column(data):
    done = train_model(data.select("a", "b", "flag"), "classification", model="logistic_regression")
    assert done.metrics.first()["target"] == "flag"


@pytest.mark.parametrize("C,penalty", [(0.5, "l1"), (2.0, "elasticnet"), (None, "none")])
def test_penalties(data, C, penalty):
    done = train_model(data, "classification", "flag", "logistic_regression", features=["a", "b"],
                       key_cols="id", C=C, penalty=penalty)
    assert done.metrics.first()["accuracy"] > 0.85


def test_refusals(data):
    gaps = data.withColumn("a", F.when(F.col("id") > 3, F.col("a")))
    for call in (
        lambda: train_model(data, "ranking", "flag"),
        lambda: train_model(data, "regression", "line", "logistic_regression"),
        lambda: train_model(data, "regression", "line", "svm"),
        lambda: train_model(data, "classification", "flag", "linear_regression"),
        lambda: train_model(data, "classification", "flag", "neural"),
        lambda: train_model(data, "classification", "none"),
        lambda: train_model(data, "classification", "flag", test_size=0.6),
        lambda: train_model(data, "classification", "flag", "svm", C=0),
        lambda: train_model(data, "classification", "flag", "logistic_regression", penalty="l3"),
        lambda: train_model(data, "classification", "flag"),
        lambda: train_model(gaps, "classification", "flag", features=["a", "b"]),
        lambda: train_model(data.where("flag = 1"), "classification", "flag", features=["a"]),
    ):
        with pytest.raises(ValueError):
            call()


def rings(spark, n: int = 900):
    rng = np.random.default_rng(2)
    angle, ring = rng.uniform(0, 2 * np.pi, n), rng.integers(0, 2, n)
    size = 1 + 2 * ring + rng.normal(scale=0.1, size=n)
    rows = [(i, float(s * np.cos(t)), float(s * np.sin(t)), int(r)) for i, (s, t, r) in enumerate(zip(size, angle, ring))]
    return spark.createDataFrame(rows, "id int, `a b` double, y double, ring int")


def test_rbf_kernel_separates_rings(spark):
    df, folder = rings(spark), f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    fit = {k: train_model(df, "classification", "ring", "svm", features=["a b", "y"], key_cols="id", kernel=k, C=10.0,
                          artifacts_dir=folder, model_name=k) for k in ("linear", "rbf")}
    got = {k: done.metrics.first() for k, done in fit.items()}
    assert got["rbf"]["accuracy"] > 0.95 and got["rbf"]["roc_auc"] > 0.98
    assert got["linear"]["accuracy"] < 0.8
    again = read_model(f"{folder}/rbf").transform(fit["rbf"].test)
    same = fit["rbf"].model.transform(fit["rbf"].test)
    assert same.select("id", "predicted").exceptAll(again.select("id", "predicted")).count() == 0
    with pytest.raises(ValueError, match="svm only"):
        train_model(df, "classification", "ring", "xgboost", features=["y"], kernel="rbf")
    with pytest.raises(ValueError, match="kernel"):
        train_model(df, "classification", "ring", "svm", features=["y"], kernel="poly")


def test_svm_probabilities_come_from_rows_it_did_not_see(spark):
    """Noise that a wide model learns by heart: probabilities of its training margins would be near 0 and 1."""
    rng = np.random.default_rng(3)
    x, label = rng.normal(size=(240, 60)), rng.integers(0, 2, 240)
    names = [f"x{i}" for i in range(60)]
    df = spark.createDataFrame(
        [(i, *map(float, row), int(v)) for i, (row, v) in enumerate(zip(x, label))],
        "id int, " + ", ".join(f"{n} double" for n in names) + ", label int")
    done = train_model(df, "classification", "label", "svm", features=names, key_cols="id", C=100.0)
    rows = done.model.transform(done.test).select("probability", "label").collect()
    loss = -np.mean([np.log(max(r.probability[r.label], 1e-9)) for r in rows])
    assert loss < 0.9


def test_svm_of_a_very_small_table(spark):
    df = spark.createDataFrame([(i, float(i), int(i > 5)) for i in range(12)], "id int, a double, y int")
    assert train_model(df, "classification", "y", "svm", features=["a"], key_cols="id").metrics.count() == 1
