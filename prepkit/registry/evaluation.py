"""Metric and training queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import metrics, train
from prepkit.plans.bounds import shared_dir
from prepkit.registry import Query, on
from prepkit.registry.inputs import RULED, rounded, ruled
from prepkit.registry.sampling import HASH, N_TEST, quota
from prepkit.sources import tables

# A rule standing in for a model, so that the metrics can be checked without training one.
SCORED = """(
  SELECT l_returnflag AS y,
         CASE WHEN l_quantity < 15 THEN 'A' WHEN l_quantity < 35 THEN 'N' ELSE 'R' END AS p,
         (l_linestatus = 'O')::INTEGER AS pos, floor(l_extendedprice / 100)::DOUBLE AS s,
         [l_quantity, floor(l_extendedprice / 1000), l_discount * 100]::DOUBLE[] AS v
  FROM lineitem)"""
FLAGS = ["A", "N", "R"]


def scored(df: DataFrame) -> DataFrame:
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    return df.select(
        F.col("l_returnflag").alias("y"),
        F.when(q < 15, "A").when(q < 35, "N").otherwise("R").alias("p"),
        (F.col("l_linestatus") == "O").cast("int").alias("pos"),
        F.floor(price / 100).cast("double").alias("s"),
        F.array(q, F.floor(price / 1000).cast("double"), F.col("l_discount") * 100).alias("v"),
    )


def _area(label: str, score: str, source: str) -> str:
    return f"""
SELECT (sum(r) FILTER ({label}) - n1 * (n1 + 1) / 2) / nullif(n1 * n0, 0) AS auc FROM (
  SELECT *, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS r,
         sum({label}::INTEGER) OVER ()::DOUBLE AS n1, sum((NOT {label})::INTEGER) OVER ()::DOUBLE AS n0
  FROM {source}) GROUP BY n1, n0"""


# A model that has learnt the rule of `ruled` gives it back on the hold-out rows, whose keys SQL knows.
RULED_HASH = "md5(concat_ws('|', CAST(c_custkey AS VARCHAR), '42'))"
RULED_TEST = "(SELECT ceil(round(0.2 * (SELECT count(*) FROM customer), 9))::BIGINT)"


def _learnt(model: str, target: str) -> Query:
    """Hold-out predictions of a model with its default work."""
    problem = "regression" if target == "amount" else "classification"

    def run(df: DataFrame) -> DataFrame:
        done = train.train_model(ruled(df), problem, target, model, features=["band", "thousands"], key_cols="c_custkey")
        scored = done.model.transform(done.test)
        if problem == "regression":
            return scored.select("c_custkey", F.round("prediction", 6).alias("predicted"))
        return scored.select("c_custkey", "predicted")

    if problem == "regression":
        sql = f"""SELECT c_custkey, amount::DOUBLE AS predicted FROM (
                    SELECT *, row_number() OVER (ORDER BY {RULED_HASH}) AS k FROM {RULED}) WHERE k <= {RULED_TEST}"""
    else:
        classes = f"(SELECT {target} AS g, count(*) AS n FROM {RULED} GROUP BY 1)"
        sql = f"""WITH q AS {quota(classes, 'n', RULED_TEST, 'n_test')},
                       r AS (SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY {RULED_HASH}) AS k FROM {RULED})
                  SELECT c_custkey, {target} AS predicted FROM r JOIN q ON r.{target} = q.g WHERE k <= n_test"""
    return on("customer", run, sql)


def _documents(spark: SparkSession, folder: str, model: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = docs.join(labels, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", F.size(F.split("text", r"\s+")).alias("n_words"), "quality")
    return train.train_model(rows, "classification", "quality", model, key_cols="doc_id", auto_encode=True,
                             features=["lang", "source", "n_chars", "n_words"]).metrics


def _fit_line(df: DataFrame, folder: str | None = None) -> train.Trained:
    return train.train_model(df, "regression", "o_totalprice", "linear_regression", features=["o_custkey"],
                             key_cols="o_orderkey", artifacts_dir=folder)


def _line(df: DataFrame) -> DataFrame:
    done = _fit_line(df)
    fit = done.model.stages[-1]
    found = done.metrics.select("rmse", "mae", "r2").withColumns({
        "slope": F.lit(float(fit.coefficients[0])), "intercept": F.lit(float(fit.intercept))})
    return rounded(found, 6, *found.columns)


def _reloaded_model(df: DataFrame) -> DataFrame:
    folder = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    done = _fit_line(df, folder)
    scored = tables.read_model(f"{folder}/{done.name}").transform(done.test)
    return scored.select("o_orderkey", F.round("prediction", 3).alias("predicted"))


def _reloaded_metrics(df: DataFrame) -> DataFrame:
    folder = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    done = _fit_line(df, folder)
    found = df.sparkSession.read.json(f"{folder}/{done.name}_metrics").select("problem_type", "model", "rmse", "mae", "r2")
    return rounded(found, 6, "rmse", "mae", "r2")


LINE = f"""
WITH r AS (SELECT o_orderkey, o_custkey::DOUBLE AS x, o_totalprice AS y,
                  row_number() OVER (ORDER BY {HASH}) <= {N_TEST} AS held FROM orders),
     f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r WHERE NOT held)"""
LINE_METRICS = """round(sqrt(avg((y - a - b * x) ** 2)), 6) AS rmse, round(avg(abs(y - a - b * x)), 6) AS mae,
       round(1 - avg((y - a - b * x) ** 2) / var_pop(y), 6) AS r2 FROM r, f WHERE held"""

QUERIES: dict[str, Query] = {
    "metrics_classification": on(
        "lineitem",
        lambda df: rounded(metrics.classification_metrics(scored(df), "y", "p"), 9,
                           "accuracy", "precision_macro", "recall_macro", "f1_macro"),
        f"""WITH k AS (SELECT unnest({FLAGS}) AS k),
                 t AS (SELECT k, count(*) FILTER (y = k AND p = k)::DOUBLE AS tp,
                              count(*) FILTER (p = k)::DOUBLE AS said, count(*) FILTER (y = k)::DOUBLE AS actual,
                              count(*)::DOUBLE AS n FROM {SCORED}, k GROUP BY k)
            SELECT round(sum(tp) / max(n), 9) AS accuracy,
                   round(avg(coalesce(tp / nullif(said, 0), 0)), 9) AS precision_macro,
                   round(avg(coalesce(tp / nullif(actual, 0), 0)), 9) AS recall_macro,
                   round(avg(coalesce(2 * tp / nullif(said + actual, 0), 0)), 9) AS f1_macro FROM t"""),
    "metrics_auc": on(
        "lineitem", lambda df: rounded(metrics.roc_auc(scored(df), "pos", "s"), 9, "roc_auc"),
        f"SELECT round(auc, 9) AS roc_auc FROM ({_area('(pos = 1)', 's', SCORED)})"),
    "metrics_auc_ovr": on(
        "lineitem",
        lambda df: rounded(metrics.roc_auc_ovr(scored(df), "y", F.col("v"), FLAGS), 9, "roc_auc"),
        "SELECT round(avg(auc), 9) AS roc_auc FROM (" + " UNION ALL ".join(
            _area(f"(y = '{k}')", f"v[{i + 1}]", SCORED) for i, k in enumerate(FLAGS)) + ")"),
    "metrics_regression": on(
        "lineitem",
        lambda df: rounded(metrics.regression_metrics(
            df.withColumn("guess", F.col("l_quantity") * 1500), "l_extendedprice", "guess"), 6,
            "rmse", "mae", "r2"),
        """SELECT round(sqrt(avg((y - p) ** 2)), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
                  round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2
           FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)"""),
    "train_linear": on(
        "orders", _line,
        f"{LINE} SELECT round(any_value(b), 6) AS slope, round(any_value(a), 6) AS intercept, {LINE_METRICS}"),
    "model_reloaded": on(
        "orders", _reloaded_model,
        f"{LINE} SELECT o_orderkey, round(a + b * x, 3) AS predicted FROM r, f WHERE held"),
    "metrics_reloaded": on(
        "orders", _reloaded_metrics,
        f"{LINE} SELECT 'regression' AS problem_type, 'linear_regression' AS model, {LINE_METRICS}"),
    "train_rf_classifier": _learnt("random_forest", "level"),
    "train_rf_regressor": _learnt("random_forest", "amount"),
    "train_gbt_classifier": _learnt("xgboost", "low"),
    "train_gbt_multiclass": _learnt("xgboost", "level"),
    "train_gbt_regressor": _learnt("xgboost", "amount"),
    "train_logistic_rule": _learnt("logistic_regression", "low"),
    "train_svm_rule": _learnt("svm", "low"),
    "train_logistic": Query(lambda s, d: rounded(
        _documents(s, d, "logistic_regression"), 3, "accuracy", "precision_macro", "recall_macro", "f1_macro",
        "roc_auc"), None),
    "train_svm": Query(lambda s, d: rounded(
        _documents(s, d, "svm"), 3, "accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc"), None),
}
