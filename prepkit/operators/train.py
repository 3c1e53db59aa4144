"""Train and evaluate a model: hold-out split, MLlib pipeline, metrics, optional artifacts."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer, IndexToString, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.schema import (
    as_double, as_list, c, check_choice, check_columns, dtype, is_numeric_or_bool, present, text_columns,
)
from prepkit.operators.metrics import (
    area_under_roc, classification_metrics, regression_metrics, roc_auc_ovr,
)
from prepkit.operators.sample import class_sizes
from prepkit.operators.select import DEEPEST_TREE
from prepkit.operators.split import train_val_test_split
from prepkit.plans.bounds import ensure_checkpoint_dir, settle, spread
from prepkit.sources.tables import write_metrics, write_model

MODELS = ("random_forest", "logistic_regression", "svm", "linear_regression", "xgboost")
CLASSIFIERS_ONLY = ("logistic_regression", "svm")
REGRESSORS_ONLY = ("linear_regression",)
PENALTIES = {"none": 0.0, "l2": 0.0, "elasticnet": 0.5, "l1": 1.0}
SOLVERS = ("lbfgs", "liblinear", "newton-cg", "newton-cholesky", "sag", "saga")

KERNELS = ("linear", "rbf")
FOLDS = 3
"""Parts of the training rows that take turns to be held out for calibration."""

LABEL, FEATURES = "_label", "_features"


class Trained(NamedTuple):
    model: PipelineModel
    metrics: DataFrame
    test: DataFrame
    name: str


def train_model(
    df: DataFrame, problem_type: str, target: str | None = None, model: str = "random_forest",
    test_size: float = 0.2, random_state: int = 42, n_estimators: int | None = None,
    max_depth: int | None = None, learning_rate: float | None = None, C: float | None = None,
    penalty: str | None = None, solver: str | None = None, artifacts_dir: str | None = None, model_name: str | None = None,
    features: Sequence[str] | None = None, key_cols: str | Sequence[str] | None = None,
    auto_encode: bool = False, max_bins: int = 256, kernel: str = "linear", n_waves: int = 256,
) -> Trained:
    """Fit on the training part, score the hold-out part, save both when `artifacts_dir` is given.

    The default target is the last column, the default features all others. Features must be
    numeric and complete unless `auto_encode` adds encoding and imputation to the pipeline.
    "xgboost" names boosted trees (MLlib's, first order). "svm" is linear, or with `kernel="rbf"` linear in
    `n_waves` random waves whose products average to that kernel; its probabilities are calibrated on margins of
    rows that the margin's model did not see. `solver` is accepted and left to MLlib: it does not move the optimum.
    """
    check_choice(kernel, KERNELS, "kernel")
    if kernel != "linear" and model != "svm":
        raise ValueError("kernel is for svm only.")
    check_choice(solver or "lbfgs", SOLVERS, "solver")
    check_choice(problem_type, ("classification", "regression"), "problem_type")
    check_choice(model, MODELS, "model")
    if problem_type == "regression" and model in CLASSIFIERS_ONLY:
        raise ValueError(f"{model} is only for classification.")
    if problem_type == "classification" and model in REGRESSORS_ONLY:
        raise ValueError(f"{model} is only for regression.")
    if not 0.05 <= test_size <= 0.5:
        raise ValueError("test_size must lie in [0.05, 0.5].")
    check_choice(penalty or "l2", PENALTIES, "penalty")
    if C is not None and C <= 0:
        raise ValueError("C must be positive.")
    target = target or df.columns[-1]
    check_columns(df, [target], "Target column")
    features = [f for f in (features or df.columns) if f != target]
    check_columns(df, features, "Feature")
    keys = as_list(key_cols)

    known = df.where(present(df, target))
    labels = _class_labels(known, target) if problem_type == "classification" else None
    encode, inputs = _feature_stages(known, features, auto_encode)
    split = train_val_test_split(
        known, target if labels else None, test_size, 0.0, bool(labels), random_state, keys or None, "_part")
    split = _with_label(split, target, labels)
    split = split.withColumns({f: as_double(known, f) for f in features if f not in text_columns(known)})
    ensure_checkpoint_dir(df.sparkSession)
    # The fit and its evaluation pass over these columns many times.
    columns = split.select(LABEL, "_part", *[c(f) for f in features])
    ready = spread(columns, known.count(), rounds=model != "random_forest").persist()
    try:
        train = ready.where(F.col("_part") == "train")
        estimator = _estimator(model, labels, train.count(), random_state, n_estimators, max_depth,
                               learning_rate, C, penalty, max_bins)
        if kernel == "rbf":
            waves, inputs = _waves(train, encode, inputs, n_waves, random_state)
            encode = [*encode, waves]
        prepare = [*encode, VectorAssembler(inputCols=inputs, outputCol=FEATURES)]
        names = [IndexToString(inputCol="prediction", outputCol="predicted", labels=labels)] if labels else []
        if model == "svm":
            fitted = _calibrated(prepare, estimator, names, train)
        else:
            fitted = Pipeline(stages=[*prepare, *estimator, *names]).fit(train)
        metrics = settle(_evaluate(
            fitted.transform(ready.where(F.col("_part") == "test")), labels, problem_type, model, target))
    finally:
        ready.unpersist()
    name = model_name or f"{model}_{problem_type}_{target}"
    if artifacts_dir is not None:
        write_model(fitted, f"{artifacts_dir}/{name}")
        write_metrics(metrics, f"{artifacts_dir}/{name}_metrics")
    test = split.where(F.col("_part") == "test").drop("_part")
    return Trained(fitted, metrics, test, name)


def _waves(train: DataFrame, encode: list, inputs: list[str], n: int, seed: int) -> tuple[SQLTransformer, list[str]]:
    """A stage that adds n random Fourier features of the inputs, and their names (Rahimi, Recht, NIPS 2007).

    cos(w x + b) with normal w and uniform b, drawn from the seed: plain expressions over the columns, so the
    stage is saved with the model. The kernel's width is one over the features' number and common variance.
    """
    filled = Pipeline(stages=encode).fit(train).transform(train) if encode else train
    odd = [x for x in inputs if not is_numeric_or_bool(dtype(filled, x))]
    if odd:
        raise ValueError(f"The rbf kernel takes numeric features only; leave out {odd}.")
    xs = [as_double(filled, x) for x in inputs]
    row = filled.agg(*[e for x in xs for e in (F.avg(x), F.avg(x * x))]).first()
    means, squares = [v or 0.0 for v in row[0::2]], [v or 0.0 for v in row[1::2]]
    spread_ = sum(squares) / len(xs) - (sum(means) / len(xs)) ** 2
    gamma = 1.0 / (len(xs) * spread_) if spread_ > 0 else 1.0
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=np.sqrt(2 * gamma), size=(n, len(xs)))
    b = rng.uniform(0, 2 * np.pi, size=n) - w @ np.array(means)
    size = float(np.sqrt(2 / n))
    taken = set(filled.columns)
    names = [next(x for x in (f"_wave{i}" + "_" * k for k in range(99)) if x not in taken) for i in range(n)]
    quoted = [f"cast(`{x.replace('`', '``')}` as double)" for x in inputs]
    waves = [
        f"{size!r}D * cos({float(b[i])!r}D + " + " + ".join(f"{float(v)!r}D * {x}" for v, x in zip(w[i], quoted)) + f") AS {names[i]}"
        for i in range(n)]
    return SQLTransformer(statement=f"SELECT *, {', '.join(waves)} FROM __THIS__"), names


def _calibrated(prepare: list, estimator: list, names: list, train: DataFrame) -> PipelineModel:
    """The SVM of all training rows, and a calibration fitted on margins of held-out folds.

    A row's fold follows from its content. Where a fold would leave a class out, as in very small tables, the
    calibration sees the training margins instead.
    """
    svm, *between, calibration = estimator
    first = Pipeline(stages=prepare).fit(train)
    fold = F.pmod(F.xxhash64(*[c(n) for n in train.columns]), F.lit(FOLDS)).alias("_fold")
    rows = first.transform(train).select(FEATURES, LABEL, fold).persist()
    try:
        here = {(r["_fold"], r[LABEL]) for r in rows.groupBy("_fold", LABEL).count().collect()}  # a row per fold and class
        classes = {label for _, label in here}
        enough = all(len({y for f, y in here if f != k}) == len(classes) for k in range(FOLDS))

        def margins(k: int) -> DataFrame:
            return svm.fit(rows.where(F.col("_fold") != k)).transform(rows.where(F.col("_fold") == k))

        with ThreadPoolExecutor(FOLDS + 1) as pool:  # each only waits for its own jobs
            whole = pool.submit(svm.fit, rows)
            held_out = list(pool.map(margins, range(FOLDS))) if enough else []
            model = whole.result()
        seen = reduce(DataFrame.unionByName, held_out) if enough else model.transform(rows)
        for stage in between:
            seen = stage.transform(seen)
        fitted = calibration.fit(seen)
    finally:
        rows.unpersist()
    return PipelineModel([*first.stages, model, *between, fitted, *names])


def _class_labels(df: DataFrame, target: str) -> list[str]:
    """Class names in value order; the model on the driver has a parameter set for each of them anyway."""
    sizes = class_sizes(df, target)
    found = sizes.orderBy("_g0").select(F.col("_g0").cast("string")).collect()
    if len(found) < 2:
        raise ValueError(f"'{target}' needs at least two classes.")
    return [r[0] for r in found]


def _with_label(df: DataFrame, target: str, labels: list[str] | None) -> DataFrame:
    if labels is None:
        return df.withColumn(LABEL, as_double(df, target))
    text = df.withColumn("_text", c(target).cast("string"))
    index = StringIndexerModel.from_labels(labels, inputCol="_text", outputCol=LABEL)
    return index.transform(text).drop("_text")


def _feature_stages(df: DataFrame, features: list[str], auto_encode: bool):
    """Encoding stages and the columns to assemble; complains about what a model cannot take."""
    numbers = [f for f in features if is_numeric_or_bool(dtype(df, f))]
    texts = [f for f in features if isinstance(dtype(df, f), T.StringType)]
    others = [f for f in features if f not in numbers and f not in texts]
    if others or (texts and not auto_encode):
        raise ValueError(f"Features must be numeric; encode or leave out {others + texts}.")
    if not features:
        raise ValueError("There are no features to train on.")
    gaps = df.agg(*[F.count_if(as_double(df, f).isNull()) for f in numbers]).first() if numbers else []
    gapped = [f for f, n in zip(numbers, gaps) if n]
    if gapped and not auto_encode:
        raise ValueError(f"Features have missing values; fill or leave out {gapped}.")
    stages = []
    if gapped:
        stages.append(Imputer(inputCols=gapped, outputCols=[f"{f}_filled" for f in gapped]))
    if texts:
        stages.append(StringIndexer(
            inputCols=texts, outputCols=[f"{f}_index" for f in texts], handleInvalid="keep",
            stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(
            inputCols=[f"{f}_index" for f in texts], outputCols=[f"{f}_onehot" for f in texts]))
    inputs = [f"{f}_filled" if f in gapped else f"{f}_onehot" if f in texts else f for f in features]
    return stages, inputs


def _estimator(
    model: str, labels: list[str] | None, n_train: int, seed: int, trees: int | None,
    depth: int | None, rate: float | None, C: float | None, penalty: str | None, max_bins: int,
) -> list:
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    if model == "random_forest":
        if depth is not None and depth > DEEPEST_TREE:
            raise ValueError(f"A tree can be {DEEPEST_TREE} levels deep at most; None stands for that.")
        deep = depth or DEEPEST_TREE
        if labels:
            return [RandomForestClassifier(numTrees=trees or 200, maxDepth=deep, seed=seed, maxBins=max_bins,
                                           featureSubsetStrategy="sqrt", **common)]
        return [RandomForestRegressor(numTrees=trees or 300, maxDepth=deep, seed=seed, maxBins=max_bins,
                                      featureSubsetStrategy="all", **common)]
    if model == "linear_regression":
        return [LinearRegression(regParam=0.0, solver="normal", **common)]
    if model == "xgboost":
        boost = {"maxDepth": depth or 6, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9",
                 "seed": seed, "maxBins": max_bins, **common}
        if not labels:
            return [GBTRegressor(maxIter=trees or 400, stepSize=rate or 0.05, **boost)]
        gbt = GBTClassifier(maxIter=trees or 300, stepSize=rate or 0.1, **boost)
        return [gbt] if len(labels) == 2 else [OneVsRest(classifier=gbt, parallelism=min(len(labels), 8), **common)]
    weight = 1.0 / ((C or 1.0) * max(n_train, 1))
    if model == "logistic_regression":
        none = penalty == "none"
        return [LogisticRegression(maxIter=200, regParam=0.0 if none else weight, standardization=False,
                                   elasticNetParam=PENALTIES[penalty or "l2"], **common)]
    svm = LinearSVC(regParam=weight, standardization=False, tol=1e-4, **common)
    margins = "rawPrediction"
    stages = [svm] if len(labels) == 2 else [OneVsRest(classifier=svm, parallelism=min(len(labels), 8), **common)]
    if len(labels) == 2:
        margins = "_margin"
        stages.append(VectorSlicer(inputCol="rawPrediction", outputCol=margins, indices=[1]))
    stages.append(LogisticRegression(
        featuresCol=margins, labelCol=LABEL, predictionCol="_calibrated", probabilityCol="probability",
        rawPredictionCol="_calibrated_raw", regParam=0.0, maxIter=100))
    return stages


def _evaluate(scored: DataFrame, labels: list[str] | None, problem: str, model: str, target: str) -> DataFrame:
    scores = next((s for s in ("probability", "rawPrediction") if s in scored.columns), None)
    if labels:
        scored = scored.select(LABEL, "prediction", vector_to_array(scores).alias("scores"))
    head = [F.lit(problem).alias("problem_type"), F.lit(model).alias("model"), F.lit(target).alias("target")]
    if labels is None:
        return regression_metrics(scored, LABEL, "prediction").select(*head, "*")
    if len(labels) == 2:
        area = area_under_roc(scored, F.col(LABEL) == 1, F.col("scores")[1]).select("auc")
    else:
        area = roc_auc_ovr(scored, LABEL, F.col("scores"), [float(i) for i in range(len(labels))])
    rates = classification_metrics(scored, LABEL, "prediction")
    return rates.withColumn("roc_auc", area.scalar()).select(*head, "*")
