"""Feature selection: scores per feature and the table narrowed to the chosen ones."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.numeric import bin_number, pearson
from prepkit.functions.schema import (
    as_double, as_list, c, check_choice, check_columns, check_numeric, clean, dtype, inline_rows,
    numeric_columns, present,
)
from prepkit.plans.bounds import across_cores, ensure_checkpoint_dir, settle, spread
from prepkit.plans.knn_information import nearest_neighbour_information
from prepkit.plans.order_stats import quantiles
from prepkit.plans.plane_information import plane_information

SCORINGS = ("f_classif", "f_regression", "mutual_info_classif", "mutual_info_regression")
FEW_CLASSES = 20
DEEPEST_TREE = 30
"""MLlib's limit on tree depth, used where no limit is asked for."""


class Selection(NamedTuple):
    """`scores`: feature, score, rank, selected - a row per candidate. `table`: what is kept.

    `left_out`: feature, rows - how many a missing feature or target keeps from each score; computed when asked for.
    """

    scores: DataFrame
    table: DataFrame
    selected: list[str]
    left_out: DataFrame | None = None


def _left_out(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    gone = [F.count_if(as_double(df, f).isNull() | ~present(df, target)).alias(f"n{i}") for i, f in enumerate(features)]
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("rows")) for i, f in enumerate(features)]
    return inline_rows(df.agg(*gone), rows)


def _candidates(df: DataFrame, target: str | None) -> list[str]:
    names = numeric_columns(df, but=[target] if target else [])
    if not names:
        raise ValueError("There is no numeric column to select from.")
    return names


def _score_table(df: DataFrame, features: Sequence[str], scores: Sequence[float | None],
                 chosen: Sequence[str], ranked: Sequence[str]) -> DataFrame:
    place = {f: i + 1 for i, f in enumerate(ranked)}
    return df.sparkSession.createDataFrame(pa.table({
        "feature": pa.array(features, pa.string()),
        "score": pa.array(scores, pa.float64()),
        "rank": pa.array([place[f] for f in features], pa.int32()),
        "selected": pa.array([f in set(chosen) for f in features], pa.bool_()),
    }))


def _ranking(features: Sequence[str], scores: Sequence[float | None]) -> list[str]:
    """Best first; equal scores favour the later column, unknown scores come last."""
    order = sorted(
        range(len(features)),
        key=lambda i: (scores[i] is not None, scores[i] if scores[i] is not None else 0.0, i),
        reverse=True,
    )
    return [features[i] for i in order]


def select_kbest(
    df: DataFrame, target: str, k: int, scoring: str, bins: int = 10, exact: bool = True,
    method: str = "binned", key_cols: str | Sequence[str] | None = None,
) -> Selection:
    """The k best numeric predictors by a univariate score; the table is target + chosen.

    Rows missing the feature or the target do not enter that feature's score. The mutual
    information scores are those of quantile-binned values (`bins` each); with `method="knn"` they are
    the 3-nearest-neighbour estimates instead, for classes or for a continuous target. These break ties by a
    tiny noise that follows from `key_cols`, or from the rows' content.
    """
    check_columns(df, [target], "Target")
    check_choice(scoring, SCORINGS, "scoring")
    check_choice(method, ("binned", "knn"), "method")
    if k < 1:
        raise ValueError("k must be at least 1.")
    if method == "knn" and not scoring.startswith("mutual_info"):
        raise ValueError("method='knn' is for the mutual information scores only.")
    keys = as_list(key_cols)
    check_columns(df, keys, "Key column")
    features = _candidates(df, target)
    if scoring == "f_classif":
        scores = f_classif(df, target, features)
    elif scoring == "f_regression":
        scores = f_regression(df, target, features)
    elif method == "knn" and scoring == "mutual_info_regression":
        check_numeric(df, target, "Target")
        scores = plane_information(df, target, features, keys)
    elif method == "knn":
        scores = nearest_neighbour_information(df, target, features, keys)
    else:
        scores = binned_information(df, target, features, bins, scoring == "mutual_info_regression", exact)
    ranked = _ranking(features, scores)
    chosen = [f for f in features if f in set(ranked[:k])]
    table = df.select(c(target), *[c(f) for f in chosen])
    return Selection(
        _score_table(df, features, scores, chosen, ranked), table, chosen, _left_out(df, target, features))


def _by_feature(rows: list, n: int, value: str) -> list[float | None]:
    found = {r["f"]: r[value] for r in rows}
    return [found.get(i) for i in range(n)]


def f_classif(df: DataFrame, target: str, features: Sequence[str]) -> list[float | None]:
    """One-way ANOVA F of each feature against the classes: one scan, grouped by class."""
    moments = []
    for i, f in enumerate(features):
        x = as_double(df, f)
        moments.append(F.struct(F.lit(i).alias("f"), F.count(x).alias("n"), F.avg(x).alias("m"),
                                F.var_pop(x).alias("v")))
    per_class = settle(
        df.where(present(df, target)).groupBy(c(target).alias("class"))
        .agg(F.array(*moments).alias("all"))
        .select(F.inline("all")).where(F.col("n") > 0)
    )
    n, m = F.col("n"), F.col("m")
    # One row per column of the table, so this side is small by construction.
    overall = per_class.groupBy("f").agg(
        F.sum("n").alias("total"), (F.sum(n * m) / F.sum(n)).alias("mean"))
    spread = per_class.join(F.broadcast(overall), "f").groupBy("f").agg(
        F.first("total").alias("total"), F.count(F.lit(1)).alias("k"),
        F.sum(n * (m - F.col("mean")) * (m - F.col("mean"))).alias("between"),
        F.sum(n * F.col("v")).alias("within"),
    )
    between = F.col("between") / F.nullif(F.col("k") - 1, F.lit(0))
    within = F.col("within") / F.nullif(F.col("total") - F.col("k"), F.lit(0))
    ratio = F.when(within != 0, F.try_divide(between, within)).when(between > 0, F.lit(float("inf")))
    return _by_feature(spread.select("f", ratio.alias("score")).collect(), len(features), "score")


def f_regression(df: DataFrame, target: str, features: Sequence[str]) -> list[float | None]:
    """F of the simple regression on each feature; 0 on a constant, the largest double on |r| = 1."""
    check_numeric(df, target, "Target")
    y = as_double(df, target)
    xs = [as_double(df, f) for f in features]
    both = [F.count_if(x.isNotNull() & y.isNotNull()) for x in xs]
    found = df.agg(
        *[pearson(x, y).alias(f"r{i}") for i, x in enumerate(xs)],
        *[n.alias(f"n{i}") for i, n in enumerate(both)],
    ).first()
    scores = []
    for i in range(len(features)):
        r, n = found[f"r{i}"], found[f"n{i}"]
        if r is None:
            scores.append(0.0)
        elif r * r >= 1:
            scores.append(float(np.finfo(np.float64).max))
        else:
            scores.append(r * r / (1 - r * r) * (n - 2))
    return scores


def binned_information(
    df: DataFrame, target: str, features: Sequence[str], bins: int, binned_target: bool, exact: bool,
) -> list[float | None]:
    """Mutual information (nats) of quantile bins: counts of (feature, bin, class), then entropies.

    Rows fold into at most bins x classes counts per feature before any shuffle.
    """
    if bins < 2:
        raise ValueError("bins must be at least 2.")
    if binned_target:
        check_numeric(df, target, "Target")
    numbers = [*features, target] if binned_target else list(features)
    probs = [float(p) for p in np.linspace(0, 1, bins + 1)]
    cuts = {x: sorted(set(q)) for x, q in quantiles(df, numbers, probs, exact).items() if q[0] is not None}

    narrow = across_cores(df.select(*[c(n) for n in dict.fromkeys([*features, target])]))
    narrow = narrow.select(
        *([] if binned_target else [clean(df, target).alias("y")]),
        *[as_double(df, x).alias("y" if i == len(features) else f"x{i}") for i, x in enumerate(numbers)])
    coded = _bins(narrow, {"y" if i == len(features) else f"x{i}": cuts.get(x) for i, x in enumerate(numbers)})
    each = [F.struct(F.lit(i).alias("f"), F.col(f"x{i}").alias("x"), F.col("y")) for i in range(len(features))]
    cells = (
        coded.where(F.col("y").isNotNull()).select(F.inline(F.array(*each)))
        .where(F.col("x").isNotNull())
        .groupBy("f", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    )
    f, x, y = F.col("f"), F.col("x"), F.col("y")
    sums = cells.groupingSets([[f, x, y], [f, x], [f, y], [f]], f, x, y).agg(
        F.sum("n").cast("double").alias("n"), F.grouping_id().alias("level"))
    level, n = F.col("level"), F.col("n")
    plus = F.when(level.isin(0, 3), n * F.ln(n)).otherwise(-n * F.ln(n))
    found = sums.groupBy("f").agg(
        (F.sum(plus) / F.max(F.when(level == 3, n))).alias("mi"))
    found = found.select("f", F.greatest("mi", F.lit(0.0)).alias("mi"))
    return _by_feature(found.collect(), len(features), "mi")


def _bins(df: DataFrame, edges: dict[str, list[float] | None]) -> DataFrame:
    """The named DOUBLE columns replaced by a number of the bin they lie in: (a, b], the least value included.

    Bucketizer searches without making the code of a scan so large that it is only interpreted. Its bins are [a, b),
    so it is given values and edges with the other sign; a difference to 0.0 makes both zeros one.
    """
    searched = {n: e for n, e in edges.items() if e is not None and len(e) > 2 and all(map(math.isfinite, e))}
    exprs = {}
    for n, e in edges.items():
        if n in searched:
            exprs[n] = F.lit(0.0) - F.col(n)
        elif e is None:
            exprs[n] = F.lit(None).cast("int")
        else:
            exprs[n] = F.when(F.col(n).isNotNull(), 1) if len(e) < 2 else bin_number(F.col(n), e, True, True)
    df = df.withColumns(exprs)
    if not searched:
        return df
    splits = [[-math.inf, *[0.0 - v for v in reversed(e[1:-1])], math.inf] for e in searched.values()]
    found = Bucketizer(
        inputCols=list(searched), outputCols=[f"_{n}" for n in searched], splitsArray=splits, handleInvalid="keep").transform(df)
    return found.withColumns({n: F.col(f"_{n}").cast("int") for n in searched}).select(*df.columns)


def variance_threshold(df: DataFrame, threshold: float = 0.0, keep: Sequence[str] = ()) -> Selection:
    """Numeric features whose population variance exceeds the threshold; other columns go.

    `keep` protects columns such as the target or keys from that.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative.")
    check_columns(df, keep)
    features = _candidates(df, None)
    xs = [as_double(df, f) for f in features]
    found = df.agg(*[
        F.struct(F.var_pop(x).alias("v"), (F.min(x) != F.max(x)).alias("moves")).alias(f"s{i}")
        for i, x in enumerate(xs)
    ]).first()
    scores = [found[f"s{i}"]["v"] for i in range(len(features))]
    moves = [bool(found[f"s{i}"]["moves"]) for i in range(len(features))]
    chosen = [
        f for f, v, m in zip(features, scores, moves)
        if v is not None and (m if threshold == 0 else v > threshold)
    ]
    if not chosen:
        raise ValueError(f"No feature has a variance above {threshold}.")
    table = df.select(*[c(x) for x in df.columns if x in set(chosen) | set(keep)])
    ranked = _ranking(features, scores)
    return Selection(_score_table(df, features, scores, chosen, ranked), table, chosen)


def infer_task(df: DataFrame, target: str) -> str:
    """'classification' for integer, boolean or at most 20 distinct values (missing is one)."""
    if isinstance(dtype(df, target), (T.IntegralType, T.BooleanType)):
        return "classification"
    y = clean(df, target)
    rough = df.agg(F.approx_count_distinct(y)).first()[0]
    if rough > 2 * FEW_CLASSES:
        return "regression"
    n = df.agg(F.count_distinct(y) + F.max(y.isNull().cast("int"))).first()[0]
    return "classification" if (n or 0) <= FEW_CLASSES else "regression"


def rf_importance_select(
    df: DataFrame, target: str, n_estimators: int = 200, max_depth: int | None = None,
    top: int | None = None, random_state: int = 42, max_bins: int = 256,
) -> Selection:
    """Numeric predictors by random-forest importance, best first; missing predictors count as 0."""
    check_columns(df, [target], "Target")
    if not 10 <= n_estimators <= 2000:
        raise ValueError("n_estimators must lie in [10, 2000].")
    if max_depth is not None and max_depth > DEEPEST_TREE:
        raise ValueError(f"A tree can be {DEEPEST_TREE} levels deep at most; None stands for that.")
    if any(x is not None and x < 1 for x in (max_depth, top)):
        raise ValueError("max_depth and top must be at least 1.")
    features = _candidates(df, target)
    task = infer_task(df, target)
    ensure_checkpoint_dir(df.sparkSession)
    filled = [F.coalesce(as_double(df, f), F.lit(0.0)).alias(f"f{i}") for i, f in enumerate(features)]
    y = clean(df, target)
    rows = df.where(present(df, target))
    if task == "classification":
        rows = rows.select(*filled, y.cast("string").alias("y"))
        rows = StringIndexer(inputCol="y", outputCol="label").fit(rows).transform(rows)
    else:
        rows = rows.select(*filled, as_double(df, target).alias("label"))
    assembler = VectorAssembler(inputCols=[f"f{i}" for i in range(len(features))], outputCol="features")
    forest = RandomForestClassifier if task == "classification" else RandomForestRegressor
    model = forest(
        numTrees=n_estimators, maxDepth=min(max_depth or DEEPEST_TREE, DEEPEST_TREE), seed=random_state,
        maxBins=max_bins, featureSubsetStrategy="sqrt" if task == "classification" else "all",
    ).fit(assembler.transform(spread(rows, rows.count())).select("features", "label"))
    scores = [float(v) for v in model.featureImportances.toArray()]
    ranked = _ranking(features, scores)
    chosen = ranked[:top]
    table = df.select(c(target), *[c(f) for f in chosen])
    return Selection(_score_table(df, features, scores, chosen, ranked), table, chosen)


def correlation_filter(df: DataFrame, target: str, threshold: float = 0.1) -> Selection:
    """Numeric features with |Pearson r| to the target of at least the threshold, strongest first.

    `score` is |r|, null where a side is constant (such a feature never passes).
    """
    check_numeric(df, target, "Target")
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie in [0, 1].")
    if isinstance(dtype(df, target), T.BooleanType):
        raise ValueError("A boolean target has no correlation; cast it to a number first.")
    features = _candidates(df, target)
    y = as_double(df, target)
    found = df.agg(*[pearson(as_double(df, f), y).alias(f"r{i}") for i, f in enumerate(features)]).first()
    scores = [None if r is None else abs(r) for r in found]
    ranked = _ranking(features, scores)
    by_name = dict(zip(features, scores))
    chosen = [f for f in ranked if by_name[f] is not None and by_name[f] >= threshold]
    table = df.select(c(target), *[c(f) for f in chosen])
    return Selection(_score_table(df, features, scores, chosen, ranked), table, chosen)
