"""Exact, repeatable samples: random, stratified, class-balanced and clustered."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.schema import as_double, as_list, c, check_columns, numeric_columns
from prepkit.plans import bounds
from prepkit.plans.bounds import settle, spread
from prepkit.plans.cuts import first_per_group, group_names, label_by_hash, label_by_order, plain_order

FITS_AT_ONCE = 4


def class_sizes(df: DataFrame, target: str) -> DataFrame:
    """_g0 and _n: one row per class, missing included."""
    check_columns(df, [target], "Target")
    return df.groupBy(c(target).alias("_g0")).agg(F.count(F.lit(1)).alias("_n"))


def share_out(sizes: DataFrame, wanted: int, size: Column, into: str) -> DataFrame:
    """Split a total over the classes in proportion to their size, largest remainder first, ties by class.

    `wanted` is the total to reach and `size` the class sizes. Rows of the table are never ranked. Up to
    SMALL_TABLE_ROWS classes are ranked at once; of more, only the remainder at the last place (and the class
    there, where remainders are equal) is looked for, and every class is compared with it.
    """
    total = sizes.agg(F.sum(size)).first()[0] or 0
    share = size.cast("double") * F.lit(wanted) / F.lit(max(total, 1))
    shares = sizes.withColumn("_share", share).withColumn("_floor", F.floor("_share"))
    spare = wanted - (shares.agg(F.sum("_floor")).first()[0] or 0)
    shares = shares.withColumn("_rest", F.col("_floor") - F.col("_share"))
    missing = F.col("_g0").isNull().cast("int")
    if bounds.small_rows(sizes, bounds.SMALL_TABLE_ROWS) is not None:
        rank = F.row_number().over(Window.orderBy("_rest", missing, "_g0"))
        marked = shares.withColumn("_more", (rank <= spare).cast("bigint"))
    else:
        order = [F.col("_rest"), missing, plain_order(shares, "_g0")]
        marked = label_by_order(shares, order, [spare], shares.count(), ["more", "same"], "_more")
        marked = marked.withColumn("_more", (F.col("_more") == "more").cast("bigint"))
    return marked.withColumn(into, F.col("_floor") + F.col("_more")).drop("_share", "_floor", "_rest", "_more")


def total_quota(df: DataFrame, cuts: Sequence[int], n: int) -> DataFrame:
    names = ["_n", *[f"_cut{i}" for i in range(len(cuts))]]
    return df.sparkSession.createDataFrame(pa.table({x: [v] for x, v in zip(names, [n, *cuts])}))


def _keep_in(df: DataFrame, labelled: DataFrame, last: Sequence[str] = ()) -> DataFrame:
    order = [x for x in df.columns if x not in last] + list(last)
    return labelled.where(F.col("_part") == "in").select(*[c(x) for x in order])


def random_sample(
    df: DataFrame, sample_size: float = 0.5, random_state: int = 42,
    key_cols: str | Sequence[str] | None = None, exact: bool = True,
) -> DataFrame:
    """floor(sample_size * n) rows. `exact=False` is Spark's one-pass Bernoulli sample."""
    _check_share(sample_size)
    if not exact:
        return df.sample(sample_size, random_state)
    n = df.count()
    keep = math.floor(sample_size * n)
    marked = label_by_hash(df, [], as_list(key_cols) or None, random_state,
                           total_quota(df, [keep], n), ["in", "out"], "_part")
    return _keep_in(df, marked)


def stratified_sample(
    df: DataFrame, target: str, sample_size: float = 0.5, random_state: int = 42,
    key_cols: str | Sequence[str] | None = None,
) -> DataFrame:
    """floor(sample_size * n) rows in the proportions of the classes; the target comes last."""
    _check_share(sample_size)
    sizes = settle(class_sizes(df, target))
    n, least = sizes.agg(F.sum("_n"), F.min("_n")).first()
    if least is not None and least < 2:
        raise ValueError("A class has fewer than 2 rows; use random_sample or class_balanced_sample.")
    keep = math.floor(sample_size * (n or 0))
    quotas = settle(share_out(sizes, keep, F.col("_n"), "_cut0"))
    marked = label_by_hash(df, [target], as_list(key_cols) or None, random_state, quotas,
                           ["in", "out"], "_part")
    return _keep_in(df, marked, [target])


def class_balanced_sample(
    df: DataFrame, target: str, per_class: int | None = None, max_total: int | None = None,
    random_state: int = 42, shuffle_within_class: bool = True,
    key_cols: str | Sequence[str] | None = None,
) -> DataFrame:
    """min(per_class, class size) rows of each class; `max_total` sets per_class by division.

    Without shuffling, each class gives its first rows in `key_cols` order.
    """
    if per_class is None and max_total is None:
        raise ValueError("Give per_class or max_total.")
    if any(x is not None and x < 1 for x in (per_class, max_total)):
        raise ValueError("per_class and max_total must be positive.")
    sizes = settle(class_sizes(df, target))
    if per_class is None:
        per_class = max(1, max_total // max(1, sizes.count()))
    quotas = sizes.withColumn("_cut0", F.least(F.col("_n"), F.lit(per_class).cast("bigint")))
    quotas = settle(quotas)
    keys = as_list(key_cols)
    if shuffle_within_class:
        marked = label_by_hash(df, [target], keys or None, random_state, quotas, ["in", "out"], "_part")
    else:
        if not keys:
            raise ValueError("shuffle_within_class=False needs key_cols: a DataFrame has no row order.")
        check_columns(df, keys, "Key column")
        marked = first_per_group(df, [target], keys, quotas, "_part")
    return _keep_in(df, marked)


def clustered_sample(
    df: DataFrame, n_clusters: int, samples_per_cluster: int = 1, random_state: int = 42,
    use_features: Sequence[str] | None = None, key_cols: str | Sequence[str] | None = None,
    n_init: int = 10, scale: bool = False, max_iter: int = 100,
) -> DataFrame:
    """The rows nearest each k-means centre; rows with a missing feature cannot be placed and stay out.

    Features are numeric columns or one array column; ties in distance go by key. The nearest
    rows are kept per task before the shuffle, so a huge cluster is not gathered anywhere.
    """
    if n_clusters < 1 or samples_per_cluster < 1:
        raise ValueError("n_clusters and samples_per_cluster must be at least 1.")
    features = list(use_features) if use_features is not None else df.columns
    check_columns(df, features)
    vector, stages = _feature_vector(df, features)
    keys = as_list(key_cols)
    check_columns(df, keys, "Key column")
    ready = vector
    if scale:
        ready = StandardScaler(inputCol="_raw", outputCol="_features").fit(ready).transform(ready)
    else:
        ready = ready.withColumnRenamed("_raw", "_features")
    placed = _placed(ready, n_clusters, random_state, n_init, max_iter)
    gaps = F.zip_with(vector_to_array("_features"), F.col("_centre"), lambda a, b: (a - b) * (a - b))
    placed = placed.withColumn("_dist", F.aggregate(gaps, F.lit(0.0), lambda acc, v: acc + v))
    tie = [c(k) for k in keys] or [F.xxhash64(*[c(n) for n in df.columns])]
    rank = F.row_number().over(Window.partitionBy("_cluster").orderBy("_dist", *tie))
    return (
        placed.withColumn("_rank", rank).where(F.col("_rank") <= samples_per_cluster)
        .select(*[c(n) for n in df.columns])
    )


def _placed(ready: DataFrame, n_clusters: int, seed: int, n_init: int, max_iter: int) -> DataFrame:
    """The rows with the number of their cluster and its centre, by the best of `n_init` fits."""
    if n_clusters == 1:  # nothing to fit, and MLlib takes two at least
        mean = ready.agg(Summarizer.mean(F.col("_features"))).first()[0]
        centre = F.array(*[F.lit(float(v)) for v in ([] if mean is None else mean.toArray())])
        return ready.withColumns({"_cluster": F.lit(0), "_centre": centre})
    points = spread(ready.select("_features"), ready.count(), rounds=True).persist()
    try:
        means = [
            KMeans(k=n_clusters, seed=seed + i, maxIter=max_iter, featuresCol="_features", predictionCol="_cluster")
            for i in range(n_init)
        ]
        with ThreadPoolExecutor(FITS_AT_ONCE) as pool:  # each only waits for its own jobs
            fits = list(pool.map(lambda one: one.fit(points), means))
    finally:
        points.unpersist()
    model: KMeansModel = min(fits, key=lambda m: m.summary.trainingCost)
    centres = model.clusterCenters()
    # A row per cluster: n_clusters bounds the broadcast.
    centres = F.broadcast(ready.sparkSession.createDataFrame(pa.table({
        "_at": pa.array(range(len(centres)), pa.int32()),
        "_centre": pa.array([[float(v) for v in row] for row in centres], pa.list_(pa.float64())),
    })))
    return model.transform(ready).join(centres, F.col("_cluster") == F.col("_at"))


def clustered_left_out(df: DataFrame, use_features: Sequence[str] | None = None) -> DataFrame:
    """One row: all rows of the table (n_rows), and those a missing feature keeps out of the clusters (left_out)."""
    features = list(use_features) if use_features is not None else df.columns
    check_columns(df, features)
    placed = _feature_vector(df, features)[0].agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("left_out", F.col("n_rows") - placed)


def _feature_vector(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    arrays = [n for n in features if isinstance(df.schema[n].dataType, T.ArrayType)]
    if arrays and len(features) == 1:
        from pyspark.ml.functions import array_to_vector

        name = arrays[0]
        whole = c(name).isNotNull() & ~F.exists(c(name), lambda v: v.isNull() | F.isnan(v))
        return df.where(whole).withColumn("_raw", array_to_vector(c(name).cast("array<double>"))), arrays
    numbers = [n for n in numeric_columns(df) if n in features]
    if not numbers:
        raise ValueError("Clusters need numeric features, or one array column; there are none.")
    filled = {f"_f{i}": as_double(df, n) for i, n in enumerate(numbers)}
    ready = df.withColumns(filled).dropna(subset=list(filled))
    ready = VectorAssembler(inputCols=list(filled), outputCol="_raw").transform(ready)
    return ready.drop(*filled), numbers


def _check_share(share: float) -> None:
    if not 0 < share <= 1:
        raise ValueError("sample_size must lie in (0, 1].")
