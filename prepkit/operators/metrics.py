"""Evaluation of predictions as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.functions.schema import as_double, c, check_columns
from prepkit.plans.bounds import shuffle_width


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy and macro precision, recall and F1 (0 where a class has no rows).

    Macro means run over every class seen as a label or a prediction.
    """
    check_columns(df, [label, prediction])
    kind = df.schema[label].dataType
    seen = df.select(c(label).alias("y"), c(prediction).cast(kind).alias("p")).dropna()
    confusion = seen.groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("said"), hit.alias("right")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("said"), F.lit(0).cast("bigint").alias("right")),
    )
    right, said, actual = (F.col(x).cast("double") for x in ("right", "said", "actual"))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return (
        confusion.select(F.inline(sides)).groupBy("class")
        .agg(F.sum("actual").alias("actual"), F.sum("said").alias("said"), F.sum("right").alias("right"))
        .agg(
            (F.sum("right") / F.sum("actual")).alias("accuracy"),
            F.avg(share(right, said)).alias("precision_macro"),
            F.avg(share(right, actual)).alias("recall_macro"),
            F.avg(share(2 * right, said + actual)).alias("f1_macro"),
        )
    )


def area_under_roc(
    df: DataFrame, positive: Column, score: Column, groups: Sequence[Column] = (),
) -> DataFrame:
    """Exact area per group (columns g0.. and auc): a tie between the classes counts half.

    Equal scores are counted first, so a hot score is one row. The distinct scores are then
    spread by range: pairs inside a range come from a running count there, pairs across
    ranges from the totals of the ranges, of which there are as many as shuffle partitions.
    """
    names = [f"g{i}" for i in range(len(groups))]
    counts = (
        df.select(*[g.alias(n) for g, n in zip(groups, names)], score.cast("double").alias("s"),
                  positive.cast("int").alias("pos"))
        .dropna(subset=["s", "pos"])
        .groupBy(*names, "s")
        .agg(F.sum("pos").cast("double").alias("pos"), F.sum(1 - F.col("pos")).cast("double").alias("neg"))
    )
    ranged = (
        counts.repartitionByRange(shuffle_width(df.sparkSession), *names, "s")
        .withColumn("part", F.spark_partition_id())
    )
    run = Window.partitionBy("part", *names).orderBy("s")
    lower = F.sum("neg").over(run) - F.col("neg")
    totals = (
        ranged.withColumn("won", F.col("pos") * (lower + F.col("neg") / 2))
        .groupBy("part", *names)
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    across = Window.partitionBy(*names).orderBy("part")
    lower = F.sum("neg").over(across) - F.col("neg")
    pairs = F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))
    return (
        totals.withColumn("won", F.col("won") + F.col("pos") * lower)
        .groupBy(*names).agg((F.sum("won") / pairs).alias("auc"))
    )


def roc_auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """One row with roc_auc of a binary label; null when a class is absent."""
    check_columns(df, [label, score])
    return area_under_roc(df, c(label) == F.lit(positive), c(score)).select(F.col("auc").alias("roc_auc"))


def roc_auc_ovr(df: DataFrame, label: str, scores: Column, classes: Sequence) -> DataFrame:
    """One row with the mean one-vs-rest area; `scores` is an array in the order of `classes`.

    Null when a class never occurs.
    """
    check_columns(df, [label])
    each = F.posexplode(F.arrays_zip(
        F.array(*[F.lit(k) for k in classes]).alias("k"), scores.alias("s")))
    long = df.select(c(label).alias("y"), each.alias("i", "pair"))
    areas = area_under_roc(long, F.col("y") == F.col("pair.k"), F.col("pair.s"), [F.col("i")])
    complete = F.count("auc") == F.lit(len(classes))
    return areas.agg(F.when(complete, F.avg("auc")).alias("roc_auc"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: rmse, mae and r2 (null on a constant label)."""
    check_columns(df, [label, prediction])
    both = df.select(as_double(df, label).alias("y"), as_double(df, prediction).alias("p")).dropna()
    error = F.col("y") - F.col("p")
    spread = F.nullif(F.var_pop("y"), F.lit(0.0))
    return both.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.avg(error * error) / spread).alias("r2"),
    )
