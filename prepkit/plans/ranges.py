"""Rows dealt out by range of an order, so that a task sees a stretch of it whatever crowds there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepkit.plans.bounds import cut_lineage, shuffle_width

PART = "part"

PART_ROWS = 250_000
"""Rows of a part, about, once the shuffle partitions are too few for that: a task sorts a few parts."""


def width(spark: SparkSession, n_rows: int) -> int:
    """How many parts `n_rows` rows make."""
    return max(shuffle_width(spark), 1 + n_rows // PART_ROWS)


def gathered(df: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """Rows with equal keys in one task, before a window or count by these: more tasks than usual where rows are many."""
    n = width(df.sparkSession, n_rows)
    return df if n == shuffle_width(df.sparkSession) else df.repartition(n, *keys)


def dealt(df: DataFrame, order: Sequence[str | Column], n_rows: int = 0) -> DataFrame:
    """`df` with `part`, a number that rises along the order; rows that are equal in it share a part.

    Written once, so that parts stay as they are for all later steps, whichever executor is lost. `n_rows` is the
    size of `df`, from which the number of parts follows.
    """
    n = width(df.sparkSession, n_rows)
    return cut_lineage(df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()))


def with_halo(rows: DataFrame, groups: list[str], order: list[str], n: int, mark: str, n_rows: int = 0) -> DataFrame:
    """Dealt `rows` and, in every part, the `n` rows of the group before and after it, told apart by a true `mark`.

    Only the first and last `n` rows of each group and part travel, so nothing grows with a group.
    """
    here = Window.partitionBy(*groups, PART)
    row = F.struct(*[F.col(x) for x in order])
    edges = (
        gathered(rows.select(*groups, PART, *order), n_rows, PART).withColumn("up", F.row_number().over(here.orderBy(*order)))
        .withColumn("down", F.row_number().over(here.orderBy(*[F.desc(x) for x in order])))
        .where((F.col("up") <= n) | (F.col("down") <= n))
        .groupBy(*groups, PART).agg(
            F.collect_list(F.when(F.col("up") <= n, row)).alias("first"),
            F.collect_list(F.when(F.col("down") <= n, row)).alias("last")))
    # Each part listed here has a row of the group, so n of them on a side hold n rows.
    along = Window.partitionBy(*groups).orderBy(PART)
    before = F.flatten(F.collect_list("last").over(along.rowsBetween(-n, -1)))
    after = F.flatten(F.collect_list("first").over(along.rowsBetween(1, n)))
    halo = edges.withColumn("near", F.concat(before, after)).select(*groups, PART, F.explode("near").alias("row")).select(
        *groups, PART, *[F.col("row")[x].alias(x) for x in order], F.lit(True).alias(mark))
    return gathered(rows.withColumn(mark, F.lit(False)).unionByName(halo, allowMissingColumns=True), n_rows, PART)


def running_count(
    rows: DataFrame, group: str, order: list[str], counted: Column, into: str, n_rows: int = 0,
) -> DataFrame:
    """Add to each row how many rows `counted` says yes to, of its group, stand at or before it in the order."""
    spread = dealt(rows.withColumn("_one", counted.cast("int")), [group, *order], n_rows)
    totals = spread.groupBy(group, PART).agg(F.sum("_one").alias("_total"))
    # A row per group and part.
    before = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(group).alias("_g"), F.col(PART).alias("_p"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    run = Window.partitionBy(group, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = gathered(spread, n_rows, PART).withColumn("_here", F.sum("_one").over(run))
    joined = local.join(F.broadcast(starts), (F.col(group) == F.col("_g")) & (F.col(PART) == F.col("_p")))
    return joined.withColumn(into, F.col("_start") + F.col("_here")).drop("_one", "_g", "_p", "_start", "_here", PART)
