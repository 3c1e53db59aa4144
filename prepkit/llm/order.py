"""Places in a global order, found without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import col, spare_name, width, written


def running_starts(totals: DataFrame, part: str, value: str, groups: list[str], out: str) -> DataFrame:
    """`totals` (one row per part and group) with the sum of `value` over the group's earlier parts.

    A group has at most one row per part, so no window here is larger than the number of parts.
    """
    before = Window.partitionBy(*map(col, groups)).orderBy(col(part)).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(out, F.coalesce(F.sum(col(value)).over(before), F.lit(0)).cast("long"))


def ranked(df: DataFrame, groups: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """Add the row's place (from 0) in its group under `order`.

    Two passes: rows are dealt out by range of (groups, order), so that a large group spans many
    partitions and each partition knows its rows' places within itself; the counts per partition
    then say where each partition starts. Only rows that are equal in groups and order share a task.
    Rows are written once between the passes. Nulls form a group; empty tables stay empty.
    """
    part = spare_name(df, "part")
    keys = [*map(col, groups), *order]
    dealt = written(
        df.repartitionByRange(width(df), *keys).withColumn(part, F.spark_partition_id()), "ranked")
    totals = dealt.groupBy(col(part), *map(col, groups)).agg(F.count(F.lit(1)).alias("n_here"))
    starts = running_starts(totals, part, "n_here", groups, "n_before").filter("n_before > 0")
    within = Window.partitionBy(col(part), *map(col, groups)).orderBy(*order)
    local = dealt.withColumn(out, F.row_number().over(within).cast("long") - 1)
    # Only the first group of a partition can have begun earlier: at most a row per partition.
    starts = starts.select(
        col(part).alias("p_"), "n_before", *[col(g).alias(f"g{i}_") for i, g in enumerate(groups)])
    match = col(part) == F.col("p_")
    for i, g in enumerate(groups):
        match = match & col(g).eqNullSafe(F.col(f"g{i}_"))
    joined = local.join(F.broadcast(starts), match, "left")
    return joined.select(*map(col, df.columns), (col(out) + F.coalesce("n_before", F.lit(0))).alias(out))
