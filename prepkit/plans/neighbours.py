"""The row before or after, per key, also where one key holds a large part of the table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.schema import c
from prepkit.plans import bounds


def with_neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, into: str, after: bool = False,
) -> DataFrame:
    """Add `value` of the previous (or next) row of the same key, null at the end; missing order values come first.

    Rows of a key with equal order values are ordered by a hash of the row. While every key fits one task this is a
    plain lag. Otherwise the table is dealt out by ranges of (keys, order, hash), which cut through a key wherever it
    is large; the row at the end of each part, one per part, is handed to the next one. Both give the same rows.
    """
    step = F.lead if after else F.lag
    by, sort = [c(k) for k in keys], [c(o) for o in order]
    tie = F.xxhash64(*[c(f.name) for f in df.schema if not _holds_map(f.dataType)])
    largest = bounds.largest_group(df, list(keys))
    if largest <= bounds.WINDOW_GROUP_ROWS:
        return df.withColumn(into, step(value).over(Window.partitionBy(*by).orderBy(*sort, tie)))
    parts = max(bounds.shuffle_width(df.sparkSession), math.ceil(4 * df.count() / bounds.WINDOW_GROUP_ROWS))
    place = [*by, *sort, F.col("_tie")]
    dealt = df.withColumns({"_v": value, "_tie": tie}).repartitionByRange(parts, *place)
    # Range bounds are drawn anew whenever a plan runs, so the parts are written once.
    rows = bounds.cut_lineage(dealt.withColumn("_part", F.spark_partition_id()))
    me = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(by)], F.col("_v").alias("v"))
    at = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(place)])
    ends = rows.groupBy("_part").agg((F.min_by if after else F.max_by)(me, at).alias("_end"))
    ends = ends.withColumn("_end", step("_end").over(Window.orderBy("_part")))
    near = F.coalesce(step(me).over(Window.partitionBy("_part").orderBy(*place)), F.col("_end"))
    same = F.lit(True)
    for i, k in enumerate(by):
        same = same & k.eqNullSafe(F.col(f"_near.k{i}"))
    # The parts bound the broadcast: a row for each.
    met = rows.join(F.broadcast(ends), "_part", "left").withColumn("_near", near)
    return met.select(*[c(n) for n in df.columns], F.when(same, F.col("_near.v")).alias(into))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))
