"""Exact order statistics and quantiles without a single-task sort.

Numbers and times have an integer image that sorts as they do; ranks among these are found by
radix selection: counts of leading bits, then of the next bits where a wanted rank lies. Values
of other kinds are counted first (a hot value collapses map-side), the distinct values are
spread by range, and only the few ranges that hold a wanted rank are looked at again. That
second look selects by value, so it does not matter how Spark drew the ranges.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.numeric import from_image, with_image
from prepkit.functions.schema import as_double, c
from prepkit.plans import bounds
from prepkit.plans.joins import attach
from prepkit.plans.bounds import shuffle_width


DIGIT = 16
"""Bits of the integer image that one pass looks at, from the highest down."""

SMALL_CELL = 200_000
"""Cells with no more rows than this are counted by value at once, instead of by the next digits."""


def values_at_ranks(df: DataFrame, value: Column, ranks: Sequence[int]) -> list[tuple]:
    """For each 0-based rank of the non-missing `value`: (value, rows below it, rows equal to it)."""
    values = df.select(value.alias("v")).where(F.col("v").isNotNull())
    if isinstance(values.schema["v"].dataType, T.IntegralType):
        return _integers_at_ranks(values.select(F.col("v").cast("bigint")), ranks)
    counts = (
        df.select(value.alias("v")).where(F.col("v").isNotNull())
        .groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    )
    spans = (
        counts.repartitionByRange(shuffle_width(df.sparkSession), "v")
        .withColumn("part", F.spark_partition_id())
        .groupBy("part").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .orderBy("part").collect()
    )
    wanted: dict[int, list[int]] = {}
    before, total = {}, 0
    for i, span in enumerate(spans):
        before[i] = total
        for rank in ranks:
            if total <= rank < total + span["n"]:
                wanted.setdefault(i, []).append(rank)
        total += span["n"]
    missing = [r for r in ranks if not 0 <= r < total]
    if missing:
        raise ValueError(f"Ranks {missing} lie outside the {total} available values.")
    if not wanted:
        return []

    in_span, inside, hit = F.lit(None).cast("int"), F.lit(False), F.lit(False)
    below = F.sum("n").over(Window.partitionBy("span").orderBy("v")) - F.col("n")
    for i, rs in wanted.items():
        within = F.col("v").between(F.lit(spans[i]["lo"]), F.lit(spans[i]["hi"]))
        inside = inside | within
        in_span = F.when(within, F.lit(i)).otherwise(in_span)
        for r in rs:
            rest = F.lit(r - before[i])
            hit = hit | (
                (F.col("span") == i) & (F.col("below") <= rest) & (rest < F.col("below") + F.col("n"))
            )
    found = (
        counts.where(inside).withColumn("span", in_span).withColumn("below", below)
        .where(hit).select("v", "n", "span", "below").collect()
    )
    found = sorted((before[f["span"]] + f["below"], f["n"], f["v"]) for f in found)
    result = []
    for r in ranks:
        low, n, v = next(f for f in found if f[0] <= r < f[0] + f[1])
        result.append((v, low, n))
    return result


def _integers_at_ranks(rows: DataFrame, ranks: Sequence[int]) -> list[tuple]:
    """Radix selection among the bits in which the values differ at all."""
    total, low, high = rows.agg(F.count("v"), F.min("v"), F.max("v")).first()
    missing = [r for r in ranks if not 0 <= r < total]
    if missing:
        raise ValueError(f"Ranks {missing} lie outside the {total} available values.")
    bits = (high - low).bit_length() if ranks else 0
    if bits < 64:  # else the difference itself would pass 64 bits
        rows, start = rows.select((F.col("v") - F.lit(low)).alias("v")), low
    else:
        start = 0
    found = select_ranks(rows, [], lambda n: [F.lit(r) for r in ranks], bits).collect() if ranks else []
    by_rank = {r["rank"]: (r["v"] + start, r["below"], r["same"]) for r in found}
    return [by_rank[r] for r in ranks]


def grouped_values_at_ranks(df: DataFrame, value: Column, groups: list[str], ranks) -> DataFrame:
    """Per group the values at the 0-based ranks `ranks(n)`, a list of columns made from its size n.

    Returns groups, slot, rank, group_n, v, below, same. No group is ever held by one task: the work is
    spread by (group, value) and the ranges looked at again are as small as a shuffle partition.
    """
    keys = [F.col(f"g{i}") for i in range(len(groups))]
    names = [f"g{i}" for i in range(len(groups))]
    counts = (
        df.select(*[c(g).alias(n) for g, n in zip(groups, names)], value.alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy(*names, "v").agg(F.count(F.lit(1)).alias("n"))
    )
    spans = (
        counts.repartitionByRange(shuffle_width(df.sparkSession), *names, "v")
        .withColumn("part", F.spark_partition_id())
        .groupBy(*names, "part")
        .agg(F.sum("n").alias("span_n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    by_group = Window.partitionBy(*keys)
    slots = F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("group_n"))]))
    targets = (
        spans.withColumn("group_n", F.sum("span_n").over(by_group))
        .withColumn("start", F.sum("span_n").over(by_group.orderBy("lo")) - F.col("span_n"))
        .select("*", slots.alias("slot", "rank"))
        .where((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("span_n")))
        .select(*[k.alias(f"t_{n}") for k, n in zip(keys, names)], "slot", "rank", "group_n", "start", "lo", "hi")
    )
    targets = bounds.settle(targets)
    same_group = F.lit(True)
    for n in names:
        same_group = same_group & F.col(n).eqNullSafe(F.col(f"t_{n}"))
    run = Window.partitionBy(*names, "slot").orderBy("v")
    return (
        counts.join(targets, same_group & F.col("v").between(F.col("lo"), F.col("hi")))
        .withColumn("below", F.col("start") + F.sum("n").over(run) - F.col("n"))
        .where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("n")))
        .select(*[k.alias(g) for k, g in zip(keys, groups)], "slot", "rank", "group_n", "v", "below",
                F.col("n").alias("same"))
    )


def select_ranks(
    rows: DataFrame, keys: Sequence[str], ranks: Callable[[Column], list[Column]], bits: int = 64,
) -> DataFrame:
    """Per group the integers at the 0-based ranks `ranks(n)`, by radix selection.

    `rows` has the columns `keys` and `v`, a BIGINT that sorts as wanted (not negative and of at most `bits` bits
    if these are below 64). Returns keys, slot, rank, n (the group's size), v, below and same (rows smaller than
    and equal to v).

    The first pass counts the leading 16 bits, for all groups at once: at most 65536 counts a group, whatever
    its size, already summed in each task. Each later pass counts the next 16 bits of the rows in the cells that
    hold a wanted rank, or the whole values once these cells are small; a cell whose rows are all equal is not looked
    at again. Four passes are the most, nothing is estimated, and no step depends on how values are distributed or
    partitioned.
    """
    keys = list(keys)
    by_group = Window.partitionBy(*keys)
    digits = max(0, bits - DIGIT)
    counts = [F.count(F.lit(1)).alias("cell_n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    cells = rows.groupBy(*keys, F.shiftright("v", digits).alias("cell")).agg(*counts)
    slots = F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("n"))])).alias("slot", "rank")
    hits = (F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("cell_n"))
    found = (
        cells.withColumn("n", F.sum("cell_n").over(by_group))
        .withColumn("start", F.sum("cell_n").over(by_group.orderBy("cell")) - F.col("cell_n"))
        .select("*", slots).where(hits)
        .select(*keys, "slot", "rank", "n", F.col("cell").alias("prefix"), F.col("start").alias("below"),
                F.col("cell_n").alias("same"), "lo", "hi"))
    cell, known = [*keys, "prefix"], []
    while digits:
        largest, places, found, sure = _open_cells(found, cell)
        known.append(sure)
        if not largest:
            return reduce(DataFrame.unionByName, known)
        last, digits = digits, 0 if largest <= SMALL_CELL else max(0, digits - DIGIT)
        # Null-safe equality also for keys without nulls: plain equality would push null tests, with all of
        # the image's arithmetic in them, below the steps that compute it once.
        inside = attach(rows.withColumn("prefix", F.shiftright("v", last)), places, cell)
        cells = inside.groupBy(*cell, "before", F.shiftright("v", digits).alias("cell")).agg(*counts)
        run = Window.partitionBy(*cell).orderBy("cell")
        cells = cells.withColumn("start", F.col("before") + F.sum("cell_n").over(run) - F.col("cell_n"))
        found = (
            attach(cells.drop("before"), found.drop("below", "same", "lo", "hi"), cell).where(hits)
            .select(*keys, "slot", "rank", "n", F.col("cell").alias("prefix"), F.col("start").alias("below"),
                    F.col("cell_n").alias("same"), "lo", "hi"))
    return reduce(DataFrame.unionByName, [*known, found.withColumnRenamed("prefix", "v").drop("lo", "hi")])


def _open_cells(found: DataFrame, cell: list[str]) -> tuple[int, DataFrame, DataFrame, DataFrame]:
    """What one pass found, computed once: the largest open cell's rows, the distinct open cells with the rows before
    them, the ranks in them, and the ranks whose value is known as all rows of their cell are equal."""
    values = [*cell[:-1], "slot", "rank", "n", F.col("lo").alias("v"), "below", "same"]
    rows = bounds.small_rows(found)
    if rows is None:
        found = bounds.cut_lineage(found)
        sure, found = found.where("lo = hi").select(*values), found.where("lo < hi")
        places = found.select(*cell, F.col("below").alias("before")).distinct()
        return found.agg(F.max("same")).first()[0] or 0, places, found, sure
    spark, equal = found.sparkSession, pc.equal(rows["lo"], rows["hi"])
    sure = spark.createDataFrame(rows.filter(equal), found.schema).select(*values)
    rows = rows.filter(pc.invert(equal))
    places = rows.select([*cell, "below"]).group_by([*cell, "below"]).aggregate([]).rename_columns([*cell, "before"])
    largest = pc.max(rows["same"]).as_py() or 0
    return largest, F.broadcast(spark.createDataFrame(places)), F.broadcast(spark.createDataFrame(rows)), sure


def _spots(probs: Sequence[float]) -> Callable[[Column], list[Column]]:
    """The two ranks that each quantile lies between."""
    return lambda n: [f((n - 1) * F.lit(float(p))).cast("bigint") for p in probs for f in (F.floor, F.ceil)]


def _quantile_rows(rows: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Per group `q`, the array of its linearly interpolated quantiles; `rows` as in select_ranks, of order images."""
    shares = [F.lit(float(p)) for p in probs]
    spots = select_ranks(rows, keys, _spots(probs))
    spots = spots.withColumns({"j": F.expr("slot div 2"), "x": from_image(F.col("v"))})
    low = F.max(F.when(F.col("slot") % 2 == 0, F.col("x")))
    high = F.max(F.when(F.col("slot") % 2 == 1, F.col("x")))
    spot = (F.max("n") - 1) * F.get(F.array(*shares), F.col("j"))
    between = (F.ceil(spot) - spot) * low + (spot - F.floor(spot)) * high
    each = spots.groupBy(*keys, "j").agg(F.when(low == high, low).otherwise(between).alias("x"))
    return each.groupBy(*keys).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("j", "x"))), lambda s: s["x"]).alias("q"))


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact: bool = True
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns, as plain numbers."""
    if not exact:
        at = F.array(*[F.lit(float(p)) for p in probs])
        found = df.agg(*[
            F.percentile_approx(as_double(df, x), at, F.lit(10_000)).alias(f"q{i}")
            for i, x in enumerate(columns)
        ]).first()
        return {x: found[i] or [None] * len(probs) for i, x in enumerate(columns)}
    each = [F.struct(F.lit(i).alias("f"), as_double(df, x).alias("x")) for i, x in enumerate(columns)]
    narrow = bounds.across_cores(df.select(*[c(x) for x in columns]))
    rows = with_image(narrow.select(F.inline(F.array(*each))).where(F.col("x").isNotNull()), "x", "v")
    spots = select_ranks(rows, ["f"], _spots(probs)).select("f", "slot", "n", from_image(F.col("v")).alias("x")).collect()
    at = {(r["f"], r["slot"]): r["x"] for r in spots}
    sizes = {r["f"]: r["n"] for r in spots}

    def between(f: int, j: int) -> float | None:
        if f not in sizes:
            return None
        low, high, spot = at[f, 2 * j], at[f, 2 * j + 1], (sizes[f] - 1) * float(probs[j])
        return low if low == high else (math.ceil(spot) - spot) * low + (spot - math.floor(spot)) * high

    return {x: [between(i, j) for j in range(len(probs))] for i, x in enumerate(columns)}


def grouped_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], groups: list[str], exact: bool = True
) -> DataFrame:
    """One row per group with `q`, the array of its quantiles (null when it has no values)."""
    x = as_double(df, column)
    keys = [c(g) for g in groups]
    if not exact:
        at = F.array(*[F.lit(float(p)) for p in probs])
        return df.groupBy(*keys).agg(F.percentile_approx(x, at, F.lit(10_000)).alias("q"))
    names = [f"_k{i}" for i in range(len(groups))]
    rows = df.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], x.alias("_v"))
    found = _quantile_rows(with_image(rows.where(F.col("_v").isNotNull()), "_v", "v"), names, probs)
    everyone = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return attach(everyone, found, groups, names, how="left").select(*keys, "q")
