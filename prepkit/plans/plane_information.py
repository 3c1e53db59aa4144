"""Nearest-neighbour mutual information between two numbers (Kraskov, Stögbauer, Grassberger, PRE 2004)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepkit.functions.numeric import digamma
from prepkit.functions.schema import as_double, c, present
from prepkit.plans.bounds import cut_lineage
from prepkit.plans.knn_information import NEIGHBOURS, count_inside, jittered, row_names, spreads
from prepkit.plans.ranges import running_count

CELL_ROWS = 1000
"""Points of a cell, which a task compares with each other."""

GUESTS = 50_000
"""Points of other cells that a task compares with a cell."""


def plane_information(
    df: DataFrame, target: str, features: Sequence[str], key_cols: Sequence[str] = (), seed: int = 42,
) -> list[float | None]:
    """One estimate (nats, at least 0) per feature: rows that miss the feature or the target stay out.

    Both numbers are standardised and given a tiny noise, as for classes. A point's reach is its distance to
    the third nearest point, the larger of both differences; the points closer than that along each number
    alone are counted by running counts. With no more than three points there is no estimate.
    """
    df = df.where(present(df, target))
    names = [*features, target]
    scales = spreads(df, names)
    named = row_names(df, names, key_cols)
    last = len(features)
    y = jittered(as_double(named, target), *scales[last], last, seed)
    each = [
        F.struct(F.lit(i).alias("f"), jittered(as_double(named, n), *scales[i], i, seed).alias("x"))
        for i, n in enumerate(features)]
    rows = named.select("rid", y.alias("y"), F.inline(F.array(*each))).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    points = cut_lineage(rows.select("f", "rid", "x", "y")).withColumn("id", F.monotonically_increasing_id())
    sizes = {r["f"]: r["n"] for r in points.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per feature
    enough = [f for f, n in sizes.items() if n > NEIGHBOURS]
    if not enough:
        return [None] * len(features)
    points = points.where(F.col("f").isin(enough)).drop("rid")
    reach = cut_lineage(third_neighbours(points, sizes))
    counts = []
    for v, far in (("x", "fx"), ("y", "fy")):
        value, end = F.col(v), F.col(far)
        # The neighbour that sets the reach lies exactly on one end of the open interval.
        on_it = F.abs(end - value) == F.col("r")
        ends = reach.select(
            "f", "id", F.lit(NEIGHBOURS).alias("k"),
            F.when(on_it & (end <= value), end).otherwise(value - F.col("r")).alias("lo"),
            F.when(on_it & (end > value), end).otherwise(value + F.col("r")).alias("hi"))
        line = points.select("f", "id", value.alias("x"))
        counts.append(count_inside(line, ends, sum(sizes.values())).groupBy("f").agg(F.avg(digamma(F.col("m").cast("double"))).alias("m")))
    one, two = ({r["f"]: r["m"] for r in part.collect()} for part in counts)
    row = df.sparkSession.range(1).select(
        digamma(F.lit(float(NEIGHBOURS))).alias("k"), *[digamma(F.lit(float(sizes[f]))).alias(f"n{f}") for f in enough]).first()
    return [max(0.0, row[f"n{i}"] + row["k"] - one[i] - two[i]) if i in enough else None for i in range(len(features))]


def _cells(points: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Points with the slab of x that they lie in and their cell of y inside it: about CELL_ROWS points each.

    By rank, so crowded values make small cells, not full ones, and no cell is nearly empty. A slab has about the
    square root of CELL_ROWS times the number of points.
    """
    n, slabs = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for f, size in sizes.items():
        n = F.when(F.col("f") == f, F.lit(size)).otherwise(n)
        slabs = F.when(F.col("f") == f, F.lit(max(1, round(math.sqrt(size / CELL_ROWS))))).otherwise(slabs)
    placed = running_count(points, "f", ["x", "id"], F.lit(True), "place", sum(sizes.values())).withColumns({"n": n, "slabs": slabs})
    placed = placed.withColumn("slab", F.expr("(place - 1) * slabs div n")).drop("place", "n", "slabs")
    slab = Window.partitionBy("f", "slab")
    size = F.count(F.lit(1)).over(slab)
    placed = placed.withColumns({"size": size, "at": F.row_number().over(slab.orderBy("y", "id")) - 1})
    placed = placed.withColumn("cells", F.greatest(F.round(F.col("size") / CELL_ROWS), F.lit(1)).cast("bigint"))
    return placed.withColumn("cell", F.expr("at * cells div size")).drop("size", "at", "cells")


def _comparer(k: int):
    """For query points the k nearest others of some points: distance and both coordinates, nearest first.

    Blocks of queries keep the memory bounded; missing neighbours are infinitely far. Made here, so that
    workers get it by value and need no copy of this package.
    """
    def nearest(host: tuple, query: tuple) -> np.ndarray:
        (x, y, ids), (qx, qy, qids) = host, query
        out = np.full((len(qx), k, 3), np.inf)
        if not len(x):
            return out.reshape(len(qx), 3 * k)
        rows = max(1, 2_000_000 // len(x))
        for a in range(0, len(qx), rows):
            b = slice(a, a + rows)
            gap = np.maximum(np.abs(x[None, :] - qx[b, None]), np.abs(y[None, :] - qy[b, None]))
            gap[ids[None, :] == qids[b, None]] = np.inf
            n = min(k, len(x))
            at = np.argpartition(gap, n - 1, axis=1)[:, :n]
            at = np.take_along_axis(at, np.argsort(np.take_along_axis(gap, at, 1), axis=1, kind="stable"), 1)
            out[b, :n] = np.stack([np.take_along_axis(gap, at, 1), x[at], y[at]], axis=2)
        return out.reshape(len(qx), 3 * k)

    return nearest


def third_neighbours(points: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(f, id, x, y, r, fx, fy): the distance of each point's third nearest one, and where that lies.

    First within its own cell, which bounds the distance. Then each point goes, as a guest, to the other cells
    that its square of that size touches, and only there: when these have answered, the third nearest is certain.
    A task compares one cell with its own points or with up to GUESTS of its guests.
    """
    key, k = ["f", "slab", "cell"], NEIGHBOURS
    cells = cut_lineage(_cells(points, sizes))
    names = [f"{n}{i}" for i in range(k) for n in ("d", "x", "y")]
    found = ", ".join(f"{n} double" for n in names)
    nearest = _comparer(k)

    def own(cell: pd.DataFrame) -> pd.DataFrame:
        all_of = tuple(cell[n].to_numpy() for n in ("x", "y", "id"))
        rows = cell[["f", "id", "x", "y", "slab", "cell"]].reset_index(drop=True)
        return pd.concat([rows, pd.DataFrame(nearest(all_of, all_of), columns=names)], axis=1)

    def host(cell: pd.DataFrame, guests: pd.DataFrame) -> pd.DataFrame:
        some = [tuple(t[n].to_numpy() for n in ("x", "y", "id")) for t in (cell, guests)]
        rows = guests[["f", "id"]].reset_index(drop=True)
        return pd.concat([rows, pd.DataFrame(nearest(*some), columns=names)], axis=1)

    first = cut_lineage(cells.groupBy(*key).applyInPandas(
        own, f"f int, id long, x double, y double, slab long, cell long, {found}"))
    guests = cut_lineage(_guests(first, cells))
    tables = guests.groupBy(*key).agg(F.expr(f"(count(1) - 1) div {GUESTS} + 1").alias("tables"))
    seated = guests.join(tables, key).withColumn("table", F.expr("pmod(xxhash64(id), tables)")).drop("tables")
    each_table = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tables") - 1))
    served = cells.join(tables, key).withColumn("table", each_table).drop("tables")
    at = [*key, "table"]
    answers = served.groupBy(*at).cogroup(seated.groupBy(*at)).applyInPandas(host, f"f int, id long, {found}")
    each = F.explode(F.array(*[
        F.struct(F.col(f"d{i}").alias("r"), F.col(f"x{i}").alias("fx"), F.col(f"y{i}").alias("fy")) for i in range(k)]))
    near = first.select("f", "id", *names).unionByName(answers).select("f", "id", each.alias("s"))
    third = near.where(F.col("s.r") < float("inf")).groupBy("f", "id").agg(
        F.get(F.sort_array(F.collect_list("s")), F.lit(k - 1)).alias("s"))
    return third.select("f", "id", "s.*").join(points.select("f", "id", "x", "y"), ["f", "id"])


def _steps_below(starts: DataFrame, asked: DataFrame, group: str) -> DataFrame:
    """Add to `asked` (group, v, ...) the number `step` of the last of the sorted `starts` (group, v) at or below v, from 0."""
    both = starts.select(group, "v", F.lit(0).alias("kind")).unionByName(
        asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    counted = running_count(both, group, ["v", "kind"], F.col("kind") == 0, "step").where("kind = 1").drop("kind")
    return counted.withColumn("step", F.greatest(F.col("step") - 1, F.lit(0).cast("bigint")))


def _guests(first: DataFrame, cells: DataFrame) -> DataFrame:
    """A row for every point and cell but its own that its square touches: f, slab, cell, id, x, y.

    The slabs between both ends of the square in x, and in each of them the cells between both ends in y: their
    numbers are looked up among the first values of slabs and cells by running counts.
    """
    reach = F.col(f"d{NEIGHBOURS - 1}")
    slabs = cells.groupBy("f", "slab").agg(F.min("x").alias("v"))
    home = [F.col("slab").alias("s0"), F.col("cell").alias("c0"), reach.alias("r")]
    ends = first.select("f", "id", "x", "y", *home, F.inline(F.array(
        F.struct(F.lit("lo").alias("end"), (F.col("x") - reach).alias("v")),
        F.struct(F.lit("hi").alias("end"), (F.col("x") + reach).alias("v")))))
    spans = _steps_below(slabs, ends, "f").groupBy("f", "id", "x", "y", "s0", "c0", "r").agg(
        F.min("step").alias("lo"), F.max("step").alias("hi"))
    spans = spans.withColumn("slab", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")

    # One column for (f, slab): a feature has fewer than 2^40 slabs.
    group = (F.col("f").cast("bigint") * (1 << 40) + F.col("slab")).alias("g")
    starts = cells.groupBy("f", "slab", "cell").agg(F.min("y").alias("v")).select(group, "v")
    ends = spans.select("*", group, F.inline(F.array(
        F.struct(F.lit("lo").alias("end"), (F.col("y") - F.col("r")).alias("v")),
        F.struct(F.lit("hi").alias("end"), (F.col("y") + F.col("r")).alias("v")))))
    touched = _steps_below(starts, ends, "g").groupBy("f", "id", "x", "y", "s0", "c0", "slab").agg(
        F.min("step").alias("lo"), F.max("step").alias("hi"))
    touched = touched.withColumn("cell", F.explode(F.sequence("lo", "hi")))
    return touched.where((F.col("slab") != F.col("s0")) | (F.col("cell") != F.col("c0"))).select(
        "f", "slab", "cell", "id", "x", "y")
