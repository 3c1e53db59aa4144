"""Nearest-neighbour mutual information between numbers and a class (Ross, PLoS ONE 2014)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.functions.numeric import digamma
from prepkit.functions.schema import as_double, c, clean, present
from prepkit.plans.cuts import CHUNK, whole_row_hash
from prepkit.plans.ranges import PART, dealt, gathered, running_count, with_halo

NEIGHBOURS = 3
JITTER = 1e-10


def row_names(df: DataFrame, columns: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """The given columns and `rid`, a text that tells rows apart and follows from their content alone.

    It is the key where there is one; else the digest of the row and the number of the copy, as equal rows are
    interchangeable. Copies are counted first and written out again in chunks, however many there are.
    """
    if key_cols:
        return df.select(*[c(n) for n in columns], F.concat_ws("|", *[c(k).cast("string") for k in key_cols]).alias("rid"))
    counted = df.select(*[c(n) for n in columns]).groupBy(*[c(n) for n in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    counted = counted.withColumn("_row", whole_row_hash(counted.drop("_copies")))
    chunks = counted.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"cast((_copies - 1) div {CHUNK} as int)"))))
    first = F.col("_chunk").cast("bigint") * CHUNK + 1
    copy = F.explode(F.sequence(first, F.least(first + CHUNK - 1, F.col("_copies")))).alias("_copy")
    named = chunks.repartition("_row", "_chunk").select(*[c(n) for n in columns], "_row", copy)
    return named.select(*[c(n) for n in columns], F.concat_ws("|", "_row", "_copy").alias("rid"))


def jittered(x: Column, scale: float, size: float, what: int, seed: int) -> Column:
    """x in units of its spread, with a tiny noise by which ties have an order: a uniform digest of row and seed."""
    digest = F.md5(F.concat_ws("|", "rid", F.lit(str(what)), F.lit(str(seed))))
    uniform = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / 2.0**52
    return x / scale + JITTER * max(1.0, size / scale) * (uniform * 2 - 1)


def spreads(df: DataFrame, names: Sequence[str]) -> list[tuple[float, float]]:
    """(standard deviation or 1, mean size) of each column."""
    xs = [as_double(df, n) for n in names]
    row = df.agg(*[e for x in xs for e in (F.stddev_pop(x), F.avg(F.abs(x)))]).first()
    return [(row[2 * i] or 1.0, row[2 * i + 1] or 0.0) for i in range(len(names))]


def nearest_neighbour_information(
    df: DataFrame, target: str, features: Sequence[str], key_cols: Sequence[str] = (), seed: int = 42,
) -> list[float | None]:
    """One estimate (nats, at least 0) per feature, from two range shuffles of (feature, class, value).

    Values are standardised by their spread and given a tiny noise so that ties have an order. The noise follows
    from the row's key, or from its content, so a recomputed task draws the same.
    """
    df = df.where(present(df, target))
    scales = spreads(df, features)
    named = row_names(df, list(dict.fromkeys([*features, target])), key_cols)
    each = [
        F.struct(F.lit(i).alias("f"), jittered(as_double(named, n), *scales[i], i, seed).alias("x"))
        for i, n in enumerate(features)]
    points = named.select(clean(named, target).alias("y"), "rid", F.inline(F.array(*each))).where(F.col("x").isNotNull())
    most = df.count() * len(features)
    points = dealt(points, ["f", "y", "x", "rid"], most).withColumn("id", F.monotonically_increasing_id())
    sizes = points.groupBy("f", "y").agg(F.count(F.lit(1)).alias("n_y"))
    alone = sizes.where(F.col("n_y") == 1).select(F.col("f").alias("f1"), F.col("y").alias("y1"))
    points = points.join(alone, (F.col("f") == F.col("f1")) & (F.col("y") == F.col("y1")), "left_anti")
    n_y = F.col("n_y").cast("double")
    labels = sizes.where(F.col("n_y") > 1).groupBy("f").agg(
        F.sum("n_y").alias("n"), (F.sum(n_y * digamma(n_y)) / F.sum(n_y)).alias("label"))
    inside = count_inside(points, _reach(points, most), most).groupBy("f").agg(
        F.avg(digamma(F.col("k").cast("double"))).alias("k"),
        F.avg(digamma(F.col("m").cast("double"))).alias("m"))
    total = digamma(F.col("n").cast("double")) + F.col("k") - F.col("label") - F.col("m")
    rows = labels.join(inside, "f").select("f", F.greatest(total, F.lit(0.0)).alias("mi")).collect()
    found = {r["f"]: r["mi"] for r in rows}
    return [found.get(i) for i in range(len(features))]


def _reach(points: DataFrame, n_points: int) -> DataFrame:
    """Per point the open interval that ends at its third nearest value of the same class."""
    k, x = NEIGHBOURS, F.col("x")
    order = Window.partitionBy("f", "y", PART).orderBy("x", "rid")
    others = [F.lag("x", i).over(order) for i in range(1, k + 1)]
    others += [F.lead("x", i).over(order) for i in range(1, k + 1)]
    near = F.array(*[F.struct(F.abs(o - x).alias("d"), o.alias("v")) for o in others])
    return (
        with_halo(points, ["f", "y"], ["x", "rid"], k, "halo", n_points).withColumn("near", near).where(~F.col("halo"))
        .withColumn("near", F.slice(F.sort_array(F.filter("near", lambda s: s["v"].isNotNull())), 1, k))
        .withColumn("k", F.size("near")).withColumn("far", F.element_at("near", -1))
        .select(
            "f", "id", "k",
            F.when(F.col("far.v") <= x, F.col("far.v")).otherwise(x - F.col("far.d")).alias("lo"),
            F.when(F.col("far.v") > x, F.col("far.v")).otherwise(x + F.col("far.d")).alias("hi"),
        )
    )


def count_inside(points: DataFrame, reach: DataFrame, n_points: int) -> DataFrame:
    """(f, id, k, m): how many points, of any class, lie strictly inside each point's interval.

    Points and interval ends are put in one order; a running count gives the points below each end.
    """
    ends = reach.select("f", "id", "k", F.inline(F.array(
        F.struct(F.col("lo").alias("x"), F.lit(2).alias("kind"), F.lit(-1).alias("sign")),
        F.struct(F.col("hi").alias("x"), F.lit(0).alias("kind"), F.lit(1).alias("sign")),
    )))
    # kind puts a point after the end of an interval at its own value and before its start.
    both = points.select("f", "x", F.lit(1).alias("kind")).unionByName(ends, allowMissingColumns=True)
    counted = running_count(both, "f", ["x", "kind"], F.col("kind") == 1, "below", 3 * n_points).where(F.col("kind") != 1)
    return gathered(counted.select("f", "id", "k", "sign", "below"), 2 * n_points, "f", "id").groupBy("f", "id").agg(F.max("k").alias("k"), F.sum(F.col("sign") * F.col("below")).alias("m"))
