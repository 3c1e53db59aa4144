"""Numeric column expressions: guarded moments, correlation, bins, digamma."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_skew(x: Column) -> Column:
    """Bias-corrected skewness: null below three values, 0 on a constant."""
    n = F.count(x).cast("double")
    g1 = F.skewness(x) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n < 3, None).when(F.min(x) == F.max(x), 0.0).otherwise(g1)


def sample_kurtosis(x: Column) -> Column:
    """Bias-corrected excess kurtosis: null below four values, 0 on a constant."""
    n = F.count(x).cast("double")
    scale = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0))
    g2 = scale * ((n + 1) * F.kurtosis(x) + 6)
    return F.when(n < 4, None).when(F.min(x) == F.max(x), 0.0).otherwise(g2)


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over the pairwise complete rows; null when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    spread = F.nullif(F.stddev_pop(px) * F.stddev_pop(py), F.lit(0.0))
    return F.covar_pop(px, py) / spread


def _search(x: Column, edges: Sequence[float], passed: Callable[[int], Column], leaf: Callable[[int], Column]) -> Column:
    """A balanced tree of CASE branches: log2(n) comparisons a row, all in generated code.

    A higher-order function over an array of edges would leave generated code.
    """
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return leaf(lo)
        mid = (lo + hi) // 2
        return F.when(passed(mid), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.when(x.isNotNull(), tree(0, len(edges)))


def count_below(x: Column, edges: Sequence[float]) -> Column:
    """How many of the sorted `edges` are below x; null when x is missing."""
    return _search(x, edges, lambda i: x > F.lit(float(edges[i])), F.lit)


def bin_number(x: Column, edges: Sequence[float], right: bool, lowest: bool) -> Column:
    """1-based number of the bin holding x; null when x is missing or outside."""
    def passed(i: int) -> Column:
        closed_left = not right or (lowest and i == 0)
        return x >= F.lit(float(edges[i])) if closed_left else x > F.lit(float(edges[i]))

    def leaf(k: int) -> Column:
        return F.lit(k if 1 <= k < len(edges) else None).cast("int")

    return _search(x, edges, passed, leaf)


def with_image(rows: DataFrame, x: str, into: str) -> DataFrame:
    """`rows` without the DOUBLE column `x` but with its order image, a BIGINT that sorts as x does.

    The image is the double's bits with its sign, and one zero; null and NaN give null. Step by step, as
    each step is used several times and must be computed once.
    """
    others = [n for n in rows.columns if n != x]
    x, a, near, power = F.col(x), F.col("_size"), F.col("_near"), F.col("_power")
    finite = F.when((a > 0) & (a < float("inf")), a)
    # The logarithm may round over a power of two, to either side; below the least one all share a unit.
    scale = F.greatest(F.when(finite < power, near - 1).when(finite >= power * 2, near + 1).otherwise(near), F.lit(-1022))
    unit = F.pow(F.lit(2.0), (F.col("_scale") - 52).cast("double"))
    image = (F.col("_scale") + 1022).cast("bigint") * (1 << 52) + (a / unit).cast("bigint")
    image = F.when(a == 0, F.lit(0).cast("bigint")).when(a == float("inf"), F.lit(2047 << 52)).when(a > 0, image)
    return (
        rows.select(*others, x.alias("_x"), F.when(~F.isnan(x), F.abs(x)).alias("_size"))
        .withColumn("_near", F.floor(F.log2(finite)).cast("int"))
        .withColumn("_power", F.pow(F.lit(2.0), near.cast("double")))
        .withColumn("_scale", scale).withColumn("_image", image)
        .select(*others, F.when(F.col("_x") < 0, -F.col("_image")).otherwise(F.col("_image")).alias(into)))


def from_image(image: Column) -> Column:
    """The DOUBLE of an order image."""
    size = F.abs(image)
    scale, digits = F.shiftright(size, 52), size.bitwiseAND((1 << 52) - 1)
    whole = F.when(scale == 0, digits).otherwise(digits + (1 << 52)).cast("double")
    value = whole * F.pow(F.lit(2.0), (F.greatest(scale, F.lit(1)) - 1075).cast("double"))
    value = F.when(size == 2047 << 52, float("inf")).otherwise(value)
    return F.when(image < 0, -value).otherwise(value)


def digamma(x: Column) -> Column:
    """Digamma for x >= 1: seven recurrence steps, then the asymptotic series."""
    shift = sum((F.lit(1.0) / (x + i) for i in range(7)), F.lit(0.0))
    z = x + 7.0
    z2 = 1.0 / (z * z)
    series = F.ln(z) - 0.5 / z - z2 * (1 / 12 - z2 * (1 / 120 - z2 * (1 / 252 - z2 / 240)))
    return series - shift


def bin_labels(edges: Sequence[float], right: bool, lowest: bool) -> list[str]:
    """Interval texts such as '(-0.011, 2.5]': three significant decimals, more if they clash."""
    def shorten(v: float, digits: int) -> float:
        if v == 0 or not math.isfinite(v):
            return v
        whole = math.trunc(v)
        if whole == 0:
            digits += -math.floor(math.log10(abs(v))) - 1
        return float(np.around(v, digits))

    digits = next(
        (d for d in range(3, 20) if len({shorten(e, d) for e in edges}) == len(edges)), 3
    )
    marks = [float(shorten(e, digits)) for e in edges]
    if right and lowest:
        marks[0] -= 10.0 ** -digits
    left, close = ("(", "]") if right else ("[", ")")
    return [f"{left}{a}, {b}{close}" for a, b in zip(marks, marks[1:])]
