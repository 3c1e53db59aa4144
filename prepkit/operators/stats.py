"""Column description and single statistics, over the whole table or per group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions import numeric
from prepkit.functions.schema import (
    as_double, as_list, c, check_choice, check_columns, check_numeric, clean, dtype, present,
)
from prepkit.plans.order_stats import grouped_quantiles, quantiles

NUMBER_STATS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "skew": numeric.sample_skew,
    "kurtosis": numeric.sample_kurtosis,
}
ANY_STATS: dict[str, Callable[[Column], Column]] = {
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "nunique": F.count_distinct,
}
STATS = (*NUMBER_STATS, *ANY_STATS, "median", "mode", "sum")

MAX_TEXT_CHARS = 1_000_000_000
"""A concatenation longer than this cannot be one Spark string value."""


def compute_statistic(
    df: DataFrame,
    column: str,
    stat: str,
    dropna: bool = True,
    groupby: str | Sequence[str] | None = None,
    exact: bool = True,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """One statistic of one column: a row, or a row per group (missing keys are a group).

    `mode` gives a row per modal value, ascending. `dropna=False` matters to `median`
    (null when anything is missing) and `mode` (missing counts as a value). `sum` over text
    concatenates in `order_by` order. `exact=False` takes sketches for `median` and `nunique`.
    """
    groups = as_list(groupby)
    stat = stat.lower()
    check_columns(df, [column])
    check_choice(stat, STATS, "stat")
    check_columns(df, groups, "Group-by column")
    keys = [c(g) for g in groups]
    if stat == "mode":
        return _modes(df, column, dropna, groups)
    if stat == "sum" and isinstance(dtype(df, column), T.StringType):
        return _joined_text(df, column, groups, as_list(order_by))
    if stat == "nunique" and not exact:
        return df.groupBy(*keys).agg(F.approx_count_distinct(clean(df, column)).alias(stat))
    if stat in ANY_STATS:
        return df.groupBy(*keys).agg(ANY_STATS[stat](clean(df, column)).alias(stat))
    check_numeric(df, column)
    if stat == "median":
        return _median(df, column, dropna, groups, exact)
    if stat == "sum":
        return df.groupBy(*keys).agg(_total(df, column).alias("sum"))
    return df.groupBy(*keys).agg(NUMBER_STATS[stat](as_double(df, column)).alias(stat))


def _total(df: DataFrame, column: str) -> Column:
    whole = isinstance(dtype(df, column), (T.IntegralType, T.BooleanType))
    x = c(column).cast("bigint") if whole else as_double(df, column)
    return F.coalesce(F.sum(x), F.lit(0 if whole else 0.0))


def _median(df: DataFrame, column: str, dropna: bool, groups: list[str], exact: bool) -> DataFrame:
    x = as_double(df, column)
    if not groups:
        if exact:
            middle = F.lit(quantiles(df, [column], [0.5])[column][0]).cast("double")
        else:
            middle = F.percentile_approx(x, 0.5, 10_000)
        if not dropna:
            middle = F.when(F.count(F.lit(1)) == F.count(x), middle)
        return df.agg(middle.alias("median"))
    found = grouped_quantiles(df, column, [0.5], groups, exact)
    if dropna:
        return found.select(*[c(g) for g in groups], F.col("q")[0].alias("median"))
    gaps = df.groupBy(*[c(g) for g in groups]).agg(
        (F.count(F.lit(1)) > F.count(x)).alias("has_gap")
    ).select(*[c(g).alias(f"k{i}") for i, g in enumerate(groups)], "has_gap")
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & c(g).eqNullSafe(F.col(f"k{i}"))
    return found.join(gaps, same).select(
        *[c(g) for g in groups], F.when(~F.col("has_gap"), F.col("q")[0]).alias("median")
    )


def _modes(df: DataFrame, column: str, dropna: bool, groups: list[str]) -> DataFrame:
    names = [f"g{i}" for i in range(len(groups))]
    counts = df.where(present(df, column)) if dropna else df
    counts = counts.select(*[c(g).alias(n) for g, n in zip(groups, names)], clean(df, column).alias("mode"))
    counts = counts.groupBy(*names, "mode").agg(F.count(F.lit(1)).alias("n"))
    if not groups:
        most = counts.agg(F.max("n")).scalar()
        return counts.where(F.col("n") == most).select("mode").orderBy(F.asc_nulls_last("mode"))
    most = counts.groupBy(*[F.col(n).alias(f"m_{n}") for n in names]).agg(F.max("n").alias("most"))
    same = F.col("n") == F.col("most")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"m_{n}"))
    return counts.join(most, same).select(*[F.col(n).alias(g) for n, g in zip(names, groups)], "mode")


def _joined_text(df: DataFrame, column: str, groups: list[str], order_by: list[str]) -> DataFrame:
    """Concatenation is one value per group, so it is refused where no value could hold it."""
    if not order_by:
        raise ValueError("sum over text needs order_by: rows of a DataFrame have no order.")
    check_columns(df, order_by, "Order column")
    keys = [c(g) for g in groups]
    longest = (
        df.groupBy(*keys).agg(F.sum(F.length(c(column)).cast("bigint")).alias("chars"))
        .agg(F.max("chars")).first()[0]
    )
    if (longest or 0) > MAX_TEXT_CHARS:
        raise ValueError(f"The joined text would have {longest} characters, beyond one string value.")
    order = ", ".join(f"`{o}`" for o in order_by)
    joined = F.expr(f"listagg(`{column}`) within group (order by {order})")
    return df.groupBy(*keys).agg(F.coalesce(joined, F.lit("")).alias("sum"))


def describe_feature(
    df: DataFrame, column: str, percentiles: Sequence[float] | None = None, exact: bool = True
) -> DataFrame:
    """One row: count, mean, std, min, percentiles, max of numbers; count, unique, top, freq of the rest.

    Given percentiles replace 25 and 75 %; 50 % is always there.
    """
    check_columns(df, [column])
    if not isinstance(dtype(df, column), T.NumericType):
        return _describe_values(df, column)
    probs = sorted({*(percentiles or (0.25, 0.75)), 0.5})
    if not all(0 <= p <= 1 for p in probs):
        raise ValueError("percentiles must lie in [0, 1].")
    x = as_double(df, column)
    cuts = F.array(*[F.lit(v).cast("double") for v in quantiles(df, [column], probs, exact)[column]])
    return df.agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"), cuts.alias("q"),
    ).select(
        "count", "mean", "std", "min",
        *[F.col("q")[i].alias(percent_name(p)) for i, p in enumerate(probs)],
        "max",
    )


def percent_name(p: float) -> str:
    return f"p{round(p * 100, 10):g}"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    check_columns(df, [column])
    return df.groupBy(clean(df, column).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def _describe_values(df: DataFrame, column: str) -> DataFrame:
    seen = value_counts(df, column).where(F.col("value").isNotNull())
    first = F.min(F.struct((-F.col("count")).alias("less"), F.col("value").alias("value")))
    return seen.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("count"),
        F.count(F.lit(1)).alias("unique"),
        first["value"].alias("top"),
        F.max("count").alias("freq"),
    )


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values, missing included; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n)
