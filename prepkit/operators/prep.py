"""Binning, one-hot encoding, missing values, column selection."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.naming import IF_EXISTS, free_name, resolve_name
from prepkit.functions.numeric import bin_labels, bin_number
from prepkit.functions.schema import (
    as_double, as_list, c, check_choice, check_columns, check_numeric, clean, dtype, present,
    text_columns,
)
from prepkit.operators.stats import value_counts
from prepkit.plans.order_stats import quantiles

STRATEGIES = ("equal_width", "equal_freq", "custom_edges")


def bin_edges(
    df: DataFrame, column: str, strategy: str, bins: int | None = None, q: int | None = None,
    edges: Sequence[float] | None = None, right: bool = True, exact: bool = True,
) -> list[float]:
    """The interval edges: a handful of numbers, found with one aggregate (none for custom edges)."""
    check_numeric(df, column)
    check_choice(strategy, STRATEGIES, "strategy")
    if strategy == "custom_edges":
        if not edges or len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
            raise ValueError("custom_edges needs at least two strictly increasing edges.")
        return [float(e) for e in edges]
    if strategy == "equal_freq":
        if q is None or q < 2:
            raise ValueError("equal_freq needs q >= 2.")
        cuts = quantiles(df, [column], [float(p) for p in np.linspace(0, 1, q + 1)], exact)[column]
        if cuts[0] is None:
            raise ValueError(f"Column '{column}' has no values to bin.")
        return sorted(set(cuts))
    if bins is None or bins < 2:
        raise ValueError("equal_width needs bins >= 2.")
    x = as_double(df, column)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        raise ValueError(f"Column '{column}' has no values to bin.")
    if lo == hi:
        pad = 0.001 * abs(lo) if lo != 0 else 0.001
        return [float(e) for e in np.linspace(lo - pad, hi + pad, bins + 1)]
    cuts = [float(e) for e in np.linspace(lo, hi, bins + 1)]
    pad = (hi - lo) * 0.001
    if right:
        cuts[0] -= pad
    else:
        cuts[-1] += pad
    return cuts


def discretize(
    df: DataFrame, column: str, strategy: str = "equal_width", bins: int | None = None,
    q: int | None = None, edges: Sequence[float] | None = None,
    labels: Sequence[str] | None = None, right: bool = True, include_lowest: bool = True,
    new_column: str | None = None, if_exists: str = "reuse", parts: bool = False,
    exact: bool = True,
) -> DataFrame:
    """Add a bin label column (default name `<column>_binned`); the source column stays.

    Missing values and values outside custom edges get no bin. `parts=True` also adds
    `<new>_id`, `<new>_lo` and `<new>_hi`. The result is a projection: no shuffle.
    """
    check_columns(df, [column])
    target = resolve_name(new_column or f"{column}_binned", df.columns, if_exists)
    if target is None:
        return df
    if strategy == "equal_freq":
        right, include_lowest = True, True
    cuts = bin_edges(df, column, strategy, bins, q, edges, right, exact)
    n_bins = len(cuts) - 1
    if labels is not None and len(labels) != n_bins:
        raise ValueError(f"{len(labels)} labels given for {n_bins} bins.")
    names = list(labels) if labels is not None else bin_labels(cuts, right, include_lowest)
    number = bin_number(as_double(df, column), cuts, right, include_lowest)

    def pick(values: Sequence, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col(at) - 1).cast(kind)

    at = free_name("bin_at", df.columns)
    added = {target: pick(names, "string")}
    if parts:
        added[f"{target}_id"] = F.col(at)
        added[f"{target}_lo"] = pick(cuts[:-1], "double")
        added[f"{target}_hi"] = pick(cuts[1:], "double")
    return df.withColumn(at, number).withColumns(added).drop(at)


def one_hot(
    df: DataFrame, column: str | None = None, columns: Sequence[str] | None = None,
    all_categoricals: bool = False, prefix: str | None = None, drop_first: bool = False,
    dtype: str = "tinyint", if_exists: str = "reuse", max_categories: int | None = None,
) -> DataFrame:
    """Add one 0/1 column per distinct value; missing is 0 everywhere, source columns stay.

    Columns that are not in the table are skipped with a warning. `max_categories`, if given, refuses columns with more
    values; `one_hot_sparse` encodes such a column as one vector column. A dummy column per value needs the
    list of values on the driver.
    """
    if all_categoricals:
        chosen = text_columns(df)
    elif columns is not None:
        chosen = list(columns)
    elif column is not None:
        chosen = [column]
    else:
        raise ValueError("Give column, columns or all_categoricals=True.")
    check_choice(if_exists, IF_EXISTS, "if_exists")
    unknown = [x for x in dict.fromkeys(chosen) if x not in df.columns]
    if unknown:
        warnings.warn(f"Not in the table and skipped: {unknown}", stacklevel=2)
    chosen = [x for x in dict.fromkeys(chosen) if x in df.columns]
    if not chosen:
        raise ValueError("None of the columns to encode is in the table.")
    values = _categories(df, chosen, max_categories)

    taken, made = list(df.columns), set()
    out: dict[str, Column] = {}
    for x in chosen:
        for v in values[x][1 if drop_first else 0:]:
            name = f"{prefix or x}_{v}"
            if name in made:
                raise ValueError(f"Prefix '{prefix}' gives two columns the name '{name}'.")
            made.add(name)
            target = resolve_name(name, taken, if_exists)
            if target is None:
                continue
            taken.append(target)
            out[target] = F.coalesce(clean(df, x) == F.lit(v), F.lit(False)).cast("int").cast(dtype)
    kept = [out.pop(n).alias(n) if n in out else c(n) for n in df.columns]
    return df.select(*kept, *[e.alias(n) for n, e in out.items()])


def _categories(df: DataFrame, columns: list[str], most: int | None) -> dict[str, list]:
    """Sorted distinct values; the output has a column for each, so they are as few as its columns."""
    if most is not None:
        counts = df.agg(*[F.count_distinct(clean(df, x)) for x in columns]).first()
        for x, n in zip(columns, counts):
            if n > most:
                raise ValueError(f"'{x}' has {n} values, more than {most}; see one_hot_sparse.")
    found = df.agg(*[F.sort_array(F.collect_set(clean(df, x))) for x in columns]).first()
    return dict(zip(columns, found))


def one_hot_sparse(df: DataFrame, columns: Sequence[str], drop_first: bool = False):
    """High-cardinality form: fit a model that adds a sparse vector `<column>_onehot` per column."""
    check_columns(df, columns)
    index = [free_name(f"{x}_index", df.columns) for x in columns]
    made = [free_name(f"{x}_onehot", df.columns) for x in columns]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(columns), outputCols=index, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=index, outputCols=made, dropLast=drop_first),
    ]).fit(df)


def clean_nulls(
    df: DataFrame, column: str, mode: str = "impute", numeric_strategy: str = "median",
    categorical_strategy: str = "most_frequent", constant_value: str = "Unknown",
    exact: bool = True,
) -> DataFrame:
    """Drop the rows missing in a column, or fill it; the fill value is one small aggregate."""
    check_columns(df, [column])
    check_choice(mode, ("drop_rows", "impute"), "mode")
    kind = dtype(df, column)
    value = clean(df, column)
    if mode == "drop_rows":
        return df.where(present(df, column))
    if isinstance(kind, T.NumericType):
        check_choice(numeric_strategy, ("median", "mean", "zero"), "numeric_strategy")
        if numeric_strategy == "zero":
            fill = F.lit(0).cast(kind)
        else:
            value = as_double(df, column)
            if numeric_strategy == "median":
                number = quantiles(df, [column], [0.5], exact)[column][0]
            else:
                number = df.agg(F.avg(value)).first()[0]
            fill = F.lit(number).cast("double")
    else:
        check_choice(categorical_strategy, ("most_frequent", "constant"), "categorical_strategy")
        top = None
        if categorical_strategy == "most_frequent":
            top = (
                value_counts(df, column).where(F.col("value").isNotNull())
                .orderBy(F.desc("count"), F.asc("value")).first()
            )
        if top is None and not isinstance(kind, T.StringType):
            value = value.cast("string")
        fill = F.lit(constant_value if top is None else top["value"])
    return df.withColumn(column, F.coalesce(value, fill))


def drop_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Remove columns; unknown names are ignored."""
    return df.drop(*as_list(columns))


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    check_columns(df, columns)
    return df.select(*[c(x) for x in dict.fromkeys(columns)])
