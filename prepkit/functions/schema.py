"""Type predicates and argument checks. Nothing here starts a Spark job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def c(name: str) -> Column:
    """Reference a column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric_or_bool(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.BooleanType))


def numeric_columns(df: DataFrame, but: Iterable[str] = ()) -> list[str]:
    """Numeric columns in table order; booleans do not count."""
    skip = set(but)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def check_columns(df: DataFrame, names: Iterable[str], what: str = "Column") -> None:
    for name in names:
        if name not in df.columns:
            raise ValueError(f"{what} {name!r} is not in the table. Available columns: {df.columns}")


def check_numeric(df: DataFrame, name: str, what: str = "Column") -> None:
    check_columns(df, [name], what)
    if not is_numeric_or_bool(dtype(df, name)):
        raise ValueError(f"{what} '{name}' must be numeric.")


def check_choice(value: str, allowed: Iterable[str], what: str) -> None:
    allowed = sorted(allowed)
    if value not in allowed:
        raise ValueError(f"Unsupported {what} {value!r}: it can be one of {', '.join(allowed)}.")


def clean(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing (NaN and null are one notion here)."""
    if isinstance(dtype(df, name), (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c(name)), c(name))
    return c(name)


def present(df: DataFrame, name: str) -> Column:
    """Whether the value is there; written so that the null test reaches the scan."""
    if isinstance(dtype(df, name), (T.DoubleType, T.FloatType)):
        return c(name).isNotNull() & ~F.isnan(c(name))
    return c(name).isNotNull()


def as_double(df: DataFrame, name: str) -> Column:
    """A numeric or boolean column as DOUBLE, NaN read as missing."""
    dt = dtype(df, name)
    if isinstance(dt, T.BooleanType):
        return c(name).cast("int").cast("double")
    if isinstance(dt, T.DoubleType):
        return clean(df, name)
    return clean(df, name).cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every floating-point NaN in the table becomes null."""
    return df.select(*[clean(df, n).alias(n) for n in df.columns])


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def inline_rows(df: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn the one wide row of `df` into one row per struct in `rows`."""
    return df.select(F.inline(F.array(*rows)))
