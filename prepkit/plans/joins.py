"""Joining per-group helper tables back to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.functions.schema import c


def attach(
    df: DataFrame, table: DataFrame, groups: Sequence[str], keys: Sequence[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Add the other columns of a per-group table; missing keys match missing keys.

    `keys` are the table's names of `groups`. Without groups the table is one row, and its
    values become literals.
    """
    keys = list(groups if keys is None else keys)
    extra = [n for n in table.columns if n not in keys]
    if not keys:
        row = table.first()
        return df.withColumns({n: F.lit(row[n]).cast(table.schema[n].dataType) for n in extra})
    side = table.withColumnsRenamed({k: f"_t{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & c(g).eqNullSafe(F.col(f"_t{i}"))
    return df.join(side, same, how).drop(*[f"_t{i}" for i in range(len(keys))])
