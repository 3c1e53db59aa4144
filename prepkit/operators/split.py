"""Train/validation/test splits as one extra column: random, stratified, chronological."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.schema import as_list, c, check_columns
from prepkit.operators.sample import class_sizes, share_out, total_quota
from prepkit.plans.bounds import settle
from prepkit.plans.cuts import label_by_hash, label_by_order, plain_order


def _ceil(x: float) -> int:
    """Ceiling that ignores the last bits of a product such as 0.1 / 0.8 * 80."""
    return math.ceil(round(x, 9))


def part_sizes(n: int, test_size: float, val_size: float) -> tuple[int, int]:
    """Rows for test, and for validation out of the rest; val_size is a share of everything."""
    n_test = _ceil(test_size * n)
    return n_test, _ceil(val_size / (1 - test_size) * (n - n_test))


def train_val_test_split(
    df: DataFrame, target: str | None = None, test_size: float = 0.2, val_size: float = 0.1,
    stratify: bool = True, random_state: int = 42, key_cols: str | Sequence[str] | None = None,
    split_column: str = "split",
) -> DataFrame:
    """Add `split` (train, val or test); stratified when a target is given and `stratify`."""
    if not 0 < test_size < 1 or not 0 <= val_size < 1:
        raise ValueError("test_size must lie in (0, 1) and val_size in [0, 1).")
    if test_size + val_size >= 1:
        raise ValueError("test_size + val_size must stay below 1.")
    if target is not None:
        check_columns(df, [target], "Target")
    labels, keys = ["test", "val", "train"], as_list(key_cols) or None
    if target is None or not stratify:
        n = df.count()
        n_test, n_val = part_sizes(n, test_size, val_size)
        quotas = total_quota(df, [n_test, n_test + n_val], n)
        return label_by_hash(df, [], keys, random_state, quotas, labels, split_column)
    sizes = settle(class_sizes(df, target))
    n_test, n_val = part_sizes(sizes.agg(F.sum("_n")).first()[0] or 0, test_size, val_size)
    quotas = share_out(sizes, n_test, F.col("_n"), "_cut0")
    quotas = share_out(quotas, n_val, F.col("_n") - F.col("_cut0"), "_val")
    quotas = settle(quotas.select("_g0", "_n", "_cut0", (F.col("_cut0") + F.col("_val")).alias("_cut1")))
    return label_by_hash(df, [target], keys, random_state, quotas, labels, split_column)


def time_series_split(
    df: DataFrame, time_column: str, test_size: float = 0.2, val_size: float = 0.1,
    key_cols: str | Sequence[str] | None = None, split_column: str = "split",
) -> DataFrame:
    """Add `split` by time: the last share is test, the share of the rest before it val.

    Text is parsed as a timestamp; rows without a readable time are left out.
    """
    check_columns(df, [time_column], "Time column")
    if not 0 < test_size < 1 or not 0 <= val_size < 1:
        raise ValueError("test_size must lie in (0, 1) and val_size in [0, 1).")
    keys = as_list(key_cols)
    check_columns(df, keys, "Key column")
    kind = df.schema[time_column].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        df = df.withColumn(time_column, F.try_to_timestamp(c(time_column).cast("string")))
    df = df.where(c(time_column).isNotNull())
    n = df.count()
    if n == 0:
        return df.withColumn(split_column, F.lit("train"))
    n_test = max(1, round(n * test_size))
    n_val = max(0, round((n - n_test) * val_size))
    n_train = n - n_test - n_val
    order = [plain_order(df, x) for x in [time_column, *keys]]
    return label_by_order(df, order, [n_train, n_train + n_val], n, ["train", "val", "test"], split_column)
