"""Shards by jump consistent hashing: no ring table, and an added shard takes rows only into itself."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.llm.order import ranked
from prepkit.llm.shared import col, ship

MULTIPLIER = 2862933555777941757
"""Fixed value: the published generator of jump hashing."""


def stable_key(key: Column) -> Column:
    """60 bits of the key's text, so that keys of any type and spacing spread alike; null is ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. A key's jumps only go up, so at most `shards` rounds are needed."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    shard = np.full(len(state), -1, np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        shard[open_] = at[open_]
        with np.errstate(over="ignore"):
            state[open_] = state[open_] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[open_] >> np.uint64(33)).astype(np.float64) + 1.0
        at[open_] = ((shard[open_] + 1) * (2.0**31 / draw)).astype(np.int64)
        open_ = open_[at[open_] < shards]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    if shards < 1:
        raise ValueError("there must be at least one shard")

    ship(SparkSession.active())

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards))

    return place(stable_key(key))


def shard(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """Add the shard (0 to shards - 1) that the key and the number of shards decide.

    Rows of equal keys share a shard; a null key counts as the empty text. A column named `out` is
    replaced, all others stay. No shuffle.
    """
    return df.withColumn(out, shard_of(col(key), shards))


def shard_manifest(df: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """Per row: key, size (UTF-8 bytes of the text plus 8), text_crc32, shard, slot, grown_shard.

    `slot` numbers a shard's rows from 0 without gaps, by key, checksum and size (null keys first);
    rows equal in all of these are interchangeable. `grown_shard` is the shard with one shard more:
    either the same or the new one. A null text counts as empty.
    """
    text_bytes = F.coalesce(col(text), F.lit("")).cast("binary")
    rows = df.select(
        col(key).alias(key),
        (F.octet_length(text_bytes).cast("long") + 8).alias("size"),
        F.crc32(text_bytes).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(col(key), shards).alias("shard"),
        shard_of(col(key), shards + 1).alias("grown_shard"),
    )
    return ranked(rows, ["shard"], [col(key), F.col("text_crc32"), F.col("size")], "slot")
