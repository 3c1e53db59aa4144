"""Written intermediate tables, stable names and the ASCII notion of white space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.plans.bounds import shared_dir, shuffle_width

ASCII_SPACE = b" \t\n\x0b\x0c\r"
"""The six characters that separate words."""

WORD = r"[^\x20\x09-\x0D]+"

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BATCH_BYTES = 12_000_000
"""Text that is worked on at once inside a task; a longer single text is a batch of its own."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder inside the one that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside are deleted when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, what: str) -> DataFrame:
    """Write `df` to the shared folder and read on from there.

    Cuts lineage for good: later stages need only the files, whichever executor is lost. So the shuffles
    behind them are dropped at once.
    """
    path = new_dir(df.sparkSession, what)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once per context."""
    context = spark.sparkContext
    if getattr(context, "_prepkit_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="prepkit-package-"), "prepkit_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._prepkit_shipped = True


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """`mapInArrow` with this package on the workers' path."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def col(name: str) -> Column:
    """A column by its plain name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def spare_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def width(df: DataFrame) -> int:
    return shuffle_width(df.sparkSession)


def slices(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds at most `limit` bytes of text, or one row."""
    ends = pc.cumulative_sum(pc.fill_null(pc.cast(pc.binary_length(batch[text]), pa.int64()), 0))
    ends, start = ends.to_numpy(zero_copy_only=False), 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
