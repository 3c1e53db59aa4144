"""Parquet tables, table versions, split folders, model folders and metric files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from prepkit.functions.schema import check_choice, check_columns, nan_to_null


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table with NaN read as missing."""
    return nan_to_null(spark.read.parquet(path))


def versions(spark: SparkSession, base: str) -> list[int]:
    """Finished versions under `base`, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = []
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith("v=") and name[2:].isdigit() and files.exists(done):
            found.append(int(name[2:]))
    return sorted(found)


def write_version(df: DataFrame, base: str, format: str = "parquet") -> str:
    """Write the working table as the next version and return its folder.

    A table is never written over the files it may still be read from.
    """
    check_choice(format, ("csv", "parquet"), "format")
    seen = versions(df.sparkSession, base)
    folder = f"{base}/v={(seen[-1] if seen else 0) + 1}"
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.csv(folder, header=True, quote='"', escape='"')
    else:
        writer.parquet(folder)
    return folder


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The latest, or a given, parquet version."""
    seen = versions(spark, base)
    if not seen or (version is not None and version not in seen):
        raise ValueError(f"Version {version or ''} not found under {base}. Available: {seen}")
    return read_table(spark, f"{base}/v={version or seen[-1]}")


def write_splits(df: DataFrame, path: str, split_column: str = "split") -> None:
    """One folder per part, so that reading one part skips the files of the others."""
    check_columns(df, [split_column])
    df.write.mode("overwrite").partitionBy(split_column).parquet(path)


def read_split(spark: SparkSession, path: str, part: str, split_column: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(f"`{split_column}` = '{part}'").drop(split_column)


def write_model(model: PipelineModel, folder: str) -> None:
    model.write().overwrite().save(folder)


def read_model(folder: str) -> PipelineModel:
    return PipelineModel.load(folder)


def write_metrics(metrics: DataFrame, folder: str) -> None:
    """A one-row table as JSON, missing metrics included."""
    metrics.coalesce(1).write.mode("overwrite").json(folder, ignoreNullFields=False)
