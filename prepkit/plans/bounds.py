"""Size checks behind every broadcast, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_TABLE_ROWS = 50_000
"""Most rows a helper table may have to be pulled to the driver and broadcast."""

SMALL_TABLE_BYTES = 64 << 20
"""Most bytes of such a table: its rows may hold long texts."""

WINDOW_GROUP_ROWS = 20_000_000
"""Most rows of one group that a single task may sort, which can spill."""


TASK_ROWS = 10_000
"""Rows of a small table that are worth a task of their own before long work."""


LARGE_TASK_ROWS = 1_000_000
"""Rows of a task once there are more than FIT_TASKS of them."""


FIT_TASKS = 500


ROUND_TASKS = 23
"""As FIT_TASKS, for fits of hundreds of short rounds: each starts all its tasks anew, so these must be worth it."""


ROUND_TASK_ROWS = 250_000
"""Rows of a task of such a round once there are more than ROUND_TASKS of them."""


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only when `spark.checkpoint.dir` is unset, as in tests, a fresh local one is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share.")
    return tempfile.mkdtemp(prefix="prepkit-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_rows(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> pa.Table | None:
    """The rows of a helper table, if they are at most `limit` and SMALL_TABLE_BYTES; else None."""
    rows = df.limit(limit + 1).toArrow()
    return rows if rows.num_rows <= limit and rows.nbytes <= SMALL_TABLE_BYTES else None


def settle(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Compute a helper table once.

    Up to `limit` rows and SMALL_TABLE_BYTES it comes back as a broadcast-hinted local table; beyond
    that as a checkpointed one without a hint, so that joins with it shuffle instead.
    """
    rows = small_rows(df, limit)
    return cut_lineage(df) if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows))


def largest_group(df: DataFrame, groups: list[str]) -> int:
    """Row count of the biggest group; partial aggregation makes this cheap on hot keys."""
    from prepkit.functions.schema import c

    if not groups:
        return df.count()
    sizes = df.groupBy(*[c(g) for g in groups]).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


SMALL_INPUT_BYTES = 1 << 30
"""Tables of up to this size are dealt out anew before work that is worth more than the shuffle."""


def across_cores(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table out evenly, as its file may be a single split; large tables stay as they are.

    Looks at the planner's size estimate only: no job is run.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df if int(str(size)) > SMALL_INPUT_BYTES else df.repartition(shuffle_width(df.sparkSession))


def spread(df: DataFrame, n_rows: int, rounds: bool = False) -> DataFrame:
    """Deal rows out by their content, in an order that follows from it, before costly or iterative work.

    How many parts there are follows from the row count alone. So a fit that draws rows by partition and
    place gives one result, however the input was cut and whatever the cluster is. Columns must be hashable.
    `rounds` is for fits of many short passes over the rows (boosting, k-means, gradient steps): fewer, larger parts.
    Rows of a content that more than an eighth of a part have are counted before the shuffle, dealt out in
    chunks of that size and written out again there: no part is filled by copies.
    """
    from prepkit.functions.schema import c

    most, large = (ROUND_TASKS, ROUND_TASK_ROWS) if rounds else (FIT_TASKS, LARGE_TASK_ROWS)
    parts = 1 + max(min(n_rows // TASK_ROWS, most), n_rows // large)
    names = df.columns
    digest = F.xxhash64(*[c(n) for n in names])
    chunk = max(1, n_rows // (8 * parts))
    often = df.groupBy(digest.alias("often")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    often = settle(often.select("often"))
    if not often.head(1):
        return df.repartition(parts, digest).sortWithinPartitions(digest)
    rows = df.select(F.struct(*[c(n).alias(f"_c{i}") for i, n in enumerate(names)]).alias("row"), digest.alias("digest"))
    same = F.col("digest") == F.col("often")
    runs = rows.join(often, same, "left_semi").groupBy("row", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(chunk).cast("bigint")))
    runs = runs.withColumn("first", first).select(
        "row", "digest", "first", F.least(F.col("n") - F.col("first"), F.lit(chunk)).cast("int").alias("copies"))
    alone = rows.join(often, same, "left_anti").select("row", "digest", F.lit(0).cast("bigint").alias("first"), F.lit(1).alias("copies"))
    dealt = alone.unionByName(runs).repartition(parts, "digest", "first")
    each = dealt.select("row", "digest", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return each.sortWithinPartitions("digest").select(*[F.col("row")[f"_c{i}"].alias(n) for i, n in enumerate(names)])


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
