"""Records of delimited files whose quoted fields hold line breaks, read in byte ranges.

A line belongs to the record before it exactly if an odd number of quotes stands before it in its file. A
byte range cannot know that alone, but its own number of quotes can be added up: counts per range, a prefix
sum over a file's ranges, and a running count inside each range tell the state before every line. Records
that cross the end of a range are put together from the pieces of the ranges they touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepkit.plans.bounds import settle

RANGE = ["file", "block"]


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"')))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the byte its range begins at, and its place in the range."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        (_quotes("value") % 2).alias("odd"))


def _ranges(lines: DataFrame) -> DataFrame:
    """Per range: `inside`, whether it begins within quotes, and `heir`, the range and record that its first lines go on.

    One row per range, so a window over a file's ranges is small. A file that ends within quotes raises.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    sums = lines.groupBy(*RANGE).agg((F.sum("odd") % 2).alias("odd"))
    sums = sums.withColumn("inside", F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0)))
    never_closed = F.sum("odd").over(whole) % 2 == 1
    return settle(sums.select(*RANGE, F.when(never_closed, F.raise_error(F.concat(
        F.lit("A quote is left open at the end of "), F.col("file")))).otherwise(F.col("inside")).alias("inside")))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, record, text): every record of the files, header and blank ones included.

    `record` counts from 1 the records that begin in a byte range. The lines are shuffled once, by range, so
    no task holds more than a range and the records that begin in it, whatever the size of a file.
    """
    lines = _lines(spark, path)
    starts = _ranges(lines).select(F.col("file").alias("f"), F.col("block").alias("b"), "inside")
    placed = lines.join(starts, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).drop("f", "b")
    before = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    to_here = Window.partitionBy(*RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    goes_on = (F.col("inside") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2
    numbered = placed.withColumn("goes_on", goes_on).withColumn("record", F.sum(1 - F.col("goes_on")).over(to_here))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda s: s["line"]), "\n")
    pieces = numbered.groupBy(*RANGE, "record").agg(joined.alias("text"), (F.sum("odd") % 2).alias("odd"))

    # A piece is whole if it begins a record and closes its quotes; the others follow each other in the file.
    whole = pieces.where((F.col("record") > 0) & (F.col("odd") == 0)).select(*RANGE, "record", "text")
    parts = pieces.where((F.col("record") == 0) | (F.col("odd") == 1))
    along = Window.partitionBy("file").orderBy("block", "record")
    begins = F.when(F.col("record") > 0, F.struct("block", "record"))
    parts = parts.withColumn("owner", F.last(begins, ignorenulls=True).over(along))
    ends = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("block", "record", "text"))), lambda s: s["text"]), "\n")
    crossing = parts.groupBy("file", "owner").agg(ends.alias("text"))
    return whole.unionByName(crossing.select("file", "owner.block", "owner.record", "text"))


def read_quoted(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """All columns as text. Each file's first record is its header; blank records are no rows.

    A quote counts wherever it stands, also in the middle of a field that is not quoted.
    """
    names = spark.read.csv(path, sep=sep, header=True, inferSchema=False, multiLine=True, quote='"', escape='"').columns
    plain = [f"c{i}" for i in range(len(names))]
    found = records(spark, path).where((F.col("block") > 0) | (F.col("record") > 1))
    text = F.regexp_replace("text", "\r$", "")
    fields = F.from_csv(text, ", ".join(f"{n} string" for n in plain), {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"})
    rows = found.where(F.length(F.trim(text)) > 0).select(fields.alias("row"))
    return rows.select(*[F.col("row")[p].alias(n) for p, n in zip(plain, names, strict=True)])
