"""Delimited text: separator detection over a landing directory, scan with type inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions.schema import c
from prepkit.sources.quoted import read_quoted

# Texts read as missing, and the separators looked for.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
SEPARATORS = (",", ";", "\t", "|")

INTEGER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"


def detect_delimiters(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: the separator that occurs in every line, most evenly, then most often.

    Quoted stretches do not count; a file where none qualifies is comma-separated. Where a quote is left open at
    the end of a line, fields hold line breaks and some lines are no records: lines with an open quote do not
    count there, and the separator is the one with the largest share of lines that have it equally often.
    """
    lines = (
        spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
        .where(F.length(F.trim("value")) > 0)
        .withColumn("value", F.regexp_replace("value", '"[^"]*"', ""))
        .withColumn("open", F.col("value").contains('"'))
    )
    length = F.length("value")
    each = [
        F.struct(F.lit(i).alias("i"), (length - F.length(F.replace("value", F.lit(s)))).alias("n"))
        for i, s in enumerate(SEPARATORS)
    ]
    counts = lines.select("file", "open", F.inline(F.array(*each))).groupBy("file", "i", "n").agg(
        F.count_if(~F.col("open")).alias("lines"), F.max("open").alias("open"))
    n, times = F.col("n").cast("decimal(18,0)"), F.col("lines").cast("decimal(18,0)")
    rated = counts.groupBy("file", "i").agg(
        F.min(F.when(F.col("lines") > 0, F.col("n"))).alias("least"), F.max("open").alias("open"),
        F.max_by("n", F.struct("lines", "n")).alias("usual"), F.max("lines").alias("most"),
        F.sum(times).cast("double").alias("all"), F.sum(times * n).cast("double").alias("sum"),
        F.sum(times * n * n).cast("double").alias("squares"))
    even = F.struct(
        (F.col("squares") / F.col("all") - (F.col("sum") / F.col("all")) ** 2).alias("uneven"),
        (-F.col("sum") / F.col("all")).alias("often"), "i")
    usual = F.struct((-F.col("most") / F.col("all")).alias("uneven"), (-F.col("usual")).cast("double").alias("often"), "i")
    best = F.min(F.when(F.col("open") & (F.col("usual") > 0) & (F.col("all") > 0), usual).when(
        ~F.col("open") & (F.col("least") > 0), even))
    marks = F.array(*[F.lit(s) for s in SEPARATORS])
    return rated.groupBy("file").agg(best.alias("best")).select(
        "file", F.coalesce(F.get(marks, F.col("best.i")), F.lit(",")).alias("delimiter"))


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """The separator of a file, or the one most files of a directory use."""
    votes = detect_delimiters(spark, path).groupBy("delimiter").agg(F.count(F.lit(1)).alias("n"))
    found = votes.orderBy(F.desc("n"), "delimiter").first()
    return found["delimiter"] if found else ","


def read_delimited(
    spark: SparkSession, path: str, sep: str = ",", na_tokens: Sequence[str] = NA_TOKENS,
    infer: bool = True, multi_line: bool | None = None,
) -> DataFrame:
    """Headed delimited text; whole columns are typed as bigint, double, boolean or string.

    By default one pass over the lines looks for quotes left open at a line's end. Without any, files are split
    as usual; else fields hold line breaks, and files are read in ranges that are joined up where quotes are open.
    `multi_line` says it beforehand: False if no field holds line breaks, True to read each file in one task.
    """
    if multi_line is None and has_open_quotes(spark, path):
        raw = read_quoted(spark, path, sep)
    else:
        raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False, multiLine=bool(multi_line),
                             quote='"', escape='"')
    raw = raw.select(*[F.when(~c(n).isin(*na_tokens), c(n)).alias(n) for n in raw.columns])
    return infer_types(raw) if infer else raw


def has_open_quotes(spark: SparkSession, path: str) -> bool:
    """Whether any line holds an odd number of quotes, as the first line of a field with line breaks does."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def infer_types(raw: DataFrame) -> DataFrame:
    """Cast all-text columns by what all their values read as: one aggregate over all columns."""
    if not raw.columns:
        return raw

    def misfits(name: str) -> Column:
        x = c(name)
        whole = x.rlike(INTEGER) & F.expr(f"try_cast(`{name.replace('`', '``')}` as bigint)").isNotNull()
        return F.struct(
            F.count_if(x.isNotNull() & ~whole).alias("bigint"),
            F.count_if(~x.rlike(NUMBER)).alias("double"),
            F.count_if(~F.lower(x).isin("true", "false")).alias("boolean"),
            F.count(x).alias("n"),
        )

    found = raw.agg(*[misfits(n).alias(f"m{i}") for i, n in enumerate(raw.columns)]).first()
    out = []
    for i, n in enumerate(raw.columns):
        m = found[f"m{i}"]
        if m["n"] == 0:
            kind = "double"
        else:
            kind = next((k for k in ("bigint", "double", "boolean") if m[k] == 0), "string")
        x = F.trim(c(n)) if kind != "string" else c(n)
        out.append(x.cast(kind).alias(n))
    return raw.select(*out)
