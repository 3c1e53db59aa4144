"""Conversation and request tables: transcripts and repeat suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.functions.schema import as_list, c, check_columns
from prepkit.plans.neighbours import with_neighbour

LAST_PAIRS = 8


def last_transcript(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", pairs: int = LAST_PAIRS,
) -> DataFrame:
    """Per conversation its last question/answer pairs as one text, oldest first.

    A pair is a user row directly followed by an assistant row; other roles are left out.
    Only the last `pairs` rows per conversation survive each task, so collecting is bounded.
    """
    check_columns(df, [conversation, turn, role, text])
    said = df.where(c(role).isin("user", "assistant"))
    reply = with_neighbour(said, [conversation], [turn], F.struct(c(role), c(text)), "_reply", after=True)
    line = F.concat(F.lit("User: "), c(text), F.lit("\nAssistant: "), F.col("_reply")[text])
    newest = Window.partitionBy(c(conversation)).orderBy(F.desc(turn))
    return (
        reply.where((c(role) == "user") & (F.col("_reply")[role] == "assistant"))
        .select(c(conversation), c(turn).alias("_turn"), line.alias("_line"))
        .withColumn("_place", F.row_number().over(newest.orderBy(F.desc("_turn"))))
        .where(F.col("_place") <= pairs)
        .groupBy(c(conversation))
        .agg(F.sort_array(F.collect_list(F.struct("_turn", "_line"))).alias("_lines"))
        .select(
            c(conversation), F.size("_lines").cast("bigint").alias("pairs"),
            F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n\n").alias("transcript"),
        )
    )


def strip(text: Column) -> Column:
    """Cut white space of any kind at both ends; missing is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def fingerprint(request: Column, context: Column) -> Column:
    return F.sha2(F.concat(strip(request), F.lit("||"), strip(context)), 256)


def suppress_repeats(
    df: DataFrame, session: str | Sequence[str], order_by: str | Sequence[str], request: str,
    context: str | None = None, fingerprint_column: str = "fingerprint",
) -> DataFrame:
    """Drop rows whose request and context repeat those of the row before in their session."""
    keys, order = as_list(session), as_list(order_by)
    check_columns(df, [*keys, *order, request, *as_list(context)])
    mark = fingerprint(c(request).cast("string"), c(context).cast("string") if context else F.lit(""))
    rows = df.withColumn(fingerprint_column, mark)
    rows = with_neighbour(rows, keys, order, c(fingerprint_column), "_before")
    return rows.where(F.col("_before").isNull() | (F.col("_before") != c(fingerprint_column))).drop("_before")
