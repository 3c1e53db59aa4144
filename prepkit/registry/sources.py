"""Text tables: delimited round trips, conversations and requests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import text
from prepkit.plans.bounds import shared_dir
from prepkit.registry import Query, on
from prepkit.sources import delimited, tables


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def _round_trip(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, _folder(df.sparkSession)
    quoted = df.withColumn("note", F.concat(F.lit('said "'), "c_mktsegment", F.lit('",\nthen left')))
    return delimited.read_delimited(spark, tables.write_version(quoted, folder, "csv"))


def _missing_trip(df: DataFrame) -> DataFrame:
    """A column of numbers and NA texts is a number column with gaps."""
    spark, folder = df.sparkSession, _folder(df.sparkSession)
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    df.select("o_orderkey", price.alias("price")).write.csv(folder, header=True, sep="|")
    return delimited.read_delimited(spark, folder, delimited.detect_delimiter(spark, folder))


def _delimiter(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, _folder(df.sparkSession)
    df.write.csv(folder, header=True, sep=";")
    return delimited.detect_delimiters(spark, folder).select("delimiter").distinct()


def _version(df: DataFrame) -> DataFrame:
    spark, base = df.sparkSession, _folder(df.sparkSession)
    tables.write_version(df, base)
    tables.write_version(tables.read_version(spark, base).drop("s_name"), base)
    return tables.read_version(spark, base)


def _one_part(df: DataFrame) -> DataFrame:
    from prepkit.operators.split import time_series_split

    spark, folder = df.sparkSession, _folder(df.sparkSession)
    tables.write_splits(time_series_split(df, "ts", key_cols="event_id"), folder)
    return tables.read_split(spark, folder, "val").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

QUERIES: dict[str, Query] = {
    "csv_round_trip": on(
        "customer", _round_trip,
        """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment,
                  concat('said "', c_mktsegment, '",', chr(10), 'then left') AS note FROM customer"""),
    "csv_missing_tokens": on(
        "orders", _missing_trip,
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders"),
    "detect_delimiter": on("customer", _delimiter, "SELECT DISTINCT ';' AS delimiter FROM customer"),
    "table_versions": on("supplier", _version, "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier"),
    "split_files": on(
        "events", _one_part,
        """WITH n AS (SELECT count(*) AS n, greatest(1, round_even(count(*) * 0.2::DOUBLE, 0))::BIGINT AS n_test
                      FROM events),
                m AS (SELECT *, round_even((n - n_test) * 0.1::DOUBLE, 0)::BIGINT AS n_val FROM n),
                r AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS k FROM events)
           SELECT event_type, count(*) AS n, min(ts) AS "first", max(ts) AS "last" FROM r, m
           WHERE k > n - n_test - n_val AND k <= n - n_test GROUP BY 1"""),
    "transcript_last_n": on(
        "conversations", text.last_transcript,
        """WITH s AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
                      FROM conversations WHERE role IN ('user', 'assistant')
                      WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
                p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k
                      FROM s WHERE role = 'user' AND next_role = 'assistant')
           SELECT conv_id, count(*) AS pairs,
                  string_agg('User: ' || text || chr(10) || 'Assistant: ' || next_text,
                             chr(10) || chr(10) ORDER BY turn) AS transcript
           FROM p WHERE k <= 8 GROUP BY conv_id"""),
    "suppress_repeats": on(
        "events", lambda df: text.suppress_repeats(df, "user_id", ["ts", "event_id"], "event_type"),
        f"""WITH f AS (SELECT *, sha256(concat({STRIP.format('event_type')}, '||', '')) AS fingerprint FROM events),
                 l AS (SELECT *, lag(fingerprint) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM f)
            SELECT * EXCLUDE (before) FROM l WHERE before IS NULL OR before <> fingerprint"""),
}
