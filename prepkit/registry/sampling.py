"""Sampling and split queries: whole tables in, exact parts out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.operators import sample, split
from prepkit.registry import Query, on
from prepkit.registry.inputs import ORDERS_NULLS, orders_nulls

HASH = "md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42'))"


def quota(sizes: str, size: str, wanted: str, name: str) -> str:
    """Largest remainder shares of `wanted` over the classes g of `sizes`."""
    return f"""
(WITH f AS (SELECT *, {size}::DOUBLE * ({wanted}) / sum({size}) OVER () AS share FROM {sizes}),
      r AS (SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, g NULLS LAST) AS k,
                   ({wanted}) - sum(floor(share)) OVER () AS spare FROM f)
 SELECT * EXCLUDE (share, k, spare), (floor(share) + (k <= spare)::INTEGER)::BIGINT AS {name} FROM r)"""


CLASSES = "(SELECT o_orderstatus AS g, count(*) AS n FROM orders GROUP BY 1)"
TOTAL = "(SELECT count(*) FROM orders)"
N_TEST = f"(SELECT ceil(round(0.2 * {TOTAL}, 9))::BIGINT)"
N_VAL = f"(SELECT ceil(round(0.1::DOUBLE / 0.8::DOUBLE * ({TOTAL} - {N_TEST}), 9))::BIGINT)"
PER_CLASS = f"row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH})"

LINES = "(SELECT count(*) FROM lineitem)"
LINE_TEST = f"(SELECT ceil(round(0.2 * {LINES}, 9))::BIGINT)"
LINE_VAL = f"(SELECT ceil(round(0.1::DOUBLE / 0.8::DOUBLE * ({LINES} - {LINE_TEST}), 9))::BIGINT)"


def _parts_and_changes(df: DataFrame) -> DataFrame:
    """Rows of each part of a split whose keys repeat, and rows that are missing from or new in all parts together."""
    parts = split.train_val_test_split(df, key_cols="l_orderkey")
    whole = parts.select(*df.columns)
    changed = df.exceptAll(whole).select(F.lit("missing").alias("split")).unionByName(
        whole.exceptAll(df).select(F.lit("new").alias("split")))
    return parts.select("split").unionByName(changed).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES: dict[str, Query] = {
    "sample_random": on(
        "orders", lambda df: sample.random_sample(df, 0.3, key_cols="o_orderkey"),
        f"""SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (ORDER BY {HASH}) AS k FROM orders)
            WHERE k <= floor(0.3::DOUBLE * {TOTAL})"""),
    "sample_stratified": on(
        "orders", lambda df: sample.stratified_sample(df, "o_orderstatus", 0.3, key_cols="o_orderkey"),
        f"""WITH q AS {quota(CLASSES, 'n', f'floor(0.3::DOUBLE * {TOTAL})', 'quota')},
                 r AS (SELECT *, {PER_CLASS} AS k FROM orders)
            SELECT r.* EXCLUDE (k) FROM r JOIN q ON r.o_orderstatus = q.g WHERE k <= quota"""),
    "sample_balanced": on(
        "orders",
        lambda df: sample.class_balanced_sample(df, "o_orderpriority", per_class=700, key_cols="o_orderkey"),
        f"""SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
                PARTITION BY o_orderpriority ORDER BY {HASH}) AS k FROM orders) WHERE k <= 700"""),
    "sample_balanced_cap": on(
        "orders",
        lambda df: sample.class_balanced_sample(df, "o_orderstatus", max_total=1000, key_cols="o_orderkey"),
        f"SELECT * EXCLUDE (k) FROM (SELECT *, {PER_CLASS} AS k FROM orders) WHERE k <= 1000 // 3"),
    "sample_balanced_first": on(
        "orders",
        lambda df: sample.class_balanced_sample(
            df, "o_orderstatus", per_class=500, shuffle_within_class=False,
            key_cols=["o_orderdate", "o_orderkey"]),
        """SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
               PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k <= 500"""),
    "sample_clustered": on(
        "part",
        lambda df: sample.clustered_sample(df, 8, 3, use_features=["p_size", "p_retailprice"],
                                           key_cols="p_partkey")),
    "sample_clustered_one": on(
        "part",
        lambda df: sample.clustered_sample(df, 1, 25, use_features=["p_size", "p_retailprice"], key_cols="p_partkey"),
        """SELECT p.* FROM part p, (SELECT avg(p_size) AS s, avg(p_retailprice) AS r FROM part)
           ORDER BY (p_size - s) ** 2 + (p_retailprice - r) ** 2, p_partkey LIMIT 25"""),
    "sample_clustered_left_out": on(
        "orders", lambda df: sample.clustered_left_out(orders_nulls(df), ["o_custkey", "o_totalprice"]),
        f"SELECT count(*) AS n_rows, count(*) - count(o_totalprice) AS left_out FROM {ORDERS_NULLS}"),
    "sample_clustered_vectors": on(
        "embeddings",
        lambda df: sample.clustered_sample(df, 10, 2, use_features=["embedding"], key_cols="vec_id")
        .select("vec_id", "label")),
    "split_random": on(
        "orders", lambda df: split.train_val_test_split(df, key_cols="o_orderkey"),
        f"""SELECT * EXCLUDE (k), CASE WHEN k <= {N_TEST} THEN 'test' WHEN k <= {N_TEST} + {N_VAL} THEN 'val'
                   ELSE 'train' END AS split
            FROM (SELECT *, row_number() OVER (ORDER BY {HASH}) AS k FROM orders)"""),
    "split_stratified": on(
        "orders", lambda df: split.train_val_test_split(df, "o_orderstatus", key_cols="o_orderkey"),
        f"""WITH t AS {quota(CLASSES, 'n', N_TEST, 'n_test')},
                 q AS {quota('t', '(n - n_test)', N_VAL, 'n_val')},
                 r AS (SELECT *, {PER_CLASS} AS k FROM orders)
            SELECT r.* EXCLUDE (k), CASE WHEN k <= n_test THEN 'test' WHEN k <= n_test + n_val THEN 'val'
                   ELSE 'train' END AS split
            FROM r JOIN q ON r.o_orderstatus = q.g"""),
    "split_repeated_keys": on(
        "lineitem", _parts_and_changes,
        f"""SELECT 'test' AS split, {LINE_TEST} AS n_rows UNION ALL SELECT 'val', {LINE_VAL}
            UNION ALL SELECT 'train', {LINES} - {LINE_TEST} - {LINE_VAL}"""),
    "split_time": on(
        "events", lambda df: split.time_series_split(df, "ts", key_cols="event_id"),
        """WITH n AS (SELECT count(*) AS n, greatest(1, round_even(count(*) * 0.2::DOUBLE, 0))::BIGINT AS n_test
                      FROM events),
                m AS (SELECT *, round_even((n - n_test) * 0.1::DOUBLE, 0)::BIGINT AS n_val FROM n),
                r AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS k FROM events)
           SELECT r.* EXCLUDE (k), CASE WHEN k <= n - n_test - n_val THEN 'train' WHEN k <= n - n_test THEN 'val'
                  ELSE 'test' END AS split FROM r, m"""),
}
