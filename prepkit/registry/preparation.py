"""Binning, encoding, missing-value and column queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from prepkit.operators import prep
from prepkit.registry import Query, on
from prepkit.registry.inputs import CUSTOMER_NULLS, ORDERS_NULLS, customer_nulls, orders_nulls, rounded

DECILES = [float(p) for p in np.linspace(0, 1, 11)]
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _parts(df, key: str, new: str):
    """Bins without their text: the key, the bin number and its edges."""
    kept = df.select(key, *[F.col(f"{new}_{p}").alias(f"bin_{p}") for p in ("id", "lo", "hi")])
    return rounded(kept, 6, "bin_lo", "bin_hi")


def _cut_sql(key: str, column: str, source: str, edges: str, right: bool, lowest: bool) -> str:
    compare = "<" if right else "<="
    inside = f"len(list_filter(e, lambda v: v {compare} x))"
    first = f"CASE WHEN x = e[1] THEN 1 ELSE {inside} END" if right and lowest else inside
    return f"""
WITH s AS (SELECT {edges} AS e FROM {source}),
     k AS (SELECT {key}, e, CAST({column} AS DOUBLE) AS x FROM {source}, s),
     b AS (SELECT {key}, e, CASE WHEN x IS NOT NULL THEN {first} END AS i FROM k),
     c AS (SELECT {key}, e, CASE WHEN i BETWEEN 1 AND len(e) - 1 THEN i END AS i FROM b)
SELECT {key}, i::INTEGER AS bin_id, round(e[i], 6) AS bin_lo, round(e[i + 1], 6) AS bin_hi FROM c"""


def _width_edges(column: str, bins: int, right: bool) -> str:
    lo, hi = f"min({column})::DOUBLE", f"max({column})::DOUBLE"
    pad = f"({hi} - {lo}) * 0.001"
    inner = f"list_transform(range(1, {bins}), lambda i: {lo} + i * (({hi} - {lo}) / {bins}))"
    left = f"{lo} - {pad}" if right else lo
    last = hi if right else f"{hi} + {pad}"
    return f"list_concat([{left}], {inner}, [{last}])"


def _dummies(column: str, values) -> str:
    return ", ".join(
        f"""coalesce({column} = '{v}', false)::TINYINT AS "{column}_{v}\"""" for v in values)


def _impute(column: str, table: str, key: str, fill: str) -> str:
    return f"SELECT {key}, {fill} AS {column} FROM {table}"


def _filled(column: str, key: str, nulls, **how):
    def run(df):
        out = prep.clean_nulls(nulls(df), column, **how).select(key, column)
        return rounded(out, 6, column) if column == "o_totalprice" else out
    return run


def _price(strategy: str, fill: str) -> Query:
    return on("orders", _filled("o_totalprice", "o_orderkey", orders_nulls, numeric_strategy=strategy),
              f"""SELECT o_orderkey, round(coalesce(o_totalprice, {fill}), 6) AS o_totalprice
                  FROM {ORDERS_NULLS}""")


QUERIES: dict[str, Query] = {
    "bin_equal_width": on(
        "orders",
        lambda df: _parts(prep.discretize(orders_nulls(df), "o_totalprice", bins=8, new_column="b", parts=True),
                          "o_orderkey", "b"),
        _cut_sql("o_orderkey", "o_totalprice", ORDERS_NULLS, _width_edges("o_totalprice", 8, True), True, True)),
    "bin_left_closed": on(
        "part",
        lambda df: _parts(prep.discretize(df, "p_size", bins=7, right=False, new_column="b", parts=True),
                          "p_partkey", "b"),
        _cut_sql("p_partkey", "p_size", "part", _width_edges("p_size", 7, False), False, True)),
    "bin_equal_freq": on(
        "part",
        lambda df: _parts(prep.discretize(df, "p_size", "equal_freq", q=10, new_column="b", parts=True),
                          "p_partkey", "b"),
        _cut_sql("p_partkey", "p_size", "part",
                 f"list_sort(list_distinct(quantile_cont(CAST(p_size AS DOUBLE), {DECILES})))", True, True)),
    "bin_custom_edges": on(
        "part",
        lambda df: _parts(prep.discretize(df, "p_retailprice", "custom_edges", edges=[900, 1000, 1500, 1800],
                                          new_column="b", parts=True), "p_partkey", "b"),
        _cut_sql("p_partkey", "p_retailprice", "part",
                 "any_value([900.0::DOUBLE, 1000.0::DOUBLE, 1500.0::DOUBLE, 1800.0::DOUBLE])", True, True)),
    "bin_labels": on(
        "part",
        lambda df: prep.discretize(df, "p_size", "custom_edges", edges=[0, 10, 25, 50],
                                   labels=["small", "middle", "large"]),
        """SELECT *, CASE WHEN p_size BETWEEN 0 AND 10 THEN 'small' WHEN p_size BETWEEN 11 AND 25 THEN 'middle'
                          WHEN p_size BETWEEN 26 AND 50 THEN 'large' END AS p_size_binned FROM part"""),
    "onehot_one": on(
        "customer", lambda df: prep.one_hot(customer_nulls(df), "c_mktsegment"),
        f"SELECT *, {_dummies('c_mktsegment', SEGMENTS)} FROM {CUSTOMER_NULLS}"),
    "onehot_many": on(
        "orders", lambda df: prep.one_hot(df, columns=["o_orderstatus", "o_orderpriority"]),
        f"""SELECT *, {_dummies('o_orderstatus', STATUSES)}, {_dummies('o_orderpriority', PRIORITIES)}
            FROM orders"""),
    "onehot_all_text": on(
        "orders", lambda df: prep.one_hot(df, all_categoricals=True),
        f"""SELECT *, {_dummies('o_orderstatus', STATUSES)}, {_dummies('o_orderpriority', PRIORITIES)}
            FROM orders"""),
    "onehot_drop_first": on(
        "orders", lambda df: prep.one_hot(df, "o_orderpriority", drop_first=True),
        f"SELECT *, {_dummies('o_orderpriority', PRIORITIES[1:])} FROM orders"),
    "drop_missing_rows": on(
        "orders", lambda df: prep.clean_nulls(orders_nulls(df), "o_totalprice", "drop_rows"),
        f"SELECT * FROM {ORDERS_NULLS} WHERE o_totalprice IS NOT NULL"),
    "impute_median": _price("median", f"(SELECT quantile_cont(o_totalprice, 0.5) FROM {ORDERS_NULLS})"),
    "impute_mean": _price("mean", f"(SELECT avg(o_totalprice) FROM {ORDERS_NULLS})"),
    "impute_zero": _price("zero", "0"),
    "impute_most_frequent": on(
        "customer", _filled("c_mktsegment", "c_custkey", customer_nulls),
        _impute("c_mktsegment", CUSTOMER_NULLS, "c_custkey", f"""coalesce(c_mktsegment, (
            SELECT c_mktsegment FROM {CUSTOMER_NULLS} WHERE c_mktsegment IS NOT NULL
            GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))""")),
    "impute_constant": on(
        "customer", _filled("c_mktsegment", "c_custkey", customer_nulls, categorical_strategy="constant"),
        _impute("c_mktsegment", CUSTOMER_NULLS, "c_custkey", "coalesce(c_mktsegment, 'Unknown')")),
    "drop_columns": on(
        "orders", lambda df: prep.drop_columns(df, ["o_custkey", "o_orderdate", "not_there"]),
        "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"),
    "project_columns": on(
        "orders", lambda df: prep.project_columns(df, ["o_orderstatus", "o_orderkey", "o_totalprice"]),
        "SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders"),
}
