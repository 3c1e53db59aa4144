"""Feature selection queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from prepkit.operators import select
from prepkit.registry import Query, on
from prepkit.registry.inputs import ORDERS_NULLS, orders_nulls, rounded, ruled

NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax")
PRICE, FLAG = "l_extendedprice", "l_returnflag"
DECILES = [float(p) for p in np.linspace(0, 1, 11)]


def _ranked(parts: list[str], chosen: str, digits: int = 8) -> str:
    """Score rows of each feature, in table order, ranked: best first, ties to the later column."""
    union = " UNION ALL ".join(f"SELECT {i} AS place, q.* FROM ({p}) q" for i, p in enumerate(parts))
    return f"""
WITH s AS ({union}),
     r AS (SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, place DESC) AS k FROM s)
SELECT feature, round(score, {digits}) AS score, k::INTEGER AS rank, {chosen} AS selected FROM r"""


def _f_class(f: str) -> str:
    return f"""
WITH g AS (SELECT count({f}) AS n, avg({f}::DOUBLE) AS m, var_pop({f}::DOUBLE) AS v FROM lineitem GROUP BY {FLAG}),
     t AS (SELECT sum(n) AS total, count(*) AS k, sum(n * m) / sum(n) AS mean FROM g)
SELECT '{f}' AS feature,
       sum(n * (m - mean) ** 2) / (any_value(k) - 1) / (sum(n * v) / (any_value(total) - any_value(k))) AS score
FROM g, t"""


def _r(f: str) -> str:
    a, b = f"{f}::DOUBLE", f"{PRICE}::DOUBLE"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


def _f_line(f: str) -> str:
    return f"""SELECT '{f}' AS feature, coalesce(r * r / (1 - r * r) * (n - 2), 0) AS score
FROM (SELECT {_r(f)} AS r, count(*) AS n FROM lineitem)"""


def _information(f: str, y: str, binned_y: bool) -> str:
    def edges(x):
        return f"list_sort(list_distinct(quantile_cont({x}::DOUBLE, {DECILES})))"

    def cell(x, e):
        return f"greatest(len(list_filter({e}, lambda v: v < {x}::DOUBLE)), 1)"

    target = cell(y, "ey") if binned_y else y
    return f"""
WITH e AS (SELECT {edges(f)} AS ex{', ' + edges(y) + ' AS ey' if binned_y else ''} FROM lineitem),
     c AS (SELECT {cell(f, 'ex')} AS x, {target} AS y, count(*)::DOUBLE AS n FROM lineitem, e GROUP BY 1, 2),
     p AS (SELECT n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny,
                  sum(n) OVER () AS total FROM c)
SELECT '{f}' AS feature, greatest(sum(n / total * ln(n * total / (nx * ny))), 0) AS score FROM p"""


def _noisy(x: str, what: int, key: str) -> str:
    """x in units of its spread with the noise that breaks ties, over the one row of spreads `s`."""
    uniform = f"('0x' || substr(md5({key} || '|{what}|42'), 1, 13))::BIGINT::DOUBLE / 4503599627370496"
    return f"{x}::DOUBLE / s.d{what} + 1e-10 * greatest(1.0, s.m{what} / s.d{what}) * ({uniform} * 2 - 1)"


def _spreads(names: dict[int, str], table: str) -> str:
    each = ", ".join(f"stddev_pop({x}::DOUBLE) AS d{i}, avg(abs({x}::DOUBLE)) AS m{i}" for i, x in names.items())
    return f"SELECT {each} FROM {table}"


def _digamma(table: str) -> str:
    """At whole numbers n: a harmonic number less Euler's constant."""
    return f"""SELECT i AS n, coalesce(sum(1.0::DOUBLE / i) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                      - 0.5772156649015329 AS psi FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM {table}))) AS i)"""


def _knn_class(i: int, f: str, y: str, key: str, table: str) -> str:
    others = ", ".join(f"{{'d': abs({o}(x, {n}) OVER w - x), 'v': {o}(x, {n}) OVER w}}" for o in ("lag", "lead") for n in (1, 2, 3))
    return f"""
WITH s AS ({_spreads({i: f}, table)}), psi AS ({_digamma(table)}),
     p AS (SELECT row_number() OVER () AS id, {y} AS y, count(*) OVER (PARTITION BY {y}) AS n_y, {_noisy(f, i, key)} AS x FROM {table}, s),
     known AS (SELECT * FROM p WHERE n_y > 1),
     near AS (SELECT id, x, list_sort(list_filter([{others}], lambda o: o.v IS NOT NULL))[1:3] AS near
              FROM known WINDOW w AS (PARTITION BY y ORDER BY x)),
     far AS (SELECT id, x, len(near) AS k, near[len(near)] AS far FROM near),
     ends AS (SELECT NULL AS id, x, 1 AS kind, 0 AS sign FROM known
              UNION ALL SELECT id, CASE WHEN far.v <= x THEN far.v ELSE x - far.d END, 2, -1 FROM far
              UNION ALL SELECT id, CASE WHEN far.v > x THEN far.v ELSE x + far.d END, 0, 1 FROM far),
     below AS (SELECT id, sign * sum((kind = 1)::INT) OVER (ORDER BY x, kind ROWS UNBOUNDED PRECEDING) AS b FROM ends),
     inside AS (SELECT id, sum(b) AS m FROM below WHERE id IS NOT NULL GROUP BY id),
     rows AS (SELECT k, n_y, m, count(*) OVER () AS n FROM known JOIN far USING (id) JOIN inside USING (id))
SELECT '{f}' AS feature, greatest(any_value(a.psi) + avg(b.psi) - avg(c.psi) - avg(d.psi), 0) AS score
FROM rows JOIN psi a ON a.n = rows.n JOIN psi b ON b.n = k JOIN psi c ON c.n = n_y JOIN psi d ON d.n = m"""


def _knn_plane(i: int, f: str, j: int, y: str, key: str, table: str) -> str:
    return f"""
WITH s AS ({_spreads({i: f, j: y}, table)}), psi AS ({_digamma(table)}),
     p AS MATERIALIZED (SELECT {key} AS id, {_noisy(f, i, key)} AS x, {_noisy(y, j, key)} AS y FROM {table}, s),
     gaps AS MATERIALIZED (SELECT a.id, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy FROM p a JOIN p b ON a.id <> b.id),
     third AS (SELECT id, min(greatest(dx, dy), 3)[3] AS r FROM gaps GROUP BY id),
     near AS (SELECT id, 1 + count(*) FILTER (dx < r) AS nx, 1 + count(*) FILTER (dy < r) AS ny FROM gaps JOIN third USING (id) GROUP BY id)
SELECT '{f}' AS feature, greatest((SELECT psi FROM psi WHERE n = (SELECT count(*) FROM p)) + (SELECT psi FROM psi WHERE n = 3)
                                  - avg(a.psi) - avg(b.psi), 0) AS score
FROM near JOIN psi a ON a.n = nx JOIN psi b ON b.n = ny"""


def _best(scoring: str, target: str, k: int = 3):
    return lambda df: rounded(select.select_kbest(df, target, k, scoring).scores, 8, "score")


def _with_constant(df):
    return df.withColumn("always", F.lit(1.0))


OTHERS = [f for f in NUMBERS if f != PRICE]
CORRELATION = _ranked(
    [f"SELECT '{f}' AS feature, abs({_r(f)}) AS score FROM lineitem" for f in OTHERS]
    + ["SELECT 'always' AS feature, NULL::DOUBLE AS score"], "coalesce(score >= 0.001, false)")

QUERIES: dict[str, Query] = {
    "kbest_f_classif": on("lineitem", _best("f_classif", FLAG),
                          _ranked([_f_class(f) for f in NUMBERS], "k <= 3")),
    "kbest_f_regression": on("lineitem", _best("f_regression", PRICE),
                             _ranked([_f_line(f) for f in OTHERS], "k <= 3")),
    "kbest_mi_classif": on("lineitem", _best("mutual_info_classif", FLAG),
                           _ranked([_information(f, FLAG, False) for f in NUMBERS], "k <= 3")),
    "kbest_mi_regression": on("lineitem", _best("mutual_info_regression", PRICE),
                              _ranked([_information(f, PRICE, True) for f in OTHERS], "k <= 3")),
    "kbest_mi_knn": on(
        "orders",
        lambda df: rounded(select.select_kbest(df, "o_orderstatus", 1, "mutual_info_classif", method="knn",
                                               key_cols="o_orderkey").scores, 4, "score"),
        _ranked([_knn_class(i, f, "o_orderstatus", "o_orderkey", "orders")
                 for i, f in enumerate(("o_orderkey", "o_custkey", "o_totalprice"))], "k <= 1", 4)),
    "kbest_mi_knn_regression": on(
        "customer",
        lambda df: rounded(select.select_kbest(df, "c_acctbal", 1, "mutual_info_regression", method="knn",
                                               key_cols="c_custkey").scores, 4, "score"),
        _ranked([_knn_plane(i, f, 2, "c_acctbal", "c_custkey", "customer")
                 for i, f in enumerate(("c_custkey", "c_nationkey"))], "k <= 1", 4)),
    "kbest_table": on(
        "part", lambda df: select.select_kbest(df, "p_retailprice", 1, "f_regression").table,
        "SELECT p_retailprice, p_partkey FROM part"),
    "variance_threshold": on(
        "lineitem",
        lambda df: rounded(select.variance_threshold(_with_constant(df)).scores, 1, "score"),
        f"""WITH s AS ({" UNION ALL ".join(
            f"SELECT {i} AS place, '{f}' AS feature, var_pop({f}::DOUBLE) AS score, min({f}) <> max({f}) AS moves FROM lineitem"
            for i, f in enumerate(NUMBERS))} UNION ALL SELECT {len(NUMBERS)}, 'always', 0.0::DOUBLE, false)
            SELECT feature, round(score, 1) AS score,
                   row_number() OVER (ORDER BY score DESC, place DESC)::INTEGER AS rank, moves AS selected FROM s"""),
    "variance_threshold_table": on(
        "lineitem", lambda df: select.variance_threshold(_with_constant(df), 1.0, keep=[FLAG]).table,
        f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, {FLAG} FROM lineitem"),
    "correlation_filter": on(
        "lineitem",
        lambda df: rounded(select.correlation_filter(_with_constant(df), PRICE, 0.001).scores, 8, "score"),
        CORRELATION),
    "kbest_left_out": on(
        "orders",
        lambda df: select.select_kbest(orders_nulls(df).drop("o_orderstatus"), "o_orderpriority", 1, "f_classif").left_out,
        f"""SELECT feature, count(*) FILTER (o_orderpriority IS NULL OR x IS NULL) AS rows FROM (
              SELECT o_orderpriority, unnest([o_orderkey::DOUBLE, o_custkey::DOUBLE, o_totalprice]) AS x,
                     unnest(['o_orderkey', 'o_custkey', 'o_totalprice']) AS feature FROM {ORDERS_NULLS}) GROUP BY 1"""),
    "rf_importance": on(
        "customer",
        lambda df: select.rf_importance_select(
            ruled(df).drop("low", "amount"), "level", top=1).scores.select("feature", "selected"),
        """SELECT feature, feature = 'band' AS selected
           FROM (SELECT unnest(['c_custkey', 'band', 'thousands']) AS feature FROM region WHERE r_regionkey = 0)"""),
}
