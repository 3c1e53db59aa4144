from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepkit.functions.numeric import bin_number
from prepkit.operators import metrics, select
from prepkit.plans import plane_information, ranges


def scores(selection) -> dict:
    return {r["feature"]: r["score"] for r in selection.scores.collect()}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 400)
    a, b = rng.normal(size=400) + y, rng.normal(size=400) * 10 + 1000
    rows = [(int(k), float(u), float(v), 1.0, "t") for k, u, v in zip(y, a, b)]
    df = spark.createDataFrame(rows, "y int, a double, b double, same double, word string").cache()
    return df, y, a, b


def test_anova(data):
    df, y, a, b = data
    got = select.select_kbest(df, "y", 1, "f_classif")
    for name, x in (("a", a), ("b", b)):
        groups = [x[y == k] for k in range(3)]
        between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / 2
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - 3)
        assert scores(got)[name] == pytest.approx(between / within, rel=1e-9)
    assert got.selected == ["a"] and got.table.columns == ["y", "a"]
    assert scores(got)["same"] is None


def test_regression_score_and_correlation(data):
    df, y, a, b = data
    got = select.select_kbest(df, "a", 9, "f_regression")
    r = np.corrcoef(a, y)[0, 1]
    assert scores(got)["y"] == pytest.approx(r * r / (1 - r * r) * 398)
    assert scores(got)["same"] == 0.0
    assert len(got.selected) == 3
    exact = select.select_kbest(df.withColumn("twice", 2 * F.col("a")), "a", 1, "f_regression")
    assert exact.selected == ["twice"] and scores(exact)["twice"] > 1e12
    kept = select.correlation_filter(df, "a", 0.3)
    assert kept.selected == ["y"] and kept.table.columns == ["a", "y"]
    assert scores(kept)["y"] == pytest.approx(abs(r)) and scores(kept)["same"] is None
    with pytest.raises(ValueError, match="numeric"):
        select.correlation_filter(df, "word")
    with pytest.raises(ValueError, match="boolean"):
        select.correlation_filter(df.withColumn("f", F.col("a") > 0), "f")


def test_correlation_uses_pairwise_complete_rows(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 7.0), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "y double, x double")
    want = abs(np.corrcoef([1, 3, 4], [2, 5, 4])[0, 1])
    assert scores(select.correlation_filter(df, "y"))["x"] == pytest.approx(want)


def test_binned_information(data):
    df, y, a, b = data
    edges = np.unique(np.quantile(a, np.linspace(0, 1, 6)))
    x = np.maximum(np.searchsorted(edges, a, side="left"), 1)
    table = np.array([[np.sum((x == i) & (y == k)) for k in range(3)] for i in np.unique(x)]) / len(x)
    outer = table.sum(1, keepdims=True) * table.sum(0, keepdims=True)
    want = np.sum(table[table > 0] * np.log(table[table > 0] / outer[table > 0]))
    got = select.select_kbest(df, "y", 1, "mutual_info_classif", bins=5)
    assert scores(got)["a"] == pytest.approx(want, rel=1e-9)
    assert scores(got)["same"] == pytest.approx(0, abs=1e-12)
    assert select.select_kbest(df, "a", 1, "mutual_info_regression").selected == ["y"]


def psi(x: float) -> float:
    shift = 0.0
    while x < 10:
        shift -= 1 / x
        x += 1
    return shift + math.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)


def brute_information(x, y) -> float:
    k, inside, label = [], [], []
    for i in range(len(x)):
        mine = np.flatnonzero(y == y[i])
        mine = mine[mine != i]
        if len(mine) == 0:
            continue
        n = min(3, len(mine))
        reach = np.sort(np.abs(x[mine] - x[i]))[n - 1]
        known = np.isin(y, [v for v in np.unique(y) if np.sum(y == v) > 1])
        k.append(psi(n))
        label.append(psi(len(mine) + 1))
        inside.append(psi(np.sum(np.abs(x[known] - x[i]) < reach)))
    return max(0.0, psi(len(k)) + np.mean(k) - np.mean(label) - np.mean(inside))


@pytest.mark.parametrize("parts", [1, 8, 40])
@pytest.mark.parametrize("keyed", [False, True])
def test_neighbour_information_equals_brute_force(spark, data, monkeypatch, parts, keyed):
    """Also where values crowd, and where a class's values lie in several ranges, some of two or three rows."""
    df, y, a, b = data
    y = y.copy()
    y[0], y[1:4] = 77, 88
    crowded = np.where(np.arange(len(a)) % 3 == 0, 1.0 + np.random.default_rng(5).random(len(a)) * 1e-4, a)
    rows = spark.createDataFrame(
        [(i, int(k), float(v), float(w)) for i, (k, v, w) in enumerate(zip(y, a, crowded))], "id int, y int, a double, w double")
    monkeypatch.setattr(ranges, "shuffle_width", lambda spark: parts)
    table = rows if keyed else rows.drop("id")
    got = scores(select.select_kbest(table, "y", 1, "mutual_info_classif", method="knn", key_cols="id" if keyed else None))
    for name, values in (("a", a), ("w", crowded)):
        assert got[name] == pytest.approx(brute_information(values / values.std(), y), abs=1e-6)


def test_bins_are_found_by_a_search_and_equal_those_of_the_expression(spark):
    """The nested expression made a scan's code too large to be compiled."""
    xs = [-2.0, -1.5, -0.0, 0.0, 0.5, 1.0, 1.5, 3.0, None]
    edges = {"a": [-2.0, 0.0, 1.0, 3.0], "b": [-2.0, 3.0], "c": [1.0], "d": None, "e": [-2.0, -0.0, 0.5, 3.0]}
    df = spark.createDataFrame([(v,) * 5 for v in xs], "a double, b double, c double, d double, e double")
    got = select._bins(df, edges)
    assert "bucketizer" in got._jdf.queryExecution().optimizedPlan().toString()
    for n in ("a", "b", "e"):
        want = [r[0] for r in df.select(bin_number(F.col(n), edges[n], True, True)).collect()]
        mine = [r[n] for r in got.collect()]
        assert len(set(zip(want, mine))) == len(set(want)) == len(set(mine)) and mine[-1] is None
    assert [r["c"] for r in got.collect()] == [1] * 8 + [None] and {r["d"] for r in got.collect()} == {None}


@pytest.mark.parametrize("part_rows", [7, 50])
def test_parts_of_the_neighbour_score_grow_in_number_with_the_rows(spark, data, monkeypatch, part_rows):
    """Eight parts of any size before; now a part has about PART_ROWS rows, and the score is the same."""
    df, y, a, b = data
    monkeypatch.setattr(ranges, "PART_ROWS", part_rows)
    rows = spark.createDataFrame([(i, int(k), float(v)) for i, (k, v) in enumerate(zip(y, a))], "id int, y int, a double")
    got = scores(select.select_kbest(rows, "y", 1, "mutual_info_classif", method="knn", key_cols="id"))
    assert got["a"] == pytest.approx(brute_information(a / a.std(), y), abs=1e-6)
    order = spark.range(400).select("id", F.lit(0).alias("g"))
    counted = ranges.running_count(order, "g", ["id"], F.lit(True), "place", 400)
    assert counted.where("place = id + 1").count() == 400
    parts = ranges.dealt(order, ["g", "id"], 400).groupBy(ranges.PART).count().agg(F.count("*"), F.max("count")).first()
    assert parts[0] >= 400 // part_rows and parts[1] <= 4 * part_rows


def test_neighbour_information_of_copies_does_not_depend_on_the_partitions(spark):
    rows = [(i % 3, float(i % 4)) for i in range(240)]
    one, two = (spark.createDataFrame(rows, "y int, a double").repartition(n) for n in (1, 7))
    got = [scores(select.select_kbest(df, "y", 1, "mutual_info_classif", method="knn"))["a"] for df in (one, two)]
    assert got[0] == got[1] and got[0] < 0.1


def brute_plane(x, y) -> float:
    x, y = x / x.std(), y / y.std()
    nx, ny = [], []
    for i in range(len(x)):
        dx, dy = np.abs(x - x[i]), np.abs(y - y[i])
        both = np.maximum(dx, dy)
        both[i] = np.inf
        reach = np.sort(both)[2]
        nx.append(psi(np.sum(dx < reach)))
        ny.append(psi(np.sum(dy < reach)))
    return max(0.0, psi(len(x)) + psi(3) - np.mean(nx) - np.mean(ny))


def test_plane_information_equals_brute_force(spark, monkeypatch):
    """Correlated, crowded on a line and on a spot, with outliers; cells small enough that most points are guests."""
    rng = np.random.default_rng(6)
    n = 2000
    y = np.concatenate([rng.normal(size=n - 4), [40.0, 41.0, -90.0, 500.0]])
    line = np.where(np.arange(n) % 3 == 0, 1.0 + 1e-5 * rng.random(n), y + rng.normal(size=n))
    spot = np.where(np.arange(n) % 3 == 0, 1e-5 * rng.random(n), rng.standard_t(2, size=n) + 0.2 * y)
    rows = [(i, float(v), float(a), float(b)) for i, (v, a, b) in enumerate(zip(y, line, spot))]
    df = spark.createDataFrame([*rows, (-1, None, 1.0, 1.0), (-2, 1.0, None, None)], "id int, y double, line double, spot double")
    monkeypatch.setattr(plane_information, "CELL_ROWS", 60)
    monkeypatch.setattr(plane_information, "GUESTS", 40)
    got = scores(select.select_kbest(df, "y", 2, "mutual_info_regression", method="knn", key_cols="id"))
    for name, values in (("line", line), ("spot", spot)):
        assert got[name] == pytest.approx(brute_plane(values, y), abs=0.002), name


def test_plane_information_of_few_rows(spark):
    for n in (0, 1, 3, 4):
        df = spark.createDataFrame([(float(i), float(i * i)) for i in range(n)], "y double, x double")
        got = scores(select.select_kbest(df, "y", 1, "mutual_info_regression", method="knn"))["x"]
        assert (got is None) == (n < 4)
    assert got == pytest.approx(brute_plane(np.arange(4.0) ** 2, np.arange(4.0)), abs=0.02)


def test_variance_threshold(data):
    df, y, a, b = data
    got = select.variance_threshold(df, keep=["word"])
    assert got.selected == ["y", "a", "b"] and got.table.columns == ["y", "a", "b", "word"]
    assert scores(got)["b"] == pytest.approx(np.var(b))
    assert select.variance_threshold(df, 10.0).table.columns == ["b"]
    with pytest.raises(ValueError):
        select.variance_threshold(df, 1e9)


def test_forest_importance(data):
    df, y, a, b = data
    got = select.rf_importance_select(df.withColumn("gap", F.lit(None).cast("double")), "y", 20, 5, top=1)
    assert got.selected == ["a"] and got.table.columns == ["y", "a"]
    assert select.infer_task(df, "a") == "regression"
    assert select.infer_task(df, "word") == "classification"
    assert select.infer_task(df, "same") == "classification"
    assert select.rf_importance_select(df, "a", 10, 4).selected[0] == "y"


def test_selection_arguments(data):
    df = data[0]
    for call in (
        lambda: select.select_kbest(df, "none", 1, "f_classif"),
        lambda: select.select_kbest(df, "y", 0, "f_classif"),
        lambda: select.select_kbest(df, "y", 1, "chi2"),
        lambda: select.select_kbest(df.select("word", "y"), "y", 1, "f_classif"),
        lambda: select.rf_importance_select(df, "y", 5),
        lambda: select.correlation_filter(df, "a", 1.5),
        lambda: select.variance_threshold(df, -1),
    ):
        with pytest.raises(ValueError):
            call()


def brute_area(pos, s) -> float:
    p, q = s[pos == 1], s[pos == 0]
    return float(np.mean((p[:, None] > q[None, :]) + 0.5 * (p[:, None] == q[None, :])))


def test_area_under_roc_with_hot_scores(spark):
    rng = np.random.default_rng(9)
    pos = rng.integers(0, 2, 900)
    s = np.where(rng.random(900) < 0.4, 0.5, np.round(rng.random(900) + 0.2 * pos, 2))
    df = spark.createDataFrame([(int(p), float(v)) for p, v in zip(pos, s)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()[0] == pytest.approx(brute_area(pos, s), abs=1e-12)
    assert metrics.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_one_vs_rest_area(spark):
    rng = np.random.default_rng(2)
    y, v = rng.integers(0, 3, 300), np.round(rng.random((300, 3)), 1)
    rows = [(float(k), [float(x) for x in r]) for k, r in zip(y, v)]
    df = spark.createDataFrame(rows, "y double, v array<double>")
    want = np.mean([brute_area((y == k).astype(int), v[:, k]) for k in range(3)])
    assert metrics.roc_auc_ovr(df, "y", F.col("v"), [0.0, 1.0, 2.0]).first()[0] == pytest.approx(want)
    assert metrics.roc_auc_ovr(df, "y", F.col("v"), [0.0, 1.0, 5.0]).first()[0] is None


def test_macro_metrics_count_classes_on_either_side(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "d")], "y string, p string")
    got = metrics.classification_metrics(df, "y", "p").first()
    assert got["accuracy"] == pytest.approx(2 / 5)
    assert got["precision_macro"] == pytest.approx((1 / 2 + 1 / 2 + 0 + 0) / 4)
    assert got["recall_macro"] == pytest.approx((1 / 3 + 1 + 0 + 0) / 4)
    assert got["f1_macro"] == pytest.approx((2 / 5 + 2 / 3) / 4)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert tuple(got) == pytest.approx((math.sqrt(1.25 / 3), 0.5, 1 - 1.25 / (14 / 3)))
    flat = spark.createDataFrame([(1.0, 1.5), (1.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first()["r2"] is None


def test_fits_do_not_depend_on_partitions(spark):
    df = spark.range(400).selectExpr("id % 7 as a", "id % 11 as b", "(id * 13) % 5 as z", "(id % 7 + id % 11) % 3 as y")
    found = [select.rf_importance_select(df.repartition(n), "y", 10, 4).scores.orderBy("feature").collect() for n in (1, 2, 7)]
    assert found[0] == found[1] == found[2]
