from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepkit.operators import profile, stats
from prepkit.functions.numeric import from_image, with_image
from prepkit.plans import order_stats

NUMBERS = ["mean", "median", "std", "var", "min", "max", "sum", "count", "nunique", "skew", "kurtosis"]
CASES = {
    "plain": [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0],
    "gaps": [3.0, None, 4.0, 1.0, None, 9.0],
    "one": [2.5],
    "two": [2.5, 3.5],
    "three": [1.0, 2.0, 4.0],
    "four": [1.0, 2.0, 4.0, 9.0],
    "constant": [7.0] * 6,
    "all_missing": [None, None],
}


def expected(values: pd.Series, stat: str):
    return {"mean": values.mean, "median": values.median, "std": values.std, "var": values.var,
            "min": values.min, "max": values.max, "sum": values.sum, "count": values.count,
            "nunique": values.nunique, "skew": values.skew, "kurtosis": values.kurt}[stat]()


def same(got, want) -> bool:
    if want is None or (isinstance(want, float) and math.isnan(want)):
        return got is None
    return got == pytest.approx(want, rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("case", CASES)
def test_single_statistics_equal_pandas(spark, case):
    df = spark.createDataFrame([(v,) for v in CASES[case]], "x double")
    values = pd.Series(CASES[case], dtype=float)
    for stat in NUMBERS:
        got = stats.compute_statistic(df, "x", stat.upper()).first()[0]
        assert same(got, expected(values, stat)), (stat, got)


def test_grouped_statistics_keep_the_missing_group(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", 9.0), (None, 3.0), (None, None), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    for stat in NUMBERS:
        got = {r["g"]: r[stat] for r in stats.compute_statistic(df, "x", stat, groupby="g").collect()}
        want = {None if pd.isna(g) else g: expected(s["x"], stat) for g, s in pdf.groupby("g", dropna=False)}
        assert set(got) == set(want)
        assert all(same(got[g], want[g]) for g in want), (stat, got, want)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert stats.compute_statistic(df, "x", "mean").first()[0] == 2.0
    assert stats.compute_statistic(df, "x", "count").first()[0] == 2
    assert stats.compute_statistic(df, "x", "max").first()[0] == 3.0
    assert stats.compute_statistic(df, "x", "median", dropna=False).first()[0] is None


def test_mode_lists_all_modal_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,)], "x string")
    assert [r[0] for r in stats.compute_statistic(df, "x", "mode").collect()] == ["a", "b"]
    kept = [r[0] for r in stats.compute_statistic(df, "x", "mode", dropna=False).collect()]
    assert kept == ["a", "b", None]


def test_text_and_boolean_columns(spark):
    df = spark.createDataFrame([(1, "x", True), (2, "y", False), (3, "x", True)], "id int, t string, b boolean")
    assert stats.compute_statistic(df, "t", "sum", order_by="id").first()[0] == "xyx"
    assert stats.compute_statistic(df, "b", "sum").first()[0] == 2
    assert stats.compute_statistic(df, "b", "mean").first()[0] == pytest.approx(2 / 3)
    got = stats.describe_feature(df, "b").first().asDict()
    assert got == {"count": 3, "unique": 2, "top": True, "freq": 2}
    with pytest.raises(ValueError, match="must be numeric"):
        stats.compute_statistic(df, "t", "mean")
    with pytest.raises(ValueError, match="order_by"):
        stats.compute_statistic(df, "t", "sum")
    with pytest.raises(ValueError, match="Available"):
        stats.compute_statistic(df, "nope", "mean")
    with pytest.raises(ValueError, match="Unsupported stat"):
        stats.compute_statistic(df, "t", "range")
    with pytest.raises(ValueError, match="Group-by column"):
        stats.compute_statistic(df, "id", "mean", groupby="nope")


@pytest.mark.parametrize("percentiles", [None, [], [0.05, 0.5, 0.999], [0.1]])
def test_describe_equals_pandas(spark, percentiles):
    values = pd.Series([3.5, 1.0, None, 9.0, 2.0, 2.0])
    df = spark.createDataFrame([(None if pd.isna(v) else v,) for v in values], "x double")
    got = stats.describe_feature(df, "x", percentiles).first().asDict()
    want = values.describe(percentiles=percentiles) if percentiles else values.describe()
    want.index = ["p" + i[:-1] if i.endswith("%") else i for i in want.index]
    assert list(got) == list(want.index)
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_top_values_counts_missing(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("b",), ("c",)], "x string")
    got = [tuple(r) for r in stats.top_values(df, "x", 3).collect()]
    assert got == [("b", 2), (None, 2), ("a", 1)]


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1.0, "u"), (3.0, "ü")], ["a.b c", "grüppe"])
    assert stats.compute_statistic(df, "a.b c", "mean").first()[0] == 2.0
    assert stats.compute_statistic(df, "a.b c", "median", groupby="grüppe").count() == 2
    assert stats.compute_statistic(df, "a.b c", "mode", groupby="grüppe").count() == 2


@pytest.mark.parametrize("small", [200_000, 40, 0])
def test_quantiles_by_radix_selection(spark, monkeypatch, small):
    """Same numbers however early cells are counted by value: hot values, gaps and all."""
    rng = np.random.default_rng(3)
    values = np.where(rng.random(3000) < 0.35, 5.0, np.round(rng.normal(size=3000), 2))
    groups = np.where(rng.random(3000) < 0.6, "hot", rng.choice(["a", "b", "c"], 3000))
    rows = [(str(g), None if i % 11 == 0 else float(v)) for i, (g, v) in enumerate(zip(groups, values))]
    df = spark.createDataFrame([*rows, (None, 1.0), (None, 4.0), ("empty", None)], "g string, x double")
    pdf = pd.DataFrame([*rows, (None, 1.0), (None, 4.0), ("empty", None)], columns=["g", "x"])
    monkeypatch.setattr(order_stats, "SMALL_CELL", small)
    probs = [0.0, 0.1, 1 / 3, 0.5, 0.9, 1.0]
    got = order_stats.quantiles(df, ["x"], probs)["x"]
    assert got == pytest.approx(list(pdf["x"].quantile(probs)))
    found = {r["g"]: r["q"] for r in order_stats.grouped_quantiles(df, "x", probs, ["g"]).collect()}
    for g, part in pdf.groupby("g", dropna=False):
        want = part["x"].quantile(probs)
        q = found[None if pd.isna(g) else g]
        assert (q is None) if want.isna().all() else q == pytest.approx(list(want))
    assert stats.compute_statistic(df, "x", "median").first()[0] == pytest.approx(pdf["x"].median())


def odd_doubles() -> list[float]:
    rng = np.random.default_rng(8)
    powers = [2.0 ** e for e in range(-1074, 1024)]
    near = [v for p in powers for v in (p, math.nextafter(p, 0), math.nextafter(p, math.inf))]
    bits = rng.integers(0, 2**64, 4000, dtype=np.uint64).view(np.float64)
    some = [*near, *bits[np.isfinite(bits)].tolist(), *rng.normal(size=500).tolist(), 0.0, math.inf, 1.7976931348623157e308]
    return [*some, *[-v for v in some]]


def test_order_image_is_the_bits(spark):
    values = odd_doubles()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    made = with_image(df.withColumn("y", F.col("x")), "y", "i")
    for row in made.withColumn("back", from_image(F.col("i"))).collect():
        want = int(np.float64(abs(row.x)).view(np.int64))
        assert row.i == (-want if row.x < 0 else want) and row.back == row.x
    gone = with_image(spark.createDataFrame([(None,), (float("nan"),)], "x double"), "x", "i")
    assert [r.i for r in gone.collect()] == [None, None]


@pytest.mark.parametrize("small", [200_000, 0])
def test_ranks_of_any_doubles(spark, monkeypatch, small):
    monkeypatch.setattr(order_stats, "SMALL_CELL", small)
    values = [v for v in odd_doubles() if math.isfinite(v)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    places = [0, 1, 17, len(values) // 2, len(values) - 1]
    rows = with_image(df, "x", "v")
    found = order_stats.select_ranks(rows, [], lambda n: [F.lit(p) for p in places]).collect()
    values.sort()
    assert len(found) == len(places)
    for r in found:
        assert df.sparkSession.range(1).select(from_image(F.lit(r.v))).first()[0] == values[r["rank"]]
        assert (r.below, r.same) == (sum(v < values[r["rank"]] for v in values), values.count(values[r["rank"]]))


def test_profile(spark):
    df = spark.createDataFrame([(1, None, 1), (2, 0.5, 0), (3, None, None)], "id int, x double, b int")
    assert tuple(profile.table_kpis(df).first()) == (3, 3)
    assert [tuple(r) for r in profile.top_missing_columns(df, 2).collect()] == [("x", 2), ("b", 1)]
    got = profile.binary_summary(df, ["b"]).first()
    assert tuple(got) == ("b", 1, 1, 1, 0.5)
    after = df.dropna(subset=["x"])
    assert tuple(profile.missing_before_after(df, after, "x").first()) == (3, 1, 2, 0)
    assert [r["id"] for r in profile.preview(df, "id", rows=2).collect()] == [1, 2]
    assert [r["id"] for r in profile.preview(df, "id", rows=2, after=[2]).collect()] == [3]


def test_pages_show_every_row_once(spark):
    """Equal, null and NaN keys, many copies of a row, and pages that end between them."""
    rows = [(k, v) for k in (None, 1, 1, 2, 2, 2, None) for v in (None, "a", "b")] + [(2, "a")] * 30
    df = spark.createDataFrame([(k, None if k is None else k / 2, v) for k, v in rows], "k int, x double, row_digest string")
    for keys, size in ((["k"], 4), (["k", "x"], 7), (["row_digest"], 100)):
        found = list(profile.pages(df.repartition(3), keys, size))
        assert [p.count() for p in found][:-1] == [size] * (len(found) - 1) and found[-1].columns == df.columns
        shown = [tuple(r) for p in found for r in p.collect()]
        assert sorted(shown, key=repr) == sorted(map(tuple, df.collect()), key=repr)
        place = df.columns.index(keys[0])
        order = [(r[place] is None, r[place] or "") if place else (r[place] is None, r[place] or 0) for r in shown]
        assert [o[0] for o in order] == sorted(o[0] for o in order)
        assert [o[1] for o in order if not o[0]] == sorted(o[1] for o in order if not o[0])
    assert profile.page(df.where("false"), "k").cursor is None


def test_pages_take_the_same_jobs_however_many_there_are(spark):
    """Each page was a pass over the table of its own."""
    df = spark.range(400).select((F.col("id") % 7).alias("k"), F.col("id").cast("timestamp").alias("at"))
    context, jobs = spark.sparkContext, {}
    try:
        for size in (200, 4):
            context.setJobGroup(f"pages of {size}", "")
            assert profile.pages(df, "k", size).together().exceptAll(df).count() == 0
            jobs[size] = len(context.statusTracker().getJobIdsForGroup(f"pages of {size}"))
    finally:
        context.setJobGroup("", "")
    assert jobs[4] == jobs[200]
    found = [p.collect() for p in profile.pages(df.repartition(3), "k", 4)]
    assert [len(p) for p in found] == [4] * 100
    assert sorted(r for p in found for r in p) == sorted(df.collect())
    assert [p.columns for p in profile.pages(df.where("false"), "k")] == [df.columns]


def test_cells_of_equal_values_are_not_looked_at_again(spark, monkeypatch):
    """Few values in large cells took all four passes; every value and its neighbours are still counted right."""
    monkeypatch.setattr(order_stats, "SMALL_CELL", 1)
    passes, look = [], order_stats._open_cells
    monkeypatch.setattr(order_stats, "_open_cells", lambda *a: passes.append(1) or look(*a))
    df = spark.createDataFrame([(v,) for v in [0.04, 0.05, 0.9, -0.0, 0.0] * 40], "x double")
    probs = [0.0, 0.19, 0.4, 0.5, 0.75, 1.0]
    got = order_stats.quantiles(df, ["x"], probs)["x"]
    assert got == pytest.approx(list(np.quantile(df.toPandas()["x"], probs)))
    assert len(passes) <= 2
    monkeypatch.setattr(order_stats.bounds, "small_rows", lambda *a: None)
    assert order_stats.quantiles(df, ["x"], probs)["x"] == got
