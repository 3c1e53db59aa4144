"""Samples and splits: exact sizes, disjoint, repeatable, hot groups and copies included."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from prepkit.operators import sample, split
from prepkit.plans import bounds, cuts, order_stats


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one class, small classes, a missing one."""
    g = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
    g = g.otherwise(F.concat(F.lit("c"), (F.col("id") % 5).cast("string")))
    return spark.range(1000).select("id", g.alias("g"), (F.col("id") * 0.5).alias("x")).cache()


def counts(df, *by):
    return {tuple(r[b] for b in by): r["count"] for r in df.groupBy(*by).count().collect()}


def quotas(sizes: dict, total: int) -> dict:
    n = sum(sizes.values())
    share = {g: s * total / n for g, s in sizes.items()}
    out = {g: int(v) for g, v in share.items()}
    order = sorted(sizes, key=lambda g: (-(share[g] - out[g]), g[0] is None, g[0] or ""))
    for g in order[: total - sum(out.values())]:
        out[g] += 1
    return out


@pytest.fixture(params=["plain", "bracketed", "narrowed", "many_classes"])
def way(request, monkeypatch):
    """Small groups directly; by a bracket of hashes; by narrowing their prefixes; with class tables too big to broadcast."""
    if request.param != "plain":
        monkeypatch.setattr(cuts, "EDGE_ROWS", 5)
        monkeypatch.setattr(cuts, "FEW_FIRST_ROWS", 0)
    if request.param == "narrowed":
        monkeypatch.setattr(cuts, "SIGMAS", -1000.0)
    if request.param == "many_classes":
        monkeypatch.setattr(sample.settle, "__defaults__", (2,))
        monkeypatch.setattr(bounds, "SMALL_TABLE_ROWS", 2)
    return request.param


def test_random_sample(rows, way):
    got = sample.random_sample(rows, 0.337, key_cols="id")
    assert got.count() == 337 and got.select("id").distinct().count() == 337
    again = sample.random_sample(rows.repartition(7), 0.337, key_cols="id")
    assert got.exceptAll(again).count() == 0
    other = sample.random_sample(rows, 0.337, random_state=1, key_cols="id")
    assert got.exceptAll(other).count() > 0
    assert sample.random_sample(rows, 1.0).count() == 1000
    assert 0 < sample.random_sample(rows, 0.5, exact=False).count() < 1000


def test_stratified_sample(rows, way):
    got = sample.stratified_sample(rows, "g", 0.35, key_cols="id")
    assert got.columns == ["id", "x", "g"]
    assert counts(got, "g") == quotas(counts(rows, "g"), 350)
    assert sample.stratified_sample(rows, "g", 1.0).count() == 1000


def test_balanced_sample(rows, way):
    sizes = counts(rows, "g")
    got = sample.class_balanced_sample(rows, "g", per_class=120, key_cols="id")
    assert counts(got, "g") == {g: min(120, n) for g, n in sizes.items()}
    got = sample.class_balanced_sample(rows, "g", max_total=100, key_cols="id")
    assert set(counts(got, "g").values()) == {100 // len(sizes)}
    first = sample.class_balanced_sample(rows, "g", per_class=3, shuffle_within_class=False, key_cols="id")
    want = {}
    for r in rows.orderBy("id").collect():
        want.setdefault(r["g"], [])
        if len(want[r["g"]]) < 3:
            want[r["g"]].append(r["id"])
    assert sorted(r["id"] for r in first.collect()) == sorted(i for ids in want.values() for i in ids)


def test_random_split(rows, way):
    got = split.train_val_test_split(rows, test_size=0.15, val_size=0.25, key_cols="id")
    assert counts(got, "split") == {("test",): 150, ("val",): 250, ("train",): 600}
    assert got.drop("split").exceptAll(rows).count() == 0
    again = split.train_val_test_split(rows.repartition(5), test_size=0.15, val_size=0.25, key_cols="id")
    assert got.exceptAll(again).count() == 0
    assert "val" not in {k[0] for k in counts(split.train_val_test_split(rows, val_size=0.0), "split")}


def test_stratified_split(rows, way):
    got = split.train_val_test_split(rows, "g", key_cols="id")
    sizes = counts(rows, "g")
    test = quotas(sizes, 200)
    val = quotas({g: n - test[g] for g, n in sizes.items()}, 100)
    found = counts(got, "g", "split")
    for g in sizes:
        assert found.get((*g, "test"), 0) == test[g]
        assert found.get((*g, "val"), 0) == val[g]
    assert got.count() == 1000


def test_parts_of_copies_and_repeated_keys(spark, monkeypatch):
    same = spark.range(301).select(F.lit("z").alias("k"), F.lit(1.5).alias("v"))
    mixed = same.union(spark.range(99).select(F.lit("z"), F.col("id").cast("double") + 2))
    monkeypatch.setattr(cuts, "CHUNK", 7)
    for edge in (100_000, 5):
        monkeypatch.setattr(cuts, "EDGE_ROWS", edge)
        monkeypatch.setattr(cuts, "FEW_FIRST_ROWS", edge - 5)
        for df in (same, mixed):
            n = df.count()
            for keys in (None, "k"):
                got = split.train_val_test_split(df, key_cols=keys)
                n_test, n_val = split.part_sizes(n, 0.2, 0.1)
                assert counts(got, "split") == {
                    ("test",): n_test, ("val",): n_val, ("train",): n - n_test - n_val}
                assert got.drop("split").exceptAll(df).count() == 0
            assert sample.stratified_sample(df, "k", 0.3, key_cols="k").count() == int(0.3 * n)
            first = sample.class_balanced_sample(df, "k", per_class=50, shuffle_within_class=False, key_cols="v")
            assert first.count() == 50


def test_time_split(spark):
    rows = [(i, f"2024-01-{1 + i // 4:02d} 00:00:00" if i % 9 else "not a time") for i in range(100)]
    df = spark.createDataFrame([*rows, (100, None)], "id int, t string")
    good = [(t, i) for i, t in rows if t != "not a time"]
    got = split.time_series_split(df, "t", 0.25, 0.2, key_cols="id")
    n = len(good)
    n_test = round(n * 0.25)
    n_val = round((n - n_test) * 0.2)
    order = [i for _, i in sorted(good)]
    want = {**{i: "train" for i in order[: n - n_test - n_val]},
            **{i: "val" for i in order[n - n_test - n_val: n - n_test]},
            **{i: "test" for i in order[n - n_test:]}}
    assert {r["id"]: r["split"] for r in got.collect()} == want
    assert split.time_series_split(df.where("false"), "t").count() == 0
    one = split.time_series_split(df.where("id = 1"), "t").collect()
    assert [r["split"] for r in one] == ["test"]
    same = spark.range(30).select(F.lit("2024-05-05").alias("t"))
    assert counts(split.time_series_split(same, "t"), "split") == {
        ("test",): 6, ("val",): 2, ("train",): 22}


def test_clustered_sample(spark):
    rows = [(c * 100 + i, c * 50.0 + i * 0.1, -c * 50.0) for c in range(4) for i in range(30)]
    df = spark.createDataFrame([*rows, (999, None, 1.0)], "id int, a double, b double")
    got = sample.clustered_sample(df, 4, 3, use_features=["a", "b"], key_cols="id", n_init=3).collect()
    assert Counter(r["id"] // 100 for r in got) == {c: 3 for c in range(4)}
    assert {r["id"] % 100 for r in got} <= {13, 14, 15, 16}
    arrays = df.dropna().select("id", F.array("a", "b").alias("v"))
    assert sample.clustered_sample(arrays, 4, 1, use_features=["v"], n_init=2, scale=True).count() == 4


def test_arguments(rows):
    with pytest.raises(ValueError, match="fewer than 2 rows"):
        sample.stratified_sample(rows, "id")
    for call in (
        lambda: sample.random_sample(rows, 0.0),
        lambda: sample.random_sample(rows, 1.5),
        lambda: sample.class_balanced_sample(rows, "g"),
        lambda: sample.class_balanced_sample(rows, "g", per_class=0),
        lambda: sample.class_balanced_sample(rows, "g", per_class=2, shuffle_within_class=False),
        lambda: sample.stratified_sample(rows, "nope"),
        lambda: sample.clustered_sample(rows.select("g"), 2),
        lambda: split.train_val_test_split(rows, test_size=0.6, val_size=0.4),
        lambda: split.train_val_test_split(rows, "nope"),
        lambda: split.time_series_split(rows, "nope"),
    ):
        with pytest.raises(ValueError):
            call()


def test_split_is_one_pass_without_a_shuffle_of_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for got in (
        split.train_val_test_split(df, key_cols="o_orderkey"),
        split.train_val_test_split(df, "o_orderstatus", key_cols="o_orderkey"),
        split.time_series_split(df, "o_orderdate", key_cols="o_orderkey"),
        sample.stratified_sample(df, "o_orderstatus", key_cols="o_orderkey"),
    ):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
        assert "Window" not in plan and "Python" not in plan


def test_shares_of_more_classes_than_a_task_may_rank(spark, monkeypatch):
    """Equal remainders, a missing class: the same shares by one ranking and by looking for the last place."""
    sizes = spark.range(40).select(
        F.when(F.col("id") > 0, F.col("id") % 40).alias("_g0"), (F.lit(3) + F.col("id") % 4).alias("_n"))
    want = quotas({(r["_g0"],): r["_n"] for r in sizes.collect()}, 77)
    for limit in (1000, 2):
        monkeypatch.setattr(bounds, "SMALL_TABLE_ROWS", limit)
        got = sample.share_out(sizes, 77, F.col("_n"), "_cut0")
        assert {(r["_g0"],): r["_cut0"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_one_pass_finds_the_hashes_at_the_cuts(spark, monkeypatch):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("_g0"), F.md5(F.col("id").cast("string")).alias("h"))
    sizes = df.groupBy("_g0").agg(F.count(F.lit(1)).alias("_n")).withColumns({"_cut0": F.lit(700), "_cut1": F.col("_n") - 1})
    plain = sorted(cuts._hash_bounds(df, ["_g0"], sizes, 2).collect())
    monkeypatch.setattr(cuts, "EDGE_ROWS", 100)
    monkeypatch.setattr(cuts, "_bracketed", lambda *a, ask=cuts._bracketed: found.append(ask(*a)) or found[-1])
    found: list = []
    assert sorted(cuts._hash_bounds(df, ["_g0"], sizes, 2).collect()) == plain and found[0] is not None
    ten = df.withColumn("h", F.md5((F.col("id") % 10).cast("string")))  # few keys: far from their share
    cuts._hash_bounds(ten, ["_g0"], sizes, 2)
    assert found[1] is None


def test_copies_are_dealt_out_before_a_fit(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("a b"), F.lit(None).cast("string").alias("t"))
    got = bounds.spread(df, 200_000)
    again = bounds.spread(df.repartition(3), 200_000)
    place = F.spark_partition_id().alias("part")
    sizes = [counts(x.select(place), "part") for x in (got, again)]
    assert sizes[0] == sizes[1] and len(sizes[0]) == 21 and max(sizes[0].values()) < 30_000
    assert counts(got, "a b") == counts(df, "a b") and got.schema == df.schema
    points = df.limit(100).select(array_to_vector(F.array(F.lit(1.0), F.lit(2.0))).alias("v"))
    assert [r["v"].toArray().tolist() for r in bounds.spread(points, 100).collect()] == [[1.0, 2.0]] * 100


def test_short_rounds_get_few_large_parts(spark):
    """A round of boosting, k-means or gradient steps starts all its tasks anew: 900,000 rows were 91 tasks each time."""
    df = spark.range(1000).select((F.col("id") % 900).alias("id"))
    got = bounds.spread(df, 900_000, rounds=True)
    assert got.rdd.getNumPartitions() == 24
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in df.collect())
    assert bounds.spread(df, 10_000_000, rounds=True).rdd.getNumPartitions() == 41
    for n in (1_000, 20_000, 200_000):  # smaller tables keep their parts, and so their draws
        assert bounds.spread(df, n, rounds=True).rdd.getNumPartitions() == bounds.spread(df, n).rdd.getNumPartitions()


def test_rows_that_differ_by_microseconds_stay_themselves(spark):
    df = spark.range(100).select(
        F.lit(1).alias("k"), F.lit("2024-01-02").cast("date").alias("d"),
        F.timestamp_micros(F.col("id")).alias("t"), F.timestamp_micros(F.col("id")).cast("timestamp_ntz").alias("n"))
    done = split.train_val_test_split(df, key_cols="k")
    back = done.drop("split")
    assert back.count() == 100
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "UTC"])
def test_order_by_local_time_where_the_clock_is_set(spark, zone):
    """Times without a zone keep their order and their distances, also where that clock jumps."""
    before = spark.conf.get("spark.sql.session.timeZone")
    times = ["1900-01-01 00:00:00.000001", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00"]
    times += [f"{day} 0{h}" for day in ("2024-03-10", "2024-03-31", "2024-04-07", "2024-10-06", "2024-10-27", "2024-11-03")
              for h in ("1:00:00", "1:45:00.5", "2:15:00", "2:30:00", "3:00:00", "3:10:00", "3:20:00.000001")]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string")
        df = df.withColumn("t", F.col("t").cast("timestamp_ntz")).repartition(3)
        order = df.select(cuts.plain_order(df, "t").alias("o"), "t").orderBy("o").collect()
        epoch = dt.datetime(1970, 1, 1)
        assert [r.o for r in order] == [(dt.datetime.fromisoformat(t) - epoch) // dt.timedelta(microseconds=1) for t in times]
        parts = {r.i: r.split for r in split.time_series_split(df, "t", 0.3, 0.2).collect()}
        n_test = round(len(times) * 0.3)
        n_val = round((len(times) - n_test) * 0.2)
        n_train = len(times) - n_test - n_val
        assert [parts[i] for i in range(len(times))] == ["train"] * n_train + ["val"] * n_val + ["test"] * n_test
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("small", [200_000, 2, 0])
def test_integers_at_ranks(spark, monkeypatch, small):
    monkeypatch.setattr(order_stats, "SMALL_CELL", small)
    draw = random.Random(4)
    for values in ([5] * 9, [-2**63, 2**63 - 1, 0, 0, 7], [draw.randrange(-10**15, 10**15) for _ in range(300)] * 2,
                   [draw.randrange(0, 3000) for _ in range(500)]):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        ordered, places = sorted(values), [0, len(values) // 2, len(values) - 1]
        got = order_stats.values_at_ranks(df, F.col("v"), places)
        assert got == [(ordered[p], ordered.index(ordered[p]), ordered.count(ordered[p])) for p in places]
    with pytest.raises(ValueError, match="outside"):
        order_stats.values_at_ranks(df, F.col("v"), [500])
