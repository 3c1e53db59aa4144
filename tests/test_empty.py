"""Zero rows in: zero rows, or a row of nulls, out - or a clear refusal."""

from __future__ import annotations

import pytest

from prepkit.operators import metrics, prep, profile, sample, select, split, stats, text


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "id bigint, x double, y string, t timestamp")


def test_statistics(empty):
    for stat in stats.STATS:
        if stat == "mode":
            assert stats.compute_statistic(empty, "x", stat).count() == 0
            continue
        got = stats.compute_statistic(empty, "x", stat).first()[0]
        assert got == {"count": 0, "nunique": 0, "sum": 0.0}.get(stat)
        assert stats.compute_statistic(empty, "x", stat, groupby="y").count() == 0
    assert stats.describe_feature(empty, "x").first()["count"] == 0
    assert stats.describe_feature(empty, "y").first()["count"] == 0
    assert stats.top_values(empty, "y").count() == 0


def test_profile_and_prep(empty):
    assert tuple(profile.table_kpis(empty).first()) == (0, 4)
    assert profile.top_missing_columns(empty).first()["missing"] == 0
    assert prep.one_hot(empty, "y").columns == empty.columns
    assert prep.clean_nulls(empty, "x").count() == 0
    assert prep.clean_nulls(empty, "y").count() == 0
    with pytest.raises(ValueError, match="no values"):
        prep.discretize(empty, "x", bins=3)


def test_parts(empty):
    assert sample.random_sample(empty, 0.5, key_cols="id").count() == 0
    assert sample.stratified_sample(empty, "y", key_cols="id").count() == 0
    assert sample.class_balanced_sample(empty, "y", max_total=5, key_cols="id").count() == 0
    assert split.train_val_test_split(empty, key_cols="id").count() == 0
    assert split.train_val_test_split(empty, "y", key_cols="id").count() == 0
    assert split.time_series_split(empty, "t", key_cols="id").count() == 0


def test_scores_and_metrics(empty):
    assert select.select_kbest(empty, "y", 1, "f_classif").scores.count() == 2
    assert select.correlation_filter(empty, "x").selected == []
    assert metrics.roc_auc(empty, "id", "x").first()[0] is None
    assert metrics.regression_metrics(empty, "x", "id").first()["rmse"] is None
    assert text.suppress_repeats(empty, "y", "t", "y").count() == 0
