from __future__ import annotations

import pandas as pd
import pytest

from prepkit.operators import prep

VALUES = {
    "mixed": [0.0, 1.0, 2.5, 10.0, None, 7.3, 2.5],
    "constant": [5.0, 5.0, 5.0],
    "zeros": [0.0, 0.0],
    "negative": [-3.25, -1.0, 0.125, 4.0, 1000.5],
    "tiny": [0.0001, 0.00016, 0.00021, 0.00093],
    "repeats": [1.0, 1.0, 1.0, 1.0, 2.0, 3.0],
}


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")


def labels(df) -> list:
    return [r["x_binned"] for r in df.orderBy("id").collect()]


def texts(cut) -> list:
    return [None if pd.isna(v) else str(v) for v in cut]


@pytest.mark.parametrize("right", [True, False])
@pytest.mark.parametrize("lowest", [True, False])
@pytest.mark.parametrize("case", VALUES)
def test_equal_width_labels_equal_pandas(spark, case, right, lowest):
    series = pd.Series(VALUES[case], dtype=float)
    for bins in (2, 3, 4):
        got = prep.discretize(frame(spark, VALUES[case]), "x", bins=bins, right=right, include_lowest=lowest)
        assert labels(got) == texts(pd.cut(series, bins=bins, right=right, include_lowest=lowest))


@pytest.mark.parametrize("case", ["mixed", "negative", "tiny", "repeats"])
def test_equal_frequency_labels_equal_pandas(spark, case):
    """Not q=3 on four values: the edge in pandas is one bit off the value it stands for."""
    series = pd.Series(VALUES[case], dtype=float)
    for q in (2, 4 if case == "tiny" else 3, 5):
        got = prep.discretize(frame(spark, VALUES[case]), "x", "equal_freq", q=q)
        assert labels(got) == texts(pd.qcut(series, q=q, duplicates="drop"))


@pytest.mark.parametrize("right", [True, False])
@pytest.mark.parametrize("lowest", [True, False])
def test_custom_edges_equal_pandas(spark, right, lowest):
    series = pd.Series(VALUES["mixed"], dtype=float)
    edges = [0.0, 1.0, 2.5, 10.0]
    got = prep.discretize(frame(spark, VALUES["mixed"]), "x", "custom_edges", edges=edges, right=right,
                          include_lowest=lowest)
    assert labels(got) == texts(pd.cut(series, bins=edges, right=right, include_lowest=lowest))


def test_binning_arguments(spark):
    df = frame(spark, VALUES["mixed"]).withColumnRenamed("id", "x_binned")
    assert prep.discretize(df, "x", bins=2) is df
    assert "x_binned_1" in prep.discretize(df, "x", bins=2, if_exists="suffix").columns
    assert prep.discretize(df, "x", bins=2, if_exists="overwrite").schema["x_binned"].dataType.typeName() == "string"
    with pytest.raises(ValueError, match="already exists"):
        prep.discretize(df, "x", bins=2, if_exists="fail")
    for wrong in ({"bins": 1}, {"bins": None}, {"strategy": "equal_freq"}, {"strategy": "equal_freq", "q": 1},
                  {"strategy": "custom_edges", "edges": [1, 1]}, {"strategy": "custom_edges"},
                  {"strategy": "nope"}, {"bins": 3, "labels": ["a", "b"]}):
        with pytest.raises(ValueError):
            prep.discretize(frame(spark, VALUES["mixed"]), "x", **wrong)
    text = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError, match="numeric"):
        prep.discretize(text, "x", bins=2)


def test_boolean_can_be_binned(spark):
    df = spark.createDataFrame([(0, True), (1, False)], "id int, x boolean")
    assert labels(prep.discretize(df, "x", bins=2)) == ["(0.5, 1.0]", "(-0.002, 0.5]"]


@pytest.mark.parametrize("drop_first", [True, False])
def test_dummies_equal_pandas(spark, drop_first):
    rows = [("b", 1.0, 1), ("a", None, 2), (None, 2.5, 1), ("b", 1.0, 3)]
    df = spark.createDataFrame(rows, "t string, x double, n int")
    pdf = pd.DataFrame(rows, columns=["t", "x", "n"])
    for column in ("t", "x", "n"):
        got = prep.one_hot(df, column, drop_first=drop_first).toPandas()
        want = pd.get_dummies(pdf[column], prefix=column, drop_first=drop_first, dtype="uint8")
        assert list(got.columns) == ["t", "x", "n", *want.columns]
        assert (got[want.columns].to_numpy() == want.to_numpy()).all()


def test_dummy_options(spark):
    df = spark.createDataFrame([("b", "p", 7), ("a", "q", 8)], "t string, u string, t_a int")
    assert prep.one_hot(df, columns=["t", "none"]).columns == ["t", "u", "t_a", "t_b"]
    assert prep.one_hot(df, "t").first()["t_a"] == 7
    assert prep.one_hot(df, "t", if_exists="overwrite").first()["t_a"] == 0
    assert prep.one_hot(df, "t", if_exists="suffix").columns[3:] == ["t_a_1", "t_b"]
    assert prep.one_hot(df, all_categoricals=True).columns[3:] == ["t_b", "u_p", "u_q"]
    assert prep.one_hot(df, "t", dtype="double").schema["t_b"].dataType.typeName() == "double"
    for wrong in ({}, {"column": "none"}, {"column": "t", "if_exists": "fail"},
                  {"column": "t", "max_categories": 0}):
        with pytest.raises(ValueError):
            prep.one_hot(df, **wrong)
    same = spark.createDataFrame([("a", "a")], "t string, u string")
    with pytest.raises(ValueError, match="two columns"):
        prep.one_hot(same, columns=["t", "u"], prefix="p")


def test_sparse_encoding(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "t string")
    got = prep.one_hot_sparse(df, ["t"]).transform(df).collect()
    assert [r["t_onehot"].toArray().tolist() for r in got[:2]] == [[0, 1, 0], [1, 0, 0]]


@pytest.mark.parametrize("strategy", ["median", "mean", "zero"])
def test_impute_numbers(spark, strategy):
    values = [4.0, None, 1.0, 2.0, float("nan")]
    series = pd.Series(values, dtype=float)
    fill = {"median": series.median(), "mean": series.mean(), "zero": 0}[strategy]
    cleaned = prep.clean_nulls(frame(spark, values), "x", numeric_strategy=strategy)
    got = [r["x"] for r in cleaned.orderBy("id").collect()]
    assert got == pytest.approx(list(series.fillna(fill)))
    again = [r["x"] for r in prep.clean_nulls(cleaned, "x", numeric_strategy=strategy).orderBy("id").collect()]
    assert again == got


def test_impute_values(spark):
    def filled(rows, kind="string", **how):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"id int, x {kind}")
        return [r["x"] for r in prep.clean_nulls(df, "x", **how).orderBy("id").collect()]

    assert filled(["b", None, "a", "b", "a"]) == ["b", "a", "a", "b", "a"]
    assert filled([None, None]) == ["Unknown", "Unknown"]
    assert filled(["a", None], categorical_strategy="constant", constant_value="-") == ["a", "-"]
    assert filled([True, None, True], "boolean") == [True, True, True]
    assert filled([None, None], "double") == [None, None]
    assert filled([3, None, 4], "bigint") == [3.0, 3.5, 4.0]
    assert filled(["a", None], mode="drop_rows") == ["a"]
    with pytest.raises(ValueError, match="mode"):
        filled(["a"], mode="replace")


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert prep.drop_columns(df, ["b", "none"]).columns == ["a", "c"]
    assert prep.project_columns(df, ["c", "a", "c"]).columns == ["c", "a"]


def test_result_of_binning_is_a_projection(spark):
    df = frame(spark, [float(v) for v in range(50)])
    plan = prep.discretize(df, "x", bins=4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
