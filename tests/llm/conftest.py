from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept boolean, id int"


@pytest.fixture(scope="session")
def tokenizer() -> str:
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi "


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and long texts, repeated rows, and columns named like the operators' own."""
    return [
        (1, None, "en", "a", None, "x", True, 1),
        (2, "", None, None, 0, None, None, None),
        (3, " \n\t ", "en", "a", 4, "x", False, 1),
        (4, LONG, "en", "b", 5, "y", True, 2),
        (4, LONG, "en", "b", 5, "y", True, 2),
        (5, LONG.upper() + "\nßé漢\U0001f600 " + LONG, None, "b", 5, "y", True, 3),
        (None, LONG * 300, "de", None, 5, "z", True, 3),
        (None, "short", "de", "b", 5, "z", True, 3),
        (7, "one\n\none\nTwo words here now\n TWO WORDS HERE NOW\t", "de", "c", 9, "z", None, 4),
    ]


@pytest.fixture(scope="session")
def odd(spark: SparkSession):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)
