from __future__ import annotations

import hashlib
import random
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepkit.operators import text
from prepkit.operators.split import train_val_test_split
from prepkit.plans import bounds
from prepkit.plans.neighbours import with_neighbour
from prepkit.sources import delimited, quoted, tables


@pytest.fixture
def folder(spark):
    return f"{bounds.shared_dir(spark)}/{uuid.uuid4().hex}"


def put(spark, folder, name, content):
    """One text file with exactly this content, written by Spark's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(content.encode()))
    out.close()
    return f"{folder}/{name}"


@pytest.mark.parametrize("hot", [2_000_000, 3])
def test_transcripts(spark, monkeypatch, hot):
    rows, want = [], {}
    for conv, n in ((1, 40), (2, 3), (3, 1)):
        said = [(conv, 3 * t + (t % 3), ["user", "assistant", "system", "user"][t % 4], f"m{t}") for t in range(n)]
        rows += said
        talk = sorted([s for s in said if s[2] != "system"], key=lambda s: s[1])
        pairs = [(a, b) for a, b in zip(talk, talk[1:]) if (a[2], b[2]) == ("user", "assistant")][-8:]
        if pairs:
            want[conv] = "\n\n".join(f"User: {a[3]}\nAssistant: {b[3]}" for a, b in pairs)
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    monkeypatch.setattr(bounds, "WINDOW_GROUP_ROWS", hot)
    assert {r["conv_id"]: r["transcript"] for r in text.last_transcript(df).collect()} == want


@pytest.mark.parametrize("hot", [2_000_000, 4])
def test_repeats(spark, monkeypatch, hot):
    rows = [(i % 2 if i < 20 else 9, i, [" go", "go ", "stop", None][(i // 3) % 4]) for i in range(80)]
    df = spark.createDataFrame(rows, "s int, t int, q string")
    last, want = {}, []
    for s, t, q in sorted(rows, key=lambda r: r[1]):
        mark = hashlib.sha256(((q or "").strip() + "||").encode()).hexdigest()
        if last.get(s) != mark:
            want.append((t, mark))
        last[s] = mark
    monkeypatch.setattr(bounds, "WINDOW_GROUP_ROWS", hot)
    got = text.suppress_repeats(df, "s", "t", "q").select("t", "fingerprint").collect()
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_neighbours_are_the_same_by_window_and_by_ranges(spark, monkeypatch, keys, after):
    """A hot key, text order, missing and equal order values, a missing key."""
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 7}", None if i % 13 == 0 else f"{i % 40:03d}", i)
            for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t string, v int").repartition(5)

    def found():
        near = with_neighbour(df, keys, ["t"], F.col("v"), "near", after)
        return sorted(tuple(r) for r in near.select("v", F.coalesce("near", F.lit(-1))).collect())

    want = found()
    assert sum(near == -1 for _, near in want) == (len({k for k, _, _ in rows}) if keys else 1)
    monkeypatch.setattr(bounds, "WINDOW_GROUP_ROWS", 20)
    assert found() == want


def test_scan_types_and_missing_tokens(spark, folder):
    path = put(spark, folder, "a.csv", 'i,f,b,t,m,n\n1,1.5,True,x,NA,007\n2,NA,false,"a ""b"",\nc",,-3\n,1e3,,NULL,n/a,+4\n')
    got = delimited.read_delimited(spark, path)
    assert dict(got.dtypes) == {"i": "bigint", "f": "double", "b": "boolean", "t": "string", "m": "double", "n": "bigint"}
    assert [tuple(r) for r in got.orderBy("n").collect()] == [
        (2, None, False, 'a "b",\nc', None, -3), (None, 1000.0, None, None, None, 4), (1, 1.5, True, "x", None, 7)]
    text_only = delimited.read_delimited(spark, path, infer=False)
    assert {t for _, t in text_only.dtypes} == {"string"}


def test_numbers_that_are_none(spark, folder):
    path = put(spark, folder, "a.csv", "a,b,c\n1d,inf,99999999999999999999\n2,1,1\n")
    assert dict(delimited.read_delimited(spark, path).dtypes) == {"a": "string", "b": "double", "c": "double"}


def test_delimiters(spark, folder):
    put(spark, folder, "comma.txt", "a,b\n1,2\n")
    put(spark, folder, "semi.txt", 'a;b;c\n"x,y;z";2;3\n4;5,5;6\n')
    put(spark, folder, "tab.txt", "a\tb\n1\t2\n")
    put(spark, folder, "pipe.txt", "a|b\n1|2,3\n")
    put(spark, folder, "none.txt", "word\nother\n")
    found = {r["file"].rsplit("/", 1)[1]: r["delimiter"] for r in delimited.detect_delimiters(spark, folder).collect()}
    assert found == {"comma.txt": ",", "semi.txt": ";", "tab.txt": "\t", "pipe.txt": "|", "none.txt": ","}
    assert delimited.detect_delimiter(spark, f"{folder}/semi.txt") == ";"


def test_versions_and_splits(spark, folder):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("g"))
    assert tables.versions(spark, folder) == []
    tables.write_version(df, folder)
    tables.write_version(tables.read_version(spark, folder).where("g = 1"), folder)
    assert tables.versions(spark, folder) == [1, 2]
    assert tables.read_version(spark, folder).count() == 25
    assert tables.read_version(spark, folder, 1).count() == 100
    with pytest.raises(ValueError):
        tables.read_version(spark, folder, 3)
    parts = train_val_test_split(df, "g", key_cols="id")
    tables.write_splits(parts, f"{folder}/parts")
    test = tables.read_split(spark, f"{folder}/parts", "test")
    assert test.count() == 20 and test.columns == ["id", "g"]
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_delimiter_with_quoted_line_breaks(spark, tmp_path):
    rows = "".join(f'{i};{i},5;"first, line\ninner line\nlast"\n{i};{i},25;"plain"\n{i};7;x\n' for i in range(5))
    (tmp_path / "breaks.txt").write_text("a;b;c\n" + rows)
    assert delimited.detect_delimiter(spark, str(tmp_path)) == ";"


def quoted_file(path, seed: int, n: int = 400) -> pd.DataFrame:
    draw = random.Random(seed)
    cells = ["plain", "", "a;b,c", 'say ""this""', "two\nlines", "\n", "x\n\ny\n", "many\n" * 30, "ß漢", "tail\r\nkept"]
    with open(path, "w", newline="") as out:
        out.write('id,"the\ntext",n\n')
        for i in range(n):
            cell = draw.choice(cells)
            quoted = f'"{cell}"' if any(ch in cell for ch in ',\n"') else cell
            out.write(f"{i},{quoted},{draw.random():.3f}" + draw.choice(["\n", "\n", "\r\n", "\n\n"]))
    return pd.read_csv(path, keep_default_na=False, dtype=str, lineterminator=None)


@pytest.mark.parametrize("size", [64, 1000, 10**8])
def test_line_breaks_in_fields_over_byte_ranges(spark, tmp_path, size):
    """Records are found wherever the ranges cut the files, also those that span several ranges."""
    want = pd.concat([quoted_file(tmp_path / f"{i}.csv", i) for i in range(2)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = delimited.read_delimited(spark, str(tmp_path), infer=False)
        if size == 1000:
            assert quoted._lines(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 10
        rows = [tuple("" if v is None else v.replace("\r\n", "\n") for v in r) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got.columns == list(want.columns)
    wanted = [tuple(v.replace("\r\n", "\n") for v in r) for r in want.itertuples(index=False, name=None)]
    assert sorted(rows) == sorted(wanted)


def test_a_quote_that_never_closes_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="left open"):
        delimited.read_delimited(spark, str(tmp_path)).collect()
