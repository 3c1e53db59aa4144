"""Table-level profiling: sizes, previews, missing counts, 0/1 summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.functions.naming import free_name
from prepkit.functions.schema import (
    as_double, as_list, c, check_columns, check_numeric, clean, inline_rows,
)
from prepkit.plans.bounds import cut_lineage
from prepkit.plans.cuts import whole_row_hash
from prepkit.plans.ranges import running_count

PAGE_ROWS = 20


def table_kpis(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def preview(
    df: DataFrame, key: str | Sequence[str], rows: int = PAGE_ROWS, after: Sequence | None = None
) -> DataFrame:
    """One page in key order, nulls last; `after` is the last key of the page before, null parts as None.

    Keys must tell rows apart: of rows with equal keys that a page ends between, the rest is not shown. `page` shows
    every row of any table.

    The key filter reaches the scan and the top-n keeps `rows` rows per task, so a late
    page costs no more than the first.
    """
    keys = as_list(key)
    check_columns(df, keys, "Key column")
    if after is not None:
        later, tied = F.lit(False), F.lit(True)
        for name, last in zip(keys, after, strict=True):
            if last is None:  # nulls are last: nothing comes after one
                tied = tied & c(name).isNull()
            else:
                later = later | (tied & ((c(name) > F.lit(last)) | c(name).isNull()))
                tied = tied & (c(name) == F.lit(last))
        reached = c(keys[0]).isNull()
        if after[0] is not None:
            reached = reached | (c(keys[0]) >= F.lit(after[0]))
        df = df.where(reached).where(F.coalesce(later, F.lit(False)))
    return df.orderBy(*[F.asc_nulls_last(c(k)) for k in keys]).limit(rows)


class Page(NamedTuple):
    """`rows`: one page, a local table. `cursor`: where the next one begins; None after the last."""

    rows: DataFrame
    cursor: tuple | None


def page(df: DataFrame, key: str | Sequence[str], rows: int = PAGE_ROWS, after: tuple | None = None) -> Page:
    """The page that begins at cursor `after`, in the order of key, nulls last, and row digest.

    The cursor is the last row's key and digest and the number of its copies already shown: copies are
    interchangeable, so it does not matter which of them come first. Going on until the cursor is None shows
    every row once, whatever keys are equal or null. A page reads the table twice at most and keeps `rows` rows
    per task.
    """
    keys = as_list(key)
    check_columns(df, keys, "Key column")
    mark = free_name("row_digest", df.columns)
    order = [*[F.asc_nulls_last(c(k)) for k in keys], F.asc(c(mark))]
    marked = df.withColumn(mark, whole_row_hash(df))
    copies = 0
    if after is None:
        shown = marked.orderBy(*order).limit(rows + 1).toArrow()
    else:
        *last, digest, copies = after
        later, tied = F.lit(False), F.lit(True)
        for name, value in zip([*keys, mark], [*last, digest], strict=True):
            kind = marked.schema[name].dataType
            if value is not None:
                later = later | (tied & (c(name).isNull() | (c(name) > F.lit(value).cast(kind))))
            tied = tied & c(name).eqNullSafe(F.lit(value).cast(kind))
        left = marked.where(tied).limit(copies + rows + 1).count() - copies
        same = marked.where(tied).limit(min(left, rows + 1)).toArrow()
        rest = marked.where(F.coalesce(later, F.lit(False))).orderBy(*order).limit(rows + 1 - same.num_rows).toArrow()
        shown = pa.concat_tables([same, rest.cast(same.schema)])
    more, shown = shown.num_rows > rows, shown.slice(0, rows)
    cursor = None
    if more:
        *last, digest = (shown[n][-1].as_py() for n in [*keys, mark])
        here = sum(d == digest for d in shown[mark].to_pylist())
        goes_on = after is not None and after[-2] == digest
        cursor = (*last, digest, here + (copies if goes_on else 0))
    return Page(df.sparkSession.createDataFrame(shown.drop_columns([mark]), df.schema), cursor)


class Pages:
    """All pages of a table, in the order of `page`; iterating gives them one after the other, each a local table."""

    def __init__(self, df: DataFrame, key: str | Sequence[str], rows: int = PAGE_ROWS):
        self.df, self.keys, self.size = df, as_list(key), rows
        check_columns(df, self.keys, "Key column")

    @cached_property
    def numbered(self) -> DataFrame:
        """`row`, its `place` from 1 and its `page` from 0: two sorts by range, however many pages there are.

        Copies of a row are told apart by their place in a table that is written once, so no task holds them all.
        """
        df = self.df
        keys = [(F.isnull(c(k)).alias(f"gone{i}"), c(k).alias(f"key{i}")) for i, k in enumerate(self.keys)]
        marked = df.select(
            F.struct(*[c(n) for n in df.columns]).alias("row"), *[x for pair in keys for x in pair],
            whole_row_hash(df).alias("digest"), F.lit(0).alias("all"))
        marked = cut_lineage(marked).withColumn("copy", F.monotonically_increasing_id())
        order = [x for x in marked.columns if x not in ("row", "all")]
        placed = running_count(marked, "all", order, F.lit(True), "place", marked.count())
        return cut_lineage(placed.select("row", "place", F.expr(f"(place - 1) div {int(self.size)}").alias("page")))

    def together(self) -> DataFrame:
        """The rows of all pages."""
        return self.numbered.select(*[F.col("row").getField(n).alias(n) for n in self.df.columns])

    def __iter__(self) -> Iterator[DataFrame]:
        """One pass over the numbered rows; the driver holds those of one range of pages."""
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pages, rows = batch.column("page").to_pylist(), batch.select(["row"])
                starts = [i for i, p in enumerate(pages) if i == 0 or p != pages[i - 1]]
                bodies = []
                for i, j in zip(starts, [*starts[1:], len(pages)]):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema) as out:
                        out.write_batch(rows.slice(i, j - i))
                    bodies.append(sink.getvalue().to_pybytes())
                yield pa.RecordBatch.from_pydict({"page": pa.array([pages[i] for i in starts], pa.int64()), "body": bodies})

        spark, schema = self.df.sparkSession, self.df.schema
        pieces = self.numbered.orderBy("place").select("row", "page").mapInArrow(cut, "page bigint, body binary")
        shown = False
        for _, same in groupby(pieces.toLocalIterator(), key=lambda r: r["page"]):
            rows = pa.concat_tables([pa.ipc.open_stream(bytes(r["body"])).read_all() for r in same]).combine_chunks()
            fields = pa.concat_arrays(rows["row"].chunks).flatten()
            yield spark.createDataFrame(pa.table(fields, names=self.df.columns), schema)
            shown = True
        if not shown:
            yield spark.createDataFrame([], schema)


def pages(df: DataFrame, key: str | Sequence[str], rows: int = PAGE_ROWS) -> Pages:
    """All pages of a table, one after the other; `together` has them all in one table."""
    return Pages(df, key, rows)


def _rows_and_gaps(df: DataFrame, column: str) -> DataFrame:
    gaps = F.count_if(clean(df, column).isNull())
    return df.agg(F.struct(F.count(F.lit(1)).alias("rows"), gaps.alias("missing")).alias("s"))


def missing_before_after(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Row and missing counts of a column on either side of a cleaning step."""
    check_columns(before, [column])
    check_columns(after, [column])
    return (
        _rows_and_gaps(before, column).withColumn("t", _rows_and_gaps(after, column).scalar())
        .select(
            F.col("s.rows").alias("rows_before"), F.col("t.rows").alias("rows_after"),
            F.col("s.missing").alias("missing_before"), F.col("t.missing").alias("missing_after"),
        )
    )


def _per_column(df: DataFrame, columns: Sequence[str], parts: dict[str, list[Column]]) -> DataFrame:
    """One scan, one wide row, then one row per column."""
    names = list(parts)
    wide = df.agg(*[
        F.struct(*[p.alias(n) for n, p in zip(names, [parts[n][i] for n in names])]).alias(f"s{i}")
        for i in range(len(columns))
    ])
    rows = [
        F.struct(F.lit(x).alias("column"), *[F.col(f"s{i}.{n}").alias(n) for n in names])
        for i, x in enumerate(columns)
    ]
    return inline_rows(wide, rows)


def binary_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ones, zeros, missing and mean of each 0/1 column."""
    for name in columns:
        check_numeric(df, name)
    xs = [as_double(df, name) for name in columns]
    return _per_column(df, columns, {
        "ones": [F.count_if(x == 1) for x in xs],
        "zeros": [F.count_if(x == 0) for x in xs],
        "missing": [F.count_if(x.isNull()) for x in xs],
        "mean": [F.avg(x) for x in xs],
    })


def top_missing_columns(df: DataFrame, n: int = 10) -> DataFrame:
    """The n columns with most missing values."""
    gaps = [F.count_if(clean(df, name).isNull()) for name in df.columns]
    return (
        _per_column(df, df.columns, {"missing": gaps})
        .orderBy(F.desc("missing"), F.asc("column")).limit(n)
    )
