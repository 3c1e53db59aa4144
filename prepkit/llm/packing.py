"""Concatenate and cut: token streams of documents as sequences of one fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.order import running_starts
from prepkit.llm.shared import col, map_arrow, slices, width, written
from prepkit.llm.tokens import encoder

LENGTH = 2048
END_ID = 1


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Ids of each document with the end id, and where they start in this partition's stream."""
    part, at = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text", 4_000_000):
            ids, counts = encoder(path).encode(batch["text"])
            ends = np.cumsum(counts + 1)
            stream = np.full(int(ends[-1]), end_id, np.uint32)
            body = np.ones(len(stream), bool)
            body[ends - 1] = False
            stream[body] = ids
            raw = stream.astype("<u4").tobytes()
            offsets = np.concatenate([[0], 4 * ends])
            rows = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(np.full(len(rows), part, np.int32)), pa.array(at + ends - counts - 1),
                 pa.array(counts + 1), pa.array(rows, pa.binary())],
                ["id", "part", "start", "n", "ids"])
            at += int(ends[-1])


def token_streams(df: DataFrame, key: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """(id, part, start, n, ids): first pass, documents in key order (null first), dealt by key ranges and written.

    `start` counts the ids before the document within its part; `ids` are little-endian 32-bit.
    """
    rows = df.select(col(key).alias("id"), col(text).cast("string").alias("text"))
    dealt = rows.repartitionByRange(width(df), "id").sortWithinPartitions("id")
    return written(map_arrow(
        dealt, lambda batches: _encode(batches, tokenizer, end_id),
        f"id {df.schema[key].dataType.simpleString()}, part int, start long, n long, ids binary"), "streams")


def stream_starts(streams: DataFrame) -> DataFrame:
    """(part, before, total): second pass, the prefix sums over the parts' totals; one row per part."""
    totals = streams.groupBy("part").agg(F.max(F.col("start") + F.col("n")).alias("total"))
    return running_starts(totals, "part", "total", [], "before")


def _cut(batches: Iterator[pa.RecordBatch], length: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Cut documents, which carry their global start, at multiples of `length`."""
    for batch in batches:
        rows = []
        ids = batch["ids"].to_pylist()
        for name, start, n, raw in zip(batch["id"].to_pylist(), batch["at"].to_pylist(), batch["n"].to_pylist(),
                                       ids, strict=True):
            done = 0
            while done < n:
                sequence, offset = divmod(start + done, length)
                take = min(length - offset, n - done)
                rows.append((sequence, offset, name, done, take, n, raw[4 * done:4 * (done + take)]))
                done += take
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), key_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", "ids"])


def pieces(
    df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: sequence_id, offset in it, doc_id, start (the document's ids before it), length,
    doc_tokens, ids (binary, little-endian 32-bit).

    Documents lie one after the other in key order, each with `end_id` at its end, and the stream is
    cut every `length` ids: only the last sequence has room left. Every id lies in one piece. A null or
    empty text is its end id alone. Rows with equal or null keys are documents of their own.
    A window that spans partitions gets its pieces from each: they carry global places, so nothing
    has to be gathered to number them.
    """
    streams = token_streams(df, key, text, tokenizer, end_id)
    starts = stream_starts(streams)  # at most one row per part
    placed = streams.join(F.broadcast(starts), "part").select(
        "id", (F.col("start") + F.col("before")).alias("at"), "n", "ids")
    kind = df.schema[key].dataType.simpleString()
    key_type = df.select(col(key)).limit(0).toArrow().schema.field(0).type
    return map_arrow(placed, lambda batches: _cut(batches, length, key_type), (
        f"sequence_id long, offset long, doc_id {kind}, start long, length long, doc_tokens long, ids binary"))


def sequences(
    df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
    end_id: int = END_ID, pad_id: int = 0,
) -> DataFrame:
    """One row per sequence: sequence_id, ids (array of `length`, the last one padded with `pad_id`), n_padding,
    pieces (doc_id, start, length, doc_tokens, offset).

    A sequence has at most `length` pieces, so a group here is small whatever the documents' sizes.
    """
    cut = pieces(df, tokenizer, key, text, length, end_id)
    ids = F.concat_ws("", F.transform("rows", lambda r: F.hex(r["ids"])))
    words = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.substring(
        F.col("hex"), i * 8 + 1, F.lit(8)))
    little = F.transform(words, lambda h: F.when(h == "", F.lit(pad_id)).otherwise(F.conv(F.concat(
        F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2)), 16, 10).cast("int")))
    grouped = cut.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct(
        "offset", "doc_id", "start", "length", "doc_tokens", "ids"))).alias("rows"))
    return grouped.withColumn("hex", ids).select(
        "sequence_id", little.alias("ids"),
        (F.lit(length) - F.aggregate("rows", F.lit(0).cast("long"), lambda s, r: s + r["length"])).alias("n_padding"),
        F.transform("rows", lambda r: F.struct(
            r["doc_id"].alias("doc_id"), r["start"].alias("start"), r["length"].alias("length"),
            r["doc_tokens"].alias("doc_tokens"), r["offset"].alias("offset"))).alias("pieces"))
