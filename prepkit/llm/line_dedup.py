"""Drop lines that several documents share, except in the first of these documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import ASCII_SPACE, col, map_arrow, slices, written

KEY_BYTES = 16
"""128-bit digests stand for normalised lines in shuffles."""


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Digest of the stripped, A-Z-lowered line; None below `min_chars` code points."""
    key = line.strip(ASCII_SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=KEY_BYTES).digest()


def _keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            keys, owners = [], []
            for i, text in enumerate(batch["text"].cast(pa.binary()).to_pylist()):
                found = {line_key(line, min_chars) for line in (text or b"").split(b"\n")}
                found.discard(None)
                keys += found
                owners += [i] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch["id"].take(pa.array(owners, pa.int64()))], ["key", "id"])


def _rebuild(batches: Iterator[pa.RecordBatch], min_chars: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(
                    batch["text"].cast(pa.binary()).to_pylist(), batch["gone"].to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                n_lines.append(len(lines))
                if gone:
                    gone = set(gone)
                    lines = [line for line in lines if line_key(line, min_chars) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(b"\n".join(lines))
            yield pa.RecordBatch.from_arrays(
                [*[batch[name] for name in keep], pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                [*keep, "kept_text", "n_lines", "n_dropped"])


def line_keys(df: DataFrame, key: str, text: str, min_chars: int = 10) -> DataFrame:
    """(key, id): the digests of each document's lines, once per document; written once."""
    rows = df.select(col(key).alias("id"), col(text).cast("string").alias("text"))
    return written(map_arrow(
        rows, lambda batches: _keys(batches, min_chars),
        f"key binary, id {df.schema[key].dataType.simpleString()}"), "line-keys")


def shared_lines(lines: DataFrame, min_docs: int = 2) -> DataFrame:
    """(key, first): the lines that at least `min_docs` documents hold, with the smallest id.

    Lines are told apart by digest; a document's repeats of a line count once. Counting distinct
    documents goes over (line, document) first, so a line that every document holds is pre-aggregated
    on many tasks and not gathered in one.
    """
    if min_docs == 2:  # two different documents exist exactly if the smallest and the largest differ
        held = lines.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                        F.max(F.col("id").isNull()).alias("unknown"))
        shared = held.filter((F.col("first") != F.col("last")) | (F.col("unknown") & F.col("first").isNotNull()))
        return shared.select("key", "first")
    held = lines.distinct().groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    return held.filter(F.col("n") >= min_docs).select("key", "first")


def dedup_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2,
) -> DataFrame:
    """Add kept_text, n_lines (before dropping) and n_dropped.

    A line's key is the line without `[ \\t-\\r]` at both ends and with A-Z in lower case. Keys of at
    least `min_chars` code points found in at least `min_docs` documents lose all their lines except
    in the document with the smallest id. A null or empty text is one empty line. A null id is one
    unknown document that comes after all others; rows of equal ids are one document. Columns that
    clash with the added ones are replaced.

    Only digests and ids are shuffled to count lines. The texts move once, to meet their document's
    list of lost lines, and are put together again by position inside their row.
    """
    lines = line_keys(df, key, text, min_chars)
    shared = shared_lines(lines, min_docs)
    lost = (
        lines.join(shared, "key").filter(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id").agg(F.collect_set("key").alias("gone")))
    others = [name for name in df.columns if name not in (text, "kept_text", "n_lines", "n_dropped")]
    safe = {name: f"c{i}" for i, name in enumerate([*others, text])}
    rows = df.select(*[col(name).alias(safe[name]) for name in others], col(text).cast("string").alias("text"))
    lost = lost.select(F.col("id").alias("lost_id"), "gone")
    joined = rows.join(lost.hint("shuffle_hash"), rows[safe[key]].eqNullSafe(lost["lost_id"]), "left")
    keep = [*[safe[name] for name in others], "text"]
    schema = "".join(f"{safe[n]} {df.schema[n].dataType.simpleString()}, " for n in others)
    done = map_arrow(
        joined.drop("lost_id"), lambda batches: _rebuild(batches, min_chars, keep),
        f"{schema}text string, kept_text string, n_lines long, n_dropped long")
    names = {safe[name]: name for name in others} | {"text": text}
    return done.select(*[F.col(s).alias(names[s]) for s in keep], "kept_text", "n_lines", "n_dropped")
