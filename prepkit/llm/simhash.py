"""SimHash near-duplicates: a byte-position index with a guaranteed count of shared bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.components import components
from prepkit.llm.shared import col, map_arrow, slices, spare_name, written

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
BYTES = 8
RUN = 50_000
"""Shingles whose bits are counted at once."""


def fingerprint(text: bytes | None) -> int:
    """The signed 64-bit SimHash; 0 for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, RUN):
        some = words[start:min(n, start + RUN) + SHINGLE_WORDS - 1]
        if len(words) < SHINGLE_WORDS:
            shingles = [b" ".join(words)]
        else:
            shingles = map(b" ".join, zip(*(some[k:] for k in range(SHINGLE_WORDS)), strict=False))
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, BYTES), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            found = [fingerprint(text) for text in batch["text"].cast(pa.binary()).to_pylist()]
            rest = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*[batch[name] for name in rest], pa.array(found, pa.int64())], [*rest, "fp"])


def _masks() -> list[int]:
    """For each choice of the bytes that must agree, a mask of their bits (signed)."""
    need = BYTES - MAX_BITS  # each differing bit spoils one byte at most
    masks = [sum(0xFF << (8 * k) for k in kept) for kept in combinations(range(BYTES), need)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _links(members: np.ndarray) -> np.ndarray:
    """(a, b) rows that connect the fingerprints of a bucket at MAX_BITS or fewer differing bits.

    Members agree in all but MAX_BITS bytes, so at most 2**16 of them are distinct. In a large bucket each member
    probes for the few values that differ in that many bits, instead of meeting all others.
    """
    values = np.unique(members)
    if len(values) <= 64:
        x = np.bitwise_count(values[:, None] ^ values[None, :])
        a, b = np.nonzero(np.triu(x <= MAX_BITS, 1))
        return np.stack([values[a], values[b]], 1)
    free = np.bitwise_or.reduce(values ^ values[0])
    bits = [np.int64(np.uint64(1) << np.uint64(k)) for k in range(64) if free >> k & 1]
    flips = [np.bitwise_xor.reduce(np.array(c, np.int64)) for n in range(1, MAX_BITS + 1) for c in combinations(bits, n)]
    root = np.arange(len(values))
    found = []
    for flip in flips:
        other = values ^ flip
        at = np.searchsorted(values, other)
        at[at == len(values)] = 0
        hit = (values[at] == other) & (values < other)
        found.append(np.stack([np.nonzero(hit)[0], at[hit]], 1))
    pairs = np.concatenate(found)
    while len(pairs):  # a spanning star per cluster says as much as all its links
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(values))
    return np.stack([values[root[moved]], values[moved]], 1)


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_links(np.asarray(m, np.int64)) for m in batch["members"].to_pylist()]
        pairs = np.concatenate([np.empty((0, 2), np.int64), *found])
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints exactly as all pairs at MAX_BITS or fewer bits do.

    Two such fingerprints share at least 6 of their 8 bytes in place. The index therefore lists each
    fingerprint under every choice of 6 positions with the bytes there: a pair meets exactly if its
    tally of shared positional bytes reaches the guaranteed minimum. (Postings of single bytes
    would hold a 256th of all rows each, so their tallies would grow with the square of the input.)
    Buckets of two are settled by their least and largest member; larger ones are gathered, which is
    bounded by the 2**16 values of the free bytes. Each met pair is verified by its differing bits.
    """
    masks = F.array(*[F.lit(m) for m in _masks()])
    entries = fingerprints.select(
        "fp", F.posexplode(F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))).alias("choice", "shared"))
    buckets = entries.groupBy("choice", "shared").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    buckets = written(buckets, "buckets")
    pairs = buckets.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
    full = (
        entries.join(buckets.filter("n > 2").select("choice", "shared"), ["choice", "shared"])
        .groupBy("choice", "shared").agg(F.collect_list("fp").alias("members")).select("members"))
    return pairs.select("a", "b").union(map_arrow(full, _bucket_links, "a long, b long")).distinct()


def _rooted(made: DataFrame) -> DataFrame:
    """(fp, least, root): each distinct fingerprint, its least id, and the least fingerprint of its component."""
    nodes = written(made.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp")), "a", "b")
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits), component_id.

    A-Z is lowered, words are runs without `[ \\t-\\r]`, shingles are 3 words joined by a space,
    repeats included; fewer words make one shingle. A bit is set if it is set in more than half of the
    shingles' XXH64 (seed 42). A text without words, null too, has fingerprint 0 and is linked like
    any other. `component_id` is the smallest id that links of MAX_BITS or fewer differing bits reach,
    the document's own included; null ids are no such candidate unless a component has no other.
    Copies share a fingerprint and are one node of the graph, however many there are.
    """
    rows = df.select(col(key).alias("id"), col(text).cast("string").alias("text"))
    made = written(map_arrow(
        rows, _fingerprints, f"id {df.schema[key].dataType.simpleString()}, fp long"), "fingerprints")
    rooted = _rooted(made)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("node_fp"), "component_id")
    return made.join(named, made["fp"] == named["node_fp"]).select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `df` per component: that of the least id (null ids last), then fingerprint, then text digest.

    Rows of equal id and text are copies, of which any stays. Rows of one id with texts of different components,
    and components without an id, each keep their own row.
    """
    rows = df.select(col(key).alias("id"), col(text).cast("string").alias("text"))
    made = written(map_arrow(
        rows.withColumn("digest", F.md5("text")), _fingerprints,
        f"id {df.schema[key].dataType.simpleString()}, digest string, fp long"), "fingerprints")
    rooted = _rooted(made).select(F.col("fp").alias("node_fp"), "root")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp", "digest")).alias("lead")
    leads = made.join(rooted, made["fp"] == rooted["node_fp"]).groupBy("root").agg(first).select(
        F.col("lead.id").alias("lead_id_"), F.col("lead.digest").alias("lead_digest_"))
    digest = spare_name(df, "digest")
    marked = df.withColumn(digest, F.md5(col(text).cast("string")))
    met = col(key).eqNullSafe(F.col("lead_id_")) & col(digest).eqNullSafe(F.col("lead_digest_"))
    return marked.join(leads.hint("merge"), met, "left_semi").dropDuplicates([key, digest]).drop(digest)
