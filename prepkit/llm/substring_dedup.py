"""Repeated passages: paragraphs by MinHash bands, verified by exact Jaccard, removed by components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.components import components
from prepkit.llm.shared import ASCII_SPACE, col, map_arrow, slices, spare_name, written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
"""A pair at the threshold shares a band with probability 1 - (1 - 0.8**4)**14 = 0.9994."""

MIN_WORDS = 20
"""Shorter paragraphs (headings, list items) are left to line dedup."""

WINDOW_WORDS, REACH = 25, 26
"""Windows of 25 words from the least of 26 shingles in a row: every stretch of 50 words holds a whole one."""

WINDOW_BANDS, WINDOW_ROWS = 2, 2
"""A pair of windows at the threshold shares a band with probability 0.87, equal ones always; passages hold several."""

SMALL_BUCKET = 24
"""Texts of a bucket up to which all its pairs are compared, at most 12 for each text."""

LEAD_TURNS = 2
"""Rounds of comparing with drawn leads before the exact search; more of them save pairs, none loses any."""

BATCH = 1_500_000
SEED = 20240229


def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def _space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(ASCII_SPACE)] = True
    return table


IS_SPACE = _space_table()


class Words:
    """The words of some texts in a row: lower-case bytes, byte spans, whose text each is."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        self.text_start = np.cumsum([0] + [len(r) + 1 for r in raw])
        joined = b"\n".join(raw)
        buf = np.frombuffer(joined, np.uint8)
        space = IS_SPACE[buf]
        edge = np.ones(1, bool)
        self.start = np.flatnonzero(~space & np.concatenate([edge, space[:-1]]))
        self.stop = np.flatnonzero(~space & np.concatenate([space[1:], edge])) + 1
        self.words = joined.lower().split()
        self.owner = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.line_start = np.concatenate([[0], np.flatnonzero(buf == 10) + 1])
        self.characters = np.concatenate([np.zeros(1, np.int32), np.cumsum((buf & 0xC0) != 0x80, dtype=np.int32)])
        codes = np.array(self.words, object)
        codes = pd.util.hash_array(codes, categorize=True).astype(np.uint64) if len(codes) else np.empty(0, np.uint64)
        self.shingles = _mixed(codes)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 word of each line of at least MIN_WORDS words."""
        first = np.searchsorted(self.start, self.line_start)
        last = np.append(first[1:], len(self.start))
        keep = last - first >= MIN_WORDS
        return first[keep], last[keep]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 word of the windows that start at the least shingle of some REACH shingles in a row."""
        h = self.shingles
        if len(h) < REACH:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        least = _running(np.minimum, h, REACH)
        n = len(least)
        least[self.owner[:n] != self.owner[REACH + SHINGLE_WORDS - 2:]] = 0  # crosses into another text
        most = _running(np.maximum, np.concatenate([np.zeros(REACH - 1, np.uint64), least, np.zeros(REACH - 1, np.uint64)]), REACH)
        chosen = most == h
        chosen[1:] &= h[1:] != h[:-1]  # a run of one repeated word has one window
        first = np.flatnonzero(chosen)
        first = first[first + size <= len(self.owner)]
        first = first[self.owner[first] == self.owner[first + size - 1]]
        return first, first + size

    def character(self, byte: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self.characters[byte] - self.characters[self.text_start[owner]]

    def places(self, first: np.ndarray) -> np.ndarray:
        """Line numbers, within their texts, of some words."""
        line = np.searchsorted(self.line_start, self.start[first], side="right")
        return line - np.searchsorted(self.line_start, self.text_start[self.owner[first]], side="right")


def _running(pick: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """pick.reduce over each `size` values in a row, by doubling."""
    out, done = values.copy(), 1
    while done < size:
        step = min(done, size - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Hashes of each SHINGLE_WORDS word codes in a row."""
    mixed = np.zeros(max(0, len(codes) - SHINGLE_WORDS + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE_WORDS):
            mixed = (mixed ^ codes[k:k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
    return mixed


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=8).digest()


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each range; ranges may overlap."""
    ends = np.empty(2 * len(first), np.int64)
    ends[::2], ends[1::2] = first, last
    return np.minimum.reduceat(np.append(values, np.uint64(0)), ends)[::2]


def _buckets(shingles: np.ndarray, first: np.ndarray, last: np.ndarray, bands: int, rows: int, salt: int) -> np.ndarray:
    """Bucket keys by band of the paragraphs, which lie in [first, last) words."""
    odd, shift = _mixers()
    keys = np.zeros((len(first), bands), np.uint64)
    if len(first):
        with np.errstate(over="ignore"):
            for i in range(bands * rows):
                least = _least(shingles * odd[i] + shift[i] ^ shingles >> np.uint64(31), first, last - SHINGLE_WORDS + 1)
                keys[:, i // rows] = (keys[:, i // rows] ^ least) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(i + salt)
    return keys.view(np.int64)


def _paragraphs(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Paragraphs with span, digest and bucket keys; a digest that a batch repeats has its keys once."""
    part, at = TaskContext.get().partitionId() << 33, 0
    for whole in batches:
        for batch in slices(whole, "text", BATCH):
            words = Words(batch["text"].to_pylist())
            kinds = [(False, *words.lines(), BANDS, ROWS, 0)]
            if window:
                kinds.append((True, *words.windows(window), WINDOW_BANDS, WINDOW_ROWS, BANDS * ROWS))
            seen: set[bytes] = set()
            for is_window, first, last, bands, rows, salt in kinds:
                digests = [_digest(words.words[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                new = np.zeros(len(first), bool)
                for i, digest in enumerate(digests):
                    if (is_window, digest) not in seen:
                        seen.add((is_window, digest))
                        new[i] = True
                keys = _buckets(words.shingles, first[new], last[new], bands, rows, salt)
                ends = np.concatenate([[0], np.cumsum(new * bands)]).astype(np.int32)
                owner = words.owner[first]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(pa.array(owner)), batch["th"].take(pa.array(owner)), pa.array(part + at + owner),
                     pa.array(words.places(first).astype(np.int32)), pa.array(words.character(words.start[first], owner), pa.int64()),
                     pa.array(words.character(words.stop[last - 1], owner), pa.int64()), pa.array(np.full(len(first), is_window)),
                     pa.array(np.frombuffer(b"".join(digests), "<i8")),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    ["id", "th", "uid", "place", "start", "stop", "window", "digest", "buckets"])
            at += batch.num_rows


def _hashes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingle hashes of all paragraphs in a row, and where each paragraph begins."""
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.array([w for some in words for w in some], object)
    mixed = _mixed(pd.util.hash_array(flat, categorize=True).astype(np.uint64))
    ends = np.cumsum(counts)
    inside = np.ones(len(mixed), bool)
    for back in range(1, SHINGLE_WORDS):
        crossing = ends[:-1] - back
        inside[crossing[crossing < len(mixed)]] = False
    sizes = counts - SHINGLE_WORDS + 1
    return mixed[inside], np.cumsum(sizes) - sizes


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct shingle hashes of single paragraphs, sorted."""
    for batch in batches:
        words = [t.encode().lower().split() for t in batch["text"].to_pylist()]
        shingles, begins = _hashes(words)
        sets = [np.unique(s) for s in np.split(shingles, begins[1:])] if words else []
        flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch["digest"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["digest", "shingles"])


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the asked paragraphs (start, stop, digest); a span that holds another text is left out."""
    for whole in batches:
        for batch in slices(whole, "text", BATCH):
            digests, texts = [], []
            for text, asked in zip(batch["text"].to_pylist(), batch["asked"].to_pylist(), strict=True):
                for one in asked:
                    words = (text or "")[one["start"]:one["stop"]].encode().lower().split()
                    if int.from_bytes(_digest(words), "little", signed=True) == one["digest"]:
                        digests.append(one["digest"])
                        texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(texts, pa.string())], ["digest", "text"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b, whatever else) whose distinct shingles have at least that Jaccard similarity."""
    one = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    met = pairs.join(one, "a").join(two, "b").withColumn("both", both)
    return met.filter(F.col("both") >= similarity * (F.size("x") + F.size("y") - F.col("both"))).select(*pairs.columns)


def _rare_shingles(texts: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(digest, shingle, n, left): the |x| - ceil(similarity * |x|) + 1 rarest shingles of each set x of n shingles.

    Two sets of that Jaccard similarity share one of these, as the order is one for all. `left` counts the
    shingle itself and all that are less rare: no pair whose rarest common shingle it is shares more.
    """
    each = written(texts.join(sets, "digest").select(
        "digest", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")), "shingles")
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    ranked = each.join(held, "shingle").groupBy("digest", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("ranked"))
    alone = F.col("n") - F.size("ranked")  # the rarest of all: no other text has them
    first = F.col("n") - F.ceil(similarity * F.col("n") - 1e-9).cast("int") + 1
    listed = ranked.withColumn("alone", alone).filter(first > alone).select(
        "digest", "n", "alone", F.posexplode(F.slice("ranked", F.lit(1), first - alone)).alias("at", "r"))
    return listed.select(
        "digest", F.col("r.shingle").alias("shingle"), "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"))


def _leads(rare: DataFrame, turn: int) -> DataFrame:
    """Pairs of the texts under a rare shingle with two of them, drawn anew for each shingle, where components differ."""
    drawn = F.struct(F.xxhash64("digest", "shingle", F.lit(turn)).alias("drawn"), "digest", "comp")
    ends = rare.groupBy("shingle").agg(F.min(drawn).alias("lo"), F.max(drawn).alias("hi"))
    met = rare.join(ends.filter("lo.digest <> hi.digest"), "shingle").select(
        F.col("digest").alias("a"), F.col("comp").alias("u"), F.inline(F.array("lo", "hi")).alias("drawn", "b", "v"))
    return met.filter("u <> v").select("a", "b", "u", "v").distinct()


def _meetings(rare: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of different components u and v that can have that similarity; a is the smaller set.

    Sets of n <= m shingles must share t = similarity / (1 + similarity) * (n + m) of them, and t is at least
    2 * similarity / (1 + similarity) * n. So the smaller one needs only as many of its rarest shingles as leave t
    of this size. Components meet under a shingle only if some of their texts can.
    """
    share = similarity / (1 + similarity)
    fits = F.col("left") >= 2 * share * F.col("n") - 1e-9

    def parts(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy("shingle", F.col("comp").alias(side)).agg(
            F.min("n").alias(f"least_{side}"), F.max("left").alias(f"left_{side}"))

    needed = share * (F.col("least_u") + F.col("least_v")) - 1e-9
    meet = parts(rare.filter(fits), "u").join(parts(rare, "v"), "shingle").filter(
        (F.col("u") != F.col("v")) & (F.least("left_u", "left_v") >= needed)).select("shingle", "u", "v")
    one = rare.filter(fits).select(
        "shingle", F.col("comp").alias("u"), F.col("digest").alias("a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"))
    two = rare.select(
        "shingle", F.col("comp").alias("v"), F.col("digest").alias("b"), F.col("n").alias("n_b"), F.col("left").alias("left_b"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    enough = F.least("left_a", "left_b") >= share * (F.col("n_a") + F.col("n_b")) - 1e-9
    return meet.join(one, ["shingle", "u"]).join(two, ["shingle", "v"]).filter(ordered & enough).select("a", "b", "u", "v").distinct()


def _linked(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(node, root): components of the similar pairs among the texts that share a bucket.

    In buckets of up to SMALL_BUCKET texts all pairs are compared. In a larger one every text is compared with the
    bucket's least one. The texts of large buckets that still fall apart are indexed by their rarest shingles: at
    first each is compared with two of those under the same shingle, LEAD_TURNS times, which is linear and unites
    large groups; then all pairs of different components that can be similar are compared, so that no link is lost.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    sized = written(members.join(sizes, "bucket"), "sized")
    small = sized.filter(F.col("size") <= SMALL_BUCKET)
    other = small.select("bucket", F.col("digest").alias("b"))
    pairs = small.select("bucket", F.col("digest").alias("a")).join(other, "bucket").filter("a < b").select("a", "b")
    big = sized.filter(F.col("size") > SMALL_BUCKET)
    star = big.filter("digest <> lead").select(F.col("lead").alias("a"), F.col("digest").alias("b"))
    links = _verified(pairs.unionByName(star).distinct(), sets, similarity)
    nodes = members.select(F.col("digest").alias("node")).distinct()
    roots = written(nodes.join(components(links, "a", "b"), "node", "left").withColumn("root", F.coalesce("root", "node")), "roots")
    placed = big.select("bucket", F.col("digest").alias("node")).join(roots, "node")
    torn = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    texts = placed.join(torn, "bucket").select(F.col("node").alias("digest")).distinct()
    rare = written(_rare_shingles(texts, sets, similarity), "rare")
    for turn in range(LEAD_TURNS + 1):
        owned = written(rare.join(roots.select(F.col("node").alias("digest"), F.col("root").alias("comp")), "digest"), "owned")
        met = _leads(owned, turn) if turn < LEAD_TURNS else _meetings(owned, similarity)
        found = _verified(met, sets, similarity)
        joined = components(found, "u", "v").select(F.col("node").alias("comp"), F.col("root").alias("whole"))
        roots = written(roots.withColumnRenamed("root", "comp").join(joined, "comp", "left").select(
            "node", F.coalesce("whole", "comp").alias("root")), "roots")
    return roots


def repeated_paragraphs(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, window: int | None = None,
) -> DataFrame:
    """One row per paragraph that has an equal or similar one elsewhere: key, place (number from 0 of the line it
    starts on), start and stop (characters), window, cluster_id and cluster_place (the cluster's first paragraph by key
    and start), n_paragraphs of the cluster, removed.

    A paragraph is a line of at least MIN_WORDS words, compared by its lower-case words. With `window`, stretches of
    that many words are paragraphs too, across lines: they start where the hash of five words is the least of REACH
    in a row, so equal passages have equal windows wherever they stand. A stretch of REACH + window - 1 words that two
    texts share holds one of them (a run of one repeated word has only the window at its start). Windows count as repeated only in another row.
    Equal paragraphs count as one text, however many there are. Texts that share a MinHash band are verified by the
    Jaccard similarity of their distinct five-word shingles; clusters are the components of the verified pairs.
    Removed are all paragraphs but the cluster's first and the windows of the row that holds it.
    Null and empty texts have no paragraphs. Rows with equal ids are read as separate texts; null ids come first.
    """
    if window is not None and window < MIN_WORDS:
        raise ValueError(f"window must be at least {MIN_WORDS} words")
    rows = df.select(col(key).alias("id"), col(text).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    kind = df.schema[key].dataType.simpleString()
    found = written(map_arrow(rows, lambda batches: _paragraphs(batches, window or 0), (
        f"id {kind}, th long, uid long, place int, start long, stop long, window boolean, digest long, "
        "buckets array<bigint>")), "paragraphs")
    # Overlapping windows of one text meet often: a window's bucket needs two texts.
    owner = F.hash(F.when(F.col("window"), F.col("th")).otherwise(F.col("digest")))
    owned = found.select(owner.alias("owner"), F.explode("buckets").alias("bucket"))
    met = owned.groupBy("bucket").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).filter("lo <> hi")
    met = written(met.select("bucket"), "met")
    bands = found.select("digest", F.explode("buckets").alias("bucket"))
    shared = written(bands.join(met, "bucket").distinct(), "shared")
    buckets = shared.groupBy("bucket").agg(F.min("digest").alias("lead"), F.max("digest").alias("last"))
    members = written(shared.join(buckets.filter("lead <> last").select("bucket", "lead"), "bucket"), "members")
    likely = members.select(F.col("digest").alias("member")).distinct()
    texts = found.groupBy("digest").agg(
        F.min(F.struct("id", "start", "uid", "place", "stop", "th")).alias("first"), F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("window")).alias("lines"), F.min("uid").alias("lo"), F.max("uid").alias("hi"))
    texts = texts.join(likely, F.col("digest") == F.col("member"), "left").filter("n > 1 or member is not null")
    texts = written(texts.drop("member"), "texts")
    asked = likely.withColumnRenamed("member", "digest").join(texts, "digest").groupBy(
        F.col("first.id").alias("asked_id"), F.col("first.th").alias("asked_th")).agg(
        F.collect_list(F.struct(F.col("first.start").alias("start"), F.col("first.stop").alias("stop"), "digest")).alias("asked"))
    source = rows.join(asked.hint("shuffle_hash"), (F.col("th") == F.col("asked_th")) & F.col("id").eqNullSafe(
        F.col("asked_id"))).select("text", "asked")
    picked = map_arrow(source, _picked, "digest long, text string")
    sets = written(map_arrow(picked, _shingle_rows, "digest long, shingles array<bigint>").dropDuplicates(["digest"]), "sets")
    roots = _linked(members, sets, similarity)
    owned = written(texts.join(roots, texts["digest"] == roots["node"], "left").select(
        "digest", "first", "n", "lines", "lo", "hi", F.coalesce("root", "digest").alias("cluster")), "owned")
    clusters = owned.groupBy("cluster").agg(
        F.min("first").alias("lead"), F.sum("n").alias("n_paragraphs"), F.sum("lines").alias("lines"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lines > 1 or lo <> hi")
    named = owned.select("digest", "cluster").join(clusters, "cluster").select(
        F.col("digest").alias("d"), "lead", "n_paragraphs")
    kept = (F.col("uid") == F.col("lead.uid")) & (F.col("window") | (F.col("place") == F.col("lead.place")))
    return found.join(named, F.col("digest") == F.col("d")).select(
        F.col("id").alias(key), "place", "start", "stop", "window", F.col("lead.id").alias("cluster_id"),
        F.col("lead.place").alias("cluster_place"), "n_paragraphs", (~kept).alias("removed"))


def drop_repeated_paragraphs(df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """`df` with the removed paragraphs' lines cut out of its texts; keys must be unique and not null."""
    id_name, places = spare_name(df, "gone_id"), spare_name(df, "gone_places")
    gone = repeated_paragraphs(df, key, text, similarity).filter("removed").groupBy(col(key).alias(id_name)).agg(
        F.collect_set("place").alias(places))
    lines = F.split(F.coalesce(col(text).cast("string"), F.lit("")), "\n")
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col(places), i))
    met = df.join(gone, col(key) == F.col(id_name), "left")
    new = F.when(F.col(places).isNull(), col(text)).otherwise(F.array_join(kept, "\n"))
    return met.select(*[(new.alias(n) if n == text else col(n)) for n in df.columns])
