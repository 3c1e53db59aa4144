"""Phrases whose words keep together, found by growing only the beginnings whose best possible score is high enough."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import col, map_arrow, width, written
from prepkit.plans.bounds import settle

SCALE = 2_000_000
"""A phrase whose parts never stand alone scores half of this."""

STEP = 1000
"""Scores are thresholded in steps of this size, so that a language has at most SCALE / STEP / 2 + 1 of them."""

BLOCK_BYTES = 12_000_000
"""Text of one language that a task codes at once; a longer single text is a block of its own."""

BITS_PER_PHRASE = 16
MAX_BITS = 1 << 28
"""Bits of a filter, 32 MB at most. A fuller filter lets more phrases through to be counted; counts stay exact."""

PROBES = 4
OUT_ROWS = 200_000

BREAKS = b".,;:!?\n\x0b\x0c\r"
"""Fixed values: what ends a piece."""


def _byte_classes() -> bytes:
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    for byte in BREAKS:
        table[byte] = 10
    table[9] = 32
    return bytes(table)


CLASSES = _byte_classes()
"""A-Z lower-cased, every end of a piece as a line feed, every white space in it as a space."""


def _hashes(texts: list) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))


def _mixed(so_far: np.ndarray, word: np.ndarray) -> np.ndarray:
    out = (so_far ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def _block(lang: str, texts: list[bytes]) -> pa.RecordBatch | None:
    """One row: the distinct words, their hashes and counts, and all words as codes (`~code` starts a piece)."""
    data = np.frombuffer(b"\n".join(texts).translate(CLASSES), np.uint8)
    inside = (data != 32) & (data != 10)
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & ~before)
    stops = np.flatnonzero(before & ~inside)
    n = len(starts)
    if len(stops) < n:
        stops = np.append(stops, len(data))
    if not len(starts):
        return None
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    piece = np.cumsum(data == 10, dtype=np.int32)[starts]
    first = np.concatenate([[True], piece[1:] != piece[:-1]])
    del stops, before, starts, piece
    words = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data[inside])).dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    counts = np.bincount(codes, minlength=len(words.dictionary)).astype(np.int64)
    whole = [0, len(words.dictionary)]
    return pa.RecordBatch.from_arrays([
        pa.array([lang], pa.string()), pa.ListArray.from_arrays(whole, words.dictionary),
        pa.array([_hashes(words.dictionary.to_pylist()).tobytes()], pa.binary()),
        pa.ListArray.from_arrays(whole, pa.array(counts)),
        pa.array([np.where(first, ~codes, codes).astype("<i4").tobytes()], pa.binary())],
        ["lang", "words", "hashes", "counts", "codes"])


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def done(lang: str) -> Iterator[pa.RecordBatch]:
        block = _block(lang, waiting.pop(lang))
        sizes.pop(lang)
        if block is not None:
            yield block

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            if sizes.get(lang, 0) + len(text) > BLOCK_BYTES and lang in waiting:
                yield from done(lang)
            waiting.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sum(sizes.values()) > 2 * BLOCK_BYTES:  # many languages in one task
                yield from done(max(sizes, key=sizes.get))
    for lang in list(waiting):
        yield from done(lang)


def coded_blocks(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The corpus as blocks of word codes, written once; every later pass reads these."""
    rows = df.select(
        F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    return written(map_arrow(
        rows, _coded, "lang string, words array<string>, hashes binary, counts array<bigint>, codes binary"), "coded")


class Filter:
    """A Bloom filter of phrases of one length, as one broadcast bitmap of bounded size. It never misses a member."""

    def __init__(self, phrases: DataFrame):
        n = phrases.count()
        self.bits = bits = 1 << min(max((BITS_PER_PHRASE * n).bit_length(), 12), MAX_BITS.bit_length() - 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = pc.split_pattern(batch["phrase"], " ")
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                words = _hashes(lists.flatten().to_pylist())
                hashed = _hashes(batch["lang"].to_pylist())
                for j in range(int(sizes.max(initial=0))):
                    has = sizes > j
                    hashed[has] = _mixed(hashed[has], words[(ends - sizes)[has] + j])
                at = np.unique(np.concatenate([_probe(hashed, i, bits) for i in range(PROBES)]))
                cells, one = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
                first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])[:len(cells)])
                merged = np.bitwise_or.reduceat(one, first) if len(first) else one
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[first].astype(np.int32)), pa.array(merged.view(np.int64))], ["cell", "held"])

        cells = map_arrow(phrases.select("lang", "phrase"), run, "cell int, held long")
        found = cells.groupBy("cell").agg(F.bit_or("held").alias("held")).toArrow()  # MAX_BITS / 64 rows at most
        bitmap = np.zeros(bits // 64, np.uint64)
        bitmap[found["cell"].to_numpy()] = found["held"].to_numpy().view(np.uint64)
        self.bitmap = phrases.sparkSession.sparkContext.broadcast(bitmap)

    def reader(self):
        """Membership of hashed phrases, for use inside tasks."""
        held, bits = self.bitmap, self.bits

        def test(hashed: np.ndarray) -> np.ndarray:
            bitmap, out = held.value, np.ones(len(hashed), bool)
            for i in range(PROBES):
                at = _probe(hashed, i, bits)
                out &= (bitmap[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            return out

        return test


def _probe(hashed: np.ndarray, i: int, bits: int) -> np.ndarray:
    step = (hashed >> np.uint64(33)) | np.uint64(1)
    return ((hashed + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


def phrase_counts(
    blocks: DataFrame, size: int, words: Filter, least: int,
    begins: Filter | None = None, ends: Filter | None = None, whole: Filter | None = None,
) -> DataFrame:
    """(lang, phrase, f): exact counts, from `least` on, of the phrases of `size` words that a filter lets through.

    All words must pass `words`; of the filters given, one must hold the phrase's first words but the last,
    its last words but the first, or all of it. A block counts its own phrases before they are shuffled.
    """
    word_ok = words.reader()
    tests = [(f.reader(), a, b) for f, a, b in ((begins, 0, size - 1), (ends, 1, size), (whole, 0, size)) if f is not None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from count(*(batch[n].slice(row, 1) for n in ("lang", "words", "hashes", "codes")))

    def count(lang, names, hashes, codes) -> Iterator[pa.RecordBatch]:
        seed = _hashes(lang.to_pylist())
        of_word = np.frombuffer(hashes[0].as_buffer(), np.uint64)
        coded = np.frombuffer(codes[0].as_buffer(), "<i4")
        first = coded < 0
        code = np.where(first, ~coded, coded)
        fine = word_ok(_mixed(seed, of_word))[code]
        n = len(code) - size + 1
        if n <= 0:
            return
        valid = fine[:n].copy()
        for j in range(1, size):
            valid &= fine[j:j + n] & ~first[j:j + n]
        at = np.flatnonzero(valid)
        if tests:
            keep = np.zeros(len(at), bool)
            for test, a, b in tests:
                hashed = np.repeat(seed, len(at))
                for j in range(a, b):
                    hashed = _mixed(hashed, of_word[code[at + j]])
                keep |= test(hashed)
            at = at[keep]
        if not len(at):
            return
        key = code[at].astype(np.int64)
        for j in range(1, size):
            if int(key.max()) >= (1 << 62) // len(of_word):
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(of_word) + code[at + j]
        _, one, counts = np.unique(key, return_index=True, return_counts=True)
        at, names = at[one], names.flatten()
        for a in range(0, len(at), OUT_ROWS):
            some = at[a:a + OUT_ROWS]
            parts = [names.take(pa.array(code[some + j])) for j in range(size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang.to_pylist() * len(some), pa.string()), pc.binary_join_element_wise(*parts, " "),
                 pa.array(counts[a:a + OUT_ROWS], pa.int64())], ["lang", "phrase", "n"])

    found = map_arrow(blocks.select("lang", "words", "hashes", "codes"), run, "lang string, phrase string, n long")
    found = found.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(found, "phrases")


def _ratio(a: Column, rest: Column) -> Column:
    """floor(SCALE * a / rest), by integral division of decimals: the product may pass 64 bits, a quotient may not round up."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * a.cast("decimal(19,0)"), rest.cast("decimal(20,0)"))


def _words(phrase: Column, first: int, n: int) -> Column:
    return F.concat_ws(" ", F.slice(F.split(phrase, " "), first, n))


def scored(phrases: DataFrame, size: int, known: DataFrame) -> DataFrame:
    """Each phrase of `size` words with every cut (k, l, r) as far as the parts are known; one row per cut."""
    part = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias("n_part"))
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), _words(F.col("phrase"), 1, k).alias("left"),
                 _words(F.col("phrase"), k + 1, size - k).alias("right")) for k in range(1, size)])).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    cuts = cuts.join(part.withColumnsRenamed({"part": "left", "n_part": "l"}), ["lang", "left"])
    return cuts.join(part.withColumnsRenamed({"part": "right", "n_part": "r"}), ["lang", "right"], "left")


def judged(cuts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score, bound) from the rows of `scored`: the lowest cut, and what growth can reach.

    A longer phrase with this beginning occurs at most `a` times, and so do its rests; cut after the
    beginning's first k words it scores at most SCALE * a / (l + a).
    """
    score = _ratio(F.col("a"), F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)"))
    lowest = F.min(F.when(F.col("r").isNotNull(), F.struct(score.alias("score"), "k", "l", "r"))).alias("cut")
    bound = F.min(_ratio(F.col("a"), F.col("l").cast("decimal(19,0)") + F.col("a").cast("decimal(19,0)"))).alias("bound")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest, bound).select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.coalesce("cut.score", F.lit(0)).alias("score"), "bound")


def _with_floor(rows: DataFrame, floors: DataFrame, value: str) -> DataFrame:
    return rows.join(floors, "lang").where(F.col(value) >= F.col("floor"))


def thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """(lang, floor): the highest step of the score that `wanted` pairs of words reach, 0 where fewer do."""
    steps = pairs.groupBy("lang", F.expr(f"score div {STEP}").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    from_top = Window.partitionBy("lang").orderBy(F.col("step").desc())
    enough = F.when(F.sum("n").over(from_top) >= wanted, F.col("step"))
    return steps.withColumn("enough", enough).groupBy("lang").agg(
        (F.coalesce(F.max("enough"), F.lit(0)) * STEP).alias("floor"))


def grown(
    blocks: DataFrame, words: Filter, known: DataFrame, pairs: DataFrame, floors: DataFrame,
    longest: int, least: int, share: int,
) -> DataFrame:
    """All surviving phrases that score at least their language's floor, with their counts.

    Level by level, the beginnings whose bound reaches the floor are extended by every frequent word. The
    phrases that reach it are also extended to the left, as a longer phrase that absorbs one may begin
    with a common word, which no bound would have let grow.
    """
    kept, level = [], pairs
    for size in range(2, longest + 1):
        found = written(_with_floor(level, floors, "score").drop("floor"), "reached")
        if size == longest:
            kept.append(found)
            break
        open_ = written(_with_floor(level, floors, "bound").select("lang", "phrase"), "open")
        longer = phrase_counts(blocks, size + 1, words, least, begins=Filter(open_), ends=Filter(found))
        both = F.explode(F.array(_words(F.col("phrase"), 1, size), _words(F.col("phrase"), 2, size))).alias("phrase")
        around = longer.select("lang", "f", both).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        absorbed = F.lit(100).cast("decimal(3,0)") * F.col("most").cast("decimal(19,0)") \
            >= F.lit(share).cast("decimal(3,0)") * F.col("a").cast("decimal(19,0)")
        kept.append(found.join(around, ["lang", "phrase"], "left").where(
            ~F.coalesce(absorbed, F.lit(False))).drop("most"))
        before = longer.withColumn("start", _words(F.col("phrase"), 1, size))
        before = before.join(open_.withColumnRenamed("phrase", "start"), ["lang", "start"], "left_semi").drop("start")
        cuts = written(scored(before, size + 1, known.unionByName(longer)), "cuts")
        known = known.unionByName(longer)
        if size > 2:
            extra = _rests(blocks, words, cuts, floors, size, least)
            if extra is not None:
                known = known.unionByName(extra)
                cuts = scored(before, size + 1, known)
        level = written(judged(cuts), "level")
    return written(reduce(DataFrame.unionByName, kept), "grown")


def _rests(blocks: DataFrame, words: Filter, cuts: DataFrame, floors: DataFrame, most: int, least: int) -> DataFrame | None:
    """Counts of the rests that no earlier level needed, where the other cuts leave the phrase a chance."""
    hopeful = _with_floor(judged(cuts), floors, "score").select("lang", "phrase")
    missing = cuts.where("r is null").join(hopeful, ["lang", "phrase"], "left_semi")
    missing = written(missing.select("lang", F.col("right").alias("phrase")).distinct(), "rests")
    out = []
    for size in range(3, most + 1):
        some = missing.where(F.size(F.split("phrase", " ")) == size)
        if some.isEmpty():
            continue
        counts = phrase_counts(blocks, size, words, least, whole=Filter(some))
        out.append(counts.join(some, ["lang", "phrase"], "left_semi"))
    return reduce(DataFrame.unionByName, out) if out else None


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", top: int = 2000, longest: int = 4,
    least: int = 30, share: int = 80,
) -> DataFrame:
    """Each language's `top` phrases of 2 to `longest` words: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts are split at `[.,;:!?\\n-\\r]` into pieces and these at blanks into words. A
    candidate occurs a >= `least` times. Cut after k words it scores floor(2000000 * a / (l + r)), l and r the
    counts of both parts; the lowest cut counts, of equal ones the smallest k. A candidate inside a longer
    one that has `share` % of its count is dropped. Order: score and a descending, then the phrase in bytes.

    Null languages are `und`, null texts empty; repeated rows count each; other columns are not looked at.
    Languages without a candidate, and empty tables, give no rows.

    Growth is best first: a language's floor is the score that twice `top` word pairs reach. All beginnings
    whose bound reaches the floor are grown, which settles every phrase from the floor up; only languages
    where fewer than `top` of them survive go on with a lower floor, at last 0. Counts are exact: blocks of the
    corpus are counted in tasks and summed by shuffles; what passes through the driver is the filters' bits.
    """
    blocks = coded_blocks(df, text, lang)
    each = blocks.select("lang", F.inline(F.arrays_zip("words", "counts")))
    totals = each.groupBy("lang").agg(F.sum("counts").alias("n"))
    known = written(each.groupBy("lang", F.col("words").alias("phrase")).agg(F.sum("counts").alias("f"))
                    .where(F.col("f") >= least), "words")
    words = Filter(known)
    pairs = phrase_counts(blocks, 2, words, least)
    level = written(judged(scored(pairs, 2, known)), "level")
    known = known.unionByName(pairs)
    done, wanted, rest = [], 2 * top, level
    while True:
        floors = settle(thresholds(rest, wanted))
        found = grown(blocks, words, known, rest, floors, longest, least, share)
        counts = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n_found"))
        short = floors.where("floor > 0").join(counts, "lang", "left").where(
            F.coalesce("n_found", F.lit(0)) < top).select("lang")
        short = settle(short)
        if short.isEmpty():
            done.append(found)
            break
        done.append(found.join(short, "lang", "left_anti"))
        rest, wanted = rest.join(short, "lang", "left_semi"), 4 * wanted
        blocks = blocks.join(short, "lang", "left_semi")
    found = reduce(DataFrame.unionByName, done)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(width(df)))
    near = found.withColumn("salt", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
