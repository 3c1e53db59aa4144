"""Document quality: counted base rules and perplexity bands of a modified Kneser-Ney n-gram model."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import col, map_arrow, slices, written

ORDER = 5
"""Characters of an n-gram."""

BITS = 12
"""Bits of a character in a packed n-gram: the lower half of the codes are exact, the rest shared by remainder."""

START = 2
"""Symbol before a text's first character."""

BATCH = 1_500_000
"""Bytes of text whose n-grams a task holds at once."""

SLICE = 4_000_000
"""Most n-grams of a model slice that is broadcast (12 bytes each). A larger model is applied slice by slice."""

WINDOW_WORDS = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

WIDTH = 2.0
"""A band's half width in robust standard deviations of a language's held-out log perplexities."""

CHARACTER_NOISE = 1.5
"""Deviation of one character's log probability: short texts get a wider band."""

GRID = 1000
"""Steps of log perplexity that quantiles are exact to."""

BASE_COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


# ---- base rules ----

def _repeat_words(codes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words per document inside windows of WINDOW_WORDS that occur twice or more in the document; exact."""
    counts = np.zeros(n_docs, np.int64)
    n = len(codes) - WINDOW_WORDS + 1
    if n < 1:
        return counts
    window = codes.astype(np.int64)
    for step in range(1, WINDOW_WORDS):  # the window's code is that of (first words, next word)
        pair = window[:len(codes) - step] << 32 | codes[step:]
        window = pd.factorize(pair)[0].astype(np.int64)
    whole = doc[:n] == doc[WINDOW_WORDS - 1:]
    at = np.flatnonzero(whole)
    group = pd.factorize(doc[at].astype(np.int64) << 32 | window[at])[0]
    often = at[np.bincount(group)[group] > 1] if len(at) else at
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[often] += 1
    edge[often + WINDOW_WORDS] -= 1
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n_docs)


def base_counts(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of BASE_COLUMNS for some whole texts."""
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    flat = [w for some in words for w in some]
    codes = pd.factorize(np.array(flat, object))[0] if flat else np.empty(0, np.int64)
    spaces = bytes(range(9, 14)) + b" "
    chars = [len(t.translate(None, spaces).decode()) for t in texts]
    symbols = [len(t) - len(t.translate(None, SYMBOLS.encode())) for t in texts]
    repeated_lines = []
    for t in texts:
        lines = [line for line in t.split(b"\n") if line.strip()]
        repeated_lines.append(len(lines) - len(set(lines)))
    doc = np.repeat(np.arange(len(texts)), n_words)
    return [n_words, np.array(chars, np.int64), np.array(symbols, np.int64), np.array(repeated_lines, np.int64),
            _repeat_words(codes, doc, len(texts))]


# ---- n-grams ----

def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-gram that ends at each character, number of characters per text).

    Lower case; white space counts once as a space. The first characters follow START symbols.
    """
    pad = chr(START) * (ORDER - 1)
    parts = [pad + t.lower() for t in texts]
    symbols = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    space = ((symbols >= 9) & (symbols <= 13)) | (symbols == 32) | (symbols == 0xA0)
    keep = np.ones(len(symbols), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    half = 1 << (BITS - 1)
    symbols = np.where(space, 32, np.where(symbols < half, symbols, half + symbols % half))[keep]
    doc = doc[keep]
    packed = symbols[ORDER - 1:].copy()
    for k in range(1, ORDER):
        packed |= symbols[ORDER - 1 - k:len(symbols) - k] << (BITS * k)
    real = symbols[ORDER - 1:] != START
    return packed[real], np.bincount(doc[ORDER - 1:][real], minlength=len(texts))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch["text"].to_pylist()]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", BATCH):
            packed, _ = grams(_texts(batch))
            codes, found = pd.factorize(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.bincount(codes, minlength=len(found)).astype(np.int64))], ["g", "c"])


def _discounts(grams_: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    n1, n2, n3, n4 = (x or 0 for x in grams_.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first())
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


class Order(NamedTuple):
    """Counts of the n-grams of one order, and per prefix the sums of the counts and of their discounts."""

    keys: np.ndarray
    counts: np.ndarray
    discounts: tuple[float, float, float]
    prefixes: np.ndarray
    sums: np.ndarray
    left: np.ndarray


def _cut(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    """What a count is discounted by; nothing for a count of 0."""
    return np.array([0.0, *discounts])[np.minimum(counts, 3)]


def order_tables(counted: DataFrame) -> list[DataFrame]:
    """(g, c) for n-grams of 1 to ORDER characters. Lower orders count the different characters before an n-gram."""
    tables = [counted]
    for k in range(ORDER - 1, 0, -1):
        tables.insert(0, written(tables[0].groupBy(F.col("g").bitwiseAND((1 << BITS * k) - 1).alias("g"))
                                 .agg(F.count(F.lit(1)).alias("c")), f"order-{k}"))
    return tables


# ---- scores ----

def _slice_bounds(table: DataFrame) -> list[tuple[int | None, int | None]]:
    """Ranges of n-grams with about SLICE entries or fewer each; a prefix lies in one range."""
    parts = -(-table.count() // SLICE)
    if parts <= 1:
        return [(None, None)]
    shares = [i / (2 * parts) for i in range(1, 2 * parts)]  # approximate bounds make uneven slices
    inner = sorted({x >> BITS << BITS for x in table.agg(F.percentile_approx("g", shares, 100 * parts)).first()[0]})
    return list(zip([None, *inner], [*inner, None], strict=True))


def _order(table: DataFrame, discounts: tuple[float, float, float], low: int | None = None, high: int | None = None) -> Order:
    """A slice of an order's counts as sorted arrays."""
    if low is not None:
        table = table.filter(F.col("g") >= low)
    if high is not None:
        table = table.filter(F.col("g") < high)
    got = table.select("g", "c").toArrow()
    keys, counts = got["g"].to_numpy(), got["c"].to_numpy()
    at = np.argsort(keys)
    keys, counts = keys[at], counts[at]
    prefixes, begins = np.unique(keys >> BITS, return_index=True)
    sums = np.add.reduceat(counts, begins) if len(keys) else counts
    left = np.add.reduceat(_cut(counts, discounts), begins) if len(keys) else np.empty(0)
    return Order(keys, counts, discounts, prefixes, sums, left)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


class Pairs(NamedTuple):
    """The distinct (document, n-gram) pairs of some texts in this order; n-grams are places in the sorted `grams`."""

    doc: np.ndarray
    code: np.ndarray
    grams: np.ndarray


def _pairs(doc: np.ndarray, code: np.ndarray, grams_: np.ndarray) -> tuple[np.ndarray, Pairs]:
    """The pair of each row, and the pairs. Document, n-gram and row are sorted as one packed number."""
    if not len(doc):
        return np.empty(0, np.int64), Pairs(doc, code, grams_)
    rows, codes = len(doc).bit_length(), len(grams_).bit_length()
    packed = np.sort(((doc << codes | code) << rows) | np.arange(len(doc)))
    row = packed & ((1 << rows) - 1)
    packed >>= rows
    first = np.ones(len(doc), bool)
    first[1:] = packed[1:] != packed[:-1]
    at = np.empty(len(doc), np.int64)
    at[row] = np.cumsum(first) - 1
    met = packed[first]
    return at, Pairs(met >> codes, met & ((1 << codes) - 1), grams_)


def _probabilities(
    orders: list[Order], pairs: Pairs, removed: np.ndarray, own: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(probability, the same without the document's own counts) of each pair's n-gram; orders are 1 to the pairs' own.

    `removed` is the document's part of an n-gram's count; `own` marks n-grams that no other document has. A lower
    order loses a count for each n-gram above that is the document's own. Discounts stay those of all documents. A
    prefix that no other document has leaves the probability to the order below. Pairs outside a slice of the
    highest order give numbers without a meaning.
    """
    order, k = orders[-1], len(orders)
    counts = _found(order.keys, order.counts, pairs.grams)[pairs.code]
    if own is None:
        own = counts == removed
    below = below_held = 1.0 / (1 << BITS)
    if k > 1:
        suffixes, code = np.unique(pairs.grams & ((1 << BITS * (k - 1)) - 1), return_inverse=True)
        at, lower = _pairs(pairs.doc, code[pairs.code], suffixes)
        lost = np.bincount(at[own], minlength=len(lower.doc))
        below, below_held = (p[at] for p in _probabilities(orders[:-1], lower, lost))
    removed = np.minimum(removed, counts)
    heads, code = np.unique(pairs.grams >> BITS, return_inverse=True)
    code = code[pairs.code]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (pairs.doc[1:] != pairs.doc[:-1])
    at, code = np.cumsum(first) - 1, code[first]
    sums = _found(order.prefixes, order.sums, heads)[code]
    left = _found(order.prefixes, order.left, heads)[code]
    rest, cut = counts - removed, _cut(counts, order.discounts)
    cut_rest = _cut(rest, order.discounts)
    sums_held = sums - np.bincount(at, weights=removed, minlength=len(sums))
    left_held = np.maximum(left - np.bincount(at, weights=cut - cut_rest, minlength=len(sums)), 0)
    whole = (counts - cut + left[at] * below) / np.maximum(sums, 1)[at]
    held = (rest - cut_rest + left_held[at] * below_held) / np.maximum(sums_held, 1)[at]
    return whole, np.where(sums_held[at] > 0, held, below_held)


def _text_pairs(texts: list[str]) -> tuple[Pairs, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, their counts, where each document's pairs begin, characters per document)."""
    packed, n = grams(texts)
    code, found = pd.factorize(packed)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    at, pairs = _pairs(np.repeat(np.arange(len(texts)), n), rank[code], found[order])
    n_pairs = np.bincount(pairs.doc, minlength=len(texts))
    return pairs, np.bincount(at, minlength=len(pairs.doc)), np.cumsum(n_pairs) - n_pairs, n


def _own(batches: Iterator[pa.RecordBatch], top: Broadcast, out: list[str]) -> Iterator[pa.RecordBatch]:
    """Add one slice's n-grams that no other document has, as places among the document's n-grams."""
    order = top.value
    for whole in batches:
        for batch in slices(whole, "text", BATCH):
            pairs, removed, begins, _ = _text_pairs(_texts(batch))
            own = np.flatnonzero(_found(order.keys, order.counts, pairs.grams)[pairs.code] == removed)
            doc, place = pairs.doc[own], own - begins[pairs.doc[own]]
            if "own" in batch.schema.names:
                before = batch["own"]
                doc = np.concatenate([doc, np.repeat(np.arange(batch.num_rows), before.value_lengths().to_numpy())])
                place = np.concatenate([place, before.flatten().to_numpy()])
                at = np.argsort(doc, kind="stable")
                doc, place = doc[at], place[at]
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))])
            made = {name: batch[name] for name in batch.schema.names}
            made["own"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place, pa.int32()))
            yield pa.RecordBatch.from_arrays([made[name] for name in out], out)


def _score(batches: Iterator[pa.RecordBatch], lower: Broadcast, top: Broadcast, out: list[str]) -> Iterator[pa.RecordBatch]:
    """Add one model slice's part of log_p and held_log_p; on the first slice also count the base columns."""
    order = top.value
    orders = [*lower.value, order]
    for whole in batches:
        for batch in slices(whole, "text", BATCH):
            texts = _texts(batch)
            pairs, inside, begins, counts = _text_pairs(texts)
            made = {name: batch[name] for name in batch.schema.names}
            own = None
            if "own" in made:
                owner = np.repeat(np.arange(len(texts)), made["own"].value_lengths().to_numpy())
                own = np.zeros(len(inside), bool)
                own[begins[owner] + made["own"].flatten().to_numpy()] = True
            there = np.isin(pairs.grams, order.keys)[pairs.code] if own is not None else np.ones(len(inside), bool)
            for name, p in zip(("log_p", "held_log_p"), _probabilities(orders, pairs, inside, own), strict=True):
                total = np.bincount(pairs.doc[there], weights=inside[there] * np.log(p[there]), minlength=len(texts))
                made[name] = pa.array(total + (made[name].to_numpy() if name in made else 0.0))
            if "n_scored" not in made:
                names = [c.split()[0] for c in BASE_COLUMNS.split(", ")]
                made |= dict(zip(names, map(pa.array, base_counts([t.encode() for t in texts])), strict=True))
                made["n_scored"] = pa.array(counts.astype(np.int64))
            yield pa.RecordBatch.from_arrays([made[name] for name in out], out)


def _middle(cells: DataFrame, value: str) -> DataFrame:
    """(lang, middle): the lower median of gridded values, from their counts."""
    upto = Window.partitionBy("lang").orderBy(value)
    all_ = Window.partitionBy("lang")
    return cells.withColumns({"at": F.sum("n").over(upto), "all": F.sum("n").over(all_)}).filter(
        F.col("at") * 2 >= F.col("all")).groupBy("lang").agg(F.min(value).alias("middle"))


def bands(scored: DataFrame) -> DataFrame:
    """(band_lang, middle, spread): median and robust deviation of held-out log perplexity per language, null included.

    Taken from all documents with a character that pass the base rules; counts on a grid of 1 / GRID, so
    the result doesn't depend on partitions. A language has as many cells as its perplexities differ.
    """
    good = scored.filter("n_scored > 0 and not base_failed").select(
        "lang", F.round(F.col("held_log_ppl") * GRID).cast("long").alias("x"))
    cells = good.groupBy("lang", "x").agg(F.count(F.lit(1)).alias("n"))
    middle = _middle(cells, "x").withColumnRenamed("lang", "band_lang")
    away = cells.join(F.broadcast(middle), F.col("lang").eqNullSafe(F.col("band_lang"))).select(
        "lang", F.abs(F.col("x") - F.col("middle")).alias("x"), "n").groupBy("lang", "x").agg(F.sum("n").alias("n"))
    spread = _middle(away, "x").select(F.col("lang").alias("l"), F.col("middle").alias("mad"))
    return middle.join(spread, F.col("band_lang").eqNullSafe(F.col("l"))).select(
        "band_lang", (F.col("middle") / GRID).alias("middle"),
        (F.col("mad") * 1.4826 / GRID).alias("spread"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _scored(df: DataFrame, key: str, text: str, lang: str, carried: list[str]) -> DataFrame:
    """id, lang, the base counts, the verdicts, and the carried columns of `df` as k0, k1, ..."""
    rows = df.select(
        col(key).alias("id"), col(lang).cast("string").alias("lang"), col(text).cast("string").alias("text"),
        *[col(name).alias(f"k{i}") for i, name in enumerate(carried)])
    counted = written(map_arrow(rows.select("text"), _count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")), "grams")
    tables = order_tables(counted)
    discounts = [_discounts(t) for t in tables]
    send = df.sparkSession.sparkContext.broadcast
    lower = send([_order(t, d) for t, d in zip(tables[:-1], discounts[:-1], strict=True)])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    bounds = _slice_bounds(counted)
    if len(bounds) > 1:
        kinds["own"] = "array<int>"
        out = list(kinds)
        schema = ", ".join(f"{name} {kinds[name]}" for name in out)
        for low, high in bounds:
            top = send(_order(counted, discounts[-1], low, high))
            rows = written(map_arrow(rows, lambda b, top=top, out=out: _own(b, top, out), schema), "own")
    kinds |= dict(c.split() for c in BASE_COLUMNS.split(", ")) | {"n_scored": "long", "log_p": "double", "held_log_p": "double"}
    for i, (low, high) in enumerate(bounds):
        top = send(_order(counted, discounts[-1], low, high))
        out = [name for name in kinds if name not in ("text", "own") or i < len(bounds) - 1]
        schema = ", ".join(f"{name} {kinds[name]}" for name in out)
        rows = written(map_arrow(rows, lambda b, top=top, out=out: _score(b, lower, top, out), schema), "scores")
    n = F.nullif("n_scored", F.lit(0))
    scored = rows.withColumns({
        "base_failed": base_failed(), "log_ppl": -F.col("log_p") / n, "held_log_ppl": -F.col("held_log_p") / n})
    met = scored.join(F.broadcast(bands(scored)), F.col("lang").eqNullSafe(F.col("band_lang")), "left")
    reach = WIDTH * F.sqrt(F.col("spread") * F.col("spread") + CHARACTER_NOISE**2 / F.nullif("n_scored", F.lit(0)))
    inside = F.abs(F.col("held_log_ppl") - F.col("middle")) <= reach
    middle = F.col("middle") + F.col("log_ppl") - F.col("held_log_ppl")
    return met.withColumns({
        "perplexity": F.exp("log_ppl"), "held_out_perplexity": F.exp("held_log_ppl"),
        "lower_band": F.exp(middle - reach), "upper_band": F.exp(middle + reach),
        "kept": ~F.col("base_failed") & F.coalesce(inside, F.lit(True))})


def score(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: key, the base counts, base_failed, perplexity, held_out_perplexity, its band, kept.

    Words are runs without `[ \\t-\\r]`; a null text has none. The model is counted over all documents, so each
    n-gram that is looked up is known. Perplexity is per character. For the verdict a document's own counts are
    taken out of the model first. The held-out perplexity must lie between the language's bands: the median of its
    logarithms, WIDTH robust deviations to each side, wider for short texts. The band is given on the scale of
    `perplexity`, shifted by what the document's own counts gain it, so it differs by document. `kept` is
    false if the base rules fail, else the bands' verdict. A null language has bands of its own. A text
    without characters has no perplexity; other columns of `df` play no part.
    """
    return _scored(df, key, text, lang, []).select(
        F.col("id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "perplexity", "held_out_perplexity", "lower_band", "upper_band", "kept")


def kept_documents(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `df` that `score` keeps, with the same columns. The rows travel with their scores: no join."""
    kept = _scored(df, key, text, lang, df.columns).filter("kept")
    return kept.select(*[F.col(f"k{i}").alias(name) for i, name in enumerate(df.columns)])
