"""Mix sources to target weights by entropy balancing: tilted document rates, rounded into copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.order import ranked
from prepkit.llm.shared import col, map_arrow, slices, spare_name, written

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
CAP = 2
TOLERANCE = 1e-7
"""Largest relative miss of a source's target before rounding."""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            n = [len((text or b"").split()) for text in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["source"], batch["digest"], pa.array(n, pa.int64())],
                ["id", "source", "digest", "size"])


def _twin(key: Column, source: Column, digest: Column) -> Column:
    """Tells rows of one id apart; rows equal in source and text are interchangeable."""
    return F.row_number().over(Window.partitionBy(key).orderBy(source, digest))


def sizes(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(id, source, twin, size): words of every whole text, written once."""
    rows = df.select(col(key).alias("id"), col(source).cast("string").alias("source"),
                     F.xxhash64(col(text).cast("string")).alias("digest"), col(text).cast("string").alias("text"))
    counted = map_arrow(rows, _count, (
        f"id {df.schema[key].dataType.simpleString()}, source string, digest long, size long"))
    return written(counted.withColumn("twin", _twin(F.col("id"), F.col("source"), F.col("digest"))).drop("digest"), "sizes")


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(source, source_size, target): `budget` times all words, shared by weight, no source above `cap` times its size.

    Sources by code point, null last, take the weights in turn. What a full source cannot take is
    shared again by weight until none is above. Only the common level is kept on the driver.
    """
    placed = written(
        ranked(totals, [], [col("source").asc_nulls_last()], "place")
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1)),
        "sources")
    most = cap * F.col("source_size")
    level, full = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > most
        n, used, free, everything = placed.agg(
            F.count_if(above), F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight"))),
            F.sum("source_size")).first()
        if not everything or n == full or not free:
            break
        level, full = (budget * everything - (used or 0)) / free, n
    return placed.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), most.cast("double")).alias("target"))


def _rate(tilt: Column, size: Column, mean: Column, cap: int) -> Column:
    """Bounded tilt of one copy per document: 1 at tilt 0, towards `cap` above and 0 below."""
    return F.lit(float(cap)) / (1 + (cap - 1) * F.exp(-tilt * size / mean))


def _means(classes: DataFrame) -> DataFrame:
    mean = F.sum(F.col("n") * F.col("size")) / F.sum("n")
    return classes.groupBy(F.col("source").alias("of")).agg(mean.alias("mean"))


def tilts(classes: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """`wanted` with the tilt that makes each source's expected words its target; null where all rates are `cap`.

    The entropy dual is convex with one multiplier per source. Each Newton round is one aggregate over
    (source, size) classes; a step outside the bracket known so far is replaced by its middle.
    """
    fit = wanted.withColumn("full", F.col("target") >= cap * F.col("source_size"))
    state = written(fit.withColumns({
        "tilt": F.lit(0.0), "low": F.lit(float("-inf")), "high": F.lit(float("inf")), "miss": F.lit(float("inf"))}), "tilts")
    known = written(classes.withColumnRenamed("source", "s").join(_means(classes), F.col("s").eqNullSafe(F.col("of")))
                    .select("s", "size", "n", "mean").filter("size > 0"), "classes")
    while True:
        met = known.join(state.filter("not full"), F.col("s").eqNullSafe(F.col("source")))
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
        words = F.col("n") * F.col("size")
        sums = met.groupBy("s").agg(
            F.sum(words * rate).alias("got"),
            F.sum(words * F.col("size") / F.col("mean") * rate * (1 - rate / cap)).alias("slope"))
        now = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - (F.col("got") - F.col("target")) / F.greatest("slope", F.lit(1e-300))
        reach = 1 + 2 * F.abs("tilt")  # a bracket's open end moves out by this at most
        lowest = F.when(low == float("-inf"), F.col("tilt") - reach).otherwise(low)
        highest = F.when(high == float("inf"), F.col("tilt") + reach).otherwise(high)
        inside = step.between(lowest, highest)
        bounded = F.when(inside, step).when(low == float("-inf"), lowest).when(high == float("inf"), highest)
        miss = F.abs(F.col("got") - F.col("target")) / F.greatest("target", F.lit(1.0))
        done = F.col("full") | F.col("got").isNull() | (miss <= TOLERANCE)
        state = written(now.select(
            "source", "source_size", "target", "full",
            F.when(done, F.col("tilt")).otherwise(F.coalesce(bounded, (low + high) / 2)).alias("tilt"),
            F.when(done, F.col("low")).otherwise(low).alias("low"),
            F.when(done, F.col("high")).otherwise(high).alias("high"),
            F.when(done, F.lit(0.0)).otherwise(miss).alias("miss")), "tilts")
        if not (state.agg(F.max("miss")).first()[0] or 0.0):
            return state


def _round_classes(cap: int):
    def settled(classes: pd.DataFrame, owed: float) -> np.ndarray:
        """The copies after exchanges that bring the words closer to the target: a copy more, a copy less, or both.

        Each step takes the best one, found among the sorted sizes, until none helps.
        """
        size, n, copies = (classes[name].to_numpy() for name in ("size", "n", "copies"))
        copies = copies.astype(np.int64)
        while True:
            more = np.flatnonzero((size > 0) & (copies < cap * n))
            less = np.flatnonzero((size > 0) & (copies > 0))
            less = less[np.argsort(size[less], kind="stable")]
            up, down = np.append(size[more], 0), np.concatenate([[0], size[less]])
            near = np.searchsorted(down, up - owed)
            best = (abs(owed) - 1e-6, -1, -1)
            for at in (np.maximum(near - 1, 0), np.minimum(near, len(down) - 1)):
                miss = np.abs(owed - (up - down[at]))
                i = int(np.argmin(miss))
                best = min(best, (float(miss[i]), i, int(at[i])))
            _, i, j = best
            if i < 0:
                return copies
            owed -= up[i] - down[j]
            if i < len(more):
                copies[more[i]] += 1
            if j:
                copies[less[j - 1]] -= 1

    def work(classes: pd.DataFrame) -> pd.DataFrame:
        """Whole copies per size class, longest documents first; each class makes up for the miss so far."""
        classes = classes.sort_values("size", ascending=False)
        owed, copies = 0.0, []
        for size, n, rate in zip(classes["size"], classes["n"], classes["rate"], strict=True):
            if size == 0:
                copies.append(n)
                continue
            want = n * rate * size + owed
            take = min(max(round(want / size), 0), cap * n)
            owed = want - take * size
            copies.append(take)
        classes = classes.assign(copies=copies)
        classes["copies"] = settled(classes, owed)
        return classes[["source", "size", "n", "copies"]]

    return work


def mix(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP,
) -> DataFrame:
    """(id, source, twin, size, source_size, target, copies, taken) per row of `df`.

    `size` counts the words of the whole text (null: 0); null sources are a source of their own. Rates
    come from entropy balancing with one token constraint per source, then copies (0 to `cap`) are dealt
    so that a source's words end within about half its shortest document of the target. Which documents
    of a size class get the odd copy is decided by a hash of the id: reruns agree. Documents without
    words keep one copy of no words. `twin` numbers rows that share an id.

    Rounding reads one source's distinct sizes in a task, at most the square root of twice its words.
    """
    rows = sizes(df, key, text, source)
    classes = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-classes")
    totals = classes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    state = tilts(classes, targets(totals, weights, budget, cap), cap)
    per_source = state.join(_means(classes), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    per_source = per_source.withColumnRenamed("source", "of_source")
    rated = classes.join(per_source, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "source", "size", "n",
        F.when(F.col("full"), F.lit(float(cap))).when(F.col("size") == 0, F.lit(1.0))
        .otherwise(_rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)).alias("rate"))
    rounded = written(rated.groupBy("source").applyInPandas(
        _round_classes(cap), "source string, size long, n long, copies long"), "copies")
    decided = rounded.join(per_source, F.col("source").eqNullSafe(F.col("of_source"))).select(
        F.col("source").alias("for_source"), F.col("size").alias("of_size"), "n", "copies", "source_size", "target")
    chosen = ranked(rows, ["source", "size"], [F.xxhash64("id"), F.col("id"), F.col("twin")], "turn")
    dealt = chosen.join(
        decided, F.col("source").eqNullSafe(F.col("for_source")) & (F.col("size") == F.col("of_size")))
    copies = F.floor(F.col("copies") / F.col("n")) + (F.col("turn") < F.col("copies") % F.col("n")).cast("long")
    return dealt.withColumn("copies", copies).select(
        "id", "source", "twin", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of `df`, each as often as its copies say; same columns. An id may then occur twice."""
    decided = mix(df, key, text, source, **options)
    twin, copy = spare_name(df, "twin"), spare_name(df, "copy")
    copies = decided.filter("copies > 0").select(
        F.col("id").alias("mix_id"), F.col("twin").alias("mix_twin"), F.col("copies").cast("int").alias("mix_copies"))
    rows = df.withColumn(twin, _twin(col(key), col(source).cast("string"), F.xxhash64(col(text).cast("string"))))
    met = rows.join(copies, col(key).eqNullSafe(F.col("mix_id")) & (col(twin) == F.col("mix_twin")))
    return met.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col("mix_copies")))).select(*map(col, df.columns))
