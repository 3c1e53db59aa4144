"""Exact cuts of a table into labelled parts without ranking its rows.

Rows get an order (a hash of their key, or given columns). For "the first n rows" only the
order value at place n is needed; it is found by narrowing and then compared with every row
in a projection. So a split of a big table is a few narrow aggregations and one map-only
pass, whatever the size of a class, and each part has exactly the wanted number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.schema import c, check_columns
from prepkit.plans.bounds import settle
from prepkit.plans.joins import attach
from prepkit.plans.order_stats import grouped_values_at_ranks, values_at_ranks

DIGITS = 3
EDGE_ROWS = 100_000
"""Groups of up to so many rows are ranked by their hashes at once."""

SIGMAS = 5.0
"""Half the width of the hash range in which a wanted place is looked for, in deviations of a uniform hash's count."""

BRACKET_DIGITS = 12
CHUNK = 1_000_000

BELOW_ALL, ABOVE_ALL = "", "g"
"""Bounds that no hex digest is <=, and that every one is."""


def key_hash(df: DataFrame, key_cols: Sequence[str] | None, seed: int) -> Column:
    """A hex digest of key and seed: the same order on any cluster and partitioning.

    Without a key every column is hashed, in its own type.
    """
    if not key_cols:
        return F.hex(F.xxhash64(*[c(n) for n in df.columns], F.lit(seed)))  # without leading zeros, not quite even
    check_columns(df, key_cols, "Key column")
    texts = [F.coalesce(c(k).cast("string"), F.lit("")) for k in key_cols]
    return F.md5(F.concat_ws("|", *texts, F.lit(str(seed))))


EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
"""Times to the microsecond: JSON's own format stops at milliseconds."""


def whole_row_hash(df: DataFrame) -> Column:
    return F.md5(F.to_json(F.struct(*[c(n) for n in df.columns]), EXACT_TIMES))


def group_names(groups: Sequence[str]) -> list[str]:
    return [f"_g{i}" for i in range(len(groups))]


def attach_cuts(df: DataFrame, cuts: DataFrame, on: list[str]) -> DataFrame:
    """Pair rows with the open cuts of their group; those of an ungrouped table are literals."""
    if on:
        return attach(df, cuts, on)
    rows = cuts.collect()
    kinds = {n: cuts.schema[n].dataType for n in cuts.columns}
    if not rows:
        return df.where(F.lit(False)).withColumns({n: F.lit(None).cast(t) for n, t in kinds.items()})
    each = [F.struct(*[F.lit(r[n]).cast(t).alias(n) for n, t in kinds.items()]) for r in rows]
    return df.select("*", F.inline(F.array(*each)))


def _place(cells: DataFrame, groups: list[str], order: str) -> DataFrame:
    """Keep the cell that holds place `rest`; `rest` becomes the place inside it."""
    run = Window.partitionBy(*groups, "slot").orderBy(order)
    return (
        cells.withColumn("start", F.sum("cell").over(run) - F.col("cell"))
        .where((F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("cell")))
        .withColumn("rest", F.col("rest") - F.col("start"))
        .withColumn("below", F.col("below") + F.col("start"))
    )


def _bracketed(rows: DataFrame, groups: list[str], open_cuts: DataFrame) -> DataFrame | None:
    """What _hash_bounds gives, by one pass; None if a place is outside its bracket.

    The bracket is the range of leading hash digits SIGMAS deviations to both sides of the place's share of its
    group. Rows below it are counted as one cell, those inside by hash: some 10 * sqrt(rows of the group).
    """
    share = F.col("rest") / F.col("all_rows")
    reach = SIGMAS * F.sqrt(share * (1 - share) / F.col("all_rows")) + SIGMAS / F.col("all_rows")

    def digits(x: Column) -> Column:
        cell = F.floor(F.greatest(x, F.lit(0.0)) * 16.0 ** BRACKET_DIGITS).cast("bigint")
        return F.when(x >= 1, ABOVE_ALL).otherwise(F.lpad(F.lower(F.hex(cell)), BRACKET_DIGITS, "0"))

    wanted = settle(open_cuts.withColumns({"low": digits(share - reach), "high": digits(share + reach)}).drop("all_rows"))
    near = attach_cuts(rows, wanted, groups).where(F.col("h") < F.col("high"))
    inside = F.when(F.col("h") < F.col("low"), BELOW_ALL).otherwise(F.col("h")).alias("h")
    cells = near.groupBy(*groups, "slot", "rest", "below", inside).agg(F.count(F.lit(1)).alias("cell"))
    found = settle(_place(cells, groups, "h").select(*groups, "slot", "h", "below", "rest", "cell"))
    missed = found.where(F.col("h") != BELOW_ALL).count() < wanted.count()
    return None if missed else found


def _hash_bounds(rows: DataFrame, groups: list[str], quotas: DataFrame, n_cuts: int, even: bool = True) -> DataFrame:
    """Per group and cut: the hash at that place, rows below it, place among and number of its equals.

    Digests are `even`, so the wanted one lies close to its share of all: one pass finds it (see _bracketed). Where
    keys repeat often and it lies elsewhere, prefixes are narrowed: each round leaves 1/4096 of a group, and only
    counts of at most 4096 prefixes per group and round are ranked.
    """
    one = F.count(F.lit(1)).alias("cell")
    open_cuts = quotas.select(
        *groups, "_n", F.col("_n").alias("all_rows"), F.posexplode(F.array(*[f"_cut{i}" for i in range(n_cuts)])).alias("slot", "rest"),
    ).where((F.col("rest") > 0) & (F.col("rest") < F.col("_n"))).drop("_n")
    open_cuts = open_cuts.withColumn("below", F.lit(0).cast("bigint"))
    left = quotas.agg(F.max("_n")).first()[0] or 0
    if even and left > EDGE_ROWS:
        found = _bracketed(rows, groups, open_cuts)
        if found is not None:
            return found
    digits = 0
    open_cuts = open_cuts.drop("all_rows")
    while left > EDGE_ROWS:
        prefix = F.substring("h", 1, digits).alias("prefix")
        longer = F.substring("h", 1, digits + DIGITS).alias("longer")
        if digits == 0:
            cells = attach_cuts(rows.groupBy(*groups, longer).agg(one), open_cuts, groups)
        else:
            inside = attach_cuts(rows.select(*groups, prefix, longer), open_cuts, [*groups, "prefix"])
            cells = inside.groupBy(*groups, "slot", "rest", "below", "longer").agg(one)
        open_cuts = settle(
            _place(cells, groups, "longer")
            .select(*groups, "slot", "rest", "below", F.col("longer").alias("prefix"))
        )
        digits += DIGITS
        left //= 16 ** DIGITS
    if digits:
        rows = rows.withColumn("prefix", F.substring("h", 1, digits))
        edge = attach_cuts(rows, open_cuts, [*groups, "prefix"])
    else:
        edge = attach_cuts(rows, open_cuts, groups)
    last = edge.groupBy(*groups, "slot", "rest", "below", "h").agg(one)
    return _place(last, groups, "h").select(*groups, "slot", "h", "below", "rest", "cell")


def label_by_hash(
    df: DataFrame, groups: Sequence[str], key_cols: Sequence[str] | None, seed: int,
    quotas: DataFrame, labels: Sequence[str], into: str,
) -> DataFrame:
    """Label each group's first `_cut0` rows labels[0], those up to `_cut1` labels[1], and so on.

    `quotas` is a settled table: group columns _g0.., group size _n, running counts _cut0..
    """
    n_cuts, gs = len(labels) - 1, group_names(groups)
    order = key_hash(df, key_cols, seed)
    for last_try in (False, True):
        if last_try:
            # Keys repeat right at a cut: tell their rows apart by everything else in them.
            order = F.concat(order, whole_row_hash(df))
        rows = df.select(*[c(g).alias(k) for g, k in zip(groups, gs)], order.alias("h"))
        found = settle(_hash_bounds(rows, gs, quotas, n_cuts, bool(key_cols)))
        tied = bool(found.where(F.col("rest") < F.col("cell")).head(1))
        if not tied:
            break
    at = [F.when(F.col("slot") == i, F.struct("h", "below", (F.col("rest") == F.col("cell")).alias("whole")))
          for i in range(n_cuts)]
    found = found.groupBy(*gs).agg(*[F.max(a).alias(f"b{i}") for i, a in enumerate(at)]).select(
        *gs, *[F.col(f"b{i}")[x].alias(f"_{x}{i}") for i in range(n_cuts) for x in ("h", "below", "whole")]
    )
    bounds = attach(quotas, found, gs, how="left")
    for i in range(n_cuts):
        cut = F.col(f"_cut{i}")
        inner = (cut > 0) & (cut < F.col("_n"))
        bounds = bounds.withColumns({
            f"_h{i}": F.when(inner, F.col(f"_h{i}")).when(cut <= 0, BELOW_ALL).otherwise(ABOVE_ALL),
            f"_whole{i}": ~inner | F.col(f"_whole{i}"),
        })
    if not tied:
        bounds = bounds.select(*gs, *[f"_h{i}" for i in range(n_cuts)])
    marked = attach(df.withColumn("_h", order), settle(bounds), groups, gs)
    label = F.lit(labels[-1])
    for i in reversed(range(n_cuts)):
        inside = F.col("_h") <= F.col(f"_h{i}")
        if tied:
            inside = inside & (F.col(f"_whole{i}") | (F.col("_h") != F.col(f"_h{i}")))
        label = F.when(inside, labels[i]).otherwise(label)
    if not tied:
        return marked.select(*[c(n) for n in df.columns], label.alias(into))
    split, below = F.lit(False), F.lit(None).cast("bigint")
    for i in range(n_cuts):
        here = ~F.col(f"_whole{i}") & (F.col("_h") == F.col(f"_h{i}"))
        split, below = split | here, F.when(here, F.col(f"_below{i}")).otherwise(below)
    return _with_copies(marked.withColumn("_below", below), split, label, df.columns, labels, into)


def _with_copies(
    marked: DataFrame, split: Column, label: Column, columns: list[str], labels: Sequence[str], into: str,
) -> DataFrame:
    """Deal out the runs of identical rows that a cut goes through, labelling the rest as usual.

    Which copy goes where cannot matter, so each run (`_h` within `_below`, the rows before it)
    is counted map-side and written out again in chunks that are spread over the cluster.
    """
    n_cuts = len(labels) - 1
    plain = marked.where(~split).select(*[c(n) for n in columns], label.alias(into))
    # By the columns themselves, so that rows whose digests agree by chance stay apart; maps have no order.
    plain_kinds = [n for n in columns if "map<" not in marked.schema[n].dataType.simpleString()]
    same = [c(n).alias(f"_same{i}") for i, n in enumerate(plain_kinds)]
    runs = marked.where(split).groupBy("_h", "_below", *[f"_cut{i}" for i in range(n_cuts)], *same).agg(
        F.first(F.struct(*[c(n) for n in columns])).alias("row"), F.count(F.lit(1)).alias("copies"),
    )
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / CHUNK).cast("int")))
    chunks = runs.withColumn("chunk", chunk).repartition("_h", "chunk")
    first = F.col("chunk").cast("bigint") * CHUNK + 1
    copies = chunks.withColumn(
        "copy", F.explode(F.sequence(first, F.least(first + CHUNK - 1, F.col("copies"))))
    )
    place = F.col("_below") + F.col("copy")
    dealt = F.lit(labels[-1])
    for i in reversed(range(n_cuts)):
        dealt = F.when(place <= F.col(f"_cut{i}"), labels[i]).otherwise(dealt)
    return plain.unionByName(
        copies.select(*[F.col("row")[n].alias(n) for n in columns], dealt.alias(into))
    )


def plain_order(df: DataFrame, name: str) -> Column:
    """An order column whose values can be written as literals again."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c(name))
    if isinstance(kind, T.TimestampNTZType):  # never through a zone: its clock may be set back
        seconds = (F.hour(c(name)) * 60 + F.minute(c(name))).cast("bigint") * 60
        fraction = (F.extract(F.lit("SECOND"), c(name)) * 1_000_000).cast("bigint")
        return (F.unix_date(c(name).cast("date")).cast("bigint") * 86_400 + seconds) * 1_000_000 + fraction
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c(name))
    return c(name) if isinstance(kind, (T.NumericType, T.StringType)) else c(name).cast("string")


def label_by_order(
    df: DataFrame, order: Sequence[Column], cuts: Sequence[int], total: int,
    labels: Sequence[str], into: str,
) -> DataFrame:
    """Label the first cuts[0] rows in the order of `order` labels[0], those up to cuts[1] labels[1], ...

    Ties are told apart by the next order column, at last by the whole row.
    """
    names = [f"_o{i}" for i in range(len(order))] + ["_h"]
    rows = df.withColumns(dict(zip(names, [*order, whole_row_hash(df)])))
    label, split, below = F.lit(labels[-1]), F.lit(False), F.lit(None).cast("bigint")
    tied = False
    open_cuts = sorted({x for x in cuts if 0 < x < total})
    first = dict(zip(open_cuts, values_at_ranks(rows, F.col(names[0]), [x - 1 for x in open_cuts])))
    for cut, name in reversed(list(zip(cuts, labels))):
        if cut <= 0:
            continue
        if cut >= total:
            label = F.lit(name)
            continue
        inside, tie, base, whole = F.lit(False), F.lit(True), 0, False
        for o in names:
            at = [first[cut]] if o == names[0] else values_at_ranks(rows.where(tie), F.col(o), [cut - 1 - base])
            [(value, low, same)] = at
            inside = inside | (tie & (F.col(o) < F.lit(value)))
            tie = tie & (F.col(o) == F.lit(value))
            base += low
            whole = base + same == cut
            if whole:
                inside = inside | tie
                break
        label = F.when(inside, name).otherwise(label)
        if not whole:
            tied, split = True, split | tie
            below = F.when(tie, F.lit(base).cast("bigint")).otherwise(below)
    if not tied:
        return rows.select(*[c(n) for n in df.columns], label.alias(into))
    marked = rows.withColumns({"_below": below, **{f"_cut{i}": F.lit(x) for i, x in enumerate(cuts)}})
    return _with_copies(marked, split, label, df.columns, labels, into)


FEW_FIRST_ROWS = 1000
"""Up to this many first rows per group, Spark prunes a ranking per task before the shuffle."""


def first_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], quotas: DataFrame, into: str,
) -> DataFrame:
    """Label 'in' the first `_cut0` rows of each group in the order of columns, 'out' the others."""
    gs = group_names(groups)
    row = whole_row_hash(df)
    for last_try in (False, True):
        # Only where the order has ties at a cut are they told apart by the whole row.
        place = F.struct(*[c(o) for o in order], *([row.alias("_row")] if last_try else []))
        rows = df.select(*[c(g).alias(k) for g, k in zip(groups, gs)], place.alias("place"))
        found = settle(_first_bounds(rows, gs, quotas))
        tied = bool(found.where(~F.col("_whole")).head(1))
        if not tied:
            break
    bounds = settle(attach(quotas, found, gs, how="left"))
    marked = attach(df.withColumn("_place", place), bounds, groups, gs)
    inside = F.col("_v").isNull() | (F.col("_place") <= F.col("_v"))
    label = F.when(inside, "in").otherwise("out")
    if not tied:
        return marked.select(*[c(n) for n in df.columns], label.alias(into))
    tie = F.coalesce((F.col("_place") == F.col("_v")) & ~F.col("_whole"), F.lit(False))
    marked = marked.withColumns({"_h": row, "_below": F.col("_low")})
    return _with_copies(marked, tie, label, df.columns, ["in", "out"], into)


def _first_bounds(rows: DataFrame, gs: list[str], quotas: DataFrame) -> DataFrame:
    """Per group that is cut: the place of its last row, rows before that place, whether all at it fit."""
    most = quotas.agg(F.max("_cut0")).first()[0] or 0
    if most > FEW_FIRST_ROWS:
        keyed = attach(rows, quotas, gs).where(F.col("_cut0") < F.col("_n"))
        last = F.col(f"g{len(gs)}") - 1
        return grouped_values_at_ranks(keyed, F.col("place"), [*gs, "_cut0"], lambda n: [last]).select(
            *gs, F.col("v").alias("_v"), F.col("below").alias("_low"),
            (F.col("below") + F.col("same") == F.col("_cut0")).alias("_whole"))
    by_place = Window.partitionBy(*gs).orderBy("place")
    near = (
        rows.withColumn("rn", F.row_number().over(by_place)).where(F.col("rn") <= most + 1)
        .withColumn("low", F.rank().over(by_place).cast("bigint") - 1)
        .withColumn("next", F.lead("place").over(by_place))
    )
    return attach(near, quotas, gs).where(
        (F.col("rn") == F.col("_cut0")) & (F.col("_cut0") < F.col("_n"))
    ).select(*gs, F.col("place").alias("_v"), F.col("low").alias("_low"),
             F.coalesce(F.col("next") != F.col("place"), F.lit(True)).alias("_whole"))
