"""Filter captures by dated URL lists: each capture meets the entries that were active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import col, written

HOT_SHARE = 1000
"""An entry met by more than one in so many of all lookups is joined by broadcast: so many entries at most."""


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null where the text is no URL with a host."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]+)", 1)
    return F.nullif(F.rtrim(F.lower(host), F.lit(".")), F.lit(""))


def suffixes(host: Column, labels: int) -> Column:
    """The host and each domain above it, longest first, those of at most `labels` labels: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    return F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def validity(events: DataFrame) -> DataFrame:
    """Dated entries (list, entry, at, action 'add' or 'remove') as intervals: list, entry, valid_from, valid_to.

    An entry holds from an addition to the next removal; valid_to is exclusive and null while it is still
    on the list. Repeated additions or removals change nothing. Of an addition and a removal at one
    time the removal counts. Rows with a null entry, time or another action are no events.
    A window holds one entry's own history.
    """
    known = events.filter(F.col("entry").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
    states = known.groupBy("list", F.rtrim(F.lower("entry"), F.lit(".")).alias("entry"), "at").agg(
        F.min((F.col("action") == "add").cast("int")).alias("on"))
    history = Window.partitionBy("list", "entry").orderBy("at")
    changes = states.filter("entry <> ''").withColumn("was", F.coalesce(F.lag("on").over(history), F.lit(0))).filter("on <> was")
    ends = changes.withColumn("valid_to", F.lead("at").over(history))
    return ends.filter("on = 1").select("list", "entry", F.col("at").alias("valid_from"), "valid_to")


def active_entries(visits: DataFrame, events: DataFrame) -> DataFrame:
    """(host, fetched, list, entry, valid_from) for every entry that covers a host at a time.

    `visits` has distinct pairs of host and fetched. An entry covers its host and all hosts below it; domains of
    more labels than any entry has are not looked up. An entry that a large share of the lookups meets goes by
    broadcast, the others by shuffle: no entry's lookups meet in one task.
    """
    intervals = written(validity(events), "intervals")
    labels = intervals.agg(F.max(F.size(F.split("entry", r"\.")))).first()[0] or 1
    name = F.explode(F.array_distinct(suffixes(F.col("host"), labels))).alias("name")
    lookups = written(visits.select("host", "fetched", name), "lookups")
    counts = lookups.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    hot = written(counts.filter(F.col("n") * HOT_SHARE > F.lit(lookups.count())).select("name"), "hot-names")
    hot_intervals = intervals.join(F.broadcast(hot), F.col("entry") == F.col("name"), "left_semi")
    cold = lookups.join(F.broadcast(hot), "name", "left_anti")
    active = (F.col("entry") == F.col("name")) & (F.col("fetched") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    often = lookups.join(F.broadcast(hot), "name", "left_semi").join(hot_intervals, active)
    return often.unionByName(cold.join(intervals, active)).select("host", "fetched", "list", "entry", "valid_from")


def evaluate(
    captures: DataFrame, events: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_at",
    block: str = "block", allow: str = "allow",
) -> DataFrame:
    """One row per capture: key, fetched, list, entry, valid_from of the deciding entry, blocked.

    Of the entries active at fetch time the most specific (longest) decides; of equal ones `allow` before
    `block`. A capture without active entry, without a host or without a fetch time has nulls and is not
    blocked. Verdicts are found once for each host and time, so every row is decided by its own URL: keys may be
    null or repeat. Hosts and times that many captures share get their verdicts by broadcast, the others by shuffle.
    """
    rows = captures.select(col(key).alias("id"), host_of(col(url)).alias("host"), col(fetched).alias("fetched"))
    decidable = F.col("host").isNotNull() & F.col("fetched").isNotNull()
    known = rows.filter(decidable)
    visits = written(known.groupBy("host", "fetched").agg(F.count(F.lit(1)).alias("n")), "visits")
    found = active_entries(visits.select("host", "fetched"), events)
    decided = found.groupBy("host", "fetched").agg(F.max_by(
        F.struct("list", "entry", "valid_from"),
        F.struct(F.length("entry"), (F.col("list") == allow).cast("int"), "list", "valid_from")).alias("best"))
    verdicts = written(visits.join(decided, ["host", "fetched"], "left"), "verdicts")
    total = verdicts.agg(F.sum("n")).first()[0] or 0
    shared = F.col("n") * HOT_SHARE > F.lit(total)  # fewer than HOT_SHARE rows
    hot = F.broadcast(verdicts.filter(shared).drop("n"))
    often = known.join(hot, ["host", "fetched"])
    seldom = known.join(hot, ["host", "fetched"], "left_anti").join(
        verdicts.filter(~shared).drop("n"), ["host", "fetched"], "left")
    bare = rows.filter(~decidable).withColumn("best", F.lit(None).cast(verdicts.schema["best"].dataType))
    met = often.unionByName(seldom).unionByName(bare)
    return met.select(
        F.col("id").alias(key), F.col("fetched").alias(fetched), F.col("best.list").alias("list"),
        F.col("best.entry").alias("entry"), F.col("best.valid_from").alias("valid_from"),
        F.coalesce(F.col("best.list") == block, F.lit(False)).alias("blocked"))
