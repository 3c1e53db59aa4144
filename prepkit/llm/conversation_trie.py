"""Conversations as one prefix trie. Turns that no other conversation can share are never shuffled for it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.order import ranked
from prepkit.llm.shared import col, map_arrow, width, written

MOST_SHARED = 8
"""Most turns that a rebuilt conversation takes from another one (a checksum modulo 9)."""

FAMILY = 5
"""Conversations c - c % FAMILY to the next multiple share the first one's beginning."""

BLOCK = 1 << 20
"""Turns of one conversation that one task keeps in order."""

CELLS_PER_PREFIX = 16
MAX_CELLS = 1 << 27
"""Cells of each of the sketch's two rows. As one bit a cell is broadcast, that is 32 MB at most. A fuller
sketch proves fewer prefixes single; the others are grouped exactly, so results do not depend on it."""

CHUNK_BYTES = 1 << 20
"""Joined ids of a node that are one row on their way to its hash."""

NODE = ["q1", "q2"]
PARENT = ["p1", "p2"]


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos from 0, x1, x2, bytes): every turn's place, 128-bit digest and UTF-8 bytes of its text.

    Order: turn, null first; equal turns by role and text (64 characters of each), then by digest. Null
    roles and texts are empty ones. Rows without a conversation id belong to none and are left out. A
    conversation with most of the rows is ordered over many tasks; texts themselves are not moved.
    """
    said = [F.coalesce(col(name).cast("string"), F.lit("")) for name in (role, text)]
    rows = df.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv_id"), col(turn).alias("turn"),
        F.substring(said[0], 1, 64).alias("role"), F.substring(said[1], 1, 64).alias("text"),
        *[F.xxhash64(F.lit(i), *said).alias(f"x{i}") for i in (1, 2)],
        F.octet_length(said[1]).cast("long").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), *[F.col(n).asc() for n in ("role", "text", "x1", "x2")]]
    return ranked(rows, ["conv_id"], order, "pos").select("conv_id", "pos", "x1", "x2", "bytes")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, conversations) of numbered turns without any rebuilding: what `trie` takes."""
    convs = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")), "conversations")
    blocks = convs.select("conv_id", "length", F.explode(_blocks(F.col("length"))).alias("block"))
    steps = turns.withColumn("block", F.expr(f"pos div {BLOCK}")).join(blocks, ["conv_id", "block"])
    return steps.select("conv_id", "length", (F.col("pos") + 1).alias("depth"), "x1", "x2", "bytes"), convs


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, conversations): every conversation c after its beginning was replaced.

    With h = crc32 of c's decimal digits modulo 9, c gets the first h turns of conversation c - c % 5 (all
    if that has fewer, none if it does not exist), then its own turns after its first h. Remainders have
    the sign of c. steps: conv_id, length, depth from 1, x1, x2, bytes; conversations: conv_id, length, also
    where no turn is left.
    """
    taken = (F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)).cast("int")
    heads = (
        turns.where((F.col("pos") < MOST_SHARED) & (F.col("conv_id") % FAMILY == 0))
        .groupBy(F.col("conv_id").alias("source"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "bytes"))).alias("head")))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumns({"h": taken, "source": F.col("conv_id") - F.col("conv_id") % FAMILY})
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,x1:bigint,x2:bigint,bytes:bigint>>")), 1, F.col("h"))
    convs = sizes.join(heads, "source", "left").withColumn("head", head)
    convs = convs.withColumn("length", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long")))
    convs = written(convs.select("conv_id", "n", "h", "head", "length"), "conversations")
    shared = convs.select("conv_id", "length", F.posexplode("head").alias("at", "turn")).select(
        "conv_id", "length", (F.col("at") + 1).cast("long").alias("depth"), "turn.x1", "turn.x2", "turn.bytes")
    blocks = convs.where("n > h").select(
        "conv_id", "length", "h", F.size("head").alias("m"), F.explode(_blocks(F.col("n"))).alias("block"))
    own = turns.withColumn("block", F.expr(f"pos div {BLOCK}")).join(blocks, ["conv_id", "block"]).where("pos >= h")
    own = own.select("conv_id", "length", (F.col("pos") + 1 + F.col("m") - F.col("h")).alias("depth"), "x1", "x2", "bytes")
    return shared.unionByName(own), convs.select("conv_id", "length")


def _blocks(n: Column) -> Column:
    """Numbers of the blocks that n turns span, so that a long conversation's joins have many keys."""
    return F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / BLOCK))


def prefixes(steps: DataFrame) -> DataFrame:
    """Each step with the digests of the prefix that ends with it (q1, q2) and of the one before (p1, p2).

    A prefix's digest is the XOR of its turns' digests, each taken together with its depth: 128 bits that
    can be summed over blocks of a conversation. `cum`: bytes from the first turn to this one.
    """
    at_depth = [F.xxhash64(F.lit(i), "depth", "x1", "x2").alias(f"z{i}") for i in (1, 2)]
    rows = written(steps.select(
        "conv_id", "length", "depth", F.expr(f"(depth - 1) div {BLOCK}").alias("block"), *at_depth, "bytes"), "steps")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.where(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(
        F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.sum("bytes").alias("bytes"))
    carry = carry.select(
        "conv_id", "block", F.bit_xor("z1").over(earlier).alias("c1"), F.bit_xor("z2").over(earlier).alias("c2"),
        F.sum("bytes").over(earlier).alias("c_bytes")).where("block > 0")
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)

    def whole(i: int) -> Column:
        return F.bit_xor(f"z{i}").over(so_far).bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long")))

    done = rows.join(carry, ["conv_id", "block"], "left").withColumns({
        "q1": whole(1), "q2": whole(2),
        "cum": F.sum("bytes").over(so_far) + F.coalesce("c_bytes", F.lit(0).cast("long"))})
    return written(done.select(
        "conv_id", "length", "depth", F.col("q1").bitwiseXOR(F.col("z1")).alias("p1"),
        F.col("q2").bitwiseXOR(F.col("z2")).alias("p2"), "q1", "q2", "bytes", "cum"), "prefixes")


class Screen:
    """A count-min sketch of prefix digests with two rows of cells, kept as "more than one" bits.

    Counts never come out too low: a prefix with an untouched-by-others cell in either row is proved to
    belong to one conversation.
    """

    def __init__(self, rows: DataFrame):
        n = rows.count()
        self.cells = 1 << min(max((CELLS_PER_PREFIX * n).bit_length(), 10), MAX_CELLS.bit_length() - 1)
        low = F.lit(self.cells - 1)
        each = F.explode(F.array(
            F.col("q1").bitwiseAND(low), F.lit(self.cells) + F.col("q2").bitwiseAND(low))).alias("cell")
        many = rows.select(each).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        word = F.shiftright("cell", 6).cast("int").alias("word")
        bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
        found = many.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()  # 2 * MAX_CELLS / 64 rows at most
        bits = np.zeros(2 * self.cells // 64, np.uint64)
        bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        self.bits = rows.sparkSession.sparkContext.broadcast(bits)

    def flagged(self, rows: DataFrame) -> DataFrame:
        """Add `shared` and `parent_shared`: whether the prefix, and the one before it, may have several members."""
        held, cells = self.bits, self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = held.value

            def many(one: pa.Array, two: pa.Array) -> np.ndarray:
                out = True
                for start, digest in ((0, one), (cells, two)):
                    cell = (digest.to_numpy(zero_copy_only=False) & (cells - 1)) + start
                    out = out & (bits[cell >> 6] >> (cell & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
                return out

            for batch in batches:
                at_root = pc.equal(batch["depth"], 1).to_numpy(zero_copy_only=False)
                shared, parent = many(batch["q1"], batch["q2"]), many(batch["p1"], batch["p2"]) | at_root
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(shared), pa.array(parent)], [*batch.schema.names, "shared", "parent_shared"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        return map_arrow(rows, run, f"{kinds}, shared boolean, parent_shared boolean")


def joined_ids_hash(members: DataFrame) -> DataFrame:
    """(q1, q2, ends_sha256): SHA-256 of each node's ids in ascending order, joined by commas.

    Members are dealt out by range of (node, id), so a node with very many is joined up by many tasks, to
    rows of about CHUNK_BYTES; only these meet in one task, which hashes them one after the other.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two, ids = (batch[n].to_numpy(zero_copy_only=False) for n in ("q1", "q2", "conv_id"))
            texts = batch["conv_id"].cast(pa.string()).to_pylist()
            edges = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1
            most = CHUNK_BYTES // 20
            starts = [s for a, b in zip([0, *edges], [*edges, len(ids)]) for s in range(a, b, most)]
            joined = [",".join(texts[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[starts]), pa.array(two[starts]), pa.array(ids[starts]), pa.array(joined, pa.string())],
                ["q1", "q2", "first_id", "joined"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            out: list[tuple] = []
            for one, two, _, joined in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node == (one, two):
                    running.update(b",")
                else:
                    if node:
                        out.append((*node, running.hexdigest()))
                    node, running = (one, two), hashlib.sha256()
                running.update(joined.encode())
            yield _nodes(out)
        if node:
            yield _nodes([(*node, running.hexdigest())])

    def _nodes(out: list[tuple]) -> pa.RecordBatch:
        one, two, text = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(text, pa.string())], ["q1", "q2", "ends_sha256"])

    n = width(members)
    dealt = members.repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    parts = map_arrow(dealt, chunks, "q1 long, q2 long, first_id long, joined string")
    parts = parts.repartition(n, *NODE).sortWithinPartitions(*NODE, "first_id")
    return map_arrow(parts, hashes, "q1 long, q2 long, ends_sha256 string")


def trie(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct beginning of a conversation, the empty one included.

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (childless
    nodes of its subtree), saved_tokens (sum over its subtree of (n_convs - 1) times the bytes of the node's
    last text), ends_sha256 (of the ids of the members that end there). No conversations: no rows.

    The screen proves most prefixes single. Those are nodes already, made where they stand; only the first
    of a conversation's single prefixes looks up its parent. The others are grouped by digest. Sums over
    subtrees need no walk over the tree: a leaf counts for the beginnings of its smallest member, and a
    node's bytes are saved by each member but the smallest, so every member adds, to each of its prefixes,
    the bytes from there to the last prefix that it does not lead.
    """
    rows = prefixes(steps)
    flagged = Screen(rows).flagged(rows)
    shared = written(flagged.where("shared").drop("parent_shared"), "shared")
    tails = flagged.where("not shared")
    nodes = written(shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("depth") == F.col("length")).alias("n_ends"),
        *[F.min(n).alias(n) for n in ("depth", *PARENT)]), "nodes")

    led = shared.join(nodes.select(*NODE, "first", "n_convs", "n_ends"), NODE)
    follows = F.col("first") != F.col("conv_id")
    inner_end = (F.col("depth") == F.col("length")) & (follows | (F.col("n_ends") < F.col("n_convs")))
    members = written(led.groupBy("conv_id").agg(
        F.coalesce(F.max(F.when(follows, F.col("cum"))), F.lit(0).cast("long")).alias("reach"),
        F.max(inner_end.cast("long")).alias("no_leaf")), "members")
    saved = F.greatest(F.col("reach") - (F.col("cum") - F.col("bytes")), F.lit(0).cast("long"))
    sums = shared.join(members, "conv_id").groupBy(*NODE).agg(
        F.sum("no_leaf").alias("no_leaf"), F.sum(saved).alias("saved_tokens"))
    kids = nodes.select(*PARENT).unionByName(tails.where("parent_shared").select(*PARENT))
    kids = kids.groupBy(F.col("p1").alias("q1"), F.col("p2").alias("q2")).agg(F.count(F.lit(1)).alias("n_children"))
    kids = written(kids, "children")

    root = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(F.col("length") == 0).alias("n_ends")).first()
    if not root.n_convs:
        return _output(nodes.withColumns({
            "parent": F.col("first"), "n_children": F.col("n_ends"), "n_leaves": F.col("n_ends"),
            "saved_tokens": F.col("n_ends"), "ends_sha256": F.lit("")}))
    ends = shared.where(F.col("depth") == F.col("length")).select(*NODE, "conv_id").unionByName(
        convs.where("length = 0").select(*[F.lit(0).cast("long").alias(n) for n in NODE], "conv_id"))
    ends = joined_ids_hash(ends)
    no_ends = F.sha2(F.lit(""), 256)

    # The root's digest is (0, 0), the XOR of nothing.
    top = members.agg(
        F.coalesce(F.sum("reach"), F.lit(0)).alias("saved_tokens"), F.coalesce(F.sum("no_leaf"), F.lit(0)).alias("no_leaf"))
    some_leaf = F.lit(root.n_convs - root.n_ends) - F.col("no_leaf")
    top = top.select(
        *[F.lit(0).cast("long").alias(n) for n in NODE], F.lit(root.conv_id).cast("long").alias("first"),
        F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
        F.lit(root.n_convs).cast("long").alias("n_convs"), "saved_tokens",
        (F.lit(1) if root.n_ends == root.n_convs else some_leaf).cast("long").alias("n_leaves"))

    above = nodes.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.col("first").alias("above"))
    at_root = F.when(F.col("depth") == 1, F.lit(root.conv_id))
    known = nodes.join(sums, NODE).join(above, PARENT, "left").select(
        *NODE, "first", "depth", F.coalesce(at_root, "above", "first").cast("long").alias("parent"), "n_convs",
        "saved_tokens", (F.col("n_convs") - F.col("no_leaf")).alias("n_leaves"))
    known = known.unionByName(top).join(kids, NODE, "left").join(ends, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")), "ends_sha256": F.coalesce("ends_sha256", no_ends)})

    first_tails = tails.where("parent_shared and depth > 1").join(above, PARENT).withColumn("parent", F.col("above"))
    later = tails.where("not parent_shared or depth = 1").withColumn("parent", F.coalesce(at_root, "conv_id").cast("long"))
    last = F.col("depth") == F.col("length")
    single = first_tails.drop("above").unionByName(later).withColumns({
        "first": F.col("conv_id"), "n_convs": F.lit(1).cast("long"), "n_children": F.when(last, 0).otherwise(1).cast("long"),
        "n_leaves": F.lit(1).cast("long"), "saved_tokens": F.lit(0).cast("long"),
        "ends_sha256": F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(no_ends)})
    return _output(known).unionByName(_output(single))


def _output(rows: DataFrame) -> DataFrame:
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    return rows.select(
        F.col("first").alias("conv_id"), F.col("depth"), F.col("parent").alias("parent_conv_id"), *numbers, "ends_sha256")
