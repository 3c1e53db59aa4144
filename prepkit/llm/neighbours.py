"""Approximate nearest neighbours by learned partitions: a balanced cut of a neighbour graph and a router.

Fit (on a bounded sample): the sample's exact neighbour graph is cut into parts of equal size that cross few edges,
then a small softmax classifier learns a vector's part. Index: every row goes to its most probable part, in
blocks of bounded size. Search: a query goes to its few most probable parts and is ranked exactly there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import col, map_arrow, written

SAMPLE = 8192
"""Most vectors that the graph and the router are fitted on; all rows are indexed."""

PART_ROWS = 1024
"""Wanted rows of a part; with more rows there are more parts, up to one per MIN_SAMPLE sampled vectors."""

MIN_SAMPLE = 64
GRAPH_NEIGHBOURS = 10
RECALL = 0.95
"""Share of neighbours that the visited parts must hold, on sampled vectors the router was not fitted on."""

HELD_OUT = 8
"""One in so many sampled vectors is kept from the router to choose the number of visited parts."""

BLOCK_ROWS = 4096
"""Rows of a part that are searched at once."""

K = 5
SLACK = 1e-9
"""Scores this close to the last one are ranked again by the exact measure."""


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Each unit vector's k nearest others by cosine, a block of rows at a time."""
    k = min(k, len(points) - 1)
    found = np.empty((len(points), k), np.int64)
    for start in range(0, len(points), 1024):
        near = points[start:start + 1024] @ points.T
        near[np.arange(len(near)), start + np.arange(len(near))] = -2
        found[start:start + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return found


def balanced_parts(points: np.ndarray, graph: np.ndarray, n_parts: int, rounds: int = 12) -> np.ndarray:
    """Cut the graph into parts of equal size (one more at most): halve by the main direction, then move points to
    the part that most of their neighbours are in, always within the parts' room."""
    n = len(points)
    parts = np.zeros(n, np.int64)
    order = [np.arange(n)]
    while len(order) < n_parts:
        order.sort(key=len)
        big = order.pop()
        if len(big) < 2:
            order.append(big)
            break
        centred = points[big] - points[big].mean(axis=0)
        axis = np.linalg.svd(centred[:: max(1, len(big) // 2000)], full_matrices=False)[2][0]
        ranked = big[np.argsort(centred @ axis, kind="stable")]
        order += [ranked[:len(big) // 2], ranked[len(big) // 2:]]
    for i, members in enumerate(order):
        parts[members] = i
    n_parts = len(order)
    room = -(-n // n_parts)
    for _ in range(rounds):
        votes = np.zeros((n, n_parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), parts[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(parts, graph.shape[1])), 1)
        gain = votes - votes[np.arange(n), parts][:, None]
        wanted = gain.argmax(axis=1)
        best = gain[np.arange(n), wanted]
        sizes = np.bincount(parts, minlength=n_parts)
        moved = 0
        waiting: dict[tuple[int, int], list[int]] = {}
        for i in np.argsort(-best, kind="stable"):
            if best[i] <= 0:
                break
            a, b = int(parts[i]), int(wanted[i])
            if sizes[b] < room:
                sizes[a] -= 1
                sizes[b] += 1
                parts[i] = b
                moved += 1
            elif waiting.get((b, a)):  # exchange with a point that wants to go the other way
                j = waiting[b, a].pop()
                parts[i], parts[j] = b, a
                moved += 2
            else:
                waiting.setdefault((a, b), []).append(int(i))
        if not moved:
            break
    return parts


def fit_router(points: np.ndarray, parts: np.ndarray, steps: int = 400, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and offsets of a softmax classifier of a unit vector's part, by Adam on mini-batches."""
    n, dim = points.shape
    k = int(parts.max()) + 1  # parts that only held-out vectors are in are never routed to
    centres = np.stack([points[parts == i].mean(axis=0) if (parts == i).any() else np.zeros(dim) for i in range(k)])
    w, b = 8 * centres.T, np.zeros(k)
    rng = np.random.default_rng(seed)
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        some = rng.integers(0, n, min(n, 512))
        x, y = points[some], parts[some]
        logits = x @ w + b
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        for i, (value, slope) in enumerate(((w, x.T @ p / len(y) + 1e-4 * w), (b, p.mean(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * slope
            v[i] = 0.999 * v[i] + 0.001 * slope * slope
            value -= 0.05 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w, b


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): vectors as doubles; null, zero and empty ones, and ones with null or non-finite components, left out."""
    vec = F.col("vec")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(col(key).alias("id"), col(vector).cast("array<double>").alias("vec"))
    return rows.filter(vec.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vec, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def probes_for(points: np.ndarray, graph: np.ndarray, w: np.ndarray, b: np.ndarray, recall: float) -> int:
    """The least number of most probable parts that holds `recall` of the nearest K neighbours of `points`' last rows."""
    logits = points @ w + b
    asked = np.arange(len(points) - max(1, len(points) // HELD_OUT), len(points))
    place = np.argsort(np.argsort(-logits[asked], axis=1, kind="stable"), axis=1)
    near = np.take_along_axis(place, logits.argmax(axis=1)[graph[asked]], axis=1)
    return int(np.sort(near.ravel())[int(np.ceil(recall * near.size)) - 1]) + 1


def fit(
    rows: DataFrame, n_rows: int, sample: int = SAMPLE, part_rows: int = PART_ROWS, recall: float = RECALL,
) -> tuple[np.ndarray, np.ndarray, int]:
    """(weights, offsets, parts to visit), fitted on the `sample` rows of least hash (all rows, if no more)."""
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    points = unit(_matrix(picked))
    n_parts = max(1, min(-(-n_rows // part_rows), len(points) // MIN_SAMPLE))
    graph = neighbour_graph(points, GRAPH_NEIGHBOURS)
    if n_parts == 1 or not graph.shape[1]:
        return np.zeros((points.shape[1], 1)), np.zeros(1), 1
    parts = balanced_parts(points, graph, n_parts)
    shown = len(points) - max(1, len(points) // HELD_OUT)
    w, b = fit_router(points[:shown], parts[:shown])
    closest = neighbour_graph(points, K)
    return w, b, probes_for(points, closest, w, b, recall)


def _route(batches: Iterator[pa.RecordBatch], router: Broadcast, probes: int) -> Iterator[pa.RecordBatch]:
    w, b = router.value
    for batch in batches:
        if not batch.num_rows:
            continue
        logits = unit(_matrix(batch["vec"])) @ w + b
        n = min(probes, logits.shape[1])
        parts = np.argsort(-logits, axis=1, kind="stable")[:, :n].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, parts.size + 1, n, dtype=np.int32)), pa.array(parts.ravel()))
        yield pa.RecordBatch.from_arrays([batch["id"], batch["vec"], lists], ["id", "vec", "parts"])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, each sum in the same order wherever the vectors stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _best(ids_q: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple]:
    """(query, candidate, score) of the k nearest ids of a block of candidates, sorted by id, for each query."""
    near = unit(q) @ unit(x).T
    near[ids_q[:, None] == ids[None, :]] = -np.inf
    begins = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    each = np.maximum.reduceat(near, begins, axis=1)  # an id may have several vectors
    out = []
    keep = min(k, each.shape[1])
    last = np.partition(each, each.shape[1] - keep, axis=1)[:, each.shape[1] - keep]
    for i in range(len(q)):
        at = np.flatnonzero((near[i] >= last[i] - SLACK) & np.isfinite(near[i]))
        exact = cosine(np.broadcast_to(q[i], (len(at), q.shape[1])), x[at])
        order = np.lexsort((-exact, ids[at]))
        first = order[np.append(True, np.diff(ids[at[order]]) != 0)[:len(order)]]
        chosen = first[np.lexsort((ids[at[first]], -exact[first]))][:k]
        out += [(ids_q[i], ids[at[j]], exact[j]) for j in chosen]
    return out


def _search(k: int):
    def work(key: tuple, queries: pa.Table, block: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if queries.num_rows and block.num_rows:
            block = block.sort_by("id")
            x, ids = _matrix(block["vec"].combine_chunks()), block["id"].to_numpy()
            for start in range(0, queries.num_rows, 512):
                some = queries.slice(start, 512)
                rows += _best(some["id"].to_numpy(), _matrix(some["vec"].combine_chunks()), ids, x, k)
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    return work


def one_length(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows whose vectors have the most frequent length (of equally frequent ones the least), their count, the length."""
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    return (rows.filter(F.size("vec") == most["dim"]), most["n"], most["dim"]) if most else (rows, 0, 0)


def nearest(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K,
    sample: int = SAMPLE, part_rows: int = PART_ROWS, probes: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` (of the same columns as `df`) its k nearest found.

    Nearness is the cosine in double precision on the original vectors, ties go to the smaller id, rows with the
    query's own id are no candidates. Vectors that are null, zero, empty or hold null or non-finite components
    take no part, nor do those of another length than most have (of two equally frequent lengths the shorter
    counts). Ids must be whole numbers; null ids take no part. Where an id has several vectors, as query or
    candidate, two ids are as near as their nearest vectors, and each candidate is listed once.
    Every row is indexed. A part of any size is searched in blocks of about BLOCK_ROWS rows, each of which gives
    k rows per query, so neither common vectors nor uneven parts gather in one task. Queries that find fewer than
    k visit twice as many parts, until they have k or have visited all.
    """
    spark = df.sparkSession
    rows = usable(df, key, vector).filter("id is not null").withColumn("id", F.col("id").cast("long"))
    asked = usable(queries, key, vector).filter("id is not null").withColumn("id", F.col("id").cast("long"))
    rows, n_rows, dim = one_length(rows)
    if not n_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    w, b, enough = fit(rows, n_rows, sample, part_rows)
    router = spark.sparkContext.broadcast((w, b))
    routed = "id long, vec array<double>, parts array<int>"
    index = written(map_arrow(rows.distinct(), lambda i: _route(i, router, 1), routed).select(
        "id", "vec", F.col("parts")[0].alias("part")), "index")
    sizes = index.groupBy("part").agg(F.count(F.lit(1)).alias("rows_"))  # one row per part
    sizes = F.broadcast(sizes.select("part", F.ceil(F.col("rows_") / BLOCK_ROWS).cast("int").alias("blocks")))
    blocks = index.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")).cast("int"))
    blocks = blocks.select("part", "block", "id", "vec")

    def search(some: DataFrame, n: int) -> DataFrame:
        """The best of each query's n most probable parts: query_id, best."""
        visits = map_arrow(some, lambda i: _route(i, router, n), routed).select("id", "vec", F.explode("parts").alias("part"))
        visits = visits.join(sizes, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        found = visits.select("part", "block", "id", "vec").groupBy("part", "block").cogroup(
            blocks.groupBy("part", "block")).applyInArrow(_search(k), "query_id long, vec_id long, score double")
        pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return pairs.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(
            (-F.col("score")).alias("far"), "vec_id", "score"))), 1, k).alias("best"))

    asked = written(asked.filter(F.size("vec") == dim).distinct(), "queries")
    visited, n_parts = probes or enough, w.shape[1]
    best = written(search(asked, visited), "best")
    while visited < n_parts:
        full = best.filter(F.size("best") >= k).select("query_id")
        short = asked.join(full, F.col("id") == F.col("query_id"), "left_anti")
        if not short.head(1):
            break
        visited = min(2 * visited, n_parts)
        found = search(short, visited)
        best = written(best.join(full, "query_id", "left_semi").unionByName(found), "best")
    return best.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.score").alias("score"))
