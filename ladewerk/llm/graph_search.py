"""Approximate nearest neighbours on robust-pruned directed graphs, one for each shard.

Each shard's graph is built in two passes: a greedy search from the shard's middle
proposes neighbours of each vector, and pruning keeps a neighbour only where no kept one
is nearer to it by the relaxed factor. Searches and pruning run for a block of vectors at
a time. Queries walk every shard's graph with a beam; the best of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladewerk.llm.common import cut

SHARD_ROWS = 4096
DEGREE, BEAM, ALPHA = 32, 64, 1.2
BLOCK = 256
#: Shards of at most so many points hold all their distances while they are built.
TABLE_ROWS = 8192
#: Points that searches start from at least; queries of a shard whose answers are compared
#: with brute force, and the share that the beam must find of these.
ENTRIES, PROBES, RECALL = 64, 64, 0.98


def _squares(points: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of queries[i] to points[ids[i, j]]; infinite where the id is -1."""
    near = points[np.maximum(ids, 0)]
    near -= queries[:, None, :]
    out = np.einsum("ijk,ijk->ij", near, near)
    out[ids < 0] = np.inf
    return out


def _between(points: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The function that gives the squared distances of points[own[i]] to points[ids[i, j]],
    infinite where the id is -1. Of a shard of usual size each is computed once, as a matrix
    product; building asks for the same ones many times over."""
    n = len(points)
    if n > TABLE_ROWS:
        single = points.astype(np.float32)
        return lambda own, ids: _squares(single, ids, single[own])
    squares = np.einsum("ij,ij->i", points, points)
    table = np.empty((n, n + 1), np.float32)
    table[:, n] = np.inf  # where the id -1 of the next row leads, and of the first the last
    for i in range(0, n, BLOCK):
        part = squares[i : i + BLOCK, None] + squares - 2 * (points[i : i + BLOCK] @ points.T)
        table[i : i + BLOCK, :n] = np.maximum(part, 0)
    flat = table.ravel()
    return lambda own, ids: flat.take(own[:, None].astype(np.int64) * (n + 1) + ids)


def beam_search(far: Callable[[np.ndarray, np.ndarray], np.ndarray], graph: np.ndarray, start: np.ndarray, n: int, beam: int, at_once: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ids and squared distances (beam columns, nearest first, -1 and infinite where
    there are fewer), and the ids expanded on the way (-1 filled), for a block of n queries
    that start from the best of some entries and expand at_once ids a step. far(rows, ids)
    are the squared distances of queries to points, infinite where an id is -1."""
    ids = np.full((n, beam), -1, np.int32)
    dist = np.full((n, beam), np.inf)
    rows = np.arange(n)
    for i in range(0, len(start), BLOCK):
        some = np.broadcast_to(start[i : i + BLOCK], (n, len(start[i : i + BLOCK]))).astype(np.int32)
        all_ids = np.concatenate((ids, some), axis=1)
        all_dist = np.concatenate((dist, far(rows, some)), axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids, dist = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_dist, order, 1)
    done = ids < 0
    expanded = []
    seen = np.zeros((n, len(graph)), bool)
    seen[:, start] = True
    while len(rows):
        waiting = np.where(done[rows], np.inf, dist[rows])
        # The beam is sorted, so the first that wait are the nearest.
        pick = np.argsort(done[rows], axis=1, kind="stable")[:, :at_once]
        more = np.isfinite(waiting.min(axis=1))
        rows, pick, waiting = rows[more], pick[more], waiting[more]
        if not len(rows):
            break
        open_ = np.isfinite(np.take_along_axis(waiting, pick, 1))
        step = np.full((n, at_once), -1, np.int32)
        step[rows] = np.where(open_, np.take_along_axis(ids[rows], pick, 1), -1)
        expanded.append(step)
        done[rows[:, None], pick] = True
        near = np.where((step[rows] >= 0)[:, :, None], graph[step[rows]], -1).reshape(len(rows), -1)
        if at_once > 1:
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        fresh = (near >= 0) & ~seen[rows[:, None], np.maximum(near, 0)]
        near = np.where(fresh, near, -1)
        at, column = np.nonzero(fresh)
        seen[rows[at], near[at, column]] = True
        d = far(rows, near)
        all_ids = np.concatenate((ids[rows], near), axis=1)
        all_dist = np.concatenate((dist[rows], d), axis=1)
        all_done = np.concatenate((done[rows], ~fresh), axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[rows] = np.take_along_axis(all_ids, order, 1)
        dist[rows] = np.take_along_axis(all_dist, order, 1)
        done[rows] = np.take_along_axis(all_done, order, 1)
    return ids, dist, np.concatenate(expanded, axis=1) if expanded else np.full((n, 0), -1, np.int32)


def prune(between: Callable[[np.ndarray, np.ndarray], np.ndarray], own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each own id at most degree of its candidate ids (-1 filled), nearest first; a
    candidate goes if a kept one is nearer to it, by the factor alpha, than own is."""
    ids = np.sort(candidates, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    ids[ids == own[:, None]] = -1
    dist = between(own, ids)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    out = np.full((len(own), degree), -1, np.int32)
    for j in range(degree):
        at = np.isfinite(dist).argmax(axis=1)
        rows = np.flatnonzero(np.isfinite(dist[np.arange(len(own)), at]))
        if not len(rows):
            break
        kept = ids[rows, at[rows]]
        out[rows, j] = kept
        gone = alpha * alpha * between(kept, ids[rows]) <= dist[rows]
        gone[np.arange(len(rows)), at[rows]] = True
        dist[rows] = np.where(gone, np.inf, dist[rows])
    return out


def _entries(graph: np.ndarray, start: np.ndarray) -> np.ndarray:
    """start, and further points until a walk from one of them comes to every point."""
    reached = np.zeros(len(graph), bool)
    entries, edge = list(start), np.asarray(start)
    while True:
        while len(edge):
            reached[edge] = True
            near = np.unique(graph[edge])
            near = near[near >= 0]
            edge = near[~reached[near]]
        left = np.flatnonzero(~reached)
        if not len(left):
            return np.array(entries, np.int32)
        entries.append(left[0])
        edge = left[:1]


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The neighbours of each point (-1 filled), and where searches start: the middle, some
    points of all places, and one of each part that these do not reach."""
    n = len(points)
    random = np.random.default_rng(seed)
    # Single precision is enough to choose neighbours by, around the middle and on one scale.
    points = points - points.mean(axis=0)
    points = points / max(np.abs(points).max(), np.finfo(float).tiny)
    between = _between(points)
    middle = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    start = np.unique(np.append(random.permutation(n)[: ENTRIES - 1], middle)).astype(np.int32)
    graph = random.integers(0, n, (n, min(degree, 8)), dtype=np.int32)
    graph = np.pad(graph, ((0, 0), (0, degree - graph.shape[1])), constant_values=-1)
    graph[graph == np.arange(n)[:, None]] = -1
    for factor in (1.0, alpha):
        order = random.permutation(n)
        for i in range(0, n, BLOCK):
            own = order[i : i + BLOCK]
            ids, _, expanded = beam_search(lambda rows, ids: between(own[rows], ids), graph, start, len(own), beam)
            graph[own] = prune(between, own, np.concatenate((ids, expanded, graph[own]), axis=1), degree, factor)
            source = np.repeat(own, degree)
            target = graph[own].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            edges = np.flatnonzero(np.diff(target, prepend=-1))
            sizes = np.diff(np.append(edges, len(target)))
            back = np.full((len(edges), degree + int(sizes.max(initial=0))), -1, np.int32)
            hit = target[edges]
            back[:, :degree] = graph[hit]
            back[np.repeat(np.arange(len(edges)), sizes), degree + np.arange(len(target)) - np.repeat(edges, sizes)] = source
            # Those that gain alike are pruned together, with no more columns than they need.
            by = np.argsort(sizes, kind="stable")
            for j in range(0, len(hit), BLOCK):
                some = by[j : j + BLOCK]
                graph[hit[some]] = prune(between, hit[some], back[some, : degree + sizes[some[-1]]], degree, factor)
    return graph, _entries(graph, start)


def wide_enough(points: np.ndarray, graph: np.ndarray, start: np.ndarray, queries: np.ndarray, k: int, beam: int) -> int:
    """The beam, or the first of its doubles that finds RECALL of the k nearest points of
    PROBES of the queries, as brute force knows them. As wide as the shard, it finds all."""
    probes = queries[:: -(-len(queries) // PROBES)]
    k = min(k, len(points))
    limit = np.array([np.partition(((points - q) ** 2).sum(axis=1), k - 1)[k - 1] for q in probes])
    while beam < len(points):
        _, dist, _ = beam_search(lambda rows, ids: _squares(points, ids, probes[rows]), graph, start, len(probes), beam, max(1, beam // BLOCK))
        # The two sums may differ in their last bits.
        if (dist[:, :k] <= limit[:, None] * (1 + 1e-9)).mean() >= RECALL:
            break
        beam *= 2
    return min(beam, max(k, len(points)))


def _usable(rows: DataFrame) -> DataFrame:
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col("vec_id").cast("long"), e.cast("array<double>").alias("embedding")).where(e.isNotNull() & F.col("vec_id").isNotNull()).where(~bad & F.exists(e, lambda x: x != 0))


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def graph_index(rows: DataFrame, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """shard, size, vec_id, embedding, neighbours (places in the shard by vec_id order) and
    entry (searches start there) of each vector in rows (vec_id, embedding; vectors distinct). Shards are dealt by
    hash, for each vector length apart, with about shard_rows rows."""
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("size", F.size("embedding"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        graph, start = build_graph(_vectors(table.column("embedding")), degree, beam, alpha)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(graph.ravel()), degree).cast(pa.list_(pa.int32()))
        n = table.num_rows
        return pa.table({"shard": table.column("shard"), "size": table.column("size"), "vec_id": table.column("vec_id"), "embedding": table.column("embedding"), "neighbours": lists, "entry": pa.array(np.isin(np.arange(n), start))})

    return dealt.groupBy("shard", "size").applyInArrow(run, "shard int, size int, vec_id long, embedding array<double>, neighbours array<int>, entry boolean")


def nearest(rows: DataFrame, every: int = 100, k: int = 10, beam: int = 2 * BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of each row whose vec_id is
    divisible by every, by Euclidean distance in double precision; ties to smaller vec_id.

    rows: vec_id, embedding; other columns are not read. Rows whose id or vector is null,
    and vectors that are zero or hold null or non-finite components, take no part. Only
    vectors of one length are compared. Equal vectors are one point of the index with its
    k + 1 smallest vec_ids, which is all that any answer can hold. Rows that repeat a
    vec_id with the same vector count once. A beam of `beam` is widened where a shard's
    vectors need it (`wide_enough`). An empty table gives no rows.
    """
    usable = _usable(rows)
    window = Window.partitionBy("embedding").orderBy("vec_id")
    # Limited to k + 1 rows a vector in each task before the exchange.
    few = usable.distinct().withColumn("turn", F.row_number().over(window)).where(F.col("turn") <= k + 1)
    points = few.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = cut(points)
    index = cut(graph_index(points.select("vec_id", "embedding")))
    queries = usable.where(F.col("vec_id") % every == 0).distinct().select(F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("size"))
    shards = index.select(F.col("shard").alias("part"), "size").distinct()
    asked = queries.join(shards, "size").select("part", F.col("size").alias("dimensions"), "query_id", "embedding")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            exact = _vectors(left.column("embedding"))
            graph = _vectors(left.column("neighbours"))
            start = np.flatnonzero(left.column("entry").to_numpy(zero_copy_only=False))
            vec_ids = left.column("vec_id").to_numpy()
            wanted = _vectors(right.column("embedding"))
            query_ids = right.column("query_id").to_numpy()
            width = wide_enough(exact, graph, start, wanted, k + 1, beam)
            for i in range(0, len(wanted), BLOCK):
                q = wanted[i : i + BLOCK]
                ids, _, _ = beam_search(lambda rows, ids: _squares(exact, ids, q[rows]), graph, start, len(q), width, max(1, width // BLOCK))
                dist = np.sqrt(((exact[np.maximum(ids, 0)] - q[:, None, :]) ** 2).sum(axis=2))
                dist[ids < 0] = np.inf
                order = np.lexsort((vec_ids[np.maximum(ids, 0)], dist), axis=1)[:, : k + 1]
                ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
                fine = ids >= 0
                out[0].append(np.broadcast_to(query_ids[i : i + BLOCK, None], ids.shape)[fine])
                out[1].append(vec_ids[np.maximum(ids, 0)][fine])
                out[2].append(dist[fine])
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
        return pa.table({"query_id": cat(out[0], np.int64), "point": cat(out[1], np.int64), "score": cat(out[2], np.float64)})

    found = index.groupBy("shard", "size").cogroup(asked.groupBy("part", "dimensions")).applyInArrow(search, "query_id long, point long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "point")
    near = found.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= k + 1)
    ids = points.select(F.col("vec_id").alias("point"), "ids")
    each = near.join(ids, "point").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
