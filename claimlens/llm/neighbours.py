"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched by beams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.common import written

SHARD_ROWS = 4096
QUERY_BLOCK = 256
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 100
ALPHA = 1.2
TOP = 20
EVERY = 20


def _longer(x: np.ndarray) -> np.ndarray:
    """Rows with one coordinate more, all of one length: the nearest to a query are then those of largest inner product."""
    squares = (x * x).sum(axis=1)
    return np.hstack([x, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]]).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, asked: np.ndarray, beam: int, keep_visited: bool = False):
    """Greedy beam searches for many query rows side by side.

    ``graph`` holds neighbour numbers, -1 where there are fewer. Gives (numbers, distances) of each query's beam, nearest
    first, -1 where it found fewer; with ``keep_visited`` also the points each search expanded.
    """
    q, n = len(asked), len(x)
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf, np.float32)
    expanded = np.ones((q, beam), bool)
    ids[:, 0], expanded[:, 0] = entry, False
    dist[:, 0] = ((asked - x[entry]) ** 2).sum(axis=1)
    met = np.zeros((q, n), bool)
    met[:, entry] = True
    visited: list[list] = [[], []]
    live = np.arange(q)
    while True:
        waiting = ~expanded[live]
        live = live[waiting.any(axis=1)]
        if not len(live):
            break
        slot = np.argmax(~expanded[live], axis=1)  # the nearest not yet expanded: beams are sorted
        point = ids[live, slot]
        expanded[live, slot] = True
        if keep_visited:
            visited[0].append(live)
            visited[1].append(point)
        near = graph[point]
        row = np.repeat(live, near.shape[1])
        flat = near.ravel()
        fresh = flat >= 0
        fresh[fresh] = ~met[row[fresh], flat[fresh]]
        d = np.full(len(flat), np.inf, np.float32)
        some = np.flatnonzero(fresh)
        met[row[some], flat[some]] = True
        gap = x[flat[some]] - asked[row[some]]
        d[some] = np.einsum("ij,ij->i", gap, gap)
        new_ids = np.where(fresh, flat, -1).reshape(near.shape)
        all_ids = np.hstack([ids[live], new_ids])
        all_dist = np.hstack([dist[live], d.reshape(near.shape)])
        done = np.hstack([expanded[live], ~fresh.reshape(near.shape)])
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, order, 1)
        dist[live] = np.take_along_axis(all_dist, order, 1)
        expanded[live] = np.take_along_axis(done, order, 1)
    ids[~np.isfinite(dist)] = -1
    if not keep_visited:
        return ids, dist
    rows, points = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in visited)
    return ids, dist, rows, points


def robust_prune(x: np.ndarray, point: int, candidates: np.ndarray, alpha: float = ALPHA, degree: int = DEGREE) -> np.ndarray:
    """Diverse neighbours: the nearest is kept, and whatever is much nearer to it than to the point goes, and so on."""
    candidates = np.unique(candidates)
    candidates = candidates[candidates != point]
    if not len(candidates):
        return candidates
    there = x[candidates]
    own = ((there - x[point]) ** 2).sum(axis=1)
    order = np.argsort(own, kind="stable")
    candidates, there, own = candidates[order], there[order], own[order]
    norms = (there * there).sum(axis=1)
    between = norms[:, None] + norms[None, :] - 2 * (there @ there.T)
    alive, chosen = np.ones(len(candidates), bool), []
    relaxed = alpha * alpha
    while len(chosen) < degree:
        k = int(np.argmax(alive))
        if not alive[k]:
            break
        chosen.append(k)
        alive &= relaxed * between[k] > own
        alive[k] = False
    return candidates[chosen]


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, int]:
    """A graph over the rows of ``x`` (at most a shard) and its entry point.

    From a random graph, points are searched for in batches; what a search expanded is pruned to the point's edges, and the
    point is offered to each new neighbour, which prunes again when it has too many.
    """
    n = len(x)
    entry = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    graph = np.full((n, degree), -1, np.int64)
    if n == 1:
        return graph, entry
    draw = np.random.default_rng(seed)
    some = min(degree, n - 1)
    graph[:, :some] = (np.arange(n)[:, None] + draw.integers(1, n, (n, some))) % n
    order = draw.permutation(n)
    for k in range(0, n, 256):
        batch = order[k : k + 256]
        ids, _, rows, points = beam_search(x, graph, entry, x[batch], beam, keep_visited=True)
        by_row = np.argsort(rows, kind="stable")
        cuts = np.searchsorted(rows[by_row], np.arange(len(batch) + 1))
        offers: dict[int, list] = {}
        for j, point in enumerate(batch.tolist()):
            found = np.concatenate([points[by_row[cuts[j] : cuts[j + 1]]], ids[j], graph[point]])
            near = robust_prune(x, point, found[found >= 0], alpha, degree)
            graph[point] = -1
            graph[point, : len(near)] = near
            for other in near.tolist():
                offers.setdefault(other, []).append(point)
        for other, points_ in offers.items():
            held = graph[other][graph[other] >= 0]
            new = np.setdiff1d(np.array(points_), held)
            if len(held) + len(new) <= degree:
                graph[other, len(held) : len(held) + len(new)] = new
            else:
                near = robust_prune(x, other, np.concatenate([held, new]), alpha, degree)
                graph[other] = -1
                graph[other, : len(near)] = near
    return graph, entry


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part: an id, and a vector of finite numbers, not all zero."""
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .where("vec_id is not null and v is not null")
        .where(~odd & F.exists("v", lambda c: c != 0))
    )


def index_shards(vectors: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: one row a shard with its distinct vectors, their ids and the graph, packed.

    Equal vectors are one point. It carries its ``top`` + 1 smallest ids: no list of ``top`` can hold a larger one, since equal
    vectors tie and ties go to smaller ids. The rank is limited before the shuffle, so a vector shared by a third of the rows
    costs a few rows a task.
    """
    keyed = vectors.withColumn("same", F.xxhash64("v"))
    place = F.row_number().over(W.partitionBy("same", "v").orderBy("vec_id"))
    first = keyed.withColumn("place", place).where(F.col("place") <= top + 1)
    points = first.groupBy("same", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = written(points, "points")
    n = points.count()
    shards = max(1, -(-n // shard_rows))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("same", F.lit(3)), F.lit(shards)))
    names = pa.schema([("shard", pa.int64()), ("dim", pa.int64()), ("x", pa.binary()), ("ids", pa.binary()), ("cuts", pa.binary()), ("graph", pa.binary()), ("entry", pa.int64())])

    def run(key, group):
        out = {name: [] for name in names.names}
        rows = [np.asarray(v, np.float64) for v in group.column("v").to_pylist()]
        ids = group.column("ids").to_pylist()
        for dim in sorted({len(r) for r in rows}):
            some = [i for i, r in enumerate(rows) if len(r) == dim]
            x = np.array([rows[i] for i in some])
            graph, entry = build_graph(_longer(x))
            out["shard"].append(key[0].as_py())
            out["dim"].append(dim)
            out["x"].append(x.tobytes())
            out["ids"].append(np.concatenate([np.array(ids[i], np.int64) for i in some]).tobytes())
            out["cuts"].append(np.cumsum([0] + [len(ids[i]) for i in some]).astype(np.int64).tobytes())
            out["graph"].append(graph.astype(np.int32).tobytes())
            out["entry"].append(entry)
        return pa.Table.from_pydict(out, schema=names)

    # Few rows, much work: as many partitions as shards, whatever their bytes.
    index = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(run, "shard long, dim long, x binary, ids binary, cuts binary, graph binary, entry long")
    return written(index, "graph-shards")


def search(index: DataFrame, queries: DataFrame, top: int = TOP, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` nearest of those that the beams of all shards found.

    Queries (vec_id, v) travel in blocks; each block meets each shard once, as one row. Every shard gives at most ``top`` a
    query, so the last sort has ``top`` times the shards for each query. A query never finds its own id.
    """
    blocks = queries.withColumn("block", F.floor(F.col("vec_id") / F.lit(QUERY_BLOCK * EVERY)))
    n_blocks = F.size("v")
    packed = blocks.groupBy("block", n_blocks.alias("dim")).agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))
    # Each block is sent to each shard, and met there: the work is dealt out by shard.
    last = index.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    sent = packed.select("dim", "asked", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("shard"))
    met = index.join(sent.hint("merge"), ["shard", "dim"])
    names = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                dim = cols["dim"][i].as_py()
                x = np.frombuffer(cols["x"][i].as_buffer(), np.float64).reshape(-1, dim)
                ids = np.frombuffer(cols["ids"][i].as_buffer(), np.int64)
                cuts = np.frombuffer(cols["cuts"][i].as_buffer(), np.int64)
                graph = np.frombuffer(cols["graph"][i].as_buffer(), np.int32).reshape(len(x), -1)
                asked = cols["asked"][i].as_py()
                numbers = np.array([a["vec_id"] for a in asked], np.int64)
                vectors = np.array([a["v"] for a in asked], np.float64)
                flat = np.hstack([vectors, np.zeros((len(vectors), 1))]).astype(np.float32)
                longer = _longer(x)
                # Only the direction of a query counts; put where the points are, distances keep their precision.
                reach = np.sqrt((longer[0] * longer[0]).sum())
                flat *= reach / np.maximum(np.sqrt((flat * flat).sum(axis=1, keepdims=True)), 1e-30)
                found, _ = beam_search(longer, graph, cols["entry"][i].as_py(), flat, beam)
                q, slot = np.nonzero(found >= 0)
                point = found[q, slot]
                score = np.einsum("ij,ij->i", vectors[q], x[point])
                many = cuts[point + 1] - cuts[point]
                take = np.repeat(cuts[point] - np.cumsum(many) + many, many) + np.arange(many.sum())
                q, score, vec = np.repeat(q, many), np.repeat(score, many), ids[take]
                other = vec != numbers[q]
                q, score, vec = q[other], score[other], vec[other]
                order = np.lexsort((vec, -score, q))
                q, score, vec = q[order], score[order], vec[order]
                start = np.searchsorted(q, q)
                best = np.arange(len(q)) - start < top
                yield pa.RecordBatch.from_arrays([pa.array(numbers[q[best]]), pa.array(vec[best]), pa.array(score[best])], schema=names)

    found = met.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, every: int = EVERY) -> DataFrame:
    """The ``top`` rows of largest inner product for each row whose id is divisible by ``every``.

    Rows with a null id and vectors that are null, zero, or hold null or non-finite numbers take no part. Vectors meet only
    vectors of their own length. Rows that repeat an id and its vector count once; an id with several vectors is a candidate with each. A query id with several
    vectors is asked once, with the least of them. Fewer candidates than ``top`` are all given; an empty table
    gives no rows.
    """
    kept = written(usable(vectors, id_col, vector_col).distinct(), "vectors")  # a repeated row is one candidate
    queries = kept.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    return search(index_shards(kept, top), queries, top)
