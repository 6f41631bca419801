"""Approximate nearest neighbours by a permutation index.

A vector is represented by its PREFIX nearest pivots in order of distance.  Each
pivot has an inverted file of the vectors that have it among these, with its
place in their order.  A query opens the files of its own pivots; from the
places follows the footrule distance of its order to that of every vector, and
the vectors are ranked by it.  Distances are computed only for the first of
them, SHARE of all vectors (the first LEAST, where that is more), and the k
nearest of these are the answer.

The pivots are a bounded sample, the vectors of smallest hashed ids, and grow
with the square root of the table up to PIVOTS, so that files stay short; every
vector is posted.  The index is cut by hashed id into shards of bounded size,
each with the inverted files of its own vectors, so that a file that a third of
all vectors share is spread evenly too.  Blocks of queries of bounded size go to
the shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import stored
from filigree.llm.exact_search import EVERY, FOUND, Best, matrix, numbered, query_blocks, ranked, squared, vector_rows

PIVOTS, FEWEST, PREFIX = 4096, 128, 64
SHARE, LEAST = 0.25, 1000
#: Bytes of vectors of one shard.
SHARD_BYTES = 4_000_000


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The prefix nearest pivots of each vector in order, ties by number."""
    parts = []
    for at in range(0, len(x), 1024):
        d = squared(x[at : at + 1024], pivots)
        if prefix < d.shape[1]:
            some = np.sort(np.argpartition(d, prefix - 1, axis=1)[:, :prefix], axis=1)
            near = np.take_along_axis(d, some, axis=1)
            order = np.take_along_axis(some, np.argsort(near, axis=1, kind="stable"), axis=1)
            tied = np.flatnonzero((d <= near.max(axis=1, keepdims=True)).sum(axis=1) > prefix)
            order[tied] = np.argsort(d[tied], axis=1, kind="stable")[:, :prefix]
        else:
            order = np.argsort(d, axis=1, kind="stable")
        parts.append(order)
    return np.concatenate(parts).astype(np.int32) if parts else np.zeros((0, min(prefix, len(pivots))), dtype=np.int32)


def inverted(order: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, vectors, places): the vectors of pivot p's file are vectors[offsets[p]:offsets[p + 1]], by number."""
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    return np.searchsorted(flat[by], np.arange(pivots + 1)), (by // order.shape[1]).astype(np.int32), (by % order.shape[1]).astype(np.uint8)


def footrule(query: np.ndarray, files: tuple[np.ndarray, np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """Footrule distance of a query's order to that of each of count vectors: the sum over its pivots of the difference of places.

    A pivot that a vector's order lacks has the place after the last.
    """
    offsets, vectors, places = files
    width = len(query)
    out = np.full(count, width * (width + 1) // 2, dtype=np.int32)
    gains = (width - np.arange(width)[:, None]) - np.abs(np.arange(width)[:, None] - np.arange(width))
    for gain, a, b in zip(gains.astype(np.int32), offsets[query].tolist(), offsets[query + 1].tolist()):
        out[vectors[a:b]] -= gain[places[a:b]]  # a file holds a vector once
    return out


def search(table: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """vec_id, neighbor_id, rank and distance: about the k nearest others of every vector whose id is divisible by every, ties by id.

    Which rows take part is as in exact_search.top_k, also for nulls, repeated
    ids and empty tables.  Vectors of each number of dimensions have pivots of
    their own.  Vectors of equal footrule distance are reranked together.  The
    result doesn't depend on partitions.
    """
    spark = table.sparkSession
    rows = stored(vector_rows(table, vec_id, embedding), "permutation-vectors")
    held = spark.sparkContext.broadcast(numbered(rows, pivots, FEWEST, 2.0))
    totals = {r["d"]: r["count"] for r in rows.groupBy("d").count().collect()}
    shards = max(1, math.ceil(8 * sum(d * n for d, n in totals.items()) / SHARD_BYTES))
    taken = {d: min(1.0, max(share, least / n)) for d, n in totals.items()}

    def build(part: pa.Table) -> pa.Table:
        part = part.sort_by("id").combine_chunks()
        d = part["d"][0].as_py()
        x = matrix(part["v"].chunk(0), d)
        order = permutations(x, held.value[d], prefix)
        offsets, vectors, places = inverted(order, len(held.value[d]))
        packed = [a.tobytes() for a in (part["id"].to_numpy(), x, offsets.astype(np.int64), vectors, places)]
        return pa.table({"d": pa.array([d], pa.int32()), **{n: pa.array([b], pa.binary()) for n, b in zip(("ids", "x", "offsets", "vectors", "places"), packed)}})

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    index = stored(sharded.groupBy("d", "shard").applyInArrow(build, "d int, ids binary, x binary, offsets binary, vectors binary, places binary"), "permutation-index")
    found = None
    for block in query_blocks(rows, every):
        near = _scanned(index, block, {d: permutations(q, held.value[d], prefix) for d, (_, q) in block.items()}, taken, k)
        found = near if found is None else found.unionByName(near)
    return ranked(spark.createDataFrame([], FOUND) if found is None else found, k)


def _scanned(index: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray]], orders: dict[int, np.ndarray], taken: dict[int, float], k: int) -> DataFrame:
    held = index.sparkSession.sparkContext.broadcast((block, orders))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, orders = held.value
        best = {d: Best(np.full(len(x), np.inf), k) for d, (_, x) in queries.items()}
        for batch in batches:
            for shard in range(batch.num_rows):
                d = batch.column("d")[shard].as_py()
                if d not in queries:
                    continue
                ids, x, *files = (np.frombuffer(batch.column(n)[shard].as_buffer(), dtype=t) for n, t in (("ids", np.int64), ("x", np.float64), ("offsets", np.int64), ("vectors", np.int32), ("places", np.uint8)))
                x = x.reshape(-1, d)
                few = math.ceil(taken[d] * len(ids))
                q_ids, q = queries[d]
                squares, found = (x * x).sum(axis=1), []
                for i in range(len(q_ids)):
                    rank = footrule(orders[d][i], files, len(ids))
                    mine = np.flatnonzero(rank <= np.partition(rank, few - 1)[few - 1])
                    mine = mine[ids[mine] != q_ids[i]]
                    near = squares[mine] - 2 * (x[mine] @ q[i])
                    if len(mine) > k:  # all within rounding of the edge count, so that ties are decided by id
                        edge = np.partition(near, k - 1)[k - 1] + (q[i] @ q[i])
                        mine = mine[near + (q[i] @ q[i]) <= edge + 1e-9 * (1 + edge + squares.max())]
                    distance = np.sqrt(((x[mine] - q[i]) ** 2).sum(axis=1))
                    order = np.lexsort((ids[mine], distance))[:k]
                    found.append((np.full(len(order), i), ids[mine[order]], distance[order]))
                best[d].add(*(np.concatenate(c) for c in zip(*found)))
        for d, (q_ids, _) in queries.items():
            yield best[d].rows(q_ids)

    return stored(index.mapInArrow(scan, FOUND), "permutation-found")
