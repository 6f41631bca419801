"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into 1, 2, 4 and 8 segments; from the means and deviations of
the segments follows a lower bound of the distance of two vectors.  Vectors lie
sorted by cell, the nearest of guide vectors whose number grows with the table.
The queries are a stated set, the rows of every fiftieth id; blocks of them of
bounded size go to all executors, and each block passes over all vectors where
they lie.  A first pass searches each query's own cell and so bounds its k-th
distance.  A second pass skips, for a query, the runs of vectors whose envelope
of statistics is farther away than that; in the rest the bounds are applied
coarse to fine, and distances are computed for survivors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filigree.llm.common import stored

SEGMENTS = (1, 2, 4, 8)
#: Queries are the rows whose id this divides.
EVERY = 50
#: Most cells; below it there are as many as the square root of the vectors.
CELLS = 1024
#: Bytes of vectors of a block of queries.
QUERY_BYTES = 16_000_000
_SLICE = 256


def vector_rows(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id (bigint), v (array<double>) and d (dimensions), one row an id (of repeated ids the least vector); without null ids, vectors or values, and NaN."""
    rows = table.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v")).where("id is not null and size(v) > 0")
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("d", F.size("v"))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that their squared distance bounds the vectors'."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    scale = np.sqrt([len(p) for p in parts])
    means = np.stack([x[:, p].mean(axis=1) for p in parts], axis=1) * scale
    deviations = np.stack([x[:, p].std(axis=1) for p in parts], axis=1) * scale
    return np.hstack((means, deviations))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T)
    return np.maximum(out, 0, out=out)


def nearest(q_ids: np.ndarray, q: np.ndarray, limit: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance) of the up to k vectors of x within each query's limit, by (distance, id), without the query itself."""
    rows, ids, distances = [], [], []
    levels = [(statistics(q, s), statistics(x, s)) for s in SEGMENTS if s <= x.shape[1]]
    for at in range(0, len(q), _SLICE):
        top = (limit[at : at + _SLICE] ** 2)[:, None] * (1 + 1e-9) + 1e-9
        alive = np.ones((len(top), len(x)), dtype=bool)
        for a, b in levels:
            alive &= squared(a[at : at + _SLICE], b) <= top
            if not alive.any():
                break
        alive &= q_ids[at : at + _SLICE, None] != x_ids[None]
        columns = np.flatnonzero(alive.any(axis=0))
        if not len(columns):
            continue
        alive = alive[:, columns]
        d = np.where(alive, squared(q[at : at + _SLICE], x[columns]), np.inf)
        d[d > top] = np.inf
        few = min(k + 4, d.shape[1])
        part = np.argpartition(d, few - 1, axis=1)[:, :few] if few < d.shape[1] else np.broadcast_to(np.arange(few), (len(d), few))
        edge = np.take_along_axis(d, part, axis=1).max(axis=1)
        for i in range(len(d)):
            # all within rounding of the edge count, so that ties are decided by id
            mine = np.flatnonzero(d[i] <= edge[i] * (1 + 1e-9) + 1e-12) if np.isfinite(edge[i]) else np.flatnonzero(np.isfinite(d[i]))
            if len(mine):
                exact = np.sqrt(((x[columns[mine]] - q[at + i]) ** 2).sum(axis=1))
                best = np.lexsort((x_ids[columns[mine]], exact))[:k]
                rows.append(np.full(len(best), at + i))
                ids.append(x_ids[columns[mine[best]]])
                distances.append(exact[best])
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(ids), np.concatenate(distances)


def numbered(rows: DataFrame, most: int, least: int, root: float) -> dict[int, np.ndarray]:
    """For every number of dimensions the vectors of smallest hashed ids: root times the square root of its vectors, at least least and at most most."""
    wanted = {r["d"]: min(most, max(least, math.ceil(root * math.sqrt(r["count"])))) for r in rows.groupBy("d").count().collect()}
    if not wanted:
        return {}
    take = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])[F.col("d")]
    nth = F.row_number().over(Window.partitionBy("d").orderBy("h", "id"))
    ids = rows.select("id", "d", F.xxhash64("id").alias("h")).withColumn("n", nth).where(F.col("n") <= most).where(F.col("n") <= take).select("id")
    chosen = rows.join(F.broadcast(ids), "id").orderBy(F.xxhash64("id"), "id").collect()  # at most most rows a number of dimensions
    return {d: np.array([r["v"] for r in chosen if r["d"] == d]) for d in wanted}


def query_blocks(rows: DataFrame, every: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The queries (ids, vectors) by number of dimensions, in blocks of about QUERY_BYTES."""
    asked = rows.where(F.col("id") % every == 0)
    volume = asked.agg(F.sum("d")).head()[0] or 0
    blocks = max(1, math.ceil(8 * volume / QUERY_BYTES))
    for block in range(blocks if volume else 0):
        held = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).select("id", "d", "v").orderBy("id").collect()  # of bounded size
        yield {d: (np.array([r["id"] for r in held if r["d"] == d], dtype=np.int64), np.array([r["v"] for r in held if r["d"] == d])) for d in sorted({r["d"] for r in held})}


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Best:
    """The k nearest so far of each query, and the distance that the next ones have to reach."""

    def __init__(self, limit: np.ndarray, k: int) -> None:
        self.k, self.limit = k, limit.copy()
        self.distance = np.full((len(limit), k), np.inf)
        self.id = np.full((len(limit), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, ids: np.ndarray, distances: np.ndarray) -> None:
        """Rows ascend, with at most k of each."""
        if not len(rows):
            return
        touched, first, index = np.unique(rows, return_index=True, return_inverse=True)
        d, i = (np.full((len(touched), 2 * self.k), fill) for fill in (np.inf, np.iinfo(np.int64).max))
        d[:, : self.k], i[:, : self.k] = self.distance[touched], self.id[touched]
        place = self.k + np.arange(len(rows)) - first[index]
        d[index, place], i[index, place] = distances, ids
        order = np.lexsort((i, d), axis=1)[:, : self.k]
        self.distance[touched], self.id[touched] = np.take_along_axis(d, order, axis=1), np.take_along_axis(i, order, axis=1)
        self.limit[touched] = np.minimum(self.limit[touched], self.distance[touched, -1])

    def rows(self, q_ids: np.ndarray) -> pa.RecordBatch:
        q, n = np.nonzero(np.isfinite(self.distance))
        return pa.RecordBatch.from_arrays([pa.array(q_ids[q]), pa.array(self.id[q, n]), pa.array(self.distance[q, n])], names=["id", "neighbor", "distance"])


FOUND = "id long, neighbor long, distance double"


def top_k(table: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", every: int = EVERY) -> DataFrame:
    """vec_id, neighbor_id, rank and distance: the k nearest others of every vector whose id is divisible by every, ties by id.

    Only vectors of equal dimensions are compared, a query with all others;
    where there are fewer than k, fewer rows come, and none for a lone vector or
    from an empty table.  Null ids, null or empty vectors and vectors with null,
    NaN or infinite values take no part.  Rows of one id count once, with the
    least vector.  Ids are integers.
    """
    spark = table.sparkSession
    rows = stored(vector_rows(table, vec_id, embedding), "exact-vectors")
    guides = spark.sparkContext.broadcast(numbered(rows, CELLS, 1, 1.0))

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("d").to_numpy()
            home = np.zeros(len(sizes), dtype=np.int32)
            for d in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == d)
                home[mine] = squared(matrix(batch.column("v").take(pa.array(mine)), d), guides.value[d]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], names=["id", "v", "d", "cell"])

    celled = rows.mapInArrow(cell, "id long, v array<double>, d int, cell int")
    celled = stored(celled.repartitionByRange("d", "cell", F.xxhash64("id")).sortWithinPartitions("d", "cell"), "exact-cells")
    found = None
    for block in query_blocks(rows, every):
        homes = {d: squared(x, guides.value[d]).argmin(axis=1) for d, (_, x) in block.items()}
        near = _passed(celled, block, homes, {d: np.full(len(x), np.inf) for d, (_, x) in block.items()}, k, True)
        edge = {r["vec_id"]: r["distance"] for r in ranked(near, k, False).where(F.col("rank") == k).collect()}  # a row a query of the block
        limits = {d: np.array([edge.get(i, np.inf) for i in ids.tolist()]) for d, (ids, _) in block.items()}
        both = near.unionByName(_passed(celled, block, homes, limits, k, False))
        found = both if found is None else found.unionByName(both)
    return ranked(spark.createDataFrame([], FOUND) if found is None else found, k)


def _passed(celled: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray]], homes: dict[int, np.ndarray], limits: dict[int, np.ndarray], k: int, own: bool) -> DataFrame:
    """What the vectors of the queries' own cells, or of all others, have within the limits, stored."""
    held = celled.sparkSession.sparkContext.broadcast((block, homes, limits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, homes, limits = held.value
        best = {d: Best(limit, k) for d, limit in limits.items()}
        fine = {d: statistics(x, max(SEGMENTS)) for d, (_, x) in queries.items()}
        for batch in batches:
            sizes, cells = batch.column("d").to_numpy(), batch.column("cell").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (np.diff(sizes) != 0) | (np.diff(cells) != 0)))) if len(sizes) else []
            for a, b in zip(cuts, [*cuts[1:], len(sizes)]):
                d = int(sizes[a])
                if d not in queries:
                    continue
                q_ids, q = queries[d]
                alive = np.flatnonzero((homes[d] == cells[a]) == own)
                if not len(alive):
                    continue
                ids, x = batch.column("id").slice(a, b - a).to_numpy(), matrix(batch.column("v").slice(a, b - a), d)
                if not own:
                    z = statistics(x, max(SEGMENTS))
                    gap = np.maximum(np.maximum(z.min(axis=0) - fine[d][alive], fine[d][alive] - z.max(axis=0)), 0)
                    alive = alive[np.sqrt((gap * gap).sum(axis=1)) <= best[d].limit[alive] * (1 + 1e-9) + 1e-9]
                row, near, distance = nearest(q_ids[alive], q[alive], best[d].limit[alive], ids, x, k)
                best[d].add(alive[row], near, distance)
        for d, (q_ids, _) in queries.items():
            yield best[d].rows(q_ids)

    return stored(celled.select("id", "v", "d", "cell").mapInArrow(scan, FOUND), "exact-found")


def ranked(found: DataFrame, k: int, rounded: bool = True) -> DataFrame:
    """The k best of each id of rows (id, neighbor, distance)."""
    order = Window.partitionBy("id").orderBy("distance", "neighbor")
    distance = F.round("distance", 5) if rounded else F.col("distance")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(F.col("id").alias("vec_id"), F.col("neighbor").alias("neighbor_id"), "rank", distance.alias("distance"))


def top_k_sql(k: int = 10, every: int = EVERY) -> str:
    return f"""with v as (select vec_id, embedding::double[] as e from embeddings where vec_id is not null and len(embedding) > 0),
d as (select a.vec_id, b.vec_id as neighbor_id, list_distance(a.e, b.e) as x from v a join v b on a.vec_id <> b.vec_id where a.vec_id % {every} = 0)
select vec_id, neighbor_id, rank::int as rank, round(x, 5) as distance from (select *, row_number() over (partition by vec_id order by x, neighbor_id) as rank from d) where rank <= {k}"""
