"""Exact top-k search by inner product: columnar branch and bound.

Candidates lie in vertical layout, one row per dimension. A task adds up the scores of
a tile of queries block of dimensions by block of dimensions. What the remaining
dimensions can still add is at most the product of the remaining lengths of the two
vectors; candidates that cannot reach the k-th best score found so far are out, and
once few are left they are compacted and finished alone. Queries are broadcast in
blocks of bounded size, every block against all candidates.

Components become floor(scale * x), and scores are exact: in double precision while
every partial sum stays below 2 ** 53, in whole numbers of any size beyond that.

Before the search, the queries of a block meet each other, which are candidates too: the
k-th best score a query finds there is its lower limit in every task from the start.

Defined cases: vectors that are null, hold a null or a number that is not finite, or
have no id take no part; a shorter vector counts as padded with zeros; every row is a
candidate of its own, also where rows share an id or are equal, and none meets a query of
its id; query rows that share an id are ranked together, so that equal ones list each
candidate as often as there are such rows; equal scores go by ascending vec_id; a
component beyond the largest double becomes that, a score beyond 64 bits the nearest
64-bit number; an empty table has no rows; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docstrata.llm.tables import Scratch, pick

K = 20
SCALE = 64
DIMENSIONS = 16
QUERY_BLOCK = 4096
TILE = 128
CANDIDATES = 4096
FEW = 0.25
_EXACT = float(1 << 53)
_LARGEST = np.finfo(np.float64).max


def matrix(vectors: pa.ListArray, scale: int) -> np.ndarray:
    """The whole numbers floor(scale * x) of each vector, as doubles, one vector per row."""
    sizes = np.diff(vectors.offsets.to_numpy())
    with np.errstate(over="ignore"):
        values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    out = np.zeros((len(vectors), sizes.max(initial=0)))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.clip(values, -_LARGEST, _LARGEST)
    return out


def _padded(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


class Queries:
    """A block of queries and the best candidates each has met so far; ``least`` holds
    scores that k candidates of each query are known to reach."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray | None = None):
        self.ids, self.k, self.matrix = ids, k, vectors
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf) if least is None else least.copy()

    def meet(self, ids: np.ndarray, vectors: np.ndarray, dimensions: int) -> None:
        width = max(self.matrix.shape[1], vectors.shape[1])
        queries = _padded(self.matrix, width)
        columns = np.ascontiguousarray(_padded(vectors, width).T)
        with np.errstate(over="ignore"):
            reach = np.sqrt((queries**2).sum(axis=1)).max(initial=0) * np.sqrt((columns**2).sum(axis=0)).max(initial=0)
        if not reach < _EXACT:
            self._meet_large(ids, queries, columns)
            return
        cuts = list(range(0, width, dimensions)) or [0]
        rest_q = np.stack([np.sqrt((queries[:, c + dimensions :] ** 2).sum(axis=1)) for c in cuts])
        rest_c = np.stack([np.sqrt((columns[c + dimensions :] ** 2).sum(axis=0)) for c in cuts])
        for low in range(0, len(self.ids), TILE):
            self._tile(slice(low, low + TILE), ids, queries, columns, cuts, dimensions, rest_q, rest_c)

    def _tile(self, tile, ids, queries, columns, cuts, dimensions, rest_q, rest_c) -> None:
        own = queries[tile]
        partial = np.zeros((len(own), columns.shape[1]))
        for n, c in enumerate(cuts):
            partial += own[:, c : c + dimensions] @ columns[c : c + dimensions]
            bound = partial + rest_q[n][tile][:, None] * rest_c[n] * (1 + 1e-9) + 1e-3
            alive = bound >= self.least[tile][:, None]
            if alive.mean() < FEW:
                break
        done = c + dimensions
        for row in range(len(own)):
            left = np.flatnonzero(alive[row])
            scores = partial[row, left]
            for n, c in enumerate(cuts):
                if c < done:
                    continue
                scores = scores + own[row, c : c + dimensions] @ columns[c : c + dimensions, left]
                bound = scores + rest_q[n][tile][row] * rest_c[n][left] * (1 + 1e-9) + 1e-3
                keep = bound >= self.least[tile][row]
                left, scores = left[keep], scores[keep]
            self._offer(tile.start + row, ids[left], scores)

    def _meet_large(self, ids: np.ndarray, queries: np.ndarray, columns: np.ndarray) -> None:
        whole = [[int(x) for x in column] for column in columns.T.tolist()]
        for row, query in enumerate(queries.tolist()):
            numbers = [int(x) for x in query]
            scores = [sum(a * b for a, b in zip(numbers, c, strict=True)) for c in whole]
            bounded = [max(-(1 << 63), min((1 << 63) - 1, s)) for s in scores]
            self._offer(row, ids, np.array(bounded, np.int64))

    def _offer(self, row: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Keeps the best k of what a query has and of what it is offered."""
        wanted = (ids != self.ids[row]) & (scores >= self.least[row])
        if not wanted.any():
            return
        ids = np.concatenate([self.best[row][0], ids[wanted]])
        scores = np.concatenate([self.best[row][1], scores[wanted].astype(np.int64)])
        if len(ids) > 4 * self.k:
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        order = np.lexsort((ids, ~scores))[: self.k]
        self.best[row] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[row] = max(self.least[row], _below(scores[order[-1]]))


def _below(score: np.int64) -> float:
    """A double that is not above the score."""
    return float(score) if abs(int(score)) < _EXACT else float(np.nextafter(float(score), -np.inf))


def _least_among(ids: np.ndarray, vectors: np.ndarray, k: int, dimensions: int) -> np.ndarray:
    """For each query a score that k of the queries of its block reach."""
    among = Queries(ids, vectors, k)
    for low in range(0, len(ids), CANDIDATES):
        among.meet(ids[low : low + CANDIDATES], vectors[low : low + CANDIDATES], dimensions)
    return among.least


def _search(block, k: int, scale: int, dimensions: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, times, least = block.value
        queries = Queries(ids, vectors, k, least)
        for batch in batches:
            for low in range(0, len(batch), CANDIDATES):
                part = batch.slice(low, CANDIDATES)
                queries.meet(part["vec_id"].to_numpy(), matrix(part["embedding"], scale), dimensions)
        for query, (found, scores), count in zip(ids, queries.best, times, strict=True):
            if len(found):
                columns = (np.full(len(found), query), found, scores)
                arrays = [pa.array(np.repeat(c, min(count, k))) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    return search


def usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = usable(vectors)
    queries = rows.where(is_query).groupBy("vec_id", "embedding").agg(F.count(F.lit(1)).alias("times"))
    queries = scratch.write(queries)
    blocks = max(1, -(-2 * queries.count() // query_block))
    blocks = 1 if blocks <= 2 else blocks
    met = None
    for number in range(blocks):
        place = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks).cast("long"))
        asked = queries.where(place == number).toArrow().sort_by("vec_id").combine_chunks()
        ids, times = asked["vec_id"].to_numpy(), asked["times"].to_numpy()
        own = matrix(pa.array(asked["embedding"].to_pylist(), pa.list_(pa.float64())), scale)
        block = spark.sparkContext.broadcast((ids, own, times, _least_among(ids, own, k, dimensions)))
        found = scratch.write(
            rows.mapInArrow(_search(block, k, scale, dimensions), "query_id bigint, vec_id bigint, score bigint")
        )
        met = found if met is None else met.unionByName(found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
