"""Exact top-k by inner product with no-random-access aggregation.

Vectors are dealt once to blocks; a block keeps one sorted list per dimension.
Queries go to every block and stream past it in batches.  A batch reads the
lists in step, ``step`` entries of each at first and twice as deep every time:
from the high end for a positive weight, from the low end for a negative one.
What a list has not yet given is known only by the value reached, so after each
step every vector met has, for each query, a lower bound (what was read, the
list's worst value for the rest) and an upper bound (what was read, the value
reached for the rest).  A vector leaves a query when its upper bound lies under
the query's k-th lower bound.  A query stops on its own, when no vector it has
not met can qualify and at most ``max(k, step)`` of those met are left; only
their scores are then resolved.  At full depth all bounds are exact, so every
query stops.  ``read_lists`` also gives the depth each query came to.

Each vector is shuffled twice whatever the number of queries (once to collapse
equal rows, once to its block); a query is sent to every block, one for each
``VECTOR_VALUES`` components.  A task holds a block and a batch of queries.

Components become floor(scale * x) as whole numbers.  Scores are exact: where
dimension x largest component x largest weight stays below 2**53 they are
summed in float64, beyond that in int64, and bounds leave room for rounding.
Scores that a long cannot hold raise OverflowError.  No rows give no rows.

Vectors that are null, empty or hold null or non-finite components take no
part; a query meets the vectors of its own length only.  A row with a null id is
no query and no candidate.  A query's own row is every row with its id.  Of a
repeated query id's valid vectors the smallest counts.  Repeated rows are
separate candidates; they are counted before they are dealt, so many copies do
not fill a block.  Ties go to the smaller id.  Only the two named columns are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components in a block of vectors, queries read together, entries of a list read first.
VECTOR_VALUES, QUERY_BLOCK, STEP = 1 << 19, 256, 32


class Lists:
    """A block's vectors and, for each dimension, their positions in ascending
    order of the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        self.copies = np.ones(len(ids), np.int64) if copies is None else copies
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)


def read_lists(block: Lists, query_ids: np.ndarray, queries: np.ndarray, k: int,
               step: int = STEP) -> tuple[list[np.ndarray], np.ndarray]:
    """Positions of the vectors that may be among each query's best k, and the
    depth to which each query read the lists."""
    n, dims = block.vectors.shape
    count = len(queries)
    weights = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    limit = _limit(block.vectors, queries)
    slack = 0.0 if limit < 2.0 ** 53 else limit * dims * 2.0 ** -50
    # Columns: the lists from the high end, then from the low end.
    worst = np.concatenate([block.values[0], block.values[-1]])
    twice = np.tile(block.vectors, 2)
    seen = np.zeros((n, 2 * dims), bool)
    left = np.ones(n, bool)  # vectors that some query still holds
    alive = block.ids[None, :] != query_ids[:, None]
    floor = np.full(count, -np.inf)
    found: list[np.ndarray] = [np.empty(0, np.int64)] * count
    depths = np.zeros(count, np.int64)
    active, depth = np.arange(count), 0
    while len(active):
        upto = min(n, max(step, 2 * depth))
        np.put_along_axis(seen[:, :dims], block.order[n - upto:n - depth], True, axis=0)
        np.put_along_axis(seen[:, dims:], block.order[depth:upto], True, axis=0)
        depth = upto
        reached = np.concatenate([block.values[n - depth], block.values[depth - 1]])
        w = weights[active]
        met = seen.any(axis=1)
        rows = np.flatnonzero(met & left)
        read, v = seen[rows], twice[rows]
        cells = np.ix_(active, rows)
        mine = alive[cells]
        upper = w @ np.where(read, v, reached).T
        lower = w @ np.where(read, v, worst).T
        lower[~mine] = -np.inf
        if len(rows) >= k:
            floor[active] = np.maximum(floor[active], np.partition(lower, len(rows) - k, axis=1)[:, len(rows) - k])
        bound = floor[active] - slack
        keep = mine & (upper >= bound[:, None])
        alive[cells] = keep
        closed = met.all() | (w @ reached < bound)
        done = (closed & (keep.sum(axis=1) <= max(k, step))) | (depth == n)
        for j in np.flatnonzero(done):
            found[active[j]] = rows[keep[j]]
            depths[active[j]] = depth
        left[rows] = keep[~done].any(axis=0)
        active = active[~done]
    return found, depths


def _limit(vectors: np.ndarray, queries: np.ndarray) -> float:
    """No score, and no part of one, is larger."""
    return vectors.shape[1] * float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0))


def block_topk(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, vector position, score) of every query's best k
    candidates in the block, ties to the smaller id."""
    return _topk(Lists(ids, vectors), query_ids, queries, k)


def _topk(block: Lists, query_ids: np.ndarray, queries: np.ndarray, k: int,
          step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    limit = _limit(block.vectors, queries)
    if limit >= 2.0 ** 63:
        raise OverflowError("scores do not fit a long")
    kind = np.float64 if limit < 2.0 ** 53 else np.int64
    found, _ = read_lists(block, query_ids, queries, k, step)
    at, scores = [], []
    for q, rows in enumerate(found):
        score = (block.vectors[rows].astype(kind) @ queries[q].astype(kind)).astype(np.int64)
        best = np.lexsort((block.ids[rows], -score))[:k]
        at.append(rows[best])
        scores.append(score[best])
    return (np.repeat(np.arange(len(queries)), [len(x) for x in at]), np.concatenate(at, dtype=np.int64),
            np.concatenate(scores, dtype=np.int64))


def whole(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad, F.transform(
        vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, vector_block: int | None = None, query_block: int = QUERY_BLOCK,
          step: int = STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row
    of ``queries``.  ``vector_block`` rows make a block; by default a block
    holds ``VECTOR_VALUES`` components."""
    def ready(df: DataFrame) -> DataFrame:
        return (df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), whole(vector_col, scale).alias("v"))
                .where("v is not null").withColumn("dim", F.size("v")))

    vectors = ready(vectors)
    rows, values = vectors.agg(F.count("*"), F.sum(F.col("dim").cast("long"))).first()
    blocks = max(1, math.ceil(rows / vector_block if vector_block else (values or 0) / VECTOR_VALUES))
    left = (vectors.groupBy("dim", "id", "v").agg(F.count("*").alias("copies"))
            .select("dim", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("vb"), F.lit(0).alias("kind"), "id", "v", "copies"))
    right = (ready(queries).groupBy("id").agg(F.min("v").alias("v"))
             .select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("vb"),
                     F.lit(1).alias("kind"), "id", "v", F.lit(1).cast("long").alias("copies")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "vb", "kind")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                dim, vb, kind = (int(x) for x in marks[:, a])
                if (dim, vb) != key:
                    key, parts, block = (dim, vb), [], None
                part = batch.slice(a, b - a)
                ids = part.column("id").to_numpy()
                v = part.column("v").flatten().to_numpy().reshape(b - a, dim)
                if kind == 0:
                    parts.append((ids, v, part.column("copies").to_numpy()))
                    continue
                if parts:
                    block, parts = Lists(*(np.concatenate(x) for x in zip(*parts))), []
                for s in range(0, b - a if block is not None else 0, query_block):
                    names = ids[s:s + query_block]
                    q, at, score = _topk(block, names, v[s:s + query_block], k, step)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (names[q], block.ids[at], score, np.minimum(block.copies[at], k))],
                        ["query_id", "vec_id", "score", "copies"])

    # A block's vectors come first, then its queries.
    found = (left.unionByName(right).where("dim > 0").repartition("dim", "vb").sortWithinPartitions("dim", "vb", "kind")
             .mapInArrow(run, "query_id long, vec_id long, score long, copies long"))
    found = found.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
