"""Exact top-k by inner product with the threshold algorithm.

Vectors are cut into blocks. A block keeps, for every dimension, the order of its vectors by that
component. A query walks these lists from their best ends in parallel, scores what it meets, and
stops as soon as the best score that any unseen vector could still reach (the threshold: the query
times the list values at the current depth) is below the kth score it already holds.

Defined cases: a vector that is null, empty, or holds a null or non-finite component takes no part,
neither as query nor as candidate; queries meet candidates of their own length only; equal scores
go to the smaller id; repeated ids are separate candidates, but none meets a query of its own id; rows
with a null id take no part; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES = 4096
"""Vectors in a block of candidates."""
QUERIES = 2048
"""Vectors in a block of queries."""
DEPTHS = (4, 16, 64, 256, 1024)
"""List depths at which a query compares its kth score with the threshold."""

PACKED = "dims int, block long, ids binary, parts binary"
FOUND = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """True for a vector whose components are all finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def scaled(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0).cast("long"))


def _pack(rows: int):
    """Rows (dims, id, parts) sorted by dims to blocks of at most ``rows`` vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = TaskContext.get().partitionId() << 33
        held: dict[int, list] = {}

        def block(dims):
            nonlocal made
            parts = held.pop(dims)
            made += 1
            ids, values = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([made], pa.int64()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                ["dims", "block", "ids", "parts"],
            )

        for batch in batches:
            dims, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat = batch.column(2).flatten().to_numpy()
            ends = np.cumsum(dims)
            for size in np.unique(dims):
                mine = np.flatnonzero(dims == size)
                for at in range(0, len(mine), rows):
                    take = mine[at : at + rows]
                    values = flat[(ends[take] - size)[:, None] + np.arange(size)]
                    if sum(len(p[0]) for p in held.get(size, [])) + len(take) > rows:
                        yield block(size)
                    held.setdefault(size, []).append((ids[take], values))
        for size in list(held):
            yield block(size)

    return pack


def _best(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id."""
    if len(at) > k:
        close = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        at, scores = at[close], scores[close]
        first = np.lexsort((ids[at], -scores))[:k]
        at, scores = at[first], scores[first]
    return at, scores


def threshold_search(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query row, candidate row, score) of the k best of ``vectors`` for every query, exactly."""
    exact = np.abs(queries).max(initial=0).astype(float) * np.abs(vectors).max(initial=0) * vectors.shape[1] < 2**52
    kind = np.float64 if exact else np.int64
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    n = len(ids)
    up = np.argsort(vectors, axis=0, kind="stable")
    depths = [d for d in DEPTHS if d < n]
    at_depth = lambda d: (np.take_along_axis(vectors, up[x][None, :], 0)[0] for x in (n - d, d - 1))
    ends = [tuple(at_depth(d)) for d in depths]
    out, rest = [], []
    for row, query in enumerate(queries):
        rising, falling = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        kept, scores, before, stopped = np.empty(0, np.int64), np.empty(0, kind), 0, False
        for depth, (high, low) in zip(depths, ends):
            if depth * (len(rising) + len(falling)) > n:
                break  # the heads of the lists are as long as the block by now: all the rest is taken at once
            fresh = np.zeros(n, bool)
            fresh[up[n - depth : n - before, rising].ravel()] = True
            fresh[up[before:depth, falling].ravel()] = True
            met = np.flatnonzero(fresh & ~seen & (ids != own[row]))
            seen |= fresh
            before = depth
            kept, scores = _best(np.concatenate([kept, met]), np.concatenate([scores, vectors[met] @ query]), ids, k)
            bound = high[rising] @ query[rising] + low[falling] @ query[falling]
            if stopped := len(kept) == k and scores.min() > bound:
                break
        if stopped:
            out += [(row, c, int(s)) for c, s in zip(kept, scores)]
        else:
            rest.append(row)
    for start in range(0, len(rest), 256):
        rows = rest[start : start + 256]
        for row, scores in zip(rows, queries[rows] @ vectors.T):
            others = np.flatnonzero(ids != own[row])
            out += [(row, c, int(s)) for c, s in zip(*_best(others, scores[others], ids, k))]
    return out


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                vec = lambda name: np.frombuffer(cell[name], np.int64)
                dims, own, ids = cell["dims"], vec("own"), vec("ids")
                found = threshold_search(vec("asked").reshape(-1, dims), own, vec("parts").reshape(-1, dims), ids, k)
                if found:
                    rows, at, scores = (np.array(x, np.int64) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[rows]), pa.array(ids[at]), pa.array(scores)], ["query_id", "vec_id", "score"]
                    )

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query by integer inner product.

    Both sides are tables (vec_id, embedding). Every block of queries meets every block of candidates
    in a task of its own, which returns k rows a query; a window ranks what the blocks return.
    """

    def packed(df: DataFrame, rows: int) -> tuple[DataFrame, int]:
        vector = F.col("embedding")
        usable_rows = df.where(usable(vector) & F.col("vec_id").isNotNull())
        blocks = usable_rows.count() // rows + 1  # sizes the blocks, decides nothing else
        parts = usable_rows.select(
            F.size(vector).alias("dims"), F.col("vec_id").cast("long").alias("id"), scaled(vector).alias("parts")
        )
        return parts.repartition(blocks).mapInArrow(_pack(rows), PACKED), blocks

    asked, _ = packed(queries, QUERIES)
    candidates, n = packed(vectors, CANDIDATES)
    slot = F.pmod(F.xxhash64("block"), F.lit(n)).cast("int").alias("slot")
    every_slot = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("slot")
    asked = asked.select("dims", F.col("ids").alias("own"), F.col("parts").alias("asked"), every_slot)
    candidates = candidates.select("dims", "ids", "parts", slot)
    cells = candidates.repartition(n, "slot", "dims").join(asked.repartition(n, "slot", "dims"), ["slot", "dims"])
    found = cells.mapInArrow(_search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.select("query_id", F.row_number().over(best).cast("int").alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
