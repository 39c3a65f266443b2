"""Nearest neighbours by a block matrix join with int8 product tiles.

Every vector is quantised to int8 with a scale of its own; the norm of what the
quantisation loses is kept. A tile is the product of a block of queries with a
block of candidates. From the products of the quantised vectors and the lost
norms follow a lower and an upper bound of each distance; pairs whose lower bound
exceeds the k-th smallest upper bound can't be among the nearest. The others are
recomputed from the original vectors in double precision, and heaps keep the best
k of each query, first per task, then over all tasks. The result is exact.

Queries are taken in blocks of ``query_block`` vectors; a block is broadcast (its
size is fixed by that parameter) and met with all candidates in one pass.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither do rows without vec_id; vectors of another
length than the query's are no candidates; repeated vec_ids are candidates each, and
one query, that of the smallest vector in array order; ties go to the smaller vec_id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import broadcast


def usable(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("v")).filter(
        "vec_id is not null and v is not null"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(v, x -> x <> 0)")


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scale, norm of the loss) of each row."""
    x = x.astype("f8")
    scale = np.abs(x).max(1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    q = np.rint(x / scale[:, None]).astype("i1")
    return q, scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows; float32 holds them for up to 1,024 columns at a time."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1024):
        out += a[:, k:k + 1024].astype("f4") @ b[:, k:k + 1024].astype("f4").T
    return out


class Block:
    """A block of vectors with their quantised form."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.q, self.scale, self.lost = quantise(x)
        self.norm = np.sqrt((x.astype("f8") ** 2).sum(1))
        self.near = np.sqrt(((self.q * self.scale[:, None]) ** 2).sum(1))


def squared_bounds(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the squared distances of all pairs; the slack also covers rounding."""
    dot = product(a.q, b.q) * a.scale[:, None] * b.scale[None, :]
    error = a.lost[:, None] * b.norm[None, :] + a.near[:, None] * b.lost[None, :]
    total = a.norm[:, None] ** 2 + b.norm[None, :] ** 2
    slack = 2 * error + 1e-9 * total
    middle = total - 2 * dot
    return middle - slack, middle + slack


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to rows in double precision, components added in order."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j].astype("f8") - y[:, j].astype("f8")
        total += d * d
    return np.sqrt(total)


def blocks(ids: list[int], vectors: list, size: int) -> Iterator[Block]:
    """Blocks of vectors of equal length."""
    by_length: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by_length.setdefault(len(v), []).append(i)
    for rows in by_length.values():
        for lo in range(0, len(rows), size):
            some = rows[lo:lo + size]
            yield Block(np.array([ids[i] for i in some], "i8"), np.array([vectors[i] for i in some]))


def search(embeddings: DataFrame, k: int = 10, every: int = 100, query_block: int = 4096, tile: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest; queries are the ids divisible by ``every``."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    chosen = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n = 1 + chosen.count() // query_block
    parts = []
    for part in range(n):
        some = chosen if n == 1 else chosen.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == part)
        got = sorted({(r["vec_id"], tuple(r["v"])) for r in some.collect()})
        if got:
            kind = "f4" if dict(rows.dtypes)["v"] == "array<float>" else "f8"
            made = list(blocks([i for i, _ in got], [np.array(v, kind) for _, v in got], 512))
            parts.append(rows.mapInArrow(_nearest(broadcast(spark, made), k, tile), "query_id long, vec_id long, score double"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = parts[0]
    for other in parts[1:]:
        best = best.unionByName(other)

    def merge(table: pa.Table) -> pa.Table:
        top = heapq.nsmallest(k, zip(table["score"].to_pylist(), table["vec_id"].to_pylist()))
        return pa.table({"query_id": pa.array([table["query_id"][0].as_py()] * len(top), pa.int64()),
                         "rank": pa.array(range(1, len(top) + 1), pa.int32()),
                         "vec_id": pa.array([v for _, v in top], pa.int64()),
                         "score": pa.array([s for s, _ in top], pa.float64())})

    return best.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")


def _nearest(shared, k: int, tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[Block] = shared.value
        heaps: list[list[list[tuple]]] = [[[] for _ in q.ids] for q in queries]   # largest of the best k on top
        for b in batches:
            for c in blocks(b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False), tile):
                for q, heap in zip(queries, heaps):
                    if q.x.shape[1] == c.x.shape[1]:
                        _meet(q, c, heap, k)
        out = [(int(i), v, s) for q, heap in zip(queries, heaps) for i, h in zip(q.ids, heap)
               for s, v in ((-a, -b) for a, b in h)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([o[2] for o in out], pa.float64())], ["query_id", "vec_id", "score"])
    return run


def _meet(q: Block, c: Block, heap: list[list[tuple]], k: int) -> None:
    low, high = squared_bounds(q, c)
    own = q.ids[:, None] == c.ids[None, :]
    high[own] = np.inf
    limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] >= k else np.full(len(high), np.inf)
    known = np.array([h[0][0] ** 2 * (1 + 1e-9) if len(h) == k else np.inf for h in heap])
    limit = np.minimum(limit, known)
    a, b = np.nonzero((low <= limit[:, None]) & ~own)
    for lo in range(0, len(a), 1 << 17):
        aa, bb = a[lo:lo + (1 << 17)], b[lo:lo + (1 << 17)]
        d = distances(q.x[aa], c.x[bb])
        for i, s, v in zip(aa.tolist(), d.tolist(), c.ids[bb].tolist()):
            entry, h = (-s, -v), heap[i]
            if len(h) < k:
                heapq.heappush(h, entry)
            elif entry > h[0]:
                heapq.heapreplace(h, entry)
