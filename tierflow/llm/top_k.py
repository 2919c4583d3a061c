"""Exact top-k inner products: a dense product, pruned by the bounds of sorted lists.

A shard holds its vectors and, per dimension, its sorted components without ids. For
a query all products of components are formed first. At some depths of the lists,
from half on, a component that scores at least its list's frontier counts as known,
any other as between the list's worst entry and the frontier; vectors whose upper
bound is below the k-th lower bound are dropped. The others are resolved exactly by
their whole vectors and ranked. This is not no-random-access aggregation: no list is
read entry by entry, and nothing is saved against the plain product. Shards answer for themselves and their answers, k per
query, are merged. Queries go to the tasks in blocks of bounded size, one pass each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.storage import written

K = 10
SCALE = 1024
SHARD_ROWS = 8192
# Components of the queries that one pass broadcasts.
QUERY_BLOCK = 1 << 21
# Bounds are compared at these parts of a list's length, from the middle on: before it
# the parts beyond the frontier leave everything open.
BLOCKS = 8


def scaled(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x): floor(scale * component) of every vector without null or non-finite components."""
    v = F.col(vector_col)
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    known = df.where(F.col(id_col).isNotNull() & v.isNotNull() & whole)
    return known.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of lists as a matrix; shorter ones are filled with zeros."""
    sizes = np.asarray(pa.compute.list_value_length(col))
    flat = col.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(col)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Shard:
    """Vectors of a shard and, for each dimension, its list: the components in order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.parts = ids, x, x.astype(float)
        self.lists = np.sort(self.parts, axis=0)

    def top(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the k best vectors but the query's own, best first, ties to smaller ids.

        At some depth of a list every component that scores at least its frontier
        counts as known, all others lie between the list's worst entry and the frontier.
        """
        n, weight = len(self.ids), q.astype(float)
        ahead = weight > 0
        worst = weight * np.where(ahead, self.lists[0], self.lists[-1])
        best = weight * np.where(ahead, self.lists[-1], self.lists[0])
        # Sums of doubles are exact below 2**53; beyond it bounds get room for rounding.
        total = float(np.maximum(np.abs(worst), np.abs(best)).sum())
        slack = 0.0 if total < 2.0**52 else total * 1e-12
        rest = np.flatnonzero(self.ids != own)
        gain = self.parts[rest] * weight
        for depth in (n * part // BLOCKS for part in range(BLOCKS // 2, BLOCKS)):
            if len(rest) <= 4 * k or depth < 1:
                break
            frontier = weight * np.where(ahead, self.lists[n - depth], self.lists[depth - 1])
            upper = np.maximum(gain, frontier).sum(axis=1) + slack
            # No lower bound is above the upper one: only vectors with good upper bounds set the bar.
            most = np.argpartition(upper, len(rest) - 4 * k)[len(rest) - 4 * k :]
            lower = np.where(gain[most] >= frontier, gain[most], worst).sum(axis=1) - slack
            bar = np.partition(lower, len(lower) - k)[len(lower) - k]
            stay = upper >= bar  # outsiders cannot qualify any more
            rest, gain = rest[stay], gain[stay]
        score = self.x[rest] @ q
        order = np.lexsort((self.ids[rest], -score))[:k]
        return rest[order], score[order]


def _search(batches, ids: np.ndarray, queries: np.ndarray, k: int):
    def answer(rows: list):
        x = _matrix(pa.concat_arrays([r[1] for r in rows]), queries.shape[1])
        shard = Shard(np.concatenate([r[0] for r in rows]), x)
        q = np.pad(queries, ((0, 0), (0, x.shape[1] - queries.shape[1])))
        found = [shard.top(own, v, k) for own, v in zip(ids.tolist(), q, strict=True)]
        n = np.array([len(r) for r, _ in found])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, n)), pa.array(shard.ids[np.concatenate([r for r, _ in found])]), pa.array(np.concatenate([s for _, s in found]))],
            ["query_id", "vec_id", "score"],
        )

    held: list = []
    for batch in batches:
        for at in range(0, batch.num_rows, SHARD_ROWS):
            part = batch.slice(at, SHARD_ROWS)
            held.append((part.column(0).to_numpy(zero_copy_only=False), part.column(1)))
            if sum(len(r[0]) for r in held) >= SHARD_ROWS:
                yield answer(held)
                held = []
    if held:
        yield answer(held)


def _blocks(queries: DataFrame, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries in blocks; the driver holds one block at a time."""
    held, size = [], 0
    for row in queries.toLocalIterator():
        if held and size + len(row.x) > most:
            yield _block(held)
            held, size = [], 0
        held.append(row)
        size += len(row.x)
    if held:
        yield _block(held)


def _block(rows: list) -> tuple[np.ndarray, np.ndarray]:
    q = np.zeros((len(rows), max(len(r.x) for r in rows)), np.int64)
    for i, r in enumerate(rows):
        q[i, : len(r.x)] = r.x
    return np.array([r.id for r in rows], np.int64), q


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of `vectors` for each of `queries`.

    Both are (id, x) as `scaled` makes them. A query's own id is no candidate; ties
    go to the smaller id; a query with fewer candidates returns all of them, one
    without any returns no row. Repeated rows are candidates each, and repeated
    queries are asked once. Vectors of different lengths meet as if filled with zeros.
    """
    rows = vectors.count()
    shards = max(1, -(-rows // SHARD_ROWS))
    dealt = vectors.repartition(shards, F.xxhash64("id", "x"))
    sc = vectors.sparkSession.sparkContext
    parts = []
    for ids, q in _blocks(queries.dropDuplicates(["id"]), query_block):
        sent = sc.broadcast((ids, q))
        parts.append(written(dealt.mapInArrow(lambda it, sent=sent: _search(it, *sent.value, k), "query_id long, vec_id long, score long"), "answers"))
    if not parts:
        return vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
