"""Exact top-k search by no-random-access aggregation.

The score of a candidate is the sum over dimensions of query component times candidate component.  In
each dimension the candidates stand in a sorted list of (value, candidate), which a query reads from the top
where its component is positive and from the bottom where it is negative; a zero component's list isn't read.
Reading goes on in rounds, each DEEPER times as deep as the one before.  A candidate that was met has a
partial sum of what was read of it; what wasn't is at most the value where the list was left, and at least
the value at its other end, which bounds its score from both sides.  One that was never met is bounded by the
values where the lists were left.  When only FEW candidates have an upper bound that reaches the k-th largest
lower bound, and one never met has not, reading stops and the scores of those few are resolved.  Lists that
are read to their end give every score.  `search` can report the share of the entries that were read.

Rows are dealt into cells of about QUERIES x ROWS by hashes of the ids, as small whole numbers; each cell gives
its k best, and these are merged.  A row is copied queries / QUERIES times, a query rows / ROWS times.

Components become floor(64 x) with x as double.  Null vectors and those with a null or non-finite
component take no part.  Shorter vectors count as filled with zeros.  Equal scores go to the smaller
vec_id.  Rows with one vec_id are one vector (if they differ, the one that sorts last); a row with a
null vec_id takes no part.  Fewer than k candidates: all of them.  Scores beyond 64 bits raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curblake.llm.vectors import finite, matrix

K = 20
SCALE = 64
EVERY = 20
#: Rows of a cell.
QUERIES, ROWS = 8192, 8192
#: Part of the lists that the first round reads, factor between rounds, candidates that end the reading.
FIRST, DEEPER, FEW = 64, 4, 128

CELL = "query_id long, vec_id long, score long, read double"


class Lists:
    """The sorted lists of a cell's rows.  Whole numbers; exact below 2^53."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray) -> None:
        self.rows, self.ids = rows, ids
        self.order = np.argsort(rows.T, axis=1, kind="stable").astype(np.int32)  # dimension x place -> row
        self.values = np.take_along_axis(rows.T, self.order, axis=1)

    def candidates(self, q: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, float]:
        """Rows that hold the k best for ``q``, and the share of the entries read; ``own`` rows are left out."""
        n = len(self.ids)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        weights = np.concatenate((q[up], q[down]))
        floor = weights * np.concatenate((self.values[up, 0], self.values[down, -1]))
        depth = max(1, n // FIRST)
        while depth * DEEPER <= n and n > k + len(own):
            met = np.concatenate((self.order[up, n - depth :].ravel(), self.order[down, :depth].ravel()))
            read = np.concatenate((self.values[up, n - depth :], self.values[down, :depth])) * weights[:, None]
            left = weights * np.concatenate((self.values[up, n - depth], self.values[down, depth - 1]))
            known = np.bincount(met, read.ravel(), n)
            lower = known + floor.sum() - np.bincount(met, np.repeat(floor, depth), n)
            upper = known + left.sum() - np.bincount(met, np.repeat(left, depth), n)
            lower[own], upper[own] = -np.inf, -np.inf
            reached = np.partition(lower, n - k)[n - k]
            alive = np.flatnonzero(upper >= reached)  # one never met has the upper bound of the lists' places
            if len(alive) <= FEW:
                return alive, depth / n
            depth *= DEEPER
        return np.delete(np.arange(n), own), 1.0

    def best(self, q: np.ndarray, qid: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Ids and scores of the k best, and the share of the entries read."""
        at, read = self.candidates(q, np.flatnonzero(self.ids == qid), k)
        scores = self.rows @ q if read == 1.0 else self.rows[at] @ q
        scores = scores[at] if read == 1.0 else scores
        if len(at) > k:
            near = np.flatnonzero(scores >= np.partition(scores, len(at) - k)[len(at) - k])
            at, scores = at[near], scores[near]
        first = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at[first]], scores[first], read


def _distinct(table: pa.Table, key: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and rows, one row an id."""
    ids, rows = table[key].to_numpy(), matrix(table[vector])
    order = np.lexsort((*rows.T[::-1], ids)) if rows.shape[1] else np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    last = np.append(ids[1:] != ids[:-1], True) if len(ids) else np.empty(0, bool)
    return ids[last], rows[last]


def _cell(q: np.ndarray, qids: np.ndarray, v: np.ndarray, vids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    width = max(q.shape[1] if q.size else 0, v.shape[1] if v.size else 0)
    if not len(q) or not len(v):
        return
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, v))
    if width and float(np.abs(q).max()) * float(np.abs(v).max()) * width >= 2.0**53:
        q, v = q.astype(object), v.astype(object)  # whole numbers too large for doubles
        for i, row in zip(qids, q, strict=True):
            c, s = vids[vids != i], v[vids != i] @ row
            first = sorted(range(len(c)), key=lambda j: (-s[j], c[j]))[:k]  # noqa: B023
            yield i, c[first], s[first], 1.0
        return
    lists = Lists(v, vids)
    for i, row in zip(qids, q, strict=True):
        yield i, *lists.best(row, i, k)


def search(vectors: DataFrame, k: int = K, every: int = EVERY, report: bool = False) -> DataFrame:
    """query_id, rank, vec_id and score; queries: the rows whose vec_id is divisible by ``every``.

    With ``report`` also read: the largest share of a cell's list entries that the query's cells read.
    """
    whole = vectors.where(finite("embedding") & F.col("vec_id").isNotNull())
    whole = whole.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))
    n, m, most = whole.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    whole = whole.withColumn("v", F.col("v").cast("array<short>" if (most or 0) < 1 << 15 else "array<bigint>"))
    asked = whole.where(F.col("vec_id") % every == 0)
    across, down = max(1, -(-n // ROWS)), max(1, -(-m // QUERIES))
    deal = lambda parts, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")
    left = asked.select("vec_id", "v", deal(down, 1).alias("row"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("column"))
    right = whole.select(F.col("vec_id").alias("other_id"), F.col("v").alias("other"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("row"), deal(across, 2).alias("column"))

    def cell(queries: pa.Table, rows: pa.Table) -> pa.Table:
        both = queries.num_rows and rows.num_rows
        (qids, q), (vids, v) = (_distinct(queries, "vec_id", "v"), _distinct(rows, "other_id", "other")) if both else ((None, None), (None, None))
        found = list(_cell(q, qids, v, vids, k)) if both else []
        size = [len(c) for _, c, _, _ in found]
        return pa.table({
            "query_id": pa.array(np.repeat(np.array([f[0] for f in found], np.int64), size), pa.int64()),
            "vec_id": pa.array(np.concatenate([f[1] for f in found]) if found else [], pa.int64()),
            "score": pa.array(np.concatenate([f[2] for f in found]).astype(np.int64) if found else [], pa.int64()),
            "read": pa.array(np.repeat([float(f[3]) for f in found], size), pa.float64()),
        })

    found = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInArrow(cell, CELL)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    if report:
        best = best.join(found.groupBy("query_id").agg(F.max("read").alias("read")), "query_id")
    return best


SQL = f"""
WITH v AS (SELECT vec_id, max(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
