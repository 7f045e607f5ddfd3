"""Op 5, exact top-k search by multi-resolution segment statistics.

A vector is cut into equal segments. Over one segment of length L the inner product is
at most L (mean_q mean_v + dev_q dev_v), with the population deviations, so the squared
distance |q|^2 + |v|^2 - 2 q.v is at least what those bounds leave. A candidate whose
bound is below a query's k-th best exact score so far can't enter its result. Bounds go
from coarse to fine segments; survivors get the exact integer inner product.

Queries go to the tasks in blocks of a fixed size; each block is one scan of the
candidates, whose tasks keep k rows a query. Only those rows shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import lean, materialize

SCHEMA = "query_id long, vec_id long, score long"
SEGMENTS = (4, 16)


def int_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id long, v array<long>): floor(scale * x) of each component as double.
    Vectors null or with null, NaN or infinite components are left out, as are null ids."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e * F.lit(scale)))
    return df.where(x.isNotNull() & ~bad & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def statistics(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means and deviations of each row's segments times the root of the length, so that
    the bound is one product; the segments' lengths differ by one at most."""
    edges = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).round().astype(int)
    lengths = np.diff(edges).astype(float)
    total = np.add.reduceat(v, edges[:-1], axis=1)
    squares = np.add.reduceat(v * v, edges[:-1], axis=1)
    mean = total / lengths
    dev = np.sqrt(np.maximum(squares / lengths - mean * mean, 0))
    return mean * np.sqrt(lengths), dev * np.sqrt(lengths), lengths


class Searcher:
    """The k best candidates of each query of one block, fed in batches."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.k = ids, k
        self.v = vectors.astype(float)
        self.levels = [statistics(self.v, s)[:2] for s in SEGMENTS] if self.v.shape[1] else []
        self.best_id = np.zeros((len(ids), k), np.int64)
        self.best = np.full((len(ids), k), -np.inf)
        self.exact = 0

    def feed(self, ids: np.ndarray, vectors: np.ndarray, rows: int = 2048) -> None:
        start, size = 0, 64
        while start < len(ids):  # a few first, for bounds to hold against
            self._feed(ids[start : start + size], vectors[start : start + size].astype(float))
            start, size = start + size, min(rows, 2 * size)

    def _feed(self, ids: np.ndarray, v: np.ndarray) -> None:
        least = self.best[:, -1]
        slack = 1e-6 * (1 + np.abs(least))
        alive = self.ids[:, None] != ids[None, :]
        for level, (mean, dev) in enumerate(self.levels):
            m, d, _ = statistics(v, SEGMENTS[level])
            if level == 0:
                bound = mean @ m.T
                bound += dev @ d.T
                alive &= bound + 1e-9 * np.abs(bound) >= (least - slack)[:, None]
                q, c = np.nonzero(alive)
            else:
                keep = np.empty(len(q), bool)
                for i in range(0, len(q), 1 << 15):
                    a, b = q[i : i + (1 << 15)], c[i : i + (1 << 15)]
                    bound = np.einsum("ij,ij->i", mean[a], m[b]) + np.einsum("ij,ij->i", dev[a], d[b])
                    keep[i : i + (1 << 15)] = bound + 1e-9 * np.abs(bound) >= (least - slack)[a]
                q, c = q[keep], c[keep]
        if not self.levels:
            q, c = np.nonzero(alive)
        self.exact += len(q)
        score = np.empty(len(q))
        for i in range(0, len(q), 1 << 15):
            a, b = q[i : i + (1 << 15)], c[i : i + (1 << 15)]
            score[i : i + (1 << 15)] = np.einsum("ij,ij->i", self.v[a], v[b])
        hit = score >= least[q]
        self._merge(q[hit], ids[c[hit]], score[hit])

    def _merge(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(q):
            return
        old_q, slot = np.nonzero(self.best > -np.inf)
        q = np.concatenate([old_q, q])
        ids = np.concatenate([self.best_id[old_q, slot], ids])
        score = np.concatenate([self.best[old_q, slot], score])
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        rank = np.arange(len(q)) - first[q]
        top = rank < self.k
        self.best[:] = -np.inf
        self.best[q[top], rank[top]] = score[top]
        self.best_id[q[top], rank[top]] = ids[top]

    def rows(self) -> pa.RecordBatch:
        q, slot = np.nonzero(self.best > -np.inf)
        columns = [self.ids[q], self.best_id[q, slot], self.best[q, slot].astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def _by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each length in a list column."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)[None, :]]


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its k candidates of another
    id with the largest integer inner products, ties to the smaller vec_id.

    Both sides are (vec_id, v) as int_vectors makes them; only vectors of a query's own
    length are its candidates (empty vectors score 0 together). Scores are exact while
    sums of products stay under 2**53. A repeated candidate row counts as a candidate of
    its own; of a query id's rows the smallest vector is taken. Empty tables give no rows."""
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    numbered = materialize(queries.withColumn("at", F.xxhash64("vec_id")), "queries")
    spark = candidates.sparkSession
    n = numbered.count()
    blocks = max(1, -(-n // block))
    found: DataFrame | None = None
    for b in range(blocks):  # a block holds about `block` queries, whatever their number
        part = numbered.where(F.pmod("at", F.lit(blocks)) == b).select("vec_id", "v").toArrow().combine_chunks()
        held = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            ids = held.value["vec_id"].to_numpy()
            lists = held.value["v"].combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
            by_length = {v.shape[1]: Searcher(ids[rows], v, k) for rows, v in _by_length(lists)} if len(ids) else {}
            for batch in batches:
                own = batch.column(0).to_numpy()
                for rows, v in _by_length(batch.column(1)):
                    if v.shape[1] in by_length:
                        by_length[v.shape[1]].feed(own[rows], v)
            for searcher in by_length.values():
                if (out := searcher.rows()).num_rows:
                    yield out

        top = candidates.mapInArrow(lean("topk", run), SCHEMA)
        ranked = top.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        ranked = ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if blocks > 1:
            ranked = materialize(ranked, "topk")
        found = ranked if found is None else found.unionByName(ranked)
    return found
