"""Scoring channels and top-k: BM25, cosine, MaxSim, and fusion of ranked lists."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import SourceError
from tessera.functions.analysis import analyzer_of
from tessera.functions.text import tokens
from tessera.operators.scratch import kept, small_batches

#: BM25 saturation, length weight and constant mean length.
BM25_K, BM25_B, BM25_MEAN = 1.2, 0.75, 256.0
#: RRF constant and channel weights.
RRF_K = 60
RRF_WEIGHTS = {"label": 1.0, "semantic": 2.0, "lexical": 1.0}
#: Rows of two short columns that are broadcast at most.
MOST_BROADCAST = 200_000


def sized(df: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """df, marked for broadcast if it has at most `most` rows; beyond that Spark shuffles
    it and splits hot keys itself."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def term_counts(points: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """id, term, tf, dl (tokens of the point). Counting is within the row: no shuffle."""
    words = points.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("t"))
    rows = words.select("id", F.size("t").alias("dl"), F.explode("t").alias("term"))
    return rows.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def document_counts(points: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """term, df: the ids whose texts have the term; rows that repeat an id (null: one id)
    count once.

    A text's distinct terms are counted where it lies, so that partial counts alone shuffle;
    only the terms of repeated ids meet by id."""
    rows = points.select(F.col(id_col).alias("id"), F.array_distinct(tokens(F.col(text_col))).alias("t"))
    ids = points.select(F.col(id_col).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    again = kept(ids.where("n > 1").select(F.col("id").alias("other")))
    if again.isEmpty():
        return rows.select(F.explode("t").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    again, same = sized(again), F.col("id").eqNullSafe(F.col("other"))
    once = rows.join(again, same, "left_anti").select(F.explode("t").alias("term"))
    more = rows.join(again, same, "left_semi").select("id", F.explode("t").alias("term")).distinct().select("term")
    return once.unionByName(more).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def bm25_weight(tf: Column, dl: Column, k: float = BM25_K, b: float = BM25_B, mean: float = BM25_MEAN) -> Column:
    return tf * (k + 1) / (tf + k * (1 - b + b * dl / mean))


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def query_terms(queries: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """qid, qn (distinct terms), term: binary weights, so distinct terms."""
    words = queries.select(F.col(id_col).alias("qid"), F.array_distinct(tokens(F.col(text_col))).alias("t"))
    return words.select("qid", F.size("t").alias("qn"), F.explode("t").alias("term"))


def rounded(x: np.ndarray) -> np.ndarray:
    """To six digits, halves away from zero as SQL does."""
    return np.copysign(np.floor(np.abs(x) * 1e6 + 0.5) / 1e6, x)


class Best:
    """The k best entries of each group met so far: scores down, of equal ones the least
    id. Groups are numbered from 0. Memory: k entries a group and `most` besides."""

    def __init__(self, groups: int, k: int, most: int = 1 << 20) -> None:
        self.k, self.most = k, most
        self.least = np.full(groups, -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, group: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = ~(scores < self.least[group])
        self.parts.append((group[good], ids[good], scores[good]))
        self.n += int(good.sum())
        if self.n > self.most:
            self.parts = [self.take()]
            self.n = len(self.parts[0][0])
            self.most = max(self.most, 2 * self.n)

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """group, ids and scores of the best, by group and rank."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        group, ids, scores = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((ids, -scores, group))
        group, ids, scores = group[order], ids[order], scores[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        last = place == self.k - 1
        self.least[group[last]] = scores[last]
        few = place < self.k
        return group[few], ids[few], scores[few]


#: Pairs of points and queries, and postings, that a task holds at once.
MOST_CELLS = 1 << 20
#: Terms of queries that tasks look for at most; with more, they keep all terms.
MOST_TERMS = 200_000
KINDS = ("lexical", "semantic", "label")


def term_rows(points: DataFrame, id_col: str, text_col: str, wanted: frozenset[str] | None, analyzer: str) -> DataFrame:
    """id, dl (terms of the point), dt (distinct ones), and terms and tfs of those in
    `wanted` (None: of all); points without any are left out. One pass, no shuffle."""
    held = points.sparkSession.sparkContext.broadcast(wanted)
    analyze = analyzer_of(analyzer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = held.value
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(analyze(text))
                terms = list(found) if some is None else [t for t in found if t in some]
                if terms:
                    out.append((key, found.total(), len(found), terms, [found[t] for t in terms]))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["id", "dl", "dt", "terms", "tfs"])

    rows = points.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, dl long, dt long, terms array<string>, tfs array<long>")


def _flat(lists: Sequence[Sequence], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Items of all lists in a row, and where each list begins (with the end)."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.array([y for x in lists for y in x], kind), ends


class QueryBlock:
    """A block of queries as postings: for each term the queries that ask for it."""

    def __init__(self, ids: Sequence[int], terms: Sequence[Sequence[str]]) -> None:
        self.ids = np.array(ids, np.int64)
        self.sizes = np.array([len(t) for t in terms], float)
        asked: dict[str, list[int]] = {}
        for i, own in enumerate(terms):
            for t in own:
                asked.setdefault(t, []).append(i)
        self.number = {t: i for i, t in enumerate(asked)}
        self.queries, self.ends = _flat(list(asked.values()), np.int64)
        self.idf = np.zeros(len(asked))

    def scores(self, rows: pa.RecordBatch, kinds: Sequence[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Channel number, query numbers, ids and scores of the pairs with a common term."""
        n_rows, n = rows.num_rows, len(self.ids)
        term = [[(self.number[t], k) for t, k in zip(ts, ks, strict=True) if t in self.number] for ts, ks in zip(rows.column(3).to_pylist(), rows.column(4).to_pylist(), strict=True)]
        flat, ends = _flat(term, np.int64)
        if not len(flat):
            return
        row = np.repeat(np.arange(n_rows), np.diff(ends))
        dl, dt = (rows.column(i).to_numpy().astype(float) for i in (1, 2))
        t, tf = flat[:, 0], flat[:, 1].astype(float)
        weight = self.idf[t] * tf * (BM25_K + 1) / (tf + BM25_K * (1 - BM25_B + BM25_B * dl[row] / BM25_MEAN))
        times = self.ends[t + 1] - self.ends[t]
        bm25, shared = np.zeros(n_rows * n), np.zeros(n_rows * n)
        # Postings are met in pieces: a common term has one for each query that asks for it.
        edges = np.flatnonzero(np.diff(np.cumsum(times) // MOST_CELLS)) + 1
        for a, b in pairwise([0, *edges.tolist(), len(t)]):
            own = times[a:b]
            which = np.repeat(np.arange(a, b), own)
            first = np.repeat(self.ends[t[a:b]] - np.cumsum(own) + own, own)
            cell = row[which] * n + self.queries[first + np.arange(len(which))]
            np.add.at(bm25, cell, weight[which])
            np.add.at(shared, cell, 1.0)
        at = np.flatnonzero(shared)
        bm25, shared, q, d = bm25[at], shared[at], at % n, at // n
        ids, qn, dt = rows.column(0).to_numpy()[d], self.sizes[q], dt[d]
        of = {"lexical": lambda: bm25, "semantic": lambda: shared / np.sqrt(qn * dt), "label": lambda: shared / (qn + dt - shared)}
        for c, kind in enumerate(kinds):
            yield c, q, ids, rounded(of[kind]())


def lexical_hits(queries: DataFrame, qid: str, points: DataFrame, pid: str, k: int = 100, kinds: Sequence[str] = KINDS, *, query_text: str = "text", text: str = "text", analyzer: str = "plain", block: int = 4096, strict: bool = False) -> DataFrame:
    """qid, id, channel, rank, score: the k best points of each query and channel, of those
    with a common term: lexical (BM25), semantic (cosine of binary term vectors) and label
    (Jaccard); ties go by id.

    Points are analyzed once; queries go out in blocks as postings, a task scores its points
    and keeps its k best a query and channel, so only those shuffle: pairs never do. strict:
    a query without terms is an error. Rows that repeat a point's id count each."""
    spark, analyze = points.sparkSession, analyzer_of(analyzer)
    small_batches(points)
    own = queries.select(F.col(qid).cast("long").alias("id"), F.col(query_text).alias("t"))
    parts = max(1, -(-own.count() // block))

    def asked(p: int) -> tuple[list[int], list[list[str]]]:
        rows = own.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == p).toArrow()  # block rows or so
        terms = [list(dict.fromkeys(analyze(t))) for t in rows["t"].to_pylist()]
        if strict and [] in terms:
            raise SourceError(f"query {rows['id'][terms.index([])].as_py()} has no terms")
        return rows["id"].to_pylist(), terms

    wanted: set[str] | None = set()
    for p in range(parts):
        wanted.update(t for ts in asked(p)[1] for t in ts)
        if len(wanted) > MOST_TERMS:
            wanted = None
            break
    rows = kept(term_rows(points, pid, text, None if wanted is None else frozenset(wanted), analyzer))
    n = points.count()
    named = rows.select(F.explode("terms").alias("term"))
    found = None
    for p in range(parts):
        made = QueryBlock(*asked(p))
        terms = list(made.number)
        few = spark.createDataFrame(pa.table({"term": pa.array(terms, pa.string())}))
        # As many rows as the block has terms.
        met = named.join(F.broadcast(few), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
        for r in met:
            made.idf[made.number[r.term]] = np.log(1 + (n - r.df + 0.5) / (r.df + 0.5))
        held = spark.sparkContext.broadcast(made)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            made = held.value
            best = Best(len(kinds) * len(made.ids), k, 1 << 18)
            size = max(1, min(512, MOST_CELLS // max(1, len(made.ids))))
            for batch in batches:
                for i in range(0, batch.num_rows, size):
                    for c, q, ids, score in made.scores(batch.slice(i, size), kinds):
                        best.add(q * len(kinds) + c, ids, score)
            group, ids, score = best.take()
            channel = pa.array([kinds[c] for c in group % len(kinds)], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(made.ids[group // len(kinds)]), pa.array(ids), channel, pa.array(score)], ["qid", "id", "channel", "score"])

        part = rows.mapInArrow(run, "qid long, id long, channel string, score double")
        order = Window.partitionBy("qid", "channel").orderBy(F.desc("score"), "id")
        part = part.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)
        found = part if found is None else found.unionByName(part)
    return found.select("qid", "id", "channel", "rank", "score")


def top_k(scores: DataFrame, k: int, group: str = "qid", score: str = "score", tie: str = "id") -> DataFrame:
    """The k best rows of each group with their rank from 1; scores are rounded first, so
    equal ones go by id."""
    rows = scores.withColumn(score, F.round(score, 6))
    order = Window.partitionBy(group).orderBy(F.desc(score), tie)
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def rrf(hits: DataFrame, weights: Mapping[str, float] = RRF_WEIGHTS, k: int = RRF_K, top: int = 100) -> DataFrame:
    """Weighted reciprocal rank fusion: qid, rank, id, fused, and each channel's rank and
    score (null where it has none).

    Order: fused down, then the semantic, label and lexical ranks (none: last), then id."""
    wide = hits.groupBy("qid", "id").agg(
        *[F.max(F.when(F.col("channel") == c, F.col(x))).alias(f"{c}_{x}") for c in weights for x in ("rank", "score")]
    )
    terms = [F.coalesce(F.lit(float(w)) / (F.lit(float(k)) + F.col(f"{c}_rank")), F.lit(0.0)) for c, w in weights.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    wide = wide.withColumn("fused", F.round(total, 6))
    ties = [F.asc_nulls_last(f"{c}_rank") for c in ("semantic", "label", "lexical") if c in weights]
    order = Window.partitionBy("qid").orderBy(F.desc("fused"), *ties, "id")
    return wide.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


# ------------------------------------------------------------------ dense vectors


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of at most `size` queries (id, vec), one after the other on the driver."""
    n = queries.count()
    parts = max(1, -(-n // size))
    for p in range(parts):
        block = queries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == p).toArrow()
        if block.num_rows:
            yield block["id"].to_numpy(), np.array(block["vec"].to_pylist(), float)


def unit_rows(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1.0)


def _slices(batches: Iterator[pa.RecordBatch], queries: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors of (id, vec), so few at once that their scores against the
    queries are MOST_CELLS at most."""
    size = max(1, MOST_CELLS // queries)
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            ids, vectors = batch.slice(i, size).columns
            flat = vectors.flatten()
            if vectors.null_count + flat.null_count == 0 and len(set(vectors.value_lengths().to_pylist())) == 1:
                rows = flat.to_numpy().astype(float).reshape(len(vectors), -1)
            else:
                rows = np.array(vectors.to_pylist(), float)
            yield ids.to_numpy(), unit_rows(rows)


def _worth(score: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the scores that once rounded may be among the k best of their
    row. least: what the k best so far have at least."""
    least = least - 1e-6
    if score.shape[1] > k and np.isneginf(least).any():
        least = np.maximum(least, np.partition(score, -k, axis=1)[:, -k] - 1e-6)
    return np.nonzero(~(score < least[:, None]))


def cosine_top_k(queries: DataFrame, points: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """qid, rank, id, score: the k points (id, vec) of another id with the largest cosine.

    Queries go out in blocks; a task multiplies its points by the block, slice by slice, and
    keeps its k best a query, so only those rows shuffle."""
    spark = points.sparkSession
    found = None
    for ids, vectors in _blocks(queries, block):
        held = spark.sparkContext.broadcast((ids, unit_rows(vectors)))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            qid, q = held.value
            best = Best(len(qid), k, 1 << 18)
            for own, vectors in _slices(batches, len(qid)):
                score = q @ vectors.T
                a, b = _worth(score, best.least, k + 1)  # a query's own row may be one of them
                other = (qid[a] != own[b]) & ~np.isnan(score[a, b])
                a, b = a[other], b[other]
                best.add(a, own[b], rounded(score[a, b]))
            a, ids, score = best.take()
            yield pa.RecordBatch.from_arrays([pa.array(qid[a]), pa.array(ids), pa.array(score)], ["qid", "id", "score"])

        part = top_k(points.select("id", "vec").mapInArrow(run, "qid long, id long, score double"), k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "qid long, id long, score double, rank long")
    return found.select("qid", "rank", "id", "score")


class BestRecords(Best):
    """The k best ids of each group, of an id's entries the best alone."""

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.parts:
            group, ids, scores = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            order = np.lexsort((-scores, ids, group))
            group, ids, scores = group[order], ids[order], scores[order]
            first = np.append(True, (group[1:] != group[:-1]) | (ids[1:] != ids[:-1]))[: len(group)]
            self.parts = [(group[first], ids[first], scores[first])]
        return super().take()


def maxsim(queries: DataFrame, variants: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """qid, rank, id, score: the k records with the largest cosine of a query and one of
    their variants (record, vec).

    A task takes the maximum over the variants that it has of a record, slice by slice, and
    keeps its k best records a query: a record among the k best of all is among those of the
    task with its best variant."""
    spark = variants.sparkSession
    found = None
    for ids, vectors in _blocks(queries, block):
        held = spark.sparkContext.broadcast((ids, unit_rows(vectors)))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            qid, q = held.value
            best = BestRecords(len(qid), k, 1 << 18)
            for records, vectors in _slices(batches, len(qid)):
                order = np.argsort(records, kind="stable")
                some, first = np.unique(records[order], return_index=True)
                score = np.maximum.reduceat(q @ vectors[order].T, first, axis=1)
                a, b = _worth(score, best.least, k)
                best.add(a, some[b], rounded(score[a, b]))
            a, met, score = best.take()
            yield pa.RecordBatch.from_arrays([pa.array(qid[a]), pa.array(met), pa.array(score)], ["qid", "record", "score"])

        part = variants.select("record", "vec").mapInArrow(run, "qid long, record long, score double")
        part = part.groupBy("qid", "record").agg(F.max("score").alias("score")).withColumnRenamed("record", "id")
        found = top_k(part, k) if found is None else found.unionByName(top_k(part, k))
    if found is None:
        found = spark.createDataFrame([], "qid long, id long, score double, rank long")
    return found.select("qid", "rank", "id", "score")


def norm_report(vectors: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """id, dim, norm and ok: whether a vector is finite and of unit length."""
    x = F.col("vec").cast("array<double>")
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b))
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return vectors.select("id", F.size("vec").cast("long").alias("dim"), F.round(norm, 6).alias("norm"), (finite & (F.abs(norm - 1) <= tolerance)).alias("ok"))
