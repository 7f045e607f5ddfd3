"""Reranking, decisions, ranking metrics and statistics over candidate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import SourceError
from tessera.functions.plugins import resolve
from tessera.functions.text import tokens
from tessera.operators.retrieval import sized

#: Fixed value: the frozen acceptance threshold.
THRESHOLD = 0.895

Reranker = Callable[[list[str], list[str]], list[float | None]]


def overlap_scores(pairs: DataFrame) -> DataFrame:
    """qid, id, rerank_score of (qid, id, query, document): the share of a query's distinct
    words that its document has, null without words. A deterministic stand-in for a model,
    in built-in functions."""
    words = F.array_distinct(tokens(F.col("query")))
    rows = pairs.select("qid", "id", words.alias("w"), tokens(F.col("document")).alias("d"))
    share = F.size(F.array_intersect("w", "d")) / F.size("w")
    return rows.select("qid", "id", F.when(F.size("w") > 0, share).alias("rerank_score"))


def _remote(url: str) -> Callable[[], Reranker]:
    from tessera.functions.remote import RemoteReranker

    return lambda: RemoteReranker(url)


#: Rerankers by name: a function that makes a scorer, or None for the stand-in. A build may
#: also name "remote:URL" or "module:attribute".
RERANKERS: dict[str, Callable[[], Reranker] | None] = {"overlap": None}


def rerank_scores(pairs: DataFrame, reranker: str | Callable[[], Reranker] = "overlap") -> DataFrame:
    """qid, id, rerank_score of (qid, id, query, document) by a reranker: one of RERANKERS,
    or a function that makes a scorer over lists in each task. Scores must be finite, one a
    pair or none for it."""
    make = resolve("reranker", reranker, RERANKERS, {"remote": _remote}) if isinstance(reranker, str) else reranker
    if make is None:
        return overlap_scores(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make()
        for batch in batches:
            scores = scorer(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            if len(scores) != batch.num_rows or any(s is not None and not abs(s) < float("inf") for s in scores):
                raise SourceError("the scorer must give one finite score or none for each pair")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["qid", "id", "rerank_score"])

    rows = pairs.select(F.col("qid").cast("long"), F.col("id").cast("long"), "query", "document")
    # A service takes the documents of one query together.
    rows = rows.sortWithinPartitions("qid", "id")
    return rows.mapInArrow(run, "qid long, id long, rerank_score double")


def attach_rerank(candidates: DataFrame, scores: DataFrame) -> DataFrame:
    """candidates with rerank_score and rerank_rank (from 1 over the scored ones); their
    own order and rank stay."""
    rows = candidates.join(scores, ["qid", "id"], "left").withColumn("rerank_score", F.round("rerank_score", 6))
    order = Window.partitionBy("qid", F.col("rerank_score").isNull()).orderBy(F.desc("rerank_score"), "rank")
    return rows.withColumn("rerank_rank", F.when(F.col("rerank_score").isNotNull(), F.row_number().over(order)).cast("long"))


def blend(candidates: DataFrame, weights: Sequence[float]) -> DataFrame:
    """weight, qid, id, score, blend_rank: w * rerank + (1 - w) * fused, both scaled to
    [0, 1] within a query (a flat list: 0; no rerank score: 0 before); ties keep rank."""
    whole = Window.partitionBy("qid")

    def scaled(x: Column) -> Column:
        low, high = F.min(x).over(whole), F.max(x).over(whole)
        return F.when(high > low, (x - low) / (high - low)).otherwise(F.lit(0.0))

    rows = candidates.select("qid", "id", "rank", scaled(F.coalesce("rerank_score", F.lit(0.0))).alias("r"), scaled(F.col("fused")).alias("f"))
    rows = rows.withColumn("weight", F.explode(F.array(*[F.lit(float(w)) for w in weights])))
    rows = rows.withColumn("score", F.round(F.col("weight") * F.col("r") + (1 - F.col("weight")) * F.col("f"), 6))
    order = Window.partitionBy("weight", "qid").orderBy(F.desc("score"), "rank")
    return rows.withColumn("blend_rank", F.row_number().over(order).cast("long")).select("weight", "qid", "id", "score", "blend_rank")


def decide(candidates: DataFrame, queries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """qid, status (mapped or unmapped), n_matches, max_score, best_id and abstain_reason,
    for every query (qid)."""
    scored = candidates.where("rerank_score IS NOT NULL")
    best = F.min_by("id", F.struct("rerank_rank", "rank"))
    found = scored.groupBy("qid").agg(F.count_if(F.col("rerank_score") >= threshold).alias("n"), F.max("rerank_score").alias("max_score"), best.alias("best_id"))
    rows = queries.select("qid").distinct().join(found, "qid", "left")
    mapped = F.coalesce(F.col("n") > 0, F.lit(False))
    reason = F.when(mapped, None).when(F.col("max_score").isNull(), "nothing scored").otherwise(F.concat(F.lit("best score "), F.format_string("%.4f", "max_score"), F.lit(f" is under {threshold}")))
    return rows.select("qid", F.when(mapped, "mapped").otherwise("unmapped").alias("status"), F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"), "max_score", "best_id", reason.alias("abstain_reason"))


def evidence(candidates: DataFrame, k: int = 10, threshold: float = THRESHOLD) -> DataFrame:
    """The first k scored candidates by rerank rank, flagged selected; `rank` is renamed."""
    rows = candidates.where((F.col("rerank_rank") <= k) & F.col("rerank_score").isNotNull())
    return rows.select("qid", "id", F.col("rank").alias("retrieval_rank"), "rerank_rank", "rerank_score", (F.col("rerank_score") >= threshold).alias("selected"))


#: The grids of acceptance policies.
RANK_CUTS, SCORE_CUTS = (1, 2, 3, 5, 10), (0.9, 0.8, 0.7, 0.5, 0.3)
MARGINS, TOP_3_SCORES = (0.2, 0.1, 0.05, 0.01), (0.8, 0.5, 0.3)
#: Name and SQL condition of each policy; margin: of a first candidate over the second.
RULES: list[tuple[str, str]] = [
    *[(f"rank<={k}", f"rerank_rank <= {k}") for k in RANK_CUTS],
    *[(f"score>={s}", f"rerank_score >= {s}") for s in SCORE_CUTS],
    *[(f"margin>={m}", f"rerank_rank = 1 AND margin >= {m}") for m in MARGINS],
    *[(f"rank<=3&score>={s}", f"rerank_rank <= 3 AND rerank_score >= {s}") for s in TOP_3_SCORES],
]


def policies(candidates: DataFrame) -> DataFrame:
    """policy, qid, id of what each acceptance policy selects: rank cuts, score cuts,
    margins of the first over the second (a lone one is accepted), rank and score."""
    order = Window.partitionBy("qid").orderBy("rerank_rank")
    margin = F.round(F.col("rerank_score") - F.lead("rerank_score").over(order), 6)
    rows = candidates.where("rerank_rank IS NOT NULL").withColumn("margin", F.coalesce(margin, F.lit(1.0)))
    named = F.filter(F.array(*[F.when(F.expr(on), F.lit(name)) for name, on in RULES]), lambda x: x.isNotNull())
    return rows.select("qid", "id", F.explode(named).alias("policy"))


def policy_metrics(selected: DataFrame, gold: DataFrame, queries: DataFrame) -> DataFrame:
    """policy, tp, fp, fn, precision, recall, f1, coverage over (qid, id) pairs of gold and
    all queries (qid); zero denominators give 0."""
    n = queries.select("qid").distinct().count()
    n_gold = gold.distinct().count()
    hit = selected.join(gold.distinct().withColumn("hit", F.lit(1)), ["qid", "id"], "left")
    sums = hit.groupBy("policy").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("hit"), F.lit(0)).alias("tp"), F.count_distinct("qid").alias("covered"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    rows = sums.select("policy", F.col("tp").cast("long"), (F.col("n") - F.col("tp")).alias("fp"), (F.lit(n_gold) - F.col("tp")).cast("long").alias("fn"), "covered")
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    rows = rows.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(ratio(2 * p * r, p + r), 6)})
    return rows.withColumn("coverage", F.round(F.col("covered") / F.lit(float(max(n, 1))), 6)).drop("covered")


CUTS = (1, 5, 10, 20, 50, 100)
MRR_CUTS = (10, 20, 100)


def first_hits(candidates: DataFrame, gold: DataFrame, queries: DataFrame) -> DataFrame:
    """queries with first: the rank of the first gold candidate, null without one."""
    found = candidates.join(gold.distinct(), ["qid", "id"]).groupBy("qid").agg(F.min("rank").alias("first"))
    return queries.join(found, "qid", "left")


def metric_columns() -> list[Column]:
    hit = [F.round(F.avg(F.when(F.col("first") <= k, 1.0).otherwise(0.0)), 6).alias(f"hit_{k}") for k in CUTS]
    mrr = [F.round(F.avg(F.when(F.col("first") <= k, 1.0 / F.col("first")).otherwise(0.0)), 6).alias(f"mrr_{k}") for k in MRR_CUTS]
    return [F.count(F.lit(1)).alias("n"), *hit, *mrr, F.round(F.avg(F.when(F.col("first").isNull(), 1.0).otherwise(0.0)), 6).alias("zero_hit")]


def concept_stats(pairs: DataFrame, n_queries: int) -> DataFrame:
    """concept, n_jobs, job_share, pair_share, mean_score, min_score, mean_rank of (job,
    concept, score, rank) pairs."""
    n = pairs.count()
    # Millionths add up exactly in any order.
    exact = F.round(F.sum(F.round(F.col("score") * 1e6).cast("long")) / F.count("score") / 1e6, 6)
    rows = pairs.groupBy("concept").agg(F.count_distinct("job").alias("n_jobs"), F.count(F.lit(1)).alias("n_pairs"), exact.alias("mean_score"), F.round(F.min("score"), 6).alias("min_score"), F.round(F.avg("rank"), 6).alias("mean_rank"))
    return rows.withColumns({"job_share": F.round(F.col("n_jobs") / F.lit(float(max(n_queries, 1))), 4), "pair_share": F.round(F.col("n_pairs") / F.lit(float(max(n, 1))), 4)})


def concentration(counts: DataFrame, catalog: int) -> DataFrame:
    """One row over (concept, n): shares of the 1, 10 and 20 largest, singletons, concepts
    with 3 or fewer, the upper median, and the share of the catalog met.

    The median comes from the histogram of n, whose rows are few, not from a sort of all."""
    whole = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("concepts"), F.count_if(F.col("n") == 1).alias("singletons"), F.count_if(F.col("n") <= 3).alias("at_most_3"))
    top = counts.orderBy(F.desc("n"), "concept").limit(20).withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "concept")))
    tops = top.agg(*[F.sum(F.when(F.col("r") <= k, F.col("n"))).alias(f"t{k}") for k in (1, 10, 20)])
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    steps = steps.withColumn("upto", F.sum("c").over(Window.orderBy("n")))
    middle = steps.join(F.broadcast(whole.select("concepts"))).where(F.col("upto") > F.floor(F.col("concepts") / 2)).agg(F.min("n").alias("median"))
    rows = whole.join(F.broadcast(tops)).join(F.broadcast(middle))
    shares = [F.round(F.col(f"t{k}") / F.col("total"), 4).alias(f"top_{k}_share") for k in (1, 10, 20)]
    return rows.select(F.col("total").cast("long"), "concepts", *shares, "singletons", "at_most_3", F.col("median").cast("long").alias("upper_median"), F.round(F.col("concepts") / F.lit(float(max(catalog, 1))), 4).alias("catalog_share"))


def stratified_sample(rows: DataFrame, key: str, strata: Sequence[str], n: int, seed: int = 7, floor: int = 1, minimums: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """n rows (all, if fewer): at least `floor` of each stratum and the minimums ((column,
    value) -> rows), filled up by the order of a hash of the key. Where these are more than
    n, the first n of them. The same rows give the same sample in any process.

    Of a stratum a task passes on `floor` rows, of the others the first n: no group of any
    size meets in one task."""
    whole = rows.withColumn("__h", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")))
    order = ["__h", key]
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    must = whole.withColumn("__s", place).where(F.col("__s") <= floor).drop("__s")
    for (column, value), least in (minimums or {}).items():
        must = must.unionByName(whole.where(F.col(column) == value).orderBy(*order).limit(least))
    must = must.dropDuplicates([key])
    first = whole.orderBy(*order).limit(n)
    both = must.withColumn("__r", F.lit(0)).unionByName(first.join(sized(must.select(key)), key, "left_anti").select(*must.columns).withColumn("__r", F.lit(1)))
    return both.orderBy("__r", *order).limit(n).select(*rows.columns)
