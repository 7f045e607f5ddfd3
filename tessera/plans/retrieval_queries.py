"""Registered queries of scoring, fusion, reranking, decisions and metrics.

Points are the documents and queries the benchmark texts; vectors are the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evaluate as ev
from tessera.operators import retrieval as rt
from tessera.operators.scratch import kept
from tessera.plans.registry import register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hits(spark: SparkSession, sf_dir: str, k: int = 100, kinds: tuple[str, ...] = rt.KINDS) -> DataFrame:
    return rt.lexical_hits(table(spark, sf_dir, "benchmark"), "item_id", table(spark, sf_dir, "documents"), "doc_id", k, kinds)


def fused(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return rt.rrf(hits(spark, sf_dir), **how)


def with_texts(spark: SparkSession, sf_dir: str, candidates: DataFrame) -> DataFrame:
    """candidates with query and document texts: documents are met by an equality join on
    the ids that were retrieved."""
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("document"))
    return candidates.join(rt.sized(candidates.select("id").distinct()).join(d, "id"), "id").join(rt.sized(q), "qid")


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fused candidates, written once: a hundred rows a query that several steps read."""
    return kept(fused(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, candidates: DataFrame) -> DataFrame:
    """(qid, id): candidates whose text holds the query's whole text. What measures are
    made of it are measures within the pool."""
    pairs = with_texts(spark, sf_dir, candidates.select("qid", "id"))
    return pairs.where(F.contains("document", "query")).select("qid", "id")


def reranked(spark: SparkSession, sf_dir: str, candidates: DataFrame, top: int = 20) -> DataFrame:
    pairs = with_texts(spark, sf_dir, candidates.where(F.col("rank") <= top).select("qid", "id"))
    return ev.attach_rerank(candidates, ev.rerank_scores(pairs))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.when(F.length("text") < 200, "short").otherwise("long").alias("bucket"))


# ------------------------------------------------------------------------- SQL

MATCHES = """d0 AS MATERIALIZED (SELECT id, t, len(t) AS dl, len(list_distinct(t)) AS dt FROM (
  SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '([a-z0-9]+)', 1) AS t FROM documents)),
q0 AS (SELECT item_id AS qid, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '([a-z0-9]+)', 1)) AS t FROM benchmark),
tf AS (SELECT id, term, count(*) AS tf, any_value(dl) AS dl, any_value(dt) AS dt FROM (
  SELECT id, unnest(t) AS term, dl, dt FROM d0) GROUP BY id, term),
qt AS (SELECT qid, len(t) AS qn, unnest(t) AS term FROM q0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
m AS (SELECT qid, id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / 256.0))) AS bm25,
  count(*) AS shared, any_value(qn) AS qn, any_value(dt) AS dt
  FROM qt JOIN tf USING (term) JOIN df USING (term), n GROUP BY qid, id)"""
CHANNELS = MATCHES + """,
c0 AS (SELECT qid, id, 'lexical' AS channel, round(bm25, 6) AS score FROM m
  UNION ALL SELECT qid, id, 'semantic', round(shared / sqrt(CAST(qn AS DOUBLE) * dt), 6) FROM m
  UNION ALL SELECT qid, id, 'label', round(CAST(shared AS DOUBLE) / (qn + dt - shared), 6) FROM m),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, channel ORDER BY score DESC, id) AS rank FROM c0) WHERE rank <= 100)"""
_WIDE = """w AS (SELECT qid, id, max(rank) FILTER (WHERE channel = 'label') AS label_rank, max(score) FILTER (WHERE channel = 'label') AS label_score,
  max(rank) FILTER (WHERE channel = 'semantic') AS semantic_rank, max(score) FILTER (WHERE channel = 'semantic') AS semantic_score,
  max(rank) FILTER (WHERE channel = 'lexical') AS lexical_rank, max(score) FILTER (WHERE channel = 'lexical') AS lexical_score
  FROM c GROUP BY qid, id)"""
_ORDER = "PARTITION BY {}qid ORDER BY fused DESC, semantic_rank NULLS LAST, label_rank NULLS LAST, lexical_rank NULLS LAST, id"
_FUSED = "round(coalesce({} / (60 + label_rank), 0) + coalesce({} / (60 + semantic_rank), 0) + coalesce({} / (60 + lexical_rank), 0), 6)"
FUSED = (
    CHANNELS + ",\n" + _WIDE + f""",
f AS (SELECT * FROM (SELECT *, row_number() OVER ({_ORDER.format('')}) AS rank FROM (
  SELECT *, {_FUSED.format('CAST(1 AS DOUBLE)', 'CAST(2 AS DOUBLE)', 'CAST(1 AS DOUBLE)')} AS fused FROM w)) WHERE rank <= 100)"""
)
GOLD = """g AS (SELECT DISTINCT f.qid, f.id FROM f JOIN documents d ON d.doc_id = f.id JOIN benchmark b ON b.item_id = f.qid WHERE contains(d.text, b.text))"""
RERANKED = FUSED + """,
x AS (SELECT f.qid, f.id, round(CASE WHEN len(q0.t) > 0 THEN CAST(len(list_intersect(q0.t, d0.t)) AS DOUBLE) / len(q0.t) END, 6) AS rerank_score
  FROM f JOIN q0 ON q0.qid = f.qid JOIN d0 ON d0.id = f.id WHERE f.rank <= 20),
r AS (SELECT f.*, x.rerank_score, CASE WHEN x.rerank_score IS NOT NULL THEN
  row_number() OVER (PARTITION BY f.qid, x.rerank_score IS NULL ORDER BY x.rerank_score DESC, f.rank) END AS rerank_rank
  FROM f LEFT JOIN x ON x.qid = f.qid AND x.id = f.id)"""
WITH = "WITH "


@register("bm25_topk", WITH + MATCHES + """
SELECT qid, rank, id, score FROM (SELECT qid, id, round(bm25, 6) AS score,
  row_number() OVER (PARTITION BY qid ORDER BY round(bm25, 6) DESC, id) AS rank FROM m) WHERE rank <= 10""")
def bm25_topk(spark, sf_dir):
    return hits(spark, sf_dir, 10, ("lexical",)).select("qid", "rank", "id", "score")


@register("bm25_weights", WITH + MATCHES + """
SELECT id, term, tf, round(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / 256.0)), 6) AS weight FROM tf""")
def bm25_weights(spark, sf_dir):
    counts = rt.term_counts(table(spark, sf_dir, "documents"), "doc_id")
    return counts.select("id", "term", "tf", F.round(rt.bm25_weight(F.col("tf"), F.col("dl")), 6).alias("weight"))


@register("idf_table", WITH + MATCHES + """
SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM df, n""")
def idf_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = rt.document_counts(docs, "doc_id")
    return counts.select("term", "df", F.round(rt.idf(F.lit(docs.count()), F.col("df")), 6).alias("idf"))


@register("query_terms", WITH + MATCHES + " SELECT qid, term, CAST(1 AS DOUBLE) AS weight FROM qt")
def query_terms(spark, sf_dir):
    return rt.query_terms(table(spark, sf_dir, "benchmark"), "item_id").select("qid", "term", F.lit(1.0).alias("weight"))


VECTORS = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


@register("cosine_topk", WITH + VECTORS + """
SELECT qid, rank, id, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (
  SELECT q.id AS qid, p.id, round(list_cosine_similarity(q.v, p.v), 6) AS score FROM e q JOIN e p ON q.id <> p.id)) WHERE rank <= 10""")
def cosine_topk(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rt.cosine_top_k(e, e, 10)


@register("maxsim_by_group", WITH + VECTORS + """
SELECT qid, rank, record, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, record) AS rank FROM (
  SELECT q.id AS qid, CAST(p.label AS BIGINT) AS record, round(max(list_cosine_similarity(q.v, p.v)), 6) AS score
  FROM e q, e p GROUP BY q.id, p.label)) WHERE rank <= 5""")
def maxsim_by_group(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("long").alias("record"))
    found = rt.maxsim(e.select("id", "vec"), e, 5)
    return found.select("qid", "rank", F.col("id").alias("record"), "score")


@register("unit_norm_check", WITH + VECTORS + """
SELECT id, CAST(len(v) AS BIGINT) AS dim, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm,
  abs(sqrt(list_sum(list_transform(v, lambda x: x * x))) - 1) <= 1e-3 AS ok FROM e""")
def unit_norm_check(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return rt.norm_report(e)


@register("channel_hits", WITH + CHANNELS + " SELECT qid, id, channel, rank, score FROM c")
def channel_hits(spark, sf_dir):
    return hits(spark, sf_dir)


@register("rrf_fuse", WITH + FUSED + """
SELECT qid, rank, id, fused, label_rank, semantic_rank, lexical_rank, label_score, semantic_score, lexical_score FROM f""")
def rrf_fuse(spark, sf_dir):
    return fused(spark, sf_dir).select("qid", "rank", "id", "fused", *[f"{c}_{x}" for x in ("rank", "score") for c in ("label", "semantic", "lexical")])


SWEEP = (1.0, 2.0, 4.0)


@register("rrf_weight_sweep", WITH + CHANNELS + ",\n" + _WIDE + f""",
s AS (SELECT weight, qid, id, rank FROM (SELECT *, row_number() OVER ({_ORDER.format('weight, ')}) AS rank FROM (
  SELECT *, {_FUSED.format('CAST(1 AS DOUBLE)', 'weight', 'CAST(1 AS DOUBLE)')} AS fused
  FROM w, (SELECT unnest([CAST(1 AS DOUBLE), 2, 4]) AS weight))) WHERE rank <= 20)
SELECT weight, qid, id, rank FROM s""")
def rrf_weight_sweep(spark, sf_dir):
    met = kept(hits(spark, sf_dir))
    out = None
    for w in SWEEP:
        part = rt.rrf(met, {"label": 1.0, "semantic": w, "lexical": 1.0}, top=20).select(F.lit(w).alias("weight"), "qid", "id", "rank")
        out = part if out is None else out.unionByName(part)
    return out


@register("rerank_attach", WITH + RERANKED + " SELECT qid, id, rank, fused, rerank_score, rerank_rank FROM r")
def rerank_attach(spark, sf_dir):
    return reranked(spark, sf_dir, pool(spark, sf_dir)).select("qid", "id", "rank", "fused", "rerank_score", "rerank_rank")


@register("rerank_stats", WITH + RERANKED + """
SELECT count(rerank_score) AS pairs, round(min(rerank_score), 6) AS min_score, round(max(rerank_score), 6) AS max_score,
  round(avg(rerank_score), 6) AS mean_score FROM r""")
def rerank_stats(spark, sf_dir):
    s = F.col("rerank_score")
    return reranked(spark, sf_dir, pool(spark, sf_dir)).agg(F.count(s).alias("pairs"), F.round(F.min(s), 6).alias("min_score"), F.round(F.max(s), 6).alias("max_score"), F.round(F.avg(s), 6).alias("mean_score"))


@register("score_blend", WITH + RERANKED + """,
y AS (SELECT qid, id, rank, coalesce(rerank_score, 0) AS rr, fused, min(coalesce(rerank_score, 0)) OVER p AS rl, max(coalesce(rerank_score, 0)) OVER p AS rh,
  min(fused) OVER p AS fl, max(fused) OVER p AS fh FROM r WINDOW p AS (PARTITION BY qid)),
z AS (SELECT weight, qid, id, rank, round(weight * CASE WHEN rh > rl THEN (rr - rl) / (rh - rl) ELSE 0 END
  + (1 - weight) * CASE WHEN fh > fl THEN (fused - fl) / (fh - fl) ELSE 0 END, 6) AS score
  FROM y, (SELECT unnest([CAST(0.5 AS DOUBLE), 0.7, 0.9, 1.0]) AS weight))
SELECT weight, qid, id, score, row_number() OVER (PARTITION BY weight, qid ORDER BY score DESC, rank) AS blend_rank FROM z""")
def score_blend(spark, sf_dir):
    return ev.blend(reranked(spark, sf_dir, pool(spark, sf_dir)), (0.5, 0.7, 0.9, 1.0))


@register("threshold_decision", WITH + RERANKED + """,
b AS (SELECT qid, count(*) FILTER (WHERE rerank_score >= 0.895) AS n, max(rerank_score) AS max_score, arg_min(id, rerank_rank) AS best_id
  FROM r WHERE rerank_score IS NOT NULL GROUP BY qid)
SELECT item_id AS qid, CASE WHEN n > 0 THEN 'mapped' ELSE 'unmapped' END AS status, coalesce(n, 0) AS n_matches, max_score, best_id,
  CASE WHEN n > 0 THEN NULL WHEN max_score IS NULL THEN 'nothing scored'
  ELSE 'best score ' || printf('%.4f', max_score) || ' is under 0.895' END AS abstain_reason
FROM benchmark LEFT JOIN b ON qid = item_id""")
def threshold_decision(spark, sf_dir):
    return ev.decide(reranked(spark, sf_dir, pool(spark, sf_dir)), items(spark, sf_dir))


@register("topk_evidence", WITH + RERANKED + """
SELECT qid, id, rank AS retrieval_rank, rerank_rank, rerank_score, rerank_score >= 0.895 AS selected FROM r WHERE rerank_rank <= 10""")
def topk_evidence(spark, sf_dir):
    return ev.evidence(reranked(spark, sf_dir, pool(spark, sf_dir)))


_RULES = [(name, rule.replace("margin >=", "coalesce(round(margin, 6), 1) >=")) for name, rule in ev.RULES]
_PICKED = " UNION ALL ".join(f"SELECT '{name}' AS policy, qid, id FROM v WHERE {rule}" for name, rule in _RULES)


@register("policy_sweep", WITH + RERANKED + ",\n" + GOLD + f""",
v AS (SELECT *, rerank_score - lead(rerank_score) OVER (PARTITION BY qid ORDER BY rerank_rank) AS margin FROM r WHERE rerank_rank IS NOT NULL),
p AS ({_PICKED}),
a AS (SELECT policy, count(*) AS n, count(g.id) AS tp, count(DISTINCT p.qid) AS covered, any_value(k.n) AS ng, any_value(b.n) AS nq
  FROM p LEFT JOIN g ON g.qid = p.qid AND g.id = p.id, (SELECT count(*) AS n FROM g) k, (SELECT count(*) AS n FROM benchmark) b GROUP BY policy)
SELECT policy, tp, n - tp AS fp, ng - tp AS fn, round(CASE WHEN n > 0 THEN CAST(tp AS DOUBLE) / n ELSE 0 END, 6) AS precision,
  round(CASE WHEN ng > 0 THEN CAST(tp AS DOUBLE) / ng ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp > 0 THEN 2 * (CAST(tp AS DOUBLE) / n) * (CAST(tp AS DOUBLE) / ng) / (CAST(tp AS DOUBLE) / n + CAST(tp AS DOUBLE) / ng) ELSE 0 END, 6) AS f1,
  round(CAST(covered AS DOUBLE) / nq, 6) AS coverage FROM a""")
def policy_sweep(spark, sf_dir):
    candidates = pool(spark, sf_dir)
    rows = reranked(spark, sf_dir, candidates)
    return ev.policy_metrics(ev.policies(rows), gold(spark, sf_dir, candidates), items(spark, sf_dir))


_METRICS = ", ".join(
    [f"round(avg(CASE WHEN first <= {k} THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS hit_{k}" for k in ev.CUTS]
    + [f"round(avg(CASE WHEN first <= {k} THEN CAST(1 AS DOUBLE) / first ELSE 0 END), 6) AS mrr_{k}" for k in ev.MRR_CUTS]
    + ["round(avg(CASE WHEN first IS NULL THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS zero_hit"]
)
FIRST = FUSED + ",\n" + GOLD + """,
h AS (SELECT qid, min(rank) AS first FROM f JOIN g USING (qid, id) GROUP BY qid),
k AS (SELECT item_id AS qid, CASE WHEN length(text) < 200 THEN 'short' ELSE 'long' END AS bucket, first FROM benchmark LEFT JOIN h ON qid = item_id)"""


@register("rank_metrics", WITH + FIRST + f" SELECT count(*) AS n, {_METRICS} FROM k")
def rank_metrics(spark, sf_dir):
    candidates = pool(spark, sf_dir)
    return ev.first_hits(candidates, gold(spark, sf_dir, candidates), items(spark, sf_dir)).agg(*ev.metric_columns())


@register("metric_slices", WITH + FIRST + f"""
SELECT coalesce(bucket, 'all') AS slice, count(*) AS n, {_METRICS} FROM k GROUP BY GROUPING SETS ((), (bucket))
UNION ALL SELECT 'answerable', count(*), {_METRICS} FROM k WHERE first IS NOT NULL""")
def metric_slices(spark, sf_dir):
    candidates = pool(spark, sf_dir)
    first = kept(ev.first_hits(candidates, gold(spark, sf_dir, candidates), items(spark, sf_dir)))
    sliced = first.rollup("bucket").agg(*ev.metric_columns()).withColumnRenamed("bucket", "slice")
    sliced = sliced.withColumn("slice", F.coalesce("slice", F.lit("all")))
    answerable = first.where("first IS NOT NULL").agg(*ev.metric_columns()).withColumn("slice", F.lit("answerable"))
    return sliced.unionByName(answerable)


@register("coverage_channels", WITH + CHANNELS + """
SELECT channel, count(DISTINCT qid) AS queries, count(*) AS hits, (SELECT count(*) FROM benchmark) - count(DISTINCT qid) AS without
FROM c GROUP BY channel""")
def coverage_channels(spark, sf_dir):
    n = table(spark, sf_dir, "benchmark").count()
    met = hits(spark, sf_dir).groupBy("channel").agg(F.count_distinct("qid").alias("queries"), F.count(F.lit(1)).alias("hits"))
    return met.withColumn("without", F.lit(n).cast("long") - F.col("queries"))


@register("lexical_miss", WITH + FUSED + """
SELECT qid, id FROM f WHERE lexical_rank IS NULL
UNION ALL SELECT item_id, NULL FROM benchmark WHERE item_id NOT IN (SELECT qid FROM f)""")
def lexical_miss(spark, sf_dir):
    f = pool(spark, sf_dir)
    none = items(spark, sf_dir).join(f.select("qid").distinct(), "qid", "left_anti").select("qid", F.lit(None).cast("long").alias("id"))
    return f.where("lexical_rank IS NULL").select("qid", "id").unionByName(none)


@register("pool_probe", WITH + CHANNELS + """
SELECT qid, id, max(rank) FILTER (WHERE channel = 'label') AS label_rank, max(rank) FILTER (WHERE channel = 'semantic') AS semantic_rank,
  max(rank) FILTER (WHERE channel = 'lexical') AS lexical_rank FROM c
WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY qid, id""")
def pool_probe(spark, sf_dir):
    suspects = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id")).distinct()
    met = hits(spark, sf_dir).join(suspects, "id", "left_semi")
    return met.groupBy("qid", "id").agg(*[F.max(F.when(F.col("channel") == c, F.col("rank"))).alias(f"{c}_rank") for c in ("label", "semantic", "lexical")])


@register("near_miss", WITH + RERANKED + """,
b AS (SELECT qid, max(rerank_score) AS s FROM r GROUP BY qid)
SELECT source, count(*) AS n FROM r JOIN b USING (qid) JOIN documents d ON d.doc_id = r.id
WHERE rerank_rank = 1 AND s < 0.895 GROUP BY source ORDER BY n DESC, source LIMIT 10""")
def near_miss(spark, sf_dir):
    rows = kept(reranked(spark, sf_dir, pool(spark, sf_dir)))
    unmapped = ev.decide(rows, items(spark, sf_dir)).where("status = 'unmapped'").select("qid")
    first = rows.where("rerank_rank = 1").join(unmapped, "qid", "left_semi").select("id")
    named = first.join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source"), "id")
    return named.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(10)


@register("point_lookup", """SELECT doc_id AS id, source, lang, CAST(length(coalesce(text, '')) AS BIGINT) AS chars FROM documents
WHERE doc_id IN (SELECT item_id FROM benchmark)""")
def point_lookup(spark, sf_dir):
    wanted = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id")).distinct()
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "lang", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    return d.join(rt.sized(wanted), "id", "left_semi")


@register("rerank_pilot", WITH + RERANKED + ",\n" + GOLD + """,
p AS (SELECT item_id AS qid FROM benchmark WHERE item_id % 3 = 0)
SELECT p.qid, min(r.rank) FILTER (WHERE g.id IS NOT NULL) AS before, min(r.rerank_rank) FILTER (WHERE g.id IS NOT NULL) AS after, count(r.rerank_score) AS scored
FROM p LEFT JOIN r ON r.qid = p.qid AND r.rank <= 20 LEFT JOIN g ON g.qid = r.qid AND g.id = r.id GROUP BY p.qid""")
def rerank_pilot(spark, sf_dir):
    """A trial of a reranker on some queries: ranks of the first gold candidate before and
    after. Nothing that is stored changes."""
    few = items(spark, sf_dir).where("qid % 3 = 0").select("qid")
    candidates = kept(pool(spark, sf_dir).join(rt.sized(few), "qid", "left_semi"))
    rows = reranked(spark, sf_dir, candidates).where("rank <= 20")
    marked = rows.join(gold(spark, sf_dir, candidates).distinct().withColumn("hit", F.lit(True)), ["qid", "id"], "left")
    best = marked.groupBy("qid").agg(F.min(F.when(F.col("hit"), F.col("rank"))).alias("before"), F.min(F.when(F.col("hit"), F.col("rerank_rank"))).alias("after"), F.count("rerank_score").alias("scored"))
    return few.join(best, "qid", "left").withColumn("scored", F.coalesce("scored", F.lit(0)).cast("long"))


_RICH = CHANNELS.replace("coalesce(text, '')), '([a-z0-9]+)', 1) AS t FROM documents", "coalesce(text, '') || ' ' || coalesce(lang, '') || ' ' || coalesce(source, '')), '([a-z0-9]+)', 1) AS t FROM documents")


@register("enrichment_probe", WITH + f"""plain AS ({WITH}{CHANNELS} SELECT qid, id, rank FROM c WHERE channel = 'lexical' AND rank <= 10),
rich AS ({WITH}{_RICH} SELECT qid, id, rank FROM c WHERE channel = 'lexical' AND rank <= 10)
SELECT coalesce(plain.qid, rich.qid) AS qid, count(*) FILTER (WHERE rich.id IS NULL) AS lost, count(*) FILTER (WHERE plain.id IS NULL) AS won, count(*) FILTER (WHERE plain.rank = rich.rank) AS same
FROM plain FULL JOIN rich ON plain.qid = rich.qid AND plain.id = rich.id GROUP BY 1""")
def enrichment_probe(spark, sf_dir):
    """A trial of richer documents: what the best ten of each query lose and win when the
    language and source are part of the text. The stored documents stay."""
    docs = table(spark, sf_dir, "documents")
    rich = docs.withColumn("text", F.concat_ws(" ", F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))))
    found = [rt.lexical_hits(table(spark, sf_dir, "benchmark"), "item_id", d, "doc_id", 10, ("lexical",)).select("qid", "id", F.col("rank").alias(name)) for d, name in ((docs, "a"), (rich, "b"))]
    both = found[0].join(found[1], ["qid", "id"], "full")
    return both.groupBy("qid").agg(F.count_if(F.col("b").isNull()).alias("lost"), F.count_if(F.col("a").isNull()).alias("won"), F.count_if(F.col("a") == F.col("b")).alias("same"))
