"""Matching postings to a promoted index: canonical postings -> queries -> three channels
-> fusion -> rerank -> verified candidates, and the decisions on them."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import ConstraintError
from tessera.functions import text as tx
from tessera.functions.encoders import encode_column
from tessera.operators import canonical as cn
from tessera.operators import constraints as ct
from tessera.operators import documents as dc
from tessera.operators import evaluate as ev
from tessera.operators import hierarchy as hi
from tessera.operators import retrieval as rt
from tessera.operators.scratch import checkpointed
from tessera.plans.build import Build, check_pointer, fingerprint, layered, promoted, table_digest
from tessera.plans.index import STAGES as INDEX_STAGES
from tessera.sources.package import read_postings, read_taxonomy
from tessera.sources.store import at

VERSION = 1
STAGES = ("postings", "validate", "queries", "retrieve", "rerank", "verify")
#: Fixed value: the root of IT categories.
IT_ROOT = "257"
DEFAULTS = {"it_root": IT_ROOT, "platform": "jobs", "shards": 4, "analyzer": "english", "reranker": "overlap", "encoder": "hash", "label_tokens": 128, "semantic_tokens": 4096, "instruction": "", "candidates": 100, "top_k": 100, "rrf_k": 60, "weights": {"label": 1.0, "semantic": 2.0, "lexical": 1.0}, "rerank_top": 100, "threshold": ev.THRESHOLD}


def canonical_postings(postings: DataFrame, taxonomy: DataFrame, it_root: str = IT_ROOT, platform: str = "jobs") -> DataFrame:
    """Completed postings with cleaned texts and categories routed to it, secondary or
    unresolved; content_hash covers texts and IT paths only. platform names the source of
    postings that don't say and begins their ids."""
    rows = postings.where("status = 'completed'")
    rows = rows.select(
        F.trim("externalId").alias("external_id"), F.coalesce(F.nullif(F.trim("platformId"), F.lit("")), F.lit(platform)).alias("platform"), F.concat(F.lit(f"{platform}:"), F.trim("externalId")).alias("job_id"),
        F.col("sourceUrl").alias("source_url"), tx.date_of(F.col("updatedAt")).alias("updated_at"),
        tx.clean_text(F.col("title")).alias("title"), tx.clean_text(F.col("description")).alias("description"), tx.clean_text(F.col("requireCandidate")).alias("require_candidate"), tx.clean_text(F.col("experience")).alias("experience"),
        tx.clean_strings(F.col("requireSummary")).alias("require_summary"), tx.clean_strings(F.transform("knowledge", lambda x: x["title"])).alias("knowledge"), tx.clean_map(F.col("commonInfo")).alias("common_info"), F.col("categories"),
    )
    own = rows.select("job_id", F.posexplode("categories").alias("pos", "c"))
    row_id = F.concat_ws("#", "job_id", "pos")
    observed = own.select(row_id.alias("row_id"), F.trim("c.key").alias("key"), F.col("c.name").alias("name"), F.col("c.level1Id").alias("level1"), F.col("c.level2Id").alias("level2"), F.col("c.level3Id").alias("level3"))
    walks = hi.walk_up(taxonomy)
    if not walks.where("state = 'cycle'").isEmpty():
        raise ConstraintError("the category taxonomy has a cycle")
    resolved = cn.resolve_categories(observed, walks, taxonomy.select("id", "name"), it_root)
    placed = own.select("job_id", "pos", row_id.alias("row_id"), F.col("c.key").alias("key"), F.col("c.name").alias("observed_name")).join(resolved, "row_id").drop("row_id")
    item = F.struct("pos", *[c for c in placed.columns if c not in ("job_id", "pos", "route")])
    kinds = {"it_category_paths": "it", "secondary_category_paths": "secondary", "unresolved_categories": "unresolved"}
    grouped = placed.groupBy("job_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("route") == k, item))).alias(c) for c, k in kinds.items()])
    rows = rows.drop("categories").join(grouped, "job_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.array().cast(grouped.schema[c].dataType)) for c in kinds})
    hashed = F.to_json(F.struct(F.lit(VERSION).alias("v"), "title", "description", "require_candidate", "require_summary", "knowledge", "it_category_paths"), {"ignoreNullFields": "false"})
    return rows.withColumn("content_hash", F.sha2(hashed, 256))


def posting_constraints(rows: DataFrame) -> list[ct.Constraint]:
    return [ct.not_blank(rows, "external_id", "job_id"), ct.not_blank(rows, "title", "job_id"), ct.unique(rows, "job_id")]


def posting_report(rows: DataFrame, postings: DataFrame) -> dict:
    """Counts of categories, conflicts, missing fields, and of postings skipped by status."""
    every = F.concat(*[F.transform(c, lambda x: x["root_conflict"].cast("int")) for c in ("it_category_paths", "secondary_category_paths")])
    last = F.concat(*[F.transform(c, lambda x: x["terminal_conflict"].cast("int")) for c in ("it_category_paths", "secondary_category_paths")])
    total = lambda a: F.sum(F.aggregate(a, F.lit(0), lambda x, y: x + y))
    sizes = [F.sum(F.size(c)).alias(c) for c in ("it_category_paths", "secondary_category_paths", "unresolved_categories")]
    counts = rows.agg(F.count(F.lit(1)).alias("postings"), *sizes, total(every).alias("root_conflicts"), total(last).alias("terminal_conflicts"), F.count_if(F.col("description").isNull()).alias("no_description")).first().asDict()
    counts["skipped"] = {str(r.status): r["count"] for r in postings.where("status IS NULL OR status <> 'completed'").groupBy("status").count().collect()}
    return counts


def _names(paths: str, one: str) -> Column:
    return F.transform(paths, lambda x: x[one])


def queries(rows: DataFrame, settings: dict) -> DataFrame:
    """qid (a number of the row's own), job_id, and the label, semantic and lexical query
    texts, fitted to their budgets."""
    terminals = F.array_distinct(_names("it_category_paths", "terminal_label"))
    paths = F.array_distinct(F.transform("it_category_paths", lambda x: F.coalesce(F.nullif(x["declared_path"], F.lit("")), x["observed_name"])))
    needs = F.array_join(F.concat(F.array_compact(F.array("require_candidate")), "require_summary"), "\n")
    made = rows.withColumns({"terminals": F.array_join(terminals, "; "), "paths": F.array_join(paths, "; "), "needs": needs})
    label = dc.fit_column(made, "job_id", [("title", "Title", "title", 90), ("category", "IT categories", "terminals", 10)], settings["label_tokens"], settings["instruction"])
    semantic = dc.fit_column(made, "job_id", [("title", "Title", "title", 90), ("category", "Category context", "paths", 50), ("responsibilities", "Responsibilities", "description", 10), ("requirements", "Requirements", "needs", 20)], settings["semantic_tokens"], settings["instruction"])
    lexical = F.array_join(F.filter(F.concat(F.array("title"), terminals, "knowledge"), lambda x: x.isNotNull() & (x != "")), "\n")
    out = made.select("job_id", "content_hash", lexical.alias("lexical"))
    out = out.join(label.select(F.col("id").alias("job_id"), F.col("text").alias("label")), "job_id").join(semantic.select(F.col("id").alias("job_id"), F.col("text").alias("semantic")), "job_id")
    # The table is written at once, so the numbers stay as they are.
    return out.withColumn("qid", F.monotonically_increasing_id())


def retrieve(spark: SparkSession, asked: DataFrame, index: Build, settings: dict) -> DataFrame:
    """Fused candidates (id is the hash of concept_id), with the content hash of their
    posting and the name of the index."""
    k = settings["candidates"]
    ids = asked.withColumn("id", F.col("qid"))
    points = index.read(spark, "records").select("id").withColumn("pid", F.xxhash64("id"))
    if points.groupBy("pid").count().where("count > 1").count():
        raise ConstraintError("two concept ids share a hash")
    vectors = {c: encode_column(ids, "id", c, settings["encoder"]).select(F.col("id").cast("long").alias("id"), "vec") for c in ("label", "semantic")}
    labels = index.read(spark, "labels").select(F.xxhash64("id").alias("record"), "vec")
    semantic = index.read(spark, "semantic").select(F.xxhash64("id").alias("id"), "vec")
    words = index.read(spark, "lexical").withColumn("id", F.xxhash64("id"))
    hit = lambda df, channel: df.select("qid", "id", F.lit(channel).alias("channel"), "rank", "score")
    best = rt.maxsim(vectors["label"], labels, k)
    near = rt.cosine_top_k(vectors["semantic"], semantic, k)
    lexical = rt.lexical_hits(ids, "id", words, "id", k, ("lexical",), query_text="lexical", analyzer=settings["analyzer"], strict=True)
    hits = hit(best, "label").unionByName(hit(near, "semantic")).unionByName(lexical)
    fused = rt.rrf(hits, settings["weights"], settings["rrf_k"], settings["top_k"])
    named = fused.join(points.select(F.col("id").alias("concept_id"), F.col("pid").alias("id")), "id")
    return named.join(asked.select("qid", "job_id", "content_hash"), "qid").withColumn("index_build", F.lit(index.path.name))


def rerank_pairs(candidates: DataFrame, asked: DataFrame, texts: DataFrame) -> DataFrame:
    """qid, id, query, document of candidates; a candidate without a document, or without
    its posting's query, is an error."""
    ct.enforce([ct.references(candidates, "concept_id", texts, "concept_id"), ct.references(candidates, "job_id", asked, "job_id")])
    pairs = candidates.join(asked.select("job_id", F.col("semantic").alias("query")), "job_id").join(texts, "concept_id")
    return pairs.select("qid", "id", "query", "document")


def match_postings(spark: SparkSession, postings_path: str, taxonomy_path: str, pointer: str | None, work: str, settings: dict | None = None, index_build: str | None = None) -> Build:
    """All stages against the promoted index, which mustn't move meanwhile, or against
    index_build, whatever is promoted."""
    settings = DEFAULTS | (settings or {})
    checkpointed(spark)
    named = index_build or promoted(pointer)
    unmoved = lambda: index_build or check_pointer(pointer, named)
    index = Build(at(named), INDEX_STAGES)
    index.require("records", "validate", "verify")
    source = read_postings(spark, postings_path)
    taxonomy = read_taxonomy(spark, taxonomy_path)
    data = [VERSION, table_digest(source.select(F.to_json(F.struct("*")).alias("j"))), table_digest(taxonomy), settings["it_root"], settings["platform"]]
    layers = layered([("postings", data), ("queries", [settings[k] for k in ("label_tokens", "semantic_tokens", "instruction")]), ("retrieve", [named, settings["encoder"], settings["analyzer"], settings["shards"], *[settings[k] for k in ("candidates", "top_k", "rrf_k", "weights")]]), ("rerank", [settings["rerank_top"], settings["reranker"]])])
    prints = {"postings": layers["postings"], "queries": layers["queries"], "retrieve": layers["retrieve"], "rerank": layers["rerank"]}
    build = Build(at(work) / fingerprint(layers), STAGES, prints)
    rows = build.table(spark, "postings", lambda: canonical_postings(source, taxonomy, settings["it_root"], settings["platform"]))

    def validate() -> dict:
        ct.enforce(posting_constraints(rows))
        return posting_report(rows, source)

    if build.state("validate") != "completed":
        build.step("validate", validate, ["postings"])
    asked = build.table(spark, "queries", lambda: queries(rows, settings), ["validate"])
    shard = F.pmod(F.xxhash64("job_id"), F.lit(settings["shards"]))
    found = build.sharded(spark, "retrieve", lambda i: retrieve(spark, asked.where(shard == i), index, settings), settings["shards"], ["queries"])
    unmoved()

    def rerank() -> DataFrame:
        texts = index.read(spark, "lexical").select(F.col("id").alias("concept_id"), F.col("text").alias("document"))
        pairs = rerank_pairs(found.where(F.col("rank") <= settings["rerank_top"]), asked, texts)
        return ev.attach_rerank(found, ev.rerank_scores(pairs, settings["reranker"]))

    done = build.table(spark, "rerank", rerank, ["retrieve"])
    if build.state("verify") != "completed":
        build.step("verify", lambda: verify(done, rows, index.read(spark, "records"), index.path.name), ["rerank"])
    unmoved()
    return build


def verify(matches: DataFrame, rows: DataFrame, concepts: DataFrame, index_build: str) -> dict:
    """Ranks and rerank ranks run from 1, candidates differ and exist, scores are finite,
    and every match is of this index and of its posting as it is now."""
    ranks = matches.groupBy("job_id").agg(
        F.max("rank").alias("m"), F.count(F.lit(1)).alias("n"), F.count_distinct("concept_id").alias("d"),
        F.count("rerank_score").alias("scored"), F.count("rerank_rank").alias("placed"), F.count_distinct("rerank_rank").alias("places"), F.max("rerank_rank").alias("last"),
    )
    key = F.col("job_id").alias("key")
    fresh = rows.select("job_id", F.col("content_hash").alias("now"))
    stale = matches.join(fresh, "job_id").where("NOT content_hash <=> now")
    ct.enforce(
        [
            ct.Constraint("ranks from 1 without gaps", ranks.where("m <> n OR d <> n").select(key)),
            ct.Constraint("rerank ranks from 1 without gaps", ranks.where("scored <> placed OR places <> placed OR coalesce(last, 0) <> placed").select(key)),
            ct.Constraint("postings as they were matched", stale.select(key)),
            ct.Constraint("matches of this index", matches.where(F.col("index_build") != index_build).select(key)),
            ct.references(matches, "concept_id", concepts, "id"),
            ct.references(matches, "job_id", rows, "job_id"),
            ct.Constraint("finite scores", matches.where("isnan(rerank_score) OR isnan(fused) OR abs(fused) = double('inf')").select(key)),
        ]
    )
    return {"jobs": rows.count(), "matched": ranks.count(), "candidates": matches.count()}


def decisions(spark: SparkSession, build: Build, threshold: float = ev.THRESHOLD) -> DataFrame:
    """A decision for each posting of a verified build."""
    build.require("verify")
    jobs = build.read(spark, "queries").select("job_id", "qid")
    made = ev.decide(build.read(spark, "rerank"), jobs.select("qid"), threshold)
    return jobs.join(made, "qid").drop("qid")
