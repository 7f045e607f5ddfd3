"""The concept index: package -> canonical records -> checks -> vectors -> verified build."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import ConstraintError, SourceError
from tessera.functions import text as tx
from tessera.functions.encoders import encode_column
from tessera.functions.text import label_key_of
from tessera.operators import canonical as cn
from tessera.operators import constraints as ct
from tessera.operators import documents as dc
from tessera.operators import hierarchy as hi
from tessera.operators import retrieval as rt
from tessera.operators.scratch import checkpointed, kept
from tessera.plans.build import Build, fingerprint, layered
from tessera.sources.package import Package, collection_uris, load_package, profile
from tessera.sources.store import at

VERSION = 1
STAGES = ("records", "validate", "labels", "semantic", "lexical", "verify")
#: Domains of the source.
STATUSES = ("released", "obsolete")
RELATIONS = ("essential", "optional")
SKILL_TYPES = ("skill/competence", "knowledge", "")
DEFAULTS = {"encoder": "hash", "language": "en", "version": "1.2.0"}


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deduplicates each row's labels by key: alternatives against the preferred one,
    hidden ones against both; sorted by key, the first spelling stays."""
    for batch in batches:
        alternatives, hidden = [], []
        for preferred, a, h in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            met = {label_key_of(preferred or "")}
            for given, out in ((a, alternatives), (h, hidden)):
                own: dict[str, str] = {}
                for label in given or []:
                    key = label_key_of(label)
                    if key and key not in met:
                        own.setdefault(key, label)
                met |= own.keys()
                out.append([own[k] for k in sorted(own)])
        texts = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(alternatives, texts), pa.array(hidden, texts)], ["uri", "alternative_labels", "hidden_labels"])


def released(package: Package) -> DataFrame:
    """Occupations, one row a URI (the latest), with the source's guards enforced."""
    rows = package.tables["occupations"]
    rows = rows.withColumns({"conceptUri": F.trim("conceptUri"), "status": F.lower(F.trim("status"))})
    differing = cn.conflicts(rows.drop("_row"), "conceptUri", "modifiedDate")
    malformed = rows.where(tx.id_of_uri(F.col("conceptUri")).isNull()).select(F.col("conceptUri").alias("key"))
    ct.enforce(
        [
            ct.not_blank(rows, "conceptUri", "_row"),
            ct.Constraint("conceptUri well-formed", malformed),
            ct.Constraint("repeated rows agree", differing.select(F.col("conceptUri").alias("key"))),
            ct.in_domain(rows, "status", STATUSES, "conceptUri"),
        ]
    )
    return cn.keep_latest(rows, "conceptUri", "modifiedDate", "_row").drop("_row")


def nodes_and_edges(package: Package, occupations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups and all occupations, obsolete ones too, and the distinct broader edges."""
    groups = package.tables["groups"].select(F.trim("conceptUri").alias("id"), F.lit("group").alias("type"), F.trim("code").alias("code"), F.trim("preferredLabel").alias("label"))
    own = occupations.select(F.col("conceptUri").alias("id"), F.lit("occupation").alias("type"), F.lit(None).cast("string").alias("code"), F.trim("preferredLabel").alias("label"))
    edges = package.tables["broader"].select(F.trim("conceptUri").alias("child"), F.trim("broaderUri").alias("parent")).distinct()
    return groups.unionByName(own), edges


def records(spark: SparkSession, package: Package, settings: dict) -> DataFrame:
    """Canonical records of released occupations."""
    occupations = kept(released(package))
    nodes, edges = nodes_and_edges(package, occupations)
    nodes = kept(nodes)
    ct.enforce([*hi.guards(nodes, edges), ct.unique(nodes, "id")])
    roots = nodes.where("type = 'group' AND length(code) = 1")
    paths = hi.canonical_paths(nodes, edges, roots)
    placed = hi.derived(paths, nodes)
    relations = package.tables["skills"].select(F.trim("occupationUri").alias("uri"), F.lower(F.trim("relationType")).alias("kind"), F.trim("skillType").alias("skill_type"), F.trim("skillUri").alias("skill"), "_row")
    bad_skill = relations.where(tx.id_of_uri(F.col("skill"), "skill").isNull()).select(F.col("_row").alias("key"))
    guards = [ct.in_domain(relations, "kind", RELATIONS, "_row"), ct.in_domain(relations, "skill_type", SKILL_TYPES, "_row"), ct.Constraint("skill URI well-formed", bad_skill), ct.references(relations, "uri", occupations, "conceptUri")]
    if "shares" in package.tables:
        guards.append(cn.bad_shares(package.tables["shares"], "conceptUri", "greenShare"))
    members = collection_uris(package.tables["research"]).withColumnRenamed("conceptUri", "uri") if "research" in package.tables else None
    if members is not None:
        known = nodes.select(F.col("id").alias("uri"))
        guards.append(ct.Constraint("research members exist", members.join(known, "uri", "left_anti").select(F.col("uri").alias("key"))))
    ct.enforce(guards)
    skills = cn.conditional_sets(relations, "uri", "kind", "skill", {"essential_skills": "essential", "optional_skills": "optional"})
    none = F.array().cast("array<string>")
    opt = lambda c: tx.clean_optional(F.col(c)) if c in occupations.columns else F.lit(None).cast("string")
    rows = occupations.where("status = 'released'").select(
        F.col("conceptUri").alias("uri"), tx.id_of_uri(F.col("conceptUri")).alias("id"), F.lit(settings["version"]).alias("version"), F.trim("conceptType").alias("concept_type"),
        F.trim("iscoGroup").alias("isco_group"), F.trim("code").alias("code"), "status", F.to_timestamp("modifiedDate").alias("modified_at"), tx.clean_optional(F.col("preferredLabel")).alias("preferred_label"),
        tx.split_labels(F.col("altLabels")).alias("__alt"), tx.split_labels(F.col("hiddenLabels")).alias("__hidden"),
        opt("description").alias("description"), opt("definition").alias("definition"), opt("scopeNote").alias("scope_note"), opt("regulatedProfessionNote").alias("regulated_profession_note"), opt("naceCode").alias("nace_code"),
    )
    labels = rows.select("uri", "preferred_label", "__alt", "__hidden").mapInArrow(_labels, "uri string, alternative_labels array<string>, hidden_labels array<string>")
    rows = rows.drop("__alt", "__hidden").join(labels, "uri").join(placed.withColumnRenamed("id", "uri"), "uri", "left").join(skills, "uri", "left")
    rows = rows.withColumns({c: F.coalesce(c, none) for c in ("essential_skills", "optional_skills")})
    if "shares" in package.tables:
        shares = package.tables["shares"].groupBy(F.trim("conceptUri").alias("uri")).agg(F.max_by("greenShare", "_row").alias("share"))
        rows = cn.left_share(rows, shares, "uri", "share")
    else:
        rows = rows.withColumn("green_share", F.lit(None).cast("double"))
    member = F.lit(False)
    if members is not None:
        rows = rows.join(members.withColumn("__m", F.lit(True)), "uri", "left")
        member = F.coalesce("__m", F.lit(False))
    rows = rows.withColumn("collections", F.when(member, F.array(F.lit("research"))).otherwise(none)).drop("__m")
    rows = rows.withColumns({"source_language": F.lit(settings["language"]), "source_files": F.lit(sorted(package.tables))})
    return rows.withColumn("content_hash", tx.content_hash(*rows.columns))


def record_constraints(rows: DataFrame) -> list[ct.Constraint]:
    """Invariants of canonical records."""
    broken = lambda name, on: ct.Constraint(name, rows.where(on).select(F.col("uri").alias("key")))
    parts = [c for c in rows.columns if c != "content_hash"]
    return [
        ct.unique(rows, "uri"),
        ct.unique(rows, "id"),
        ct.not_blank(rows, "preferred_label", "uri"),
        ct.not_blank(rows, "concept_type", "uri"),
        ct.disjoint(rows, "essential_skills", "optional_skills", "uri"),
        ct.sorted_array(rows, "essential_skills", "uri"),
        ct.sorted_array(rows, "optional_skills", "uri"),
        broken("id is the URI's", ~F.col("id").eqNullSafe(tx.id_of_uri(F.col("uri")))),
        broken("has a path and a root", F.coalesce("level", F.lit(0)).cast("int") < 2),
        broken("root is one character", F.length(F.coalesce("major", F.lit(""))) != 1),
        broken("not its own ancestor", F.array_contains(F.split("path_ids", ">"), F.col("uri"))),
        broken("labels without line ends", F.exists(F.concat(F.array("preferred_label"), "alternative_labels", "hidden_labels"), lambda x: x.rlike(r"[\r\n]"))),
        broken("share in range", (F.col("green_share") < 0) | (F.col("green_share") > 1) | (F.round("green_share", 6) != F.col("green_share"))),
        broken("hash recomputes", ~F.col("content_hash").eqNullSafe(tx.content_hash(*parts))),
    ]


def statistics(rows: DataFrame) -> dict:
    """Counts by major and collection, and sizes of the arrays."""
    arrays = ("alternative_labels", "hidden_labels", "essential_skills", "optional_skills")
    sizes = [f(F.size(c)).alias(f"{name}_{c}") for c in arrays for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("description", "definition", "scope_note", "nace_code", "green_share")]
    whole = rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.array_contains("collections", "research")).alias("research"), *sizes, *nulls).first().asDict()
    whole["by_major"] = {r.major: r["count"] for r in rows.groupBy("major").count().collect()}
    return whole


def label_variants(rows: DataFrame) -> DataFrame:
    """(id, label, hidden): preferred and alternative labels, and hidden ones flagged."""
    open_ = rows.select("id", F.explode(F.concat(F.array("preferred_label"), "alternative_labels")).alias("label"), F.lit(False).alias("hidden"))
    return open_.unionByName(rows.select("id", F.explode("hidden_labels").alias("label"), F.lit(True).alias("hidden")))


def build_index(spark: SparkSession, source: str, work: str, settings: dict | None = None, until: str = "verify") -> Build:
    """The stages up to `until`; what is there and intact is kept. Only a build with all of
    them is verified and can be promoted."""
    settings = DEFAULTS | (settings or {})
    wanted = STAGES[: STAGES.index(until) + 1]
    checkpointed(spark)
    package = load_package(spark, source)
    layers = layered([("records", [VERSION, package.checksum, settings["version"], settings["language"]]), ("vectors", settings["encoder"])])
    prints = {s: layers["records"] for s in ("records", "validate", "lexical")} | {s: layers["vectors"] for s in ("labels", "semantic", "verify")}
    build = Build(at(work) / fingerprint(layers), STAGES, prints)
    rows = build.table(spark, "records", lambda: records(spark, package, settings))

    def validate() -> dict:
        ct.enforce(record_constraints(rows))
        return {"source": profile(package), "statistics": statistics(rows)}

    if "validate" in wanted and build.state("validate") != "completed":
        build.step("validate", validate, ["records"])
    if "lexical" not in wanted:
        return build
    variants = label_variants(rows)
    build.table(spark, "labels", lambda: encoded_labels(variants.where("NOT hidden"), settings["encoder"]), ["validate"])
    text = dc.semantic_text(F.col("preferred_label"), F.col("description"), F.col("definition"), F.col("scope_note"), F.col("path_text"))
    build.table(spark, "semantic", lambda: encode_column(rows.withColumn("text", text), "id", "text", settings["encoder"]), ["validate"])
    lexical = rows.select("id", F.array_join(F.concat(F.array("preferred_label"), "alternative_labels", "hidden_labels"), "\n").alias("text"))
    build.table(spark, "lexical", lambda: lexical, ["validate"])
    if "verify" in wanted and build.state("verify") != "completed":
        build.step("verify", lambda: verify(spark, build), ["labels", "semantic", "lexical"])
    return build


def encoded_labels(variants: DataFrame, encoder: str) -> DataFrame:
    """(id, label, vec): each distinct label is encoded once."""
    vectors = encode_column(variants.select("label").distinct(), "label", "label", encoder).withColumnRenamed("id", "label")
    return variants.join(vectors, "label").select("id", "label", "vec")


def verify(spark: SparkSession, build: Build) -> dict:
    """Every record has each vector table's rows, with unit vectors, and nothing else."""
    rows = build.read(spark, "records")
    counts = {}
    for name in ("labels", "semantic", "lexical"):
        table = build.read(spark, name)
        odd = cn.coverage(rows, table, "id").where("side <> 'both'").limit(10).collect()
        if odd:
            raise ConstraintError(f"{name}: ids {', '.join(r.id for r in odd)} are missing or unknown")
        if "vec" in table.columns and not rt.norm_report(table).where("NOT ok").isEmpty():
            raise ConstraintError(f"{name}: vectors of another length than 1")
        counts[name] = table.count()
    if not rows.count():
        raise SourceError("no released records")
    return counts
