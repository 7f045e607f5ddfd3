"""Gold labels: adjudication, audit, titles and labelling context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.errors import ConstraintError
from tessera.operators import constraints as ct
from tessera.operators.canonical import one_to_one
from tessera.operators.retrieval import sized

MISSING = "??MISSING??"


def adjudicate(gold: DataFrame, overrides: DataFrame, names: DataFrame) -> DataFrame:
    """gold (job_id, accepted, primary: arrays of ids) with the accepted ids of overrides
    (job_id, labels: array of names) in place of its own; primary ids that aren't accepted
    any more drop out. A name must have exactly one id in names (label, id)."""
    asked = overrides.select("job_id", F.posexplode("labels").alias("pos", "label"))
    found = asked.join(one_to_one(names, "label", "id"), "label", "left")
    bad = found.where("n_ids IS NULL OR n_ids <> 1").select("label").distinct().limit(10).collect()
    if bad:
        raise ConstraintError(f"labels without exactly one id: {', '.join(sorted(r.label for r in bad))}")
    new = found.groupBy("job_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("__new"))
    rows = gold.join(new, "job_id", "left").withColumn("accepted", F.coalesce("__new", "accepted")).drop("__new")
    return rows.withColumn("primary", F.array_intersect("primary", "accepted"))


def gold_constraints(gold: DataFrame, jobs: DataFrame, concepts: DataFrame) -> list[ct.Constraint]:
    """Gold rows (job_id, accepted, primary): one a job, of known jobs and concepts, with
    different labels, and primary ones among the accepted."""
    ids = gold.select("job_id", F.explode("accepted").alias("id"))
    repeated = gold.where(F.size(F.array_distinct("accepted")) < F.size("accepted")).select(F.col("job_id").alias("key"))
    return [ct.unique(gold, "job_id"), ct.references(gold, "job_id", jobs, "job_id"), ct.references(ids, "id", concepts, "id"), ct.subset(gold, "primary", "accepted", "job_id"), ct.Constraint("labels differ", repeated)]


def audit(gold: DataFrame) -> DataFrame:
    """One row: rows, rows without labels, labels, different ids."""
    whole = gold.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("accepted") == 0).alias("empty"), F.sum(F.size("accepted")).alias("labels"))
    ids = gold.select(F.explode("accepted").alias("id")).agg(F.count_distinct("id").alias("ids"))
    return whole.join(F.broadcast(ids))  # one row each


def titles(gold: DataFrame, concepts: DataFrame) -> DataFrame:
    """job_id and the accepted concepts' labels in order, MISSING where there is none."""
    ids = gold.select("job_id", F.posexplode_outer("accepted").alias("pos", "id"))
    named = ids.join(sized(concepts.select("id", "label")), "id", "left")
    item = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("label", F.lit(MISSING)).alias("t")))
    return named.groupBy("job_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), "; ").alias("titles"))


def first_source(*sources: DataFrame) -> DataFrame:
    """The first of some tables that has any row: a later one counts only if all before
    it are empty."""
    for s in sources[:-1]:
        if not s.isEmpty():
            return s
    return sources[-1]


def context(candidates: DataFrame, concepts: DataFrame, chars: int = 600) -> DataFrame:
    """candidates with a concept's label and the beginning of its description, or else
    its definition, or else its scope note."""
    text = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in ("description", "definition", "scope_note")])
    return candidates.join(concepts.select("id", "label", F.left(text, F.lit(chars)).alias("about")), "id", "left")


def show(rows: DataFrame, title: str, job_id: str, asked: str, limit: int = 10) -> DataFrame:
    """Rows of a job id made of digits, or else with the asked text in the title."""
    on: Column = F.col(job_id).cast("string").endswith(asked) if asked.isdigit() else F.contains(F.lower(title), F.lit(asked.lower()))
    return rows.where(on).orderBy(job_id).limit(limit)


def without_instruction(text: Column) -> Column:
    """A query without its first line and the word before it, where it has an instruction."""
    return F.regexp_replace(text, r"^(?s)[^\n]*\nQuery: ", "")
