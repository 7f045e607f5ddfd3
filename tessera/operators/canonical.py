"""Canonical records: dedup, conditional sets, labels, category resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import ascii_key, consecutive_distinct
from tessera.operators.constraints import Constraint


def keep_latest(rows: DataFrame, key: str, date: str, position: str) -> DataFrame:
    """Of each key's rows the one with the largest date, the earlier one on a tie."""
    best = F.struct(F.col(date), -F.col(position))
    named = F.struct(*rows.columns)
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(named, best).alias("__r")).select("__r.*")


def conflicts(rows: DataFrame, key: str, date: str, *ignored: str) -> DataFrame:
    """Keys (and their numbers of variants) whose rows differ in more than the date."""
    rest = [c for c in rows.columns if c not in (key, date, *ignored)]
    return rows.groupBy(key).agg(F.count_distinct(F.struct(*rest)).alias("variants")).where("variants > 1")


def conditional_sets(rows: DataFrame, key: str, kind: str, value: str, kinds: dict[str, str]) -> DataFrame:
    """key and, for each output column of kinds (column -> kind), the sorted set of values
    of that kind; kinds are compared in lower case."""
    sets = [F.array_sort(F.collect_set(F.when(F.lower(kind) == k.lower(), F.col(value)))).alias(c) for c, k in kinds.items()]
    return rows.groupBy(key).agg(*sets)


def disjoint_sets(sets: DataFrame, key: str, a: str, b: str) -> Constraint:
    return Constraint(f"{a} and {b} disjoint", sets.where(F.arrays_overlap(a, b)).select(F.col(key).alias("key")))


def dedup_labels(rows: DataFrame, owner: str, kind: str, position: str, label: str, key: Column | None = None) -> DataFrame:
    """owner, kind, label, key: labels with one key once an owner, by precedence preferred,
    alternative, hidden and then position; blank keys vanish."""
    rank = F.when(F.col(kind) == "preferred", 0).when(F.col(kind) == "alternative", 1).otherwise(2)
    rows = rows.withColumn("__key", ascii_key(F.col(label)) if key is None else key).where("__key <> ''")
    first = F.struct(rank.alias("r"), F.col(position).alias("p"))
    return rows.groupBy(F.col(owner), F.col("__key").alias("key")).agg(F.min_by(F.struct(kind, label), first).alias("x")).select(owner, f"x.{kind}", f"x.{label}", "key")


def left_share(rows: DataFrame, shares: DataFrame, key: str, share: str) -> DataFrame:
    """rows with share: a number in [0, 1] rounded to 6 digits, null where there is none."""
    value = F.expr(f"try_cast({share} AS double)")
    clean = shares.where(F.trim(F.col(share).cast("string")) != "").select(F.col(key).alias("__k"), F.round(value, 6).alias("green_share"))
    return rows.join(clean, F.col(key) == F.col("__k"), "left").drop("__k")


def bad_shares(shares: DataFrame, key: str, share: str) -> Constraint:
    value = F.expr(f"try_cast({share} AS double)")
    bad = shares.where((F.trim(F.col(share).cast("string")) != "") & (value.isNull() | (value < 0) | (value > 1)))
    return Constraint(f"{share} in [0, 1]", bad.select(F.col(key).alias("key")))


def declared_ids(*levels: Column) -> Column:
    """Declared ids from the top: trimmed, blanks dropped first, then consecutive repeats."""
    texts = F.array(*[F.trim(x.cast("string")) for x in levels])
    return consecutive_distinct(F.filter(texts, lambda x: x.isNotNull() & (x != "")))


def resolve_categories(observed: DataFrame, walks: DataFrame, names: DataFrame, it_root: str) -> DataFrame:
    """Three layers of a category: observed, declared (ids on the row) and canonical (the
    walk from its key), with conflict flags and the route it, secondary or unresolved.

    observed: row_id, key, name, level1, level2, level3; walks: id, path, state; names: id,
    name. declared_root is the first declared id, known or not."""
    own = observed.withColumn("ids", declared_ids(F.col("level1"), F.col("level2"), F.col("level3")))
    known = names.select(F.col("id").cast("string").alias("__n"), F.col("name").alias("__name"))
    steps = own.select("row_id", F.posexplode_outer("ids").alias("pos", "declared"))
    met = steps.join(known, F.col("declared") == F.col("__n"), "left").where("pos IS NOT NULL")
    found = met.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("pos", "declared", "__name"))).alias("d"))
    walked = walks.select(F.col("id").cast("string").alias("__w"), "path", "state")
    rows = own.join(found, "row_id", "left").join(walked, F.trim(F.col("key").cast("string")) == F.col("__w"), "left")
    ok = F.coalesce(F.col("state") == "ok", F.lit(False))
    declared_root = F.get("ids", F.lit(0))
    canonical_root = F.when(ok, F.get("path", F.lit(0)))
    last = F.get("d", F.size("d") - 1)["__name"]
    level3 = F.nullif(F.trim(F.col("level3").cast("string")), F.lit(""))
    route = F.when(~ok, "unresolved").when(declared_root == it_root, "it").otherwise("secondary")
    return rows.select(
        "row_id",
        declared_root.alias("declared_root"),
        canonical_root.alias("canonical_root"),
        F.array_join(F.transform(F.filter("d", lambda x: x["__name"].isNotNull()), lambda x: x["__name"]), " > ").alias("declared_path"),
        F.when(ok, F.array_join("path", ">")).alias("canonical_path"),
        F.size(F.filter("d", lambda x: x["__name"].isNull())).cast("long").alias("unknown_ids"),
        F.coalesce(last, F.col("name")).alias("terminal_label"),
        F.coalesce(declared_root != canonical_root, F.lit(False)).alias("root_conflict"),
        F.coalesce(level3 != F.trim(F.col("key").cast("string")), F.lit(False)).alias("terminal_conflict"),
        route.alias("route"),
    )


def one_to_one(rows: DataFrame, name: str, id_col: str) -> DataFrame:
    """name, id, n_ids: a lookup by name; n_ids over 1 names what is ambiguous."""
    return rows.groupBy(name).agg(F.min(id_col).alias("id"), F.count_distinct(id_col).alias("n_ids"))


def path_conflicts(rows: DataFrame, group: str, label: str, path: str) -> DataFrame:
    """group, outer, inner: pairs of one group where a label is a step of another's path.
    Steps are exploded and joined by equality, so a group's pairs are never all made."""
    steps = rows.select(F.col(group).alias("g"), F.col(label).alias("inner"), F.explode(F.transform(F.split(path, ">"), F.trim)).alias("outer"))
    names = rows.select(F.col(group).alias("g"), F.col(label).alias("outer")).distinct()
    return steps.join(names, ["g", "outer"]).where("outer <> inner").select("g", "outer", "inner").distinct()


def coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key and side (both, left, right) of every key of either side."""
    x = a.select(F.col(key).alias("__a")).distinct()
    y = b.select(F.col(key).alias("__b")).distinct()
    side = F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").otherwise("both")
    return x.join(y, F.col("__a") == F.col("__b"), "full_outer").select(F.coalesce("__a", "__b").alias(key), side.alias("side"))


def first_per_group(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, with rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")).where(F.col("rank") <= k)
