"""Integrity constraints: each is a query for the rows that break it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import ConstraintError


@dataclass(frozen=True)
class Constraint:
    """name, and the breaking rows with a column `key` that names each."""

    name: str
    violations: DataFrame


def report(constraints: Iterable[Constraint], shown: int = 10) -> DataFrame:
    """constraint, n and the smallest `shown` keys of each broken constraint: all of them
    in one union, so one job. Keys are sliced from bounded heads, not from whole groups."""
    parts = [c.violations.select(F.lit(c.name).alias("constraint"), F.col("key").cast("string").alias("key")) for c in constraints]
    if not parts:
        raise ValueError("no constraints")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    counts = rows.groupBy("constraint").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("constraint").orderBy("key")
    heads = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= shown)
    heads = heads.groupBy("constraint").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    return counts.join(heads, "constraint")


def enforce(constraints: Iterable[Constraint]) -> None:
    """Raises ConstraintError with every broken constraint, its count and first keys."""
    broken = report(constraints).orderBy("constraint").collect()  # one row a constraint
    if broken:
        raise ConstraintError("; ".join(f"{r.constraint}: {r.n} ({', '.join(map(str, r['keys']))})" for r in broken))


def unique(df: DataFrame, *key: str, name: str | None = None) -> Constraint:
    """No two rows share the key."""
    rows = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return Constraint(name or f"unique {', '.join(key)}", rows.select(F.concat_ws("|", *key).alias("key")))


def not_blank(df: DataFrame, column: str, key: str) -> Constraint:
    return Constraint(f"{column} not blank", df.where(F.col(column).isNull() | (F.trim(column) == "")).select(F.col(key).alias("key")))


def in_domain(df: DataFrame, column: str, domain: Iterable[str], key: str) -> Constraint:
    return Constraint(f"{column} in domain", df.where(F.col(column).isNull() | ~F.col(column).isin(*domain)).select(F.col(key).alias("key")))


def references(df: DataFrame, column: str, target: DataFrame, target_key: str) -> Constraint:
    """Every value of the column exists in the target."""
    known = target.select(F.col(target_key).alias("__k")).distinct()
    rows = df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__k"), "left_anti")
    return Constraint(f"{column} references {target_key}", rows.select(F.col(column).alias("key")).distinct())


def sorted_array(df: DataFrame, column: str, key: str) -> Constraint:
    return Constraint(f"{column} sorted", df.where(~F.col(column).eqNullSafe(F.array_sort(column))).select(F.col(key).alias("key")))


def disjoint(df: DataFrame, a: str, b: str, key: str) -> Constraint:
    return Constraint(f"{a} and {b} disjoint", df.where(F.arrays_overlap(a, b)).select(F.col(key).alias("key")))


def subset(df: DataFrame, part: str, whole: str, key: str) -> Constraint:
    return Constraint(f"{part} within {whole}", df.where(F.size(F.array_except(part, whole)) > 0).select(F.col(key).alias("key")))


def equal_rows(a: DataFrame, b: DataFrame, key: str) -> Constraint:
    """Both sides have the same keys and equal rows under each."""
    columns = [c for c in a.columns if c != key]
    left = a.select(F.col(key).alias("__a"), F.struct(*columns).alias("__x"))
    right = b.select(F.col(key).alias("__b"), F.struct(*columns).alias("__y"))
    both = left.join(right, F.col("__a") == F.col("__b"), "full_outer")
    return Constraint(f"equal rows by {key}", both.where(~F.col("__x").eqNullSafe(F.col("__y"))).select(F.coalesce("__a", "__b").alias("key")))
