"""Hierarchies: guards and canonical root paths of a poly-hierarchy, and walks to the root
of a single-parent forest.

Paths grow level by level from the roots by a join of the frontier with the edges, until
the frontier is empty: ids only, labels are joined afterwards. A node's canonical path is
the longest, then the least by ids; since a longest path extends its parent's longest
path, only the best path of each node need stay in the frontier of a level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.errors import CycleError
from tessera.operators.constraints import Constraint
from tessera.operators.scratch import kept


def guards(nodes: DataFrame, edges: DataFrame, group: str = "group") -> list[Constraint]:
    """Constraints on nodes (id, type, code, label) and edges (child, parent)."""
    ids = nodes.select(F.col("id").alias("__id"))
    roots = nodes.where((F.col("type") == group) & (F.length("code") == 1))
    with_parent = edges.select(F.col("child").alias("__c")).distinct()
    key = F.col("id").alias("key")
    blank = F.coalesce(F.trim("label"), F.lit("")) == ""
    coded = F.coalesce(F.trim("code"), F.lit("")) != ""
    return [
        Constraint("label not blank", nodes.where(blank).select(key)),
        Constraint("groups have codes, others none", nodes.where((F.col("type") == group) != coded).select(key)),
        Constraint("child exists", edges.join(ids, F.col("child") == F.col("__id"), "left_anti").select(F.col("child").alias("key"))),
        Constraint("parent exists", edges.join(ids, F.col("parent") == F.col("__id"), "left_anti").select(F.col("parent").alias("key"))),
        Constraint("roots have no parent", roots.join(with_parent, F.col("id") == F.col("__c"), "left_semi").select(key)),
        Constraint("others have a parent", nodes.join(roots.select(F.col("id").alias("__r")), F.col("id") == F.col("__r"), "left_anti").join(with_parent, F.col("id") == F.col("__c"), "left_anti").select(key)),
    ]


def on_cycles(edges: DataFrame) -> DataFrame:
    """id of the nodes that lie on a cycle or below one only: what is left when edges
    whose parents have no parents left are removed, level by level, until nothing goes."""
    left = edges.select("child", "parent").distinct()
    n, m = -1, left.count()
    while 0 < m != n:
        inner = left.select(F.col("child").alias("__c")).distinct()
        left = kept(left.join(inner, F.col("parent") == F.col("__c"), "left_semi"))
        n, m = m, left.count()
    return left.select(F.col("child").alias("id")).distinct()


def cycle_trail(edges: DataFrame) -> list[str]:
    """One cycle, from its least id up through the parents and back to it; none: empty.

    The edges left by on_cycles are cut from below too: what remains are cycles and what
    lies between two of them. The walk asks for one parent at a time."""
    some = kept(on_cycles(edges))
    left = edges.select("child", "parent").distinct()
    for end in ("child", "parent"):
        left = left.join(some.select(F.col("id").alias("__c")), F.col(end) == F.col("__c"), "left_semi")
    left = kept(left)
    n, m = -1, left.count()
    while 0 < m != n:
        outer = left.select(F.col("parent").alias("__p")).distinct()
        left = kept(left.join(outer, F.col("child") == F.col("__p"), "left_semi"))
        n, m = m, left.count()
    up = left.groupBy("child").agg(F.min("parent").alias("parent"))
    start = up.agg(F.min("child").alias("child")).first().child
    trail: list[str] = []
    while start is not None and start not in trail:
        trail.append(start)
        start = up.where(F.col("child") == start).first().parent
    if not trail:
        return []
    ring = trail[trail.index(start) :]
    low = ring.index(min(ring))
    return [*ring[low:], *ring[:low], ring[low]]


def canonical_paths(nodes: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """id and path (array of ids from the root to the node): the longest, ties to the
    least array. roots: column id. A node below a cycle raises CycleError."""
    links = edges.select("child", "parent").distinct()
    frontier = roots.select("id", F.array("id").alias("path"))
    levels = frontier
    while True:  # a path that goes on for ever meets a node twice
        grown = frontier.join(links, F.col("id") == F.col("parent")).select(F.col("child").alias("id"), F.concat("path", F.array("child")).alias("path"))
        # All paths of one level are equally long: the least is the level's best.
        frontier = kept(grown.groupBy("id").agg(F.min("path").alias("path")))
        if frontier.isEmpty():
            return levels.groupBy("id").agg(F.max_by("path", F.size("path")).alias("path"))
        if not frontier.where(F.size(F.array_distinct("path")) < F.size("path")).isEmpty():
            raise CycleError("a node is its own ancestor: " + " > ".join(cycle_trail(links)))
        levels = levels.unionByName(frontier)


def derived(paths: DataFrame, nodes: DataFrame, group: str = "group") -> DataFrame:
    """id, level, parent_id, terminal_id (last group above), major (code of the root),
    path_ids and path_text of the ancestors, without the node itself."""
    own = paths.select("id", F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))).alias("above"))
    steps = own.select("id", F.posexplode_outer("above").alias("pos", "node"))
    named = steps.join(nodes.select(F.col("id").alias("node"), "type", "code", "label"), "node", "left")
    made = named.groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "node", "type", "code", "label")))).alias("p"))
    groups = F.filter("p", lambda x: x["type"] == group)
    return made.select(
        "id",
        (F.size("p") + 1).cast("long").alias("level"),
        F.get("p", F.size("p") - 1)["node"].alias("parent_id"),
        F.get(groups, F.size(groups) - 1)["node"].alias("terminal_id"),
        F.get("p", F.lit(0))["code"].alias("major"),
        F.array_join(F.transform("p", lambda x: x["node"]), ">").alias("path_ids"),
        F.array_join(F.transform("p", lambda x: x["label"]), " > ").alias("path_text"),
    )


def walk_up(forest: DataFrame) -> DataFrame:
    """id, path (ids from the root) and state of each node of (id, name, parent_id): ok,
    missing (an ancestor isn't there or has no name) or cycle."""
    links = forest.select(F.col("id").alias("up"), F.col("parent_id").alias("next"), (F.coalesce(F.trim("name"), F.lit("")) != "").alias("named"))
    live = forest.select("id", F.array().cast("array<string>").alias("path"), F.col("id").cast("string").alias("at"))
    done = None
    while True:  # a walk ends at a root, at a gap, or where it has been
        step = live.join(links, F.col("at") == F.col("up").cast("string"), "left")
        step = kept(step.select(
            "id",
            F.concat(F.array("at"), F.col("path")).alias("path"),
            F.col("next").cast("string").alias("at"),
            F.when(F.array_contains("path", F.col("at")), "cycle").when(F.col("up").isNull() | ~F.col("named"), "missing").when(F.col("next").isNull(), "ok").alias("state"),
        ))
        ended = step.where("state IS NOT NULL").select("id", "path", "state")
        done = ended if done is None else done.unionByName(ended)
        live = step.where("state IS NULL").select("id", "path", "at")
        if live.isEmpty():
            return done
