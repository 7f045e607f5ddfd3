"""Registered queries of records, constraints, hierarchies, texts and statistics.

Customers stand for concepts of a hierarchy (region > nation > customer), parts for
concepts of postings (orders), events and documents for raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import canonical as cn
from tessera.operators import constraints as ct
from tessera.operators import documents as dc
from tessera.operators import evaluate as ev
from tessera.operators import hierarchy as hi
from tessera.operators import labels as lb
from tessera.plans.registry import register
from tessera.plans.retrieval_queries import table

SPACE = r"[\s\x1c-\x1f]"

# ------------------------------------------------------------------- hierarchy


def tree(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """nodes (id, type, code, label) and edges (child, parent): regions, their nations and
    customers. Every tenth customer also hangs under its region, a second, shorter path."""
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    name = lambda kind, key: F.concat(F.lit(kind), F.lpad(F.col(key).cast("string"), 10, "0"))
    nodes = r.select(name("r", "r_regionkey").alias("id"), F.lit("group").alias("type"), F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("label"))
    nodes = nodes.union(n.select(name("n", "n_nationkey"), F.lit("group"), F.concat(F.lit("00"), F.col("n_nationkey").cast("string")), "n_name"))
    nodes = nodes.union(c.select(name("c", "c_custkey"), F.lit("occupation"), F.lit(None).cast("string"), "c_name"))
    edges = n.select(name("n", "n_nationkey").alias("child"), name("r", "n_regionkey").alias("parent"))
    edges = edges.union(c.select(name("c", "c_custkey"), name("n", "c_nationkey")))
    more = c.where("c_custkey % 10 = 0").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return nodes, edges.union(more.select(name("c", "c_custkey"), name("r", "n_regionkey")))


TREE = """nodes AS (SELECT 'r' || lpad(CAST(r_regionkey AS VARCHAR), 10, '0') AS id, 'group' AS type, CAST(r_regionkey AS VARCHAR) AS code, r_name AS label FROM region
  UNION ALL SELECT 'n' || lpad(CAST(n_nationkey AS VARCHAR), 10, '0'), 'group', '00' || n_nationkey, n_name FROM nation
  UNION ALL SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 'occupation', NULL, c_name FROM customer),
edges AS (SELECT 'n' || lpad(CAST(n_nationkey AS VARCHAR), 10, '0') AS child, 'r' || lpad(CAST(n_regionkey AS VARCHAR), 10, '0') AS parent FROM nation
  UNION ALL SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 'n' || lpad(CAST(c_nationkey AS VARCHAR), 10, '0') FROM customer
  UNION ALL SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 'r' || lpad(CAST(n_regionkey AS VARCHAR), 10, '0')
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 = 0)"""


@register("hierarchy_paths", "WITH RECURSIVE " + TREE + """,
p AS (SELECT id, [id] AS path FROM nodes WHERE type = 'group' AND length(code) = 1
  UNION ALL SELECT child, list_append(path, child) FROM p JOIN edges ON parent = id),
b AS (SELECT id, path FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY len(path) DESC, path) AS k FROM p) WHERE k = 1),
s AS (SELECT id, len(path) AS n, unnest(path) AS node, generate_subscripts(path, 1) AS pos FROM b),
j AS (SELECT s.*, type, code, label FROM s JOIN nodes ON nodes.id = node)
SELECT id, max(n) AS level, any_value(node) FILTER (WHERE pos = n - 1) AS parent_id,
  arg_max(node, pos) FILTER (WHERE pos < n AND type = 'group') AS terminal_id, any_value(code) FILTER (WHERE pos = 1 AND pos < n) AS major,
  coalesce(string_agg(node, '>' ORDER BY pos) FILTER (WHERE pos < n), '') AS path_ids,
  coalesce(string_agg(label, ' > ' ORDER BY pos) FILTER (WHERE pos < n), '') AS path_text FROM j GROUP BY id""")
def hierarchy_paths(spark, sf_dir):
    nodes, edges = tree(spark, sf_dir)
    roots = nodes.where("type = 'group' AND length(code) = 1")
    return hi.derived(hi.canonical_paths(nodes, edges, roots), nodes)


@register("hierarchy_guards", "WITH " + TREE + """,
v AS (SELECT 'label not blank' AS c, id FROM nodes WHERE trim(coalesce(label, '')) = ''
  UNION ALL SELECT 'groups have codes, others none', id FROM nodes WHERE (type = 'group') <> (trim(coalesce(code, '')) <> '')
  UNION ALL SELECT 'child exists', child FROM edges WHERE child NOT IN (SELECT id FROM nodes)
  UNION ALL SELECT 'parent exists', parent FROM edges WHERE parent NOT IN (SELECT id FROM nodes)
  UNION ALL SELECT 'roots have no parent', id FROM nodes WHERE type = 'group' AND length(code) = 1 AND id IN (SELECT child FROM edges)
  UNION ALL SELECT 'others have a parent', id FROM nodes WHERE NOT (type = 'group' AND length(coalesce(code, '')) = 1) AND id NOT IN (SELECT child FROM edges))
SELECT c AS "constraint", count(*) AS n FROM v GROUP BY c""")
def hierarchy_guards(spark, sf_dir):
    nodes, edges = tree(spark, sf_dir)
    return ct.report(hi.guards(nodes, edges)).select("constraint", "n")


@register("category_resolve", """WITH RECURSIVE f AS (SELECT 'R' || r_regionkey AS id, r_name AS name, CAST(NULL AS VARCHAR) AS parent FROM region
  UNION ALL SELECT 'N' || n_nationkey, n_name, 'R' || n_regionkey FROM nation),
w AS (SELECT id AS node, id AS up, parent AS next, id AS path, name FROM f UNION ALL
  SELECT w.node, f.id, f.parent, f.id || '>' || w.path, w.name FROM w JOIN f ON f.id = w.next),
p AS (SELECT node, path FROM w WHERE next IS NULL),
o AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 97 = 0 THEN 'N999' ELSE 'N' || c_nationkey END AS key, c_name AS name,
  'R' || (c_custkey % 6) AS l1, 'R' || (c_custkey % 6) AS l2, 'N' || CASE WHEN c_custkey % 5 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS l3 FROM customer)
SELECT row_id, l1 AS declared_root, split_part(path, '>', 1) AS canonical_root,
  concat_ws(' > ', a.name, b.name) AS declared_path, path AS canonical_path,
  CAST(a.name IS NULL AS BIGINT) + CAST(b.name IS NULL AS BIGINT) AS unknown_ids, coalesce(b.name, o.name) AS terminal_label,
  coalesce(l1 <> split_part(path, '>', 1), false) AS root_conflict, l3 <> key AS terminal_conflict,
  CASE WHEN path IS NULL THEN 'unresolved' WHEN l1 = 'R1' THEN 'it' ELSE 'secondary' END AS route
FROM o LEFT JOIN p ON p.node = o.key LEFT JOIN f a ON a.id = l1 LEFT JOIN f b ON b.id = l3""")
def category_resolve(spark, sf_dir):
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    forest = r.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_id"))
    forest = forest.union(n.select(F.concat(F.lit("N"), "n_nationkey"), "n_name", F.concat(F.lit("R"), "n_regionkey")))
    root = F.concat(F.lit("R"), F.col("c_custkey") % 6)
    observed = c.select(
        F.col("c_custkey").alias("row_id"),
        F.when(F.col("c_custkey") % 97 == 0, "N999").otherwise(F.concat(F.lit("N"), "c_nationkey")).alias("key"),
        F.col("c_name").alias("name"),
        root.alias("level1"),
        root.alias("level2"),
        F.concat(F.lit("N"), F.when(F.col("c_custkey") % 5 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))).alias("level3"),
    )
    return cn.resolve_categories(observed, hi.walk_up(forest), forest.select("id", "name"), "R1")


# --------------------------------------------------------------------- records


@register("dedup_latest", """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders) WHERE k = 1""")
def dedup_latest(spark, sf_dir):
    return cn.keep_latest(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@register("dedup_conflicts", """SELECT user_id, count(DISTINCT event_type) AS variants FROM events WHERE event_type IS NOT NULL
GROUP BY user_id HAVING count(DISTINCT event_type) > 1""")
def dedup_conflicts(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("event_type IS NOT NULL").select("user_id", "event_type", "ts")
    return cn.conflicts(rows, "user_id", "ts")


@register("conditional_sets", """SELECT l_partkey, coalesce(array_to_string(list(DISTINCT l_linestatus ORDER BY l_linestatus) FILTER (WHERE lower(l_returnflag) = 'a'), ','), '') AS essential,
  coalesce(array_to_string(list(DISTINCT l_linestatus ORDER BY l_linestatus) FILTER (WHERE lower(l_returnflag) = 'n'), ','), '') AS optional,
  coalesce(bool_or(lower(l_returnflag) = 'a' AND l_linestatus IN (SELECT l_linestatus FROM lineitem x WHERE x.l_partkey = lineitem.l_partkey AND lower(x.l_returnflag) = 'n')), false) AS overlap
FROM lineitem GROUP BY l_partkey""")
def conditional_sets(spark, sf_dir):
    sets = cn.conditional_sets(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", "l_linestatus", {"essential": "A", "optional": "N"})
    return sets.select("l_partkey", F.array_join("essential", ",").alias("essential"), F.array_join("optional", ",").alias("optional"), F.arrays_overlap("essential", "optional").alias("overlap"))


@register("membership_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def membership_semi(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(orders, "c_custkey", "left_semi").select("c_custkey", "c_name")


@register("referential_anti", "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def referential_anti(spark, sf_dir):
    broken = ct.references(table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey")
    return broken.violations.select(F.col("key").cast("string").alias("key"))


@register("share_left_join", """SELECT p_partkey, round(s, 6) AS green_share FROM part LEFT JOIN (
  SELECT l_partkey, avg(l_discount) AS s FROM lineitem GROUP BY l_partkey HAVING count(*) > 20) ON l_partkey = p_partkey""")
def share_left_join(spark, sf_dir):
    shares = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.avg("l_discount").alias("share"), F.count(F.lit(1)).alias("n")).where("n > 20")
    return cn.left_share(table(spark, sf_dir, "part").select("p_partkey"), shares, "p_partkey", "share").select("p_partkey", "green_share")


@register("lookup_unique", "SELECT p_name, min(p_partkey) AS id, count(DISTINCT p_partkey) AS n_ids FROM part GROUP BY p_name")
def lookup_unique(spark, sf_dir):
    return cn.one_to_one(table(spark, sf_dir, "part"), "p_name", "p_partkey")


@register("theta_self_join", """WITH a AS (SELECT p_brand AS g, p_name AS label, p_type || '>' || p_name AS path FROM part)
SELECT DISTINCT x.g, x.label AS "outer", y.label AS "inner" FROM a x JOIN a y ON x.g = y.g AND x.label <> y.label
AND list_contains(list_transform(string_split(y.path, '>'), lambda s: trim(s)), x.label)
UNION SELECT DISTINCT x.g, x.label, y.label FROM (SELECT p_brand AS g, p_type AS label FROM part) x JOIN a y ON x.g = y.g AND list_contains(string_split(y.path, '>'), x.label) WHERE x.label <> y.label""")
def theta_self_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    path = F.concat_ws(">", "p_type", "p_name")
    rows = p.select(F.col("p_brand").alias("g"), F.col("p_name").alias("label"), path.alias("path"))
    types = p.select(F.col("p_brand").alias("g"), F.col("p_type").alias("label"), F.lit(None).cast("string").alias("path"))
    return cn.path_conflicts(rows.union(types), "g", "label", "path")


@register("coverage_full_outer", """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left' WHEN d.doc_id IS NULL THEN 'right' ELSE 'both' END AS side
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def coverage_full_outer(spark, sf_dir):
    return cn.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@register("payload_equality", """SELECT 'equal rows by doc_id' AS "constraint", count(*) AS n FROM documents WHERE n_chars IS DISTINCT FROM length(text) HAVING count(*) > 0""")
def payload_equality(spark, sf_dir):
    stored = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    made = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    return ct.report([ct.equal_rows(stored, made, "doc_id")]).select("constraint", "n")


# ----------------------------------------------------------------------- texts

KEY = "trim(regexp_replace(lower({}), '[\\s\\x1c-\\x1f]+', ' ', 'g'))"


@register("label_normalize", f"""SELECT p_partkey AS id, {KEY.format("' ' || p_brand || chr(9) || '  ' || p_name || chr(10)")} AS key FROM part""")
def label_normalize(spark, sf_dir):
    raw = F.concat(F.lit(" "), "p_brand", F.lit("\t  "), "p_name", F.lit("\n"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), tx.ascii_key(raw).alias("key"))


@register("label_dedup", f"""SELECT owner, kind, label, key FROM (SELECT *, row_number() OVER (PARTITION BY owner, key ORDER BY r, pos) AS k FROM (
  SELECT p_brand AS owner, CASE p_partkey % 3 WHEN 0 THEN 'preferred' WHEN 1 THEN 'alternative' ELSE 'hidden' END AS kind, p_partkey % 3 AS r, p_partkey AS pos,
    CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS label, {KEY.format('p_name')} AS key FROM part)) WHERE k = 1 AND key <> ''""")
def label_dedup(spark, sf_dir):
    kind = F.when(F.col("p_partkey") % 3 == 0, "preferred").when(F.col("p_partkey") % 3 == 1, "alternative").otherwise("hidden")
    label = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("owner"), kind.alias("kind"), F.col("p_partkey").alias("pos"), label.alias("label"))
    return cn.dedup_labels(rows, "owner", "kind", "pos", "label")


@register("alias_filter", f"""SELECT DISTINCT p_brand AS owner, {KEY.format('p_name')} AS key FROM part
WHERE {KEY.format('p_name')} IN (SELECT {KEY.format('p_name')} FROM part WHERE p_partkey IN (SELECT item_id FROM benchmark))""")
def alias_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("owner"), tx.ascii_key(F.col("p_name")).alias("key"))
    wanted = p.join(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("p_partkey")), "p_partkey", "left_semi").select("key")
    return p.join(wanted, "key", "left_semi").select("owner", "key").distinct()


@register("html_clean", r"""SELECT page_id, nullif(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b]+', ' ', 'g')), '') AS text FROM pages""")
def html_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.clean_text(F.col("html")).alias("text"))


@register("json_extract", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_extract(spark, sf_dir):
    made = F.from_json("props", "k long")
    return table(spark, sf_dir, "events").select("event_id", made["k"].alias("k"))


@register("semantic_text", """SELECT p_partkey AS id, concat_ws(chr(10), 'Occupation: ' || p_name, 'Description: ' || p_type,
  CASE WHEN p_brand <> p_type THEN 'Definition: ' || p_brand END, 'Context path: ' || p_type || ' > ' || p_brand) AS text FROM part""")
def semantic_text(spark, sf_dir):
    path = F.concat_ws(" > ", "p_type", "p_brand")
    text = dc.semantic_text(F.col("p_name"), F.col("p_type"), F.col("p_brand"), F.lit(None).cast("string"), path)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.alias("text"))


@register("lexical_text", """SELECT p_partkey AS id, CASE WHEN p_name = p_type THEN p_name || chr(10) || p_brand ELSE p_name || chr(10) || p_type || chr(10) || p_brand END AS text FROM part""")
def lexical_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), dc.lexical_text(F.col("p_name"), F.col("p_type"), F.col("p_brand")).alias("text"))


@register("query_sections", """SELECT o_orderkey AS id, 'Title: ' || o_orderpriority || chr(10) || 'IT categories: ' || CASE WHEN c_mktsegment = o_orderstatus THEN c_mktsegment ELSE c_mktsegment || '; ' || o_orderstatus END AS label_query,
  'Title: ' || o_orderpriority || chr(10) || 'Category context: ' || c_mktsegment || chr(10) || 'Responsibilities: ' || c_name AS semantic_query
FROM orders JOIN customer ON c_custkey = o_custkey""")
def query_sections(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    label = dc.label_query(F.col("o_orderpriority"), F.array("c_mktsegment", "o_orderstatus"))
    semantic = dc.semantic_query(F.col("o_orderpriority"), F.array("c_mktsegment"), F.col("c_name"), F.lit(None).cast("string"))
    return rows.select(F.col("o_orderkey").alias("id"), label.alias("label_query"), semantic.alias("semantic_query"))


@register("content_hash", """SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"source":' || coalesce('"' || source || '"', 'null') || '}') AS hash,
  sha256(coalesce(text, '')) AS text_hash FROM documents""")
def content_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.content_hash("source", "lang", "doc_id").alias("hash"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_hash"))


MARKS = "éèêçñíóßäöü"


@register("lang_hint", f"""SELECT doc_id, CASE WHEN n = 0 THEN 'empty' WHEN CAST(m AS DOUBLE) / n > 0.15 THEN 'marked' WHEN CAST(m AS DOUBLE) / n > 0.02 THEN 'mixed' ELSE 'plain' END AS hint
FROM (SELECT doc_id, length(regexp_replace(coalesce(text, ''), '\\P{{L}}', '', 'g')) AS n, length(regexp_replace(coalesce(text, ''), '[^{MARKS}]', '', 'g')) AS m FROM documents)""")
def lang_hint(spark, sf_dir):
    hint = tx.lang_hint(F.coalesce("text", F.lit("")), MARKS, names=("plain", "mixed", "marked", "empty"))
    return table(spark, sf_dir, "documents").select("doc_id", hint.alias("hint"))


NOISE = r"(urgent|hot|[!]{2,}|[*#$%&]{3,}|\|)"


@register("noisy_titles", f"SELECT doc_id FROM documents WHERE regexp_matches(lower(split_part(text, chr(10), 1)), '{NOISE}')")
def noisy_titles(spark, sf_dir):
    title = F.lower(F.split_part("text", F.lit("\n"), F.lit(1)))
    return table(spark, sf_dir, "documents").where(title.rlike(NOISE)).select("doc_id")


@register("token_truncate", """WITH t AS (SELECT conv_id, turn, list_append(list_transform(regexp_extract_all(lower(coalesce(text, '')), '([a-z0-9]+)', 1), lambda x: length(x)), -1) AS ids FROM conversations)
SELECT conv_id, turn, len(ids) AS before, array_to_string(CASE WHEN len(ids) <= 16 THEN ids ELSE list_append(ids[1:15], -1) END, ',') AS ids FROM t""")
def token_truncate(spark, sf_dir):
    ids = F.concat(F.transform(tx.tokens(F.col("text")), lambda x: F.length(x)), F.array(F.lit(-1)))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", ids.alias("ids"))
    cut = tx.truncate_ids(F.col("ids"), F.array(F.lit(-1)), 16)
    return rows.select("conv_id", "turn", F.size("ids").cast("long").alias("before"), F.array_join(cut.cast("array<string>"), ",").alias("ids"))


# ------------------------------------------------------------------ statistics


@register("quality_report", """SELECT d.lang AS lang, count(*) AS n, count(*) FILTER (WHERE d.text IS NULL) AS null_texts, count(l.doc_id) AS labelled, min(n_chars) AS min_chars,
  max(n_chars) AS max_chars, round(avg(n_chars), 6) AS mean_chars, count(DISTINCT d.source) AS sources FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.lang""")
def quality_report(spark, sf_dir):
    labelled = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("l"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.col("text").isNull().alias("none")).join(labelled, "doc_id", "left")
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("none").alias("null_texts"), F.count("l").alias("labelled"), F.min("n_chars").alias("min_chars"),
        F.max("n_chars").alias("max_chars"), F.round(F.avg("n_chars"), 6).alias("mean_chars"), F.count_distinct("source").alias("sources"),
    )


@register("status_histogram", "SELECT o_orderstatus AS status, count(*) AS n, o_orderstatus = 'F' AS kept FROM orders GROUP BY o_orderstatus")
def status_histogram(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("kept", F.col("status") == "F")


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@register("source_profile", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def source_profile(spark, sf_dir):
    out = None
    for t in TABLES:
        part = table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, concept, score, rank): orders as postings, their lines' parts as concepts."""
    l = table(spark, sf_dir, "lineitem")
    return l.select(F.col("l_orderkey").alias("job"), F.col("l_partkey").alias("concept"), (1 - F.col("l_discount")).alias("score"), F.col("l_linenumber").alias("rank"))


@register("occupation_stats", """SELECT l_partkey AS concept, count(DISTINCT l_orderkey) AS n_jobs, count(*) AS n_pairs, round(CAST(sum(CAST(round((1 - l_discount) * 1e6) AS BIGINT)) AS DOUBLE) / count(*) / 1e6, 6) AS mean_score, round(min(1 - l_discount), 6) AS min_score,
  round(avg(l_linenumber), 6) AS mean_rank, round(CAST(count(DISTINCT l_orderkey) AS DOUBLE) / (SELECT count(*) FROM orders), 4) AS job_share,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem), 4) AS pair_share FROM lineitem GROUP BY l_partkey""")
def occupation_stats(spark, sf_dir):
    return ev.concept_stats(order_pairs(spark, sf_dir), table(spark, sf_dir, "orders").count())


@register("top_titles", """SELECT p_brand, rank, p_name, n FROM (SELECT p_brand, p_name, n, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_name) AS rank
  FROM (SELECT p_brand, p_name, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand, p_name)) WHERE rank <= 5""")
def top_titles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).join(table(spark, sf_dir, "part"), "p_partkey")
    counts = rows.groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return cn.first_per_group(counts, ["p_brand"], [F.desc("n"), F.col("p_name")], 5)


@register("concentration", """WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, l_partkey) AS k, row_number() OVER (ORDER BY n, l_partkey) AS up FROM c)
SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS concepts, round(CAST(sum(n) FILTER (WHERE k <= 1) AS DOUBLE) / sum(n), 4) AS top_1_share, round(CAST(sum(n) FILTER (WHERE k <= 10) AS DOUBLE) / sum(n), 4) AS top_10_share,
  round(CAST(sum(n) FILTER (WHERE k <= 20) AS DOUBLE) / sum(n), 4) AS top_20_share, count(*) FILTER (WHERE n = 1) AS singletons, count(*) FILTER (WHERE n <= 3) AS at_most_3,
  max(n) FILTER (WHERE up = (SELECT count(*) // 2 + 1 FROM c)) AS upper_median, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM part), 4) AS catalog_share FROM r""")
def concentration(spark, sf_dir):
    counts = order_pairs(spark, sf_dir).groupBy("concept").agg(F.count(F.lit(1)).alias("n"))
    return ev.concentration(counts, table(spark, sf_dir, "part").count())


@register("family_mix", "SELECT coalesce(nullif(trim(split_part(p_type, ' ', 1)), ''), '?') AS family, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM part), 4) AS share FROM part GROUP BY 1")
def family_mix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    family = F.coalesce(F.nullif(F.trim(F.split_part("p_type", F.lit(" "), F.lit(1))), F.lit("")), F.lit("?"))
    return p.groupBy(family.alias("family")).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.round(F.col("n") / F.lit(float(max(p.count(), 1))), 4))


@register("matches_histogram", """SELECT n_matches, count(*) AS n FROM (SELECT o_orderkey, count(l_orderkey) AS n_matches FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey) GROUP BY n_matches""")
def matches_histogram(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("c"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    return rows.groupBy(F.coalesce("c", F.lit(0)).cast("long").alias("n_matches")).agg(F.count(F.lit(1)).alias("n"))


@register("gold_audit", """SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, CAST(count(*) - count(DISTINCT doc_id) AS BIGINT) AS repeated,
  count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS unknown, count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS both FROM labels""")
def gold_audit(spark, sf_dir):
    known = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("k")).distinct()
    rows = table(spark, sf_dir, "labels").join(known, "doc_id", "left")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.count_if(F.col("k").isNull()).alias("unknown"), F.count_if((F.col("toxic") == 1) & (F.col("quality") == 0)).alias("both"))
    return counts.select("n", "ids", (F.col("n") - F.col("ids")).alias("repeated"), "unknown", "both")


@register("constraint_report", """SELECT 'lang in domain' AS "constraint", count(*) AS n FROM documents WHERE lang IS NULL OR lang NOT IN ('en', 'de', 'fr') HAVING count(*) > 0
UNION ALL SELECT 'unique o_custkey', count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'o_custkey references c_custkey', count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) HAVING count(*) > 0""")
def constraint_report(spark, sf_dir):
    d, o, c = (table(spark, sf_dir, t) for t in ("documents", "orders", "customer"))
    rows = ct.report([ct.in_domain(d, "lang", ("en", "de", "fr"), "doc_id"), ct.unique(o, "o_custkey"), ct.references(o, "o_custkey", c, "c_custkey")])
    return rows.select("constraint", "n")


# ----------------------------------------------------------------- gold labels


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as jobs; the parts of their orders' lines as accepted labels."""
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    parts = o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_custkey").alias("job_id"))
    first = F.array_sort(F.collect_set(F.when(F.col("l_linenumber") == 1, F.col("l_partkey"))))
    return parts.agg(F.array_sort(F.collect_set("l_partkey")).alias("accepted"), first.alias("primary"))


GOLD = """g AS (SELECT o_custkey AS job_id, list(DISTINCT l_partkey ORDER BY l_partkey) AS accepted,
  coalesce(list(DISTINCT l_partkey ORDER BY l_partkey) FILTER (WHERE l_linenumber = 1), []) AS "primary" FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey)"""


@register("gold_titles", "WITH " + GOLD + """
SELECT job_id, string_agg(coalesce(p_name, '??MISSING??'), '; ' ORDER BY id) AS titles FROM (SELECT job_id, unnest(accepted) AS id FROM g)
LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = id GROUP BY job_id""")
def gold_titles(spark, sf_dir):
    concepts = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"))
    return lb.titles(gold_rows(spark, sf_dir), concepts)


@register("adjudicated", "WITH " + GOLD + """,
n AS (SELECT s_name AS label, s_suppkey AS id FROM supplier),
a AS (SELECT g.job_id, CASE WHEN s.s_suppkey IS NULL THEN accepted ELSE [s.s_suppkey] END AS accepted, "primary" FROM g LEFT JOIN supplier s ON s.s_suppkey = g.job_id)
SELECT job_id, CAST(len(accepted) AS BIGINT) AS n_accepted, CAST(len(list_filter("primary", lambda x: list_contains(accepted, x))) AS BIGINT) AS n_primary,
  array_to_string(accepted[1:3], ',') AS head FROM a""")
def adjudicated(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("label"), F.col("s_suppkey").alias("id"))
    overrides = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("job_id"), F.array("s_name").alias("labels"))
    rows = lb.adjudicate(gold_rows(spark, sf_dir), overrides, names)
    head = F.array_join(F.slice("accepted", 1, 3).cast("array<string>"), ",")
    return rows.select("job_id", F.size("accepted").cast("long").alias("n_accepted"), F.size("primary").cast("long").alias("n_primary"), head.alias("head"))


@register("gold_totals", "WITH " + GOLD + """
SELECT count(*) AS n, count(*) FILTER (WHERE len(accepted) = 0) AS empty, CAST(sum(len(accepted)) AS BIGINT) AS labels, (SELECT count(DISTINCT id) FROM (SELECT unnest(accepted) AS id FROM g)) AS ids FROM g""")
def gold_totals(spark, sf_dir):
    return lb.audit(gold_rows(spark, sf_dir))


@register("gold_context", """SELECT d.doc_id AS id, b.item_id AS qid, d.source AS label, left(trim(b.text), 600) AS about FROM documents d JOIN benchmark b ON b.item_id = d.doc_id""")
def gold_context(spark, sf_dir):
    candidates = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("item_id").alias("qid"))
    texts = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("scope_note"))
    concepts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("label")).join(texts, "id")
    concepts = concepts.withColumns({"description": F.lit(" "), "definition": F.lit(None).cast("string")})
    return lb.context(candidates, concepts).where("label IS NOT NULL").select("id", "qid", "label", "about")


@register("show_matches", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'widget') ORDER BY p_partkey LIMIT 10")
def show_matches(spark, sf_dir):
    return lb.show(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "p_partkey", "Widget")


@register("strip_instruction", "SELECT p_partkey, p_name AS query FROM part")
def strip_instruction(spark, sf_dir):
    asked = F.concat(F.lit("Find the concept\nQuery: "), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", lb.without_instruction(asked).alias("query"))
