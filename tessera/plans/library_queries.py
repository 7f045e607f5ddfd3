"""Registered queries that run the engine's own functions over stand-in records, labels and
postings made from the star schema: text cleaning, label keys, checks, reports, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import constraints as ct
from tessera.operators import documents as dc
from tessera.operators import evaluate as ev
from tessera.operators import hierarchy as hi
from tessera.plans import index, match
from tessera.plans.registry import register
from tessera.sources import package as pk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def figures(spark: SparkSession, report: dict) -> DataFrame:
    """figure, value of a report whose values are numbers, nested by name."""
    rows: list[tuple[str, float]] = []

    def walk(prefix: str, value: object) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(f"{prefix}.{k}" if prefix else str(k), v)
        else:
            rows.append((prefix, round(float(value or 0), 6)))

    walk("", report)
    return spark.createDataFrame(rows, "figure string, value double")


# ----------------------------------------------------------------------- texts

_MARKED = "'  ' || upper(p_brand) || chr(8211) || p_name || chr(9) || chr(10) || p_type || chr(8217)"


@register("label_keys", f"""SELECT p_partkey AS id, trim(regexp_replace(lower(replace(replace({_MARKED}, chr(8211), '-'), chr(8217), '''')), '\\s+', ' ', 'g')) AS key FROM part""")
def label_keys(spark, sf_dir):
    raw = F.concat(F.lit("  "), F.upper("p_brand"), F.lit("–"), "p_name", F.lit("\t\n"), "p_type", F.lit("’"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), tx.label_key(raw).alias("key"))


@register("label_lines", """SELECT p_partkey AS id, CAST(pos AS BIGINT) AS pos, label FROM (
  SELECT p_partkey, unnest(l) AS label, generate_subscripts(l, 1) - 1 AS pos FROM (SELECT p_partkey, list_filter([trim(p_name), trim(p_brand), CASE WHEN p_size % 2 = 0 THEN p_type END], lambda x: x IS NOT NULL) AS l FROM part))""")
def label_lines(spark, sf_dir):
    field = F.concat(F.lit("\n "), "p_name", F.lit("\t\r\n\n  "), "p_brand", F.lit("\n"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.lit(" \t")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.posexplode(tx.split_labels(field)).alias("pos", "label"))
    return rows.select("id", F.col("pos").cast("long").alias("pos"), "label")


@register("record_labels", """SELECT CAST(p_partkey AS VARCHAR) AS uri, array_to_string(CASE WHEN lower(p_type) < lower(p_brand) THEN [p_type, p_brand] ELSE [p_brand, p_type] END, '|') AS alternatives,
  p_size || 'cm' AS hidden FROM part WHERE lower(p_type) <> lower(p_brand) AND lower(p_name) NOT IN (lower(p_type), lower(p_brand))""")
def record_labels(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("lower(p_type) <> lower(p_brand) AND lower(p_name) NOT IN (lower(p_type), lower(p_brand))")
    alternatives = F.array("p_brand", F.upper("p_name"), F.lower("p_brand"), "p_type", F.concat("p_type", F.lit("  ")))
    hidden = F.array(F.concat("p_size", F.lit("cm")), F.concat(F.lit(" "), "p_brand"), F.upper(F.concat("p_size", F.lit("CM"))), F.lit(" "))
    rows = p.select(F.col("p_partkey").cast("string").alias("uri"), "p_name", alternatives.alias("a"), hidden.alias("h"))
    done = rows.mapInArrow(index._labels, "uri string, alternative_labels array<string>, hidden_labels array<string>")
    return done.select("uri", F.array_join("alternative_labels", "|").alias("alternatives"), F.array_join("hidden_labels", "|").alias("hidden"))


@register("posting_fields", """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at, 'kind=' || event_type || ';pay=by hour' AS info, 'first ' || event_type || '|last' AS lines FROM events""")
def posting_fields(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    dated = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("$date"))
    info = F.create_map(F.lit("kind"), F.concat(F.lit("  "), "event_type"), F.lit("pay"), F.lit("by \t hour "), F.lit("bonus"), F.lit(None).cast("string"))
    lines = F.array(F.concat(F.lit("<li>first</li>\n "), "event_type"), F.lit(" <br> "), F.lit(None).cast("string"), F.lit("last"))
    rows = e.select("event_id", tx.date_of(dated).alias("at"), tx.clean_map(info).alias("info"), tx.clean_strings(lines).alias("lines"))
    said = F.array_join(F.transform(F.array_sort(F.map_entries("info")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ";")
    return rows.select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), said.alias("info"), F.array_join("lines", "|").alias("lines"))


# --------------------------------------------------------------------- records


def stand_ins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of parts, with faults in some: ids that aren't the URI's, unsorted or shared
    skills, blank labels, shares out of range, missing paths."""
    key = F.col("p_partkey")
    uuid = F.concat(F.lpad(F.lower(F.hex(key)), 8, "0"), F.lit("-0000-4000-8000-"), F.lpad(key.cast("string"), 12, "0"))
    none = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("http://k.invalid/occupation/"), uuid).alias("uri"),
        F.when(key % 50 == 3, F.upper(F.concat(uuid, F.lit("x")))).otherwise(uuid).alias("id"),
        F.when(key % 40 == 7, F.lit(" ")).otherwise(F.col("p_name")).alias("preferred_label"),
        F.lit("Occupation").alias("concept_type"),
        F.when(key % 3 == 0, F.array("p_brand")).otherwise(none).alias("alternative_labels"),
        F.when(key % 30 == 11, F.array(F.lit("two\nlines"))).otherwise(none).alias("hidden_labels"),
        F.when(key % 25 == 4, F.array(F.lit("s2"), F.lit("s1"))).otherwise(F.array(F.lit("s1"), F.lit("s2"))).alias("essential_skills"),
        F.when(key % 20 == 9, F.array(F.lit("s2"))).otherwise(none).alias("optional_skills"),
        F.when(key % 60 == 1, F.lit(1)).otherwise(F.lit(3)).cast("long").alias("level"),
        F.when(key % 70 == 2, F.lit("10")).otherwise((F.col("p_size") % 4).cast("string")).alias("major"),
        F.when(key % 80 == 5, F.concat(F.lit("r>http://k.invalid/occupation/"), uuid)).otherwise(F.lit("r>g")).alias("path_ids"),
        F.when(key % 35 == 6, F.lit(1.5)).when(key % 2 == 0, F.round(F.col("p_size") / 100, 2)).alias("green_share"),
        F.when(key % 10 == 0, F.array(F.lit("research"))).otherwise(none).alias("collections"),
        F.when(key % 4 == 0, F.col("p_type")).alias("description"), F.lit(None).cast("string").alias("definition"), F.lit(None).cast("string").alias("scope_note"), F.lit(None).cast("string").alias("nace_code"),
    )
    made = rows.withColumn("content_hash", tx.content_hash(*rows.columns))
    stale = F.when(F.col("uri").endswith("13"), F.lit("0")).otherwise(F.col("content_hash"))
    return made.withColumn("content_hash", stale)


_BROKEN = {
    "id is the URI's": "p_partkey % 50 = 3",
    "preferred_label not blank": "p_partkey % 40 = 7",
    "labels without line ends": "p_partkey % 30 = 11",
    "essential_skills sorted": "p_partkey % 25 = 4",
    "essential_skills and optional_skills disjoint": "p_partkey % 20 = 9",
    "has a path and a root": "p_partkey % 60 = 1",
    "root is one character": "p_partkey % 70 = 2",
    "not its own ancestor": "p_partkey % 80 = 5",
    "share in range": "p_partkey % 35 = 6",
    "hash recomputes": "CAST(p_partkey AS VARCHAR) LIKE '%13'",
}


@register("record_checks", " UNION ALL ".join(f"""SELECT '{name.replace("'", "''")}' AS "constraint", count(*) AS n FROM part WHERE {on} HAVING count(*) > 0""" for name, on in _BROKEN.items()))
def record_checks(spark, sf_dir):
    return ct.report(index.record_constraints(stand_ins(spark, sf_dir))).select("constraint", "n")


_ARRAYS = {"alternative_labels": "CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END", "hidden_labels": "CASE WHEN p_partkey % 30 = 11 THEN 1 ELSE 0 END", "essential_skills": "2", "optional_skills": "CASE WHEN p_partkey % 20 = 9 THEN 1 ELSE 0 END"}
_NULLS = {"description": "p_partkey % 4 <> 0", "definition": "true", "scope_note": "true", "nace_code": "true", "green_share": "p_partkey % 35 <> 6 AND p_partkey % 2 <> 0"}


@register("record_statistics", " UNION ALL ".join([
    "SELECT 'records' AS figure, CAST(count(*) AS DOUBLE) AS value FROM part",
    "SELECT 'research', CAST(count(*) AS DOUBLE) FROM part WHERE p_partkey % 10 = 0",
    *[f"SELECT '{f}_{c}', round(CAST({'avg' if f == 'mean' else f}({x}) AS DOUBLE), 6) FROM part" for c, x in _ARRAYS.items() for f in ("min", "max", "mean")],
    *[f"SELECT 'null_{c}', CAST(count(*) FILTER (WHERE {x}) AS DOUBLE) FROM part" for c, x in _NULLS.items()],
    "SELECT 'by_major.' || CASE WHEN p_partkey % 70 = 2 THEN '10' ELSE CAST(p_size % 4 AS VARCHAR) END, CAST(count(*) AS DOUBLE) FROM part GROUP BY 1",
]))
def record_statistics(spark, sf_dir):
    return figures(spark, index.statistics(stand_ins(spark, sf_dir)))


@register("package_profile", """SELECT 'groups' AS name, count(*) AS n, 'conceptUri,code,preferredLabel,extraColumn' AS columns, 'extraColumn' AS extra FROM nation
UNION ALL SELECT 'broader', count(*), 'conceptUri,broaderUri', '' FROM nation""")
def package_profile(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    uri = lambda c: F.concat(F.lit("http://k.invalid/"), c)
    tables = {
        "groups": n.select(uri("n_nationkey").alias("conceptUri"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("preferredLabel"), F.lit("").alias("extraColumn")),
        "broader": n.select(uri("n_nationkey").alias("conceptUri"), uri("n_regionkey").alias("broaderUri")),
    }
    made = pk.profile(pk.Package(tables, {k: "" for k in tables}, "", {k: tuple(v.columns) for k, v in tables.items()}))
    rows = [(k, v["rows"], ",".join(v["columns"]), ",".join(v["extra"])) for k, v in made.items()]
    return spark.createDataFrame(rows, "name string, n long, columns string, extra string")


@register("membership_keys", "SELECT DISTINCT p_brand AS key FROM part WHERE p_size % 3 = 0")
def membership_keys(spark, sf_dir):
    column = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), "p_brand", F.lit("  "))).otherwise(F.lit("   "))
    return pk.collection_uris(table(spark, sf_dir, "part").select(column.alias("key")), "key")


# -------------------------------------------------------------------- postings


def postings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as postings with two categories each, and regions over nations as taxonomy."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    nation = F.concat(F.lit("N"), "c_nationkey")
    region = F.concat(F.lit("R"), key % 6)  # declared; R5 isn't there
    none = F.lit(None).cast("string")
    kind = lambda k, name, *levels: F.struct(k.alias("key"), name.alias("name"), none.alias("url"), none.alias("group"), *[x.alias(f"level{i + 1}Id") for i, x in enumerate(levels)])
    categories = F.array(kind(nation, F.col("c_name"), region, region, nation), kind(F.when(key % 9 == 0, F.lit("gone")).otherwise(F.lit("R2")), F.lit("second"), F.lit("R2"), none, F.lit("R2")))
    rows = o.select(
        F.concat(F.lit(" "), key.cast("string")).alias("externalId"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "queued").alias("status"),
        F.when(key % 2 == 0, F.lit("own")).alias("platformId"), none.alias("sourceUrl"), F.concat(F.lit("<i>"), "o_orderpriority", F.lit("</i>")).alias("title"),
        F.when(key % 4 != 0, F.concat(F.lit("<p>for "), "c_mktsegment", F.lit("</p>"))).alias("description"), none.alias("requireCandidate"), none.alias("experience"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("$date")).alias("updatedAt"), F.array(F.lit("<b>one</b>"), F.lit(" ")).alias("requireSummary"),
        F.array(F.struct(F.lit("1").alias("id"), F.lit(" a  b ").alias("title"))).alias("knowledge"), F.create_map(F.lit("k"), F.lit(" v ")).alias("commonInfo"), categories.alias("categories"),
    )
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    forest = r.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.col("r_name").alias("name"), none.alias("parent_id"))
    return rows, forest.union(n.select(F.concat(F.lit("N"), "n_nationkey"), "n_name", F.concat(F.lit("R"), "n_regionkey")))


_POSTINGS = """o AS (SELECT orders.*, c_name, c_nationkey, c_mktsegment, n_regionkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
k AS (SELECT * FROM o WHERE o_orderstatus = 'F')"""


@register("posting_records", "WITH " + _POSTINGS + """
SELECT 'desk:' || o_orderkey AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 'own' ELSE 'desk' END AS platform, o_orderpriority AS title, CASE WHEN o_orderkey % 4 <> 0 THEN 'for ' || c_mktsegment END AS description,
  strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 6 = 2 THEN 'N' || c_nationkey || CASE WHEN o_orderkey % 9 <> 0 THEN '|R2' ELSE '' END ELSE CASE WHEN o_orderkey % 9 <> 0 THEN 'R2' ELSE '' END END AS it,
  CASE WHEN o_orderkey % 6 <> 2 THEN 'N' || c_nationkey ELSE '' END AS secondary, CASE WHEN o_orderkey % 9 = 0 THEN 'gone' ELSE '' END AS unresolved, 64 AS hash_length FROM k""")
def posting_records(spark, sf_dir):
    given, forest = postings(spark, sf_dir)
    rows = match.canonical_postings(given, forest, "R2", "desk")
    keys = lambda c: F.array_join(F.transform(c, lambda x: x["key"]), "|")
    return rows.select(
        "job_id", "platform", "title", "description", F.date_format("updated_at", "yyyy-MM-dd").alias("day"),
        keys("it_category_paths").alias("it"), keys("secondary_category_paths").alias("secondary"), keys("unresolved_categories").alias("unresolved"), F.length("content_hash").alias("hash_length"),
    )


@register("posting_figures", "WITH " + _POSTINGS + """,
f AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 6 = 2) + count(*) FILTER (WHERE o_orderkey % 9 <> 0) AS it, count(*) FILTER (WHERE o_orderkey % 6 <> 2) AS sec, count(*) FILTER (WHERE o_orderkey % 9 = 0) AS un,
  count(*) FILTER (WHERE o_orderkey % 6 <> n_regionkey) AS rc, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS nd FROM k)
SELECT 'postings' AS figure, CAST(n AS DOUBLE) AS value FROM f UNION ALL SELECT 'it_category_paths', it FROM f UNION ALL SELECT 'secondary_category_paths', sec FROM f UNION ALL SELECT 'unresolved_categories', un FROM f
UNION ALL SELECT 'root_conflicts', rc FROM f UNION ALL SELECT 'terminal_conflicts', 0 FROM f UNION ALL SELECT 'no_description', nd FROM f
UNION ALL SELECT 'skipped.queued', count(*) FROM o WHERE o_orderstatus = 'O' HAVING count(*) > 0 UNION ALL SELECT 'skipped.None', count(*) FROM o WHERE o_orderstatus NOT IN ('F', 'O') HAVING count(*) > 0""")
def posting_figures(spark, sf_dir):
    given, forest = postings(spark, sf_dir)
    return figures(spark, match.posting_report(match.canonical_postings(given, forest, "R2", "desk"), given))


# ------------------------------------------------------------- faulty structures


@register("hierarchy_faults", """SELECT 'groups have codes, others none' AS "constraint", count(*) AS n FROM nation WHERE n_nationkey % 7 = 1 HAVING count(*) > 0
UNION ALL SELECT 'label not blank', count(*) FROM nation WHERE n_nationkey % 5 = 2 HAVING count(*) > 0
UNION ALL SELECT 'parent exists', count(*) FROM nation WHERE n_nationkey % 6 = 3 HAVING count(*) > 0
UNION ALL SELECT 'others have a parent', count(*) FROM nation WHERE n_nationkey % 8 = 4 HAVING count(*) > 0
UNION ALL SELECT 'roots have no parent', 1
UNION ALL SELECT 'child exists', 1""")
def hierarchy_faults(spark, sf_dir):
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    nodes = r.select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.lit("group").alias("type"), F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("label"))
    nodes = nodes.union(n.select(F.concat(F.lit("N"), key), F.lit("occupation"), F.when(key % 7 == 1, "x"), F.when(key % 5 == 2, " ").otherwise(F.col("n_name"))))
    edges = n.where(key % 8 != 4).select(F.concat(F.lit("N"), key).alias("child"), F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    edges = edges.union(n.where(key % 6 == 3).select(F.concat(F.lit("N"), key), F.concat(F.lit("missing"), key)))
    edges = edges.union(r.where("r_regionkey = 1").select(F.lit("R1"), F.lit("R0"))).union(r.where("r_regionkey = 1").select(F.lit("nobody"), F.lit("R0")))
    # A nation whose only parent is missing has a parent all the same.
    return ct.report(hi.guards(nodes, edges)).select("constraint", "n")


@register("cycle_members", """SELECT 'N' || n_nationkey AS id FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'R1'""")
def cycle_members(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    edges = n.select(F.concat(F.lit("N"), "n_nationkey").alias("child"), F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    first = n.where("n_regionkey = 1").agg(F.min("n_nationkey").alias("k")).select(F.lit("R1").alias("child"), F.concat(F.lit("N"), "k").alias("parent"))
    return hi.on_cycles(edges.union(first))


@register("payload_differences", """SELECT 'equal rows by doc_id' AS "constraint", count(*) AS n FROM documents WHERE doc_id % 10 = 3 OR (doc_id % 10 = 4 AND n_chars IS NOT NULL)""")
def payload_differences(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    stored = d.where("doc_id % 10 <> 3").withColumn("n_chars", F.when(F.col("doc_id") % 10 != 4, F.col("n_chars")))
    return ct.report([ct.equal_rows(stored, d, "doc_id")]).select("constraint", "n")


# ------------------------------------------------------- budgets and samples

#: What Python splits words at.
_GAP = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_LEAD = "'Find the concept' || chr(10) || 'Query: '"


def _fit_sql(budget: int, margin: int = 8, rounds: int = 3) -> str:
    """The steps of documents.fit, one query a round, for a title and a body."""
    count = lambda x: f"len(list_filter(regexp_split_to_array({x}, '{_GAP}'), lambda w: w <> ''))"
    whole = f"{_LEAD} || concat_ws(chr(10), CASE WHEN title <> '' THEN 'Title: ' || title END, CASE WHEN body <> '' THEN 'Responsibilities: ' || body END)"
    steps = ["""s0 AS MATERIALIZED (SELECT doc_id, coalesce(split_part(text, chr(10), 1), '') AS title, coalesce(text, '') AS body, false AS cut_title, false AS cut_body FROM documents)""", f"n0 AS (SELECT doc_id, {count(whole)} AS n FROM s0)"]
    plan = [("body", "Responsibilities")] * rounds + [("title", "Title")] * rounds
    for i, (part, header) in enumerate(plan):
        other = "title" if part == "body" else "body"
        steps.append(f"t{i} AS MATERIALIZED (SELECT *, {whole} AS t, {count(whole)} AS total, {count(f"'{header}: ' || {part}")} AS own FROM s{i})")
        steps.append(f"u{i} AS MATERIALIZED (SELECT *, greatest(0, {budget - margin} - (total - own)) * length(t) // greatest(total, 1) AS room FROM t{i})")
        on = f"total > {budget} AND {part} <> '' AND room < length({part})"
        steps.append(f"""s{i + 1} AS MATERIALIZED (SELECT doc_id, {other}, CASE WHEN {on} THEN regexp_replace(left({part}, room), '{_GAP}$', '') ELSE {part} END AS {part},
  cut_{other}, cut_{part} OR ({on}) AS cut_{part} FROM u{i})""")
    last = f"s{len(plan)}"
    steps.append(f"z AS MATERIALIZED (SELECT *, {whole} AS t, {count(whole)} AS total FROM {last})")
    steps.append(f"y AS (SELECT doc_id, cut_title, cut_body, CASE WHEN total > {budget} THEN left(t, greatest(1, length(t) * {budget} // total - {margin})) ELSE t END AS t FROM z)")
    return f"""WITH {', '.join(steps)}
SELECT y.doc_id AS id, CAST(n AS BIGINT) AS tokens_before, CAST({count('t')} AS BIGINT) AS tokens, cut_title OR cut_body OR n <> {count('t')} AS truncated,
  concat_ws(',', CASE WHEN cut_body THEN 'body' END, CASE WHEN cut_title THEN 'title' END) AS shortened, sha256(t) AS text_hash FROM y JOIN n0 USING (doc_id)"""


@register("budget_fit", _fit_sql(128))
def budget_fit(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), "text")
    done = dc.fit_column(rows, "doc_id", [("title", "Title", "title", 90), ("body", "Responsibilities", "text", 10)], 128, "Find the concept")
    return done.withColumn("text_hash", F.sha2(F.col("text").cast("binary"), 256)).drop("text")


@register("stratified_sample", """WITH h AS (SELECT doc_id, lang, source, md5(doc_id || ':7') AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY h, doc_id) AS s, row_number() OVER (PARTITION BY lang ORDER BY h, doc_id) AS m FROM h)
SELECT doc_id, lang, source FROM r ORDER BY CASE WHEN s <= 1 OR (lang = 'en' AND m <= 40) OR (lang = 'es' AND m <= 15) THEN 0 ELSE 1 END, h, doc_id LIMIT 200""")
def stratified_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return ev.stratified_sample(rows, "doc_id", ["lang", "source"], 200, minimums={("lang", "en"): 40, ("lang", "es"): 15})
