from __future__ import annotations

import glob

from pyspark.sql import functions as F

from tessera.llm import common


def test_joins_agree_at_any_size(spark):
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), F.create_map(F.lit("a"), F.lit("b")).alias("m"))
    params = spark.createDataFrame([("hot", 1), ("6", 2), (None, 3)], "k string, v int")
    a, b = (sorted((r.id, r.v) for r in common.keyed_join(rows, params, ["k"], most=most).collect()) for most in (10, 0))
    assert a == b and len(a) == 300 and dict(a)[3] == 3 and dict(a)[1] == 1 and dict(a)[12] is None
    assert common.keyed_join(rows, params, ["k"], most=0).columns == ["id", "k", "m", "v"]


def test_scratch_tables(spark):
    df = common.materialize(spark.range(5).withColumn("s", F.lit("x")), "test")
    assert df.count() == 5
    where = common.shared_dir(spark).removeprefix("file://")
    assert glob.glob(f"{where}/tessera/test-*")
    common.clear_scratch()
    assert not glob.glob(f"{where}/tessera/test-*")


def test_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    common.small_batches(spark.range(1))
    assert spark.conf.get(key) == "1000"
    spark.conf.set(key, "100")
    common.small_batches(spark.range(1))
    assert spark.conf.get(key) == "100"
    spark.conf.unset(key)


def test_workers_keep_one_operators_stores():
    emptied = []
    common.kept_store(clear := lambda: emptied.append(1))
    assert list(common.lean("one", iter)([1, 2])) == [1, 2] and len(emptied) == 1
    list(common.lean("one", iter)([]))
    list(common.lean("two", iter)([]))
    assert len(emptied) == 2
    common._clear.remove(clear)


def broadcast_bytes(df):
    """Bytes of the broadcasts that df's rows needed (of a plan that isn't adaptive)."""
    df.collect()
    found, rest = 0, [df._jdf.queryExecution().executedPlan()]
    while rest:
        node = rest.pop()
        if node.getClass().getSimpleName() == "BroadcastExchangeExec":
            found += node.metrics().apply("dataSize").value()
        children = node.children()
        rest.extend(children.apply(i) for i in range(children.size()))
    return found


def test_keys_that_go_weigh_little_on_the_driver(spark):
    gone = common.materialize(spark.range(0, 60_000, 2).withColumnRenamed("id", "doc_id"), "test")
    rows = spark.range(60_100).select(F.when(F.col("id") < 60_050, F.col("id")).alias("doc_id"), F.lit("x").alias("__gone"), F.lit("y").alias("__part"), F.lit("z").alias("a`b"))
    rows = rows.unionByName(rows.where("doc_id < 4"))
    few, many = (common.without(rows, gone, "doc_id", most=most) for most in (30_000, 29_999))
    want = sorted([*range(1, 60_000, 2), *range(60_000, 60_050), 1, 3])
    for left in (few, many):
        ids = [r.doc_id for r in left.collect()]
        assert left.columns == rows.columns and ids.count(None) == 50 and sorted(i for i in ids if i is not None) == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = common.materialize(spark.range(200_000).withColumnRenamed("id", "doc_id"), "test")
        assert 8 * 200_000 <= broadcast_bytes(common.without(rows, large, "doc_id", most=200_000)) < 24 * 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert common.without(rows, gone.limit(0), "doc_id").count() == rows.count()


def test_iterations_leave_no_garbage_on_the_driver(spark, monkeypatch):
    released = []
    monkeypatch.setattr(common, "release", released.append)
    first = common.materialize(spark.range(5), "test")
    assert not released
    assert common.materialize(first.where("id > 1"), "test", replaces=[first]).count() == 3 and released == [spark]
