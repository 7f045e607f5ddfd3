from __future__ import annotations

from tessera.streaming.events import for_each_new, windowed_counts

SF = "/root/testdata/sf0.001"


def test_stream_equals_table(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = windowed_counts(stream).writeStream.format("memory").queryName("counted").outputMode("complete").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, windowed_counts(events).collect()))


def test_each_batch_once(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "CAST(id AS string) AS title")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):
        for_each_new(stream, lambda b: b.withColumnRenamed("id", "job"), str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
