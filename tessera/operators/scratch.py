"""Cutting lineage: checkpoints in the folder that the session names; bounded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.errors import TesseraError


def checkpointed(spark: SparkSession) -> None:
    """Sees to a checkpoint folder: spark.checkpoint.dir, or one in the warehouse of a local
    session. A cluster must name one that all executors share."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local"):
        raise TesseraError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")


def kept(df: DataFrame) -> DataFrame:
    """df, computed and written once; a lost executor costs tasks of later stages only."""
    checkpointed(df.sparkSession)
    return df.checkpoint()


#: Rows, and bytes, that go to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(df: DataFrame) -> None:
    """Bounds the session's Arrow batches by rows and bytes, unless they are bounded lower:
    texts are long, and a batch is held by the executor and its worker at once. Plans run
    after this function returns, so the setting stays; it changes no result."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(f"spark.sql.execution.arrow.{key}").removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(f"spark.sql.execution.arrow.{key}", str(most))
