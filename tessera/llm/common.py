"""What the training-data operators share: scratch tables, sized joins, text bytes."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tessera.operators.scratch import BATCH_BYTES, BATCH_ROWS, small_batches  # noqa: F401

#: ASCII white space, the only characters that separate words: [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_scratch: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir,
    or one in the warehouse where that is unset (a local session only)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (found or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def materialize(df: DataFrame, name: str, replaces: Sequence[DataFrame] = (), few: bool = False) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back, which cuts its
    lineage: a lost executor costs tasks of later stages only. Removed at exit; the
    written tables that it replaces, which nothing may read any more, go at once. few: df has
    few rows for its partitions; they are put together first, into files of Spark's advisory
    size, since each file costs its task some system calls and each reader a split."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if few else df).write.parquet(path)
    if not _scratch:
        atexit.register(clear_scratch)
    _scratch.append((spark, path))
    for old in replaces:
        at = old._scratch_path
        _scratch.remove((spark, at))
        _delete(spark, at)
    if replaces:
        release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage. The plans of an iteration, their shuffles and broadcasts
    go then, and the heap shrinks to what is in use; left alone it grows to its limit, which
    the driver's other memory comes on top of."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch() -> None:
    """Removes every scratch table of this process."""
    while _scratch:
        try:
            _delete(*_scratch.pop())
        except Exception:  # the session has gone, and with it the means to delete
            return


def keyed_join(
    rows: DataFrame,
    params: DataFrame,
    keys: Sequence[str],
    *,
    most: int = 50_000,
    salts: int = 32,
    known: int | None = None,
) -> DataFrame:
    """rows LEFT JOIN params USING (keys), null keys equal. params has one row a key.

    With at most `most` rows in params it is broadcast. With more, params is
    repeated once per salt and the rows of one key are dealt over the salts, so
    that a key with a third of all rows doesn't end in one task."""
    n = params.count() if known is None else known
    names = [free_name(rows, f"__{k}") for k in keys]
    right = params.select(
        *[F.col(k).alias(a) for k, a in zip(keys, names, strict=True)],
        *[c for c in params.columns if c not in keys],
    )
    on = [F.col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, names, strict=True)]
    if n <= most:
        return rows.join(F.broadcast(right), on, "left").drop(*names)
    hashed = [_quoted(c) for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    salt, other = free_name(rows, "__salt"), free_name(rows, "__salt_r")
    left = rows.withColumn(salt, F.pmod(F.xxhash64(*hashed) if hashed else F.lit(0), F.lit(salts)).cast("int"))
    right = right.withColumn(other, F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    on.append(F.col(salt) == F.col(other))
    return left.join(right, on, "left").drop(*names, salt, other)


#: Keys that share a row of a broadcast.
PACKED = 32


def without(rows: DataFrame, gone: DataFrame, key: str, *, most: int = 50_000) -> DataFrame:
    """rows whose key isn't among the distinct keys of gone (one column); a null key stays.
    All columns of rows pass through, whatever their names.

    Up to `most` keys are broadcast, PACKED in a row: the driver builds what it broadcasts,
    and a row of its own for each key weighs some ten times as much."""
    n = gone.count()
    mark = free_name(rows, "__gone")
    if n > most:
        marked = keyed_join(rows, gone.withColumn(mark, F.lit(True)), [key], most=most, known=n)
        return marked.where(F.col(mark).isNull()).drop(mark)
    own, other = free_name(rows, "__part"), free_name(rows, "__part_r")
    part = F.pmod(F.xxhash64(key), F.lit(n // PACKED + 1)).cast("int")
    packed = gone.groupBy(part.alias(other)).agg(F.collect_list(key).alias(mark))
    marked = rows.withColumn(own, part).join(F.broadcast(packed), F.col(own) == F.col(other), "left")
    return marked.where(~F.coalesce(F.array_contains(mark, F.col(key)), F.lit(False))).drop(own, other, mark)


#: Keys with fewer rows are never hot: a task bears as many.
HOT_ROWS = 200_000


def hot_join(rows: DataFrame, params: DataFrame, key: str, *, most: int = 0, written: bool = False, share: float = 0.001) -> DataFrame:
    """rows JOIN params USING (key), for keys that may hold a large part of the rows.
    params has one row a key. written: rows is a written table, cheap to read again.

    With at most `most` rows, params is broadcast. Otherwise keys with more than `share` of
    the rows (and HOT_ROWS), 1 / share of them at most, are broadcast with their params, and
    their rows stay where they are; all others meet in a shuffle."""
    if most and params.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(params), key)
    n = rows.count()
    if n <= HOT_ROWS:
        return rows.join(params, key)
    rows = rows if written else materialize(rows, "hot-rows")
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max(HOT_ROWS, share * n)).select(key)
    hot = materialize(hot, "hot-keys")
    if hot.isEmpty():
        return rows.join(params, key)
    few = F.broadcast(materialize(params.join(F.broadcast(hot), key, "left_semi"), "hot-params"))
    here = rows.join(few, key)
    return here.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(params, key).select(here.columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def code_points(b: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(b) if b.isascii() else len(b.decode("utf-8", "replace"))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal keys out of batches that are sorted by a key without nulls."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        edges = np.flatnonzero(k[1:] != k[:-1]) + 1
        if rest and rest[-1].column(key)[0].as_py() != k[0]:
            yield pa.Table.from_batches(rest)
            rest = []
        start = 0
        for end in edges.tolist():
            yield pa.Table.from_batches([*rest, batch.slice(start, end - start)])
            rest, start = [], end
        rest.append(batch.slice(start))
    if rest:
        yield pa.Table.from_batches(rest)


# ------------------------------------------------------------- Python workers

_owner: str | None = None
_clear: list[Callable[[], None]] = []


def kept_store(clear: Callable[[], None]) -> None:
    """Registers how to empty a store that a worker keeps between tasks."""
    if clear not in _clear:
        _clear.append(clear)


def lean(owner: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that leaves its worker small: stores of other operators go when it
    starts, and freed memory goes back to the system when it ends. Workers are reused."""

    def task(batches: Iterator) -> Iterator:
        _enter(owner)
        try:
            yield from run(batches)
        finally:
            _trim()

    return task


def text_udf(owner: str, run: Callable[[Iterator], Iterator], kind: str) -> Callable[..., Column]:
    """A lean function of Arrow batches as a function of columns: only these go to Python."""
    return arrow_udf(lean(owner, run), kind, ArrowUDFType.SCALAR_ITER)


def _enter(owner: str) -> None:
    global _owner
    if _owner != owner:
        for clear in _clear:
            clear()
        if _owner is not None:
            _trim()
        _owner = owner


def _trim() -> None:
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to ask for
        return
