"""Shared pieces of the training-data operators: inputs, written intermediates, checked joins."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word, as every contract of this subpackage has it.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes up to which the small side of a join may be broadcast; above either the join shuffles.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
#: What a batch of rows may hold on its way to a Python worker, unless the session says otherwise.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing and the master is local.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="folioquarry-")
        spark.sparkContext.setCheckpointDir(found)
    return found


#: The tables that each open ``scratch`` has to delete.
_scratch: list[list[str]] = []


def written(df: DataFrame, keep: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors.

    Within a ``scratch`` the table is deleted at its end; one to ``keep`` outlives it (and is the surrounding one's).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioquarry/{uuid.uuid4().hex}"
    df.write.parquet(path)
    owners = _scratch[:-1] if keep else _scratch
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables written in it; nothing that is still to be read may depend on them."""
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield
    finally:
        _scratch.remove(paths)
        delete(spark, *paths)


def delete(spark: SparkSession, *paths: str) -> None:
    """Removes written tables, wherever Spark can write."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def mapped(df: DataFrame, work, schema) -> DataFrame:
    """``df.mapInArrow(work, schema)`` in batches of few megabytes, so that what JVM and worker hold of a task is bounded.

    A batch has one row at least, so a text longer than the bound is a batch of its own. Workers outlive their tasks:
    what a task has used is given back to the system at its end, so that idle workers hold nothing of it.
    """
    conf = df.sparkSession.conf
    for key, value in BATCHES.items():
        if conf.get(key, None) is None:
            conf.set(key, value)

    def run(batches):
        import pyarrow as pa

        pa.set_memory_pool(pa.system_memory_pool())  # one that can be trimmed
        try:
            yield from work(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory of this process to the system, where the C library can."""
    gc.collect()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def bytes_of(df: DataFrame) -> Column:
    """Bytes of a row as it is broadcast, from the types of its columns and the lengths of its texts and arrays."""

    def of(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return reduce(lambda a, f: a + of(value[f.name], f.dataType), kind.fields, F.lit(16))
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 16
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
                each = F.aggregate(value, F.lit(0), lambda a, x: a + of(x, kind.elementType))
            else:
                each = F.size(value) * 16
            return F.coalesce(each, F.lit(0)) + 16
        if isinstance(kind, T.MapType):
            return of(F.map_entries(value), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
        return F.lit(16)

    return reduce(lambda a, f: a + of(F.col(f"`{f.name}`"), f.dataType).cast("long"), df.schema.fields, F.lit(0).cast("long"))


def small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast only if it has at most ``limit`` rows and about ``size`` bytes; ``df`` must be cheap to read."""
    rows, total = df.limit(limit + 1).select(bytes_of(df).alias("b")).agg(F.count("*"), F.sum("b")).first()
    return F.broadcast(df) if rows <= limit and (total or 0) <= size else df


def written_small(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES, keep: bool = False) -> DataFrame:
    """``small(written(df, keep))``, with rows and bytes counted while they are written: a query less for the driver to plan, run and remember."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(bytes_of(df)).alias("bytes")), keep)
    found = seen.get
    return F.broadcast(out) if found["rows"] <= limit and (found["bytes"] or 0) <= size else out


def code_points(text: Column) -> Column:
    return F.coalesce(F.char_length(text), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; whatever else the input carries cannot clash with working columns."""
    return df.select(*names)
