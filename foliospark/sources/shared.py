"""Intermediate tables in the folder that all executors share, and Arrow stages."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ARROW_ROWS = 1_024


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); a temporary one only where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="folio-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors.

    Once it is written, Spark removes the shuffle files of the write; ``discard`` removes the table itself.
    """
    spark = session_of(df)
    path = f"{shared_dir(spark)}/folio/{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folio_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``stored`` that no later result reads (each was followed by another stored table)."""
    for df in tables:
        jvm = session_of(df).sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.folio_path)
        path.getFileSystem(session_of(df).sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends Python at most ARROW_ROWS rows at once, where it has Spark's own default, so that whole texts need little memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if session_of(df).conf.get(key) == "10000":
        session_of(df).conf.set(key, str(ARROW_ROWS))
    return df


def in_arrow(df: DataFrame, f, schema: str, keep: bool = False) -> DataFrame:
    """``df.mapInArrow`` in small batches, ``trimmed``."""
    return small_batches(df).mapInArrow(trimmed(f, keep), schema)


def trimmed(f, keep: bool = False):
    """``f`` over batches; freed memory goes back to the system when a task ends.

    Spark hands workers on from stage to stage: unless ``keep``, what earlier stages left ``kept`` there goes first.
    """

    def run(batches):
        if not keep:
            forget()
        yield from f(batches)
        release()

    return run


def release() -> None:
    """Freed memory of this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_kept: dict = {}


def kept(key, make):
    """``make()``, which the worker process keeps for the next tasks that ask for the same key; one key at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    if _kept:
        _kept.clear()
        release()
