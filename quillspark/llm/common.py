"""What the operators of this subpackage share: stored intermediates, row keys, batches of bounded size."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quillspark.functions.shipping import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local one only where it is unset and everything runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="quillspark-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Folders of what is stored.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: it is computed once, and lost executors cost nothing.

    The folder goes with ``unstored``, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quillspark-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path.rpartition("/")[0])
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path.rpartition("/")[0]
    return out


def unstored(*frames: DataFrame) -> None:
    """Give up the folders of stored frames that nothing will read any more."""
    for df in frames:
        if folder := _FOLDERS.pop(df, None):
            _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


#: Arrow batches between the JVM and Python: bytes of one, where the session doesn't say otherwise. Rows alone would let long texts fill a worker.
ARROW_BYTES, ARROW_ROWS = 8 << 20, 4000


#: What this worker keeps from one task to the next.
WORKER_KEPT: dict = {}


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with bounded batches and workers that give back what a task has used; what they keep is for tasks that say so (``keeps``), any other drops it."""
    spark = df.sparkSession
    ship(spark)
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            drop_kept()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return df.mapInArrow(bounded, schema)


def drop_kept() -> None:
    """Give up what earlier tasks left in this worker."""
    if WORKER_KEPT:
        WORKER_KEPT.clear()
        release_memory()


def release_memory() -> None:
    """Hand free memory of this worker back to the system; workers are used again by other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_key(text: Column) -> Column:
    """A hash that tells rows with one id and different texts apart; with the id it is a row's key."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def batches_of(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the values of ``column`` in each take up at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def refuse_clashes(keep: list[str], *outputs: str) -> None:
    """An error where a column to keep is named like an output, in any case of letters, or named twice."""
    names = [c.lower() for c in keep]
    clash = [c for c in keep if c.lower() in {o.lower() for o in outputs} or names.count(c.lower()) > 1]
    if clash:
        raise ValueError(f"these columns can't be kept beside the outputs, rename them: {', '.join(clash)}")


def quoted(name: str) -> str:
    """A column's name as an expression: dots and the like are part of it."""
    return "`" + name.replace("`", "``") + "`"


def kept(df: DataFrame, keep: list[str]) -> list[Column]:
    """The columns to keep under names of our own, so that none can clash with what an operator adds."""
    return [df[quoted(c)].alias(f"__keep{i}") for i, c in enumerate(keep)]


def named(out: DataFrame, keep: list[str], *outputs: str | Column) -> DataFrame:
    """The kept columns under their own names again, then the outputs."""
    return out.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)], *outputs)


def kept_fields(df: DataFrame) -> list[StructField]:
    return [f for f in df.schema.fields if f.name.startswith("__keep")]


def with_fields(fields: list[StructField], ddl: str) -> StructType:
    """Fields, then those of a DDL string."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])
