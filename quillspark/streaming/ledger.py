"""Structured Streaming forms of the incremental parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.operators.ledger import project


def read_events(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """An append-only folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def idempotent(events: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once, however often it is appended; the state holds the keys."""
    return events.dropDuplicates(keys)


def project_stream(events: DataFrame, key: str, seq: str, target: str, checkpoint: str) -> StreamingQuery:
    """Keeps the last event of each key in ``target``.

    A batch is merged with the state before it and written beside it under the
    batch's number, so a batch that is run again gives the same state and a reader
    never sees half of one.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = project(batch, key, seq)
        before = state_path(spark, target, number - 1)
        if before is not None:
            last = project(spark.read.parquet(before).unionByName(last), "key", seq)
        last.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{number:012d}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state_path(spark: SparkSession, target: str, most: int | None = None) -> str | None:
    """The folder of the newest whole state, of a batch up to ``most``."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(target)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    done = sorted(s.getPath().getName() for s in fs.listStatus(at) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    done = [d for d in done if most is None or int(d) <= most]
    return f"{target.rstrip('/')}/{done[-1]}" if done else None


def ingest_stream(docs: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends documents whose content isn't in ``target`` yet; a batch's folder is overwritten when it is run again."""

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256)).dropDuplicates(["sha"])
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(target)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(at):
            others = [s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName() != f"batch={number}" and s.getPath().getName().startswith("batch=")]
            if others:
                new = new.join(spark.read.parquet(*others).select("sha").distinct(), "sha", "left_anti")
        new.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return docs.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
