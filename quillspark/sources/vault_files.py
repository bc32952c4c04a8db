"""Scans and sinks of the file-backed layout: notes, sidecars, ledgers, the chunk store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.text import store_path

FOLDERS = ["raw", "wiki", "index"]
LEDGER = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("doc_id", "stage", "status", "primary")]
    + [T.StructField("secondary", T.ArrayType(T.StringType()))]
    + [T.StructField(n, T.StringType()) for n in ("relation_type", "confidence_bucket", "method", "reasoning_brief", "taxonomy_version", "glossary_version", "policy_version", "model_id")]
    + [T.StructField("top_k", T.IntegerType()), T.StructField("timestamp", T.StringType())]
)


def read_notes(spark: SparkSession, root: str) -> DataFrame:
    """(path, folder, stem, text, mtime) of the markdown files of raw, wiki and index; tests are never read."""
    paths = [f"{root.rstrip('/')}/{f}" for f in FOLDERS]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(paths)
    inner = F.regexp_extract("path", f"{_escaped(root)}/(.*)$", 1)
    return files.select(inner.alias("path"), F.regexp_extract(inner, "^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract(inner, "([^/]*)\\.md$", 1).alias("stem"), F.try_validate_utf8(F.col("content").cast("string")).alias("text"), F.col("modificationTime").alias("mtime"))


def _escaped(root: str) -> str:
    import re

    return re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", root.rstrip("/").split("://", 1)[-1])


def read_inputs(spark: SparkSession, root: str) -> DataFrame:
    """(path, raw, sha, length, mtime) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("content").alias("raw"), F.sha2("content", 256).alias("sha"), "length", F.col("modificationTime").alias("mtime"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, everything a string."""
    return spark.read.option("header", "true").csv(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A ledger of JSON lines; blank ones are skipped. ``seq`` orders the events as they were appended.

    It compares the number of the append (null, hence first, for files that others
    wrote, which go by their time), the file's name (the parts of an append are
    numbered), the place of its block and the line in it; a block is read by one task
    from front to back.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).where(F.trim("value") != "")
    number = F.try_to_number(F.nullif(F.regexp_extract("_metadata.file_path", "/append-(\\d{12})/", 1), F.lit("")), F.lit("999999999999")).cast("long")
    seq = F.struct(number.alias("append"), F.when(number.isNull(), F.col("_metadata.file_modification_time")).alias("at"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return lines.select(F.from_json("value", LEDGER).alias("e"), seq.alias("seq")).select("e.*", "seq")


def append_ledger(events: DataFrame, path: str) -> None:
    """Appends the events, in their order, as the ledger's next numbered part."""
    spark = events.sparkSession
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(top)] if fs.exists(top) else []
    number = max((int(n.removeprefix("append-")) for n in names if n.startswith("append-")), default=0) + 1
    events.write.mode("append").json(f"{path.rstrip('/')}/append-{number:012d}")


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Content-addressed sink (chunk): partitions of the first two digits; what is there already isn't written again."""
    spark = chunks.sparkSession
    new = chunks.select("chunk", F.sha2(F.col("chunk").cast("binary"), 256).alias("sha")).dropDuplicates(["sha"]).withColumn("part", F.substring("sha", 1, 2))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        new = new.join(spark.read.parquet(path).select("sha"), "sha", "left_anti")
    new.write.mode("append").partitionBy("part").parquet(path)


def chunk_paths(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk", store_path(F.col("chunk")).alias("path"))


def write_sidecars(rows: DataFrame, key: str, path: str) -> None:
    """A JSON document per row."""
    rows.select(F.to_json(F.struct(*[F.col(c) for c in rows.columns if c != key])).alias("value"), F.col(key)).write.mode("overwrite").json(path)


def refuse_inside(output: str, corpus: str) -> None:
    """The output of a census may not lie inside the corpus."""
    if f"{output.rstrip('/')}/".startswith(f"{corpus.rstrip('/')}/"):
        raise ValueError("the output lies inside the corpus")


def onenote_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an extracted notebook, with the schema given rather than inferred."""
    page = "struct<id:string,title:string,created:string,deleted:boolean,conflict:boolean,history:boolean,idx:int,binaries:array<struct<name:string,path:string>>>"
    return spark.read.schema(f"notebook string, pages array<{page}>").option("multiLine", "true").json(path).select("notebook", F.explode("pages").alias("p")).select("notebook", "p.*")
