"""The corpus pipeline: language, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), where docs has the columns of
``documents``, and works on all rows that the stage before has kept.  ``run``
writes every stage's rows as Parquet to the shared folder and reads them again; the
rows of the stage before go then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, near_copies, ppm_language, suffix_dedup, vector_pack
from quillspark.llm.common import stored, text_key, unstored

#: Predictions less sure than this are rejected.
LEAST_SCORE = 0.5


def _private(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns renamed by their place, so that further columns of any name clash with nothing, and the names by the old ones."""
    names = [f"__col{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names, strict=True))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told; ``lang`` becomes the prediction.

    Null, empty and letterless texts go, texts of any length are read whole, repeated
    rows are judged alike; further columns, whatever their names, stay; an empty table
    gives an empty one.
    """
    own, at = _private(docs)
    model = ppm_language.fit(own.where(ppm_language.training_rows(own[at["doc_id"]])), at["doc_id"], at["text"], at["lang"])
    told = ppm_language.identify(own, model, at["doc_id"], at["text"], keep=own.columns)
    told = told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).withColumn(at["lang"], F.col("lang_pred"))
    return told.select(*own.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document with the smallest id (null first), one of its rows if it is repeated.

    Near are documents whose sets of five-word shingles have a Jaccard coefficient of
    0.8 or more, found by SimHash and an exact check, and by a prefix filter what the
    bits lose; groups are closed over such pairs.  Null, empty and blank texts are
    one group.  Of rows with one id and different texts the checksum orders; further
    columns, whatever their names, stay; an empty table gives an empty one.
    """
    own, at = _private(docs)
    keyed = own.withColumn("__key", F.struct(F.col(at["doc_id"]).alias("doc_id"), text_key(F.col(at["text"])).alias("crc")))
    groups = near_copies.near_copies(keyed, id_col="__key", text_col=at["text"])
    first = stored(groups.where(F.col("__key").eqNullSafe(F.col("component_id"))).groupBy("__key").count(), "first")
    named = first.select(F.col("__key").alias("__first"))
    kept = keyed.join(named, F.col("__key").eqNullSafe(F.col("__first")), "left_semi")
    if not first.where("count > 1").isEmpty():  # repeated rows
        kept = kept.dropDuplicates(["__key"])
    return kept.select(*own.columns).toDF(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 100 bytes that start earlier too out of the texts. Documents of which nothing but white space is left go.

    Characters that a cut leaves in part are dropped; ``n_chars`` counts
    anew there.  Rows
    of which nothing was taken stay as they are, null and empty texts too.  Repeated
    rows count as one document.  Further columns, whatever their names, stay; an empty
    table gives an empty one.
    """
    own, at = _private(docs)
    own = own.withColumn("__null", F.col(at["text"]).isNull())
    out = suffix_dedup.remove_repeats(own, at["doc_id"], at["text"], keep=[c for c in own.columns if c != at["text"]])
    # A cut may leave the rest of a character: make_valid_utf8 puts U+FFFD there, which goes; texts that hold it themselves are whole.
    whole = F.size("span_starts") == 0
    text = F.when(F.col("__null"), F.lit(None)).when(whole, F.col("kept").cast("string")).otherwise(F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("�"), F.lit("")))
    cleaned = out.withColumn(at["text"], text).where((F.length(F.trim(F.regexp_replace(at["text"], "\\s+", " "))) > 0) | whole)
    if "n_chars" in at:
        cleaned = cleaned.withColumn(at["n_chars"], F.when(whole, F.col(at["n_chars"])).otherwise(F.length(at["text"])).cast(own.schema[at["n_chars"]].dataType))
    return cleaned.select(*at.values()).toDF(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more lie in passages of the benchmark.

    Null and empty texts have no words and stay; repeated rows are judged alike;
    further columns, whatever their names, stay; an empty table gives an empty one.
    """
    own, at = _private(docs)
    out = decontaminate.decontaminate(own, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), at["doc_id"], at["text"], keep=own.columns)
    return out.where("NOT contaminated").select(*own.columns).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences of 2048 tokens, with their ids: a row per piece; null and empty texts are their end id, other columns are ignored."""
    return vector_pack.pack_examples(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packing),
]

#: SQL can't express the stages; the tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        unstored(before)
    return docs
