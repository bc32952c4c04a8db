"""Grading of answers against known facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import cites, is_refusal, overlap_percent, stripped


def grade(cases: DataFrame) -> DataFrame:
    """(case_id, passed, overlap, missing) of cases (case_id, grp, gold, expected ARRAY, answer).

    T2 passes by a refusal alone.  The others need every expected note named; in T3
    one may be missing if more than two are expected.
    """
    missing = F.filter("expected", lambda s: ~cites(F.col("answer"), s))
    allowed = F.when((F.col("grp") == "T3") & (F.size("expected") > 2), 1).otherwise(0)
    passed = F.when(F.col("grp") == "T2", is_refusal(F.col("answer"))).otherwise(F.size("missing") <= allowed)
    return cases.withColumn("missing", missing).select("case_id", passed.alias("passed"), overlap_percent(F.col("gold"), F.col("answer")).alias("overlap"), F.when(F.col("grp") == "T2", F.array().cast("array<string>")).otherwise(F.col("missing")).alias("missing"))


def parse_cases(files: DataFrame, text: str) -> DataFrame:
    """(grp, number, question, gold, expected) from the numbered table rows below ``## T1`` and so on."""
    sections = F.split(text, "(?m)^## ")
    s = files.select(F.explode(sections).alias("s")).select(F.regexp_extract("s", "^(T[0-9])", 1).alias("grp"), F.explode(F.split("s", "\n")).alias("line")).where("grp <> ''")
    cells = s.where(F.col("line").rlike("^\\s*\\|")).select("grp", F.transform(F.split(F.regexp_replace(stripped(F.col("line")), "^\\||\\|$", ""), "\\|"), lambda c: stripped(c)).alias("c")).where(F.col("c")[0].rlike("^[0-9]+$"))
    get = lambda i: F.coalesce(F.try_element_at("c", F.lit(i)), F.lit(""))
    return cells.select("grp", get(1).cast("int").alias("number"), get(2).alias("question"), get(3).alias("gold"), F.regexp_extract_all(get(4), F.lit("`([^`]+)`"), F.lit(1)).alias("expected"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Index documents that hold a test item's text word for word; (doc_id, item_id).

    Items and documents meet on the hash of an item's first five words, or of all
    where it has fewer, so no text is compared with all items.
    """
    words = lambda c: F.filter(F.split(F.lower(c), "\\s+"), lambda w: w != "")
    i = items.select("item_id", words(F.col("text")).alias("iw")).where(F.size("iw") > 0).withColumn("k", F.least(F.size("iw"), F.lit(5)))
    i = i.withColumn("h", F.xxhash64("k", F.slice("iw", F.lit(1), F.col("k"))))
    d = docs.select("doc_id", words(F.col("text")).alias("dw"))
    kinds = sorted(r["k"] for r in i.select("k").distinct().collect())  # five at most
    starts = lambda k: F.when(F.size("dw") >= k, F.transform(F.sequence(F.lit(0), F.size("dw") - k), lambda p: F.struct(p.alias("pos"), F.xxhash64(F.lit(k), F.slice("dw", p + 1, F.lit(k))).alias("h")))).otherwise(F.array().cast("array<struct<pos:int,h:bigint>>"))
    grams = d.select("doc_id", "dw", F.explode(F.concat(F.array().cast("array<struct<pos:int,h:bigint>>"), *[starts(k) for k in kinds])).alias("x")).select("doc_id", "dw", "x.pos", "x.h")
    return grams.join(i, "h").where(F.slice("dw", F.col("pos") + 1, F.size("iw")) == F.col("iw")).select("doc_id", "item_id").distinct()
