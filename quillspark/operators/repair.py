"""Repair actions on flagged documents, and the worklists of what isn't repaired by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.operators import detectors


def reverse_runs(docs: DataFrame) -> DataFrame:
    """RA1: (doc_id, text, repaired, healed): Hebrew runs with misplaced final forms are reversed outside fences, links and frontmatter; healed if the detector is silent afterwards."""
    hebrew = "\\u05D0-\\u05EA\\u05B0-\\u05C7\\u05F3\\u05F4"
    run = f"[{hebrew}]{{2,}}"

    def fixed(line: Column) -> Column:
        # Runs and what lies between them alternate; links are among the latter, and what starts neither goes in one piece.
        parts = F.regexp_extract_all(line, F.lit(f"!?\\[\\[?[^\\]]*\\]\\]?(?:\\([^)]*\\))?|{run}|[^!\\[{hebrew}]+|(?s)."), F.lit(0))
        wrong = lambda r: F.substring(r, 1, 1).isin(list(detectors.FINALS)) | F.right(r, F.lit(1)).isin(list(detectors.TWINS))
        return F.array_join(F.transform(parts, lambda r: F.when(wrong(r) & r.rlike(f"^{run}$"), F.reverse(r)).otherwise(r)), "")

    every = lambda numbers: F.transform(F.split("text", "\n"), lambda x, i: F.when(x.rlike(run) & F.array_contains(numbers, i + 1), fixed(x)).otherwise(x))
    text = F.when(F.col("text").rlike(run), let(F.transform("__cl", lambda z: z["n"]), lambda numbers: F.array_join(every(numbers), "\n"))).otherwise(F.col("text"))
    out = detectors.prepared(docs).select("doc_id", "raw", "path", F.col("text").alias("__before"), text.alias("text"))
    # The detector reads the repaired text in the same row.
    d = detectors.REGISTRY["rtl_char_reversed"]
    again = detectors.prepared(out).select("doc_id", "__before", "text", F.struct(*[c.alias(k) for k, c in d.base().items()]).alias("__v"))
    _, fired = d.judge({k: F.col("__v")[k] for k in d.base()}, d.threshold)
    return again.select("doc_id", F.col("__before").alias("text"), F.col("text").alias("repaired"), (~F.coalesce(fired, F.lit(False))).alias("healed"))


def reverse_words(line: Column) -> Column:
    """RA2: the words of a segment in reverse order; for review only."""
    return F.array_join(F.reverse(F.split(line, " ")), " ")


def extract_base64(docs: DataFrame) -> DataFrame:
    """RA3: (doc_id, text, blobs): inline images become references into the store; what doesn't decode to an image stays."""
    uri = "data:[\\w.+-]+/[\\w.+-]+;base64,[A-Za-z0-9+/=\\s]{40,}"
    found = F.transform(F.regexp_extract_all("text", F.lit(uri), F.lit(0)), lambda u: F.struct(u.alias("uri"), detectors.decoded(F.regexp_replace(u, "^[^,]*,", "")).alias("data")))
    images = F.filter(found, lambda z: F.coalesce(detectors.magic_type(z["data"]).isin(detectors.IMAGE_TYPES), F.lit(False)))
    blobs = F.transform(images, lambda z: F.struct(F.sha2(z["data"], 256).alias("sha"), z["uri"].alias("uri"), z["data"].alias("data")))
    text = F.aggregate("blobs", F.col("text"), lambda acc, b: F.replace(acc, b["uri"], F.concat(F.lit("store/"), F.substring(b["sha"], 1, 2), F.lit("/"), b["sha"])))
    return docs.withColumn("blobs", blobs).select("doc_id", text.alias("text"), F.transform("blobs", lambda b: F.struct(b["sha"].alias("sha"), b["data"].alias("data"))).alias("blobs"))


def worklist(findings: DataFrame, route: str) -> DataFrame:
    """RA4-RA6: documents of a route with the detectors that sent them there."""
    return findings.where(F.col("fired") & (F.col("route") == route)).groupBy("doc_id").agg(F.array_sort(F.collect_set("detector")).alias("detectors"))


def reroute_manifest(docs: DataFrame) -> DataFrame:
    """RA6: (doc_id, type, action): office files can be recovered, archives unpacked, the rest goes to its own converter."""
    kind = detectors.magic_type(F.col("raw"))
    ooxml = F.instr(F.hex(F.substring(F.col("raw"), 1, 4096)), "5B436F6E74656E745F54797065735D2E786D6C") > 0
    return docs.select("doc_id", kind.alias("type"), F.when((kind == "zip") & ooxml, "recover_office").when(kind.isin("zip", "rar", "7z", "gzip"), "unpack").otherwise("convert").alias("action")).where("type IS NOT NULL")


def review_rows(repairs: DataFrame, most: int = 1000, percent: int = 10) -> DataFrame:
    """RA8: before and after of every change; above ``most`` changes a hash sample of them (a sampling operator)."""
    changed = repairs.where("text <> repaired").select("doc_id", F.substring("text", 1, 160).alias("before"), F.substring("repaired", 1, 160).alias("after"))
    if changed.count() <= most:
        return changed
    return changed.where(F.conv(F.substring(F.sha2(F.col("doc_id").cast("string").cast("binary"), 256), 1, 8), 16, 10).cast("long") % 100 < percent)


def next_engine(attempts: DataFrame, engines: list[str]) -> DataFrame:
    """RA9: per document the first engine of its chain that hasn't been tried; null and poisoned when all were."""
    tried = attempts.groupBy("doc_id").agg(F.collect_set("engine").alias("tried"))
    left = F.filter(F.array(*[F.lit(e) for e in engines]), lambda e: ~F.array_contains("tried", e))
    return tried.select("doc_id", F.try_element_at(left, F.lit(1)).alias("engine"), (F.size(left) == 0).alias("poisoned"))
