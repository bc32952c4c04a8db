"""What surrounds file conversion: routing, skipping, attachments, notebooks, diagrams, mail."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.shipping import ship
from quillspark.functions.text import diagram_label, email_header, mirrored_path, safe_attachment

#: Converter by file extension.
CONVERTERS = {
    "pdf": "docling", "docx": "docling", "pptx": "docling", "xlsx": "docling", "xls": "docling",
    "html": "pandoc", "htm": "pandoc", "mht": "pandoc", "mhtml": "pandoc",
    "txt": "markitdown", "csv": "markitdown",
    "eml": "eml", "msg": "msg", "vsdx": "vsdx", "one": "onenote",
}


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, "\\.([^./]+)$", 1))


def route(files: DataFrame) -> DataFrame:
    """S3: adds converter and status; an extension without one is skipped."""
    table = F.create_map(*[F.lit(x) for kv in CONVERTERS.items() for x in kv])
    c = F.try_element_at(table, extension(F.col("path")))
    return files.withColumn("converter", c).withColumn("status", F.when(c.isNull(), "skipped").otherwise("pending"))


def up_to_date(sources: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """Sources (path, mtime) that need converting: no output, or an older one."""
    o = outputs.toDF("out_path", "out_mtime")
    joined = sources.withColumn("out_path", mirrored_path(F.col("path"))).join(o, "out_path", "left")
    return joined.where(F.lit(force) | F.col("out_mtime").isNull() | (F.col("out_mtime") < F.col("mtime"))).select("path", "mtime")


def created(meta: Column, mtime: Column, now: Column) -> Column:
    """Creation time from the metadata, else the file; null if it is less than a day old."""
    c = F.coalesce(meta, mtime)
    return F.when(now - c > F.expr("INTERVAL 24 HOURS"), c)


def subsumed(files: DataFrame, notebooks: DataFrame) -> DataFrame:
    """Section files inside a notebook's folder, with that folder (its path is a prefix)."""
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(F.split("path", "/")) - 1, F.lit(1))), lambda n: F.array_join(F.slice(F.split("path", "/"), F.lit(1), n), "/"))
    each = files.select("path", F.explode(parents).alias("folder"))
    return each.join(notebooks.select("folder"), "folder", "left_semi").groupBy("path").agg(F.min("folder").alias("notebook"))


def attachment_names(attachments: DataFrame) -> DataFrame:
    """(mail, ord, name, safe_name); a taken name gets _1, _2 and so on."""
    safe = attachments.withColumn("base", safe_attachment(F.col("name")))
    n = F.row_number().over(W.partitionBy("mail", "base").orderBy("ord")) - 1
    stem, ext = F.regexp_replace("base", "\\.[^.]*$", ""), F.regexp_extract("base", "(\\.[^.]*)$", 1)
    return safe.withColumn("n", n).select("mail", "ord", "name", F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat(stem, F.lit("_"), F.col("n").cast("string"), ext)).alias("safe_name"))


def canonical_link(md_by_hash: Column, canonical: Column) -> Column:
    """where a duplicate attachment's link goes: the converted copy, else the canonical file's markdown."""
    return F.coalesce(md_by_hash, mirrored_path(F.try_element_at(F.split(canonical, "#"), F.lit(1))))


def diagram_edges(shapes: DataFrame, connects: DataFrame) -> DataFrame:
    """(connector, source, target): a connector's first two ends, by label; without one, ``Shape <id>``."""
    ends = connects.groupBy("connector").agg(F.array_sort(F.collect_list(F.struct("ord", "shape"))).alias("e")).where(F.size("e") >= 2)
    pair = ends.select("connector", F.col("e")[0]["shape"].alias("a"), F.col("e")[1]["shape"].alias("b"))
    label = shapes.select(F.col("shape").alias("id"), diagram_label(F.col("text"), 40).alias("label"))
    la, lb = label.toDF("a", "la"), label.toDF("b", "lb")
    name = lambda text, key: F.coalesce(F.nullif(F.col(text), F.lit("")), F.concat(F.lit("Shape "), F.col(key)))
    return pair.join(la, "a", "left").join(lb, "b", "left").select("connector", name("la", "a").alias("source"), name("lb", "b").alias("target"))


def mermaid(edges: DataFrame) -> DataFrame:
    """One line of a flow chart per edge, in order of the connectors."""
    return edges.select("connector", F.concat(F.lit('    "'), "source", F.lit('" --> "'), "target", F.lit('"')).alias("line")).orderBy("connector")


def note_name(title: Column, idx: Column) -> Column:
    """File name of a notebook page: safe characters, at most 80 of them, with its number."""
    safe = F.trim(F.substring(F.regexp_replace(title, '[\\\\/:*?"<>|\\x00-\\x1f]', "_"), 1, 80))
    return F.concat(F.when(safe == "", F.lit("page")).otherwise(safe), F.lit("-"), idx.cast("string"))


def live_pages(pages: DataFrame) -> DataFrame:
    """Pages that are neither deleted nor conflicts nor history."""
    return pages.where("NOT deleted AND NOT conflict AND NOT history")


def parse_mail(files: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``mail``: subject, sender, recipient, date (UTC), markdown and attachments. Arrow batches over the standard parser."""
    ship(files.sparkSession)

    @F.pandas_udf("subject string, sender string, recipient string, date string, created timestamp, body string, attachments array<struct<name:string,payload:binary>>")
    def parse(x):  # noqa: ANN001, ANN202
        import datetime
        import email
        import email.policy
        import email.utils

        import pandas as pd

        rows = []
        for data in x:
            m = email.message_from_bytes(bytes(data) if data is not None else b"", policy=email.policy.default)
            part = m.get_body(("plain", "html"))
            text = part.get_content() if part is not None else ""
            try:
                when = email.utils.parsedate_to_datetime(m["date"])
                when = when.replace(tzinfo=datetime.UTC) if when.tzinfo is None else when.astimezone(datetime.UTC)
            except (TypeError, ValueError):
                when = None
            files = [{"name": a.get_filename() or "", "payload": a.get_payload(decode=True) or b""} for a in m.iter_attachments()]
            rows.append((m["subject"], m["from"], m["to"], m["date"], when.replace(tzinfo=None) if when else None, text, files))
        return pd.DataFrame(rows, columns=["subject", "sender", "recipient", "date", "created", "body", "attachments"])

    out = files.withColumn("mail", parse(F.col(raw)))
    m = F.col("mail")
    return out.withColumn("markdown", F.concat(email_header(m["subject"], m["sender"], m["recipient"], m["date"]), F.lit("\n\n"), F.coalesce(m["body"], F.lit(""))))


def report(rows: DataFrame) -> DataFrame:
    """How many files have each status."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def convert(files: DataFrame, existing: DataFrame, converters: dict[str, Callable[[Column], Column]], force: bool = False) -> DataFrame:
    """The report of a conversion run: (path, status, reason, duplicate_of, converter, md).

    ``files``: path, raw, mtime; ``existing``: path and mtime of outputs; ``converters``:
    by converter an expression of the bytes that gives a struct of md and error (X4: the
    caller's own; one that is missing fails its files).  Files go by path: those without
    a converter are skipped, sections inside a notebook's folder belong to it, a content
    that an earlier file had is a duplicate, and what has a newer output is up to date.
    """
    table = F.create_map(*[F.lit(x) for kv in CONVERTERS.items() for x in kv])
    ext = extension(F.col("path"))
    known = files.withColumn("sha", F.sha2("raw", 256)).withColumn("converter", F.when(ext == "onetoc2", "onenote").otherwise(F.try_element_at(table, ext)))
    folders = files.where(ext == "onetoc2").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).distinct()
    inner = subsumed(files.where(ext == "one"), folders).select("path", F.lit(True).alias("inner"))
    known = known.join(inner, "path", "left")
    open_ = F.col("converter").isNotNull() & F.col("inner").isNull()
    # Notebooks don't take part in the comparison of contents.
    first = known.where(open_ & (F.col("converter") != "onenote")).groupBy("sha").agg(F.min("path").alias("first"))
    done = existing.select(F.col("path").alias("out_path"), F.col("mtime").alias("out_mtime"))
    rows = known.join(first, "sha", "left").withColumn("out_path", mirrored_path(F.col("path"))).join(done, "out_path", "left")
    copied = open_ & (F.col("converter") != "onenote") & (F.col("first") != F.col("path"))
    fresh = F.coalesce(F.col("out_mtime") >= F.col("mtime"), F.lit(False)) & F.lit(not force)
    reason = (
        F.when(F.col("converter").isNull(), F.concat(F.lit("unsupported extension "), F.when(ext == "", F.lit("")).otherwise(F.concat(F.lit("."), ext))))
        .when(F.col("inner"), "part of notebook dir (handled via .onetoc2)")
        .when(copied, F.lit(None))
        .when(fresh, "up to date")
    )
    tried = open_ & ~copied & ~fresh
    empty = F.struct(F.lit(None).cast("string").alias("md"), F.lit("no converter").alias("error"))
    result = F.lit(None).cast("struct<md:string,error:string>")
    made = None
    for name, f in sorted(converters.items()):
        case = F.col("converter") == name
        out = f(F.col("raw"))
        one = F.struct(out["md"].cast("string").alias("md"), out["error"].cast("string").alias("error"))
        made = F.when(case, one) if made is None else made.when(case, one)
    made = empty if made is None else made.otherwise(empty)
    rows = rows.withColumn("reason", reason).withColumn("copied", copied).withColumn("x", F.when(tried, made).otherwise(result))
    status = F.when(F.col("copied"), "duplicate").when(F.col("reason").isNotNull(), "skipped").when(F.col("x.error").isNotNull(), "failed").otherwise("converted")
    return rows.select("path", status.alias("status"), F.coalesce("reason", "x.error").alias("reason"), F.when(F.col("copied"), F.col("first")).alias("duplicate_of"), F.when(status == "converted", F.col("converter")).alias("converter"), F.when(status == "converted", F.col("x.md")).alias("md"))
