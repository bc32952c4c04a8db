"""Integrity of a vault: links, orphans, sources, log, reachability, duplicate stems.

``docs`` holds stem, path, folder and text.  Link targets are notes directly in
raw, wiki, wiki/sources and index; links are looked for in wiki and index with
all their subfolders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.markdown import wikilinks
from quillspark.operators.graph import cut_lineage, reachable

#: The folders of link targets, in the order in which stems are taken.
TARGET_FOLDERS = ["raw", "wiki", "wiki/sources", "index"]


def in_wiki(docs: DataFrame) -> DataFrame:
    return docs.where((F.col("folder") == "wiki") | F.col("folder").startswith("wiki/"))


def link_sources(docs: DataFrame) -> DataFrame:
    return docs.where((F.col("folder") == "wiki") | F.col("folder").startswith("wiki/") | (F.col("folder") == "index") | F.col("folder").startswith("index/"))


def links(docs: DataFrame) -> DataFrame:
    """M3: (stem, path, pos, target), an occurrence each."""
    return docs.select("stem", "path", F.posexplode(wikilinks(F.col("text"))).alias("pos", "target"))


def targets(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("folder").isin(TARGET_FOLDERS)).select("stem").distinct()


def broken_links(docs: DataFrame, known_external: tuple[str, ...] = (), found: DataFrame | None = None) -> DataFrame:
    """Links of wiki and index notes to no note and none of the names that are no note on purpose."""
    found = links(link_sources(docs)) if found is None else found
    if known_external:
        found = found.where(~F.col("target").isin(*known_external))
    return found.join(targets(docs).withColumnRenamed("stem", "target"), "target", "left_anti").select("path", "target", "pos")


def _linked(docs: DataFrame, found: DataFrame | None) -> DataFrame:
    return (links(link_sources(docs)) if found is None else found).select("target").distinct()


def orphans(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Wiki notes that no wiki or index note links to (a link to itself counts)."""
    return in_wiki(docs).join(_linked(docs, found), F.col("stem") == F.col("target"), "left_anti").select("path", "stem")


def unreferenced_raw(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    return docs.where("folder = 'raw'").join(_linked(docs, found), F.col("stem") == F.col("target"), "left_anti").select("path", "stem")


def missing_sources(docs: DataFrame) -> DataFrame:
    """P5: plain text tests on the whole note, as defined."""
    exempt = F.contains("text", F.lit("type: index")) | F.contains("text", F.lit("type: analysis"))
    return docs.where((F.col("folder") == "wiki") & ~exempt & ~F.contains("text", F.lit("sources:"))).select("path", "stem")


def todo_markers(docs: DataFrame) -> DataFrame:
    """P6."""
    return in_wiki(docs).where(F.contains("text", F.lit("<!-- TODO"))).select("path", "stem")


def named_in(stems: DataFrame, text: DataFrame) -> DataFrame:
    """Stems (stem) that a text (text: one long row, or several) holds somewhere, as a part of a word too; distinct.

    The text's lines are dealt out, and every run of a length that some stem has meets
    the stems by equality; a file name has at most 255 characters, so there are few lengths.
    """
    own = stems.select("stem").distinct()
    lengths = sorted(r["n"] for r in own.select(F.length("stem").alias("n")).distinct().where("n > 0").collect())
    lines_ = text.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    runs = lambda n: F.when(F.length("line") >= n, F.transform(F.sequence(F.lit(1), F.length("line") - n + 1), lambda i: F.substring(F.col("line"), i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    every = F.array_distinct(F.concat(F.array().cast("array<string>"), *[runs(n) for n in lengths]))
    return own.join(lines_.select(F.explode(every).alias("stem")).distinct(), "stem", "left_semi")


def missing_log_entries(docs: DataFrame) -> DataFrame:
    """Raw notes whose stem isn't in the log's text."""
    log = docs.where("folder = 'index' AND stem = 'log'")
    if log.isEmpty():
        return docs.sparkSession.createDataFrame([("index/log.md", "log")], "path string, stem string")
    raw = docs.where("folder = 'raw'").select("path", "stem")
    return raw.join(named_in(raw, log.select("text")), "stem", "left_anti").where("stem <> ''").select("path", "stem")


def duplicate_stems(docs: DataFrame) -> DataFrame:
    """Later copies of a stem against the first in folder order, by path."""
    rank = F.array_position(F.array(*[F.lit(x) for x in TARGET_FOLDERS]), F.col("folder"))
    order = W.partitionBy("stem").orderBy(rank, "path")
    ranked = docs.where(F.col("folder").isin(TARGET_FOLDERS)).select("stem", "path", "folder").withColumn("r", F.row_number().over(order)).withColumn("first_path", F.first("path").over(order))
    return ranked.where("r > 1").select("stem", "path", "first_path")


def unreachable(docs: DataFrame, start: str = "_map-of-content") -> DataFrame:
    """Wiki notes that links from the map of content don't reach, through notes of any folder."""
    rank = F.array_position(F.array(*[F.lit(x) for x in TARGET_FOLDERS]), F.col("folder"))
    last = docs.where(F.col("folder").isin(TARGET_FOLDERS)).groupBy("stem").agg(F.max_by("text", F.struct(rank, "path")).alias("text"))
    edges = last.select(F.col("stem").alias("src"), F.explode(wikilinks(F.col("text"))).alias("dst")).distinct()
    edges = cut_lineage(edges.join(last.select(F.col("stem").alias("dst")), "dst", "left_semi").select("src", "dst"))
    seen = reachable(edges, [start])
    return in_wiki(docs).join(seen.select(F.col("node").alias("stem")), "stem", "left_anti").select("path", "stem")


def findings(docs: DataFrame) -> DataFrame:
    """Every check's findings (check, subject, detail). Links are read off the notes once."""
    found = cut_lineage(links(link_sources(docs)))
    parts = [
        broken_links(docs, found=found).select(F.lit("broken_link").alias("check"), F.col("path").alias("subject"), F.col("target").alias("detail")),
        orphans(docs, found).select(F.lit("orphan"), "path", "stem"),
        unreferenced_raw(docs, found).select(F.lit("unreferenced_raw"), "path", "stem"),
        missing_sources(docs).select(F.lit("missing_sources"), "path", "stem"),
        missing_log_entries(docs).select(F.lit("no_log_entry"), "path", "stem"),
        unreachable(docs).select(F.lit("unreachable"), "path", "stem"),
        duplicate_stems(docs).select(F.lit("duplicate_stem"), "path", "first_path"),
        todo_markers(docs).select(F.lit("todo"), "path", "stem"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


#: Fixed values, what may be done about a finding; anything else stops and is reported.
ALLOWED_FIXES = {"broken_link": "repair_link", "orphan": "add_inbound_link", "unreferenced_raw": "ingest", "missing_sources": "add_sources", "no_log_entry": "append_log", "unreachable": "link_from_map"}


def with_fix(found: DataFrame) -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in ALLOWED_FIXES.items() for x in kv])
    return found.withColumn("fix", F.coalesce(F.try_element_at(table, F.col("check")), F.lit("report")))


def summary_exists(docs: DataFrame) -> DataFrame:
    """Raw stems that a note's ``sources`` list names, as [[stem]] or plainly."""
    from quillspark.functions.markdown import frontmatter

    named = in_wiki(docs).select(F.explode(F.try_element_at(frontmatter(F.col("text")), F.lit("sources"))).alias("s"))
    return named.select(F.regexp_replace("s", "^[\\[\\]]+|[\\[\\]]+$", "").alias("stem")).distinct()


def status(docs: DataFrame) -> DataFrame:
    """Per raw note whether it has a summary, is in the registry and is in the log."""
    raw = docs.where("folder = 'raw'").select("stem").distinct()
    note = lambda name: named_in(raw, docs.where((F.col("folder") == "index") & (F.col("stem") == name)).select("text")).withColumn(name, F.lit(True))
    has = summary_exists(docs).withColumn("has", F.lit(True))
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), "yes").otherwise("NO")
    joined = raw.join(has, "stem", "left").join(note("registry"), "stem", "left").join(note("log"), "stem", "left")
    return joined.select("stem", yes(F.col("has")).alias("summary"), yes(F.col("registry")).alias("registry"), yes(F.col("log")).alias("log"))


def notes_checked(docs: DataFrame) -> int:
    """R2: how many distinct stems a lint looks at."""
    return targets(docs).count()


def check(docs: DataFrame, stamped: str | None, installed: str) -> DataFrame:
    """One row (findings, todos, notes, drift, exit_status): 1 if there is a finding, a TODO marker or another framework version than stamped; no stamp is no drift."""
    counted = findings(docs).agg(F.count_if(F.col("check") != "todo").alias("findings"), F.count_if(F.col("check") == "todo").alias("todos"))
    drift = F.lit(stamped is not None and stamped != installed)
    failed = (F.col("findings") > 0) | (F.col("todos") > 0) | drift
    return counted.select("findings", "todos", F.lit(notes_checked(docs)).cast("long").alias("notes"), drift.alias("drift"), F.when(failed, 1).otherwise(0).alias("exit_status"))
