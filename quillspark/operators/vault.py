"""Vault commands as conditional inserts: ingest, new note, write-back, frontmatter patches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.markdown import body, frontmatter
from quillspark.functions.text import slug_title, slugify, yaml_quoted


def render(template: str, values: dict[str, Column]) -> Column:
    """A template with its {{NAMES}} filled in."""
    out = F.lit(template)
    for name, value in sorted(values.items()):
        out = F.replace(out, F.lit(f"{{{{{name}}}}}"), value)
    return out


def ingest(clippings: DataFrame, registry: DataFrame, today: str) -> DataFrame:
    """Registry rows (slug, title, author, source, published) and log lines of clippings that aren't registered; running it again adds none."""
    fm = frontmatter(F.col("text"))
    one = lambda k: F.coalesce(F.try_element_at(F.try_element_at(fm, F.lit(k)), F.lit(1)), F.lit(""))
    rows = clippings.select("stem", one("title").alias("title"), one("author").alias("author"), one("source").alias("source"), one("published").alias("published"))
    rows = rows.withColumn("slug", slugify(F.coalesce(F.nullif("title", F.lit("")), F.col("stem"))))
    new = rows.join(registry.select("slug"), "slug", "left_anti").dropDuplicates(["slug"])
    return new.withColumn("log_line", F.concat(F.lit(f"## [{today}] ingest | "), F.col("title")))


def new_notes(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """C4: notes to be made of titles; a stem that exists is refused."""
    w = wanted.select("title", slugify(F.col("title")).alias("stem")).dropDuplicates(["stem"])
    return w.join(docs.select("stem").distinct(), "stem", "left_anti").select("stem", F.concat(F.lit("---\ntitle: "), yaml_quoted(F.col("title")), F.lit("\n---\n\n# "), slug_title(F.col("stem")), F.lit("\n")).alias("text"))


def log_entries(log: DataFrame) -> DataFrame:
    """M5: (date, op, title) of a log's headings."""
    pattern = "^## \\[(\\d{4}-\\d{2}-\\d{2})\\] (\\S+) \\| (.*)$"
    line = log.select(F.explode(F.split("text", "\n")).alias("l")).where(F.col("l").rlike(pattern))
    return line.select(F.to_date(F.regexp_extract("l", pattern, 1)).alias("date"), F.regexp_extract("l", pattern, 2).alias("op"), F.regexp_extract("l", pattern, 3).alias("title"))


def accepted_text(text: Column, primary: Column, secondary: Column, trust: Column) -> Column:
    """a note with its frontmatter rewritten on acceptance: other keys stay in their order, the decision's keys are set."""
    fm = frontmatter(text)
    names = ["domains", "doc_decision", "decided_by", "doc_type", "trust", "level"]
    kept = F.filter(F.map_entries(fm), lambda e: ~e["key"].isin(names))
    scalar = lambda v: F.when(v.rlike("^(?:null|true|false|-?[0-9]+(?:\\.[0-9]+)?)$") | v.rlike("^[A-Za-z_][\\w -]*$"), v).otherwise(yaml_quoted(v))
    shown = F.transform(kept, lambda e: F.when(F.size(e["value"]) == 1, F.concat(e["key"], F.lit(": "), scalar(e["value"][0]))).otherwise(F.concat(e["key"], F.lit(":"), F.array_join(F.transform(e["value"], lambda v: F.concat(F.lit("\n  - "), scalar(v))), ""))))
    domains = F.concat(F.lit("domains:"), F.array_join(F.transform(F.concat(F.array(primary), secondary), lambda v: F.concat(F.lit("\n  - "), scalar(v))), ""))
    own = F.array(domains, F.concat(F.lit("doc_decision: "), scalar(primary)), F.lit("decided_by: model"), F.lit("doc_type: classified"), F.concat(F.lit("trust: "), trust), F.lit('level: "1"'))
    return F.concat(F.lit("---\n"), F.array_join(F.concat(shown, own), "\n"), F.lit("\n---\n\n"), body(text))


def write_back(question: Column, answer: Column) -> Column:
    """An answer kept as a note of type analysis."""
    return F.concat(F.lit("---\ntitle: "), yaml_quoted(question), F.lit("\ntype: analysis\n---\n\n"), answer)


def scaffold(owned: DataFrame, scaffold_only: DataFrame, existing: DataFrame) -> DataFrame:
    """(path, tier) that a new vault lays down: the owned paths, then those of the scaffold alone; an error where the folder holds anything."""
    if not existing.isEmpty():
        raise FileExistsError("the vault exists and isn't empty")
    return owned.select("path", F.lit("owned").alias("tier")).unionAll(scaffold_only.select("path", F.lit("scaffold_only").alias("tier")))


#: Fixed values, the collections that are searched, with the folders they hold; tests are left out on purpose.
COLLECTIONS = {"sources": "raw", "concepts": "wiki", "indices": "index"}


def register_collections(docs: DataFrame, run: Callable[[str, DataFrame], bool] | None = None) -> DataFrame:
    """(collection, folder, docs) of what is registered; ``run`` takes each collection's name and documents, and the first that it refuses is an error."""
    top = F.regexp_extract("folder", "^([^/]*)", 1)
    table = F.create_map(*[F.lit(x) for name, folder in COLLECTIONS.items() for x in (folder, name)])
    known = docs.withColumn("collection", F.try_element_at(table, top)).where("collection IS NOT NULL")
    for name in COLLECTIONS if run else ():
        if not run(name, known.where(F.col("collection") == name)):
            raise RuntimeError(f"registering {name} failed")
    return known.groupBy("collection", top.alias("folder")).agg(F.count("*").alias("docs"))
