"""Glossaries in layers, and checks of translated documents against their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.markdown import lines, wikilinks
from quillspark.functions.text import stripped

#: Layers from the narrowest on.
LAYERS = ["subdomain", "domain", "organisation"]


def resolve(terms: DataFrame, glossary: DataFrame) -> DataFrame:
    """(term, english, layer) of the narrowest layer that has the term; null if none does."""
    rank = F.array_position(F.array(*[F.lit(x) for x in LAYERS]), F.col("layer"))
    best = glossary.groupBy("term").agg(F.min_by(F.struct("english", "layer"), F.struct(rank, "english")).alias("b"))
    return terms.join(best, "term", "left").select("term", F.col("b.english").alias("english"), F.col("b.layer").alias("layer"))


def collisions(glossary: DataFrame) -> DataFrame:
    """Q16: renderings that several terms share, and terms with several rows in a layer."""
    shared = glossary.groupBy("english").agg(F.countDistinct("term").alias("n")).where("n > 1").select(F.lit("shared_rendering").alias("kind"), F.col("english").alias("item"), "n")
    return shared.union(glossary.groupBy("term", "layer").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_term"), "term", "n"))


def unregistered_overrides(glossary: DataFrame) -> DataFrame:
    """Q5: rows of a narrower layer that differ from a wider one without saying so."""
    rank = F.array_position(F.array(*[F.lit(x) for x in LAYERS]), F.col("layer"))
    g = glossary.withColumn("rank", rank)
    wide = g.select("term", F.col("rank").alias("wide_rank"), F.col("english").alias("wide_english"))
    return g.where("overrides IS NULL").join(wide, "term").where("wide_rank > rank AND wide_english <> english").select("term", "layer").distinct()


def inconsistent(renderings: DataFrame) -> DataFrame:
    """Q4: source terms with several renderings in the corpus."""
    return renderings.groupBy("term").agg(F.countDistinct("english").alias("n")).where("n > 1")


def numbers(text: Column) -> Column:
    return F.array_sort(F.regexp_extract_all(text, F.lit("[0-9]+(?:[.,][0-9]+)*%?"), F.lit(0)))


def heading_levels(text: Column) -> Column:
    return F.transform(F.filter(lines(text), lambda x: x.rlike("^#{1,6}\\s")), lambda x: F.length(F.regexp_extract(x, "^(#+)", 1)))


def structure(text: Column) -> Column:
    ls = lines(text)
    count = lambda pattern: F.size(F.filter(ls, lambda x: x.rlike(pattern)))
    return F.array(count("^\\s*([-*+]|[0-9]+\\.)\\s"), count("^\\s*\\|.*\\|\\s*$"), count("^\\s*(```|~~~)"))


def hebrew_ratio(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.round(F.length(F.regexp_replace(text, "[^\\u0590-\\u05FF]", "")) / F.length(text), 4)).otherwise(0.0)


def checks(source: Column, target: Column, most_hebrew: float = 0.02, low: float = 0.5, high: float = 2.5) -> dict[str, Column]:
    """Q1, Q2, Q7-Q12 of a pair: True means passed. The bands are ours."""
    unmarked = F.regexp_replace(target, "⟦he:[^⟧]*⟧", "")
    paragraphs = F.split(unmarked, "\n\n")
    ratio = F.length(target) / F.greatest(F.length(source), F.lit(1))
    fences = F.size(F.filter(lines(target), lambda x: stripped(x).startswith("```")))
    return {
        "residual_hebrew": hebrew_ratio(unmarked) <= most_hebrew,
        "untranslated_block": ~F.exists(paragraphs, lambda p: hebrew_ratio(p) > 0.5),
        "heading_fidelity": heading_levels(source) == heading_levels(target),
        "structure_fidelity": structure(source) == structure(target),
        "numeric_fidelity": numbers(source) == numbers(target),
        "length_ratio": (ratio >= low) & (ratio <= high),
        "markup_integrity": (fences % 2 == 0) & (F.size(wikilinks(source)) == F.size(wikilinks(target))),
        "marker_free": F.regexp_count(target, F.lit("⟦he:[^⟧]*⟧")) == 0,
    }


def quarantined(pairs: DataFrame) -> DataFrame:
    """Any failed check quarantines: (doc_id, failed)."""
    c = checks(F.col("source"), F.col("target"))
    failed = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in c.items()]), lambda x: x.isNotNull())
    return pairs.select("doc_id", failed.alias("failed"))


def in_chunk(chunks: DataFrame, glossary: DataFrame, key: str, text: str) -> DataFrame:
    """Q14: (key, term, english): the glossary's terms that a chunk's text holds word for word, ignoring case.

    A term meets the chunks by its first word, so no chunk is held against all terms.
    """
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[\\p{L}\\p{N}_]+"), F.lit(0))
    terms = glossary.select("term", "english").distinct().withColumn("tw", words(F.col("term"))).where(F.size("tw") > 0)
    own = chunks.select(F.col(key).alias("__key"), words(F.col(text)).alias("w"))
    each = own.select("__key", "w", F.posexplode("w").alias("pos", "first")).join(terms.withColumn("first", F.col("tw")[0]), "first")
    held = each.where(F.slice("w", F.col("pos") + 1, F.size("tw")) == F.col("tw"))
    return held.select(F.col("__key").alias(key), "term", "english").distinct()


#: Bytes of a glossary that is sent to every executor.
SMALL = 8_000_000


def _times(text: Column, word: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, word, F.lit("")))) / F.length(word)).cast("long")


def retention(pairs: DataFrame, glossary: DataFrame) -> DataFrame:
    """Q3: (doc_id, term, wanted, found): every occurrence of a term in the source needs its rendering in the target.

    Terms meet the sources by their first three characters (all of a shorter term);
    only those are counted.  A glossary of up to ``SMALL`` bytes is sent to the sources;
    of a larger one neither side is, and no text goes with the characters.
    """
    g = glossary.select("term", "english").distinct().where(F.length("term") > 0).withColumn("k", F.least(F.length("term"), F.lit(3)))
    found = g.groupBy("k").agg(F.sum(F.octet_length("term") + F.coalesce(F.octet_length("english"), F.lit(0))).alias("bytes")).collect()
    sizes = sorted(r["k"] for r in found)
    starts = lambda k: F.when(F.length("source") >= k, F.transform(F.sequence(F.lit(1), F.length("source") - k + 1), lambda i: F.substring(F.col("source"), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    each = F.explode(F.array_distinct(F.concat(F.array().cast("array<string>"), *[starts(k) for k in sizes]))).alias("start")
    g = g.select("term", "english", F.substring(F.col("term"), F.lit(1), F.col("k")).alias("start"))
    if sum(r["bytes"] for r in found) <= SMALL:
        met = pairs.select("doc_id", "source", "target", each).join(F.broadcast(g), "start")
    else:
        keys = pairs.select("doc_id", each).hint("merge").join(g, "start").select("doc_id", "term", "english")
        met = keys.hint("merge").join(pairs.select("doc_id", "source", "target"), "doc_id")
    counted = met.where(F.contains("source", "term")).select("doc_id", "term", _times(F.col("source"), F.col("term")).alias("wanted"), _times(F.col("target"), F.col("english")).alias("found"))
    return counted.distinct()


def forbidden(docs: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """Q6: documents with a forbidden term, and which."""
    found = F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.lower(text), F.lower(t)))
    return docs.select("doc_id", found.alias("terms")).where(F.size("terms") > 0)


def term_spread(uses: DataFrame) -> DataFrame:
    """Per term its frequency and in how many domains it occurs."""
    return uses.groupBy("term").agg(F.count("*").alias("freq"), F.countDistinct("domain").alias("domains"))


def question_queue(blocked: DataFrame) -> DataFrame:
    """One question per campaign and term, the most frequent first."""
    return blocked.groupBy("campaign", "term").agg(F.count("*").alias("freq"), F.countDistinct("doc_id").alias("blocked_docs")).orderBy(F.desc("freq"), F.desc("blocked_docs"), "campaign", "term")


def paragraph_chunks(text: Column, budget: int) -> Column:
    """Q13: paragraphs gathered up to ``budget`` characters; a heading starts a chunk, a longer paragraph stays whole."""
    parts = F.filter(F.split(text, "\n\n+"), lambda p: p != "")
    joined = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when((F.size(acc) > 0) & ~p.startswith("#") & (F.length(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(""))) + 2 + F.length(p) <= budget), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat(F.try_element_at(acc, F.lit(-1)), F.lit("\n\n"), p)))).otherwise(F.concat(acc, F.array(p))))
    return joined
