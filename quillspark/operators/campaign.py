"""Campaigns: selection, trust, ordering, collisions, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select(ledger_state: DataFrame, campaign: str) -> DataFrame:
    """K1: a campaign is a query over the ledger's current state."""
    return ledger_state.where(F.array_contains("campaigns", campaign))


def domains(path: Column, text: Column, cues: dict[str, list[str]]) -> Column:
    """K2: every domain one of whose cues is in the path or the text."""
    low = F.lower(F.concat_ws("\n", path, text))
    hit = [F.when(F.greatest(*[F.contains(low, F.lit(c.lower())) for c in words], F.lit(False), F.lit(False)), F.lit(d)) for d, words in sorted(cues.items())]
    return F.filter(F.array(*hit), lambda x: x.isNotNull())


def collide(old: DataFrame, new: DataFrame) -> DataFrame:
    """K4, K5: (concept, outcome) of claims about one concept: agree, extend (nothing known yet), override by a better tier, conflict at the same one, keep otherwise. Tier 1 is the most trusted."""
    joined = new.join(old.toDF("concept", "known", "known_tier"), "concept", "left")
    outcome = F.when(F.col("known").isNull(), "extend").when(F.col("known") == F.col("claim"), "agree").when(F.col("tier") < F.col("known_tier"), "override").when(F.col("tier") == F.col("known_tier"), "conflict").otherwise("keep")
    return joined.select("concept", outcome.alias("outcome"))


def curriculum(docs: DataFrame) -> DataFrame:
    """Level ascending, then the most trusted."""
    return docs.orderBy("level", F.desc("trust"), "doc_id")


def review_order(rows: DataFrame) -> DataFrame:
    """Priority, then the least confident bucket first."""
    rank = F.when(F.col("bucket") == "I_GUESSED", 0).when(F.col("bucket") == "NEEDS_HUMAN_VALIDATION", 1).otherwise(2)
    return rows.orderBy("priority", rank, "doc_id")


def agreement(gold: DataFrame) -> DataFrame:
    """K7: share of agreement per kind; it sets how much is left to run by itself."""
    return gold.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.avg((F.col("truth") == F.col("pred")).cast("double")), 4).alias("rate"))


def unassigned_share(docs: DataFrame, label: str) -> DataFrame:
    """K8."""
    return docs.agg(F.round(F.avg(F.col(label).isNull().cast("double")), 4).alias("unassigned"))


def freeze(names: list[str], files: dict[str, str]) -> str:
    """K9: the hash of a frozen taxonomy; it has 5 to 50 classes."""
    import hashlib

    if not 5 <= len(set(names)) <= 50:
        raise ValueError("a taxonomy has 5 to 50 classes")
    return hashlib.sha256("\0".join(f"{k}\0{files[k]}" for k in sorted(files)).encode()).hexdigest()


def boosted(docs: DataFrame, text: str, glossary: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, subdomains) that glossary terms in the text point to."""
    hits = F.array_distinct(F.filter(F.array(*[F.when(F.contains(F.lower(text), F.lit(t.lower())), F.lit(d)) for t, d in glossary]), lambda x: x.isNotNull()))
    return docs.select("doc_id", F.array_sort(hits).alias("subdomains"))
