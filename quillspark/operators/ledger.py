"""Append-only ledgers and what is read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def project(ledger: DataFrame, key: str, seq: str) -> DataFrame:
    """The last event of each key; a null key is ``_global``. One aggregate with map-side partial results."""
    key_col = F.coalesce(F.col(key).cast("string"), F.lit("_global")).alias("key")
    rest = [c for c in ledger.columns if c not in (key, seq)]
    last = ledger.groupBy(key_col).agg(F.max_by(F.struct(seq, *rest), F.col(seq)).alias("e"))
    return last.select("key", "e.*")


def not_ledgered(rows: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the ledger doesn't hold yet."""
    return rows.join(ledger.select(*keys).distinct(), keys, "left_anti")


def first_by_key(events: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Of events that repeat their keys the first."""
    rest = [c for c in events.columns if c not in (*keys, seq)]
    return events.groupBy(*keys).agg(F.min_by(F.struct(seq, *rest), F.col(seq)).alias("e")).select(*keys, "e.*")


def stale(ledger: DataFrame, key: str, seq: str, version: str, current: Column) -> DataFrame:
    """Keys whose last event used another version than the current one."""
    return project(ledger, key, seq).where(F.col(version) != current)


def poisoned(ledger: DataFrame, key: str, seq: str, status: str, in_flight: str = "in_flight") -> DataFrame:
    """T4: keys that were being worked on when it ended."""
    return project(ledger, key, seq).where(F.col(status) == in_flight)


def latest_version(findings: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys the row of the highest version."""
    rest = [c for c in findings.columns if c not in keys]
    return findings.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("version")).alias("e")).select(*keys, "e.*")


def streaks(reviews: DataFrame, key: str, seq: str, rejected: Column, needed: int) -> DataFrame:
    """RA7: per key the reviews since its last rejection, and whether they are enough."""
    last = reviews.withColumn("__r", F.max(F.when(rejected, F.col(seq))).over(W.partitionBy(key)))
    run = last.groupBy(key).agg(F.count_if(F.col("__r").isNull() | (F.col(seq) > F.col("__r"))).alias("streak"))
    return run.withColumn("eligible", F.col("streak") >= needed)
