"""Exact and near duplicates of the reference's own kind, and upgrades as set operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.operators.graph import cut_lineage


def content_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def canonical(docs: DataFrame, path: str, text: str) -> DataFrame:
    """(path, sha, canonical, duplicate_of); the canonical copy has the least path.

    The minimum is an aggregate with partial results, joined back, so a hash with
    very many copies isn't gathered.
    """
    keyed = docs.select(F.col(path).alias("path"), content_hash(F.col(text)).alias("sha"))
    first = keyed.groupBy("sha").agg(F.min("path").alias("canonical"), F.count("*").alias("copies"))
    return keyed.join(first, "sha").select("path", "sha", "canonical", "copies", F.when(F.col("path") != F.col("canonical"), F.col("canonical")).alias("duplicate_of"))


def attachment_duplicates(files: DataFrame) -> DataFrame:
    """(path, sha, ord) files in order; each that repeats an earlier one's content points to the first."""
    first = files.groupBy("sha").agg(F.min_by("path", "ord").alias("first_path"), F.min("ord").alias("first_ord"))
    return files.join(first, "sha").select("path", "sha", "ord", F.when(F.col("ord") > F.col("first_ord"), F.col("first_path")).alias("duplicate_of"))


def near_pairs(docs: DataFrame, key: str, words: str, version: str, size: str, shingle: int = 5, threshold: float = 0.9) -> DataFrame:
    """(loser, winner, similarity) of documents whose sets of word shingles have a Jaccard coefficient of ``threshold`` or more.

    Prefix filter: at that threshold two sets of n shingles must share one of the first
    ``n - ceil(t n) + 1`` of each, in an order that is the same for all; it puts shingles
    that a sample shows to be frequent last, so only rare ones meet.  The sample changes
    what the join costs, never what it finds.  Only those few leave a document's row, and
    how many of them a pair shares bounds its whole intersection: of the set whose prefix
    ends first no more than the rest comes on top.  The pairs left are few; the shingles
    of their documents are made again, so no set is stored or shuffled before.  Copies of
    one set are collapsed before and join again as members, so no group of copies is
    paired.  The newer version wins, then the longer document, then the smaller key.
    """

    def grams(w: Column) -> Column:
        n = F.size(w)
        each = F.when(n >= shingle, F.array_distinct(F.transform(F.sequence(F.lit(1), n - shingle + 1), lambda i: F.xxhash64(F.slice(w, i, shingle))))).otherwise(F.array(F.xxhash64(w)))
        return F.when(n > 0, F.sort_array(each))

    sets = docs.select(F.col(key).alias("k"), let(F.col(words), grams).alias("g"), F.struct((-F.col(version)).alias("v"), (-F.col(size)).alias("z"), F.col(key).alias("k")).alias("o"))
    common = _frequent(docs.select(F.col(words).alias("w")), lambda d: d.select(let(F.col("w"), grams).alias("g")))
    most = lambda n: (n - F.ceil(n * threshold) + 1).cast("int")

    def sketch(g: Column) -> Column:
        late = F.array_intersect(g, common)
        first = F.slice(F.concat(F.array_except(g, common), late), F.lit(1), most(F.size(g)))  # both parts stay sorted
        # Where a prefix ends; all those that end among the frequent ones count as one place.
        end = F.when(F.array_contains(common, F.element_at(first, -1)), F.lit(2**63 - 1)).otherwise(F.element_at(first, -1))
        sig = F.struct(F.xxhash64(g).alias("a"), F.xxhash64(F.lit(1), g).alias("b"))
        return F.when(g.isNotNull(), F.struct(sig.alias("sig"), F.size(g).alias("n"), first.alias("first"), end.alias("e")))

    known = cut_lineage(sets.select("o", let(F.col("g"), sketch).alias("s"))).where("s IS NOT NULL").select("o", "s.*")
    first = known.groupBy("sig").agg(F.min("o").alias("best"))
    pairs = known.select("o", "sig").join(first, "sig").where(F.col("o") != F.col("best"))
    copies = pairs.select(F.col("o.k").alias("loser"), F.col("best.k").alias("winner"), F.lit(1.0).alias("similarity"))
    best = known.join(first.select(F.col("best").alias("o")), "o", "left_semi")
    prefix = best.select("o", "n", "e", F.explode("first").alias("t"))
    a, b = prefix.toDF("oa", "na", "ea", "t"), prefix.toDF("ob", "nb", "eb", "t")
    met = a.join(b, "t").where((F.col("oa") < F.col("ob")) & (F.least("na", "nb") >= threshold * F.greatest("na", "nb")))
    shared = met.groupBy("oa", "ob").agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("na", "nb", "ea", "eb")])
    rest = lambda n: n - most(n)
    above = F.when(F.col("ea") < F.col("eb"), rest(F.col("na"))).when(F.col("ea") > F.col("eb"), rest(F.col("nb"))).otherwise(F.greatest(rest(F.col("na")), rest(F.col("nb"))))
    # A hair below the bound, for rounding.
    cand = cut_lineage(shared.where(F.col("c") + above >= (F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - 1e-6).select(F.col("oa.k").alias("ka"), F.col("ob.k").alias("kb")))
    keys = cand.select(F.col("ka").alias(key)).union(cand.select("kb")).distinct()
    few = F.broadcast if cand.count() <= KEYS else (lambda d: d)
    again = docs.join(few(keys), key, "left_semi").select(F.col(key).alias("k"), let(F.col(words), grams).alias("g"))
    ga, gb = again.select(F.col("k").alias("ka"), F.col("g").alias("gx")), again.select(F.col("k").alias("kb"), F.col("g").alias("gy"))
    both = cand.join(ga, "ka").join(gb, "kb").withColumn("inter", F.size(F.array_intersect("gx", "gy")))
    sim = both.select(F.col("kb").alias("loser"), F.col("ka").alias("winner"), (F.col("inter") / (F.size("gx") + F.size("gy") - F.col("inter"))).alias("similarity")).where(F.col("similarity") >= threshold)
    return copies.union(sim)


#: Sets in the sample that tells frequent shingles (about), how many of them hold one, and how many shingles are put last at most.
SAMPLE_SETS, FREQUENT, LAST = 5_000, 10, 1_000
#: Pairs whose keys are sent to every executor.
KEYS = 1_000_000


def _frequent(docs: DataFrame, grams: Callable[[DataFrame], DataFrame]) -> Column:
    share = min(1.0, SAMPLE_SETS / max(1, docs.count()))
    sets = grams(docs.sample(False, share, 5)).groupBy(F.xxhash64("g")).agg(F.first("g").alias("g"))
    seen = sets.select(F.explode("g").alias("t")).groupBy("t").count().where(F.col("count") >= FREQUENT)
    rows = seen.orderBy(F.desc("count"), "t").limit(LAST).collect()
    return F.array(*[F.lit(r["t"]) for r in rows]).cast("array<bigint>")


def upgrade_plan(previous: DataFrame, packaged: DataFrame, on_disk: DataFrame) -> DataFrame:
    """(path, action) between manifests (path, sha): orphans are deleted, drifted files backed up and laid anew, missing ones laid."""
    orphan = previous.select("path").exceptAll(packaged.select("path")).select("path", F.lit("delete_orphan").alias("action"))
    p, d = packaged.toDF("path", "want"), on_disk.toDF("path", "have")
    laid = p.join(d, "path", "left").select("path", F.when(F.col("have").isNull(), "lay").when(F.col("have") != F.col("want"), "backup_and_lay").otherwise("keep").alias("action"))
    return orphan.union(laid)


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of only one side, with the side."""
    only_a = a.select(key).distinct().join(b, key, "left_anti").select(key, F.lit("left").alias("side"))
    return only_a.union(b.select(key).distinct().join(a, key, "left_anti").select(key, F.lit("right").alias("side")))
