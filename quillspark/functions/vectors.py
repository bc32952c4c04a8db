"""Vectors: hash embeddings, centroids, cosine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.functions.text import tokens


def cosine(a: Column, b: Column) -> Column:
    """0 if either norm is 0."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norms = norm(a) * norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot / norms)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def normalised(a: Column) -> Column:
    return let(a, lambda v: let(norm(v), lambda n: F.when(n == 0, v).otherwise(F.transform(v, lambda x: x / n))))


def hash_vector(text: Column, dim: int = 64, first: int = 200) -> Column:
    """Counts of the first ``first`` words by the hash of the word, L2-normalised."""
    bucket = lambda w: (F.conv(F.right(F.sha2(w.cast("binary"), 256), F.lit(8)), 16, 10).cast("long") % dim).cast("int")
    buckets = F.transform(F.slice(tokens(text), 1, first), bucket)
    counts = let(buckets, lambda bs: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.size(F.filter(bs, lambda b: b == i)).cast("double")))
    return normalised(counts)


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """A5: per label the normalised mean of its vectors.

    Positions are averaged with map-side partial sums; no label's vectors are gathered.
    """
    each = df.select(label, F.posexplode(vector).alias("pos", "x"))
    mean = each.groupBy(label, "pos").agg(F.avg("x").alias("x"))
    whole = mean.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return whole.select(label, normalised(F.transform("v", lambda z: z["x"])).alias("centroid"))
