"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text is a sequence of bytes.  A k-mer of ``K`` bytes is chosen if the
least-hashed of its s-mers of ``S`` bytes is its first or its last.  That looks at
nothing outside the k-mer, so whoever holds the same bytes chooses the same
anchors, at whatever place and in whatever script: the choice is free of context.
A text of fewer than ``K`` bytes has one anchor, itself; an empty one has none.

An anchor is a number: 31 bits of the k-mer's hash, and below 32 bits its place in
bytes.  Texts are compared by all their distinct anchors, at their first places:
anchors of both match if another pair is displaced by as much, or if neither has
moved, and ``likeness`` is the share of the matches in the anchors of either.  A
cut text's anchors follow from those of its parts and the few k-mers across the
cut, so each text is gone through once.  ``fingerprint`` is the ``SKETCH`` least
hashes, a short name of the text that nothing is computed from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.binding import let

#: S-mers of a k-mer but for its first and last: a power of two, for their least is found by doubling.
INNER = 16
S = 8
K = S + INNER + 1
SKETCH = 64
#: Bytes of text (about) in a range of ids that neighbours are sought in, sampled rows per range, ranges that a literal lists.
RANGE_BYTES, SAMPLED, LISTED = 16 << 20, 8, 256
#: Rows of one id and text in the sample from which on they are counted before they are dealt out.
FREQUENT = 50
_PLACE = 0x7FFFFFFF
_ARRAY = "array<bigint>"


def _packed(piece: Column, place: Column) -> Column:
    return F.shiftleft(F.xxhash64(piece).bitwiseAND(F.lit(_PLACE)), 32) + place


def _none() -> Column:
    return F.array().cast(_ARRAY)


def _chosen(data: Column, h: Column) -> Column:
    """Anchors from the hashes of all s-mers (at least ``INNER + 2`` of them)."""

    def places(m: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(h) - INNER - 2), lambda i: F.least(F.get(h, i), F.get(h, i + INNER + 1)) <= F.get(m, i + 1))

    return let(_doubled(h), lambda m: F.transform(places(m), lambda i: _packed(F.substring(data, i + 1, F.lit(K)), i)))


def _doubled(h: Column) -> Column:
    """The least of every ``INNER`` hashes from each place on; runs at the end are shorter, and not asked for."""

    def least(step: int):  # noqa: ANN202
        return lambda x: F.zip_with(x, F.slice(x, F.lit(1 + step), F.size(x)), lambda a, b: F.least(a, b))

    m, step = h, 1
    while step < INNER:
        m, step = let(m, least(step)), 2 * step
    return m


def anchors_of(data: Column) -> Column:
    """All anchors of a binary, array<bigint>, by place."""
    hashes = lambda d: F.transform(F.sequence(F.lit(1), F.octet_length(d) - S + 1), lambda i: F.xxhash64(F.substring(d, i, F.lit(S))))
    whole = lambda d: F.array(_packed(d, F.lit(0)))
    return let(data, lambda d: F.when(F.octet_length(d) >= K, let(hashes(d), lambda h: _chosen(d, h))).when(F.octet_length(d) > 0, whole(d)).otherwise(_none()))


def anchors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Closed syncmers with their places: ``id_col``, pos (in bytes, from 0), anchor (31-bit hash), one row each; a null text is empty."""
    found = df.select(df[id_col].alias("id"), F.explode(anchors_of(_bytes(df[text_col]))).alias("a"))
    return found.select(F.col("id").alias(id_col), _place(F.col("a")).cast("int").alias("pos"), F.shiftright("a", 32).alias("anchor"))


def _bytes(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def _place(a: Column) -> Column:
    return a.bitwiseAND(F.lit(_PLACE).cast("long"))


def joined_anchors(left: Column, left_whole: Column, left_anchors: Column, right: Column, right_whole: Column, right_anchors: Column) -> Column:
    """Anchors of left + right, the beginnings of two binaries of which all anchors are known (``whole``: their sizes)."""
    cut, take = F.octet_length(left), F.octet_length(right)
    before = F.when(left_whole >= K, F.filter(left_anchors, lambda a: _place(a) + K <= cut)).otherwise(_none())
    after = F.when(right_whole >= K, F.transform(F.filter(right_anchors, lambda a: _place(a) + K <= take), lambda a: a + cut)).otherwise(_none())
    near = F.least(cut, F.lit(K - 1))
    middle = F.concat(F.substring(left, cut - near + 1, near), F.substring(right, F.lit(1), F.lit(K - 1)))
    across = F.when(F.octet_length(middle) >= K, F.transform(anchors_of(middle), lambda a: a + (cut - near))).otherwise(_none())
    return F.when(cut + take >= K, F.concat(before, across, after)).otherwise(anchors_of(F.concat(left, right)))


def firsts(found: Column) -> Column:
    """The distinct anchors at their first places, ascending."""
    return let(F.sort_array(found), lambda z: F.filter(z, lambda x, i: (i == 0) | (F.shiftright(F.get(z, i - 1), 32) != F.shiftright(x, 32))))


def fingerprint(distinct: Column) -> Column:
    """Eight hex digits for each of the least hashes."""
    return F.array_join(F.transform(F.slice(distinct, 1, SKETCH), lambda a: F.lower(F.lpad(F.hex(F.shiftright(a, 32)), 8, "0"))), "")


def matched(a: Column, b: Column) -> Column:
    """How many distinct anchors of both lie at places of a shared displacement, or at the same place."""
    moved = lambda z: F.filter(F.transform(z, lambda x, i: F.when((i > 0) & (F.shiftright(x, 32) == F.shiftright(F.get(z, i - 1), 32)), _place(x) - _place(F.get(z, i - 1)))), lambda d: d.isNotNull())
    shared = lambda o: F.size(F.filter(o, lambda d, i: (d == 0) | F.coalesce(F.get(o, i - 1) == d, F.lit(False)) | F.coalesce(F.get(o, i + 1) == d, F.lit(False))))
    both = F.sort_array(F.concat(a, F.transform(b, lambda x: x + F.lit(_PLACE + 1).cast("long"))))
    return let(both, lambda z: let(F.sort_array(moved(z)), shared))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, of two texts' distinct anchors as ``firsts`` gives them; two texts without anchors are alike (1)."""
    hashes = lambda x: F.transform(x, lambda k: F.shiftright(k, 32))
    common = F.size(F.array_intersect(hashes(a), hashes(b)))
    return let(common, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).when(n == 0, F.lit(0.0)).otherwise(matched(a, b) / (F.size(a) + F.size(b) - n)))


def _key(df: DataFrame) -> Column:
    return F.struct(df["id"].isNotNull().alias("known"), df["id"].alias("id"), df["h"].alias("h"))


def with_next(df: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (id, text, h, copies) dealt out by ranges of (id, h), so that a window over ``__range`` sees every row's next one.

    Ranges are cut at rows of a sample, as many as the texts' bytes ask for.  The
    rows of a range's first key are put at the end of the range before too
    (``__copy``), and those of the first of all at the end of the last, so one shuffle
    holds every neighbour.  Null ids come first.
    """
    spark = df.sparkSession
    n = df.count()
    if not n:
        return df.withColumn("__range", F.lit(0)).withColumn("__copy", F.lit(False))
    least = df.agg(F.min(_key(df)).alias("k")).first()["k"]
    # The sample's size doesn't depend on the number of rows, but for a few per range.
    some = df.sample(False, min(1.0, 20_000 / n), 11).select(F.avg(F.octet_length("text")).alias("z")).first()["z"] or 0.0
    ranges = max(1, int(n * some / range_bytes), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    picked = df.sample(False, min(1.0, SAMPLED * ranges / n), 12).select("id", "h").collect()
    keys = sorted({(r["id"] is not None, r["id"] or 0, r["h"]) for r in picked})
    first = (least["known"], least["id"] or 0, least["h"])
    cuts = sorted({first, *(keys[i * len(keys) // ranges] for i in range(1, ranges) if keys)})
    literal = lambda ks: F.array(*[F.struct(F.lit(a).alias("known"), (F.lit(b) if a else F.lit(None)).cast("long").alias("id"), F.lit(c).cast("long").alias("h")) for a, b, c in ks])
    below = lambda bounds, key: F.size(F.filter(bounds, lambda b: b <= key))
    key = _key(df)
    if len(cuts) <= LISTED:
        placed = df.withColumn("__place", below(literal(cuts), key)).withColumn("__low", F.get(literal(cuts), F.col("__place") - 1))
    else:  # two steps: one of LISTED lists, which go to all tasks as a table, then a place in it
        step = -(-len(cuts) // LISTED)
        parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
        rows = [(i + 1, [(a, b if a else None, c) for a, b, c in part]) for i, part in enumerate(parts)]
        lists = F.broadcast(spark.createDataFrame(rows, "__part int, __cuts array<struct<known:boolean,id:bigint,h:bigint>>"))
        found = df.withColumn("__part", below(literal([p[0] for p in parts]), key)).join(lists, "__part")
        placed = found.withColumn("__in", below(F.col("__cuts"), key)).withColumn("__place", (F.col("__part") - 1) * step + F.col("__in")).withColumn("__low", F.get("__cuts", F.col("__in") - 1)).drop("__part", "__cuts", "__in")
    starts = F.col("__low") == key
    back = F.when(starts, F.when(F.col("__place") > 1, F.col("__place") - 1).otherwise(F.lit(len(cuts))))
    homes = F.filter(F.array(F.struct(F.col("__place").alias("r"), F.lit(False).alias("copy")), F.struct(back.alias("r"), F.lit(True).alias("copy"))), lambda x: x["r"].isNotNull())
    dealt = placed.withColumn("__home", F.explode(homes)).withColumn("__range", F.col("__home.r")).withColumn("__copy", F.col("__home.copy"))
    return dealt.drop("__place", "__low", "__home").repartition("__range")


def _counted(rows: DataFrame) -> DataFrame:
    """(id, text, h, copies): rows that a sample shows to be repeated very often are one row with their number."""
    n = rows.count()
    some = rows.sample(False, min(1.0, 20_000 / max(1, n)), 13).groupBy("id", "h").count().where(F.col("count") >= FREQUENT)
    often = [(r["id"], r["h"]) for r in some.collect()]
    one = rows.withColumn("copies", F.lit(1).cast("long"))
    if not often:
        return one
    table = F.broadcast(rows.sparkSession.createDataFrame(often, "__id long, __h long"))
    met = rows["id"].eqNullSafe(table["__id"]) & (rows["h"] == table["__h"])
    many = rows.join(table, met, "left_semi").groupBy("id", "h", "text").agg(F.count("*").alias("copies"))
    return one.join(table, met, "left_anti").unionByName(many)


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row: ``id_col``, text, edited, own, changed (the texts' distinct anchors), near_edited, near_next.

    edited is the text with its last half (rounded down) replaced by as much of the
    next row's beginning.  A null text is empty; ids are whole numbers, others are
    null; null ids come first; rows of one id follow each other by a hash of their
    texts, then by them; equal rows follow each other; a lone row is its own next one.
    Texts of any length are compared whole.  Further columns, whatever their names,
    are ignored.  Empty tables give no rows.
    """
    rows = df.select(df[id_col].try_cast("long").alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = ["__copy", F.col("id").asc_nulls_first(), "h", "text"]
    dealt = with_next(_counted(rows), range_bytes).sortWithinPartitions("__range", *order)
    made = dealt.withColumn("found", anchors_of(_bytes(F.col("text"))))
    following = F.lead(F.struct("text", "found")).over(W.partitionBy("__range").orderBy(*order))
    pairs = made.withColumn("follow", following).where("NOT __copy")
    # Of rows that were counted all but the last have an equal one next.
    itself = F.struct(F.struct("text", "found").alias("f"), (F.col("copies") - 1).alias("times"))
    last = F.struct(F.coalesce("follow", F.struct("text", "found")).alias("f"), F.lit(1).cast("long").alias("times"))
    each = pairs.withColumn("x", F.explode(F.filter(F.array(last, itself), lambda x: x["times"] > 0))).select("id", "text", "found", F.col("x.f.text").alias("next_text"), F.col("x.f.found").alias("next_found"), "x.times")
    half = F.floor(F.length("text") / 2).cast("int")
    cut = each.withColumn("head", F.substring(F.col("text"), F.lit(1), F.length("text") - half)).withColumn("tail", F.substring(F.col("next_text"), F.lit(1), half))
    size = lambda c: F.octet_length(F.col(c))
    edited = cut.withColumn("changed", joined_anchors(_bytes(F.col("head")), size("text"), F.col("found"), _bytes(F.col("tail")), size("next_text"), F.col("next_found")))
    for name in ("found", "changed", "next_found"):
        edited = edited.withColumn(name, firsts(F.col(name)))
    out = edited.select(
        F.col("id").alias(id_col),
        "text",
        F.concat("head", "tail").alias("edited"),
        F.col("found").alias("own"),
        "changed",
        likeness(F.col("found"), F.col("changed")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
        "times",
    )
    return out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times")


def op8_syncmers(spark, sf_dir: str) -> DataFrame:
    """Query: every document against its edited text and the next document."""
    out = compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
