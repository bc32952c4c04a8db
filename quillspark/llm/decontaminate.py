"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every benchmark item gives windows of ``window`` consecutive words (an item with
fewer words is one window).  A window is a set of word shingles; a document
contains it only if it contains all of them, so one shingle of each window is
enough to find candidates (the prefix of a join at full containment).  Shingles
are ordered by how often they occur in the documents, and a window's prefix is
its rarest.  The steps:

1. documents' shingles (hashed, with positions) are met with the benchmark's,
   which makes the list of hits: short, and stored once;
2. the hits give the document frequencies, hence the prefixes;
3. hits of prefix shingles propose (document, window, start); the window must
   lie within the document (length and position bounds);
4. a proposal stands if every shingle of the window is hit at its own position,
   which is exact as the hits' words were compared.

The benchmark side is broadcast only below ``BROADCAST_BYTES``; a larger one meets
the documents' hashes by a shuffle, and only hits are then held against the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import kept, named, refuse_clashes, stored, text_key

#: Bytes of the benchmark's shingles that are broadcast at most; more are joined by shuffling.
BROADCAST_BYTES = 32 << 20
#: Words of a shingle; fewer in windows that are shorter.
SHINGLE = 5
#: Fixed pattern of a word, after A-Z were lower-cased.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text; A-Z are lower-cased, other letters are left. Null has none."""
    text = text.cast("string")
    # lower() is quick but changes other letters too; it serves where the text has no other capitals.
    ascii_lower = F.when(text.rlike("[\\p{IsUppercase}\\p{Lt}&&[^\\x00-\\x7F]]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.coalesce(F.regexp_extract_all(ascii_lower, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashed: Column, size: int) -> Column:
    """Hashes of every run of ``size`` words, from the words' own."""
    last = F.size(hashed) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.xxhash64(F.slice(hashed, i, size)))).otherwise(F.array().cast("array<long>"))


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows (wid, item, words, size) of items (item, words)."""
    n = F.size("words")
    starts = F.when(n > window, F.sequence(F.lit(0), n - window)).otherwise(F.array(F.lit(0)))
    cut = items.where(n > 0).select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at") + 1, window).alias("words"))
    return cut.distinct().select(F.xxhash64(F.concat_ws(" ", "words"), F.lit("window")).alias("wid"), "item", "words", F.size("words").alias("size"))


#: A hash that stands for a document itself among its shingles'.
_SELF = 0


def contained_windows(docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = SHINGLE, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Occurrences (key, start, end, item) of items' windows in documents, and the documents' sizes (key, n), once each.

    ``docs``: key and words; ``items``: item and words.  start and end count words.
    The documents' texts are gone through once: each adds a row of its own to the hits.
    """
    windows = stored(windows_of(items, window), "windows")
    own = windows.select("wid", "words", "size").distinct()
    of_size = F.least(F.col("size"), F.lit(shingle))
    # Distinct shingles of the benchmark, numbered by their words.
    parts = own.select("wid", "size", of_size.alias("k"), F.explode(F.sequence(F.lit(0), F.col("size") - of_size)).alias("off"), "words").select("wid", "size", "k", "off", F.slice("words", F.col("off") + 1, F.col("k")).alias("shingle"))
    parts = stored(parts.withColumn("hash", F.xxhash64(_hashed(F.col("shingle")))), "shingles")
    vocabulary = parts.select("k", "hash", "shingle").distinct()
    size = vocabulary.agg(F.sum(F.octet_length(F.array_join("shingle", " ")) + 64)).first()[0] or 0
    kinds = sorted(r["k"] for r in vocabulary.select("k").distinct().collect())  # at most `shingle` of them
    hashed = docs.select("key", "words", _hashed(F.col("words")).alias("hashed"))
    small = size <= broadcast_bytes
    found = None
    for k in kinds:
        side = vocabulary.where(F.col("k") == k).select("hash", F.col("shingle").alias("wanted"))
        each = F.posexplode(_shingles(F.col("hashed"), k))
        if small:
            own = F.array(F.lit(_SELF).cast("long")) if k == kinds[0] else F.array().cast("array<long>")
            each = F.posexplode(F.concat(own, _shingles(F.col("hashed"), k)))
            side = F.broadcast(side.unionByName(side.sparkSession.range(1).select(F.lit(_SELF).cast("long").alias("hash"), F.lit(None).cast("array<string>").alias("wanted"))) if k == kinds[0] else side)
        first = 1 if small and k == kinds[0] else 0
        if small:
            rows_of = hashed.select("key", "words", each.alias("pos", "hash"))
            same = F.slice("words", F.col("pos") + 1 - first, k) == F.col("wanted")
            if first:
                same = F.when(F.col("pos") == 0, F.col("wanted").isNull()).otherwise(F.coalesce(same, F.lit(False)))
            met = rows_of.join(side, "hash").where(same).select("key", F.size("words").alias("n"), (F.col("pos") - first).alias("pos"), F.lit(k).alias("k"), "hash")
        else:  # words stay where they are until a document's hits are known
            hits_of = hashed.select("key", each.alias("pos", "hash")).join(side, "hash").groupBy("key").agg(F.collect_set(F.struct("pos", "hash", "wanted")).alias("hits"))
            checked = docs.join(hits_of, "key").select("key", "words", F.explode("hits").alias("x")).where(F.slice("words", F.col("x.pos") + 1, k) == F.col("x.wanted"))
            met = checked.select("key", F.size("words").alias("n"), F.col("x.pos").alias("pos"), F.lit(k).alias("k"), F.col("x.hash").alias("hash"))
        found = met if found is None else found.union(met)
    if not small or found is None:
        sizes = docs.select("key", F.size("words").alias("n"))
    if found is None:
        return docs.select("key", F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(None).cast("string").alias("item")).where(F.lit(False)), sizes.distinct()
    found = stored(found, "hits")
    if small:
        sizes = found.where("pos < 0").select("key", "n")
    hits = found.where("pos >= 0").distinct()
    df = hits.groupBy("k", "hash").agg(F.count("*").alias("df"))
    # Hashes of different words are parted by the windows' own words in the end: a proposal needs each shingle at its place.
    rarity = W.partitionBy("wid").orderBy("df", "off")
    prefix = parts.join(df, ["k", "hash"]).withColumn("r", F.row_number().over(rarity))
    whole = parts.groupBy("wid").agg(F.count("*").alias("need"))
    prefix = prefix.where("r = 1").join(whole, "wid").select("wid", "size", "k", "hash", "off", "need")
    proposed = hits.join(prefix, ["k", "hash"]).select("key", "wid", "size", "need", (F.col("pos") - F.col("off")).alias("start"), "n").where("start >= 0 AND start + size <= n")
    expected = proposed.join(parts.select("wid", "k", "hash", "off"), "wid").select("key", "wid", "size", "need", "start", "k", "hash", (F.col("start") + F.col("off")).alias("pos"))
    stand = expected.join(hits.select("key", "k", "hash", "pos"), ["key", "k", "hash", "pos"]).groupBy("key", "wid", "size", "need", "start").agg(F.count("*").alias("met")).where("met = need")
    return stand.join(windows.select("wid", "item"), "wid").select("key", "start", (F.col("start") + F.col("size")).alias("end"), "item"), sizes.distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    window: int = 13,
    least_share: float = 0.05,
) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` (default: ``id_col``), n_words, n_hit, item_ids (sorted strings) and contaminated.

    A word is hit if it lies in any occurrence of any window; a document is
    contaminated if some word is and at least ``least_share`` of its words are.
    Null and empty texts have no words and are clean; items without words have no
    windows.  A null item id counts for the words but is in no list.  Repeated
    rows each get the same result, repeated items count once.  Texts of any length
    are searched whole.  Columns that aren't kept may have any name; one of ``keep``
    that is named like an output is an error.  Empty tables: no rows, or all documents
    clean.
    """
    keep = [id_col] if keep is None else keep
    refuse_clashes(keep, "n_words", "n_hit", "item_ids", "contaminated")
    key = F.struct(docs[id_col].cast("string").alias("id"), text_key(docs[text_col].cast("string")).alias("crc"))
    texts = docs.select(key.alias("key"), words(docs[text_col]).alias("words"))
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), words(benchmark[item_text_col]).alias("words"))
    occurs, sizes = contained_windows(texts, items, window)
    occurs = stored(occurs, "occurrences")
    before = W.partitionBy("key").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = occurs.select("key", "start", "end").distinct().withColumn("seen", F.max("end").over(before))
    hit = spans.groupBy("key").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("seen", "start")))).cast("long").alias("n_hit"))
    listed = occurs.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    no_items = F.array().cast("array<string>")
    per_key = sizes.join(hit, "key", "left").join(listed, "key", "left").select(F.col("key").alias("__key"), F.col("n").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", no_items).alias("item_ids"))
    rows = docs.select(*kept(docs, keep), key.alias("__key"))
    joined = rows.join(per_key, rows["__key"].eqNullSafe(per_key["__key"]))
    contaminated = (F.col("n_hit") > 0) & (F.col("n_hit") >= least_share * F.col("n_words"))
    return named(joined, keep, "n_words", "n_hit", "item_ids", contaminated.alias("contaminated"))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Query: all documents against the whole benchmark, windows of 13 words."""
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


#: DuckDB twin of the query. Windows are joined as strings of their words, by length; word positions that any occurrence covers are counted.
OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
o AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.s = bw.s),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS q FROM (SELECT DISTINCT doc_id, i, k FROM o)) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN n USING (doc_id)
"""
