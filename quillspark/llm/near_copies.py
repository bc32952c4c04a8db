"""Near copies by SimHash and an exact check, with the Jaccard coefficient of sets of word shingles.

Each document's set of shingles has a SimHash fingerprint.  Fingerprints are joined
as in ``simhash`` (binary tries per block key, a bit budget, pruning by components,
star components), and the sets of a component are held against each other exactly:
those that have the coefficient t are a class.

A coefficient bounds no number of differing bits, so fingerprints alone would lose near
copies.  The rest is found by a prefix filter between different classes: two sets of n
shingles whose coefficient is t or more share one of the first ``n - ceil(t n) + 1``
shingles of each, in any order that is the same for all documents.  The order here
puts shingles that are frequent in a sample last; the sample changes what the join
costs, never what it finds.  Documents that share a prefix shingle are held against each other by size and by
a parity bitmap: sets differ in at least as many shingles as their bitmaps in
bits.  Both only leave out pairs that can't reach t.  What remains is linked by a
spanning forest per shingle and gathered to components of candidates.

The texts of candidates go to one task for each component, for the exact comparison; pairs that are connected
already are skipped, so groups of copies aren't expanded.  Sets are compared by
64-bit hashes of their shingles; documents with equal sets count as one.

Groups of more than ``key_rows`` are split: they are dealt into parts and every
pair of parts is joined by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of, map_batches, stored, unstored
from quillspark.llm.simhash import Forest, components, fingerprint_links, majority

#: Members of a group that one task joins.
KEY_ROWS = 2_000
#: Fewest bits of a parity bitmap; it has as many as a power of two that the set's size doesn't exceed, so unrelated sets are told apart at any length.
BITS = 256
#: Differing bits at which fingerprints are candidates, and the blocks that they are cut into. What the bits lose is found afterwards.
BUDGET, BLOCKS = 3, 4
#: Documents in the sample (about), and documents of it that hold a frequent shingle.
SAMPLE, FREQUENT = 10_000, 10
BATCH_BYTES = 4 << 20
#: Edges up to which one task finds the components; more go through rounds of stars.
FEW_EDGES = 2_000_000
#: Candidate sets up to which they are sent to all rows; more are joined by a shuffle.
BROADCAST = 200_000
_MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"%d" % i) | 1 for i in range(64)], np.uint64)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """The text's distinct shingles, ascending 64-bit hashes. Words as in ``simhash``; fewer than ``size`` are one shingle; none for blank texts."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    size = min(size, n)
    out = np.full(n - size + 1, np.uint64(size))
    for i in range(size):
        out += hashes[i : n - size + 1 + i] * _MULTIPLIERS[i]
    out ^= out >> np.uint64(29)
    out *= _MULTIPLIERS[-1]
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _bitmap(held: np.ndarray) -> np.ndarray:
    width = max(BITS, 1 << (len(held) - 1).bit_length()) if len(held) else BITS
    ones = np.bincount((held & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little")


def _least_overlap(na: np.ndarray | int, nb: np.ndarray | int, threshold: float) -> np.ndarray:
    """Shared shingles from which sets of these sizes have the coefficient."""
    return np.ceil(threshold / (1 + threshold) * (np.asarray(na, np.int64) + nb) - 1e-9).astype(np.int64)


def _frequent(df: DataFrame, text_col: str, size: int) -> np.ndarray:
    """Shingles that many documents of a sample hold, ascending."""
    n = df.count()
    texts = df.select(df[text_col].cast("string").alias("__text")).where(F.pmod(F.xxhash64("__text"), F.lit(max(1, n // SAMPLE))) == 0).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(iter([batch]), "__text", BATCH_BYTES):
                found = [shingles(t, size) for t in part.column("__text").cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["t"])

    rows = map_batches(texts, run, "t long").groupBy("t").count().where(F.col("count") >= FREQUENT).select("t").toPandas()
    return np.sort(rows["t"].to_numpy(np.int64).view(np.uint64))


def _sketches(df: DataFrame, size: int, threshold: float, frequent: np.ndarray) -> DataFrame:
    """id, crc, sig (the set's hash), fp (its SimHash), n, bits, prefix of every row (id, text, crc)."""
    id_type = df.schema["id"].dataType.simpleString()
    common = df.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value
        for batch in batches_of(batches, "text", BATCH_BYTES):
            sigs, fps, ns, bits, prefixes = [], [], [], [], []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                held = shingles(text, size)
                n = len(held)
                sigs.append(xxhash.xxh3_64_intdigest(held.tobytes()))
                fps.append(majority(held))
                ns.append(n)
                bits.append(_bitmap(held).tobytes())
                at = np.searchsorted(last, held)
                late = last[np.minimum(at, len(last) - 1)] == held if len(last) else np.zeros(n, bool)
                ordered = np.concatenate([held[~late], held[late]])
                prefixes.append(ordered[: n - int(np.ceil(threshold * n - 1e-9)) + 1 if n else 0].view(np.int64))
            arrays = [batch.column("id"), batch.column("crc"), pa.array(np.array(sigs, np.uint64).view(np.int64)), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(ns, pa.int32()), pa.array(bits, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "crc", "sig", "fp", "n", "bits", "prefix"])

    return map_batches(df, run, f"id {id_type}, crc long, sig long, fp long, n int, bits binary, prefix array<long>")


def _dealt(df: DataFrame, key: str, count: Column, member: str, key_rows: int) -> DataFrame:
    """``df`` with ``group``, rows of one following each other; groups of more than ``key_rows`` members become pairs of parts."""
    parts = F.ceil(count / key_rows).cast("long")
    own = F.pmod(F.xxhash64(member), parts)
    pairs = F.when(parts <= 1, F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda j: F.least(j, own) * parts + F.greatest(j, own)))
    out = df.withColumn("__pair", F.explode(pairs)).withColumn("group", F.xxhash64(key, "__pair"))
    return out.drop("__pair").repartition("group").sortWithinPartitions("group", member)


def _per_group(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list]:
    """The columns of each group, of batches that come sorted by ``group``."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        groups = np.asarray(batch.column("group"))
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi == lo:
                continue
            if held and groups[lo] != now:
                yield [pa.chunked_array([b.column(c) for b in held]) for c in columns]
                held = []
            now = groups[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield [pa.chunked_array([b.column(c) for b in held]) for c in columns]


def _linked(known: np.ndarray, test) -> list[tuple[int, int]]:
    """A spanning forest of the pairs for which ``test(pivot, others)`` holds; each row is held against the later ones it isn't connected to. Rows of a class (``known``) are connected from the start."""
    n = len(known)
    _, first, of = np.unique(known, return_index=True, return_inverse=True)
    forest = Forest(n)
    forest.parent = first[of]
    for i in range(n - 1):
        roots = forest.roots()
        others = i + 1 + np.flatnonzero(roots[i + 1 :] != roots[i])
        if len(others):
            others = others[test(i, others)]
            forest.link(np.full(len(others), i), others)
    return forest.links


def _possible(n: np.ndarray, bitmaps: list[bytes], threshold: float):
    """``test`` of ``_linked``: false only for pairs whose sizes or bitmaps rule the coefficient out."""
    words = [np.frombuffer(b, np.uint64) for b in bitmaps]
    width = np.array([len(w) for w in words])

    def apart(i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), np.int64)
        for w in np.unique(width[others]):
            at = np.flatnonzero(width[others] == w)
            least = min(w, width[i])
            # A wider bitmap is folded: the parity of two places is that of both together.
            own = np.bitwise_xor.reduce(words[i].reshape(-1, least), axis=0)
            for lo in range(0, len(at), max(1, (1 << 19) // w)):
                part = at[lo : lo + max(1, (1 << 19) // w)]
                theirs = np.stack([words[o] for o in others[part]]).reshape(len(part), -1, least)
                out[part] = np.bitwise_count(np.bitwise_xor.reduce(theirs, axis=1) ^ own).sum(axis=1, dtype=np.int64)
        return out

    def test(i: int, others: np.ndarray) -> np.ndarray:
        need = _least_overlap(n[others], n[i], threshold)
        fits = np.minimum(n[others], n[i]) >= need
        at = np.flatnonzero(fits)
        if len(at):
            fits[at] = n[others[at]] + n[i] - 2 * need[at] >= apart(i, others[at])
        return fits

    return test


def _edges(links: Iterator[tuple[np.ndarray, list[tuple[int, int]]]]) -> Iterator[pa.RecordBatch]:
    for cls, found in links:
        if found:
            at = np.array(found)
            a, b = cls[at[:, 0]], cls[at[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def connected(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), as ``components`` has them: root is the component's smallest node.

    Edges that one task holds are joined there at once: each round of stars costs the
    driver plans, threads and broadcasts, however few the edges are.
    """
    now = stored(edges, "links")
    if now.count() > few:
        return components(now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column("a")), np.asarray(b.column("b"))) for b in batches if b.num_rows]
        if held:
            a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            forest = Forest(len(nodes))
            forest.link(at[: len(a)], at[len(a) :])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[forest.roots()])], names=["node", "root"])

    return map_batches(now.coalesce(1), run, "node long, root long")


def _candidates(classed: DataFrame, threshold: float, key_rows: int) -> DataFrame:
    """Edges (a, b) between classes of sets (sig, cls, n, bits, prefix) that may be near: whatever is near is connected."""
    entries = classed.select("sig", "cls", F.explode("prefix").alias("key"))
    of_key = W.partitionBy("key")
    shared = entries.withColumn("c", F.count("*").over(of_key)).withColumn("other", F.min("cls").over(of_key) < F.max("cls").over(of_key)).where("other").drop("other")
    filed = _dealt(shared.join(classed.select("sig", "n", "bits"), "sig"), "key", F.col("c"), "sig", key_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
            for cls, n, bits in _per_group(batches, ["cls", "n", "bits"]):
                cls, n = cls.to_numpy(), n.to_numpy().astype(np.int64)
                yield cls, _linked(cls, _possible(n, bits.to_pylist(), threshold))

        yield from _edges(links())

    return map_batches(filed.select("group", "cls", "n", "bits"), run, "a long, b long").distinct()


def _verified(texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Edges (a, b) between classes of sets (group, cls, text) that have the coefficient: enough to connect whatever is near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links() -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
            for cls, text in _per_group(batches, ["cls", "text"]):
                cls, sets = cls.to_numpy(), [shingles(t, size) for t in text.cast(pa.large_binary()).to_pylist()]
                n = np.array([len(s) for s in sets], np.int64)
                possible = _possible(n, [_bitmap(s).tobytes() for s in sets], threshold)

                def test(i: int, others: np.ndarray, sets=sets, n=n, possible=possible) -> np.ndarray:
                    maybe = np.flatnonzero(possible(i, others))
                    near = np.zeros(len(others), bool)
                    if len(maybe):
                        every = np.concatenate([sets[o] for o in others[maybe]])
                        at = np.minimum(np.searchsorted(sets[i], every), n[i] - 1)
                        starts = np.cumsum(n[others[maybe]]) - n[others[maybe]]
                        both = np.add.reduceat((sets[i][at] == every).astype(np.int64), starts)
                        near[maybe] = both >= _least_overlap(n[others[maybe]], n[i], threshold)
                    return near

                yield cls, _linked(cls, test)

        yield from _edges(links())

    return map_batches(texts, run, "a long, b long").distinct()


def _checked(rows: DataFrame, groups: DataFrame, size: int, threshold: float, key_rows: int) -> DataFrame:
    """(node, root) of the classes that exact checks inside each group connect; groups: sig, one, cls, root."""
    # Groups that need a split are few: at most (rows) / key_rows of them.
    large = groups.groupBy("root").agg(F.count("*").alias("c")).where(F.col("c") > key_rows)
    wanted = stored(groups.join(F.broadcast(large), "root", "left").select("sig", "one", "cls", "root", F.coalesce("c", F.lit(1)).alias("c")), "candidates")
    # Each candidate set's text is read from one row that has it.
    if wanted.count() <= BROADCAST:
        wanted = F.broadcast(wanted)
    chosen = rows.join(wanted, rows["id"].eqNullSafe(wanted["one.id"]) & (rows["crc"] == wanted["one.crc"]))
    texts = chosen.select("sig", "cls", "root", "c", "text").dropDuplicates(["sig"])
    return connected(_verified(_dealt(texts, "root", F.col("c"), "sig", key_rows).select("group", "cls", "text"), size, threshold))


def by_fingerprints(distinct: DataFrame, budget: int, blocks: int) -> DataFrame:
    """sig, one, cls, root of the sets whose fingerprints the trie join connects with another set's; every set is a class of its own, root is the component."""
    comp = connected(fingerprint_links(distinct.select("fp").distinct(), budget, blocks))
    rooted = stored(distinct.join(comp, distinct["fp"] == comp["node"], "left").select("sig", "one", F.col("sig").alias("cls"), F.coalesce("root", "fp").alias("root")), "prints")
    several = rooted.groupBy("root").count().where("count > 1").select("root")
    return rooted.join(several, "root", "left_semi")


def near_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    budget: int = BUDGET,
    blocks: int = BLOCKS,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """Per row: ``id_col``, component_id (smallest id that is reached over pairs with a coefficient of ``threshold`` or more, its own included).

    ``budget`` and ``blocks`` change which copies the fingerprints find and which the prefix filter, not the result.
    Blank and null texts are one group.  Repeated ids keep a row each; a null id is
    passed over in the minimum.  Empty tables give no rows.
    """
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).withColumn("crc", F.xxhash64("text"))
    own = stored(_sketches(rows, shingle, threshold, _frequent(rows, "text", shingle)), "sketches")
    one = F.min(F.struct("id", "crc")).alias("one")
    ids = stored(own.select("id", "sig"), "ids")
    distinct = stored(own.groupBy("sig").agg(F.min("id").alias("least"), one, *[F.any_value(c).alias(c) for c in ("fp", "n", "bits", "prefix")]), "distinct")
    unstored(own)
    comp = _checked(rows, by_fingerprints(distinct, budget, blocks), shingle, threshold, key_rows)
    classed = stored(distinct.join(comp, distinct["sig"] == comp["node"], "left").drop("node", "fp").withColumn("cls", F.coalesce("root", "sig")).drop("root"), "classes")
    unstored(distinct)
    # The rest: classes that the prefix filter connects.
    maybe = connected(_candidates(classed, threshold, key_rows))
    groups = classed.select("sig", "one", "cls").join(maybe, F.col("cls") == maybe["node"]).drop("node")
    comp = _checked(rows, groups, shingle, threshold, key_rows)
    rooted = stored(classed.join(comp, classed["cls"] == comp["node"], "left").select("sig", "least", F.coalesce("root", "cls").alias("root")), "rooted")
    unstored(classed)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return ids.join(rooted.join(least, "root").select("sig", "component_id"), "sig").select(F.col("id").alias(id_col), "component_id")
