"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are made per document from its word shingles' XXH64.  The join
works on distinct fingerprints only; copies share one.  Every fingerprint is
filed in a few tables, each keyed by some of its bit blocks, so that any two
fingerprints within the budget of differing bits agree on a table's key (with b
blocks, those within 3 bits agree on b - 3 of them).  Inside a key the
fingerprints, with the remaining bits in front, form a binary trie that is
joined with itself: pairs of nodes are traversed together, level by level, with
the bits that differ so far; a pair over the budget is dropped, and so is a pair
whose leaves are linked already.  Two nodes whose remaining levels can't exceed
the budget any more are linked as a whole.  A key yields a spanning forest of its
links, never all its pairs, and forests are joined into components by rounds of
large-star / small-star, which shuffle edges only.

A key with very many fingerprints is split by more of their bits, as the tables
were: of the bits left, cut into blocks, pairs within the budget agree on one.  Where
that is done twice and a key still has very many, they are dealt into groups and
every pair of groups is joined by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of, kept, kept_fields, map_batches, named, refuse_clashes, stored, unstored, with_fields

#: Fingerprints of a key that one task joins; beyond it the key is split by further bits, so many times, then into groups of this size.
KEY_ROWS = 20_000
REFINED = 2
#: Fingerprints with the most rows, whose rows are dealt over several tasks at the end; any other has less than a thousandth of all.
HOT_PRINTS = 1_000
#: Node pairs that a worker expands at a time.
FRONTIER = 1 << 18
BATCH_BYTES = 4 << 20


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of 64-bit hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()  # on bytes both are ASCII's: A-Z, and \x20 \x09-\x0D
    if not words:
        return 0
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], "<u8")
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: n - 1] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], "<u8", n)
    return majority(hashes)


def fingerprints(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Columns ``keep`` and ``fp`` (64 bits as a signed long) of every row.

    Words are runs of other than ASCII white space, A-Z in lower case; the
    shingles are hashed with repeats.  Fewer words than a shingle: the whole
    sequence is the shingle.  Null, empty and blank texts: 0.
    """
    keep = keep or []
    refuse_clashes(keep, "fp")
    source = df.select(*kept(df, keep), df[text_col].cast("string").alias("__text"))
    fields = kept_fields(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "__text", BATCH_BYTES):
            texts = batch.column("__text").cast(pa.large_binary()).to_pylist()
            fps = np.array([_fingerprint(t, shingle, seed) if t else 0 for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(fps)], names=[*(f.name for f in fields), "fp"])

    return named(map_batches(source, run, with_fields(fields, "fp long")), keep, "fp")


class Forest:
    """Union-find over the leaves of a chunk; ``links`` are the edges that joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link a[i] with b[i], whole arrays at a time: each round every tree hooks to its smallest neighbour."""
        while len(a):
            roots = self.roots()
            ra, rb = roots[a], roots[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            order = np.lexsort((low, high))
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            self.parent[high[first]] = low[first]
            self.links += zip(a[first].tolist(), b[first].tolist(), strict=True)


def trie_join(keys: np.ndarray, groups: np.ndarray, bits: int, budget: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over rows that share a group and whose ``keys`` differ in at most ``budget`` bits.

    Rows are sorted by (group, key), keys distinct in a group; only the low ``bits`` bits count.
    A trie node is a run of rows; its children are found by binary search for the first row with the next bit set.
    """
    n = len(keys)
    forest = Forest(n)
    # Position of the first row from lo on, below hi, whose bit `level` is set: rows of a node are sorted, so a count of unset bits.
    zeros = [None] * bits
    for level in range(bits):
        zeros[level] = np.concatenate([[0], np.cumsum((keys >> np.uint64(level)) & np.uint64(1) == 0)]).astype(np.int32)
    edges = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1 if n else 0)) if n else np.zeros(0, np.int64)
    lo = edges.astype(np.int32)
    hi = np.append(edges[1:], n).astype(np.int32)
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    stack = [(bits - 1, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        level, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > FRONTIER:
            for at in range(0, len(alo), FRONTIER):
                part = slice(at, at + FRONTIER)
                stack.append((level, alo[part], ahi[part], blo[part], bhi[part], diff[part]))
            continue
        if not len(alo):
            continue
        # Nodes that the remaining levels can't part, or two leaves at the end: link all their leaves in a chain.
        done = diff + (level + 1) <= budget
        if done.any():
            first, size = np.concatenate([alo[done], blo[done]]), np.concatenate([ahi[done] - alo[done], bhi[done] - blo[done]])
            reps = np.repeat(first, size - 1)
            steps = np.arange(len(reps)) - np.repeat(np.cumsum(size - 1) - (size - 1), size - 1) + 1
            forest.link(np.concatenate([reps, alo[done]]), np.concatenate([reps + steps, blo[done]]))
            alo, ahi, blo, bhi, diff = (x[~done] for x in (alo, ahi, blo, bhi, diff))
        if level < 0 or not len(alo):
            continue
        # Leave out pairs whose leaves are one component already.
        roots = forest.roots()
        turns = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
        one = (turns[ahi - 1] == turns[alo]) & (turns[bhi - 1] == turns[blo]) & (roots[alo] == roots[blo])
        one &= (ahi - alo > 1) | (bhi - blo > 1) | (alo != blo)
        same = (alo == blo) & (ahi == bhi)
        keep = ~one & ~(same & (ahi - alo == 1))
        alo, ahi, blo, bhi, diff, same = (x[keep] for x in (alo, ahi, blo, bhi, diff, same))
        z = zeros[level]
        am, bm = alo + (z[ahi] - z[alo]), blo + (z[bhi] - z[blo])
        parts = [
            (alo, am, blo, bm, diff),
            (am, ahi, bm, bhi, diff),
            (alo, am, bm, bhi, diff + 1),
            (*(x[~same] for x in (am, ahi, blo, bm)), diff[~same] + 1),
        ]
        alo, ahi, blo, bhi, diff = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (ahi > alo) & (bhi > blo) & (diff <= budget)
        alo, ahi, blo, bhi, diff = (x[live] for x in (alo, ahi, blo, bhi, diff))
        stack.append((level - 1, alo, ahi, blo, bhi, diff.astype(np.int8)))
    return forest.links


def _tables(budget: int, blocks: int) -> list[tuple[int, int]]:
    """(mask of the key's bits, mask of the others) of each table."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    out = []
    for chosen in combinations(range(blocks), blocks - budget):
        key = sum(masks[i] for i in chosen)
        out.append((key, ((1 << 64) - 1) ^ key))
    return out


def _refined(table: tuple[int, int], budget: int) -> list[tuple[int, int]]:
    """Tables whose keys have one block more of the bits left: pairs within the budget agree on one of budget + 1 blocks."""
    key, rest = table
    bits = [i for i in range(64) if rest >> i & 1]
    edges = [len(bits) * i // (budget + 1) for i in range(budget + 2)]
    masks = [sum(1 << i for i in bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [(key | m, rest ^ m) for m in masks]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(fps: DataFrame, budget: int = 3, blocks: int = 4, key_rows: int = KEY_ROWS) -> DataFrame:
    """Edges (a, b) between distinct values of ``fp``: enough that whatever is linked at ``budget`` or fewer differing bits is connected.

    ``fps`` holds each value once.  Null values don't occur.  An empty table, or one without links, gives no rows.
    """
    if blocks <= budget:
        raise ValueError("blocks must exceed the budget")
    tables, children, level = _tables(budget, blocks), {}, range(0)
    level = range(len(tables))
    for _ in range(REFINED):
        for t in level:
            children[t] = list(range(len(tables), len(tables) + budget + 1))
            tables += _refined(tables[t], budget)
        level = range(children[level[0]][0], len(tables))
    masks = F.array(*[F.lit(_signed(k)).cast("long") for k, _ in tables])

    def filed(rows: DataFrame, chosen: Column) -> DataFrame:
        out = rows.withColumn("t", F.explode(chosen))
        return out.select("fp", "t", F.col("fp").bitwiseAND(F.get(masks, F.col("t"))).alias("key"))

    now = filed(fps.select("fp"), F.array(*[F.lit(t) for t in range(len(_tables(budget, blocks)))]))
    done: list[DataFrame] = []
    parts = F.lit(None).cast("int")
    for step in range(REFINED + 1):
        crowd = stored(now.groupBy("t", "key").count().where(F.col("count") > key_rows).withColumn("parts", F.ceil(F.col("count") / key_rows).cast("int")).select("t", "key", "parts"), "crowd")
        if crowd.isEmpty():
            break
        sized = now.join(crowd, ["t", "key"], "left")
        if step == REFINED:
            now, parts = sized, F.col("parts")
            break
        done.append(sized.where("parts IS NULL").select("fp", "t", "key"))
        below = F.array(*[F.array(*[F.lit(c) for c in children.get(t, [])]).cast("array<int>") for t in range(len(tables))])
        now = filed(sized.where("parts IS NOT NULL").select("fp", "t"), F.get(below, F.col("t")))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    pairs = F.when(parts.isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0), parts - 1), lambda j: (F.least(j, own) * parts + F.greatest(j, own)).cast("long")))
    dealt = now.select("t", "key", "fp", F.explode(pairs).alias("pair"))
    for rows in done:
        dealt = dealt.unionByName(rows.withColumn("pair", F.lit(0).cast("long")))
    grouped = dealt.withColumn("group", F.xxhash64("t", "key", "pair")).repartition("group").sortWithinPartitions("group", "t", "key", "pair")
    rest_masks = [np.uint64(r) for _, r in tables]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by their group; groups are gathered to chunks of some size and joined."""

        def joined(t: np.ndarray, key: np.ndarray, pair: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a_out, b_out = [], []
            for k in np.unique(t).tolist():
                mine, mask = t == k, rest_masks[k]
                f, ky, pr = fp[mine], key[mine], pair[mine]
                # The bits outside the key, moved together, highest first.
                rest, width = np.zeros(len(f), np.uint64), 0
                for bit in range(64):
                    if int(mask) >> bit & 1:
                        rest |= ((f >> np.uint64(bit)) & np.uint64(1)) << np.uint64(width)
                        width += 1
                order = np.lexsort((rest, pr, ky))
                f, ky, pr, rest = f[order], ky[order], pr[order], rest[order]
                group = np.cumsum((np.diff(ky, prepend=ky[0]) != 0) | (np.diff(pr, prepend=pr[0]) != 0))
                links = trie_join(rest, group, width, budget)
                if links:
                    at = np.array(links)
                    a_out.append(f[at[:, 0]])
                    b_out.append(f[at[:, 1]])
            a = np.concatenate(a_out).view(np.int64) if a_out else np.zeros(0, np.int64)
            b = np.concatenate(b_out).view(np.int64) if b_out else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(np.asarray(batch.column(c)) for c in ("group", "t", "key", "pair", "fp")))
            size += batch.num_rows
            if size >= 4 * KEY_ROWS:
                g, t, key, pair, fp = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(g, g[-1], side="left"))  # the last group may go on
                if cut:
                    yield joined(t[:cut], key[:cut], pair[:cut], fp[:cut].view(np.uint64))
                held, size = [(g[cut:], t[cut:], key[cut:], pair[cut:], fp[cut:])], len(g) - cut
        if size:
            _, t, key, pair, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            yield joined(t, key, pair, fp.view(np.uint64))

    return map_batches(grouped.select("group", "t", "key", "pair", "fp"), run, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the component's smallest node.

    Alternating large-star and small-star (Kiveris et al., 2014), each round stored
    in the shared folder, until the edges are stars.  The neighbours of a node
    are never gathered: a star's centre is a minimum, joined back to its edges.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = both.join(low, "u")
        if large:
            # Neighbours above the node get the smallest of its neighbourhood.
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    last = None
    for _ in range(max_rounds):
        before, now = now, stored(star(star(now, True), False), "edges")
        unstored(before)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("the components did not settle")
    return now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 3, blocks: int = 4, shingle: int = 3, seed: int = 42, key_rows: int = KEY_ROWS) -> DataFrame:
    """Per row: ``id_col``, fingerprint (16 hex digits), component_id (smallest id that links reach, its own included).

    Rows with equal fingerprints are linked.  Blank and null texts share
    fingerprint 0.  Repeated ids keep a row each; a null id is passed over in the
    minimum (null if the component has no other id).  Texts of any length count
    whole.  Further columns, whatever their names, are ignored.  Empty tables give no
    rows.
    """
    own = stored(fingerprints(df.select(df[id_col].alias("id"), df[text_col].alias("text")), "text", ["id"], shingle, seed), "fingerprints")
    distinct = stored(own.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    comp = components(fingerprint_links(distinct.select("fp"), budget, blocks, key_rows))
    rooted = distinct.join(comp, distinct["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Rows of very frequent fingerprints (of blank texts, say) are dealt over several tasks.
    often = F.broadcast(distinct.where(F.col("n") > key_rows).orderBy(F.desc("n"), "fp").limit(HOT_PRINTS).select("fp", F.ceil(F.col("n") / key_rows).cast("int").alias("parts")))
    labelled = rooted.join(least, "root").select("fp", "component_id").join(often, "fp", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    dealt = own.join(often, "fp", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    return dealt.join(labelled, ["fp", "part"]).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, 64 bits, at most 3 of them different."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
