"""Repeated passages by a column-wise built collection BWT with common prefixes.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier.
Windows of that length are dealt out by content: each window's anchor is its
least-hashed ``ANCHOR``-gram, so equal windows have equal anchors, wherever they
are, and the windows of one anchor's occurrence are a run, a *segment* of fewer
than ``2 * length`` bytes.  Segments meet by anchor, and hashes decide nothing
else than who meets.  The texts of all segments whose anchor occurs again are the
documents of a collection, equal ones as one document with several places, and the
collection's Burrows-Wheeler transform is built column by column (Bauer, Cox,
Rosone 2013; Cox, Garofalo, Rosone, Sciortino 2016): each round inserts one symbol
of every document, from its end, and updates transform, longest common prefixes
and suffix numbers, which lie in a file that is read and written front to back.
A symbol is ``SYMBOL`` bytes, so a text is that many documents, one for each byte
that symbols can begin at, and the rounds are fewer by as much.  Runs of common
prefixes of ``length`` bytes or more are the equal windows; all their places but the
first are removed.  Equal segments of a chunk of input are compared
byte by byte before, and only the first goes on.

An anchor that a sample shows to be frequent is dealt into groups of about ``HOT``
segments.  What a group keeps meets again by anchor, and where that is still more
than ``HOT`` segments, by the hash of single windows; the transform decides there too.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of, kept, kept_fields, map_batches, named, refuse_clashes, stored, text_key, utf8_buffer, with_fields

LENGTH, ANCHOR = 100, 20
#: Segments of an anchor that meet in one task (about); more are dealt into groups first.
HOT = 20_000
#: Documents (about) in which frequent anchors are looked for, and how often one must occur there at least. The sample changes who meets where, never what is found.
SAMPLE_DOCS, FREQUENT = 5_000, 10
#: Bytes of segments in a collection, if no single group has more.
COLLECTION_BYTES = 2 << 20
#: Windows that are looked at together when a collection is trimmed.
STRETCH = 16
#: Windows of a chunk whose anchors are searched at a time.
CHUNK_BYTES = 2 << 20
#: The transform's file stays in memory up to this size, then goes to disk like any spill of a task; rows that are read at a time.
FILE_BYTES, BLOCK_ROWS = 32 << 20, 1 << 21
#: Bytes of a symbol; fewer where a collection has more kinds or documents than 24 bits number, or a window isn't made of whole ones.
SYMBOL = 20
NO_ID = -(1 << 63)
_NUMBERS = 1 << 24

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _ODD[3]
    h ^= h >> np.uint64(29)
    h *= _ODD[4]
    return h ^ (h >> np.uint64(32))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as integers."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded.tobytes(), strides=(1,))


def _span_hash(words: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the bytes from ``first`` to ``last + length``; first and last window overlap, so both together hold every byte."""
    h = _mix((last - first).astype(np.uint64) + _ODD[2])
    for start in (first, last):
        for at in [*range(0, length - 8, 8), length - 8]:
            h = _mix((h ^ words[start + at]) * _ODD[0] + _ODD[1])
    return h


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(document, start, windows and anchor's place, anchor hash, segment hash) of a buffer's segments. ``start`` counts from the document's first byte."""
    n = len(data)
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < length:
        return empty
    words = _words(data)
    grams = n - anchor + 1
    h = words[:grams] * _ODD[0]
    for at in [*range(8, anchor - 8, 8), anchor - 8]:
        h += words[at : at + grams] * _ODD[1 + at % 3]
        h ^= h >> np.uint64(31)
        h *= _ODD[3]
    h = _mix(h)
    low = np.uint64((1 << 24) - 1)
    best = (h & ~low) | np.arange(grams, dtype=np.uint64)  # least hash, then the leftmost
    width, span = length - anchor + 1, 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
    at = (best & low).astype(np.int64)  # the anchor of each window of the buffer
    sizes = np.diff(offsets)
    valid = np.zeros(n + 1, np.int32)
    has = sizes >= length
    np.add.at(valid, offsets[:-1][has], 1)
    np.add.at(valid, offsets[1:][has] - length + 1, -1)
    valid = np.cumsum(valid)[: len(at)] > 0
    start = np.flatnonzero(valid & np.concatenate([[True], (at[1:] != at[:-1]) | ~valid[:-1]]))
    if not len(start):
        return empty
    stop = np.flatnonzero(valid & np.concatenate([(at[1:] != at[:-1]) | ~valid[1:], [True]]))
    doc = np.searchsorted(offsets, start, side="right") - 1
    # Windows of the segment, and above 8 bits where its anchor is.
    return doc, start - offsets[doc], (stop - start + 1) | (at[start] - start) << 8, h[at[start]], _span_hash(words, start, stop, length)


_SEGMENT = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("crc", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
_SEGMENT_SQL = "anchor long, id long, crc long, start int, n int"


def _intervals(keys: tuple[np.ndarray, ...], start: np.ndarray, stop: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Unions of the intervals of each key."""
    order = np.lexsort((stop, start, *reversed(keys)))
    keys = tuple(k[order] for k in keys)
    start, stop = start[order], stop[order]
    if not len(start):
        return keys, start, stop
    fresh = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
    group = np.cumsum(fresh) - 1
    lift = group * (1 << 33)  # so that a running maximum doesn't cross keys
    reach = np.maximum.accumulate(stop + lift)
    head = fresh | np.concatenate([[True], (start + lift)[1:] > reach[:-1]])
    at = np.flatnonzero(head)
    return tuple(k[at] for k in keys), start[at], (reach - lift)[np.append(at[1:], len(start)) - 1]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for size[0] numbers, then the same of the next."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _settled(data: np.ndarray, at: np.ndarray, anchor: np.ndarray, seg: np.ndarray, ids: np.ndarray, crc: np.ndarray, start: np.ndarray, n: np.ndarray, length: int) -> pa.RecordBatch:
    """Of equal segments of a chunk, held against each other byte by byte, only the first goes on; the others' bytes go on as intervals (n < 0: minus their size). ``at``: places in data."""
    order = np.lexsort((start, crc, ids, n, seg, anchor))
    t, a, s, i, c, p, m = (x[order] for x in (at, anchor, seg, ids, crc, start, n))
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1]) | (m[1:] != m[:-1])]) if len(a) else np.zeros(0, bool)
    of = np.flatnonzero(head)[np.cumsum(head) - 1] if len(a) else np.zeros(0, np.int64)
    gone = (i != i[of]) | (c != c[of]) | (p != p[of])
    like = np.flatnonzero(gone)
    if len(like):
        size = (m[like] & 255) + length - 1
        differ = data[_ranges(t[like], size)] != data[_ranges(t[of[like]], size)]
        gone[like[np.add.reduceat(differ, np.cumsum(size) - size, dtype=np.int64) > 0]] = False
    first = ~gone
    (gi, gc), gs, ge = _intervals((i[gone], c[gone]), p[gone], p[gone] + (m[gone] & 255) + length - 1)
    spread = _mix(gi.astype(np.uint64) * _ODD[0] + gs.astype(np.uint64)).view(np.int64)
    columns = ((a[first], spread), (i[first], gi), (c[first], gc), (p[first].astype(np.int32), gs.astype(np.int32)), (m[first].astype(np.int32), (gs - ge).astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], schema=_SEGMENT)


def _find_segments(length: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", CHUNK_BYTES):
            if not batch.num_rows:
                continue
            data, offsets = utf8_buffer(batch.column("text"))
            ids, crc = np.asarray(batch.column("id")), np.asarray(batch.column("crc"))
            # One very long text is taken in stretches that share all but one byte of a window.
            stretches = [0] if len(data) <= CHUNK_BYTES or batch.num_rows > 1 else range(0, len(data) - length + 1, CHUNK_BYTES)
            for at in stretches:
                part = data if len(stretches) == 1 else data[at : at + CHUNK_BYTES + length - 1]
                own = offsets if len(stretches) == 1 else np.array([0, len(part)])
                doc, start, n, a, s = segments(part, own, length, anchor)
                yield _settled(part, own[doc] + start, a.view(np.int64), s.view(np.int64), ids[doc], crc[doc], start + at, n, length)

    return run


def frequent_anchors(docs: DataFrame, length: int, anchor: int, hot: int) -> DataFrame:
    """(anchor, parts) of anchors that have more than ``hot`` segments, by a sample of the documents; at most a few thousand."""
    n = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, n))
    some = docs.sample(False, share, 7) if share < 1 else docs
    seen = map_batches(some.where(F.octet_length("text") >= length), _find_segments(length, anchor), _SEGMENT_SQL).where("n > 0").groupBy("anchor").count()
    found = seen.where(F.col("count") >= max(FREQUENT, hot * share)).select("anchor", F.ceil(F.col("count") / (hot * share)).cast("int").alias("parts"))
    return docs.sparkSession.createDataFrame(found.collect(), "anchor long, parts int")


def meet(found: DataFrame, frequent: DataFrame) -> DataFrame:
    """Adds ``grp`` (who meets) and ``hot`` (is it a part of a frequent anchor only); leaves out segments that meet no other. One shuffle."""
    dealt = found.join(F.broadcast(frequent), "anchor", "left").withColumn("hot", F.col("parts").isNotNull())
    group = F.when(F.col("hot"), F.xxhash64("anchor", F.pmod(F.xxhash64("id", "crc", "start"), F.col("parts")))).otherwise(F.col("anchor"))
    dealt = dealt.withColumn("grp", group).drop("parts").repartition("grp")
    return dealt.withColumn("c", F.count("*").over(W.partitionBy("grp"))).where("n < 0 OR c > 1 OR hot").drop("c")


class RowFile:
    """The rows of the growing transform as 64-bit numbers (symbol in 24 bits, common prefix and suffix length in 8 each, document in 24), written and read front to back; on disk beyond ``limit`` bytes."""

    def __init__(self, limit: int):
        self.limit, self.held, self.bytes, self.file = limit, [], 0, None

    def write(self, rows: np.ndarray) -> None:
        self.bytes += rows.nbytes
        if self.file is None and self.bytes > self.limit:
            self.file = tempfile.TemporaryFile()  # noqa: SIM115 - private to the task attempt, like its spills
            for part in self.held:
                self.file.write(memoryview(part).cast("B"))
            self.held = []
        if self.file is not None:
            self.file.write(memoryview(np.ascontiguousarray(rows)).cast("B"))
        elif len(rows):
            self.held.append(rows)

    def blocks(self, block: int) -> Iterator[np.ndarray]:
        if self.file is None:
            if len(self.held) > 1:
                self.held = [np.concatenate(self.held)]
            for part in self.held:
                for at in range(0, len(part), block):
                    yield part[at : at + block]
            return
        self.file.seek(0)
        while got := self.file.read(8 * block):
            yield np.frombuffer(bytearray(got), "<u8")

    def close(self) -> None:
        self.held = []
        if self.file is not None:
            self.file.close()


def _packed(symbol: np.ndarray, prefix: np.ndarray | int, size: int, doc: np.ndarray) -> np.ndarray:
    return symbol.astype(np.uint64) | np.asarray(prefix, np.uint64) << np.uint64(24) | np.uint64(size << 32) | doc.astype(np.uint64) << np.uint64(40)


def _fields(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, common prefix, suffix length, document) of rows."""
    small = rows.view(np.uint8).reshape(-1, 8)
    return rows.view(np.uint32)[::2] & np.uint32(_NUMBERS - 1), small[:, 3], small[:, 4], rows >> np.uint64(40)


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first] to values[last], for many ranges of any length: by the least of 64s, and of runs of them."""
    rows = np.append(values, np.full(-len(values) % 64, 255, np.uint8)).reshape(-1, 64)
    front, back = rows.copy(), rows.copy()
    for step in (1, 2, 4, 8, 16, 32):
        front[:, step:] = np.minimum(front[:, step:], front[:, :-step])
        back[:, :-step] = np.minimum(back[:, :-step], back[:, step:])
    runs = [np.ascontiguousarray(front[:, 63])]
    while 2 ** len(runs) <= len(rows):
        half = 2 ** (len(runs) - 1)
        runs.append(np.minimum(runs[-1][:-half], runs[-1][half:]))
    a, b = first >> 6, last >> 6
    out = np.minimum(back.ravel()[first], front.ravel()[last])
    between = b - a - 1
    for k in range(len(runs)):
        own = np.flatnonzero((between >> k) == 1)
        if len(own):
            out[own] = np.minimum(out[own], np.minimum(runs[k][a[own] + 1], runs[k][b[own] - 2**k]))
    near = np.flatnonzero(a == b)
    if len(near):
        near = near[np.argsort(first[near])]
        ends = np.empty(2 * len(near), np.int64)
        ends[0::2], ends[1::2] = first[near], last[near] + 1
        out[near] = np.minimum.reduceat(np.append(values, np.uint8(0)), ends)[0::2]
    return out


class _Places:
    """First pass of a round: rows are read front to back; the suffixes to insert get their places and common prefixes, what comes after them its new one."""

    def __init__(self, counts: np.ndarray, size: int, blocks: bool):
        """``blocks``: the rows come in several, so symbols are counted from one to the next."""
        self.end, self.size, self.blocks = len(counts) - 1, size, blocks
        self.parts: list[tuple[np.ndarray, ...]] = []
        if blocks:
            self.below = np.cumsum(counts) - counts
            self.seen = np.zeros(len(counts), np.int64)
            self.least = np.full(len(counts), 255, np.uint8)  # common prefixes since a symbol's last row
            self.after_new = np.zeros(len(counts), bool)

    def read(self, rows: np.ndarray, more: bool) -> None:
        """``more``: rows follow that will ask for what was last."""
        symbol, prefix, length = _fields(rows)[:3]
        prefix, new = np.ascontiguousarray(prefix), length == self.size - 1
        # By symbol, then by place; rows without a symbol have the last number and come last.
        keys = np.sort(symbol.astype(np.uint64) << np.uint64(32) | np.arange(len(rows), dtype=np.uint64))
        keys = keys[: np.searchsorted(keys, np.uint64(self.end << 32))]
        low = prefix.min() if more else 0
        if not len(keys):
            if more:
                self.least = np.minimum(self.least, low)
            return
        order, kind = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), keys >> np.uint64(32)
        head = np.concatenate([[True], kind[1:] != kind[:-1]])
        fresh = new[order]
        touched = fresh.copy()
        touched[1:] |= fresh[:-1] & ~head[1:]
        if self.blocks:
            heads = np.flatnonzero(head)
            kinds, sizes = kind[heads], np.diff(np.append(heads, len(keys)))
            touched[heads] |= self.after_new[kinds]
        t = np.flatnonzero(touched)
        at, inner = order[t], ~head[t]
        value, rank = np.zeros(len(t), np.uint8), t
        if inner.any():
            value[inner] = _least_between(prefix, order[t[inner] - 1] + 1, at[inner]) + 1
        if self.blocks:
            own = kind[t]
            met = np.flatnonzero(~inner & (self.seen[own] > 0))
            if len(met):  # a symbol's first row of the block, after others in blocks before
                value[met] = np.minimum(np.minimum.accumulate(prefix)[at[met]], self.least[own[met]]) + 1
            rank = self.below[own] + self.seen[own] + t - heads[np.searchsorted(heads, t, side="right") - 1]
            self.seen[kinds] += sizes
        self.parts.append((rank, fresh[t], value, (rows[at] >> np.uint64(40)).astype(np.int64)))
        if more:
            tails = order[heads + sizes - 1]
            since = np.append(np.minimum.accumulate(prefix[::-1])[::-1], np.uint8(255))
            self.least = np.minimum(self.least, low)
            self.least[kinds] = since[tails + 1]
            self.after_new[kinds] = new[tails]

    def sorted(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, k) for k in (np.int64, bool, np.uint8, np.int64))
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        return tuple(c[order] for c in columns)


def column_wise(data: np.ndarray, offsets: np.ndarray, block: int = BLOCK_ROWS, file_bytes: int = FILE_BYTES) -> Iterator[np.ndarray]:
    """All suffixes of a collection in sorted order, in blocks of rows, as ``_fields`` takes them apart: common prefix with the row before, suffix length, document.

    Documents hold fewer than 255 symbols; these, their kinds and the documents are numbered with 24 bits.
    Ends sort first and by document number, and match nothing.  Round j inserts the suffixes of length j: a
    row's place is the rank of its first symbol in the transform so far, and its
    common prefix is one more than the least between that symbol and its
    predecessor there.  A round reads the file twice and writes it once; besides a
    block, a round's new rows are all it holds.
    """
    m, sizes = len(offsets) - 1, np.diff(offsets)
    end = np.int64(data.max(initial=0)) + 1  # no symbol
    last = np.where(sizes > 0, data[np.maximum(offsets[1:] - 1, 0)] if len(data) else end, end)
    now = RowFile(file_bytes)
    for at in range(0, m, block):
        now.write(_packed(last[at : at + block], 0, 0, np.arange(at, min(m, at + block))))
    counts, n = np.bincount(last, minlength=end + 1), m
    for j in range(1, int(sizes.max(initial=0)) + 1):
        places, left = _Places(counts, j, n > block), n
        for rows in now.blocks(block):
            left -= len(rows)
            places.read(rows, left > 0)
        rank, fresh, value, doc = places.sorted()
        if not fresh.any():
            break
        own = doc[fresh]
        rest = sizes[own] - j
        symbol = np.where(rest > 0, data[np.maximum(offsets[own] + rest - 1, 0)], end)
        counts += np.bincount(symbol, minlength=end + 1)
        rows_new, place = _packed(symbol, value[fresh], j, own), m + rank[fresh]
        before = place - np.arange(len(place))  # the row of the file that each goes in front of
        moved = m + rank[~fresh]
        changed, to = moved - np.searchsorted(place, moved), value[~fresh].astype(np.uint64) << np.uint64(24)
        then, at, lo, clo = RowFile(file_bytes), 0, 0, 0
        for rows in now.blocks(block):
            chi, last_block = int(np.searchsorted(changed, at + len(rows))), at + len(rows) == n
            hi = len(before) if last_block else int(np.searchsorted(before, at + len(rows)))
            rows[changed[clo:chi] - at] = (rows[changed[clo:chi] - at] & ~np.uint64(0xFF000000)) | to[clo:chi]
            out, old = np.empty(len(rows) + hi - lo, np.uint64), np.ones(len(rows) + hi - lo, bool)
            target = place[lo:hi] - at - lo
            old[target] = False
            out[old], out[target] = rows, rows_new[lo:hi]
            then.write(out)
            at, lo, clo = at + len(rows), hi, chi
        now.close()
        now, n = then, n + len(place)
    yield from now.blocks(block)
    now.close()


def trimmed(data: np.ndarray, offsets: np.ndarray, anchors: np.ndarray, places: np.ndarray, whole: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(bytes, offsets, segment, bytes left out in front) of what segments may share with another of their group; of those in ``whole`` everything.

    Windows are taken in stretches of ``STRETCH`` by their distance to the anchor.
    All windows of a stretch hold the bytes between its last window's start and its
    first one's end, so those that no other segment has at that place can't recur.
    """
    n = np.diff(offsets) - length + 1
    first, last = (places - n + 1) // STRETCH, places // STRETCH  # stretches by distance of a window's start before the anchor
    last = np.minimum(last, (length - 1) // STRETCH)
    words, core = _words(data), length - STRETCH + 1
    lo, hi = np.full(len(n), 1 << 30), np.full(len(n), -1)
    for q in range(int(max(first.min(initial=0), 0)), int(last.max(initial=-1)) + 1):
        own = np.flatnonzero((first <= q) & (q <= last))
        at = offsets[own] + places[own] - q * STRETCH  # the core starts where the stretch's last window does
        inside = (at >= offsets[own]) & (at + core <= offsets[own + 1])
        h = anchors[own].astype(np.uint64) + np.uint64(q)
        for step in [*range(0, core - 8, 8), core - 8]:
            h = _mix((h ^ words[np.clip(at + step, 0, len(words) - 1)]) * _ODD[0] + _ODD[1])
        _, code, count = np.unique(h, return_inverse=True, return_counts=True)
        stay = own[(count[code] > 1) | ~inside | whole[own]]
        # Window starts of the stretch, as places in the segment.
        lo[stay] = np.minimum(lo[stay], np.maximum(places[stay] - q * STRETCH - STRETCH + 1, 0))
        hi[stay] = np.maximum(hi[stay], np.minimum(places[stay] - q * STRETCH, n[stay] - 1))
    kept = np.flatnonzero(hi >= lo)
    size = hi[kept] - lo[kept] + length
    ends = np.concatenate([[0], np.cumsum(size)])
    return data[_ranges(offsets[kept] + lo[kept], size)], ends, kept, lo[kept]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal values as equal numbers from 0 on, and how many there are."""
    kinds, codes = np.unique(values, return_inverse=True)
    return codes, len(kinds)


def _symbols(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, offsets, bytes of one) of a collection: a text gives a document for each of the bytes that a symbol can begin at."""
    for size in (s for s in dict.fromkeys((SYMBOL, 4, 2, 1)) if s <= SYMBOL and length % s == 0):
        if (len(offsets) - 1) * size >= _NUMBERS:
            continue
        each = np.arange(size)
        counts = np.maximum((np.diff(offsets)[:, None] - each) // size, 0).ravel()
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = (offsets[:-1, None] + each).ravel()
        at = np.repeat(first - size * ends[:-1], counts) + size * np.arange(ends[-1])
        words, done = _words(data), min(size, 8)
        codes, kinds = _numbered(words[at] & np.uint64((1 << (8 * done)) - 1))
        while done < size and kinds < _NUMBERS:  # equal so far, and in the next bytes
            more = min(size - done, 5)
            codes, kinds = _numbered(codes.astype(np.uint64) << np.uint64(40) | words[at + done] & np.uint64((1 << (8 * more)) - 1))
            done += more
        if kinds < _NUMBERS:
            return codes, ends, size
    raise ValueError(f"{len(offsets) - 1} texts of one group are more than one task can transform")


def repeated_windows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, group) of all windows of a collection, equal ones in one group, from the blocks of its transform."""
    symbols, ends, size = _symbols(data, offsets, length)
    docs, sizes, groups, group = [], [], [], 0
    for rows in column_wise(symbols, ends):
        _, prefix, n, doc = _fields(rows)
        own = np.cumsum(prefix < length // size) + group
        group = int(own[-1])
        windows = np.flatnonzero(n >= length // size)
        docs.append(doc[windows].astype(np.int64))
        sizes.append(n[windows].astype(np.int64))
        groups.append(own[windows])
    doc, n, group = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, sizes, groups))
    return doc // size, doc % size + size * (np.diff(ends)[doc] - n), group


def _cut_out(length: int):
    """Segment texts out of documents."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", CHUNK_BYTES):
            data, offsets = utf8_buffer(batch.column("text"))
            wanted = batch.column("wanted")
            flat = wanted.flatten()
            per = np.asarray(pa.compute.list_value_length(wanted)).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), per)
            start, n = (np.asarray(flat.field(k)).astype(np.int64) for k in ("start", "n"))
            first, raw = offsets[doc] + start, data.tobytes()
            cut = [raw[s:e] for s, e in zip(first.tolist(), (first + (n & 255) + length - 1).tolist(), strict=True)]
            ids, crc = (batch.column(k).take(pa.array(doc)) for k in ("id", "crc"))
            yield pa.RecordBatch.from_arrays([flat.field("grp"), flat.field("anchor"), flat.field("hot"), ids, crc, flat.field("start"), pa.array((n >> 8).astype(np.int32)), pa.array(cut, pa.binary())], schema=_PIECE)

    return texts


_PIECE = pa.schema([("grp", pa.int64()), ("anchor", pa.int64()), ("hot", pa.bool_()), ("id", pa.int64()), ("crc", pa.int64()), ("start", pa.int32()), ("at", pa.int32()), ("data", pa.binary())])
_PIECE_SQL = "grp long, anchor long, hot boolean, id long, crc long, start int, at int, data binary"
#: Removed bytes (s to e), or with data what a part of a frequent anchor keeps.
_BUILT = pa.schema([("id", pa.int64()), ("crc", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("anchor", pa.int64()), ("at", pa.int32()), ("data", pa.binary())])
_BUILT_SQL = "id long, crc long, s int, e int, anchor long, at int, data binary"


def _decided(table: pa.Table, length: int) -> pa.RecordBatch:
    """What the transform of a collection says of its segments; rows are sorted by group."""
    column = pa.concat_arrays(table.column("data").chunks).cast(pa.large_binary())
    of = {k: np.asarray(table.column(k)).astype(np.int64) for k in ("grp", "anchor", "id", "crc", "start", "at")}
    hot = np.asarray(table.column("hot"))
    same = np.asarray(column.dictionary_encode().indices).astype(np.int64)
    order = np.lexsort((of["start"], of["crc"], of["id"], same, of["grp"]))
    grp, anchor, ids, crc, start, place = (of[k][order] for k in ("grp", "anchor", "id", "crc", "start", "at"))
    same, hot = same[order], hot[order]
    # Equal segments of a group are one document of the collection; its first place leads.
    head = np.flatnonzero(np.concatenate([[True], (same[1:] != same[:-1]) | (grp[1:] != grp[:-1])]))
    text = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(grp))))
    lead = head[text]
    later = (ids != ids[lead]) | (crc != crc[lead]) | (start != start[lead])
    whole = (np.bincount(text, later, len(head)) > 0) | hot[head]
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw, first = np.frombuffer(column.buffers()[2], np.uint8), offsets[:-1][order[head]]
    size = (offsets[1:] - offsets[:-1])[order[head]]
    data, ends = raw[_ranges(first, size)], np.concatenate([[0], np.cumsum(size)])
    cut, cut_ends, own, moved = trimmed(data, ends, grp[head], place[head], whole, length)
    doc, at, group = repeated_windows(cut, cut_ends, length)
    at, doc = at + moved[doc], own[doc]
    i, c, p = ids[head[doc]], crc[head[doc]], start[head[doc]] + at
    by = np.lexsort((p, c, i, group))
    heads = np.flatnonzero(np.diff(group[by], prepend=-1))
    first_of = np.empty(len(by), np.int64)
    first_of[by] = by[np.repeat(heads, np.diff(np.append(heads, len(by))))]
    gone = (i != i[first_of]) | (c != c[first_of]) | (p != p[first_of])
    # Places behind a document's first one go with all its windows.
    least, most = np.full(len(head), 1 << 30), np.full(len(head), -1)
    np.minimum.at(least, doc, at)
    np.maximum.at(most, doc, at)
    more = np.flatnonzero(later & (most[text] >= 0))
    (ri, rc), rs, re = _intervals((np.concatenate([i[gone], ids[more]]), np.concatenate([c[gone], crc[more]])), np.concatenate([p[gone], start[more] + least[text[more]]]), np.concatenate([p[gone] + length, start[more] + most[text[more]] + length]))
    # What a part of a frequent anchor keeps: runs of windows that stay.
    stay = np.flatnonzero(~gone & hot[head[doc]])
    stay = stay[np.lexsort((at[stay], doc[stay]))]
    d, a = doc[stay], at[stay]
    begin = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] != a[:-1] + 1)])) if len(d) else np.zeros(0, np.int64)
    stop = np.append(begin[1:], len(d)) - 1
    d, a, z = d[begin], a[begin], a[stop] - a[begin] + length if len(d) else np.zeros(0, np.int64)
    base, blob = ends[d] + a, data.tobytes()
    none = np.zeros(len(rs), np.int64)
    columns = ((ri, ids[head[d]]), (rc, crc[head[d]]), (rs, start[head[d]] + a), (re, start[head[d]] + a + z), (none, anchor[head[d]]), (none, place[head[d]] - a))
    arrays = [pa.array(np.concatenate(x)).cast(f.type) for x, f in zip(columns, _BUILT, strict=False)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([None] * len(rs) + [blob[x : x + y] for x, y in zip(base.tolist(), z.tolist(), strict=True)], pa.binary())], schema=_BUILT)


def _build(length: int, collection_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; whole groups are gathered to a collection."""
        held: list[pa.RecordBatch] = []
        size = 0
        for whole in batches:
            for batch in (whole.slice(at, 4096) for at in range(0, whole.num_rows, 4096)):
                held.append(batch)
                size += batch.column("data").nbytes
                if size >= collection_bytes:
                    table = pa.Table.from_batches(held)
                    groups = np.asarray(table.column("grp"))
                    cut = int(np.searchsorted(groups, groups[-1], side="left"))
                    if cut:
                        yield _decided(table.slice(0, cut), length)
                        table = table.slice(cut)
                    held, size = table.to_batches(), table.column("data").nbytes
        if held:
            yield _decided(pa.Table.from_batches(held), length)

    return run


def _window_keys(length: int):
    """(key, id, crc, start) of every window of segments, key being its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "data", CHUNK_BYTES):
            column = batch.column("data").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            n = np.diff(offsets) - length + 1
            each, at = np.repeat(np.arange(len(n)), n), _ranges(offsets[:-1] - offsets[0], n)
            step = at - (offsets[:-1] - offsets[0])[each]
            key = _span_hash(_words(data), at, at, length).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("id").take(pa.array(each)), batch.column("crc").take(pa.array(each)), pa.array((np.asarray(batch.column("s"))[each] + step).astype(np.int32))], names=["anchor", "id", "crc", "start"])

    return run


def _remove(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "__text", CHUNK_BYTES):
            texts = batch.column("__text").cast(pa.large_binary()).to_pylist()
            kept, sizes, spans, ends = [], [], [], []
            for text, gone in zip(texts, batch.column("__gone").to_pylist(), strict=True):
                text, runs = text or b"", []
                for s, e in sorted((x["s"], x["e"]) for x in gone or ()):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                at, parts = 0, []
                for s, e in runs:
                    parts.append(text[at:s])
                    at = e
                parts.append(text[at:])
                kept.append(b"".join(parts))
                sizes.append(len(text))
                spans.append([r[0] for r in runs])
                ends.append([r[1] for r in runs])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], names=[*names, "kept", "n_bytes", "span_starts", "span_ends"])

    return run


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    hot: int = HOT,
    collection_bytes: int = COLLECTION_BYTES,
) -> DataFrame:
    """Per row: the columns ``keep`` (default: ``id_col``), kept (its remaining bytes), n_bytes, span_starts and span_ends of the maximal removed runs.

    Strings are compared on the input, so a removal takes nothing from others'
    matches; none crosses documents.  "Earlier" is by id, then for rows that share
    an id by a checksum of the text, then by start.  A null text is empty; a null
    id comes before all others.  Repeated rows (same id and text) count as one
    document: each gets that document's result.  Ids are whole numbers; others are an
    error.  Very long texts are searched in
    stretches that share all but one byte of a window, so nothing is missed.  Columns
    that aren't kept may have any name; one of ``keep`` that is named like an output is
    an error.  Empty tables give no rows.
    """
    if not 8 <= anchor <= length or 2 * length - anchor >= 255:
        raise ValueError("anchor must be 8 or more and length at most 127 + anchor / 2")
    keep = [id_col] if keep is None else keep
    refuse_clashes(keep, "kept", "n_bytes", "span_starts", "span_ends")
    key_id, key_crc = F.coalesce(df[id_col].cast("long"), F.lit(NO_ID)), text_key(df[text_col].cast("string"))
    docs = df.select(key_id.alias("id"), key_crc.alias("crc"), df[text_col].cast("string").alias("text"))
    frequent = frequent_anchors(docs, length, anchor, hot)
    found = map_batches(docs.where(F.octet_length("text") >= length), _find_segments(length, anchor), _SEGMENT_SQL)
    known = stored(meet(found, frequent), "segments")
    gone = known.where("n < 0").selectExpr("id", "crc", "start AS s", "start - n AS e")

    def with_text(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("id", "crc").agg(F.collect_set(F.struct("grp", "anchor", "hot", "start", "n")).alias("wanted"))
        return map_batches(docs.join(wanted.hint("shuffle_hash"), ["id", "crc"]), _cut_out(length), _PIECE_SQL)

    def decided(pieces: DataFrame) -> DataFrame:
        return map_batches(pieces.repartition("grp").sortWithinPartitions("grp"), _build(length, collection_bytes), _BUILT_SQL)

    built = decided(with_text(known.where("n > 0")))
    if not frequent.isEmpty():
        built = stored(built, "parts")
        left = built.where("data IS NOT NULL")
        crowd = stored(left.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "crowd")
        again = left.join(crowd, "anchor", "left_anti").selectExpr("anchor AS grp", "anchor", "false AS hot", "id", "crc", "s AS start", "at", "data")
        gone = gone.union(decided(again).select("id", "crc", "s", "e"))
        if not crowd.isEmpty():
            windows = map_batches(left.join(crowd, "anchor", "left_semi"), _window_keys(length), "anchor long, id long, crc long, start int").withColumn("n", F.lit(1))
            windows = stored(meet(windows, frequent.where("false")), "windows")
            gone = gone.union(decided(with_text(windows)).select("id", "crc", "s", "e"))
    gone = gone.union(built.where("data IS NULL").select("id", "crc", "s", "e"))
    per_doc = gone.groupBy("id", "crc").agg(F.collect_list(F.struct("s", "e")).alias("__gone")).select(F.col("id").alias("__id"), F.col("crc").alias("__crc"), "__gone")
    rows = df.select(*kept(df, keep), key_id.alias("__id"), key_crc.alias("__crc"), df[text_col].cast("string").alias("__text"))
    joined = rows.join(per_doc.hint("shuffle_hash"), ["__id", "__crc"], "left").drop("__id", "__crc")
    fields = kept_fields(joined)
    schema = with_fields(fields, "kept binary, n_bytes long, span_starts array<int>, span_ends array<int>")
    return named(map_batches(joined, _remove([f.name for f in fields]), schema), keep, "kept", "n_bytes", "span_starts", "span_ends")


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, strings of 100 bytes."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
