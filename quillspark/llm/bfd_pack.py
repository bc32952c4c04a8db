"""Token-id output: best-fit-decreasing packing with a segment tree over free capacities.

A document longer than a sequence is split into whole sequences and a rest, so
nothing is lost.  Rests and short documents are sorted by length, longest first;
each goes to the open sequence with the least room that still holds it.  A
segment tree over the capacities 0..T, with the number of open sequences at each,
finds that capacity in O(log T).

Every task packs its own input in blocks of bounded size; badly filled sequences
of a block are opened again in the next one, at most ``REOPEN`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from quillspark.llm.common import batches_of, map_batches
from quillspark.llm.tokens import BatchTokenizer, tokenizer_path

BLOCK_BYTES = 4 << 20
#: Sequences filled to less than 95 % that a block hands on to the next.
REOPEN = 512
#: Sequences of an output batch.
ROWS = 512


class CapacityTree:
    """Counts of open bins by free capacity; ``fit(n)`` is the least capacity of n or more that some bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def fit(self, need: int) -> int:
        """-1 if no open bin has the room."""
        count, i = self.count, need + self.size
        if count[i]:
            return need
        while i > 1:
            if not i & 1 and count[i + 1]:  # a left child whose sibling holds larger capacities
                i += 1
                while i < self.size:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers. Ties in length go by item number, ties in capacity to the bin that got there last."""
    tree, open_bins, bins = CapacityTree(capacity), {}, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        room = tree.fit(need)
        if room < 0:
            b, room = len(bins), capacity
            bins.append([])
        else:
            b = open_bins[room].pop()
            tree.add(room, -1)
        bins[b].append(item)
        if room > need:
            open_bins.setdefault(room - need, []).append(b)
            tree.add(room - need, 1)
    return bins


class _Pool:
    """Pieces of documents whose ids lie in one buffer, by arrays: document (row of ``docs``), start in it, length, place in the buffer."""

    def __init__(self, docs: pa.Array):
        self.docs, self.ids = docs, np.zeros(0, np.uint32)
        self.doc, self.start, self.length, self.base = (np.zeros(0, np.int64) for _ in range(4))

    def only(self, pieces: np.ndarray) -> None:
        """Keeps these pieces, in this order."""
        length = self.length[pieces]
        ends = np.concatenate([[0], np.cumsum(length)])
        self.ids = self.ids[np.repeat(self.base[pieces] - ends[:-1], length) + np.arange(ends[-1])]
        self.docs = self.docs.take(pa.array(self.doc[pieces]))
        self.doc, self.start, self.length, self.base = np.arange(len(pieces)), self.start[pieces], length, ends[:-1]

    def add(self, docs: pa.Array, ids: np.ndarray, lengths: np.ndarray, capacity: int) -> None:
        """Documents, cut into whole sequences and a rest."""
        parts = -(-lengths // capacity)
        doc = np.repeat(np.arange(len(lengths)), parts)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * capacity
        first = np.cumsum(lengths) - lengths + len(self.ids)
        self.doc = np.concatenate([self.doc, doc + len(self.docs)])
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, np.minimum(lengths[doc] - start, capacity)])
        self.base = np.concatenate([self.base, first[doc] + start])
        self.docs = pa.concat_arrays([self.docs, docs])
        self.ids = np.concatenate([self.ids, ids])


def _rows(pool: _Pool, sequences: list[list[int]], first_id: int, capacity: int, pad_id: int, kind: str, names: list[str]) -> pa.RecordBatch:
    """The rows of some sequences: one gather for the id matrix, one for the positions."""
    sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
    piece = np.fromiter(chain.from_iterable(sequences), np.int64, int(sizes.sum()))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    row = np.repeat(np.arange(len(sequences)), sizes)
    length = pool.length[piece]
    ends = np.concatenate([[0], np.cumsum(length)])
    filled = ends[edges[1:]] - ends[edges[:-1]]
    offset = ends[:-1] - ends[edges[row]]  # of a piece in its sequence
    within = np.arange(ends[-1]) - np.repeat(ends[:-1], length)
    at = np.repeat(row * capacity + offset, length) + within
    matrix = np.full(len(sequences) * capacity, pad_id, kind)
    matrix[at] = pool.ids[np.repeat(pool.base[piece], length) + within]
    position = (np.arange(capacity) - filled[:, None]).ravel()  # the padding's; the segments' follow
    position[at] = within
    sums_at = np.arange(len(piece)) + row + 1
    sums = np.zeros(len(piece) + len(sequences), np.int32)
    sums[sums_at] = offset + length
    lists = pa.array(edges.astype(np.int32))
    blobs = [m.astype(kind).reshape(len(sequences), capacity) for m in (matrix, position)]
    columns = [
        pa.array(first_id + np.arange(len(sequences))),
        pa.ListArray.from_arrays(lists, pool.docs.take(pa.array(pool.doc[piece]))),
        pa.ListArray.from_arrays(lists, pa.array(pool.start[piece])),
        pa.ListArray.from_arrays(lists, pa.array(length.astype(np.int32))),
        pa.ListArray.from_arrays(pa.array((edges + np.arange(len(edges))).astype(np.int32)), pa.array(sums)),
        pa.array(filled.astype(np.int32)),
        *[pa.array([r.tobytes() for r in m], pa.binary()) for m in blobs],
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def pack_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 49407,
    pad_id: int = 49407,
    id_bytes: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pack the texts' ids, each text's followed by ``end_id``, into rows of ``capacity`` ids.

    Returns a row per sequence: sequence_id; doc_ids, starts, lengths (its pieces
    in order: document, its ids before the piece, ids of the piece); cu_seqlens
    (0 and the running sums of lengths); n_tokens; input_ids (the padded row of
    the id matrix, unsigned little-endian of ``id_bytes`` bytes); position_ids
    (unsigned of the same width: 0, 1, ... from each segment's start again, and
    over the padding too).  One row of the matrix per sequence, so a table of
    them is the packed matrix in parts.

    A null or empty text is its end id alone.  Ids of any type are carried as they
    are.  Repeated rows and ids are packed like others, equal lengths in the order
    of their input; a null id stays null, further columns, whatever their names,
    are ignored, an empty table gives no rows.  An id or position that
    ``id_bytes`` can't hold is an error.
    """
    path = tokenizer or tokenizer_path()
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    most = 1 << (8 * id_bytes)
    if max(end_id + 1, pad_id + 1, capacity) > most:
        raise ValueError(f"end_id, pad_id and positions must fit in {id_bytes} bytes")
    source = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    schema = StructType(
        [StructField("sequence_id", LongType()), StructField("doc_ids", ArrayType(source.schema["id"].dataType))]
        + list(StructType.fromDDL("starts array<long>, lengths array<int>, cu_seqlens array<int>, n_tokens int, input_ids binary, position_ids binary"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pid, count, pool = BatchTokenizer(path, end_id), TaskContext.get().partitionId(), 0, None

        def emit(sequences: list[list[int]]) -> Iterator[pa.RecordBatch]:
            nonlocal count
            for at in range(0, len(sequences), ROWS):
                part = sequences[at : at + ROWS]
                yield _rows(pool, part, (pid << 33) + count, capacity, pad_id, kind, schema.names)
                count += len(part)

        for batch in batches_of(batches, "text", block_bytes):
            if not batch.num_rows:
                continue
            ids, n = words.encode(batch.column("text"))
            if int(ids.max()) >= most:
                raise ValueError(f"id {ids.max()} doesn't fit in {id_bytes} bytes")
            pool = pool or _Pool(batch.column("id").slice(0, 0))
            pool.add(batch.column("id"), ids, n, capacity)
            whole = np.flatnonzero(pool.length == capacity)
            part = np.flatnonzero(pool.length < capacity)
            bins = [part[b].tolist() for b in best_fit_decreasing(pool.length[part], capacity)]
            used = np.fromiter((pool.length[b].sum() for b in bins), np.int64, len(bins))
            loose = np.argsort(used, kind="stable")[:REOPEN]
            opened = set(loose[used[loose] < 0.95 * capacity].tolist())
            yield from emit([[w] for w in whole.tolist()] + [b for k, b in enumerate(bins) if k not in opened])
            pool.only(np.array([i for k in sorted(opened) for i in bins[k]], np.int64))
        if pool is not None and len(pool.length):
            yield from emit(best_fit_decreasing(pool.length, capacity))

    return map_batches(source, run, schema, keeps=True)


def op1_token_packing(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, 2048 ids a sequence; a row of the packed matrix per sequence."""
    return pack_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
