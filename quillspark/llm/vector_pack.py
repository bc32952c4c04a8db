"""Vector bin packing of instruction data under limits on tokens, segments and loss-bearing tokens.

An example asks for a vector (tokens, one segment, loss-bearing tokens).  An open
sequence takes, of the examples that fit, the one whose demand has the largest
dot product with what is left of its limits, each dimension divided by its
limit.  Where none fits, the best one is cut and its rest stays in the pool.

Every task packs its own input in blocks of bounded size and carries what
doesn't fill a sequence over to the next block, so no text is shuffled and no
task holds more than a block.  Sequence ids hold the partition number in their
upper bits; an input partition that is computed again gives the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quillspark.llm.common import batches_of, map_batches
from quillspark.llm.tokens import BatchTokenizer, tokenizer_path

#: Bytes of text that are tokenized and packed at a time.
BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


def _power_of_two(n: int) -> int:
    return 1 << (int(n).bit_length() - 1)


class Packer:
    """The pool of one task. Sequences come out as lists of (example, start, length, loss-bearing tokens)."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.total = 0
        self.example = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.loss_from = np.zeros(0, np.int64)

    def add(self, example: np.ndarray, start: np.ndarray, length: np.ndarray, loss_from: np.ndarray) -> None:
        """loss_from: the first loss-bearing token of the whole example, before any cut."""
        self.example = np.concatenate([self.example, example])
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, length])
        self.loss_from = np.concatenate([self.loss_from, loss_from])
        self.total = int(self.length.sum())

    def sequences(self, last: bool) -> Iterator[list[tuple[int, int, int, int]]]:
        cap = self.limits.tokens
        while self.total >= cap or (last and self.total):
            yield self._fill(cap if self.total >= cap else _power_of_two(self.total))
        used = self.length > 0
        self.example, self.start, self.length, self.loss_from = self.example[used], self.start[used], self.length[used], self.loss_from[used]

    def _fill(self, cap: int) -> list[tuple[int, int, int, int]]:
        limits, out = self.limits, []
        tokens, segments, loss = cap, limits.segments, limits.loss_tokens
        wt, ws, wl = 1 / limits.tokens**2, 1 / limits.segments**2, 1 / limits.loss_tokens**2
        while tokens and segments:
            own = np.clip(self.start + self.length - np.maximum(self.start, self.loss_from), 0, None)
            score = self.length * (wt * tokens) + ws * segments + own * (wl * loss)
            fits = (self.length > 0) & (self.length <= tokens) & (own <= loss)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                take = int(self.length[i])
            else:
                room = np.where(self.length > 0, np.minimum(np.minimum(self.length, tokens), np.maximum(self.loss_from - self.start, 0) + loss), 0)
                i = int(np.argmax(room))
                take = int(room[i])
                if take == 0:
                    break
            start = int(self.start[i])
            cost = max(0, start + take - max(start, int(self.loss_from[i])))
            out.append((i, start, take, cost))
            self.start[i] += take
            self.length[i] -= take
            tokens, segments, loss = tokens - take, segments - 1, loss - cost
        over = cap - tokens - _power_of_two(cap - tokens) if tokens else 0
        while over:  # another limit binds: cut back to a length that needs no padding
            i, start, take, cost = out.pop()
            back = min(over, take)
            self.start[i] -= back
            self.length[i] += back
            if back < take:
                out.append((i, start, take - back, max(0, start + take - back - max(start, int(self.loss_from[i])))))
            over -= back
        self.total -= sum(x[2] for x in out)
        return [(int(self.example[i]), start, take, cost) for i, start, take, cost in out]


def pack_examples(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),
    tokenizer: str | None = None,
    end_id: int = 1,
    with_ids: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pack every row into sequences of at most ``limits.tokens`` tokens.

    The prompt's ids (if ``prompt_col`` is given) come first and bear no loss;
    the text's ids and ``end_id`` follow and do.  Returns a row per piece:
    ``id_col``, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id,
    offset, sequence_tokens, padded_to and, with ``with_ids``, ids (unsigned
    32-bit little-endian).  ``padded_to`` is the token limit, or the sequence's
    own length where that is a power of two; sequences end at such lengths, so
    padding arises only where a limit leaves no other way.

    A null text or prompt is empty: such a row is its end id alone.  Ids of any
    type are carried as they are, a null id stays null.  Repeated rows and
    repeated ids are packed like any others; of examples with equal scores the one
    that came first is placed first.  Further columns, whatever their names, are
    ignored and an empty table gives no rows.  Long texts are cut into pieces;
    each id lies in exactly one.
    """
    path = tokenizer or tokenizer_path()
    source = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"), *([df[prompt_col].cast("string").alias("prompt")] if prompt_col else []))
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset", "sequence_tokens", "padded_to"]
    schema = StructType([StructField("id", source.schema["id"].dataType), *(StructField(n, LongType()) for n in numbers), *([StructField("ids", BinaryType())] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = BatchTokenizer(path, end_id)
        prompts = BatchTokenizer(path, None) if prompt_col else None
        packer, pid, count = Packer(limits), TaskContext.get().partitionId(), 0
        docs: pa.Array | None = None  # of the examples that pieces may still come from
        ids = np.zeros(0, "<u4")
        total, base = np.zeros(0, np.int64), np.zeros(0, np.int64)  # base: an example's place in ids

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal count
            sequences = list(packer.sequences(last))
            sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
            if not len(sizes):
                return
            example, start, length, cost = np.array([p for s in sequences for p in s], np.int64).T
            firsts = np.cumsum(sizes) - sizes
            used = np.add.reduceat(length, firsts)
            padded = np.where(used & (used - 1) == 0, used, limits.tokens)
            ends = np.cumsum(length)
            at = base[example] + start
            parts = [ids[a : a + n].tobytes() for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            crc = np.fromiter(map(zlib.crc32, parts), np.int64, len(parts))
            of = np.repeat(np.arange(len(sizes)), sizes)
            values = (start, length, crc, total[example], cost, (pid << 33) + count + of, ends - length - (ends - length)[firsts][of], used[of], padded[of])
            columns = [docs.take(pa.array(example)), *map(pa.array, values), *([pa.array(parts, pa.binary())] if with_ids else [])]
            count += len(sizes)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches_of(batches, "text", block_bytes):
            if not batch.num_rows:
                continue
            new, n = words.encode(batch.column("text"))
            first = np.zeros(len(n), np.int64)
            if prompts:
                own, first = prompts.encode(batch.column("prompt"))
                both = np.empty(len(new) + len(own), new.dtype)
                ends = np.cumsum(n + first)
                of_prompt = np.arange(len(both)) - np.repeat(ends - n - first, n + first) < np.repeat(first, n + first)
                both[of_prompt], both[~of_prompt] = own, new
                new, n = both, n + first
            # What is left over of earlier blocks moves to the front.
            left, gone = packer.example, packer.length
            gone_ends = np.cumsum(gone)
            kept = ids[np.repeat(base[left] + packer.start - (gone_ends - gone), gone) + np.arange(int(gone.sum()))]
            docs = batch.column("id") if docs is None else pa.concat_arrays([docs.take(pa.array(left)), batch.column("id")])
            total = np.concatenate([total[left], n])
            base = np.concatenate([gone_ends - gone - packer.start, len(kept) + np.cumsum(n) - n])
            ids = np.concatenate([kept, new]).astype("<u4")
            packer.example = np.arange(len(left))
            packer.add(np.arange(len(left), len(left) + len(n)), np.zeros(len(n), np.int64), n, first)
            yield from emit(False)
        if packer.total:
            yield from emit(True)

    out = map_batches(source, run, schema, keeps=True)
    return out.withColumnRenamed("id", id_col)


def op5_vector_packing(spark, sf_dir: str) -> DataFrame:
    """Query: all documents, 2048 tokens a sequence."""
    packed = pack_examples(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", F.col("padded_to"))
