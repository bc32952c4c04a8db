"""Language identification by prediction by partial matching (PPM).

For every language a context tree over bytes holds, for contexts of up to
``order`` bytes, how often each byte followed.  A byte's probability is taken at
the longest context that has seen it; every longer context that hasn't is left
by its escape (PPM-C: c / (n + q), escape q / (n + q), n symbols seen, q of them
different; at the end 1 / 256).  The counts are frozen after training, so the
code length of a text under a language is the sum of its bytes' lengths, and
that language is predicted whose code is shortest.

The trees are compiled: per order, a hash table from (context, byte) to its code
length in each language.  Scoring a batch is one look-up per byte; only grams
that no language has seen fall back to the next shorter context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of, kept, kept_fields, map_batches, named, refuse_clashes, utf8_buffer, with_fields

#: Bound of the training sample: documents per language, and bytes of one that are read.
SAMPLE_DOCS, SAMPLE_DOC_BYTES = 400, 20_000
#: Values of the language column from which on it is an error: it can't be one of languages then. All below are learned.
MAX_LANGUAGES = 1000
ORDER = 4
BATCH_BYTES = 2 << 20


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n-byte grams of a buffer as integers, first byte lowest."""
    words = np.ndarray((max(0, len(data) - n + 1),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
    return words & np.uint64((1 << (8 * n)) - 1)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Table:
    """Open-addressing hash table from gram to a row of ``values``; look-ups are whole arrays at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.row = np.zeros(1 << self.bits, np.int32)
        self.values = values
        left, at, self.probes = np.arange(len(keys)), _slots(keys, self.bits), 0
        while len(left):
            free = self.keys[at] == np.uint64(2**64 - 1)
            place, first = np.unique(at[free], return_index=True)
            taken = left[free][first]
            self.keys[place], self.row[place] = keys[taken], taken
            stay = np.ones(len(left), bool)
            stay[np.flatnonzero(free)[first]] = False
            left, at = left[stay], (at[stay] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows, -1 where a key isn't there."""
        at = _slots(keys, self.bits)
        hit = self.keys[at] == keys
        rows = np.where(hit, self.row[at], -1)
        miss, mask = np.flatnonzero(~hit), (1 << self.bits) - 1
        at = at[miss]
        for _ in range(self.probes - 1):
            at = (at + 1) & mask
            found = self.keys[at]
            hit = found == keys[miss]
            rows[miss[hit]] = self.row[at[hit]]
            stay = ~hit & (found != np.uint64(2**64 - 1))
            miss, at = miss[stay], at[stay]
            if not len(miss):
                break
        return rows


@dataclass
class Model:
    languages: list[str]
    order: int
    tables: list[Table]  # by order d: gram of d + 1 bytes -> code length in bits per language
    escapes: list[Table]  # by order d: context of d bytes -> bits of the escape per language, 0 where unseen

    def bits(self, grams: np.ndarray, order: int | None = None) -> np.ndarray:
        """Code lengths [gram, language]; a gram has ``order`` context bytes and the coded byte, highest, last."""
        d = self.order if order is None else order
        if d < 0:
            return np.full((len(grams), len(self.languages)), 8.0, np.float32)
        rows = self.tables[d].find(grams)
        out = self.tables[d].values[rows]
        miss = np.flatnonzero(rows < 0)
        if len(miss):
            g = grams[miss]
            out[miss] = self.bits(g >> np.uint64(8), d - 1)
            context = self.escapes[d].find(g & np.uint64((1 << (8 * d)) - 1))
            out[miss] += np.where(context[:, None] >= 0, self.escapes[d].values[context], 0)
        return out


def train(texts: dict[str, list[bytes]], order: int = ORDER) -> Model:
    """texts: per language, its sample."""
    languages = sorted(texts)
    data = {k: [np.frombuffer(t, np.uint8) for t in v] for k, v in texts.items()}
    tables, escapes, lower = [], [], None
    for d in range(order + 1):
        counted = {}
        for k in languages:
            parts = [_grams(t, d + 1) for t in data[k]]
            counted[k] = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
        keys = np.unique(np.concatenate([c[0] for c in counted.values()]))
        mask = np.uint64((1 << (8 * d)) - 1)
        contexts = np.unique(keys & mask)
        cost, leave = np.zeros((len(keys), len(languages)), np.float32), np.zeros((len(contexts), len(languages)), np.float32)
        shorter = np.full((len(keys), len(languages)), 8.0, np.float32) if lower is None else lower.bits(keys >> np.uint64(8), d - 1)
        of = np.searchsorted(contexts, keys & mask)
        for j, k in enumerate(languages):
            own, n = counted[k]
            at = np.searchsorted(contexts, own & mask)
            total, kinds = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
            with np.errstate(divide="ignore", invalid="ignore"):
                leave[:, j] = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0)
            cost[:, j] = shorter[:, j] + leave[of, j]
            cost[np.searchsorted(keys, own), j] = np.log2((total + kinds)[at] / n)
        tables.append(Table(keys, cost))
        escapes.append(Table(contexts, leave))
        lower = Model(languages, d, tables, escapes)
    return Model(languages, order, tables, escapes)


def code_lengths(model: Model, column: pa.Array) -> np.ndarray:
    """Bits [text, language] of whole texts; a text's first bytes have the shorter contexts that there are."""
    data, offsets = utf8_buffer(column)
    n, d = len(column), model.order
    out = np.zeros((n, len(model.languages)))
    if not len(data):
        return out
    lengths = np.diff(offsets)
    step = 1 << 20
    for at in range(0, max(0, len(data) - d), step):  # grams of a long buffer, a stretch at a time
        bits = model.bits(_grams(data[at : at + step + d], d + 1))
        place = at + d + np.arange(len(bits))
        doc = np.searchsorted(offsets, place, side="right") - 1
        bits[place - offsets[doc] < d] = 0  # those contexts would reach into the text before
        heads = np.flatnonzero(np.diff(doc, prepend=-1))
        np.add.at(out, doc[heads], np.add.reduceat(bits, heads, axis=0, dtype=np.float64))
    for k in range(d):
        has = np.flatnonzero(lengths > k)
        grams = np.zeros(len(has), np.uint64)
        for i in range(k + 1):
            grams |= data[offsets[has] + i].astype(np.uint64) << np.uint64(8 * i)
        out[has] += model.bits(grams, k)
    return out


def training_rows(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def sample(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, list[bytes]]:
    """At most ``SAMPLE_DOCS`` documents of each language, the first by a hash of their id, ``SAMPLE_DOC_BYTES`` of each; a bounded collect.

    Only ids are ranked; the few texts are then read.  Of rows that share id and
    language one is taken.  Every language with a text that has a letter is learned.
    """
    usable = df.select(df[id_col].cast("string").alias("id"), df[lang_col].cast("string").alias("lang"), df[text_col].cast("string").alias("text")).where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    if not counts:
        return {}
    # About four times the wanted ids of each language pass by their hash, however many rows there are; only those are ranked.
    space = 1 << 40
    hashed = F.pmod(F.xxhash64("id"), F.lit(space))
    share = F.broadcast(df.sparkSession.createDataFrame([(k, min(space, 4 * SAMPLE_DOCS * space // n)) for k, n in counts.items()], "lang string, share long"))
    few = usable.select("id", "lang").join(share, "lang").where(hashed < F.col("share")).select("id", "lang").distinct()
    top = few.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy(hashed, "id"))).where(F.col("k") <= SAMPLE_DOCS).select("id", "lang")
    part = F.substring(F.col("text").cast("binary"), 1, SAMPLE_DOC_BYTES)
    texts = usable.join(F.broadcast(top), ["id", "lang"]).groupBy("id", "lang").agg(F.min(part).alias("text"))
    out: dict[str, list[bytes]] = {}
    for r in texts.collect():
        out.setdefault(r["lang"], []).append(bytes(r["text"]))
    return {k: sorted(v) for k, v in out.items()}


def identify(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: ``id_col``, lang_pred, score, bits_per_byte and the columns ``keep`` (untouched).

    score is the predicted language's share of 2 ** -(code length), all languages
    being equally likely beforehand.  ``und``, score 0, where the text is null,
    empty or without a letter, and where no language was learned.  On a tie the
    first language by name wins.  Texts of any length are coded whole, a stretch at a
    time.  Repeated rows each give a row; empty tables give none.  Columns that
    aren't kept may have any name; one of ``keep`` that is named like an output is an
    error.
    """
    keep = [id_col, *[c for c in keep or [] if c != id_col]]
    refuse_clashes(keep, "lang_pred", "score", "bits_per_byte")
    source = df.select(*kept(df, keep), df[text_col].cast("string").alias("__text"), F.coalesce(df[text_col].rlike("\\p{L}"), F.lit(False)).alias("__letter"))
    fields = kept_fields(source)
    schema = with_fields(fields, "lang_pred string, score double, bits_per_byte double")
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # its size is bounded by the sample's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches_of(batches, "__text", BATCH_BYTES):
            n = batch.num_rows
            letter = np.asarray(batch.column("__letter"))
            pred, score, rate = np.array(["und"] * n, object), np.zeros(n), np.zeros(n)
            if model is not None and n:
                bits = code_lengths(model, batch.column("__text"))
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                size = np.asarray(pc.fill_null(pc.binary_length(batch.column("__text")), 0))
                pred = np.where(letter, np.array(model.languages, object)[best], "und")
                score = np.where(letter, share, 0.0)
                rate = np.where(letter, least / np.maximum(size, 1), 0.0)
            columns = [batch.column(f.name) for f in fields] + [pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields] + ["lang_pred", "score", "bits_per_byte"])

    return named(map_batches(source, run, schema), keep, "lang_pred", "score", "bits_per_byte")


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER) -> Model | None:
    """None if there is no labelled row to learn from."""
    texts = sample(df, id_col, text_col, lang_col)
    return train(texts, order) if texts else None


def op4_ppm_language(spark, sf_dir: str) -> DataFrame:
    """Query: the language of every document, learned from the rows that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(training_rows(docs["doc_id"])))
    out = identify(docs, model)
    return out.select("doc_id", F.coalesce(~training_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")
