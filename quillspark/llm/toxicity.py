"""Toxicity grades by cumulative-link (proportional-odds) ordinal regression on sparse text features.

P(grade >= k) = sigmoid(w . x - theta_k): one weight vector for all thresholds,
theta ascending.  Features are whole words and word beginnings of 4, 5 and 6
letters that go with graded documents in the labelled sample; a document's value
for one is 1 + ln(count), 0 where it hasn't got it.  The output is the expected severity, the sum over k of
P(grade >= k).

Fitting uses a bounded, hash-chosen sample of labelled rows: association counts
are summed in Spark, at most ``MAX_FEATURES`` of them and the sample's few
remaining features per row come to the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of, kept, kept_fields, map_batches, named, refuse_clashes, stored, with_fields

#: Bounds of the fit: labelled rows that are read (about; by their ids' hash), features, bytes of a sampled text.
SAMPLE_ROWS, MAX_FEATURES, SAMPLE_BYTES = 20_000, 4096, 200_000
#: Graded documents that a feature needs at least.
SUPPORT = 4
LEVELS = 3
BATCH_BYTES = 4 << 20
CACHE_WORDS = 400_000
_WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    """Of a lower-cased word: itself and its beginnings."""
    return [f"={word}"] + [f"^{word[:k]}" for k in (4, 5, 6) if len(word) >= k]


def _chunk_words(chunk: str) -> list[str]:
    core = chunk.strip(".,!?;:\"'()").lower()
    return [core] if core.isalpha() else _WORD.findall(core)


class Featurizer:
    """Sparse features of whole texts; the words of a batch are looked at once each."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary, self.known = vocabulary, {}

    def _of(self, chunk: str) -> tuple[int, ...]:
        found = self.known.get(chunk)
        if found is None:
            get = self.vocabulary.get
            found = tuple({i for w in _chunk_words(chunk) for f in features_of(w) if (i := get(f)) is not None})
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[chunk] = found
        return found

    def __call__(self, column: pa.Array) -> list[tuple[int, int, dict[int, int]]]:
        """Per text: white-space chunks, chunks with a feature, count of each feature."""
        pieces = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.large_string()), ""))
        per = np.asarray(pc.list_value_length(pieces)).astype(np.int64)
        flat = pieces.flatten()
        blank = int(pc.sum(pc.equal(pc.utf8_length(flat), 0)).as_py() or 0) if len(flat) else 0
        words = flat.dictionary_encode()
        found = [self._of(c) for c in words.dictionary.to_pylist()]
        index = np.asarray(words.indices)
        has = np.fromiter(map(bool, found), bool, len(found))
        ends = np.cumsum(per)
        out = [(int(n), 0, {}) for n in per]
        if blank:
            empty = np.flatnonzero(np.asarray(pc.equal(words.dictionary, "")))
            doc = np.searchsorted(ends, np.flatnonzero(np.isin(index, empty)), side="right")
            for d, k in zip(*np.unique(doc, return_counts=True), strict=True):
                out[d] = (out[d][0] - int(k), 0, {})
        at = np.flatnonzero(has[index]) if len(index) else np.zeros(0, np.int64)
        doc = np.searchsorted(ends, at, side="right")
        for d, w in zip(doc.tolist(), index[at].tolist(), strict=True):
            n, hits, counts = out[d]
            for f in found[w]:
                counts[f] = counts.get(f, 0) + 1
            out[d] = (n, hits + 1, counts)
        return out


def _values(counts: dict[int, int]) -> tuple[list[int], list[float]]:
    return list(counts), (1 + np.log(np.fromiter(counts.values(), float, len(counts)))).tolist()


@dataclass
class OrdinalModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade from 1 on
    cut: float = 0.5  # least P(grade >= 1) of what counts as toxic

    def tail(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) [row, k]."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


def best_cut(tail: np.ndarray, positive: np.ndarray) -> float:
    """The probability that parts the sample with the best F1, the geometric mean of the rows on both sides of it; at most 1/2."""
    order = np.argsort(-tail, kind="stable")
    p, hit = tail[order], np.cumsum(positive[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + positive.sum())
    f1[:-1][p[:-1] == p[1:]] = 0  # equal rows stay together
    k = int(np.argmax(f1))
    below = p[k + 1] if k + 1 < len(p) else 0.0
    return float(min(0.5, np.sqrt(p[k] * max(below, 1e-9))))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, steps: int = 1000, l2: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights, none below 0, and ascending thresholds of highest likelihood from sparse rows (row, column, value) and grades 0..K."""
    n, k = len(grades), int(grades.max(initial=1))
    w, base, gaps = np.zeros(n_features), 1.0, np.zeros(max(k - 1, 0))
    params = np.concatenate([w, [base], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, theta = params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(np.exp(params[n_features + 1 :]))])
        s = np.bincount(rows, values * w[columns], n)
        cdf = 1 / (1 + np.exp(np.clip(s[:, None] - theta[None, :], -500, 500)))  # P(grade < k)
        bounds = np.concatenate([np.zeros((n, 1)), cdf, np.ones((n, 1))], axis=1)
        low, high = bounds[np.arange(n), grades], bounds[np.arange(n), grades + 1]
        p = np.maximum(high - low, 1e-12)
        ds = low + high - 1  # of the log-likelihood by the score
        dtheta = np.zeros(k)
        np.add.at(dtheta, grades[grades < k], (high * (1 - high) / p)[grades < k])
        np.add.at(dtheta, grades[grades > 0] - 1, -(low * (1 - low) / p)[grades > 0])
        above = np.cumsum(dtheta[::-1])[::-1]
        grad = np.concatenate([np.bincount(columns, values * ds[rows], n_features) / n - l2 * w, [above[0] / n], above[1:] * np.exp(params[n_features + 1 :]) / n])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        params[:n_features] = np.maximum(params[:n_features], 0)
    return params[:n_features], params[n_features] + np.concatenate([[0], np.cumsum(np.exp(params[n_features + 1 :]))])


def _hashed_with(seed: int):
    return lambda g: F.xxhash64(F.lit(seed), g)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "toxic", levels: int = LEVELS, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel | None:
    """None if the labelled sample has no graded or no clean row, or nothing sets them apart.

    Labels of 0 and 1 only are graded further: the rows of 1 are cut into
    ``levels`` grades of about equal size by how many of their words carry an
    associated feature.  What sets those grades apart is then not supervised but read
    off the texts; P(grade >= 1) alone rests on the labels.  Null grades, ids and texts are passed over; of several
    labels for an id the highest counts, and of copies and near copies one row.
    """
    known = labels.where(labels[grade_col].isNotNull() & labels[id_col].isNotNull()).groupBy(labels[id_col].cast("string").alias("id")).agg(F.max(labels[grade_col].cast("int")).alias("grade"))
    total = known.count()
    if not total:
        return None
    space = 1 << 40
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(space)) < min(space, sample_rows * space // total))  # about sample_rows rows
    texts = df.where(df[text_col].isNotNull() & (F.octet_length(df[text_col]) <= SAMPLE_BYTES)).select(df[id_col].cast("string").alias("id"), df[text_col].cast("string").alias("text"))
    # Near copies would vouch for each other's rare words: of rows whose two least shingle hashes agree one stays.
    words = F.split(F.lower("text"), "\\s+")
    grams = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.slice("w", i, 3))).otherwise(F.array("w"))
    least = [F.array_min(F.transform("g", _hashed_with(seed))) for seed in (1, 2)]
    keyed = texts.join(F.broadcast(chosen), "id").withColumn("w", words).withColumn("g", grams).select("id", "text", "grade", F.struct(*least).alias("key"))
    sample = keyed.groupBy("key").agg(F.min_by(F.struct("id", "text", "grade"), "id").alias("row")).select("row.*")
    sample = stored(sample, "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "text", BATCH_BYTES):
            counts: tuple[Counter, Counter] = Counter(), Counter()
            cached: dict[str, list[str]] = {}
            for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist(), strict=True):
                own: set[str] = set()
                for chunk in set(text.split()):
                    if chunk not in cached:
                        cached[chunk] = [f for w in _chunk_words(chunk) for f in features_of(w)]
                    own.update(cached[chunk])
                counts[grade > 0].update(own)
                counts[grade > 0][""] += 1
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict({"f": names, "pos": [counts[1][x] for x in names], "neg": [counts[0][x] for x in names]}, schema=pa.schema([("f", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())]))

    summed = map_batches(sample, count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where("pos >= 1 OR f = ''")
    summed = stored(summed.where((F.col("f") == "") | (F.col("pos") >= SUPPORT)), "features")
    whole = summed.where("f = ''").first()
    tried = summed.count()
    if whole is None or not whole["pos"] or not whole["neg"]:
        return None
    # Chernoff's bound on the chance of so many graded documents among those with the feature, against the number of features tried.
    rate, size = whole["pos"] / (whole["pos"] + whole["neg"]), F.col("pos") + F.col("neg")
    other = F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (size * (1 - rate)))).otherwise(0.0)
    evidence = F.col("pos") * F.log(F.col("pos") / (size * rate)) + other
    best = summed.where("f <> ''").withColumn("z", evidence).where((F.col("pos") > rate * size) & (F.col("z") >= float(np.log(tried)))).orderBy(F.desc("z"), "f").limit(MAX_FEATURES).collect()
    vocabulary = {r["f"]: i for i, r in enumerate(best)}
    if not vocabulary:
        return None

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer(vocabulary)
        for batch in batches_of(batches, "text", BATCH_BYTES):
            found = featurize(batch.column("text"))
            pairs = [_values(counts) for _, _, counts in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("grade"), pa.array([h for _, h, _ in found], pa.int64()), pa.array([p[0] for p in pairs], pa.list_(pa.int32())), pa.array([p[1] for p in pairs], pa.list_(pa.float64()))],
                names=["id", "grade", "hits", "features", "amounts"],
            )

    rows = map_batches(sample, sparse, "id string, grade int, hits long, features array<int>, amounts array<double>").orderBy("id").limit(4 * sample_rows).collect()
    grades = np.array([max(0, r["grade"]) for r in rows])
    if grades.max() == 1 and levels > 1:
        graded = np.flatnonzero(grades)
        hits = np.array([rows[i]["hits"] for i in graded])
        cuts = np.quantile(hits, [j / levels for j in range(1, levels)])
        grades[graded] = 1 + np.searchsorted(cuts, hits, side="left")
    sizes = [len(r["features"]) for r in rows]
    columns = np.fromiter((f for r in rows for f in r["features"]), np.int64, sum(sizes))
    amounts = np.fromiter((a for r in rows for a in r["amounts"]), float, sum(sizes))
    row = np.repeat(np.arange(len(rows)), sizes)
    model = OrdinalModel(vocabulary, *fit_ordinal(row, columns, amounts, grades, len(vocabulary)))
    tail = model.tail(np.bincount(row, amounts * model.weights[columns], len(rows)))
    model.cut = best_cut(tail[:, 0], grades > 0)
    return model


def grade(df: DataFrame, model: OrdinalModel | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns ``keep``, severity (expected grade), p_toxic (P(grade >= 1)), grade (the highest k with P(grade >= k) >= 1/2; 1 at least where P(grade >= 1) reaches the fitted cut) and toxic (grade >= 1).

    Null, empty and featureless texts get the severity of no feature; without a
    model all is 0.  Texts of any length count whole.  Repeated rows each get theirs;
    empty tables give no rows.  Columns that aren't kept may have any name; one of
    ``keep`` that is named like an output is an error.
    """
    spark = df.sparkSession
    keep = [] if keep is None else keep
    refuse_clashes(keep, "severity", "p_toxic", "grade", "toxic")
    source = df.select(*kept(df, keep), df[text_col].cast("string").alias("__text"))
    fields = kept_fields(source)
    shared = spark.sparkContext.broadcast((model.vocabulary, model.weights, model.thresholds, model.cut) if model else None)  # at most MAX_FEATURES entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OrdinalModel(*shared.value) if shared.value else None
        featurize = Featurizer(own.vocabulary) if own else None
        for batch in batches_of(batches, "__text", BATCH_BYTES):
            severity, chance, level = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int32)
            if own and batch.num_rows:
                scores = []
                for _, _, counts in featurize(batch.column("__text")):
                    f, x = _values(counts)
                    scores.append(float(own.weights[f] @ np.array(x)) if f else 0.0)
                tail = own.tail(np.array(scores))
                severity, chance, level = tail.sum(axis=1), tail[:, 0], np.maximum((tail >= 0.5).sum(axis=1), tail[:, 0] >= own.cut).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(severity), pa.array(chance), pa.array(level), pa.array(level > 0)], names=[*(f.name for f in fields), "severity", "p_toxic", "grade", "toxic"])

    return named(map_batches(source, run, with_fields(fields, "severity double, p_toxic double, grade int, toxic boolean")), keep, "severity", "p_toxic", "grade", "toxic")


def op10_ordinal_toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: the severity of every document, learned from the labels."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return grade(docs, fit(docs, labels), keep=["doc_id"])
