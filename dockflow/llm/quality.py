"""Operator 1: quality classifier, a hashed word n-gram logistic regression trained by follow-the-regularised-leader.

Features are hashes of single words and pairs of words, and of one, two and three word shapes (case, digits, symbols,
length, sameness with the word before), each over the root of the number of words.  A text's score is one sparse dot product, taken
with array operations over a whole batch.  Weights are one array of 2**18 floats, whatever the corpus.

A head's ``Design`` says which features it has. Besides the n-grams there is ``PRESENCE``: whether a word occurs at all, with a
penalty that leaves weights to the few words that tell (one such word tells as much in a long text as in a short one).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from . import store

SLOTS = 1 << 18
#: Labelled documents that the classifier is fitted on, at most, and passes over them, at least.
TRAINING_DOCS = 8_000
PASSES = 3
#: Updates of a head, at least: a small sample is passed over more often.
UPDATES = 24_000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
SCALE = 2.0
THRESHOLD = 0.3

#: Byte classes: white space, letters and digits (all bytes of non-ASCII characters), other symbols.
_KIND = np.full(256, 2, np.uint8)
_KIND[K.IS_SPACE] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1
_C = [K.U64(0x8F14E45FCEEA167B), K.U64(0xC2B2AE3D27D4EB4F), K.U64(0x165667B19E3779F9)]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot of every feature of a batch, its row, and the number of words of each row."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change |= edge
    cut = np.flatnonzero(change)
    starts, ends = cut[:-1], cut[1:]
    word = kind[starts] > 0
    starts, ends = starts[word], ends[word]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    h = K.range_hashes(K.LOWER[data], starts, ends)
    first = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(n), np.diff(first))

    def total(table):
        s = np.concatenate([[0], np.cumsum(table[data])])
        return s[ends] - s[starts]

    length = ends - starts
    upper, digit = total(_UPPER), total(_DIGIT)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    two = np.zeros(len(h), bool)
    two[2:] = (h[2:] == h[:-2]) & (rows[2:] == rows[:-2])
    shape = (kind[starts] == 2).astype(np.int64)
    shape = shape * 3 + np.where(upper == 0, 0, np.where(upper == length, 2, 1))
    shape = shape * 3 + np.where(digit == 0, 0, np.where(digit == length, 2, 1))
    shape = shape * 6 + np.minimum(np.log2(length).astype(np.int64), 5)
    shape = K.mix((shape * 4 + same * 2 + two).astype(np.uint64) + _C[2])
    out, at = [], []
    for stream in (h, shape):
        out.append(stream)
        at.append(rows)
        ok = rows[1:] == rows[:-1]
        pair = K.mix(stream[:-1] * _C[0] + stream[1:] * _C[1])
        out.append(pair[ok])
        at.append(rows[1:][ok])
    ok = rows[2:] == rows[:-2]
    out.append(K.mix(shape[:-2] * _C[0] + shape[1:-1] * _C[1] + shape[2:] * _C[2])[ok])
    at.append(rows[2:][ok])
    return (np.concatenate(out) >> K.U64(64 - 18)).astype(np.int64), np.concatenate(at), np.diff(first)


def present_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot of every word of letters and digits, its row, and the number of words of each row."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    kind = _KIND[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    cut = np.flatnonzero(change)
    word = kind[cut[:-1]] == 1
    starts, ends = cut[:-1][word], cut[1:][word]
    rows = np.searchsorted(offsets, starts, "right") - 1
    return (K.range_hashes(K.LOWER[data], starts, ends) >> K.U64(64 - 18)).astype(np.int64), rows, np.bincount(rows, minlength=n)


@dataclass(frozen=True)
class Design:
    """Features of a head; ``present``: a feature counts once a text, else as often as it occurs over the root of the words.
    Step size and penalty of the fit, passes at least, and updates at least (a small sample is passed over more often)."""

    features: Callable
    present: bool
    alpha: float
    l1: float
    passes: int
    updates: int

    def values(self, times: np.ndarray, size: int) -> np.ndarray:
        return np.ones(len(times)) if self.present else times * (SCALE / max(1, size) ** 0.5)

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(n)) / self.alpha + L2))

    def sums(self, slot: np.ndarray, row: np.ndarray, size: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Dot products of all rows of a batch, without the bias."""
        if self.present:
            told = w[slot] != 0  # few words have a weight
            slot, row = K.distinct(slot[told], row[told])
            return np.bincount(row, w[slot], len(size))
        return np.bincount(row, w[slot], len(size)) * (SCALE / np.sqrt(np.maximum(1, size)))


NGRAMS = Design(features, False, ALPHA, L1, PASSES, UPDATES)
PRESENCE = Design(present_words, True, 0.3, 8.0, 8, UPDATES)


def fit(texts_and_labels: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], designs: tuple[Design, ...] = (NGRAMS,)) -> np.ndarray:
    """Weights (heads x slots, the bias last) by the per-coordinate follow-the-regularised-leader rule, over batches of
    (data, offsets, labels: rows x heads). A label that is not a number doesn't move its head."""
    examples: dict[Callable, list] = {d.features: [] for d in designs}
    truth = []
    for data, offsets, labels in texts_and_labels:
        truth.append(labels)
        for lo, hi in K.slices(offsets):
            for features_of, kept in examples.items():
                slot, row, size = features_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                turn = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[turn], np.arange(hi - lo + 1))
                for r in range(hi - lo):
                    ids, times = np.unique(slot[turn[cuts[r] : cuts[r + 1]]], return_counts=True)
                    kept.append((np.append(ids, SLOTS).astype(np.int32), times, int(size[r])))
    labels = np.concatenate(truth) if truth else np.zeros((0, len(designs)))
    out = np.zeros((len(designs), SLOTS + 1), np.float32)
    for head, design in enumerate(designs):
        told = [(ids, np.append(design.values(times, size), 1.0).astype(np.float32), y) for (ids, times, size), y in zip(examples[design.features], labels[:, head], strict=True) if not np.isnan(y)]
        z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
        for _ in range(min(40, max(design.passes, design.updates // max(1, len(labels))))):
            for ids, x, y in told:
                zi, ni = z[ids], n[ids]
                w = design.weights(zi, ni)
                g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
                up = ni + g * g
                z[ids] = zi + g - (np.sqrt(up) - np.sqrt(ni)) / design.alpha * w
                n[ids] = up
        out[head] = design.weights(z, n)
    return out


def train(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...] = ("quality",), designs: tuple[Design, ...] = (NGRAMS,), limit: int = TRAINING_DOCS) -> np.ndarray:
    """Fit one head for each label column on at most ``limit`` labelled documents, those with the lowest hash of doc_id,
    whose crc32(doc_id) mod 5 is not 0. A document labelled more than once has its highest label; null labels don't count;
    without labels all weights are 0. Only ids (``limit`` of them) are broadcast and only the weights come to the driver."""
    chosen = (
        labels.where(F.coalesce(*columns).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(*(F.max(c).cast("double").alias(f"__label{i}") for i, c in enumerate(columns)))
        .withColumn("__turn", F.xxhash64("doc_id")).orderBy("__turn", "doc_id").limit(limit)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").repartition(1).sortWithinPartitions("__turn", "doc_id", "text").select("text", *(f"__label{i}" for i in range(len(columns))))
    heads = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = fit(((*K.text_bytes(b.column(0)), np.stack([b.column(1 + i).to_numpy(zero_copy_only=False).astype(float) for i in range(heads)], axis=1)) for b in batches), designs)
        yield pa.RecordBatch.from_pydict({"weights": [w.tobytes()]})

    got = sample.mapInArrow(run, "weights binary").first()
    return (np.frombuffer(got[0], np.float32) if got else np.zeros(heads * (SLOTS + 1), np.float32)).reshape(heads, SLOTS + 1)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def batch_scores(column, weights: np.ndarray, designs: tuple[Design, ...] = (NGRAMS,)) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (rows x heads) of a text column, and its numbers of words as the first head counts them."""
    data, offsets = K.text_bytes(column)
    out = np.tile(weights[:, SLOTS].astype(float), (len(offsets) - 1, 1))
    words = np.zeros(len(offsets) - 1, np.int64)
    for lo, hi in K.slices(offsets):
        part, off = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        for head, (w, design) in enumerate(zip(weights, designs, strict=True)):
            slot, row, size = design.features(part, off)
            if not head:
                words[lo:hi] = size
            out[lo:hi, head] += design.sums(slot, row, size, w)
    return 1 / (1 + np.exp(-np.clip(out, -700, 700))), words


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` with a column of scores (0 to 1) put at the end; a column of that name is replaced. Null texts are empty,
    an empty text has the score of the bias, repeated rows have the same score."""
    held = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(batch_scores(b.column(at), held.value)[0][:, 0], pa.float64())], [*b.schema.names, name])

    return kept.mapInArrow(run, schema)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every row of ``documents``. Null texts are empty, empty texts have the score of the bias, repeated rows have one score each,
    a null doc_id isn't held out, other columns are ignored, no labels give scores of one half, an empty table gives no rows."""
    docs = store.table(spark, sf_dir, "documents").select("doc_id", "text")
    got = score(docs, train(docs, store.table(spark, sf_dir, "labels")))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier rejects go. It learns from the labelled rows of ``docs``. Null and
    empty texts have the score of the bias; rows with a null or repeated doc_id are judged each by its own text; all columns stay; an empty table
    stays empty."""
    kept = score(docs, train(docs, store.table(spark, sf_dir, "labels")), "__quality_score")
    return kept.where(F.col("__quality_score") >= THRESHOLD).select(*docs.columns)
