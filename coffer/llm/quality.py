"""Quality scores: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.llm.rolling import SPACE, U, mixed, utf8, word_hashes

#: Labelled rows to learn from; a bound on the training task, whatever the number of labels.
TRAIN_ROWS = 8_192
BUCKETS = 1 << 18
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 0.02, 1e-6, 1e-5
THRESHOLD = 0.7
#: Rows whose checksum of doc_id leaves this remainder are never learned from.
FOLDS, HELD_OUT = 4, 2

# Kinds of bytes: lower case, upper case, digit, beyond ASCII, each other printing character by itself.
KIND = np.zeros(256, np.uint8)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 1, 2, 4, 8
KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 16


def _shapes(data: np.ndarray) -> np.ndarray:
    """For each word, the kinds of its bytes and its last byte if that is no letter or digit."""
    word = ~SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, U)
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    kinds = np.bitwise_or.reduceat(np.where(word, KIND[data], 0), at)
    last = data[np.flatnonzero(ends)]
    return kinds.astype(U) << U(8) | np.where(KIND[last] == 16, last, 0).astype(U)


def features(hashes: np.ndarray, shapes: np.ndarray) -> list[np.ndarray]:
    """Buckets of a text's n-grams, by kind: words, pairs of words, shapes, pairs of shapes with whether the words are
    the same. Word n-grams know words; shape n-grams carry over to words that training has not seen."""
    if not len(hashes):
        return []
    shapes = mixed(shapes + U(1 << 20))
    kinds = [hashes, shapes]
    if len(hashes) > 1:
        same = (hashes[1:] == hashes[:-1]).astype(U)
        kinds += [mixed(hashes[:-1]) + hashes[1:], mixed(mixed(shapes[:-1]) + shapes[1:] + same)]
    # Bucket 0 is the intercept.
    return [(mixed(k + U(i)) % U(BUCKETS - 1) + U(1)).astype(np.int32) for i, k in enumerate(kinds)]


def text_features(column: pa.Array):
    """Yields (row, features) for the whole texts of an Arrow column."""
    data, offsets = utf8(column)
    for row, hashes in word_hashes(data, offsets):
        yield row, features(hashes, _shapes(data[offsets[row] : offsets[row + 1]]))


def score(weights: np.ndarray, kinds: list[np.ndarray]) -> float:
    """The sparse dot product, in which every kind of n-gram counts by its share, as a probability."""
    z = float(weights[0]) + sum(float(weights[k].mean()) for k in kinds)
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Per-coordinate FTRL-proximal updates; a coordinate's weight follows from its two sums when it is needed."""

    def __init__(self):
        self.z, self.n = np.zeros(BUCKETS), np.zeros(BUCKETS)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _sparse(kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([np.zeros(1, np.int32), *kinds])
    share = np.concatenate([np.ones(1), *[np.full(len(k), 1 / len(k)) for k in kinds]])
    buckets, where = np.unique(at, return_inverse=True)
    return buckets, np.bincount(where, share)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_labels(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label) of about rows labels outside the held-out fold: all, or those with the smallest hashes of doc_id.
    A doc_id with several labels counts once, with the higher one."""
    usable = labels.where("doc_id is not null and quality is not null").where(~held_out())
    each = usable.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    share = min(1.0, rows / max(1, each.count()))
    return each.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learned from the labelled texts of at most about rows documents, in one order of their hashes.

    Texts become sparse n-grams where they are read. The sample of labels, which is bounded, is broadcast; the training
    task sees the sample's n-grams only. Without labels all weights are zero.
    """

    def sparse(batches):
        for batch in batches:
            found = [(row, *_sparse(kinds)) for row, kinds in text_features(batch.column(1))]
            ids, ys = batch.column(0), batch.column(2)
            columns = [ids, ys, pa.array([b.astype("<i4").tobytes() for _, b, _ in found], pa.binary()), pa.array([x.astype("<f4").tobytes() for _, _, x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "at", "x"])

    def fit(batches):
        examples = []
        for batch in batches:
            for y, at, x in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                examples.append((y, np.frombuffer(at, "<i4"), np.frombuffer(x, "<f4")))
        model = Ftrl()
        for _ in range(EPOCHS):
            for y, at, x in examples:
                model.learn(at, x.astype(np.float64), y)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype("<f4").tobytes()], pa.binary())], ["weights"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = docs.select("doc_id", "text").join(F.broadcast(training_labels(labels, rows)), "doc_id")
    examples = sample.select("doc_id", "text", "label").mapInArrow(sparse, f"doc_id {kind}, label int, at binary, x binary")
    ordered = examples.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "at")
    fitted = ordered.select("label", "at", "x").mapInArrow(fit, "weights binary").collect()
    return np.frombuffer(fitted[0]["weights"], "<f4") if fitted else np.zeros(BUCKETS, np.float32)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs with a column score between 0 and 1, higher for better texts. An empty or NULL text has the score of no
    n-grams. All columns stay; one named score is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = [c for c in docs.columns if c != "score"]
    schema = docs.select(kept).schema.add("score", "double")
    place = kept.index("text")

    def run(batches):
        for batch in batches:
            found = pa.array([score(shared.value, kinds) for _, kinds in text_features(batch.column(place))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*kept, "score"])

    return docs.select(kept).mapInArrow(run, schema)
