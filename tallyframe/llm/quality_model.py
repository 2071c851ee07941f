"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

Features are the single pieces and the pairs of neighbours of a text, hashed
into a fixed table; pieces are runs of letters and digits or runs of other
signs. Follow-the-regularised-leader (proximal) keeps two sums for each
feature and sets weights from them, so that most stay zero. A score is one
sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.llm import vec
from tallyframe.plans.lineage import materialize

TABLE_BITS = 18
#: At most so many labelled rows are learnt from, those with the least hashed ids.
TRAIN_ROWS = 8000
EPOCHS = 6
RATE, SMOOTH, L1, L2 = 0.5, 1.0, 0.02, 0.5

# Classes of bytes: white space 0, letters, digits and all beyond ASCII 1, other signs 2.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_TWICE = vec.mix(np.array([0x5EED], vec.U64))[0]


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and n + 1 offsets by text of the longest runs of one class."""
    kind = _CLASS[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[:-1][offsets[:-1] < len(data)]] = True
    edges = np.flatnonzero(change)
    ends = np.append(edges[1:], len(data))[: len(edges)]
    real = kind[edges] != 0
    starts, ends = edges[real], ends[real]
    return starts, ends, np.searchsorted(starts, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (n + 1 offsets, table places, values); a row's squares sum to 1.

    A feature that a text has c times counts 1 + log(c), so a long text does
    not drown in its common words. A piece next to itself is one feature,
    whatever the piece.
    """
    starts, ends, bounds = pieces(data, offsets)
    hashed = vec.span_hashes(data, starts, ends)
    with np.errstate(over="ignore"):
        pairs = vec.mix(hashed[:-1] * vec.U64(3) + hashed[1:]) if len(hashed) else hashed
        pairs[hashed[:-1] == hashed[1:]] = _TWICE
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    inner = text[1:] == text[:-1]
    shift = vec.U64(64 - TABLE_BITS)
    place = np.concatenate([hashed >> shift, pairs[inner] >> shift]).astype(np.int64)
    key = np.concatenate([text, text[1:][inner]]) << TABLE_BITS | place
    unique, often = np.unique(key, return_counts=True)
    row, value = unique >> TABLE_BITS, 1.0 + np.log(often)
    norm = np.sqrt(np.bincount(row, value * value, len(offsets) - 1))
    return np.searchsorted(row, np.arange(len(offsets))), unique & ((1 << TABLE_BITS) - 1), value / norm[row]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """Weights by follow-the-regularised-leader; the last place is the constant."""

    def __init__(self):
        self.z = np.zeros((1 << TABLE_BITS) + 1)
        self.n = np.zeros((1 << TABLE_BITS) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((SMOOTH + np.sqrt(n)) / RATE + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        weight = self.weights(at)
        gradient = (sigmoid(weight @ value) - label) * value
        square = gradient * gradient
        step = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / RATE
        self.z[at] += gradient - step * weight
        self.n[at] += square


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Learn from the rows of one task in their order; gives the weights as one row."""
    rows, model = [], Ftrl()
    for batch in batches:
        data, offsets = vec.string_bytes(batch.column(0))
        labels = batch.column(1).to_pylist()
        for low, high in vec.chunks(offsets):
            at, place, value = features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            for i in range(high - low):
                own = slice(at[i], at[i + 1])
                rows.append((np.append(place[own], 1 << TABLE_BITS).astype(np.int32), np.append(value[own], 1.0).astype(np.float32), labels[low + i]))
    for _ in range(EPOCHS):
        for place, value, label in rows:
            model.learn(place, value.astype(float), float(label))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights(slice(None)).astype("<f4").tobytes()], pa.binary())], names=["weights"])


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % by


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents in one partition, in a fixed order.

    The ids are chosen from the labels alone, those with the least hash, so
    the table sent to the documents has at most ``rows`` rows. Ids with
    contradicting labels, null labels and null ids are left out.
    """
    agreed = labels.filter(f"doc_id is not null and {label} is not null").groupBy("doc_id").agg(
        F.min(label).alias("label"), F.max(label).alias("most")
    ).filter("label = most")
    ids = agreed.select("doc_id", "label", F.xxhash64("doc_id").alias("o")).orderBy("o", "doc_id").limit(rows)
    own = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumn("t", F.xxhash64("text"))
    bounded = own.orderBy("o", "doc_id", "t").limit(rows)  # an id may have several rows
    return bounded.repartition(1).sortWithinPartitions("o", "doc_id", "t").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from a bounded sample of labelled documents.

    Only texts and labels go in. Without any label every weight is 0 and every
    score 0.5.
    """
    one = labelled_sample(docs, labels, label, rows)
    found = materialize(one.mapInArrow(_train, "weights binary")).first()
    return np.frombuffer(found["weights"], "<f4") if found else np.zeros((1 << TABLE_BITS) + 1, np.float32)


def _score(weights):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(weights.value, "<f4").astype(float)
        for batch in batches:
            data, offsets = vec.string_bytes(batch.column(1))
            found = [np.zeros(0)]
            for low, high in vec.chunks(offsets):
                at, place, value = features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                # Each text's own sum, not a difference of long running sums.
                filled = np.flatnonzero(np.diff(at))
                dots = np.zeros(high - low)
                if len(filled):
                    dots[filled] = np.add.reduceat(table[place] * value, at[:-1][filled])
                found.append(sigmoid(dots + table[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], names=["doc_id", "score"])

    return score


def score_texts(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` of every whole text; null and empty texts get the constant's score."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4").tobytes())  # of fixed size
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score(sent), f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: int = 1, folds: int = 3) -> DataFrame:
    """Score every document; rows whose id falls in ``fold`` are never learnt from."""
    held = remainder(F.col("doc_id"), folds) == fold
    scored = score_texts(docs, fit(docs, labels.filter(~held), label))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return classify(read("documents"), read("labels"))
