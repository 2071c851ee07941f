"""Toxicity by compression distance to two zstandard dictionaries.

One dictionary holds ordinary text, the other the same and toxic text after
it. A window is one word with its blanks; a fixed carrier that both
dictionaries hold follows it, so that the cost of starting a block is the same
for both. A window counts by how many bytes the toxic dictionary saves over
the ordinary one and by how much is left that it does not explain either. A
logistic curve over a text's counts, fitted on labelled texts, sets the
thresholds.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import vec
from tallyframe.llm.quality_model import labelled_sample, remainder, sigmoid
from tallyframe.plans.lineage import materialize

#: At most so many labelled rows are learnt from, those with the least hashed ids.
TRAIN_ROWS = 5000
ORDINARY_WORDS, TOXIC_WORDS = 3000, 400
#: Letter runs of these lengths mark toxic words, if they are correlated with the label so far.
RUNS, LEAST_CORRELATION, LEAST_SIGMAS, LEAST_TEXTS = (6, 7, 8), 0.14, 4.0, 5
LEVEL, LEAST_MATCH = 5, 4
GAINS, REST = 7, 4
KEPT_WORDS = 1_000_000
CARRIER = b"\n:= the carrier of each word =:\n"
MARKS = ".,!?;:$%&#*|\"()"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bare(word: str) -> str:
    return word.lower().strip(MARKS)


def _runs(word: str) -> set[str]:
    own = f" {word} "
    return {own[i : i + k] for k in RUNS for i in range(len(own) - k + 1)}


def _compressor(dictionary: bytes):
    content = zstandard.ZstdCompressionDict(dictionary + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=64, dict_size=len(content), min_match=LEAST_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    content.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=settings).compress


class Windows(dict):
    """The cell of each word: 0 if the toxic dictionary saves nothing, else by saving and rest."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = _compressor(ordinary), _compressor(ordinary + toxic)
        self.least = len(self.toxic(CARRIER))

    def __missing__(self, word: str) -> int:
        window = f" {bare(word)} ".encode("utf-8", "replace") + CARRIER
        left = len(self.toxic(window))
        gain = min(len(self.ordinary(window)) - left, GAINS)
        cell = (gain - 1) * REST + min(max(left - self.least - 2, 0), REST - 1) + 1 if gain > 0 else 0
        self[word] = cell
        return cell

    def features(self, texts: list[str]) -> np.ndarray:
        """A row for each text: windows that save at least so much and leave at most so much."""
        cells, sizes = np.zeros((len(texts), GAINS * REST)), np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = WORD.findall(text)
            sizes[i] = len(words)
            found = np.frombuffer(bytes(map(self.__getitem__, words)), np.uint8)
            cells[i] = np.bincount(found, minlength=GAINS * REST + 1)[1:]
            if len(self) > KEPT_WORDS:
                self.clear()
        grid = cells.reshape(len(texts), GAINS, REST)
        grid = grid[:, ::-1].cumsum(1)[:, ::-1].cumsum(2).reshape(len(texts), -1)
        return np.concatenate([np.log1p(grid), grid > 0, grid > 2, np.log1p(sizes)[:, None]], axis=1)


def _words_of(texts: list[str], labels: np.ndarray) -> tuple[bytes, bytes]:
    """Contents of the two dictionaries: the most frequent ordinary words, and
    the words of toxic texts that hold a letter run typical of these."""
    texts_with, words = (Counter(), Counter()), (Counter(), Counter())
    for text, label in zip(texts, labels):
        own = Counter(map(bare, WORD.findall(text)))
        words[label].update(own)
        texts_with[label].update(set().union(*map(_runs, own)) if own else ())
    n = [max(1, int((labels == k).sum())) for k in (0, 1)]
    total, marks = n[0] + n[1], set()
    for run, a in texts_with[1].items():
        b = texts_with[0][run]
        share = (a + b) / total
        if a < LEAST_TEXTS or share >= 1:
            continue
        sigmas = (a / n[1] - b / n[0]) / math.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
        if sigmas >= max(LEAST_SIGMAS, LEAST_CORRELATION * math.sqrt(total)):
            marks.add(run)
    ranked = lambda counted: sorted(counted, key=lambda w: (-counted[w], w))
    toxic = [w for w in ranked(words[1]) if not marks.isdisjoint(_runs(w))][:TOXIC_WORDS]
    ordinary = [w for w in ranked(words[0])[: 2 * ORDINARY_WORDS] if marks.isdisjoint(_runs(w))][:ORDINARY_WORDS]
    # What is most frequent stands last, where it is cheapest to refer to.
    joined = lambda found, gap: (" " + gap.join(reversed(found)) + " ").encode("utf-8", "replace")
    return joined(ordinary, " "), joined(toxic, "  ")


def _curve(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps: mean, scale and weights (the constant last)."""
    mean, scale = rows.mean(0), rows.std(0) + 1e-9
    x = np.column_stack([(rows - mean) / scale, np.ones(len(rows))])
    weights, hold = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * len(rows) + 1e-6)
    for _ in range(30):
        p = sigmoid(x @ weights)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(hold), x.T @ (labels - p) - hold * weights)
        weights = weights + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return mean, scale, weights


def train(texts: list[str], labels: np.ndarray) -> dict:
    ordinary, toxic = _words_of(texts, labels)
    mean, scale, weights = _curve(Windows(ordinary, toxic).features(texts), labels)
    return {"ordinary": ordinary, "toxic": toxic, "mean": mean, "scale": scale, "weights": weights}


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += [t or "" for t in batch.column(0).to_pylist()]
        labels += batch.column(1).to_pylist()
    if texts:
        model = train(texts, np.array(labels, int))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> bytes | None:
    """Model from a bounded sample of labelled documents; None without any."""
    one = labelled_sample(docs, labels, label, rows)
    found = materialize(one.mapInArrow(_train, "model binary")).first()
    return bytes(found["model"]) if found else None


_open: dict[bytes, tuple] = {}


def _score(model, text_at: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = model.value
        if data not in _open:  # a worker keeps what it knows of words from task to task
            _open.clear()
            found = pickle.loads(data)
            _open[data] = found, Windows(found["ordinary"], found["toxic"])
        found, windows = _open[data]
        for batch in batches:
            texts_of = batch.column(text_at)
            _, offsets = vec.string_bytes(texts_of)
            out = [np.zeros(0)]
            for low, high in vec.chunks(offsets):
                texts = [t or "" for t in texts_of.slice(low, high - low).to_pylist()]
                rows = (windows.features(texts) - found["mean"]) / found["scale"]
                out.append(sigmoid(rows @ found["weights"][:-1] + found["weights"][-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out))], names=[*batch.schema.names, "__score"])

    return score


def score_texts(docs: DataFrame, model: bytes | None) -> DataFrame:
    """``docs``, all columns, with ``__score`` of every whole text.

    Null texts count as empty; without a model all score 0.
    """
    if model is None:
        return docs.withColumn("__score", F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_score(sent, docs.columns.index("text")), f"{kinds}, __score double")


def without_toxic(docs: DataFrame, labels: DataFrame, fold: int = 0, folds: int = 5) -> DataFrame:
    """``docs``, all columns, without those that score 0.5 or more."""
    model = fit(docs, labels.filter(remainder(F.col("doc_id"), folds) != fold))
    return score_texts(docs, model).filter("__score < 0.5").drop("__score")


def classify(docs: DataFrame, labels: DataFrame, fold: int = 0, folds: int = 5) -> DataFrame:
    """Score every document; rows whose id falls in ``fold`` are never learnt from."""
    held = remainder(F.col("doc_id"), folds) == fold
    scored = score_texts(docs.select("doc_id", "text"), fit(docs, labels.filter(~held)))
    predicted = (F.col("__score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held.alias("held_out"), F.col("__score").alias("score"), predicted)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return classify(read("documents"), read("labels"))
