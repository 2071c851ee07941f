"""Quality rules whose cutoffs are chosen under a proven limit of false rejections.

Every rule has a fixed ladder of cutoffs from lenient to strict. In each
stratum (language) the good labelled documents test the ladders one rule after
the other: a step is taken while the exact binomial upper bound of the share
of good documents that all rules together would reject stays within the limit.
A ladder ends at its first failed test, so from any one start its tests need no
correction among themselves. Where a ladder starts depends on the same
documents, by the steps that earlier ladders took; so the error probability is
divided by strata, by rules and by the starts a ladder can have, and holds
whichever comes about. A stratum with too few labelled documents gets no
cutoffs, and its documents are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import vec
from tallyframe.plans.lineage import materialize

LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Of good documents, at most this share is rejected, but for this probability.
LIMIT, ERROR = 0.05, 0.05
#: Each rule rejects values above its cutoff; cutoffs from lenient to strict.
LADDERS = {
    "symbols_a_word": (2.0, 1.0, 0.5, 0.25, 0.15, 0.1),
    "upper_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25),
    "repeated_share": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25),
    "repeated_lines": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25),
    "long_words": (14.0, 12.0, 10.0, 9.0, 8.0, 7.5),
    "short_words": (-2.0, -2.25, -2.5, -2.75, -3.0, -3.25),
}
RULES = tuple(LADDERS)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
# The bytes 80-BF continue a character.
_FIRST = np.ones(256, bool)
_FIRST[0x80:0xC0] = False

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


def _by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _salted(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The values told apart by text, so that equal ones meet within a text only."""
    text = np.repeat(np.arange(1, len(offsets), dtype=vec.U64), np.diff(offsets))
    return vec.mix(values ^ vec.mix(text))


def counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The figures of ``COUNTS`` for each text."""
    starts, ends, words = vec.words(data, offsets)
    chars = np.concatenate([[0], np.cumsum(_FIRST[data], dtype=np.int64)])
    word_chars = np.concatenate([[0], np.cumsum(chars[ends] - chars[starts])])
    # Lines: split at \n inside each text; those with a word count.
    is_end = data == 10
    line_ends = np.union1d(np.flatnonzero(is_end), offsets[1:]) if len(offsets) > 1 else np.zeros(0, np.int64)
    line_starts = np.concatenate([[0], np.where(is_end[np.minimum(line_ends[:-1], max(len(data) - 1, 0))] if len(data) else False, line_ends[:-1] + 1, line_ends[:-1])]) if len(line_ends) else line_ends
    line_starts = np.minimum(line_starts, line_ends)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    lines = np.searchsorted(line_starts, offsets)
    _, first = np.unique(_salted(vec.span_hashes(data, line_starts, line_ends), lines), return_index=True)
    fresh = np.zeros(len(line_starts), bool)
    fresh[first] = True
    # Words that lie in a three-word window which the text has twice.
    windows, at = vec.shingles(vec.span_hashes(data, starts, ends), words, 3)
    real = np.repeat(np.diff(words) >= 3, np.diff(at))
    begin = (np.repeat(words[:-1] - at[:-1], np.diff(at)) + np.arange(len(windows)))[real]
    _, which, often = np.unique(_salted(windows, at)[real], return_inverse=True, return_counts=True)
    again = begin[often[which] > 1]
    step = np.bincount(again, minlength=len(starts) + 3) - np.bincount(again + 3, minlength=len(starts) + 3)
    covered = np.cumsum(step)[: len(starts)] > 0
    return [
        np.diff(words), np.diff(word_chars[words]), _by_text(_SYMBOL[data], offsets), np.diff(lines),
        np.diff(lines) - _by_text(fresh, lines), _by_text(covered, words), _by_text(_LETTER[data], offsets), _by_text(_UPPER[data], offsets),
    ]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = vec.string_bytes(batch.column(2))
        parts = [counts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]) for low, high in vec.chunks(offsets)]
        columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)] if parts else [pa.array([], pa.int64())] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "stratum", *COUNTS])


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``stratum`` (the language) and the counts of every whole text; null texts count as empty."""
    kinds = ", ".join(f"{name} bigint" for name in COUNTS)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("lang").alias("stratum"), "text").mapInArrow(_count, f"doc_id {id_kind}, stratum string, {kinds}")


def with_steps(counted: DataFrame) -> DataFrame:
    """Add ``base_failed`` and, for each rule, the first step of its ladder that rejects (or one past the last)."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = {
        "symbols_a_word": F.col("n_symbols") / words,
        "upper_share": F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)),
        "repeated_share": F.col("n_repeat_words") / words,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "long_words": F.col("word_chars") / words,
        "short_words": -F.col("word_chars") / words,
    }
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    steps = {}
    for rule, ladder in LADDERS.items():
        step = F.lit(len(ladder))
        for k in reversed(range(len(ladder))):
            step = F.when(values[rule] > ladder[k], k).otherwise(step)
        steps[f"step_{rule}"] = step.cast("int")
    return counted.withColumns({"base_failed": failed, **steps})


def upper_bound(rejected: int, total: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper bound of a share: the least p with P(X <= rejected) <= error."""
    if rejected >= total:
        return 1.0
    low, high = rejected / total, 1.0
    for _ in range(60):
        p = (low + high) / 2
        tail = beta_share(total - rejected, rejected + 1, 1 - p) if p < 1 else 0.0
        low, high = (p, high) if tail > error else (low, p)
    return high


def beta_share(a: float, b: float, x: float) -> float:
    """The incomplete beta function, regularised, by its continued fraction.

    With a = n - k and b = k + 1 it is the chance of at most k of n, whose terms
    need not be added one by one.
    """
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    small = 1e-300
    ratio, below = 1.0, 1 / (1 - (a + b) * x / (a + 1) or small)
    value = below
    for m in range(1, 100_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            below = 1 / (1 + term * below or small)
            ratio = 1 + term / ratio or small
            value *= below * ratio
        if abs(below * ratio - 1) < 1e-15:
            break
    return front * value


def choose(steps: np.ndarray, counted: np.ndarray, error: float, limit: float = LIMIT) -> list[int]:
    """Steps taken on each ladder (-1: none), from the good documents' first rejecting steps and how many have them."""
    total, taken = int(counted.sum()), [-1] * steps.shape[1]
    for rule in range(steps.shape[1]):
        # Each earlier ladder ended on one of its steps or on none.
        error /= len(LADDERS[RULES[rule - 1]]) + 1 if rule else 1
        others = (steps <= np.array(taken)).any(axis=1)
        for k in range(len(LADDERS[RULES[rule]])):
            rejected = int(counted[others | (steps[:, rule] <= k)].sum())
            if rejected > limit * total or upper_bound(rejected, total, error) > limit:
                break
            taken[rule] = k
    return taken


def cutoffs(good: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """Per stratum the step taken on each ladder, from good documents with their steps."""
    names = [f"step_{rule}" for rule in RULES]
    # At most (steps + 1) ** rules rows for each stratum, whatever the input.
    tally = materialize(good.filter("not base_failed").groupBy("stratum", *names).agg(F.count("*").alias("n")))
    strata = max(1, tally.select("stratum").distinct().count())

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        taken = choose(rows[names].to_numpy(np.int64), rows["n"].to_numpy(np.int64), error / (strata * len(RULES)), limit)
        return pd.DataFrame([[rows["stratum"].iloc[0], *taken]], columns=["stratum", *(f"cut_{r}" for r in RULES)])

    return tally.groupBy("stratum").applyInPandas(pick, "stratum string, " + ", ".join(f"cut_{r} int" for r in RULES))


def apply_rules(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """Counts of every document, ``base_failed``, ``kept`` and ``rejected_by``.

    ``docs`` has ``doc_id``, ``text``, ``lang``; ``labels`` has ``doc_id`` and
    ``quality`` (1: good). Other columns are ignored. Null texts count as
    empty and fail the base; a null language is a stratum of its own; rows
    that share an id are judged each by its own text; labels that contradict
    each other, are null or have no document are left out. Without labels the
    base rules alone decide.
    """
    counted = materialize(with_steps(text_counts(docs)))
    agreed = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    good = counted.join(agreed.filter("low = 1 and high = 1").select("doc_id"), "doc_id", "left_semi")
    cuts = materialize(cutoffs(good, limit, error)).withColumnRenamed("stratum", "__stratum")
    joined = counted.join(cuts, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    named = [F.when(F.col(f"step_{r}") <= F.coalesce(F.col(f"cut_{r}"), F.lit(-1)), F.lit(r)) for r in RULES]
    by = F.array_compact(F.array(*named))
    return joined.select(
        "doc_id", "stratum", *COUNTS, "base_failed", (~F.col("base_failed") & (F.size(by) == 0)).alias("kept"), by.alias("rejected_by")
    )


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return apply_rules(read("documents"), read("labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"
    )
