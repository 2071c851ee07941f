from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm.brute import without_repeats
from llm.conftest import SCHEMA, prose
from tallyframe.llm import repeated_bytes as R, vec
from tallyframe.plans.lineage import materialize


def found(docs):
    rows = R.remove_repeated(docs, digest=True).collect()
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in rows)


def test_odd_rows(odd_docs, odd_rows):
    assert found(materialize(odd_docs)) == Counter(without_repeats([r[:2] for r in odd_rows]))


def test_empty_table(no_docs):
    assert R.remove_repeated(no_docs).count() == 0


@pytest.mark.parametrize("held", [16 << 20, 900])
def test_shared_passages(spark, held, monkeypatch):
    """Passages of all lengths about the window, at all places, over many parts and small groups."""
    monkeypatch.setattr(R, "HELD_BYTES", held)
    rng = random.Random(held)
    passages = [prose(rng, n) for n in (8, 12, 15, 20, 60)] + ["a" * 120, "ab" * 60, "z" * 50, "ö" * 60]
    rows = []
    for i in range(160):
        parts = [prose(rng, rng.randint(0, 25)) for _ in range(rng.randint(1, 4))]
        parts += [p[rng.randint(0, 5) :] if rng.random() < 0.5 else p for p in rng.sample(passages, rng.randint(0, 3))]
        rng.shuffle(parts)
        rows.append((rng.randint(0, 140), rng.choice(["", " "]).join(parts)))
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(5, "text")
    assert found(materialize(docs)) == Counter(without_repeats(rows))


def test_kept_bytes_are_what_is_left(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, "start " + text), (2, "before " + text + " after")]
    docs = materialize(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = {r.doc_id: bytes(r.kept).decode() for r in R.remove_repeated(docs).collect()}
    assert kept == {1: "start " + text, 2: "before after"}


def test_changed_parts_fail(tmp_path):
    """A scan that sees other documents than the one before stops."""
    data, offsets = vec.string_bytes(pa.array(["some text", "and more"]))
    filed = R.Filed(str(tmp_path), 0)
    with pytest.raises(ValueError, match="changed between scans"):
        filed.check(R.Held(np.array([1, 2]), data, offsets))
    filed.marks = {R._part_mark(np.array([1, 2]), offsets)}
    filed.check(R.Held(np.array([1, 2]), data, offsets))
    with pytest.raises(ValueError, match="changed between scans"):
        filed.check(R.Held(np.array([1, 3]), data, offsets))
