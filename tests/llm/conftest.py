from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice("ae io un ka lo mi tes ran Vel dor.".split()) + rng.choice("abcdefgh") for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and long texts, copies, near copies, repeated ids and rows."""
    rng = random.Random(5)
    long, plain, passage = prose(rng, 6000), prose(rng, 200), prose(rng, 60)
    near = plain.split()
    near[100] = "changed"
    texts = [
        (9, plain), (4, plain), (7, " ".join(near)), (1, None), (2, ""), (3, " \n\t "), (5, long), (6, long + " end"),
        (8, "one two three"), (10, "ONE two\nthree"), (11, prose(rng, 80) + " " + passage), (12, passage + " " + prose(rng, 90)),
        (13, "é" * 70 + "\n" + "é" * 70), (14, "é" * 49), (15, "x" * 400), (16, "x" * 300), (None, plain), (None, None), (9, plain), (4, prose(rng, 120)),
        (17, "word " * 300), (18, "a <b> | $ \n same line here\nsame line here\n\n \nsame line here"),
    ]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), len(t or "")) for i, t in texts]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows over several partitions, with columns that operators use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, SCHEMA).repartition(3, "n_chars")
    return docs.withColumns({"n": F.lit(1), "size": F.lit("own"), "score": F.lit(2.5), "bucket": F.lit(0), "item_id": F.lit(3), "root": F.lit("r")})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
