from __future__ import annotations


import corpus_pipeline as P
from llm.brute import contained_items, jaccard_components
from tallyframe.llm import mixing, toxicity
from tallyframe.llm.registry import QUERIES, SQL
from tallyframe.plans.lineage import materialize

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in P.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], SF)))
        assert kept[-1].columns == docs.columns, name
    clean, unique, tested, mixed = kept[1:]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = {(r.doc_id): r.predicted for r in toxicity.classify(docs, labels).collect()}
    assert rows_of(clean) == [r for r in rows_of(docs) if not scored[r[0]]]
    groups = jaccard_components(rows_of(clean), 5, 80)
    assert {r[0] for r in rows_of(unique)} == {c for _, _, c in groups}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, *_ in contained_items(rows_of(unique), items)}
    assert rows_of(tested) == [r for r in rows_of(unique) if r[0] not in leaks]
    assert leaks or len(rows_of(unique)) == len(rows_of(tested))
    copies = {r.doc_id: r.copies for r in mixing.mix(tested).collect()}
    assert rows_of(mixed) == sorted(r for r in rows_of(tested) for _ in range(copies[r[0]]))
    ids = P.STAGES[-1][1](spark, mixed, SF).collect()
    assert sorted(r.doc_id for r in ids) == [r[0] for r in rows_of(mixed)]
    want = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in P.run(spark, SF).collect()}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in ids} == want


def test_stages_on_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    """Nulls, blank and long texts, repeated rows and ids, clashing column names; then no row at all."""
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES[:-1]:
            kept = materialize(stage(spark, docs, SF))
            assert kept.columns == docs.columns, name
            assert name == "mixing" or kept.count() <= docs.count(), name
            docs = kept
        ids = P.STAGES[-1][1](spark, docs, SF)
        assert ids.count() == docs.count() and ids.filter("n_tokens < 1").count() == 0


def test_registry():
    import __spark_entry__ as entry

    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(QUERIES)
