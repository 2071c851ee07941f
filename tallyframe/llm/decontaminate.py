"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document long, so the sample is taken from the item
alone: its shingles with the least hashes. An item's share of a document's
shingles is then estimated by how much of the sample the document holds. Items
are put in classes of size by powers of two; a class has one sample size, and
the number of hits asked for follows from how many shingles an item may miss,
so an item that is contained is never passed over. What the search finds is
counted exactly, shingle text by shingle text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.plans.lineage import materialize

SIZE = 5
SHARE_PERCENT = 80
LEAST_SAMPLE = 16
#: Sample rows (24 bytes each) up to which they are sent to every task.
BROADCAST_ROWS = 1_000_000
BLANKS = " \t\n\u000b\f\r"


def words_of(text: Column) -> Column:
    """Lower-case words; null, empty and blank texts have none."""
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def _runs(words: str, item) -> Column:
    """One value for each run of ``SIZE`` words; fewer words give none.

    Take it apart with ``explode_outer`` only: ``explode`` adds a filter on the
    array's size, which is pushed below the split and makes it run again for
    every single word.
    """
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (SIZE - 1), F.lit(0)))
    return F.transform(starts, item)


def hashed_shingles(docs: DataFrame) -> DataFrame:
    """Add ``__shingles``: distinct 64-bit hashes of the word shingles."""
    hashed = docs.withColumn("__words", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))
    parts = lambda first, i: F.xxhash64(first, *(F.get("__words", i + k) for k in range(1, SIZE)))
    return hashed.withColumn("__shingles", _runs("__words", parts)).drop("__words")


def text_shingles(docs: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``keys`` and ``shingle``: each distinct shingle as text."""
    split = docs.select(*keys, words_of(F.col("text")).alias("__words"))
    joined = lambda _, i: F.array_join(F.slice("__words", i + 1, F.lit(SIZE)), " ")
    return split.select(*keys, F.explode_outer(_runs("__words", joined)).alias("shingle")).distinct().filter("shingle is not null")


def _samples(items: DataFrame) -> DataFrame:
    """Rows (hash, item_id, size, need): each item's sample and the hits it must have.

    ``missed`` shingles may be lacking at the wanted share. A sample is about
    twice the most that a class may miss, and of it all but ``missed`` must hit.
    """
    # Texts of one item are cut one by one: no shingle crosses from one to the next.
    shingled = hashed_shingles(items).groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("__shingles"))).alias("__shingles"))
    sized = shingled.select("item_id", "__shingles", F.size("__shingles").alias("size"))
    missed = F.expr(f"(size * {100 - SHARE_PERCENT}) div 100").cast("int")
    # The class bound: the least power of two that is not below the size.
    bound = F.expr("shiftleft(1, cast(ceil(log2(size)) as int))")
    sample = F.least(F.col("size"), F.greatest(F.lit(LEAST_SAMPLE), F.expr(f"2 * ((bound * {100 - SHARE_PERCENT}) div 100) + 1").cast("int")))
    classed = sized.withColumn("bound", bound).withColumn("missed", missed).withColumn("sample", sample)
    taken = classed.select(
        "item_id", "size", (F.col("sample") - F.col("missed")).alias("need"),
        # Ordered by another hash, so that the sample is the least by a random order.
        F.expr("slice(array_sort(transform(__shingles, x -> struct(xxhash64(x, 17) as o, x as h))), 1, sample)").alias("s"),
    )
    return taken.select(F.explode_outer("s.h").alias("hash"), "item_id", "size", "need").filter("hash is not null")


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of document and test item with at least 80 % of the item's shingles.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and
    ``text``; other columns are ignored. Gives ``doc_id``, ``text_hash``,
    ``item_id``, ``shared``, ``item_shingles`` and ``containment``; rows that
    are equal in id and text count once, rows that share an id alone are
    searched apart. Null, empty and short texts (under five words) have no
    shingle: as items they are never found, as documents they hold nothing.
    Repeated item rows count once, items of one id and other texts together.
    """
    items = items.select("item_id", "text").distinct()
    per_item = materialize(text_shingles(items, "item_id"))
    samples = materialize(_samples(items))
    # The sample is measured before it is sent out; a larger one is joined by shuffle.
    small = samples.count() <= BROADCAST_ROWS
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rows = hashed_shingles(keyed).select("doc_id", "text_hash", F.size("__shingles").alias("n"), F.explode_outer("__shingles").alias("hash"))
    if not small:
        rows = rows.distinct()
    wanted = F.broadcast(samples) if small else samples
    hits = rows.join(wanted, "hash").filter(F.col("n") * 100 >= F.col("size") * SHARE_PERCENT)
    counted = hits.groupBy("doc_id", "text_hash", "item_id").agg(F.countDistinct("hash").alias("hits"), F.first("need").alias("need"))
    candidates = materialize(counted.filter("hits >= need").select("doc_id", "text_hash", "item_id"))
    return _verified(keyed, candidates, per_item)


def _verified(keyed: DataFrame, candidates: DataFrame, per_item: DataFrame) -> DataFrame:
    """Exact share of each candidate pair, by shingle text."""
    on = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    named = candidates.select("doc_id", "text_hash").distinct()
    found = keyed.join(named, on(keyed, named), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    own = text_shingles(found, "doc_id", "text_hash")
    sizes = per_item.groupBy("item_id").agg(F.count("*").alias("item_shingles"))
    shared = own.join(per_item, "shingle").groupBy("doc_id", "text_hash", "item_id").agg(F.count("*").alias("shared"))
    pairs = shared.join(
        candidates.withColumnsRenamed({"doc_id": "__d", "text_hash": "__t", "item_id": "__i"}),
        F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t")) & F.col("item_id").eqNullSafe(F.col("__i")),
        "left_semi",
    )
    pairs = pairs.join(sizes.withColumnRenamed("item_id", "__item"), F.col("item_id").eqNullSafe(F.col("__item"))).drop("__item")
    share = F.col("shared").cast("double") / F.col("item_shingles").cast("double")
    return pairs.filter(F.col("shared") * 100 >= F.col("item_shingles") * SHARE_PERCENT).withColumn("containment", share)


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs``, all columns, without the documents that hold a test item."""
    found = contained(docs, items).select("doc_id", "text_hash").distinct()
    found = found.withColumnsRenamed({"doc_id": "__d", "text_hash": "__t"})
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t")), "left_anti")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contained(docs, items).select("doc_id", "item_id", "shared", "item_shingles", "containment")


SQL = r"""
WITH d AS (SELECT doc_id, string_split_regex(trim(lower(coalesce(text, '')), E' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, string_split_regex(trim(lower(coalesce(text, '')), E' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) >= 5),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS item_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, item_shingles, CAST(count(*) AS DOUBLE) / CAST(item_shingles AS DOUBLE) AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, item_shingles
HAVING 100 * count(*) >= 80 * item_shingles
"""
