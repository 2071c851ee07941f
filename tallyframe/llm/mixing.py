"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash. Words are summed by source and by the
leading bits of the hash; the running sum shows in which bucket a source's
budget ends. Only the documents of that bucket are looked at again, by the
next bits, so the cut is found in a few sums and no document is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tallyframe.plans.lineage import materialize
from tallyframe.plans.ordered import number_rows

WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
BITS, LEVELS = 12, 5
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Words of a text as bigint; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Target of each source from its size: (source, source_size, target).

    Sources in code point order, null last, take the weights in turn. A
    source's target is its share of all words by weight but at most ``most``
    times its size; what is over is shared again among the others. The sources
    that stop are those with the least room per weight, so one running sum
    over that order finds them: a source stops if its room is at most its
    share of what those before it leave.
    """
    turn = W.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    at = ((F.row_number().over(turn) - 1) % len(weights)).cast("int")
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at + 1).cast("bigint"))
    room = F.col("source_size") * most
    order = W.orderBy(room / F.col("weight"), F.col("source").isNull(), F.encode("source", "utf-8"))
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    words_left = F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(room).over(before), F.lit(0))
    stops = room * F.sum("weight").over(rest) <= words_left * F.col("weight")
    marked = ranked.withColumn("stops", stops)
    everything = W.partitionBy()
    free = F.sum("source_size").over(everything) - F.sum(F.when(F.col("stops"), room).otherwise(0)).over(everything)
    weight = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    share = free.cast("double") * F.col("weight") / weight.cast("double")
    return marked.select("source", "source_size", F.when(F.col("stops"), room.cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 7) -> DataFrame:
    """How often the mix takes each document.

    ``docs`` has ``doc_id``, ``text`` and ``source``; all its columns are kept
    and ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` are
    added (input columns of these names are replaced). A source whose target
    is r times its size takes every document floor(r) times; the rest of its
    budget goes to the documents with the least hashes, up to the hash at
    which the sum is nearest to the budget. The hash is over id and text, so
    reruns agree.

    Null or empty texts have size 0 and add no words; a null source is a
    source of its own, the last in order. Rows equal in id and text share a
    hash; where the cut falls on them, as many are taken as bring the sum
    nearest to the budget, in the order of all their columns. An empty table
    gives an empty result.
    """
    docs = docs.select([c for c in docs.columns if c not in ADDED])
    keyed = docs.withColumns({"size": word_count(F.col("text")), "__hash": _hash(seed), "__text": F.xxhash64("text")})
    sized = materialize(keyed.select("doc_id", "__text", "source", "size", "__hash"))
    plan = mix_sizes(sized, weights, most)
    # A hash decides for all rows alike, so the plan is joined back by source only.
    parts = materialize(_parts(sized, plan))
    out = _known(keyed, plan)
    extra = F.when(F.col("__hash") <= F.col("__cut"), 1).otherwise(0)
    if parts.limit(1).count():
        # Rows that share the hash of the cut are numbered, over all tasks, and the first of them taken.
        split = parts.withColumnsRenamed({"source": "__source", "cut": "__at", "part": "__part"})
        shared = F.col("source").eqNullSafe(F.col("__source")) & (F.col("__hash") == F.col("__at"))
        others = out.join(split, shared, "left_anti").withColumn("__extra", extra)
        tied = out.join(split, shared).withColumns({"__row": F.xxhash64(*docs.columns), "__place": F.monotonically_increasing_id()})
        numbered = number_rows(materialize(tied), "__source", "__row", "__place", into="__nth")
        first = numbered.groupBy(F.col("__source").alias("__own")).agg(F.min("__nth").alias("__first"))
        numbered = numbered.join(first, F.col("__source").eqNullSafe(F.col("__own")))
        taken = F.when(F.col("__nth") - F.col("__first") < F.col("__part"), 1).otherwise(0)
        out = others.unionByName(numbered.withColumn("__extra", taken).select(*others.columns))
        extra = F.col("__extra")
    copies = F.col("__base") + extra
    return out.withColumn("copies", copies.cast("bigint")).withColumn("taken", F.col("copies") * F.col("size")).drop(
        "__hash", "__text", "__base", "__cut", "__budget", "__extra"
    )


def _parts(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Sources whose cut falls on rows that share a hash: (source, cut, part), and how many of these rows to take.

    Such rows are equal in id and text, so of one size. The cut of the plan is
    on the near side of them; the hash they share is the last within the
    budget or the first beyond it.
    """
    plan = plan.select(F.col("source").alias("__s"), "edge", "low", "budget").filter("edge >= 0 and budget > 0")
    ties = sized.join(plan, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__hash") == F.col("edge")))
    counted = ties.groupBy("source", "edge").agg(
        F.count(F.lit(1)).alias("rows"), F.first("budget").alias("budget"), F.first("low").alias("low"), F.max("size").alias("size")
    ).filter("rows > 1 and size > 0")
    nearest = F.floor((F.col("budget") - F.col("low")) / F.col("size") + 0.5)
    return counted.select("source", F.col("edge").alias("cut"), F.greatest(F.lit(0), F.least("rows", nearest)).cast("bigint").alias("part"))


def _hash(seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 64 - BITS * LEVELS)


def _known(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Add each document's source plan; null sources match too."""
    plan = plan.withColumnsRenamed({"source": "__source", "base": "__base", "cut": "__cut", "budget": "__budget"}).drop("edge", "low")
    return docs.join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")


def mix_sizes(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Plan of each source: (source, source_size, target, base, cut), and of its cut (edge, low, budget).

    ``sized`` has ``source``, ``size`` and ``__hash`` and is read once for
    each level, so give a written table.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(per_source, weights, most)
    base = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    aims = aims.withColumn("base", base.cast("bigint"))
    aims = materialize(aims.withColumn("budget", F.col("target") - (F.col("base") * F.col("source_size")).cast("double")))
    # ``low``: words of the hashes below the boundary bucket; ``prefix``: that bucket's bits.
    edge = aims.select("source", "budget", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("prefix"))
    for level in range(1, LEVELS + 1):
        edge = materialize(_refine(sized, edge, level))
    cut = F.when(F.col("budget") <= 0, F.lit(-1)).when(
        F.col("low") + F.col("inside") - F.col("budget") <= F.col("budget") - F.col("low"), F.col("prefix")
    ).otherwise(F.col("prefix") - 1)
    cuts = edge.select(F.col("source").alias("__s"), cut.alias("cut"), F.col("prefix").alias("edge"), "low")
    joined = aims.join(cuts, F.col("source").eqNullSafe(F.col("__s")), "left")
    return joined.select("source", "source_size", "target", "base", F.coalesce("cut", F.lit(-1)).alias("cut"), "edge", "low", "budget")


def _refine(sized: DataFrame, edge: DataFrame, level: int) -> DataFrame:
    """The boundary bucket of each source one level of bits further down."""
    edge = edge.select(F.col("source").alias("__s"), "budget", "low", F.col("prefix").alias("__p"))
    below = BITS * (LEVELS - level)
    bucket = F.shiftrightunsigned("__hash", below)
    # Each task sums its own rows before anything is shuffled, so a hot source
    # costs as many rows as it has buckets.
    sums = sized.withColumn("bucket", bucket)
    if level > 1:
        on = F.col("source").eqNullSafe(F.col("__s")) & (F.shiftrightunsigned("bucket", BITS) == F.col("__p"))
        sums = sums.join(edge.select("__s", "__p"), on, "left_semi")
    sums = sums.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    found = sums.join(edge, F.col("source").eqNullSafe(F.col("__s")))
    run = W.partitionBy("source").orderBy("bucket")
    upto = F.col("low") + F.sum("words").over(run)
    found = found.withColumn("upto", upto)
    # The first bucket that reaches the budget, or the last one of all.
    reach = F.when(F.col("upto") >= F.col("budget"), F.col("bucket"))
    chosen = found.groupBy("source").agg(
        F.first("budget").alias("budget"),
        F.coalesce(F.min(reach), F.max("bucket")).alias("prefix"),
        F.coalesce(F.min_by(F.col("upto") - F.col("words"), reach), F.max_by(F.col("upto") - F.col("words"), "bucket")).alias("low"),
        F.coalesce(F.min_by("words", reach), F.max_by("words", "bucket")).alias("inside"),
    )
    return chosen


def mixed_rows(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes it."""
    own = {name: f"__own_{name}" for name in ADDED if name in docs.columns}
    taken = mix(docs.withColumnsRenamed(own)).withColumnRenamed("copies", "__copies")
    again = taken.filter("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return again.select(*(F.col(own.get(name, name)).alias(name) for name in docs.columns))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{folder}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")
