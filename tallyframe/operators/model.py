"""Which attributes drive a 0/1 outcome: split, pipeline, hold-out score, importances."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tallyframe.plans.cutoff import cutoffs
from tallyframe.plans.hold import held
from tallyframe.plans.ordered import exact_median, running_total

RARE = "__rare__"

# Hold-out share, share below which a level is rare, forest size, seed, depth (the most Spark allows).
TEST_SHARE = "0.2"
RARE_SHARE = "0.01"
TREES = 200
SEED = 42
DEPTH = 30


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: str = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """``df`` with ``is_test``: in each class exactly the ceiling of the share.

    Rows go by the hash of key and seed, so the split repeats on any cluster
    and does not change when columns are added. The last hash of each class
    that is still in the test rows is found by histograms: no row is moved, and
    the result is a filter-like column on ``df``, which is read a few times.
    ``key`` tells rows apart; rows of one key fall on the same side. ``label``
    has a few values.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    # The first 60 bits put digests in the order of their text.
    lead = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    mixed = df.select(F.col(label).alias("__label"), F.col(key).alias("__key"), digest.alias("__mix"), lead.alias("__lead"))
    sizes = {row[0]: row[1] for row in mixed.groupBy("__label").agg(F.count(F.lit(1))).collect()}
    wanted = {label: math.ceil(size * Decimal(test_share)) for label, size in sizes.items()}
    is_test = F.lit(True)
    for value, cut in cutoffs(mixed, "__lead", wanted, "__label").items():
        inside = F.lit(wanted[value] > 0)
        if cut is not None:
            last = (
                mixed.filter(F.col("__label").eqNullSafe(F.lit(value)) & (F.col("__lead") == cut.value))
                .select("__mix", "__key").orderBy("__mix", "__key").limit(cut.ties).orderBy(F.desc("__mix"), F.desc("__key")).first()
            )
            at_end = (digest < last["__mix"]) | ((digest == last["__mix"]) & (F.col(key) <= F.lit(last["__key"])))
            inside = (lead < cut.value) | ((lead == cut.value) & at_end)
        is_test = F.when(F.col(label).eqNullSafe(F.lit(value)), inside).otherwise(is_test)
    return df.withColumn("is_test", is_test)


def common_levels(
    df: DataFrame, columns: Sequence[str], min_share: str = RARE_SHARE
) -> dict[str, list[str]]:
    """Per text column the levels holding at least the share of rows.

    One pass for all columns. At most 1 / share levels per column come back,
    whatever the data, so the lists are small enough to be literals.
    """
    if not columns:
        return {}
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    common = (
        df.select(*columns)
        .unpivot([], list(columns), "column", "level")
        .filter(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= rows * F.lit(Decimal(min_share)))
    )
    out: dict[str, list[str]] = {column: [] for column in columns}
    for row in common.orderBy("column", "level").collect():
        out[row["column"]].append(row["level"])
    return out


def group_rare_levels(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every level outside the given lists, missing included, under one name.

    With lists taken from the training rows, a level only later rows have is
    rare too.
    """
    return df.withColumns(
        {c: F.when(F.col(c).isin(list(known)), F.col(c)).otherwise(RARE) for c, known in levels.items()}
    )


def balanced_weights(df: DataFrame, label: str, into: str = "weight") -> DataFrame:
    """Row weight n / (2 x rows of its class): both classes weigh the same."""
    n = F.count(F.lit(1))
    ones = F.sum(F.col(label).cast("double"))
    counts = df.agg(F.struct(n.alias("all"), ones.alias("ones")).alias("c")).scalar()
    size = F.when(F.col(label) == 1, counts["ones"]).otherwise(counts["all"] - counts["ones"])
    return df.withColumn(into, counts["all"] / (2 * size))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column, the mean of the two middle values if even; None without a value.

    All columns in one pass for the enclosing sketches and one for what lies
    between them. NaN counts as missing.
    """
    if not columns:
        return {}
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns}
    long = df.select(*values.values()).unpivot([], list(columns), "column", "value")
    found = {row["column"]: row["median"] for row in exact_median(long, "value", "column").collect()}  # one row a column
    return {c: found.get(c) for c in columns}


def fill_medians(df: DataFrame, middle: Mapping[str, float | None]) -> DataFrame:
    """Missing numbers (NULL or NaN) replaced by the given medians."""
    return df.withColumns(
        {c: F.when(F.isnan(F.col(c).cast("double")), F.lit(m)).otherwise(F.coalesce(F.col(c).cast("double"), F.lit(m))) for c, m in middle.items()}
    )


def daily_sketches(df: DataFrame, day: str, columns: Sequence[str], k: int = 400) -> DataFrame:
    """A mergeable quantile sketch of each column and day, to be kept: (day, column, sketch)."""
    long = df.select(day, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot([day], list(columns), "column", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy(day, "column").agg(
        F.kll_sketch_agg_double("value", k).alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, share: float = 0.5, by: str = "column") -> DataFrame:
    """Quantile of kept sketches merged over all their days, and the rows it stands for."""
    merged = sketches.groupBy(by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(
        by, F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("quantile"), F.kll_sketch_get_n_double("sketch").alias("n")
    )


def rank_sum_auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, as one row (``auc``).

    Rows are counted by score first; the counts of lower scores come from a
    running total over range-partitioned distinct scores. NULL if a class has
    no rows. NULL labels and scores are left out.
    """
    ones = F.count(F.when(F.col(label) == 1, 1))
    rows = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = rows.groupBy(F.col(score).alias("s")).agg(ones.alias("ones"), (F.count(F.lit(1)) - ones).alias("zeros"))
    ranked = running_total(counts, "zeros", "s", into="upto")
    wide = lambda c: c.cast("decimal(19,0)")
    twice = wide(F.col("ones")) * wide(2 * F.col("upto") - F.col("zeros"))
    return ranked.agg(
        F.sum(twice).cast("double").alias("twice"), F.sum("ones").cast("double").alias("ones"), F.sum("zeros").cast("double").alias("zeros")
    ).select(F.try_divide(F.col("twice"), 2 * F.col("ones") * F.col("zeros")).alias("auc"))


@dataclass
class FittedModel:
    model: PipelineModel
    auc: float
    importances: DataFrame


def _pipeline(text: Sequence[str], middle: Mapping[str, float | None], trees: int, depth: int, seed: int) -> Pipeline:
    numbers = list(middle)
    stages = []
    if text:
        indexer = StringIndexer(
            inputCols=list(text), outputCols=[f"{c}__ix" for c in text], handleInvalid="keep"
        )
        encoder = OneHotEncoder(
            inputCols=[f"{c}__ix" for c in text], outputCols=[f"{c}__oh" for c in text],
            dropLast=True, handleInvalid="keep",
        )
        stages += [indexer, encoder]
    if numbers:
        # A column without any value gets 0. NaN is missing too.
        filled = ", ".join(f"coalesce(nanvl(`{c}`, NULL), {m or 0.0!r}D) AS `{c}__im`" for c, m in middle.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
    features = [f"{c}__oh" for c in text] + [f"{c}__im" for c in numbers]
    stages.append(VectorAssembler(inputCols=features, outputCol="features"))
    stages.append(
        RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight",
            numTrees=trees, maxDepth=depth, seed=seed,
        )
    )
    return Pipeline(stages=stages)


def named_importances(model: PipelineModel, scored: DataFrame, top: int | None = None) -> DataFrame:
    """Feature names with the forest's importances, largest first.

    As many rows as features, which rare-level grouping bounds.
    """
    groups = scored.schema["features"].metadata["ml_attr"]["attrs"].values()
    names = {attr["idx"]: attr["name"] for group in groups for attr in group}
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(names[i].replace("__oh_", "=").replace("__im", ""), float(w)) for i, w in enumerate(weights)]
    frame = scored.sparkSession.createDataFrame(rows, "feature string, importance double")
    ordered = frame.orderBy(F.col("importance").desc(), "feature")
    return ordered if top is None else ordered.limit(top)


def fit_drivers(
    df: DataFrame,
    key: str,
    label: str,
    text: Sequence[str] = (),
    numbers: Sequence[str] = (),
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    top: int | None = None,
) -> FittedModel:
    """Fit a balanced random forest on 80 % of the rows and score it on the rest.

    A missing label reads as 0. Training never leaves Spark ML.
    """
    rows = df.select(
        key,
        F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("label"),
        *text,
        *[F.col(c).cast("double").alias(c) for c in numbers],
    )
    split = stratified_split(rows, key, "label", seed=seed)
    levels = common_levels(split.filter(~F.col("is_test")), text)
    coded = group_rare_levels(split, levels)
    train = balanced_weights(coded.filter(~F.col("is_test")), "label")
    # Indexers, imputer and forest each pass over the training rows.
    with held(train) as kept:
        middle = medians(kept, numbers)
        fitted = _pipeline(text, middle, trees, depth, seed).fit(kept)
    # The copy leaves the training summary behind. It holds the session, which
    # cannot be sent to executors once the session has observed a query.
    model = fitted.copy()
    scored = model.transform(coded.filter("is_test").withColumn("weight", F.lit(1.0)))
    sure = scored.select("label", vector_to_array("probability")[1].alias("score"))
    auc = rank_sum_auc(sure, "label", "score").first()["auc"]
    return FittedModel(model, auc, named_importances(model, scored, top))
