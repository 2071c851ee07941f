"""Split and importance over labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import model
from tallyframe.queries.registry import Tables, query


@query("q_stratified_split", """
    SELECT doc_id, quality, rn <= CEIL(n * 0.2) AS is_test FROM (
        SELECT doc_id, quality, COUNT(*) OVER (PARTITION BY quality) AS n,
               ROW_NUMBER() OVER (PARTITION BY quality
                                  ORDER BY MD5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS rn
        FROM labels) t""")
def stratified_split(t: Tables):
    return model.stratified_split(t.labels.select("doc_id", "quality"), "doc_id", "quality")


# A forest's weights are no query; their names and what they sum to are.
@query("q_importances", """
    WITH rows AS (
        SELECT d.lang, d.source, l.quality,
               ROW_NUMBER() OVER (PARTITION BY l.quality ORDER BY MD5(CAST(d.doc_id AS VARCHAR) || ':42'), d.doc_id)
                   <= CEIL(COUNT(*) OVER (PARTITION BY l.quality) * 0.2) AS is_test
        FROM documents d JOIN labels l USING (doc_id)),
    train AS (SELECT lang, source FROM rows WHERE NOT is_test),
    levels AS (
        SELECT 'lang=' || lang AS feature, COUNT(*) AS n FROM train GROUP BY lang
        UNION ALL SELECT 'source=' || source, COUNT(*) FROM train GROUP BY source)
    SELECT feature, CAST(1.0 AS DOUBLE) AS total FROM levels
    WHERE n >= 0.01 * (SELECT COUNT(*) FROM train)
    UNION ALL SELECT 'n_chars', CAST(1.0 AS DOUBLE)""")
def importances(t: Tables):
    """Every feature of the forest with the sum of all importances."""
    fitted = model.fit_drivers(
        t.labelled, "doc_id", "quality", text=["lang", "source"], numbers=["n_chars"], depth=5
    )
    # The indexer adds a level of its own for the unseen.
    extra = F.col("feature").endswith(f"={model.RARE}") | F.col("feature").endswith("=__unknown")
    named = fitted.importances.filter(~extra)
    whole = fitted.importances.agg(F.round(F.sum("importance"), 6).alias("total"))
    return named.select("feature", whole.scalar().alias("total"))


_GAPPED = "(SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars AS DOUBLE) END AS n_chars, doc_id * doc_id % 97 * 1.0::DOUBLE AS mark FROM documents)"


@query("q_impute_median", f"""
    SELECT doc_id, COALESCE(n_chars, (SELECT MEDIAN(n_chars) FROM {_GAPPED} g)) AS n_chars, mark FROM {_GAPPED} t""")
def impute_median(t: Tables):
    """Every fifth length is missing and takes the exact median of the others."""
    gapped = t.documents.select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("n_chars").cast("double")).alias("n_chars"),
        (F.col("doc_id") * F.col("doc_id") % 97).cast("double").alias("mark"),
    )
    return model.fill_medians(gapped, model.medians(gapped, ["n_chars", "mark"]))


@query("q_rare_levels", """
    WITH marked AS (SELECT doc_id, lang, source || CASE WHEN doc_id % 150 = 7 THEN '-' || doc_id ELSE '' END AS source FROM documents),
    many AS (SELECT source FROM marked GROUP BY source HAVING COUNT(*) >= 0.01 * (SELECT COUNT(*) FROM marked))
    SELECT doc_id, CASE WHEN (SELECT COUNT(*) FROM marked m WHERE m.lang = marked.lang) >= 0.01 * (SELECT COUNT(*) FROM marked)
                        THEN lang ELSE '__rare__' END AS lang,
           CASE WHEN source IN (SELECT source FROM many) THEN source ELSE '__rare__' END AS source
    FROM marked""")
def rare_levels(t: Tables):
    """Levels with under a hundredth of the rows, missing included, under one name."""
    odd = F.when(F.col("doc_id") % 150 == 7, F.concat(F.lit("-"), "doc_id")).otherwise("")
    marked = t.documents.select("doc_id", "lang", F.concat("source", odd).alias("source"))
    return model.group_rare_levels(marked, model.common_levels(marked, ["lang", "source"]))


@query("q_class_weights", """
    SELECT doc_id, toxic, (SELECT COUNT(*) FROM labels) / (2.0::DOUBLE * COUNT(*) OVER (PARTITION BY toxic)) AS weight FROM labels""")
def class_weights(t: Tables):
    return model.balanced_weights(t.labels.select("doc_id", "toxic"), "toxic")


@query("q_auc", """
    WITH scored AS (SELECT l.quality, d.n_chars // 50 AS score FROM documents d JOIN labels l USING (doc_id)),
    levels AS (SELECT score, COUNT(*) FILTER (quality = 1) AS ones, COUNT(*) FILTER (quality <> 1) AS zeros FROM scored GROUP BY score)
    SELECT SUM(ones * (2 * below + zeros))::DOUBLE / (2 * SUM(ones)::DOUBLE * SUM(zeros)::DOUBLE) AS auc
    FROM (SELECT *, SUM(zeros) OVER (ORDER BY score) - zeros AS below FROM levels) t""")
def auc(t: Tables):
    """How well length tells good documents: rounded down to fifties, so many tie."""
    scored = t.labelled.select("quality", F.floor(F.col("n_chars") / 50).alias("score"))
    return model.rank_sum_auc(scored, "quality", "score")
