"""Ranking metrics over (query, item, grade) judgements and ranked results, by slice, and what is decided from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.operators.retrieval import _DENSE, _dense
from sieveline.plans.runtime import table

KS = (5, 10, 15)


def per_query(results: DataFrame, judgements: DataFrame, queries: DataFrame, k: int, threshold: int = 1) -> DataFrame:
    """(query_id, category, rr, recall, precision, ndcg) at k; recall is NULL without relevant items.

    Precision divides by the items returned, an unjudged item has grade 0, NDCG uses gains 2^g - 1.
    """
    top = results.where(F.col("rank") <= k).join(judgements, ["query_id", "item_id"], "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    gain = (F.pow(F.lit(2.0), "grade") - 1) / F.log2(F.col("rank") + 1)
    got = top.groupBy("query_id").agg(
        F.min(F.when(F.col("grade") >= threshold, F.col("rank"))).alias("first"), F.count_if(F.col("grade") >= threshold).alias("hits"), F.count("*").alias("returned"), F.sum(gain).alias("dcg")
    )
    ideal = judgements.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("grade"), "item_id")))
    best = ideal.groupBy("query_id").agg(F.count_if(F.col("grade") >= threshold).alias("relevant"), F.sum(F.when(F.col("rank") <= k, gain)).alias("idcg"))
    both = queries.join(got, "query_id", "left").join(best, "query_id", "left")
    return both.select(
        "query_id",
        "category",
        F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("rr"),
        F.when(F.col("relevant") > 0, F.coalesce("hits", F.lit(0)) / F.col("relevant")).alias("recall"),
        F.coalesce(F.col("hits") / F.col("returned"), F.lit(0.0)).alias("precision"),
        F.when(F.col("idcg") > 0, F.coalesce("dcg", F.lit(0.0)) / F.col("idcg")).otherwise(0.0).alias("ndcg"),
    )


def summary(scores: DataFrame) -> DataFrame:
    """Means over all queries and by category in one pass; the overall row has category '*'."""
    means = [F.round(F.avg(c), 4).alias(n) for c, n in (("rr", "mrr"), ("recall", "recall"), ("precision", "precision"), ("ndcg", "ndcg"))]
    return scores.rollup("category").agg(F.count("*").alias("n_queries"), *means, F.grouping("category").alias("g")).withColumn("category", F.when(F.col("g") == 1, "*").otherwise(F.col("category"))).drop("g")


def bias(by_category: DataFrame, metric: str = "ndcg", gap: float = 0.1) -> DataFrame:
    """(category, value, mean, disparity, below) for categories; none below a minimum of two categories."""
    w = Window.partitionBy()
    c = by_category.where("category <> '*'").select("category", F.col(metric).alias("value"))
    out = c.select("category", "value", F.round(F.avg("value").over(w), 6).alias("mean"), F.round(F.max("value").over(w) - F.min("value").over(w), 6).alias("disparity"), F.count("*").over(w).alias("n"))
    return out.where("n >= 2").withColumn("below", F.col("value") < F.col("mean") - gap).drop("n")


def separation(results: DataFrame, judgements: DataFrame) -> DataFrame:
    """Mean score by grade, of unjudged items, and between grades 2 and 0, at four places."""
    j = results.join(judgements, ["query_id", "item_id"], "left")
    mean = {n: F.avg(F.when(F.col("grade") == g, F.col("score"))) for g, n in ((0, "grade_0"), (1, "grade_1"), (2, "grade_2"))}
    return j.agg(*[F.round(c, 4).alias(n) for n, c in mean.items()], F.round(F.avg(F.when(F.col("grade").isNull(), F.col("score"))), 4).alias("unjudged"), F.round(mean["grade_2"] - mean["grade_0"], 4).alias("separation"))


def selection_score(ndcg10: F.Column, recall10: F.Column, mrr5: F.Column, storage_mb: F.Column) -> F.Column:
    storage = F.least(F.lit(1.0), 120 / F.greatest(F.coalesce(storage_mb, F.lit(60.0)), F.lit(1.0)))
    return F.round(0.47 * ndcg10 + 0.29 * recall10 + 0.18 * mrr5 + 0.06 * storage, 4)


# --- queries: an item is relevant if it has the query's label, grade 2 where its id is even -----------
def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "label")
    q = e.where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), "label")
    judgements = q.join(e, "label").select("query_id", "item_id", F.when(F.col("item_id") % 2 == 0, 2).when(F.col("item_id") % 3 == 0, 1).otherwise(0).alias("grade"))
    return judgements, q.select("query_id", F.concat(F.lit("c"), F.pmod("label", F.lit(4)).cast("string")).alias("category"))


def _scores(spark: SparkSession, d: str, k: int) -> DataFrame:
    judgements, queries = _judged(spark, d)
    return per_query(_dense(spark, d, 15), judgements, queries, k)


def q_per_query(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d, 10).select("query_id", "category", *[F.round(c, 6).alias(c) for c in ("rr", "recall", "precision", "ndcg")])


def q_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for k in KS:
        part = summary(_scores(spark, d, k)).withColumn("k", F.lit(k).cast("bigint"))
        out = part if out is None else out.union(part)
    return out


def q_bias(spark: SparkSession, d: str) -> DataFrame:
    return bias(summary(_scores(spark, d, 10)))


def q_separation(spark: SparkSession, d: str) -> DataFrame:
    return separation(_dense(spark, d, 15), _judged(spark, d)[0])


def q_detail(spark: SparkSession, d: str) -> DataFrame:
    j = _dense(spark, d, 10).join(_judged(spark, d)[0], ["query_id", "item_id"], "left")
    grades = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.coalesce("grade", F.lit(-1)).alias("g")))), lambda x: x["g"].cast("string")), ",")
    return j.groupBy("query_id").agg(F.count_if(F.col("grade") >= 1).alias("relevant_in_top"), F.min_by("item_id", "rank").alias("top_item"), F.min_by("score", "rank").alias("top_score"), grades.alias("grades"))


def q_selection(spark: SparkSession, d: str) -> DataFrame:
    """Three configurations (depth of the result list) ranked by their selection score, and the gate."""
    judgements, queries = _judged(spark, d)
    dense, rows = _dense(spark, d, 15), None
    n = table(spark, d, "embeddings").count()
    for name, depth, is_open in (("deep", 15, True), ("middle", 8, False), ("shallow", 3, True)):
        cut = dense.where(F.col("rank") <= depth)
        ten = per_query(cut, judgements, queries, 10).agg(F.avg("ndcg").alias("ndcg10"), F.avg("recall").alias("recall10"))
        five = per_query(cut, judgements, queries, 5).agg(F.avg("rr").alias("mrr5"))
        one = ten.join(five).select(F.lit(name).alias("config"), F.lit(is_open).alias("open"), F.col("ndcg10"), selection_score(F.col("ndcg10"), F.col("recall10"), F.col("mrr5"), F.lit(round(n * (64 * 4 + 64) / 2**20, 2))).alias("score"))
        rows = one if rows is None else rows.union(one)
    w = Window.partitionBy().orderBy(F.desc("score"), "config")
    ranking = rows.withColumn("rank", F.row_number().over(w)).withColumn("best", F.first("ndcg10").over(w))
    first_open = F.min(F.when(F.col("open"), F.col("rank"))).over(Window.partitionBy())
    gap = (F.col("best") - F.col("ndcg10")) / F.col("best")
    return ranking.select("config", "score", F.col("rank").cast("bigint").alias("rank"), F.when(F.col("best") > 0, (F.col("rank") == first_open) & (gap <= 0.05)).otherwise(False).alias("recommended"))


_JUDGED = """j AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, CASE WHEN e.vec_id % 2 = 0 THEN 2 WHEN e.vec_id % 3 = 0 THEN 1 ELSE 0 END AS grade FROM embeddings q JOIN embeddings e USING (label) WHERE q.vec_id % 20 = 0),
    q AS (SELECT vec_id AS query_id, 'c' || (label % 4) AS category FROM embeddings WHERE vec_id % 20 = 0)"""
_SCORES = """SELECT q.query_id, category, {k} AS k, coalesce(1.0::DOUBLE / first, 0) AS rr, CASE WHEN relevant > 0 THEN coalesce(hits, 0)::DOUBLE / relevant END AS recall, coalesce(hits::DOUBLE / returned, 0) AS "precision", CASE WHEN idcg > 0 THEN coalesce(dcg, 0) / idcg ELSE 0 END AS ndcg
    FROM q LEFT JOIN (SELECT query_id, min(rank) FILTER (coalesce(grade, 0) >= 1) AS first, count(*) FILTER (coalesce(grade, 0) >= 1) AS hits, count(*) AS returned, sum((pow(2.0, coalesce(grade, 0)) - 1) / log2(rank + 1)) AS dcg FROM {dense} LEFT JOIN j USING (query_id, item_id) WHERE rank <= {k} GROUP BY 1) USING (query_id)
    LEFT JOIN (SELECT query_id, count(*) FILTER (grade >= 1) AS relevant, sum((pow(2.0, grade) - 1) / log2(r + 1)) FILTER (r <= {k}) AS idcg FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, item_id) AS r FROM j) GROUP BY 1) USING (query_id)"""
_HEAD = f"WITH {_DENSE.format(k=15)}, {_JUDGED}"
_MEANS = 'count(*) AS n_queries, round(avg(rr), 4) AS mrr, round(avg(recall), 4) AS recall, round(avg("precision"), 4) AS "precision", round(avg(ndcg), 4) AS ndcg'

QUERIES = {"metrics_per_query": q_per_query, "metrics_by_category": q_metrics, "bias_report": q_bias, "score_separation": q_separation, "per_query_detail": q_detail, "selection_gate": q_selection}

SQL = {
    "metrics_per_query": f'{_HEAD} SELECT query_id, category, round(rr, 6) AS rr, round(recall, 6) AS recall, round("precision", 6) AS "precision", round(ndcg, 6) AS ndcg FROM ({_SCORES.format(k=10, dense="dense")})',
    "metrics_by_category": f"{_HEAD}, s AS (" + " UNION ALL ".join(_SCORES.format(k=k, dense="dense") for k in KS) + f") SELECT coalesce(category, '*') AS category, k, {_MEANS} FROM s GROUP BY GROUPING SETS ((category, k), (k))",
    "bias_report": f"{_HEAD}, c AS (SELECT category, round(avg(ndcg), 4) AS value FROM ({_SCORES.format(k=10, dense='dense')}) GROUP BY 1) SELECT category, value, mean, disparity, value < mean - 0.1 AS below FROM (SELECT category, value, round(avg(value) OVER (), 6) AS mean, round(max(value) OVER () - min(value) OVER (), 6) AS disparity, count(*) OVER () AS n FROM c) WHERE n >= 2",
    "score_separation": f"{_HEAD} SELECT round(avg(score) FILTER (grade = 0), 4) AS grade_0, round(avg(score) FILTER (grade = 1), 4) AS grade_1, round(avg(score) FILTER (grade = 2), 4) AS grade_2, round(avg(score) FILTER (grade IS NULL), 4) AS unjudged, round(avg(score) FILTER (grade = 2) - avg(score) FILTER (grade = 0), 4) AS separation FROM dense LEFT JOIN j USING (query_id, item_id)",
    "per_query_detail": f"{_HEAD} SELECT query_id, count(*) FILTER (grade >= 1) AS relevant_in_top, min_by(item_id, rank) AS top_item, min_by(score, rank) AS top_score, string_agg(coalesce(grade, -1)::VARCHAR, ',' ORDER BY rank) AS grades FROM dense LEFT JOIN j USING (query_id, item_id) WHERE rank <= 10 GROUP BY 1",
}
