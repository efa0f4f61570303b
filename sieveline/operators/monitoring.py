"""Embedding drift between a reference distribution and recent queries: centroid, per-dimension shift, two-sample
Kolmogorov-Smirnov share, and the composite flag. Vectors are exploded to (dim, value) once and aggregated."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.plans.runtime import table

CENTROID_LIMIT, SHIFT_LIMIT, SHARE_LIMIT, MIN_QUERIES = 0.15, 2.0, 0.30, 20


def long_form(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    return vectors.where(f"{column} is not null").select(F.posexplode(column).alias("dim", "value")).select("dim", F.col("value").cast("double").alias("value"))


def per_dimension(vectors: DataFrame) -> DataFrame:
    """(dim, mean, std) with the population deviation."""
    return long_form(vectors).groupBy("dim").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def centroid_distance(reference: DataFrame, current: DataFrame) -> Column | DataFrame:
    """One row: 1 - cosine of the mean vectors."""
    j = reference.select("dim", F.col("mean").alias("r")).join(current.select("dim", F.col("mean").alias("c")), "dim")
    return j.agg((1 - F.sum(F.col("r") * F.col("c")) / F.sqrt(F.sum(F.col("r") ** 2) * F.sum(F.col("c") ** 2))).alias("centroid_distance"))


def shift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(dim, shift): the means' distance in reference deviations, which count as 1e-8 at least."""
    j = reference.join(current.select("dim", F.col("mean").alias("now")), "dim")
    return j.select("dim", (F.abs(F.col("now") - F.col("mean")) / F.greatest("std", F.lit(1e-8))).alias("shift"))


def ks(reference: DataFrame, current: DataFrame, alpha: float = 0.05) -> DataFrame:
    """(dim, statistic, drifted): the two-sample statistic against its asymptotic critical value."""
    both = long_form(reference).groupBy("dim", "value").agg(F.count("*").alias("r"), F.lit(0).cast("bigint").alias("c")).union(long_form(current).groupBy("dim", "value").agg(F.lit(0).cast("bigint").alias("r"), F.count("*").alias("c")))
    steps = both.groupBy("dim", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    upto = Window.partitionBy("dim").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("dim")
    f = steps.select("dim", F.abs(F.sum("r").over(upto) / F.sum("r").over(whole) - F.sum("c").over(upto) / F.sum("c").over(whole)).alias("d"), F.sum("r").over(whole).alias("n"), F.sum("c").over(whole).alias("m"))
    critical = math.sqrt(-math.log(alpha / 2) / 2)
    return f.groupBy("dim").agg(F.max("d").alias("statistic"), F.first("n").alias("n"), F.first("m").alias("m")).select("dim", "statistic", (F.col("statistic") > critical * F.sqrt((F.col("n") + F.col("m")) / (F.col("n") * F.col("m")))).alias("drifted"))


def composite(reference: DataFrame, current: DataFrame) -> DataFrame:
    """One row: the three measures, their breaches and the flag (two of three); skipped below MIN_QUERIES."""
    ref, now = per_dimension(reference), per_dimension(current)
    one = centroid_distance(ref, now).join(shift(ref, now).agg(F.percentile("shift", 0.95).alias("shift_p95"))).join(ks(reference, current).agg(F.avg(F.col("drifted").cast("int")).alias("drift_share"))).join(current.agg(F.count("*").alias("n_queries")))
    breaches = F.array_compact(F.array(F.when(F.col("centroid_distance") > CENTROID_LIMIT, F.lit("centroid")), F.when(F.col("shift_p95") > SHIFT_LIMIT, F.lit("shift")), F.when(F.col("drift_share") > SHARE_LIMIT, F.lit("share"))))
    out = one.withColumn("breaches", F.array_join(breaches, ",")).withColumn("status", F.when(F.col("n_queries") < MIN_QUERIES, "skipped").when(F.size(breaches) >= 2, "drift").otherwise("stable"))
    return out.select(F.round("centroid_distance", 6).alias("centroid_distance"), F.round("shift_p95", 6).alias("shift_p95"), F.round("drift_share", 6).alias("drift_share"), "n_queries", "breaches", "status")


# --- queries: vectors of labels below 5 are the reference, the others the current week ----------------
def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings")
    return e.where("label % 2 = 0").select("embedding"), e.where("label % 2 = 1").select("embedding")


def q_centroid(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    return centroid_distance(per_dimension(a), per_dimension(b)).select(F.round("centroid_distance", 6).alias("centroid_distance"))


def q_per_dim(spark: SparkSession, d: str) -> DataFrame:
    return per_dimension(_sides(spark, d)[0]).select(F.col("dim").cast("bigint").alias("dim"), F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"))


def q_shift(spark: SparkSession, d: str) -> DataFrame:
    a, b = map(per_dimension, _sides(spark, d))
    return shift(a, b).agg(F.round(F.percentile("shift", 0.95), 6).alias("shift_p95"))


def q_ks(spark: SparkSession, d: str) -> DataFrame:
    return ks(*_sides(spark, d)).select(F.col("dim").cast("bigint").alias("dim"), F.round("statistic", 9).alias("statistic"), "drifted")


def q_composite(spark: SparkSession, d: str) -> DataFrame:
    return composite(*_sides(spark, d))


def q_lookback(spark: SparkSession, d: str) -> DataFrame:
    """Logged queries with a vector in the seven days before the newest entry, by week."""
    logs = table(spark, d, "query_logs")
    newest = logs.agg(F.max("logged_at").alias("as_of"))
    near = logs.where("query_embedding is not null").join(F.broadcast(newest)).where(F.col("logged_at") >= F.col("as_of") - F.expr("INTERVAL 7 DAYS"))  # newest is one row
    return near.groupBy(F.date_format(F.date_trunc("week", "logged_at"), "yyyy-MM-dd").alias("week_start")).agg(F.count("*").alias("n"))


def q_latency(spark: SparkSession, d: str) -> DataFrame:
    """Latency quantiles of the log by day; entries without a measurement are left out."""
    logs = table(spark, d, "query_logs").where("latency_ms >= 0").dropDuplicates(["id"])
    return logs.groupBy(F.date_format("logged_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.round(F.percentile("latency_ms", 0.5), 3).alias("p50"), F.round(F.percentile("latency_ms", 0.95), 3).alias("p95"))


_LONG = "SELECT generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings WHERE label % 2 = {0} AND embedding IS NOT NULL"
_DIM = "SELECT dim, avg(value) AS mean, stddev_pop(value) AS std FROM ({0}) GROUP BY 1"
_AB = f"a AS ({_LONG.format(0)}), b AS ({_LONG.format(1)}), ra AS ({_DIM.format('SELECT * FROM a')}), rb AS ({_DIM.format('SELECT * FROM b')})"
_CENTROID = "SELECT 1 - sum(ra.mean * rb.mean) / sqrt(sum(ra.mean ** 2) * sum(rb.mean ** 2)) AS centroid_distance FROM ra JOIN rb USING (dim)"
_SHIFT = "SELECT quantile_cont(abs(rb.mean - ra.mean) / greatest(ra.std, 1e-8), 0.95) AS shift_p95 FROM ra JOIN rb USING (dim)"
_KS = """SELECT dim, max(abs(fr / n - fc / m)) AS statistic, max(abs(fr / n - fc / m)) > sqrt(-ln(0.025) / 2) * sqrt((any_value(n) + any_value(m)) / (any_value(n) * any_value(m))) AS drifted FROM (
    SELECT dim, sum(r) OVER u AS fr, sum(c) OVER u AS fc, (sum(r) OVER (PARTITION BY dim))::DOUBLE AS n, (sum(c) OVER (PARTITION BY dim))::DOUBLE AS m
    FROM (SELECT dim, value, sum(r) AS r, sum(c) AS c FROM (SELECT dim, value, 1 AS r, 0 AS c FROM a UNION ALL SELECT dim, value, 0, 1 FROM b) GROUP BY ALL)
    WINDOW u AS (PARTITION BY dim ORDER BY value ROWS UNBOUNDED PRECEDING)) GROUP BY dim"""

QUERIES = {"centroid_distance": q_centroid, "per_dim_stats": q_per_dim, "per_dim_shift_p95": q_shift, "ks_drift_share": q_ks, "drift_composite": q_composite, "lookback_window": q_lookback, "latency_quantiles": q_latency}

SQL = {
    "centroid_distance": f"WITH {_AB} SELECT round(centroid_distance, 6) AS centroid_distance FROM ({_CENTROID})",
    "per_dim_stats": f"WITH {_AB} SELECT dim, round(mean, 8) AS mean, round(std, 8) AS std FROM ra",
    "per_dim_shift_p95": f"WITH {_AB} SELECT round(shift_p95, 6) AS shift_p95 FROM ({_SHIFT})",
    "ks_drift_share": f"WITH {_AB} SELECT dim, round(statistic, 9) AS statistic, drifted FROM ({_KS})",
    "drift_composite": f"""WITH {_AB}, one AS (SELECT * FROM ({_CENTROID}), ({_SHIFT}), (SELECT avg(drifted::INT) AS drift_share FROM ({_KS})), (SELECT count(*) AS n_queries FROM embeddings WHERE label % 2 = 1))
        SELECT round(centroid_distance, 6) AS centroid_distance, round(shift_p95, 6) AS shift_p95, round(drift_share, 6) AS drift_share, n_queries,
        concat_ws(',', CASE WHEN centroid_distance > 0.15 THEN 'centroid' END, CASE WHEN shift_p95 > 2.0 THEN 'shift' END, CASE WHEN drift_share > 0.3 THEN 'share' END) AS breaches,
        CASE WHEN n_queries < 20 THEN 'skipped' WHEN (centroid_distance > 0.15)::INT + (shift_p95 > 2.0)::INT + (drift_share > 0.3)::INT >= 2 THEN 'drift' ELSE 'stable' END AS status FROM one""",
    "lookback_window": "SELECT strftime(date_trunc('week', logged_at AT TIME ZONE 'UTC'), '%Y-%m-%d') AS week_start, count(*) AS n FROM query_logs WHERE query_embedding IS NOT NULL AND logged_at >= (SELECT max(logged_at) FROM query_logs) - INTERVAL 7 DAYS GROUP BY 1",
    "latency_quantiles": "SELECT strftime(logged_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, count(*) AS n, round(quantile_cont(latency_ms, 0.5), 3) AS p50, round(quantile_cont(latency_ms, 0.95), 3) AS p95 FROM (SELECT DISTINCT ON (id) * FROM query_logs WHERE latency_ms >= 0) GROUP BY 1",
}
