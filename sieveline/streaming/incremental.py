"""Structured Streaming forms of the incremental operators; each equals its batch form over the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.plans.runtime import stage_path, table


def stream_of(spark: SparkSession, path: str, files_per_trigger: int = 4) -> DataFrame:
    """A stream over Parquet files; timestamps without zone become UTC instants, as watermarks need."""
    kind = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
    reader = spark.readStream.schema(kind).option("maxFilesPerTrigger", files_per_trigger)
    s = reader.parquet(path) if whole else reader.option("pathGlobFilter", name).parquet(folder)
    return s.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in kind])


def run_to_end(stream: DataFrame, mode: str) -> DataFrame:
    """Drive a stream over all present files and return what it wrote; checkpoints lie in the shared folder."""
    spark = stream.sparkSession
    out, state = stage_path(spark, "stream-out"), stage_path(spark, "stream-state")
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    else:
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", state).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def tumbling_counts(events: DataFrame, size: str = "1 day") -> DataFrame:
    w = events.withWatermark("ts", "2 days").groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def q_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return run_to_end(tumbling_counts(stream_of(spark, f"{d}/events.parquet")), "complete")


def q_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of each user with gaps of at most six hours; the log's end closes them all."""
    s = stream_of(spark, f"{d}/events.parquet").withWatermark("ts", "1 day").groupBy(F.session_window("ts", "6 hours"), "user_id").agg(F.count("*").alias("n"))
    sessions = run_to_end(s.select("user_id", F.col("session_window.start").alias("start"), "n"), "complete")
    return sessions.groupBy("n").agg(F.count("*").alias("sessions"))


def q_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Distinct texts of the corpus as a stream that drops repeats by hash."""
    s = stream_of(spark, f"{d}/documents.parquet").where("text is not null").select(F.md5("text").alias("h")).dropDuplicates(["h"])
    return run_to_end(s, "append")


def upsert_stream(stream: DataFrame, key: str, target: str) -> None:
    """Keep the newest row of each key in ``target``: every micro-batch rebuilds the table beside it and swaps."""
    from sieveline.operators.loading import upsert

    spark = stream.sparkSession
    current = {"path": ""}

    def merge(df: DataFrame, _: int) -> None:
        new = df.dropDuplicates([key])
        rows = upsert(spark.read.parquet(current["path"]), new, key) if current["path"] else new
        path = f"{target}/v-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(path)
        current["path"] = path

    stream.writeStream.option("checkpointLocation", stage_path(spark, "stream-state")).foreachBatch(merge).trigger(availableNow=True).start().awaitTermination()


def batch_tumbling(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))


QUERIES = {"stream_tumbling_counts": q_tumbling, "stream_session_counts": q_sessions, "stream_dedup": q_dedup}

SQL = {
    "stream_tumbling_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_session_counts": """SELECT n, count(*) AS sessions FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
        SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY ALL) GROUP BY 1""",
    "stream_dedup": "SELECT DISTINCT md5(text) AS h FROM documents WHERE text IS NOT NULL",
}
