"""Where models meet the data: encoding texts, grading pairs with an injected client, tracking, registry lookup."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.plans.runtime import table


def column_name(model: str) -> str:
    """The vector column of a model: the last part of its path, lower case, dashes as underscores."""
    return "embeddings_" + model.rsplit("/", 1)[-1].replace("-", "_").lower()


def hashed_vectors(df: DataFrame, key: str, column: str, size: int = 64) -> DataFrame:
    """(key, embedding): unit vectors of hashed word counts, the stand-in for an encoder where no model is at
    hand. Texts without words have no row."""
    w = df.select(key, F.explode(text.words(F.lower(column))).alias("w")).groupBy(key, F.pmod(F.xxhash64("w"), F.lit(size)).cast("int").alias("slot")).agg(F.count("*").alias("n"))
    g = w.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("m"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return g.select(key, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (F.coalesce(F.element_at("m", i), F.lit(0)) / F.col("norm")).cast("float")).alias("embedding"))


def encode(df: DataFrame, key: str, column: str, encoder: Callable[[list[str]], list[list[float]]], batch: int = 32) -> DataFrame:
    """(key, embedding) by an injected encoder, called with at most ``batch`` texts; NULL texts are left out."""
    kind = dict(df.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                yield pd.DataFrame({key: part[key], "embedding": encoder(part[column].tolist())})

    return df.where(F.col(column).isNotNull()).select(key, column).mapInPandas(run, f"`{key}` {kind}, embedding array<float>")


def grade(pairs: DataFrame, client: Callable[[str, str], int], tries: int = 3, longest: int = 1500) -> DataFrame:
    """(query_id, item_id, grade) of (query_id, item_id, query_text, body) pairs by an injected client; texts are
    cut to ``longest`` characters, a call that keeps failing is graded -1."""

    def one(q: str, b: str) -> int:
        for _ in range(tries):
            try:
                return client(q, b if len(b) <= longest else b[:longest] + "...")
            except Exception:  # noqa: BLE001 - whatever a client raises counts as one failed try
                continue
        return -1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"query_id": f["query_id"], "item_id": f["item_id"], "grade": [one(q or "", b or "") for q, b in zip(f["query_text"], f["body"], strict=True)]})

    return pairs.select("query_id", "item_id", "query_text", "body").mapInPandas(run, "query_id bigint, item_id bigint, grade int")


def overlap_client(query: str, body: str) -> int:
    """A deterministic grader: 2 if half of the query's words occur in the text, 1 if any does, else 0."""
    words = set(query.lower().split())
    n = len(words & set(body.lower().split()))
    return 2 if words and 2 * n >= len(words) else int(n > 0)


def tracked(run: str, row: DataFrame) -> DataFrame:
    """A one-row frame of measures as (run, metric, value) rows."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c, kind in row.dtypes if kind in ("double", "float", "int", "bigint")]
    return row.select(F.lit(run).alias("run"), F.explode(F.array(*cells)).alias("m")).select("run", "m.metric", "m.value")


def latest(runs: DataFrame, name: str, label: str, when: str, config: str) -> DataFrame:
    """The configuration of the newest run whose label holds ``name``, whatever its case."""
    return runs.where(F.lower(label).contains(name.lower())).agg(F.max_by(config, F.struct(when, label)).alias("config"))


def gate(before: Column, after: Column, worst_drop: float = 0.005, least_gain: float = 0.01) -> Column:
    return F.when(before - after > worst_drop, "regression").when(after - before >= least_gain, "promote").otherwise("keep")


# --- queries ------------------------------------------------------------------------------------------
def q_hashed(spark: SparkSession, d: str) -> DataFrame:
    v = hashed_vectors(table(spark, d, "processed_documents").distinct(), "document_id", "title")
    return v.select("document_id", F.size("embedding").cast("bigint").alias("dims"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), 3).alias("norm"))


def q_graded(spark: SparkSession, d: str) -> DataFrame:
    """Logged top results graded by word overlap: how many pairs have which grade."""
    logs = table(spark, d, "query_logs").where("query_text is not null and top_k_chunk_ids is not null").dropDuplicates(["id"])
    chunks = table(spark, d, "document_chunks").where("raw_text is not null").groupBy(F.col("chunk_no").cast("bigint").alias("item_id")).agg(F.min("raw_text").alias("body"))
    pairs = logs.select(F.col("id").cast("bigint").alias("query_id"), "query_text", F.explode(F.array_distinct(F.col("top_k_chunk_ids").cast("array<bigint>"))).alias("item_id")).join(chunks, "item_id")
    return grade(pairs, overlap_client).groupBy("grade").agg(F.count("*").alias("n"))


def q_failures(spark: SparkSession, d: str) -> DataFrame:
    """Share of replies without text by day, whether it exceeds five per cent, and the cost of asking again."""
    logs = table(spark, d, "query_logs").dropDuplicates(["id"])
    bad = F.count_if(text.is_blank(F.col("llm_response")))
    g = logs.groupBy(F.date_format("logged_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), bad.alias("failed"))
    return g.select("month", "n", "failed", (F.col("failed") > 0.05 * F.col("n")).alias("warning"), F.round(F.col("failed") * 0.40 / 5000, 6).alias("cost"))


def q_tracked(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "lineitem").agg(F.count("*").alias("rows"), F.round(F.avg("l_discount"), 6).alias("discount"), F.round(F.max("l_extendedprice"), 2).alias("largest"))
    return tracked("r1", one)


def q_latest(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "scraped_documents").where("title is not null"), "interview", "title", "scrape_batch_id", "record_no")


def q_top_companies(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "processed_documents").where(~text.is_blank(F.col("company")))
    return docs.groupBy("company").agg(F.count("*").alias("n"), F.min("scrape_batch_id").alias("first_batch"), F.max("scrape_batch_id").alias("last_batch")).orderBy(F.desc("n"), "company").limit(10)


def q_gate(spark: SparkSession, d: str) -> DataFrame:
    by = table(spark, d, "embeddings").groupBy("label").agg(F.avg(F.when(F.col("vec_id") % 2 == 0, F.element_at("embedding", 1).cast("double"))).alias("a"), F.avg(F.when(F.col("vec_id") % 2 == 1, F.element_at("embedding", 1).cast("double"))).alias("b"))
    return by.select("label", gate(F.col("a"), F.col("b")).alias("verdict"))


QUERIES = {"hashed_embedding": q_hashed, "graded_results": q_graded, "reply_failures": q_failures, "tracked_metrics": q_tracked, "registry_latest": q_latest, "top_companies": q_top_companies, "regression_gate": q_gate}

_BLANK = r"coalesce(regexp_replace({0}, '[ \t\n\r\f\v]+', '', 'g'), '') = ''"
_W = r"list_filter(string_split_regex(lower({0}), '[ \t\n\r\f\v]+'), lambda x: x <> '')"
SQL = {
    "graded_results": f"""
        WITH l AS (SELECT id, query_text, unnest(list_distinct(top_k_chunk_ids)) AS item_id FROM (SELECT DISTINCT ON (id) * FROM query_logs WHERE query_text IS NOT NULL AND top_k_chunk_ids IS NOT NULL)),
        c AS (SELECT chunk_no AS item_id, min(raw_text) AS b FROM document_chunks WHERE raw_text IS NOT NULL GROUP BY 1),
        j AS (SELECT query_text, CASE WHEN length(b) > 1500 THEN substr(b, 1, 1500) || '...' ELSE b END AS body FROM l JOIN c USING (item_id)),
        w AS (SELECT len(list_distinct({_W.format('query_text')})) AS k, len(list_intersect(list_distinct({_W.format('query_text')}), list_distinct({_W.format('body')}))) AS n FROM j)
        SELECT CASE WHEN k > 0 AND 2 * n >= k THEN 2 WHEN n > 0 THEN 1 ELSE 0 END AS grade, count(*) AS n FROM w GROUP BY 1""",
    "reply_failures": f"SELECT month, n, failed, failed > 0.05 * n AS warning, round(failed * 0.40 / 5000, 6) AS cost FROM (SELECT strftime(logged_at AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*) AS n, count(*) FILTER ({_BLANK.format('llm_response')}) AS failed FROM (SELECT DISTINCT ON (id) * FROM query_logs) GROUP BY 1)",
    "tracked_metrics": "SELECT 'r1' AS run, unnest(['rows', 'discount', 'largest']) AS metric, unnest([count(*)::DOUBLE, round(avg(l_discount), 6), round(max(l_extendedprice), 2)]) AS value FROM lineitem",
    "registry_latest": "SELECT max_by(record_no, (scrape_batch_id, title)) AS config FROM scraped_documents WHERE contains(lower(title), 'interview')",
    "top_companies": f"SELECT company, count(*) AS n, min(scrape_batch_id) AS first_batch, max(scrape_batch_id) AS last_batch FROM processed_documents WHERE NOT ({_BLANK.format('company')}) GROUP BY 1 ORDER BY n DESC, company LIMIT 10",
    "regression_gate": "SELECT label, CASE WHEN a - b > 0.005 THEN 'regression' WHEN b - a >= 0.01 THEN 'promote' ELSE 'keep' END AS verdict FROM (SELECT label, avg(embedding[1]::DOUBLE) FILTER (vec_id % 2 = 0) AS a, avg(embedding[1]::DOUBLE) FILTER (vec_id % 2 = 1) AS b FROM embeddings GROUP BY 1)",
}
