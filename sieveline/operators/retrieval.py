"""Retrieval for batches of queries: exact vector top-k in blocks, BM25, rank fusion, pooling.

All results are in long form: (query_id, item_id, score[, rank]). Every ranking breaks ties by id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.plans.runtime import staged, table


def ranked(df: DataFrame, k: int | None = None, score: str = "score") -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc_nulls_last(score), "item_id")
    out = df.withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= k) if k else out


def vector_topk(queries: DataFrame, items: DataFrame, k: int, block: int = 2048, parts: int = 8) -> DataFrame:
    """(query_id, item_id, score, rank) by cosine; both sides are (id bigint, embedding array<float>).

    Queries meet items block by block as matrices; each block keeps its k best, a window merges blocks.
    NULL and all-zero vectors take no part, nor do vectors of another length than the query's.
    """

    def sized(df: DataFrame) -> DataFrame:
        return df.select("id", "embedding").where(F.expr("embedding is not null and exists(embedding, x -> x <> 0) and forall(embedding, x -> x is not null and not isnan(x))"))

    n_blocks = max(1, -(-queries.count() // block))
    left = sized(queries).withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # other names: both sides may come from one table, and a cogroup must not take their columns for the same
    named = sized(items).select(F.col("id").alias("item"), F.col("embedding").alias("vector"))
    right = named.withColumn("item_part", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int")).withColumn("item_qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def score(q: pa.Table, e: pa.Table) -> pa.Table:
        out = [], [], []
        if not q.num_rows or not e.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "item_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(e.column("vector").to_pylist()):
            by_size.setdefault(len(v), []).append(i)
        qv, ev = q.column("embedding").to_pylist(), e.column("vector").to_pylist()
        q_ids, e_ids = q.column("id").to_numpy(), e.column("item").to_numpy()
        for size, rows in by_size.items():
            mine = [i for i, v in enumerate(qv) if len(v) == size]
            if not mine:
                continue
            a, b = np.array([qv[i] for i in mine], np.float64), np.array([ev[i] for i in rows], np.float64)
            s = (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1))
            ids = e_ids[rows]
            for i, row in zip(mine, s, strict=True):
                top = np.lexsort((ids, -np.round(row, 9)))[: k + 1]
                out[0].append(np.full(len(top), q_ids[i]))
                out[1].append(ids[top])
                out[2].append(row[top])
        flat = [np.concatenate(x) if x else np.empty(0) for x in out]
        return pa.table({"query_id": pa.array(flat[0], pa.int64()), "item_id": pa.array(flat[1], pa.int64()), "score": pa.array(flat[2], pa.float64())})

    found = left.groupBy("qb", "part").cogroup(right.groupBy("item_qb", "item_part")).applyInArrow(score, "query_id bigint, item_id bigint, score double")
    return ranked(found.withColumn("score", F.round("score", 6)), k)


class Postings:
    """Where the terms of queries stand in a block of documents: for each term the documents in order of their id, and
    how often each holds it."""

    def __init__(self, docs: pa.Table, terms: pa.Array):
        order = pc.sort_indices(docs.column("item_id")).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids = docs.column("item_id").take(pa.array(order))
        words = docs.column("words").combine_chunks()
        size = pc.list_value_length(words).to_numpy()
        self.length = size[order]
        flat = words.flatten().dictionary_encode()
        code = pc.fill_null(pc.index_in(flat.dictionary, value_set=terms), -1).to_numpy()[flat.indices.to_numpy()]
        key = code.astype(np.int64) * len(order) + np.repeat(place, size)
        key, self.times = np.unique(key[code >= 0], return_counts=True)
        self.doc = key % len(order)
        self.start = np.searchsorted(key, np.arange(len(terms) + 1) * len(order))


def _terms(queries: pa.Table) -> tuple[pa.Array, list[list[int]]]:
    """The distinct terms of a block of queries, and those of each query by number."""
    flat = queries.column("terms").combine_chunks().flatten().dictionary_encode()
    ends = np.cumsum(pc.list_value_length(queries.column("terms")).to_numpy())
    return flat.dictionary, [x.tolist() for x in np.split(flat.indices.to_numpy(), ends[:-1])]


def _by_blocks(queries: DataFrame, docs: DataFrame, meet: Callable[[pa.Table, pa.Table], pa.Table], schema: str, query_block: int = 32_768, doc_block: int = 32_768) -> DataFrame:
    """Every block of queries (query_id, terms, ...) meets every block of documents (item_id, words); of both only the
    rows themselves are shuffled, never the pairs that share a term."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    n = docs.count()
    n_queries = max(1, -(-queries.count() // query_block))
    n_docs = max(1, -(-n // doc_block), min(cores, n // 512))
    left = queries.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(n_queries)).cast("int")).withColumn("qd", F.explode(F.sequence(F.lit(0), F.lit(n_docs - 1))))
    right = docs.withColumn("db", F.pmod(F.xxhash64("item_id"), F.lit(n_docs)).cast("int")).withColumn("dq", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    # several partitions for each group, so that few groups share a task
    tasks = min(4 * n_queries * n_docs, 20_000)
    return left.repartition(tasks, "qb", "qd").groupBy("qb", "qd").cogroup(right.repartition(tasks, "dq", "db").groupBy("dq", "db")).applyInArrow(meet, schema)


def _worded(docs: DataFrame, name: str) -> DataFrame:
    return staged(docs.select("item_id", text.words(F.lower("body")).alias("words")), name)


def bm25(queries: DataFrame, docs: DataFrame, k: int, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """(query_id, item_id, score, rank): for every query the ``k`` best documents by BM25 Okapi with a score above 0, rounded
    to six decimals; queries are (query_id, query_text), docs (item_id, body).

    Tokens are lower-case words between white space; a negative idf becomes epsilon times the mean idf.
    Blocks of queries meet blocks of documents, each keeps its k best for every query, a window merges the blocks.
    """
    worded = _worded(docs, "bm25-words")
    n, mean_length = worded.agg(F.count("*"), F.avg(F.size("words"))).first()
    df = worded.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    raw = df.select("term", F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("raw"))
    mean = raw.agg(F.avg("raw").alias("mean"))
    idf = raw.crossJoin(F.broadcast(mean)).select("term", F.when(F.col("raw") < 0, epsilon * F.col("mean")).otherwise(F.col("raw")).alias("idf"))  # one row
    terms = queries.select("query_id", F.explode(text.words(F.lower("query_text"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qf"))
    weighted = terms.join(idf, "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", (F.col("qf") * F.col("idf")).alias("weight")))).alias("t"))
    asked = staged(weighted.select("query_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "bm25-asked")

    def score(q: pa.Table, d: pa.Table) -> pa.Table:
        hit_q, hit_d, hit_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if q.num_rows and d.num_rows:
            names, own = _terms(q)
            p = Postings(d, names)
            size = d.num_rows
            part = p.times * (k1 + 1) / (p.times + k1 * (1 - b + b * p.length[p.doc] / mean_length))
            start, many = p.start.tolist(), (np.diff(p.start) > size // 64).tolist()
            weights = np.split(q.column("weights").combine_chunks().flatten().to_numpy(), np.cumsum([len(t) for t in own])[:-1])
            pairs = [list(zip(t, w.tolist(), strict=True)) for t, w in zip(own, weights, strict=True)]
            # queries with the same frequent terms stand together: the sum of those is taken once
            frequent = [tuple(x for x in pair if many[x[0]]) for pair in pairs]
            base, scores, last = np.zeros(-(-size // 64) * 64), np.empty(-(-size // 64) * 64), ()
            for i in sorted(range(len(pairs)), key=frequent.__getitem__):
                if frequent[i] != last:
                    base[:], last = 0, frequent[i]
                    for t, w in last:
                        base[p.doc[start[t] : start[t + 1]]] += w * part[start[t] : start[t + 1]]
                scores[:] = base
                for t, w in pairs[i]:
                    if not many[t] and start[t] < start[t + 1]:
                        scores[p.doc[start[t] : start[t + 1]]] += w * part[start[t] : start[t + 1]]
                # the k-th of the best scores of runs of 64 documents is reached by k documents at least
                best = scores.reshape(-1, 64).max(axis=1)
                edge = np.partition(best, len(best) - k)[len(best) - k] if len(best) >= k else 0.0
                at = np.flatnonzero(scores >= max(edge - 2e-6, 4e-7))
                rounded = np.floor(scores[at] * 1e6 + 0.5)
                top = np.argsort(-rounded, kind="stable")[:k]
                top = top[rounded[top] > 0]
                hit_q.append(np.full(len(top), i))
                hit_d.append(at[top])
                hit_s.append(rounded[top] / 1e6)
            ids = p.ids
        else:
            ids = d.column("item_id")
        return pa.table({"query_id": q.column("query_id").take(pa.array(np.concatenate(hit_q))), "item_id": ids.take(pa.array(np.concatenate(hit_d))), "score": pa.array(np.concatenate(hit_s))})

    kinds = dict(queries.dtypes)["query_id"], dict(docs.dtypes)["item_id"]
    return ranked(_by_blocks(asked, worded.where("item_id is not null"), score, f"query_id {kinds[0]}, item_id {kinds[1]}, score double"), k)


def matches_all(queries: DataFrame, docs: DataFrame, stop: list[str]) -> DataFrame:
    """(query_id, item_id): documents that hold every query word outside the stop list.

    Blocks of queries meet blocks of documents; the documents of a query's terms are intersected, the rarest first.
    """
    terms = F.array_except(text.words(F.lower("query_text")), F.array(*map(F.lit, stop)).cast("array<string>"))  # distinct
    asked = staged(queries.select("query_id", terms.alias("terms")).where(F.size("terms") > 0), "match-asked")

    def match(q: pa.Table, d: pa.Table) -> pa.Table:
        hit_q, hit_d = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        ids = d.column("item_id")
        if q.num_rows and d.num_rows:
            names, own = _terms(q)
            p = Postings(d, names)
            ids, start, held = p.ids, p.start.tolist(), np.diff(p.start).tolist()
            for i, t in enumerate(own):
                rarest, *others = sorted(t, key=held.__getitem__)
                found = p.doc[start[rarest] : start[rarest + 1]]
                for x in others:
                    if not len(found):
                        break
                    docs_of = p.doc[start[x] : start[x + 1]]
                    found = found[docs_of[np.searchsorted(docs_of, found).clip(max=len(docs_of) - 1)] == found]
                hit_q.append(np.full(len(found), i))
                hit_d.append(found)
        return pa.table({"query_id": q.column("query_id").take(pa.array(np.concatenate(hit_q))), "item_id": ids.take(pa.array(np.concatenate(hit_d)))})

    kinds = dict(queries.dtypes)["query_id"], dict(docs.dtypes)["item_id"]
    return _by_blocks(asked, _worded(docs, "match-words"), match, f"query_id {kinds[0]}, item_id {kinds[1]}")


def rrf(arms: list[tuple[DataFrame, float]], k: int, constant: int = 60) -> DataFrame:
    """Weighted reciprocal rank fusion of ranked arms: the sum of weight / (constant + rank)."""
    parts = None
    for arm, weight in arms:
        part = arm.select("query_id", "item_id", (F.lit(weight) / (constant + F.col("rank"))).alias("s"))
        parts = part if parts is None else parts.union(part)
    return ranked(parts.groupBy("query_id", "item_id").agg(F.round(F.sum("s"), 9).alias("score")), k)


def min_max(df: DataFrame) -> DataFrame:
    """Scores scaled to 0..1 within each query; a list without spread gets 1."""
    w = Window.partitionBy("query_id")
    low, high = F.min("score").over(w), F.max("score").over(w)
    return df.withColumn("score", F.when(high == low, 1.0).otherwise((F.col("score") - low) / (high - low)))


def linear_fusion(vector: DataFrame, lexical: DataFrame, k: int, alpha: float = 0.5) -> DataFrame:
    a = min_max(vector).select("query_id", "item_id", F.col("score").alias("v"))
    b = min_max(lexical).select("query_id", "item_id", F.col("score").alias("l"))
    both = a.join(b, ["query_id", "item_id"], "full_outer")
    return ranked(both.select("query_id", "item_id", F.round(alpha * F.coalesce("v", F.lit(0.0)) + (1 - alpha) * F.coalesce("l", F.lit(0.0)), 9).alias("score")), k)


def pool(arms: dict[str, DataFrame]) -> DataFrame:
    """One row for each (query, item) with the arms that found it, each arm's rank, and the best scaled score."""
    parts = None
    for i, (name, arm) in enumerate(arms.items()):
        part = min_max(arm).select("query_id", "item_id", F.lit(i).alias("i"), F.lit(name).alias("arm"), "rank", "score")
        parts = part if parts is None else parts.union(part)
    ranks = [F.max(F.when(F.col("arm") == n, F.col("rank"))).alias(f"{n}_rank") for n in arms]
    sources = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "arm"))), lambda x: x["arm"]), ",")
    return parts.groupBy("query_id", "item_id").agg(sources.alias("sources"), *ranks, F.round(F.max("score"), 6).alias("best_score"))


# --- queries: the vectors are embeddings, every twentieth one a query ---------------------------------
def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return e.where("id % 20 = 0"), e


def _texts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    logs = table(spark, d, "query_logs").where("id % 20 = 0 and query_text is not null")
    chunks = table(spark, d, "document_chunks").where("chunk_text is not null").groupBy("chunk_no").agg(F.min("chunk_text").alias("body"))
    return logs.groupBy("query_text").agg(F.min("id").alias("query_id")), chunks.withColumnRenamed("chunk_no", "item_id")


def _dense(spark: SparkSession, d: str, k: int = 10) -> DataFrame:
    return vector_topk(*_vectors(spark, d), k)


def _labels_arm(spark: SparkSession, d: str, k: int = 10) -> DataFrame:
    """A second arm over the same items: those of the query's label by id distance."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "label")
    q = e.where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), "label")
    return ranked(q.join(e, "label").select("query_id", "item_id", (1.0 / (1 + F.abs(F.col("query_id") - F.col("item_id")))).alias("score")), k)


def q_vector(spark: SparkSession, d: str) -> DataFrame:
    return _dense(spark, d).select("query_id", "item_id", "score", F.col("rank").cast("bigint").alias("rank"))


def q_bm25(spark: SparkSession, d: str) -> DataFrame:
    queries, docs = _texts(spark, d)
    return bm25(queries, docs, 10).select("query_id", "item_id", "score", F.col("rank").cast("bigint").alias("rank"))


def q_matches(spark: SparkSession, d: str) -> DataFrame:
    return matches_all(*_texts(spark, d), STOP)


def q_rrf(spark: SparkSession, d: str) -> DataFrame:
    return rrf([(_dense(spark, d, 16), 1.0), (_labels_arm(spark, d, 16), 0.5)], 8).select("query_id", "item_id", "score", F.col("rank").cast("bigint").alias("rank"))


def q_linear(spark: SparkSession, d: str) -> DataFrame:
    return linear_fusion(_dense(spark, d), _labels_arm(spark, d), 10).select("query_id", "item_id", "score", F.col("rank").cast("bigint").alias("rank"))


def q_min_max(spark: SparkSession, d: str) -> DataFrame:
    return min_max(_dense(spark, d)).select("query_id", "item_id", F.round("score", 6).alias("score"))


def _pooled(spark: SparkSession, d: str) -> DataFrame:
    dense, near = _dense(spark, d), _labels_arm(spark, d)
    return pool({"vector": dense, "label": near, "hybrid": linear_fusion(dense, near, 10)})


def q_pool(spark: SparkSession, d: str) -> DataFrame:
    return _pooled(spark, d).select("query_id", "item_id", "sources", *[F.col(f"{n}_rank").cast("bigint").alias(f"{n}_rank") for n in ("vector", "label", "hybrid")], "best_score")


def q_overlap(spark: SparkSession, d: str) -> DataFrame:
    p = _pooled(spark, d)
    only = [F.count_if(F.col("sources") == n).alias(f"{n}_only") for n in ("vector", "label", "hybrid")]
    return p.agg(F.count("*").alias("pooled"), *only, F.count_if(F.col("sources").contains(",")).alias("multi_source"))


def context(url: Column, body: Column, i: Column) -> Column:
    return F.concat(F.lit("--- Chunk "), i.cast("string"), F.lit(" ---\nSource URL: "), F.coalesce(url, F.lit("")), F.lit("\n"), body)


def q_context(spark: SparkSession, d: str) -> DataFrame:
    """Prompt contexts of each document's chunks in order, parts joined by a blank line."""
    chunks = table(spark, d, "document_chunks").where("chunk_text is not null").dropDuplicates(["chunk_id"])
    docs = table(spark, d, "processed_documents").groupBy("document_id").agg(F.min("source_url").alias("url"))
    i = F.row_number().over(Window.partitionBy("document_id").orderBy("chunk_index", "chunk_id"))
    parts = chunks.join(docs, "document_id", "left").select("document_id", i.alias("i"), context(F.col("url"), F.col("chunk_text"), i).alias("part"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "part"))), lambda x: x["part"]), "\n\n")
    return parts.groupBy("document_id").agg(F.md5(joined).alias("context"))


# Words left out of lexical matching.
STOP = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with how what when where why do does did i my me".split()

_DENSE = """dense AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT q.vec_id AS query_id, e.vec_id AS item_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score
    FROM (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q, embeddings e) QUALIFY rank <= {k})"""
_NEAR = """near AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT q.vec_id AS query_id, e.vec_id AS item_id, 1.0::DOUBLE / (1 + abs(q.vec_id - e.vec_id)) AS score FROM embeddings q JOIN embeddings e USING (label) WHERE q.vec_id % 20 = 0) QUALIFY rank <= {k})"""
_SCALED = "{0}_s AS (SELECT query_id, item_id, rank, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS s FROM {0} WINDOW w AS (PARTITION BY query_id))"
_LINEAR = """linear AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
    SELECT query_id, item_id, round(0.5 * coalesce(a.s, 0) + 0.5 * coalesce(b.s, 0), 9) AS score FROM dense_s a FULL JOIN near_s b USING (query_id, item_id)) QUALIFY rank <= 10)"""
_BASE = f"WITH {_DENSE.format(k=10)}, {_NEAR.format(k=10)}, {_SCALED.format('dense')}, {_SCALED.format('near')}, {_LINEAR}, {_SCALED.format('linear')}"
_POOL = f"""{_BASE}, parts AS (SELECT query_id, item_id, 0 AS i, 'vector' AS arm, rank, s FROM dense_s UNION ALL SELECT query_id, item_id, 1, 'label', rank, s FROM near_s UNION ALL SELECT query_id, item_id, 2, 'hybrid', rank, s FROM linear_s),
    pooled AS (SELECT query_id, item_id, string_agg(arm, ',' ORDER BY i) AS sources, max(rank) FILTER (arm = 'vector') AS vector_rank, max(rank) FILTER (arm = 'label') AS label_rank, max(rank) FILTER (arm = 'hybrid') AS hybrid_rank, round(max(s), 6) AS best_score FROM parts GROUP BY ALL)"""
_POOL = _POOL.replace("FROM parts GROUP BY ALL", "FROM parts GROUP BY query_id, item_id")
_WS = r"list_filter(string_split_regex(lower({0}), '[ \t\n\r\f\v]+'), lambda x: x <> '')"
_TEXTS = """q AS (SELECT query_text, min(id) AS query_id FROM query_logs WHERE id % 20 = 0 AND query_text IS NOT NULL GROUP BY 1),
    d AS (SELECT chunk_no AS item_id, min(chunk_text) AS body FROM document_chunks WHERE chunk_text IS NOT NULL GROUP BY 1)"""

QUERIES = {
    "vector_topk": q_vector, "bm25_topk": q_bm25, "lexical_and_match": q_matches, "rrf_fusion": q_rrf, "linear_fusion": q_linear, "minmax_normalize": q_min_max, "result_pooling": q_pool, "pool_overlap": q_overlap,
    "context_build": q_context,
}

SQL = {
    "vector_topk": f"WITH {_DENSE.format(k=10)} SELECT query_id, item_id, score, rank FROM dense",
    "bm25_topk": f"""
        WITH {_TEXTS}, p AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest({_WS.format('body')}) AS term FROM d) GROUP BY ALL),
        l AS (SELECT item_id, len({_WS.format('body')}) AS dl FROM d), t AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM l),
        r AS (SELECT term, ln((n - df + 0.5) / (df + 0.5)) AS raw FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), t),
        i AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM r) ELSE raw END AS idf FROM r),
        qt AS (SELECT query_id, term, count(*) AS qf FROM (SELECT query_id, unnest({_WS.format('query_text')}) AS term FROM q) GROUP BY ALL),
        s AS (SELECT query_id, item_id, round(sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM qt JOIN i USING (term) JOIN p USING (term) JOIN l USING (item_id), t GROUP BY ALL)
        SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM s WHERE score > 0 QUALIFY rank <= 10""",
    "lexical_and_match": f"""
        WITH {_TEXTS}, qt AS (SELECT DISTINCT query_id, unnest({_WS.format('query_text')}) AS term FROM q), qn AS (SELECT * FROM qt WHERE term NOT IN ({', '.join(repr(w) for w in STOP)})),
        dt AS (SELECT DISTINCT item_id, unnest({_WS.format('body')}) AS term FROM d)
        SELECT query_id, item_id FROM qn JOIN dt USING (term) JOIN (SELECT query_id, count(*) AS need FROM qn GROUP BY 1) USING (query_id) GROUP BY query_id, item_id, need HAVING count(*) = need""",
    "rrf_fusion": f"""WITH {_DENSE.format(k=16)}, {_NEAR.format(k=16)} SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM (
        SELECT query_id, item_id, round(sum(s), 9) AS score FROM (SELECT query_id, item_id, 1.0::DOUBLE / (60 + rank) AS s FROM dense UNION ALL SELECT query_id, item_id, 0.5::DOUBLE / (60 + rank) FROM near) GROUP BY ALL) QUALIFY rank <= 8""",
    "linear_fusion": f"{_BASE} SELECT query_id, item_id, score, rank FROM linear",
    "minmax_normalize": f"WITH {_DENSE.format(k=10)}, {_SCALED.format('dense')} SELECT query_id, item_id, round(s, 6) AS score FROM dense_s",
    "result_pooling": f"{_POOL} SELECT * FROM pooled",
    "pool_overlap": f"{_POOL} SELECT count(*) AS pooled, count(*) FILTER (sources = 'vector') AS vector_only, count(*) FILTER (sources = 'label') AS label_only, count(*) FILTER (sources = 'hybrid') AS hybrid_only, count(*) FILTER (contains(sources, ',')) AS multi_source FROM pooled",
    "context_build": """
        SELECT document_id, md5(string_agg('--- Chunk ' || i || ' ---' || chr(10) || 'Source URL: ' || coalesce(url, '') || chr(10) || chunk_text, chr(10) || chr(10) ORDER BY i)) AS context FROM (
          SELECT document_id, chunk_text, url, row_number() OVER (PARTITION BY document_id ORDER BY chunk_index, chunk_id) AS i FROM (
            SELECT DISTINCT ON (chunk_id) * FROM document_chunks WHERE chunk_text IS NOT NULL) LEFT JOIN (SELECT document_id, min(source_url) AS url FROM processed_documents GROUP BY 1) USING (document_id)) GROUP BY 1""",
}
