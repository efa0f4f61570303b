"""Exact deduplication by content hash, and near duplicates by the Jaccard similarity of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions.hashing import banded, runs_of, similar
from sieveline.functions.text import content_key, is_blank, words
from sieveline.plans.runtime import ensure_spread, staged, table


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row by ``order`` of every value of ``key``; a window rank that Catalyst turns into
    a group limit before the shuffle."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def word_shingles(df: DataFrame, key: str, content: str, size: int, least: int) -> DataFrame:
    """(key, n, shingles) of every row with at least ``least`` distinct runs of ``size`` words split at white
    space; ``shingles`` is the sorted set of their hashes as little-endian 64-bit integers."""
    hashed = ensure_spread(df.select(key, content)).select(key, F.transform(words(F.lower(content)), lambda x: F.xxhash64(x)).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for i, w in enumerate(batch.column(1)):
                a = np.array(w.values, np.int64).view(np.uint64)
                h = runs_of(a, size)
                if len(h) >= least:
                    rows.append(i)
                    sets.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array([len(s) // 8 for s in sets], pa.int32()), pa.array(sets, pa.binary())], names=[key, "n", "shingles"])

    return hashed.mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, n int, shingles binary")


def similar_pairs(sets: DataFrame, key: str, share: int, of: int, bands: int, rows: int) -> DataFrame:
    """(a, b), a < b: pairs of ``word_shingles`` with a Jaccard similarity of at least ``share / of``. Candidates
    agree in a band of MinHash values; each is verified on the whole sets."""
    postings = staged(banded(sets, key, bands, rows).select(key, "n", F.explode("bands").alias("band")), "near-bands")
    left = postings.select("band", F.col(key).alias("a"), F.col("n").alias("na"))
    right = postings.select("band", F.col(key).alias("b"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (F.col("na") * of >= F.col("nb") * share) & (F.col("nb") * of >= F.col("na") * share)
    found = left.join(right, "band").where(fits).select("a", "b").distinct()
    held = found.join(sets.select(F.col(key).alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col(key).alias("b"), F.col("shingles").alias("sb")), "b")
    return similar(held, share, of).select("a", "b")


def greedy_rejects(pairs: DataFrame) -> DataFrame:
    """(b, a) of every ``b`` that is similar to an earlier kept ``a`` (the first of them), as if the rows came one by
    one in the order of their keys: rows without an earlier neighbour stay and reject theirs, until no pair is open."""
    pairs = staged(pairs, "near-pairs")
    left, rejected = pairs, pairs.select("b").limit(0)
    while not left.isEmpty():
        kept = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        hit = staged(left.join(kept, "a", "left_semi").select("b").distinct(), "near-rejected")
        rejected = rejected.union(hit)
        left = staged(left.join(hit, "b", "left_anti").join(hit.withColumnRenamed("b", "a"), "a", "left_anti").select("a", "b"), "near-open")
    kept = pairs.join(rejected.withColumnRenamed("b", "a"), "a", "left_anti")
    return kept.join(rejected, "b", "left_semi").groupBy("b").agg(F.min("a").alias("a"))


def near_dup_keep(df: DataFrame, key: str, content: str, share: int = 8, of: int = 10, size: int = 3, least: int = 10, bands: int = 60, rows: int = 5) -> DataFrame:
    """(key, near_duplicate_of) of the rows of ``df`` that are similar to an earlier kept row; ``key`` is unique and
    gives the order. With 60 bands of 5 rows a pair at similarity 0.8 is missed with a probability below 1e-10."""
    sets = staged(word_shingles(df, key, content, size, least), "near-sets")
    return greedy_rejects(similar_pairs(sets, key, share, of, bands, rows)).select(F.col("b").alias(key), F.col("a").alias("near_duplicate_of"))


def exact_dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(~is_blank(F.col("text")))
    keyed = docs.select("doc_id", "lang", "n_chars", content_key(F.col("text")).alias("content_hash"))
    return keep_first(keyed, "content_hash", "doc_id").select("doc_id", "lang", "n_chars", "content_hash")


QUERIES = {"exact_dedup_keep_first": exact_dedup_keep_first}

SQL = {
    "exact_dedup_keep_first": r"""
        SELECT doc_id, lang, n_chars, content_hash FROM (
          SELECT doc_id, lang, n_chars, content_hash, row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) AS r
          FROM (SELECT doc_id, lang, n_chars, sha256(regexp_replace(regexp_replace(lower(text), '[ \t\n\r\f\v]+', ' ', 'g'), '^ | $', '', 'g')) AS content_hash
                FROM documents WHERE regexp_replace(text, '[ \t\n\r\f\v]+', '', 'g') <> ''))
        WHERE r = 1""",
}
