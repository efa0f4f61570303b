"""The pN_ queries of the operators for training data, and SQL for those that SQL can express."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm.canonical import map_column
from sieveline.llm.dartminhash import NearDuplicates
from sieveline.llm.incremental import reject_repeats
from sieveline.llm.multiindex import nearest_vectors
from sieveline.llm.packing import pack
from sieveline.llm.pii import find_personal_data, pseudonymise_personal_data, redact_personal_data
from sieveline.llm.spam import stuffed_pages
from sieveline.llm.splitting import round_labels, split_texts
from sieveline.llm.tokenizer import encode_column
from sieveline.plans.runtime import table
from pyspark.sql import functions as F


def _records(spark: SparkSession, d: str) -> NearDuplicates:
    return NearDuplicates(table(spark, d, "scraped_documents"), "record_no", "title", "raw_content", share=70, of=100, size=3)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).record_pairs()


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).groups()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return find_personal_data(table(spark, d, "scraped_documents"), "record_no", "raw_content")


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    return redact_personal_data(table(spark, d, "scraped_documents"), "record_no", "raw_content")


def p2_pseudonyms(spark: SparkSession, d: str) -> DataFrame:
    # without a secret of its own a session draws one: pseudonyms are then linked within this result only
    secret = spark.conf.get("sieveline.pseudonym.secret", None) or secrets.token_hex(32)
    return pseudonymise_personal_data(table(spark, d, "scraped_documents"), "record_no", "raw_content", secret=secret)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    logs, chunks = table(spark, d, "query_logs"), table(spark, d, "document_chunks")
    return nearest_vectors(logs, "id", "query_embedding", chunks, "chunk_id", "embedding", k=5, least=0.55).select("id", "chunk_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return round_labels(table(spark, d, "processed_documents"), "document_id", "content", 500, 50)


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(table(spark, d, "processed_documents"), "document_id", "content", 500, 50)


def p4_chunk_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_texts(table(spark, d, "document_chunks"), "chunk_id", "chunk_text", 500, 50)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "processed_documents")
    company = map_column(docs, "document_id", "company", table(spark, d, "companies"), "company_id", "company_name", "aliases")
    role = map_column(docs, "document_id", "role", table(spark, d, "role_titles"), "role_id", "title", "aliases")
    return company.select("document_id", F.lit("company").alias("field_name"), "ref_id").union(role.select("document_id", F.lit("role").alias("field_name"), "ref_id"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return reject_repeats(table(spark, d, "scraped_documents"), "record_no", "scrape_batch_id", "title", "raw_content", share=70, of=100, size=3)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_column(table(spark, d, "documents"), "doc_id", "text")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = encode_column(table(spark, d, "documents"), "doc_id", "text", counts_only=True)
    return pack(sizes, "doc_id", "n_tokens", 2048)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffed_pages(table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_redacted, p2_pseudonyms, p3_found, p4_found, p4_pieces, p4_chunk_pieces, p5_found, p6_found, p7_ids, p8_containers, p9_found)}


#: Sets of three words of the records and the pairs of them with a similarity of 0.70, by joining every shared run.
_SETS = r"""
    w AS (SELECT record_no, scrape_batch_id, regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(raw_content, '')), '[a-z0-9]+') AS w FROM scraped_documents),
    g AS (SELECT DISTINCT record_no, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT record_no, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
    n AS (SELECT record_no, count(*) AS n FROM g GROUP BY 1 HAVING count(*) >= 10),
    h AS (SELECT record_no, s, n FROM g JOIN n USING (record_no)),
    pairs AS MATERIALIZED (SELECT a.record_no AS record_a, b.record_no AS record_b FROM h a JOIN h b ON a.s = b.s AND a.record_no < b.record_no GROUP BY a.record_no, b.record_no, a.n, b.n HAVING 100 * count(*) >= 70 * (a.n + b.n - count(*)))"""
_FINE = "len({0}) = 384 AND list_bool_and(list_transform({0}, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform({0}, lambda x: x <> 0))"
SQL = {
    "p1_found": f"WITH {_SETS} SELECT record_a, record_b FROM pairs",
    "p1_groups": f"""WITH RECURSIVE {_SETS},
    links AS MATERIALIZED (SELECT record_a AS a, record_b AS b FROM pairs UNION ALL SELECT record_b, record_a FROM pairs),
    reach(node, other) AS (SELECT record_no, record_no FROM n UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
    sets AS (SELECT record_no, md5(string_agg(s, '|' ORDER BY s)) AS k FROM h GROUP BY 1),
    reps AS (SELECT record_no, min(record_no) OVER (PARTITION BY k) AS rep FROM sets),
    links_of AS (SELECT x.rep, count(DISTINCT y.rep) AS links FROM links l JOIN reps x ON x.record_no = l.a JOIN reps y ON y.record_no = l.b WHERE x.rep <> y.rep GROUP BY 1)
    SELECT r.node AS record_no, min(r.other) AS class_id, coalesce(any_value(o.links), 0) AS links FROM reach r JOIN reps p ON p.record_no = r.node LEFT JOIN links_of o ON o.rep = p.rep GROUP BY 1""",
    "p3_found": f"""WITH e AS (SELECT DISTINCT ON (chunk_id) chunk_id, embedding::DOUBLE[384] AS v FROM document_chunks WHERE {_FINE.format('embedding')}),
    q AS (SELECT id, query_embedding::DOUBLE[384] AS v FROM (SELECT DISTINCT ON (id) id, query_embedding FROM query_logs WHERE {_FINE.format('query_embedding')})),
    d AS (SELECT DISTINCT v FROM q),
    s AS (SELECT d.v AS v, chunk_id, round(array_cosine_similarity(d.v, e.v), 6) AS c FROM d, e),
    t AS (SELECT v, chunk_id FROM s WHERE c >= 0.55 QUALIFY row_number() OVER (PARTITION BY v ORDER BY c DESC, chunk_id) <= 5)
    SELECT id, chunk_id FROM q JOIN t USING (v)""",
    "p6_found": f"""WITH RECURSIVE {_SETS},
        o AS (SELECT record_no, row_number() OVER (ORDER BY coalesce(scrape_batch_id, ''), record_no) AS i FROM w),
        e AS (SELECT greatest(x.i, y.i) AS i, least(x.i, y.i) AS before FROM pairs JOIN o x ON x.record_no = record_a JOIN o y ON y.record_no = record_b),
        steps AS MATERIALIZED (SELECT i, list(before) AS before, row_number() OVER (ORDER BY i) AS k FROM e GROUP BY i),
        walk(k, rejected) AS (
          SELECT 0::BIGINT, []::BIGINT[]
          UNION ALL
          SELECT s.k, CASE WHEN len(list_filter(s.before, lambda x: NOT list_contains(walk.rejected, x))) > 0 THEN list_append(walk.rejected, s.i) ELSE walk.rejected END FROM walk JOIN steps s ON s.k = walk.k + 1)
        SELECT record_no FROM o WHERE i IN (SELECT unnest(rejected) FROM (SELECT rejected FROM walk ORDER BY k DESC LIMIT 1))""",
}


def oracle_sql() -> dict[str, str]:
    """Plain joins of everything with everything that shares a run, or of all vectors: right, and only for small tables."""
    return dict(SQL)
