"""Loading: keyed upserts, get-or-create dimensions, insert-ignore, enrichment joins, resume, reports.

Plain Parquet has no MERGE, so every write is a rebuild: a join of the old and the new rows that the
caller writes in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators.dedup import keep_first
from sieveline.plans.runtime import numbered_by, table


def upsert(old: DataFrame, new: DataFrame, key: str, update: list[str] | None = None) -> DataFrame:
    """Rows of both; where a key is in both, the columns of ``update`` (all if None) come from ``new``."""
    if update is None:
        return old.join(new.select(key), key, "left_anti").unionByName(new)
    o, n = old.select(key, *[F.col(c).alias(f"o_{c}") for c in old.columns if c != key], F.lit(True).alias("__o")), new.select(key, *[F.col(c).alias(f"n_{c}") for c in old.columns if c != key], F.lit(True).alias("__n"))
    both = o.join(n, key, "full_outer")
    pick = [F.when(F.col("__n") & (F.lit(c in update) | F.col("__o").isNull()), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) if c != key else F.col(key) for c in old.columns]
    return both.select(*pick)


def insert_ignore(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def get_or_create(dim: DataFrame, id_col: str, name_col: str, values: DataFrame, value_col: str) -> DataFrame:
    """The dimension with a row for every new non-blank value (key: lower case, stripped); new ids follow the
    largest in order of the key."""
    key = F.lower(text.strip(F.col(value_col)))
    fresh = values.where(~text.is_blank(F.col(value_col))).groupBy(key.alias("k")).agg(F.min(text.strip(F.col(value_col))).alias(name_col))
    fresh = fresh.join(dim.select(F.lower(text.strip(F.col(name_col))).alias("k")), "k", "left_anti")
    top = dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))
    numbered = numbered_by(fresh, "k", "__no").crossJoin(F.broadcast(top)).withColumn(id_col, (F.col("top") + F.col("__no")).cast("int"))  # top is one row
    return dim.select(id_col, name_col).unionByName(numbered.select(id_col, name_col))


# --- queries ------------------------------------------------------------------------------------------
def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "processed_documents").distinct()


def q_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders with customer, nation and region; every order stays."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def q_inner_join(spark: SparkSession, d: str) -> DataFrame:
    """Retrievable chunks: only those whose document has a company and a role, by company name of the list."""
    chunks = table(spark, d, "document_chunks").dropDuplicates(["chunk_id"])
    docs = _docs(spark, d).where(~text.is_blank(F.col("company")) & ~text.is_blank(F.col("role")))
    j = chunks.join(docs.select("document_id", "company", "role"), "document_id").join(table(spark, d, "companies"), F.lower("company") == F.lower("company_name")).join(table(spark, d, "role_titles"), F.lower("role") == F.lower("title"))
    return j.groupBy("company_name", "title").agg(F.count("*").alias("n_chunks"))


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` whose key is NOT IN ``other``, with SQL's rules for NULL: nothing is known not to be in a list
    that holds a NULL, and a NULL is in no list but also not known not to be, unless the list is empty. The rules take
    one row of counts; the join itself is a plain anti-join, which never needs the whole list in one place."""
    state = other.agg(F.count("*").alias("__n"), F.count_if(F.col(other_key).isNull()).alias("__nulls"))  # one row
    rest = df.join(other.select(F.col(other_key).alias(key)).distinct(), key, "left_anti").crossJoin(F.broadcast(state))
    return rest.where((F.col("__nulls") == 0) & (F.col(key).isNotNull() | (F.col("__n") == 0))).drop("__n", "__nulls")


def q_not_in(spark: SparkSession, d: str) -> DataFrame:
    """Documents without chunks, with the null-aware semantics of NOT IN."""
    docs = table(spark, d, "processed_documents").select("document_id").distinct()
    return not_in(docs, "document_id", table(spark, d, "document_chunks"), "document_id")


def q_upsert_partial(spark: SparkSession, d: str) -> DataFrame:
    docs = keep_first(_docs(spark, d).select("document_id", "title", "content_hash", "word_count", "scrape_batch_id"), "document_id", "content_hash")
    raw = table(spark, d, "scraped_documents").where("document_id is not null")
    new = keep_first(raw.select("record_no", "document_id", "title", "content_hash", F.lit(-1).alias("word_count"), "scrape_batch_id"), "document_id", "record_no").drop("record_no")
    shared = docs.limit(0).unionByName(docs.where("word_count % 2 = 0").withColumn("title", F.lit("new")).withColumn("word_count", F.lit(0)))
    return upsert(docs, new.unionByName(shared), "document_id", ["content_hash", "word_count"])


def q_upsert_full(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.lit(0.0))
    return upsert(c, new, "c_custkey")


def q_dims(spark: SparkSession, d: str) -> DataFrame:
    return get_or_create(table(spark, d, "companies"), "company_id", "company_name", _docs(spark, d), "company")


def q_insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "document_chunks").dropDuplicates(["chunk_id"]).select("chunk_id", "document_id", "word_count")
    return insert_ignore(chunks.where("word_count < 300"), chunks.withColumn("word_count", F.lit(-1)), "chunk_id")


def missing_vectors(chunks: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that lack the vector of any of the models' columns."""
    return chunks.where(F.expr(" or ".join(f"`{c}` is null" for c in columns)))


def update_vectors(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """Every row of ``old`` with the vector that ``new`` has for its key, else its own."""
    fresh = new.select(key, F.col(column).alias("__fresh"))
    return old.join(fresh, key, "left").withColumn(column, F.coalesce("__fresh", column)).drop("__fresh")


def q_missing_vectors(spark: SparkSession, d: str) -> DataFrame:
    return missing_vectors(table(spark, d, "document_chunks").dropDuplicates(["chunk_id"]), ["embedding"]).select("chunk_id", "chunk_no")


def q_embedding_update(spark: SparkSession, d: str) -> DataFrame:
    """Vectors for the chunks that lack one; all others keep theirs."""
    chunks = table(spark, d, "document_chunks").dropDuplicates(["chunk_id"])
    new = missing_vectors(chunks, ["embedding"]).select("chunk_id", F.transform(F.sequence(F.lit(1), F.lit(384)), lambda i: (i / 384).cast("float")).alias("embedding"))
    done = update_vectors(chunks, new, "chunk_id", "embedding")
    return done.select("chunk_id", F.size("embedding").cast("bigint").alias("dims"), F.round(F.get("embedding", 0).cast("double"), 6).alias("first"))


def q_resume(spark: SparkSession, d: str) -> DataFrame:
    """Pairs still to be graded after a left merge with those done."""
    pairs = table(spark, d, "query_logs").dropDuplicates(["id"]).where("top_k_chunk_ids is not null").select("id", F.explode("top_k_chunk_ids").alias("chunk_no"))
    done = pairs.where("(id + chunk_no) % 2 = 0").distinct().withColumn("grade", F.lit(1))
    return pairs.distinct().join(done, ["id", "chunk_no"], "left").groupBy(F.col("grade").isNull().alias("pending")).agg(F.count("*").alias("n"))


def q_distinct_queries(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "query_logs").where("query_text is not null")
    return logs.groupBy(F.dayofweek("logged_at").cast("bigint").alias("weekday")).agg(F.countDistinct("query_text").alias("queries"))


def q_watermark(spark: SparkSession, d: str) -> DataFrame:
    """Newest scraped_at of each platform and what came after the batch before last."""
    raw = table(spark, d, "scraped_documents")
    mark = raw.agg(F.max("scrape_batch_id").alias("newest"))
    return raw.join(F.broadcast(mark)).groupBy(text.platform(F.col("source_platform")).alias("platform")).agg(F.max("scraped_at").alias("watermark"), F.count_if(F.col("scrape_batch_id") == F.col("newest")).alias("in_newest"))  # mark is one row


def q_top_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("source")).limit(10)


def q_load_summary(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "scraped_documents")
    bad = text.is_blank(F.col("raw_content"))
    return raw.groupBy("scrape_batch_id").agg(F.count("*").alias("total"), F.count_if(~bad).alias("inserted"), F.count_if(bad).alias("skipped"), F.array_join(F.sort_array(F.collect_list(F.when(bad, F.col("record_no")))).cast("array<string>"), ",").alias("skipped_records"))


def q_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Chunks announced by total_chunks against chunks delivered, by document, where they differ."""
    chunks = table(spark, d, "document_chunks").dropDuplicates(["chunk_id"])
    g = chunks.groupBy("document_id").agg(F.max("total_chunks").cast("bigint").alias("announced"), F.count("*").alias("delivered"))
    return g.where("announced <> delivered")


REPLIES = [
    '```json\n{"relevance": 2, "reason": "r"}\n```', "I would say 2.", "no idea", '{"relevance": "1"}', '{"relevance": 1.0}', '{"relevance": 7, "reason": "2 of 9"}', "score: 12", '{"reason": "none"}', '{"relevance": true}', "{broken 0",
    '{"relevance": "2.0"}', '{"relevance": null}', "",
]


def q_reply(spark: SparkSession, d: str) -> DataFrame:
    """Grades read from model replies of many forms, the logged ones among them."""
    logs = table(spark, d, "query_logs").dropDuplicates(["id"])
    made = F.coalesce(F.get(F.array(*[F.lit(r) for r in REPLIES]), (F.col("id") % (len(REPLIES) + 1)).cast("int")), "llm_response")
    return parse_reply(logs.select("id", made.alias("reply"))).groupBy("how", "grade").agg(F.count("*").alias("n"))


def parse_reply(df: DataFrame) -> DataFrame:
    """(…, how, grade): the whole number 0, 1 or 2 that a reply's JSON names as relevance, whether as a number, a text or
    a truth value; else the first of these digits anywhere in it; else an error."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce("reply", F.lit("")), r"```json|```", ""), r"^\s+|\s+$", "")
    held = df.withColumn("__body", body).withColumn("__v", F.try_variant_get(F.try_parse_json("__body"), "$.relevance", "variant"))
    kind, said = F.schema_of_variant("__v"), F.try_variant_get("__v", "$", "string")
    number = (
        F.when(kind == "STRING", F.when(said.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(said).try_cast("bigint")))
        .when(kind == "BOOLEAN", F.when(said == "true", 1).otherwise(0).cast("bigint"))
        .otherwise(F.try_variant_get("__v", "$", "double").try_cast("bigint"))
    )
    graded = F.when(number.between(0, 2), number)
    digit = F.nullif(F.regexp_extract("__body", "[012]", 0), F.lit(""))
    how = F.when(graded.isNotNull(), "json").when(digit.isNotNull(), "parse_fallback").otherwise("error")
    return held.withColumn("how", how).withColumn("grade", F.coalesce(graded, digit.cast("bigint")).cast("int")).drop("__body", "__v")


def whole_grades(df: DataFrame, column: str) -> DataFrame:
    """Rows whose grade is a number, cut to a whole one."""
    return df.withColumn(column, F.col(column).try_cast("double")).where(F.col(column).isNotNull() & ~F.isnan(column)).withColumn(column, F.col(column).cast("int"))


def q_whole_grades(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "query_logs").dropDuplicates(["id"])
    made = F.get(F.array(*[F.lit(x) for x in ("2", "1.0", "x", "", "NaN")]), (F.col("id") % 6).cast("int"))
    return whole_grades(logs.select("id", made.alias("relevance")), "relevance")


def q_judged(spark: SparkSession, d: str) -> DataFrame:
    """Judged pairs of a query in order of their grades, the best first."""
    logs = table(spark, d, "query_logs").dropDuplicates(["id"]).where("top_k_chunk_ids is not null")
    judged = logs.select("id", F.explode(F.array_distinct("top_k_chunk_ids")).alias("chunk_no")).withColumn("relevance", (F.col("chunk_no") % 3).cast("int"))
    return judged.groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("relevance")).alias("r"), "chunk_no"))), lambda x: x["chunk_no"].cast("string")), ",").alias("chunks"))


def q_metadata(spark: SparkSession, d: str) -> DataFrame:
    """source_metadata as JSON where it is whole: how many records have which keys."""
    raw = table(spark, d, "scraped_documents")
    keys = F.json_object_keys("source_metadata")
    return raw.select(F.when(F.col("source_metadata").isNull(), "null").when(F.expr("try_parse_json(source_metadata)").isNull(), "broken").otherwise("whole").alias("state"), F.coalesce(F.size(keys), F.lit(0)).alias("n_keys")).groupBy("state").agg(F.count("*").alias("n"))


def q_pricing(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").where("l_shipdate <= '1998-09-02'")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


def q_supplier_part(spark: SparkSession, d: str) -> DataFrame:
    li, s, p = table(spark, d, "lineitem"), table(spark, d, "supplier"), table(spark, d, "part")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    return j.groupBy("s_name", "p_brand").agg(F.round(F.sum("l_quantity"), 2).alias("qty"))


def q_event_props(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.get_json_object("props", "$.k").isNotNull()).alias("with_k"), F.round(F.sum("value"), 4).alias("total"))


QUERIES = {
    "left_join_enrich": q_left_join, "inner_join_retrievable": q_inner_join, "not_in_null_aware": q_not_in, "upsert_partial_columns": q_upsert_partial, "upsert_full": q_upsert_full, "get_or_create_dim": q_dims,
    "insert_ignore": q_insert_ignore, "embedding_update": q_embedding_update, "missing_vectors": q_missing_vectors, "whole_grades": q_whole_grades, "judged_in_order": q_judged, "resume_left_merge": q_resume, "distinct_queries_by_weekday": q_distinct_queries, "watermark_incremental": q_watermark,
    "top_sources": q_top_sources, "load_summary": q_load_summary, "count_reconciliation": q_reconcile, "llm_reply_parse": q_reply, "metadata_state": q_metadata, "pricing_summary": q_pricing, "supplier_part_quantity": q_supplier_part, "event_props": q_event_props,
}

_BLANK = r"coalesce(regexp_replace({0}, '[ \t\n\r\f\v]+', '', 'g'), '') = ''"
_STRIP = r"regexp_replace({0}, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g')"
SQL = {
    "left_join_enrich": "SELECT r_name, n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "inner_join_retrievable": f"SELECT company_name, r.title, count(*) AS n_chunks FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks) JOIN (SELECT DISTINCT document_id, company, role FROM (SELECT DISTINCT * FROM processed_documents) WHERE NOT ({_BLANK.format('company')}) AND NOT ({_BLANK.format('role')})) USING (document_id) JOIN companies ON lower(company) = lower(company_name) JOIN role_titles r ON lower(role) = lower(r.title) GROUP BY ALL",
    "not_in_null_aware": "SELECT DISTINCT document_id FROM processed_documents WHERE document_id NOT IN (SELECT document_id FROM document_chunks)",
    "upsert_partial_columns": """
        WITH o AS (SELECT document_id, title, content_hash, word_count, scrape_batch_id FROM (SELECT DISTINCT document_id, title, content_hash, word_count, scrape_batch_id FROM processed_documents) QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY content_hash) = 1),
        n AS (SELECT document_id, title, content_hash, -1 AS word_count, scrape_batch_id FROM scraped_documents WHERE document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY record_no) = 1),
        s AS (SELECT * FROM n UNION ALL SELECT document_id, 'new', content_hash, 0, scrape_batch_id FROM o WHERE word_count % 2 = 0)
        SELECT document_id, CASE WHEN o.document_id IS NULL THEN s.title ELSE o.title END AS title, CASE WHEN s.document_id IS NULL THEN o.content_hash ELSE s.content_hash END AS content_hash,
          CASE WHEN s.document_id IS NULL THEN o.word_count ELSE s.word_count END AS word_count, CASE WHEN o.document_id IS NULL THEN s.scrape_batch_id ELSE o.scrape_batch_id END AS scrape_batch_id FROM o FULL JOIN s USING (document_id)""",
    "upsert_full": "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer",
    "get_or_create_dim": f"""
        WITH f AS (SELECT lower({_STRIP.format('company')}) AS k, min({_STRIP.format('company')}) AS company_name FROM processed_documents WHERE NOT ({_BLANK.format('company')}) GROUP BY 1)
        SELECT company_id, company_name FROM companies UNION ALL SELECT (SELECT max(company_id) FROM companies) + row_number() OVER (ORDER BY k), company_name FROM f WHERE k NOT IN (SELECT lower({_STRIP.format('company_name')}) FROM companies)""",
    "insert_ignore": "SELECT chunk_id, document_id, CASE WHEN word_count < 300 THEN word_count ELSE -1 END AS word_count FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks)",
    "missing_vectors": "SELECT DISTINCT chunk_id, chunk_no FROM document_chunks WHERE embedding IS NULL",
    "embedding_update": "SELECT chunk_id, coalesce(len(embedding), 384) AS dims, CASE WHEN embedding IS NULL THEN round((1 / 384)::FLOAT::DOUBLE, 6) ELSE round(embedding[1]::DOUBLE, 6) END AS first FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks)",
    "whole_grades": "SELECT id, CASE id % 6 WHEN 0 THEN 2 ELSE 1 END AS relevance FROM (SELECT DISTINCT id FROM query_logs) WHERE id % 6 < 2",
    "judged_in_order": "SELECT id, string_agg(chunk_no::VARCHAR, ',' ORDER BY chunk_no % 3 DESC, chunk_no) AS chunks FROM (SELECT DISTINCT id, unnest(top_k_chunk_ids) AS chunk_no FROM (SELECT DISTINCT ON (id) * FROM query_logs)) GROUP BY id",
    "resume_left_merge": "SELECT (id + chunk_no) % 2 <> 0 AS pending, count(*) AS n FROM (SELECT DISTINCT id, unnest(top_k_chunk_ids) AS chunk_no FROM (SELECT DISTINCT ON (id) * FROM query_logs)) GROUP BY 1",
    "distinct_queries_by_weekday": "SELECT dayofweek(logged_at AT TIME ZONE 'UTC') + 1 AS weekday, count(DISTINCT query_text) AS queries FROM query_logs WHERE query_text IS NOT NULL GROUP BY 1",
    "watermark_incremental": "SELECT CASE p WHEN 'geeksforgeeks' THEN 'gfg' WHEN 'geeks for geeks' THEN 'gfg' WHEN 'geeks' THEN 'gfg' WHEN 'medium.com' THEN 'medium' WHEN 'lc' THEN 'leetcode' WHEN 'leet code' THEN 'leetcode' ELSE p END AS platform, max(scraped_at) AS watermark, count(*) FILTER (scrape_batch_id = (SELECT max(scrape_batch_id) FROM scraped_documents)) AS in_newest FROM (SELECT *, " + _STRIP.format("lower(source_platform)") + " AS p FROM scraped_documents) GROUP BY 1",
    "top_sources": "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source NULLS LAST LIMIT 10",
    "load_summary": f"SELECT scrape_batch_id, count(*) AS total, count(*) FILTER (NOT b) AS inserted, count(*) FILTER (b) AS skipped, coalesce(string_agg(record_no::VARCHAR, ',' ORDER BY record_no) FILTER (b), '') AS skipped_records FROM (SELECT *, {_BLANK.format('raw_content')} AS b FROM scraped_documents) GROUP BY 1",
    "count_reconciliation": "SELECT document_id, max(total_chunks) AS announced, count(*) AS delivered FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks) GROUP BY 1 HAVING max(total_chunks) <> count(*)",
    # what each form means is written out from the rule; the logged replies are parsed
    "llm_reply_parse": r"""
        WITH l AS (SELECT id % 14 AS k, CASE WHEN id % 14 = 13 THEN trim(replace(replace(coalesce(llm_response, ''), '```json', ''), '```', ''), ' ' || chr(9) || chr(10) || chr(13)) END AS b FROM (SELECT DISTINCT ON (id) * FROM query_logs)),
        j AS (SELECT *, CASE WHEN json_valid(b) THEN try_cast(json_extract_string(b, '$.relevance') AS BIGINT) END AS g FROM l)
        SELECT CASE WHEN k IN (0, 3, 4, 8) OR (k = 13 AND g BETWEEN 0 AND 2) THEN 'json' WHEN k IN (1, 5, 6, 9, 10) OR (k = 13 AND regexp_matches(b, '[012]')) THEN 'parse_fallback' ELSE 'error' END AS how,
          CASE WHEN k IN (0, 1, 5, 10) THEN 2 WHEN k IN (3, 4, 6, 8) THEN 1 WHEN k = 9 THEN 0 WHEN k = 13 AND g BETWEEN 0 AND 2 THEN g WHEN k = 13 THEN try_cast(nullif(regexp_extract(b, '[012]'), '') AS BIGINT) END AS grade, count(*) AS n FROM j GROUP BY ALL""",
    "metadata_state": "SELECT CASE WHEN source_metadata IS NULL THEN 'null' WHEN NOT json_valid(source_metadata) THEN 'broken' ELSE 'whole' END AS state, count(*) AS n FROM scraped_documents GROUP BY 1",
    "pricing_summary": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY ALL",
    "supplier_part_quantity": "SELECT s_name, p_brand, round(sum(l_quantity), 2) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL",
    "event_props": "SELECT event_type, count(*) AS n, count(*) FILTER (json_extract(props, '$.k') IS NOT NULL) AS with_k, round(sum(value), 4) AS total FROM events GROUP BY 1",
}
