"""Sources and sinks: raw JSON by batch and platform, JSON lines, CSV, sitemaps, pages, manifests, reports."""

from __future__ import annotations

import os
import re
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import rules, text
from sieveline.plans.runtime import stage_path, table


# --- files --------------------------------------------------------------------------------------------
def list_files(spark: SparkSession, root: str, suffix: str = "") -> list[str]:
    """Paths below ``root`` with ``suffix``, newest name first (descending)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    it, out = fs.listFiles(path, True), []
    while it.hasNext():
        out.append(it.next().getPath().toString())
    return sorted((p for p in out if p.endswith(suffix)), reverse=True)


def read_raw_json(spark: SparkSession, root: str, batch: str, platforms: list[str], schema: str) -> DataFrame:
    """One JSON document a file below ``root/batch/platform*.json``; unreadable files keep their text in _corrupt;
    ``_source_path`` tells the lineage."""
    paths = [f"{root}/{batch}/{p}*.json" for p in platforms]
    df = spark.read.schema(schema + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(paths)
    return df.select("*", F.col("_metadata.file_path").alias("_source_path"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """CSV with a header; header names are stripped, and a missing required column is a ValueError."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    missing = [c for c in required or [] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[text.strip(F.col(c)).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("escape", '"').csv(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Processed rows by batch, quarantined ones by batch and reason: one folder a value."""
    df.repartition(*by).write.mode("append").partitionBy(*by).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def latest_manifest(manifests: DataFrame, platform: str) -> DataFrame:
    """The newest manifest row (path, body) whose path holds ``scrape_`` and the platform."""
    return manifests.where(F.col("path").contains("scrape_") & F.col("path").contains(platform)).agg(F.max_by("body", "path").alias("body"))


def settings(spec: Any, env: dict[str, str] | None = None) -> Any:  # noqa: ANN401
    """Nested settings with ${NAME} replaced from the environment; an unset name is a KeyError."""
    env = dict(os.environ) if env is None else env
    if isinstance(spec, dict):
        return {k: settings(v, env) for k, v in spec.items()}
    if isinstance(spec, list):
        return [settings(v, env) for v in spec]
    return re.sub(r"\$\{(\w+)\}", lambda m: env[m.group(1)], spec) if isinstance(spec, str) else spec


# --- parsing ------------------------------------------------------------------------------------------
def sitemap_entries(xml: Column, element: str = "url") -> Column:
    """array<struct<loc, lastmod>> of a sitemap or sitemap index, whatever its namespace."""
    blocks = F.regexp_extract_all(xml, F.lit(rf"(?s)<(?:\w+:)?{element}\b[^>]*>(.*?)</(?:\w+:)?{element}>"), 1)

    def inner(b: Column, name: str) -> Column:
        return F.nullif(text.strip(F.regexp_extract(b, rf"(?s)<(?:\w+:)?{name}\b[^>]*>(.*?)</(?:\w+:)?{name}>", 1)), F.lit(""))

    return F.transform(blocks, lambda b: F.struct(inner(b, "loc").alias("loc"), inner(b, "lastmod").alias("lastmod")))


def after_cutoff(lastmod: Column, cutoff: str, bulk: bool) -> Column:
    """Bulk keeps entries without a date or from the cutoff on; incremental only those after it."""
    return (lastmod.isNull() | (lastmod >= cutoff)) if bulk else F.coalesce(lastmod > cutoff, F.lit(False))


def parse_vector(c: Column) -> Column:
    return F.from_json(c, "array<float>")


def page_title(html: Column) -> Column:
    return F.nullif(text.collapse(text.strip_html(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))), F.lit(""))


def page_meta(html: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(html, rf"(?is)<meta\s+(?:property|name)=[\"']{name}[\"']\s+content=[\"'](.*?)[\"']", 1), F.lit(""))


def paywall(html: Column) -> Column:
    """The first sign of a paywall in a page, NULL if none: the class of the article, the badge, the linked data, the
    state of its posts, then preview and call to action. Broken JSON is no sign."""
    badge, preview, call = (F.when(html.rlike(p), name) for name, p in rules.PAYWALL_TEXTS)
    metered = F.when(html.rlike(r"(?is)<article\b[^>]*\bclass=[\"'][^\"']*meteredContent"), "meteredContent class")
    linked = F.get_json_object(F.regexp_extract(html, r"(?is)<script\b[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", 1), "$.isAccessibleForFree")
    state = F.regexp_extract(html, r"(?is)<script\b[^>]*>[^<]*?__APOLLO_STATE__[^=<]*=\s*(.*?)\s*;?\s*</script>", 1)
    posts = F.map_filter(F.from_json(state, "map<string,string>"), lambda k, v: k.startswith("Post:") & v.isNotNull())

    def sign(post: Column) -> Column:
        own = F.from_json(post, "map<string,string>")
        content = F.coalesce(F.element_at(own, rules.PAYWALL_CONTENT), F.element_at(own, "content"))
        return F.coalesce(
            *[F.when(F.element_at(own, field) == "true", name) for name, field in rules.PAYWALL_STATES],
            F.when(F.get_json_object(content, "$.isLockedPreviewOnly") == "true", "Apollo content isLockedPreviewOnly"),
        )

    of_posts = F.get(F.array_compact(F.transform(F.map_values(posts), sign)), 0)
    return F.coalesce(metered, badge, F.when(linked == "false", "JSON-LD isAccessibleForFree"), of_posts, preview, call)


def wanted_url(url: Column, lastmod: Column, pattern: str, cutoff: str, bulk: bool) -> Column:
    """Does an entry's address match and its date pass? Entries without a date count in bulk only."""
    return url.rlike(pattern) & after_cutoff(lastmod, cutoff, bulk)


def listing(rows: Column) -> Column:
    """array<struct<slug, title, tags, comments>> of one page of a listing as JSON; hidden comments are left out."""
    kind = "array<struct<slug: string, title: string, tags: array<string>, comments: array<struct<body: string, hidden: boolean>>>>"
    return F.transform(
        F.from_json(rows, kind),
        lambda r: F.struct(r["slug"].alias("slug"), r["title"].alias("title"), r["tags"].alias("tags"), F.transform(F.filter(r["comments"], lambda c: ~F.coalesce(c["hidden"], F.lit(False))), lambda c: c["body"]).alias("comments")),
    )


def in_order_of_number(keys: Column) -> Column:
    """Keys such as ``p_12`` in order of the number at their end; keys without one come last."""
    number = lambda k: F.coalesce(F.nullif(F.regexp_extract(k, r"(\d+)$", 1), F.lit("")).try_cast("bigint"), F.lit(2**62))
    return F.transform(F.array_sort(F.transform(keys, lambda k: F.struct(number(k).alias("n"), k.alias("k")))), lambda x: x["k"])


def error_category(error: Column) -> Column:
    """What kind of failure a message tells of."""
    low = F.lower(error)
    return F.when(error.isNull(), "none").when(low.contains("timeout"), "timeout").when(low.contains("net::err") | low.contains("connection"), "connection").when(low.rlike(r"\b(?:4\d\d|5\d\d)\b"), "http").otherwise("other")


def published(c: Column) -> Column:
    """A date from ISO forms or day-month-year text; NULL for anything else."""
    fixed = text.strip(c)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(fixed, F.lit(f))) for f in ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss", "d MMM, yyyy", "d MMM yyyy")])


# --- queries ------------------------------------------------------------------------------------------
def q_json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Records written as JSON lines and read back with a fixed schema."""
    raw = table(spark, d, "scraped_documents").select("record_no", "document_id", "title", "raw_content")
    path = stage_path(spark, "json")
    raw.write.option("ignoreNullFields", False).json(path)
    back = read_json_lines(spark, path, "record_no bigint, document_id string, title string, raw_content string")
    return back.select("record_no", "document_id", "title", F.md5("raw_content").alias("content_md5"))


def q_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = stage_path(spark, "csv")
    write_csv(table(spark, d, "role_titles").select("role_id", "title"), path)
    back = read_csv(spark, path, ["role_id", "title"])
    return back.select(F.col("role_id").cast("int").alias("role_id"), "title")


def q_sitemap(spark: SparkSession, d: str) -> DataFrame:
    """URLs and dates of the records as a sitemap for each batch, parsed and cut off again."""
    raw = table(spark, d, "scraped_documents").where("source_url is not null")
    one = F.concat(F.lit("<url><loc>"), "source_url", F.lit("</loc>"), F.when(F.col("scraped_at").isNotNull(), F.concat(F.lit("<lastmod>"), F.substring("scraped_at", 1, 10), F.lit("</lastmod>"))).otherwise(""), F.lit("</url>"))
    # a sitemap holds 50,000 entries at most: batches are cut by a hash into maps of about 40,000
    sizes = raw.groupBy(F.col("scrape_batch_id").alias("of_batch")).agg(F.ceil(F.count("*") / 40_000).cast("int").alias("maps"))
    slot = F.pmod(F.xxhash64("record_no"), F.col("maps")).cast("int")
    maps = (
        raw.join(sizes, F.col("scrape_batch_id").eqNullSafe(F.col("of_batch")))
        .select("scrape_batch_id", slot.alias("slot"), one.alias("entry"))
        .groupBy("scrape_batch_id", "slot")
        .agg(F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>"), F.array_join(F.sort_array(F.collect_list("entry")), ""), F.lit("</urlset>")).alias("xml"))
    )
    e = maps.select("scrape_batch_id", F.explode(sitemap_entries(F.col("xml"))).alias("e"))
    return e.where(after_cutoff(F.col("e.lastmod"), "2031-04-01", True)).groupBy("scrape_batch_id").agg(F.countDistinct("e.loc").alias("urls"), F.max("e.lastmod").alias("newest"))


def q_published(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "scraped_documents")
    return raw.select("record_no", F.date_format(published(F.col("published_at")), "yyyy-MM-dd").alias("published_on"))


def q_vector_text(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", parse_vector(F.to_json("embedding")).alias("v"))
    return e.select("vec_id", F.size("v").cast("bigint").alias("dims"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"))


def q_fetch_anti(spark: SparkSession, d: str) -> DataFrame:
    """URLs of records that no accepted document has: what is still to be fetched."""
    raw = table(spark, d, "scraped_documents").where("source_url is not null").select("source_url").distinct()
    return raw.join(table(spark, d, "processed_documents").select("source_url"), "source_url", "left_anti")


def q_paywall(spark: SparkSession, d: str) -> DataFrame:
    """Pages made of the records, each with another sign or with something like one."""
    post = lambda body: F.lit('<script>window.__APOLLO_STATE__ = {"ROOT": {"isLocked": true}, "Post:1": ' + body + "};</script>")
    kinds = [
        F.lit('<article class="a meteredContent b">x</article>'), F.lit("<p>MEMBER-ONLY STORY</p>"), F.lit('<script type="application/ld+json">{"isAccessibleForFree": false}</script>'), post('{"isLocked": true}'),
        post('{"isLocked": false, "isLockedPreviewOnly": true}'), post('{"isMarkedPaywallOnly": true}'), post('{"content": {"isLockedPreviewOnly": true}}'), F.lit("<p>This is a preview of it</p>"), F.lit("<p>upgrade to continue</p>"),
        F.lit("<p>read the full story</p>"), F.lit('<script type="application/ld+json">{"isAccessibleForFree": "False"}</script>'), post('{"isLocked": "true", broken'), F.lit('<div class="meteredContent">x</div>'),
    ]
    made = F.element_at(F.array(*kinds), (F.col("record_no") % len(kinds) + 1).cast("int"))
    page = F.concat(F.lit("<html><body>"), made, F.lit("<p>"), F.coalesce("document_id", F.lit("")), F.lit("</p></body></html>"))
    return table(spark, d, "scraped_documents").select("record_no", paywall(page).alias("sign"))


def q_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of interview stories from a day on; those without a date only in bulk."""
    raw = table(spark, d, "scraped_documents").withColumn("day", F.nullif(F.substring("scraped_at", 1, 10), F.lit("")))
    bulk, newer = (wanted_url(F.col("source_url"), F.col("day"), "(?i)interview", "2031-04-01", b) for b in (True, False))
    return raw.select("record_no", bulk.alias("in_bulk"), newer.alias("when_newer"))


def q_listing(spark: SparkSession, d: str) -> DataFrame:
    """A page of a listing for each logged query, its comments hidden in turn, mapped to rows again."""
    logs = table(spark, d, "query_logs").dropDuplicates(["id"]).where("query_text is not null")
    comment = F.struct(F.col("query_text").alias("body"), (F.col("id") % 2 == 0).alias("hidden"))
    other = F.struct(F.lit("kept").alias("body"), F.lit(None).cast("boolean").alias("hidden"))
    page = F.to_json(F.array(F.struct(F.concat(F.lit("s"), "id").alias("slug"), F.col("query_text").alias("title"), F.array(F.lit("a"), F.lit("b")).alias("tags"), F.array(comment, other).alias("comments"))))
    rows = logs.select(F.explode(listing(page)).alias("r"))
    return rows.select("r.slug", F.md5("r.title").alias("title"), F.array_join("r.tags", ",").alias("tags"), F.size("r.comments").cast("bigint").alias("comments"))


def q_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Keys of paragraphs that end in numbers, put in order."""
    logs = table(spark, d, "query_logs").dropDuplicates(["id"]).where("top_k_chunk_ids is not null")
    keys = F.array_append(F.transform(F.array_distinct("top_k_chunk_ids"), lambda n: F.concat(F.lit("p_"), n.cast("string"))), F.lit("title"))
    return logs.select("id", F.array_join(in_order_of_number(keys), ",").alias("keys"))


def q_errors(spark: SparkSession, d: str) -> DataFrame:
    logs = table(spark, d, "query_logs").dropDuplicates(["id"])
    made = F.when(F.col("id") % 5 == 0, "Timeout 30s").when(F.col("id") % 5 == 1, "net::ERR_FAILED").when(F.col("id") % 5 == 2, "got 503 there").when(F.col("id") % 5 == 3, "odd")
    return logs.groupBy(error_category(made).alias("category")).agg(F.count("*").alias("n"))


QUERIES = {"paywall_signs": q_paywall, "url_filter": q_urls, "listing_rows": q_listing, "paragraph_order": q_paragraphs, "error_categories": q_errors, "json_round_trip": q_json_round_trip, "csv_round_trip": q_csv_round_trip, "sitemap_cutoff": q_sitemap, "published_dates": q_published, "vector_text_parse": q_vector_text, "fetch_anti_join": q_fetch_anti}

SQL = {
    "json_round_trip": "SELECT record_no, document_id, title, md5(raw_content) AS content_md5 FROM scraped_documents",
    "csv_round_trip": "SELECT role_id, title FROM role_titles",
    "sitemap_cutoff": "SELECT scrape_batch_id, count(DISTINCT source_url) AS urls, max(m) AS newest FROM (SELECT scrape_batch_id, source_url, nullif(trim(substr(scraped_at, 1, 10)), '') AS m FROM scraped_documents WHERE source_url IS NOT NULL) WHERE m IS NULL OR m >= '2031-04-01' GROUP BY 1",
    "published_dates": """SELECT record_no, strftime(coalesce(try_strptime(p, '%Y-%m-%d'), try_strptime(p, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(p, '%Y-%m-%dT%H:%M:%S'), try_strptime(p, '%d %b, %Y'), try_strptime(p, '%d %b %Y')), '%Y-%m-%d') AS published_on FROM (SELECT record_no, trim(published_at) AS p FROM scraped_documents)""",
    "vector_text_parse": "SELECT vec_id, len(embedding) AS dims, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings",
    "paywall_signs": "SELECT record_no, CASE record_no % 13 WHEN 0 THEN 'meteredContent class' WHEN 1 THEN 'Member-only badge' WHEN 2 THEN 'JSON-LD isAccessibleForFree' WHEN 3 THEN 'Apollo isLocked' WHEN 4 THEN 'Apollo isLockedPreviewOnly' WHEN 5 THEN 'Apollo isMarkedPaywallOnly' WHEN 6 THEN 'Apollo content isLockedPreviewOnly' WHEN 7 THEN 'Preview text' WHEN 8 THEN 'Paywall CTA' END AS sign FROM scraped_documents",
    "url_filter": "SELECT record_no, regexp_matches(source_url, '(?i)interview') AND (day IS NULL OR day >= '2031-04-01') AS in_bulk, regexp_matches(source_url, '(?i)interview') AND coalesce(day > '2031-04-01', false) AS when_newer FROM (SELECT *, nullif(substr(scraped_at, 1, 10), '') AS day FROM scraped_documents)",
    "listing_rows": "SELECT 's' || id AS slug, md5(query_text) AS title, 'a,b' AS tags, CASE WHEN id % 2 = 0 THEN 1 ELSE 2 END AS comments FROM (SELECT DISTINCT ON (id) * FROM query_logs) WHERE query_text IS NOT NULL",
    "paragraph_order": "SELECT id, array_to_string(list_append(list_transform(list_sort(list_distinct(top_k_chunk_ids)), lambda n: 'p_' || n), 'title'), ',') AS keys FROM (SELECT DISTINCT ON (id) * FROM query_logs) WHERE top_k_chunk_ids IS NOT NULL",
    "error_categories": "SELECT CASE id % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connection' WHEN 2 THEN 'http' WHEN 3 THEN 'other' ELSE 'none' END AS category, count(*) AS n FROM (SELECT DISTINCT ON (id) * FROM query_logs) GROUP BY 1",
    "fetch_anti_join": "SELECT DISTINCT source_url FROM scraped_documents WHERE source_url IS NOT NULL AND source_url NOT IN (SELECT source_url FROM processed_documents WHERE source_url IS NOT NULL)",
}
