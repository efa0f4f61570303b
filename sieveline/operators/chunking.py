"""Chunks of documents: a single chunk, structural segments at round headings, or sentence windows with overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import rules, text
from sieveline.plans.runtime import table

SIZE, OVERLAP, SINGLE_BELOW = 500, 50, 150
MARK = "\u0001"
BOUNDARY = r"(?i)(?:^|(?<=\n))(?=[ \t]*(?:" + "|".join(rules.ROUND_STARTS) + "))"


def sentences(c: Column) -> Column:
    """Split after ., ! or ? and white space; blanks dropped."""
    return F.filter(F.split(text.strip(c), r"(?<=[.!?])\s+"), lambda s: F.length(F.trim(s)) > 0)


def strategy(c: Column) -> Column:
    return F.when(text.word_count(c) < SINGLE_BELOW, "single_chunk").when(c.rlike(BOUNDARY + "."), "structural").otherwise("fixed_window")


def windows(c: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Whole sentences up to ``size`` words; the next window starts with the trailing sentences of at most
    ``overlap`` words; a longer sentence is a window of its own. One fold over the sentences, no Python."""
    unit = "struct<s:string,n:int>"
    state = f"struct<done:array<string>,cur:array<{unit}>,n:int>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast(f"array<{unit}>").alias("cur"), F.lit(0).alias("n")).cast(state)

    def total(units: Column) -> Column:
        return F.aggregate(units, F.lit(0), lambda a, u: a + u["n"])

    def step(acc: Column, s: Column) -> Column:
        n = (F.regexp_count(F.trim(s), F.lit(r"\s+")) + 1).cast("int")
        now = F.struct(s.alias("s"), n.alias("n")).cast(unit)
        fits = (acc["n"] + n <= size) | (F.size(acc["cur"]) == 0)
        # trailing sentences whose words, with those after them, stay within the overlap
        tail = F.filter(acc["cur"], lambda u, i: total(F.slice(acc["cur"], i + 1, F.size(acc["cur"]))) <= overlap)
        kept = F.struct(acc["done"].alias("done"), F.concat(acc["cur"], F.array(now)).alias("cur"), (acc["n"] + n).alias("n")).cast(state)
        cut = F.struct(F.concat(acc["done"], F.array(F.array_join(F.transform(acc["cur"], lambda u: u["s"]), " "))).alias("done"), F.concat(tail, F.array(now)).alias("cur"), (total(tail) + n).cast("int").alias("n")).cast(state)
        return F.when(fits, kept).otherwise(cut)

    def finish(acc: Column) -> Column:
        return F.when(F.size(acc["cur"]) > 0, F.concat(acc["done"], F.array(F.array_join(F.transform(acc["cur"], lambda u: u["s"]), " ")))).otherwise(acc["done"])

    return F.aggregate(sentences(c), start, step, finish)


def segments(c: Column) -> Column:
    """The text cut before every line that starts a round."""
    return F.filter(F.split(F.regexp_replace(c, BOUNDARY, MARK), MARK), lambda s: F.length(F.trim(s)) > 0)


def label(segment: Column) -> Column:
    """The first line of a segment that starts a round, at most 60 characters; otherwise Preamble."""
    first = text.strip(F.regexp_extract(F.ltrim(segment), r"^[^\n]{0,80}", 0))
    return F.when(segment.rlike(BOUNDARY + "."), F.substring(first, 1, 60)).otherwise("Preamble")


def header(company: Column, role: Column, round_label: Column, index: Column, total: Column) -> Column:
    """Company, role, round and part, leaving out what is missing."""

    def part(name: str, c: Column) -> Column:
        return F.when(~text.is_blank(c), F.concat(F.lit(name + ": "), c))

    return F.concat(F.concat_ws(" | ", part("Company", company), part("Role", role), part("Round", round_label), F.concat(F.lit("Part: "), (index + 1).cast("string"), F.lit(" of "), total.cast("string"))), F.lit(" | "))


def chunk(df: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(document_id, chunk_id, chunk_index, total_chunks, strategy, round_label, raw_text, chunk_text, word_count,
    char_start_offset, char_end_offset) of documents (document_id, content, company, role). Ids are hashes of
    document and index, so chunking again gives the same ids. Blank documents have no chunks."""
    c = F.replace(F.replace(F.col("content"), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    d = df.withColumn("content", c).where(~text.is_blank(F.col("content"))).withColumn("strategy", strategy(F.col("content")))
    pieces = F.when(F.col("strategy") == "single_chunk", F.array(F.col("content"))).when(F.col("strategy") == "structural", segments(F.col("content"))).otherwise(F.array(F.col("content")))
    cut = d.select("*", F.posexplode(pieces).alias("segment_no", "segment"))
    cut = cut.withColumn("round_label", F.when(F.col("strategy") == "structural", label(F.col("segment"))))
    inner = F.when((F.col("strategy") == "fixed_window") | (text.word_count(F.col("segment")) > size), windows(F.col("segment"), size, overlap)).otherwise(F.array(text.strip(F.col("segment"))))
    parts = cut.withColumn("parts", inner).select("document_id", "content", "company", "role", "strategy", "segment_no", "round_label", F.size("parts").alias("n_parts"), F.posexplode("parts").alias("part_no", "raw_text"))
    named = parts.withColumn("round_label", F.when((F.col("n_parts") > 1) & F.col("round_label").isNotNull(), F.concat("round_label", F.lit(" (part "), (F.col("part_no") + 1).cast("string"), F.lit(")"))).otherwise(F.col("round_label")))
    from pyspark.sql import Window

    order = Window.partitionBy("document_id").orderBy("segment_no", "part_no")
    whole = Window.partitionBy("document_id")
    out = named.withColumn("chunk_index", F.row_number().over(order) - 1).withColumn("total_chunks", F.count("*").over(whole))
    at = F.expr("locate(raw_text, content) - 1")
    return out.select(
        "document_id", F.sha2(F.concat_ws("|", "document_id", F.col("chunk_index").cast("string")), 256).alias("chunk_id"), "chunk_index", "total_chunks", "strategy", "round_label", "raw_text",
        F.concat(header(F.col("company"), F.col("role"), F.col("round_label"), F.col("chunk_index"), F.col("total_chunks")), F.col("raw_text")).alias("chunk_text"),
        text.word_count(F.col("raw_text")).alias("word_count"), F.greatest(at, F.lit(0)).alias("char_start_offset"), (F.greatest(at, F.lit(0)) + F.length("raw_text")).alias("char_end_offset"),
    )


def violations(chunks: DataFrame, most: int = 550) -> DataFrame:
    """(chunk_id, level, issue): missing ids are errors, long chunks and texts without header warnings."""
    issues = F.array_compact(F.array(
        F.when(text.is_blank(F.col("chunk_id")) | text.is_blank(F.col("document_id")), F.lit("error:missing_id")),
        F.when(F.col("word_count") > most, F.lit("warning:too_long")),
        F.when(~F.coalesce(F.col("chunk_text").contains("Part: "), F.lit(False)), F.lit("warning:no_header")),
    ))
    return chunks.select("chunk_id", F.explode(issues).alias("i")).select("chunk_id", F.split_part("i", F.lit(":"), F.lit(1)).alias("level"), F.split_part("i", F.lit(":"), F.lit(2)).alias("issue"))


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "processed_documents").distinct()


def q_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunk(_docs(spark, d)).drop("raw_text")


def q_strategies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "document_chunks").dropDuplicates(["chunk_id"]).groupBy("strategy").agg(F.countDistinct("document_id").alias("documents"), F.count("*").alias("chunks"))


def q_windows(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).where(~text.is_blank(F.col("content"))).select("document_id", F.posexplode(windows(F.col("content"))).alias("window_no", "window_text"))


def q_header(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "document_chunks").dropDuplicates(["chunk_id"])
    docs = _docs(spark, d).groupBy("document_id").agg(F.min("company").alias("company"), F.min("role").alias("role"))
    return chunks.join(docs, "document_id").select("chunk_id", header(F.col("company"), F.col("role"), F.col("round_label"), F.col("chunk_index"), F.col("total_chunks")).alias("header"))


def q_offsets(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "document_chunks").dropDuplicates(["chunk_id"])
    docs = _docs(spark, d).groupBy("document_id").agg(F.min("content").alias("content"))
    at = F.expr("coalesce(locate(raw_text, content), 0)")
    return chunks.join(docs, "document_id").select("chunk_id", F.greatest(at - 1, F.lit(0)).cast("bigint").alias("start_at"), (F.greatest(at - 1, F.lit(0)) + F.length("raw_text")).cast("bigint").alias("end_at"))


def q_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).where(~text.is_blank(F.col("content"))).select("document_id", F.size(sentences(F.col("content"))).cast("bigint").alias("n_sentences"))


def q_violations(spark: SparkSession, d: str) -> DataFrame:
    return violations(table(spark, d, "document_chunks").dropDuplicates(["chunk_id"])).groupBy("level", "issue").agg(F.count("*").alias("n"))


QUERIES = {"chunk_documents": q_chunks, "chunk_strategy_counts": q_strategies, "chunk_fixed_window": q_windows, "chunk_headers": q_header, "chunk_offsets": q_offsets, "sentence_counts": q_sentences, "chunk_violations": q_violations}

_BLANK = r"coalesce(regexp_replace({0}, '[ \t\n\r\f\v]+', '', 'g'), '') = ''"
SQL = {
    "chunk_strategy_counts": "SELECT strategy, count(DISTINCT document_id) AS documents, count(*) AS chunks FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks) GROUP BY 1",
    "chunk_headers": f"""SELECT chunk_id, concat_ws(' | ', CASE WHEN NOT ({_BLANK.format('company')}) THEN 'Company: ' || company END, CASE WHEN NOT ({_BLANK.format('role')}) THEN 'Role: ' || role END, CASE WHEN NOT ({_BLANK.format('round_label')}) THEN 'Round: ' || round_label END,
        'Part: ' || (chunk_index + 1) || ' of ' || total_chunks) || ' | ' AS header FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks) JOIN (SELECT document_id, min(company) AS company, min(role) AS role FROM processed_documents GROUP BY 1) USING (document_id)""",
    "chunk_offsets": "SELECT chunk_id, greatest(coalesce(strpos(content, raw_text), 0) - 1, 0) AS start_at, greatest(coalesce(strpos(content, raw_text), 0) - 1, 0) + length(raw_text) AS end_at FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks) JOIN (SELECT document_id, min(content) AS content FROM processed_documents GROUP BY 1) USING (document_id)",
    "sentence_counts": rf"""SELECT document_id, len(list_filter(string_split(regexp_replace(regexp_replace(content, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g'), '([.!?])[ \t\n\r\f\v]+', '\1' || chr(1), 'g'), chr(1)), lambda x: length(trim(x)) > 0)) AS n_sentences FROM (SELECT DISTINCT * FROM processed_documents) WHERE NOT ({_BLANK.format('content')})""",
    "chunk_violations": f"""SELECT level, issue, count(*) AS n FROM (SELECT DISTINCT ON (chunk_id) * FROM document_chunks), LATERAL (SELECT unnest(list_filter([
        CASE WHEN {_BLANK.format('chunk_id')} OR {_BLANK.format('document_id')} THEN 'error:missing_id' END, CASE WHEN word_count > 550 THEN 'warning:too_long' END, CASE WHEN NOT coalesce(contains(chunk_text, 'Part: '), false) THEN 'warning:no_header' END], lambda x: x IS NOT NULL)) AS i), LATERAL (SELECT split_part(i, ':', 1) AS level, split_part(i, ':', 2) AS issue) GROUP BY ALL""",
}
