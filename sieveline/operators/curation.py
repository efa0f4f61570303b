"""Curation steps: normalize, redact, score, deduplicate, tag, validate. Rows are tagged, never dropped:
each step adds its columns and may set ``filter_reason``; the first failing check wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions import rules, text
from sieveline.functions.entities import alias_map, named
from sieveline.operators.dedup import near_dup_keep
from sieveline.plans.runtime import ensure_spread, staged, table


# --- steps --------------------------------------------------------------------------------------------
def normalize(df: DataFrame) -> DataFrame:
    body = text.normalize_body(F.col("raw_content"), F.col("source_platform"))
    out = df.withColumn("content", body).withColumn("clean_title", text.normalize_title(F.col("title")))
    reason = F.when(text.is_blank(F.col("raw_content")), "empty_raw_content").when(F.length("content") < 20, "empty_after_cleaning")
    return tag(out.withColumn("word_count", text.word_count(F.col("content"))), "content_normalizer", reason)


def tag(df: DataFrame, step: str, reason: Column) -> DataFrame:
    """Set filter_reason and filtered_at where no earlier step has."""
    if "filter_reason" not in df.columns:
        df = df.withColumn("filter_reason", F.lit(None).cast("string")).withColumn("filtered_at", F.lit(None).cast("string"))
    now = F.when(F.col("filter_reason").isNull(), reason)
    return df.withColumn("__now", now).withColumn("filtered_at", F.when(F.col("__now").isNotNull(), step).otherwise(F.col("filtered_at"))).withColumn("filter_reason", F.coalesce("filter_reason", "__now")).drop("__now")


def redact(df: DataFrame, column: str = "content", pii: list = rules.PII) -> DataFrame:
    """Rules in order, each counted on the text the ones before left; counts as a map of types > 0. NULL stays NULL."""
    done = df.withColumn("__redacted", text.redactor(pii)(F.col(column)))
    return done.withColumns({column: F.col("__redacted.content"), "pii_counts": F.col("__redacted.counts")}).drop("__redacted")


def signal_ratio(c: Column, keywords: list[str] = rules.SIGNALS) -> Column:
    """Share of the lower-case words that are signal words; punctuation is not stripped."""
    kw = F.array(*[F.lit(k) for k in keywords])
    w = text.words(F.lower(c))
    return F.when(text.is_blank(c), 0.0).otherwise(F.size(F.filter(w, lambda x: F.array_contains(kw, x))) / F.greatest(text.word_count(c), F.lit(1)))


def quality_score(words: Column, ratio: Column) -> Column:
    """Half length, half signal, rounded half to even at three places."""
    length = F.when(words < 200, words / 200).when(words <= 2000, F.lit(1.0)).otherwise(F.greatest(F.lit(0.5), 1 - (words - 2000) / 10000))
    return F.bround(0.5 * length + 0.5 * F.least(F.lit(1.0), ratio / 0.10), 3)


STOP_WORDS = {
    # Frequent words that tell the languages apart.
    "en": ["the", "and", "of", "to", "was", "in", "that", "for", "with", "they"],
    "de": ["der", "die", "und", "das", "ich", "nicht", "mit", "ein", "war", "auf"],
    "fr": ["le", "la", "les", "des", "est", "une", "pour", "dans", "que", "avec"],
    "es": ["el", "los", "las", "una", "para", "con", "que", "por", "del", "muy"],
    "hi": ["के", "में", "का", "की", "और", "से", "को", "पर", "है", "था"],
}


def language(c: Column, sample: int = 1000) -> Column:
    """The language whose frequent words occur most in the first ``sample`` characters; 'unknown' if none."""
    w = text.words(F.lower(F.substring(c, 1, sample)))

    def hit(i: int, name: str, stop: list[str]) -> Column:
        return F.struct(F.size(F.filter(w, lambda x: x.isin(stop))).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("lang"))

    hits = [hit(i, name, stop) for i, (name, stop) in enumerate(STOP_WORDS.items())]
    best = F.array_max(F.array(*hits))
    return F.when(best["n"] > 0, best["lang"]).otherwise("unknown")


def quality(df: DataFrame) -> DataFrame:
    c = F.col("content")
    n = F.col("word_count")
    df = df.withColumn("signal_ratio", signal_ratio(c))
    reason = (
        F.when(n < rules.MIN_WORDS, F.concat(F.lit("too_short_"), n.cast("string"), F.lit("_words")))
        .when(n > rules.MAX_WORDS, F.concat(F.lit("too_long_"), n.cast("string"), F.lit("_words")))
        .when(F.substring(c, 1, 500).rlike("(?i)" + "|".join(rules.ERROR_PAGES)), "error_page")
        .when((F.length(c) >= 50) & ~language(c).isin("en", "unknown"), "non_english")
        .when(F.col("signal_ratio") < rules.MIN_SIGNAL, "low_interview_signal")
    )
    return tag(df.withColumn("quality_score", quality_score(n, F.col("signal_ratio"))), "quality_filter", reason)


def deduplicate(df: DataFrame, existing: DataFrame | None = None, key: str = "content", order: str = "record_no") -> DataFrame:
    """Row by row in the unique ``order``: a duplicate is exact if its normalized hash is that of a row kept before
    or of ``existing`` (content_hash), near if its word shingles are similar to a row's kept before."""
    df = staged(df.withColumn("content_hash", text.content_key(F.col(key))), "dedup-rows")
    live = F.col("filter_reason").isNull() & ~text.is_blank(F.col(key))
    rank = F.row_number().over(Window.partitionBy(F.when(live, F.col("content_hash")).otherwise(F.col(order).cast("string"))).orderBy(order))  # others stand alone
    seen = F.lit(False)
    if existing is not None:
        df = df.join(existing.select("content_hash").distinct().withColumn("__seen", F.lit(True)), "content_hash", "left")
        seen = F.coalesce("__seen", F.lit(False))
    first = df.where(live & ~seen).groupBy("content_hash").agg(F.min_by(key, order).alias(key), F.min(order).alias(order))
    near = near_dup_keep(first, order, key)
    # copies of a near duplicate are near duplicates too: its hash was never kept
    verdict = first.select("content_hash", order).join(near, order).select("content_hash", "near_duplicate_of")
    df = df.withColumn("__rank", rank).join(verdict, "content_hash", "left").withColumn("near_duplicate_of", F.when(live, F.col("near_duplicate_of")))
    reason = (
        F.when(text.is_blank(F.col(key)), "empty_content_at_dedup")
        .when(seen, "exact_duplicate")
        .when(F.col("near_duplicate_of").isNotNull(), "near_duplicate")
        .when(F.col("__rank") > 1, "exact_duplicate")
    )
    return tag(df, "deduplicator", reason).drop("__rank", "__seen")


def titled_company(title: Column) -> Column:
    """The first form of a title that gives a company of 2 to 50 signs."""
    found = [text.strip(F.regexp_extract(title, p, 1)) for p in rules.TITLE_COMPANY]
    return F.coalesce(*[F.when(F.length(t).between(2, 50), t) for t in found])


def entities(df: DataFrame, companies: DataFrame | None = None, roles: DataFrame | None = None) -> DataFrame:
    """Company and role by the title's form and the lists' names and aliases, topics, level, types, rounds, outcome
    and difficulty from title and text."""
    c, low = F.col("content"), F.lower("content")
    types = F.array_compact(F.array(*[F.when(c.rlike(text.any_of(k)), F.lit(n)) for n, k in rules.INTERVIEW_TYPES.items()]))
    tail = F.substring(c, F.floor(F.length(c) * 0.7).cast("int") + 1, F.length(c))
    return (
        df.withColumn("__named", named(F.col("clean_title"), c, titled_company(F.col("clean_title")), alias_map(companies, "company_id", "company_name"), alias_map(roles, "role_id", "title")))
        .select(*[F.col(f"`{x}`") for x in df.columns], F.col("__named.company"), F.col("__named.role"), F.col("__named.topics"))
        .withColumn("experience_level", text.first_label(F.concat_ws(" ", "clean_title", c), rules.LEVELS, F.lit("unknown")))
        .withColumn("interview_types", F.when(F.size(types) == 0, F.array(F.lit("unknown"))).otherwise(types))
        .withColumn("num_rounds", num_rounds(low))
        .withColumn("interview_outcome", F.coalesce(text.first_label(tail, rules.OUTCOMES), text.first_label(c, rules.OUTCOMES), F.lit("unknown")))
        .withColumn("difficulty", text.first_label(c, rules.DIFFICULTIES, F.lit("unknown")))
    )


def num_rounds(low: Column) -> Column:
    """The larger of the highest "N rounds" (or "N round", "N stages") and the number of distinct round phrases; 0 becomes
    NULL. Numbers beyond 64 bits are passed over."""
    said = F.array_max(F.transform(F.regexp_extract_all(low, F.lit(r"(\d+)\s*(?:rounds?|stages?)"), 1), lambda x: x.try_cast("bigint")))
    found = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(low, F.lit(p), 1) for p in rules.ROUND_COUNTS])))
    return F.nullif(F.greatest(F.coalesce(said, F.lit(0).cast("bigint")), F.size(found).cast("bigint")), F.lit(0).cast("bigint"))


def safe_enum(c: Column, valid: list[str]) -> Column:
    v = F.lower(text.strip(c))
    return F.when(v.isin(valid), v)


def missing_fields(columns: list[str] = rules.REQUIRED, held: dict[str, Column] | None = None) -> Column:
    """Names of the required columns that are NULL or blank, in order; ``held`` gives their values if not the columns."""
    values = held or {c: F.col(c) for c in columns}
    return F.array_compact(F.array(*[F.when(text.is_blank(values[c].cast("string")), F.lit(c)) for c in columns]))


def database_enum(c: Column, valid: list[str]) -> Column:
    """The value as it stands if the database knows it, else NULL; 'unknown' is not stored."""
    return F.when(c.isin([v for v in valid if v != "unknown"]), c)


def project(df: DataFrame, columns: list[str] = rules.TARGET, renames: dict[str, str] | None = None) -> DataFrame:
    """The target columns in order, from their own name or the one given in ``renames``; absent ones are NULL."""
    held = {renames.get(c, c) if renames else c: c for c in df.columns}
    return df.select(*[F.col(f"`{held[c]}`").alias(c) if c in held else F.lit(None).cast("string").alias(c) for c in columns])


def validate(df: DataFrame, required: list[str] = rules.REQUIRED) -> DataFrame:
    """A required column that is NULL, blank or not there is missing; of titles the cleaned one counts, if there is one."""
    held = {c: F.col(c) for c in required if c in df.columns} | ({"title": F.col("clean_title")} if "clean_title" in df.columns else {})
    df = df.withColumn("missing", missing_fields(required, {c: held.get(c, F.lit(None)) for c in required}))
    reason = F.when(F.size("missing") > 0, F.concat(F.lit("missing_"), F.array_join("missing", "_"))).when(~text.platform(F.col("source_platform")).isin(rules.VALID_PLATFORMS), "invalid_platform")
    for name, valid in rules.ENUMS.items():
        if name in df.columns:
            df = df.withColumn(name, safe_enum(F.col(name), valid))
    return tag(df, "schema_validator", reason).drop("missing")


# --- registry and pipeline ----------------------------------------------------------------------------
REGISTRY = {"content_normalizer": normalize, "pii_remover": redact, "quality_filter": quality, "deduplicator": deduplicate, "entity_extractor": entities, "schema_validator": validate}


def register_step(name: str, step) -> None:  # noqa: ANN001
    REGISTRY[name] = step


def run_pipeline(df: DataFrame, steps: list[str | tuple[str, dict]]) -> DataFrame:
    """Apply registered steps in order; an unknown name is a ValueError."""
    for step in steps:
        name, options = step if isinstance(step, tuple) else (step, {})
        if name not in REGISTRY:
            raise ValueError(f"unknown step: {name}")
        df = REGISTRY[name](df, **options)
    return df


def step_stats(df: DataFrame, steps: list[str]) -> DataFrame:
    """(step, rows_in, rows_filtered, rows_out, pass_rate) from the tags, in one aggregation."""
    at = F.create_map(*[x for i, s in enumerate(steps) for x in (F.lit(s), F.lit(i))])
    total = df.select(F.coalesce(F.element_at(at, F.col("filtered_at")), F.lit(len(steps))).alias("left_at"))
    cells = [F.struct(F.lit(s).alias("step"), F.count_if(F.col("left_at") >= i).alias("rows_in"), F.count_if(F.col("left_at") == i).alias("rows_filtered")) for i, s in enumerate(steps)]
    one = total.agg(F.array(*cells).alias("cells"))
    s = one.select(F.explode("cells").alias("c")).select("c.*")
    return s.withColumn("rows_out", F.col("rows_in") - F.col("rows_filtered")).withColumn("pass_rate", F.when(F.col("rows_in") > 0, F.col("rows_out") / F.col("rows_in")).otherwise(0.0))


# --- queries ------------------------------------------------------------------------------------------
def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scraped_documents")


def _spread(spark: SparkSession, d: str) -> DataFrame:
    """The same for work that costs much a row: a small file would be one task."""
    return ensure_spread(_raw(spark, d))


STEPS = ["content_normalizer", "pii_remover", "quality_filter", "deduplicator", "entity_extractor", "schema_validator"]


def _run(spark: SparkSession, d: str) -> DataFrame:
    """All steps over the scraped documents; accepted documents count as seen."""
    options = {
        "deduplicator": {"existing": table(spark, d, "processed_documents")},
        "entity_extractor": {"companies": table(spark, d, "companies"), "roles": table(spark, d, "role_titles")},
    }
    return run_pipeline(_spread(spark, d).drop("content_hash"), [(s, options.get(s, {})) for s in STEPS])


def q_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d).select(
        "record_no", "filtered_at", "filter_reason", "near_duplicate_of", "word_count", "quality_score", "company", "role", "topics", "experience_level", "num_rounds", "interview_outcome", "difficulty"
    )


def q_step_stats(spark: SparkSession, d: str) -> DataFrame:
    return step_stats(_run(spark, d), STEPS)


def q_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d).where("filter_reason is not null").groupBy("filtered_at", "filter_reason").agg(F.count("*").alias("n"))


def q_word_count(spark: SparkSession, d: str) -> DataFrame:
    n = text.word_count(F.col("raw_content"))
    verdict = F.when(n < 50, "too_short").when(n > 15000, "too_long").otherwise("ok")
    return _raw(spark, d).select("record_no", n.cast("bigint").alias("n_words"), verdict.alias("verdict"))


def q_signal(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("raw_content")
    n, r = text.word_count(c), signal_ratio(c)
    return _raw(spark, d).select("record_no", F.round(r, 9).alias("signal_ratio"), F.round(F.when(n < 200, n / 200).when(n <= 2000, F.lit(1.0)).otherwise(F.greatest(F.lit(0.5), 1 - (n - 2000) / 10000)), 9).alias("length_score"))


def q_error_pages(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).where(F.substring("raw_content", 1, 500).rlike("(?i)" + "|".join(rules.ERROR_PAGES))).select("record_no")


def q_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(~text.is_blank(F.col("text")))
    return docs.select(F.lower("lang").alias("labelled"), language(F.col("text")).alias("detected")).groupBy("labelled", "detected").agg(F.count("*").alias("n"))


def q_pii_counts(spark: SparkSession, d: str) -> DataFrame:
    out = redact(_spread(spark, d).select("record_no", F.col("raw_content").alias("content")))
    return out.select("record_no", F.explode("pii_counts").alias("pii_type", "n"))


def q_pii_redact(spark: SparkSession, d: str) -> DataFrame:
    return redact(_spread(spark, d).select("record_no", F.col("raw_content").alias("content"))).select("record_no", "content")


def q_pii_portable(spark: SparkSession, d: str) -> DataFrame:
    out = redact(_spread(spark, d).select("record_no", F.col("raw_content").alias("content")), pii=[r for r in rules.PII if r[0] == "email"])
    return out.select("record_no", "content", F.coalesce(F.element_at("pii_counts", "email"), F.lit(0)).cast("bigint").alias("emails"))


def q_normalized(spark: SparkSession, d: str) -> DataFrame:
    return normalize(_raw(spark, d)).select("record_no", "clean_title", "content", "word_count", "filter_reason")


def q_spaces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.collapse(F.col("text")).alias("collapsed"))


def q_literals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(text.fix_literals(F.col("text"))).alias("fixed"))


def q_emoji(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length(text.strip_emoji(F.col("text"))).cast("bigint").alias("kept"))


def q_markdown(spark: SparkSession, d: str) -> DataFrame:
    simple = [rules.MARKDOWN[i] for i in (0, 1, 3, 4, 6, 7)]
    return table(spark, d, "documents").select("doc_id", F.md5(text.chain(F.replace("text", F.lit("\r"), F.lit("")), simple)).alias("plain"))


def q_markdown_all(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(text.strip_markdown(F.replace("text", F.lit("\r"), F.lit("")))).alias("plain"))


def q_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("text").contains("<")).select("doc_id", text.strip_html(F.col("text")).alias("plain"))


def q_document_id(spark: SparkSession, d: str) -> DataFrame:
    p = F.lower(text.strip(F.col("source_platform")))
    return _raw(spark, d).select("record_no", text.document_id(p, F.col("source_url")).alias("made_id"))


def q_platform(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).groupBy(text.platform(F.col("source_platform")).alias("platform")).agg(F.count("*").alias("n"))


def q_enums(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "processed_documents")
    return docs.select("document_id", *[safe_enum(F.col(c), v).alias(c) for c, v in rules.ENUMS.items()])


def q_database_enums(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "processed_documents")
    kinds = F.filter("interview_types", lambda x: x.isin(list(rules.INTERVIEW_TYPES)))
    return docs.select("document_id", *[database_enum(F.col(c), v).alias(c) for c, v in rules.ENUMS.items()], F.array_join(kinds, ",").alias("types"))


def q_projection(spark: SparkSession, d: str) -> DataFrame:
    """Scraped records in the columns of the processed schema; raw_content becomes content."""
    out = project(_raw(spark, d).drop("scrape_type"), renames={"raw_content": "content"})
    return out.select(*[F.md5(c).alias(c) if c == "content" else F.col(c) for c in rules.TARGET])


def q_topics(spark: SparkSession, d: str) -> DataFrame:
    """Topics without repeats, in order; NULL stays NULL."""
    return table(spark, d, "processed_documents").select("document_id", F.array_join(F.array_sort(F.array_distinct("topics")), ",").alias("topics"))


def q_missing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "processed_documents")
    return docs.select("document_id", F.array_join(missing_fields(), ",").alias("missing"))


def q_types(spark: SparkSession, d: str) -> DataFrame:
    valid = list(rules.INTERVIEW_TYPES)
    arr = F.filter(F.transform("interview_types", lambda x: F.lower(F.trim(x))), lambda x: x.isin(valid))
    return table(spark, d, "processed_documents").select("document_id", F.array_join(arr, ",").alias("types"))


def q_labels(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content")
    docs = table(spark, d, "processed_documents").distinct()
    return docs.select("document_id", text.first_label(c, rules.LEVELS, F.lit("unknown")).alias("level"), text.first_label(c, rules.DIFFICULTIES, F.lit("unknown")).alias("difficulty_found"))


def q_outcome(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content")
    tail = F.substring(c, F.floor(F.length(c) * 0.7).cast("int") + 1, F.length(c))
    return table(spark, d, "processed_documents").distinct().select("document_id", F.coalesce(text.first_label(tail, rules.OUTCOMES), text.first_label(c, rules.OUTCOMES), F.lit("unknown")).alias("outcome"))


def q_rounds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "processed_documents").distinct().select("document_id", num_rounds(F.lower("content")).cast("bigint").alias("rounds"))


def q_title_company(spark: SparkSession, d: str) -> DataFrame:
    p = rules.TITLE_COMPANY[4]
    return _raw(spark, d).select("record_no", F.nullif(text.strip(F.regexp_extract(F.coalesce("title", F.lit("")), p, 1)), F.lit("")).alias("company"))


def q_title_company_all(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("record_no", titled_company(F.col("title")).alias("company"))


def q_alias(spark: SparkSession, d: str) -> DataFrame:
    """The longest listed name or alias among a title's word runs: an equi-join on runs, no scan of all aliases."""
    listed = table(spark, d, "companies")
    alias = listed.select(F.explode(F.array_append(F.coalesce("aliases", F.array().cast("array<string>")), F.col("company_name"))).alias("a"), "company_name").select(F.lower("a").alias("alias"), "company_name")
    w = text.words(F.regexp_replace(F.lower("title"), r"[^a-z0-9 ]", " "))
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), " "))))
    titles = _raw(spark, d).where(~text.is_blank(F.col("title"))).select("record_no", w.alias("w")).select("record_no", F.explode(F.array_distinct(runs)).alias("alias"))
    found = titles.join(alias, "alias")
    return found.groupBy("record_no").agg(F.max_by("company_name", F.struct(F.length("alias"), "company_name")).alias("company"))


def q_dedup_existing(spark: SparkSession, d: str) -> DataFrame:
    key = text.content_key(F.col("raw_content"))
    new = _raw(spark, d).where(~text.is_blank(F.col("raw_content"))).select("record_no", key.alias("h"))
    old = table(spark, d, "processed_documents").select(text.content_key(F.col("content")).alias("h")).distinct()
    return new.join(old, "h", "left_anti").groupBy("h").agg(F.min("record_no").alias("record_no")).select("record_no")


def q_shingles(spark: SparkSession, d: str) -> DataFrame:
    w = text.words(F.lower("content"))
    docs = table(spark, d, "processed_documents").distinct().select("document_id", F.explode(F.array(w)).alias("w"))
    three = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 2, F.lit(1))), lambda i: F.array_join(F.slice("w", i, 3), " ")))
    return docs.select("document_id", F.when(F.size("w") == 0, 0).otherwise(F.size(three)).cast("bigint").alias("n_shingles"))


QUERIES = {
    "pipeline_run": q_pipeline, "step_stats": q_step_stats, "filter_reason_histogram": q_reasons, "word_count_bounds": q_word_count, "signal_ratio": q_signal, "error_page_filter": q_error_pages,
    "language_gate": q_language, "pii_counts": q_pii_counts, "pii_redact": q_pii_redact, "pii_emails": q_pii_portable, "normalized_documents": q_normalized, "whitespace_normalize": q_spaces,
    "literal_encoding_fix": q_literals, "emoji_strip": q_emoji, "markdown_strip": q_markdown, "html_strip": q_html, "document_id_from_url": q_document_id, "platform_alias": q_platform,
    "enum_safe_cast": q_enums, "database_enums": q_database_enums, "target_projection": q_projection, "topics_sorted": q_topics, "required_fields_missing": q_missing, "interview_types_filter": q_types, "level_first_match": q_labels, "outcome_tail_first": q_outcome, "num_rounds": q_rounds,
    "title_company": q_title_company, "title_company_all": q_title_company_all, "markdown_strip_all": q_markdown_all, "alias_lookup_longest": q_alias, "dedup_existing_hash_anti": q_dedup_existing, "shingle_counts": q_shingles,
}

_STRIP = r"regexp_replace({0}, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g')"
_WORDS = r"CASE WHEN coalesce(" + _STRIP + r", '') = '' THEN 0 ELSE len(string_split_regex(" + _STRIP + r", '[ \t\n\r\f\v]+')) END"


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _ladder(column: str, labels: dict[str, list[str]], otherwise: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({column}, '{text.any_of(k).replace(chr(39), chr(39) * 2)}') THEN '{n}'" for n, k in labels.items())
    return f"CASE {whens} {otherwise} END"


_KEY = r"sha256(regexp_replace(regexp_replace(lower({0}), '[ \t\n\r\f\v]+', ' ', 'g'), '^ | $', '', 'g'))"

_SAMPLE = "string_split_regex(" + _STRIP.format("lower(substr(text, 1, 1000))") + r", '[ \t\n\r\f\v]+')"
_HITS = ", ".join(f"len(list_filter({_SAMPLE}, lambda x: x IN ({_quoted(v)}))) AS {k}" for k, v in STOP_WORDS.items())

SQL = {
    "language_gate": f"""SELECT labelled, CASE WHEN m = 0 THEN 'unknown' {' '.join(f"WHEN {k} = m THEN '{k}'" for k in STOP_WORDS)} END AS detected, count(*) AS n FROM (
        SELECT *, greatest({', '.join(STOP_WORDS)}) AS m FROM (SELECT lower(lang) AS labelled, {_HITS} FROM documents WHERE coalesce({_STRIP.format('text')}, '') <> '')) GROUP BY ALL""",
    "word_count_bounds": f"SELECT record_no, n_words, CASE WHEN n_words < 50 THEN 'too_short' WHEN n_words > 15000 THEN 'too_long' ELSE 'ok' END AS verdict FROM (SELECT record_no, {_WORDS.format('raw_content')} AS n_words FROM scraped_documents)",
    "signal_ratio": f"""
        WITH w AS (SELECT record_no, raw_content, {_WORDS.format('raw_content')} AS n, string_split_regex({_STRIP.format('lower(raw_content)')}, '[ \\t\\n\\r\\f\\v]+') AS ws FROM scraped_documents)
        SELECT record_no, round(CASE WHEN n = 0 THEN 0.0 ELSE len(list_filter(ws, lambda x: x IN ({_quoted(rules.SIGNALS)}))) / n::DOUBLE END, 9) AS signal_ratio,
          round(CASE WHEN n < 200 THEN n / 200.0 WHEN n <= 2000 THEN 1.0 ELSE greatest(0.5, 1 - (n - 2000) / 10000.0) END, 9) AS length_score FROM w""",
    "error_page_filter": "SELECT record_no FROM scraped_documents WHERE regexp_matches(substr(raw_content, 1, 500), '(?i)" + "|".join(rules.ERROR_PAGES).replace("'", "''") + "')",
    "pii_emails": f"SELECT record_no, regexp_replace(raw_content, '{rules.PII[0][2]}', '[EMAIL]', 'g') AS content, coalesce(len(regexp_extract_all(raw_content, '{rules.PII[0][2]}')), 0) AS emails FROM scraped_documents",
    "whitespace_normalize": r"SELECT doc_id, regexp_replace(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'), '^ | $', '', 'g') AS collapsed FROM documents",
    "literal_encoding_fix": "SELECT doc_id, md5(" + "".join("replace(" for _ in rules.LITERALS if _ != "\x00") + "text" + "".join(", '{}', '{}')".format(k, v.replace("'", "''")) for k, v in rules.LITERALS.items() if k != "\x00") + ") AS fixed FROM documents",
    "markdown_strip": r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(13), ''),
        '!\[([^\]]*)\]\([^)]+\)', '', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '~~(.+?)~~', '\1', 'g'), '(?m)^#{1,6}\s+', '', 'g'), '(?m)^[-*+]\s+', '', 'g'), '(?m)^\d+\.\s+', '', 'g')) AS plain FROM documents""",
    "document_id_from_url": f"SELECT record_no, {_STRIP.format('lower(source_platform)')} || '_' || translate(substr(to_base64(unhex(sha256(source_url))), 1, 6), '+/', '-_') AS made_id FROM scraped_documents",
    "platform_alias": f"SELECT platform, count(*) AS n FROM (SELECT CASE p {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in rules.PLATFORMS.items())} ELSE p END AS platform FROM (SELECT {_STRIP.format('lower(source_platform)')} AS p FROM scraped_documents)) GROUP BY 1",
    "enum_safe_cast": "SELECT document_id, " + ", ".join(f"CASE WHEN {_STRIP.format(f'lower({c})')} IN ({_quoted(v)}) THEN {_STRIP.format(f'lower({c})')} END AS {c}" for c, v in rules.ENUMS.items()) + " FROM processed_documents",
    "database_enums": "SELECT document_id, " + ", ".join(f"CASE WHEN {c} IN ({_quoted([x for x in v if x != 'unknown'])}) THEN {c} END AS {c}" for c, v in rules.ENUMS.items()) + f", array_to_string(list_filter(interview_types, lambda x: x IN ({_quoted(list(rules.INTERVIEW_TYPES))})), ',') AS types FROM processed_documents",
    "target_projection": "SELECT document_id, source_platform, source_url, content_hash, title, md5(raw_content) AS content, " + ", ".join(f"NULL::VARCHAR AS {c}" for c in ("word_count", "company", "role", "experience_level", "interview_outcome", "difficulty", "num_rounds")) + ", published_at, scraped_at, NULL::VARCHAR AS preprocessed_at, scrape_batch_id, source_metadata FROM scraped_documents",
    "topics_sorted": "SELECT document_id, array_to_string(list_sort(list_distinct(topics)), ',') AS topics FROM processed_documents",
    "required_fields_missing": "SELECT document_id, concat_ws(',', " + ", ".join(f"CASE WHEN coalesce({_STRIP.format(c)}, '') = '' THEN '{c}' END" for c in rules.REQUIRED) + ") AS missing FROM processed_documents",
    "interview_types_filter": f"SELECT document_id, array_to_string(list_filter(list_transform(interview_types, lambda x: lower(trim(x))), lambda x: x IN ({_quoted(list(rules.INTERVIEW_TYPES))})), ',') AS types FROM processed_documents",
    "level_first_match": f"SELECT document_id, {_ladder('content', rules.LEVELS, 'ELSE ' + repr('unknown'))} AS level, {_ladder('content', rules.DIFFICULTIES, 'ELSE ' + repr('unknown'))} AS difficulty_found FROM (SELECT DISTINCT * FROM processed_documents)",
    "outcome_tail_first": f"SELECT document_id, coalesce({_ladder('substr(content, floor(length(content) * 0.7)::INT + 1)', rules.OUTCOMES, '')}, {_ladder('content', rules.OUTCOMES, '')}, 'unknown') AS outcome FROM (SELECT DISTINCT * FROM processed_documents)",
    "num_rounds": "SELECT document_id, nullif(greatest(coalesce(list_max(list_transform(regexp_extract_all(c, '(\\d+)\\s*(?:rounds?|stages?)', 1), lambda x: try_cast(x AS BIGINT))), 0), len(list_distinct(flatten(["
    + ", ".join(f"regexp_extract_all(c, '{p}', 1)" for p in rules.ROUND_COUNTS)
    + "])))), 0) AS rounds FROM (SELECT DISTINCT * REPLACE (content AS content), lower(content) AS c FROM processed_documents)",
    "title_company": f"SELECT record_no, nullif({_STRIP.format(f'regexp_extract(coalesce(title, {chr(39)*2}), {chr(39)}{rules.TITLE_COMPANY[4]}{chr(39)}, 1)')}, '') AS company FROM scraped_documents",
    "alias_lookup_longest": r"""
        WITH alias AS (SELECT lower(unnest(list_append(coalesce(aliases, []::VARCHAR[]), company_name))) AS alias, company_name FROM companies),
        t AS (SELECT record_no, ' ' || regexp_replace(regexp_replace(lower(title), '[^a-z0-9 ]', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g') || ' ' AS t FROM scraped_documents WHERE title IS NOT NULL)
        SELECT record_no, company FROM (SELECT record_no, company_name AS company, row_number() OVER (PARTITION BY record_no ORDER BY length(alias) DESC, company_name DESC) AS r FROM t JOIN alias ON contains(t, ' ' || alias || ' ')) WHERE r = 1""",
    "dedup_existing_hash_anti": f"SELECT min(record_no) AS record_no FROM (SELECT record_no, {_KEY.format('raw_content')} AS h FROM scraped_documents WHERE coalesce({_STRIP.format('raw_content')}, '') <> '') WHERE h NOT IN (SELECT {_KEY.format('content')} FROM processed_documents WHERE content IS NOT NULL) GROUP BY h",
    "shingle_counts": r"""
        WITH w AS (SELECT document_id, list_filter(string_split_regex(lower(coalesce(content, '')), '[ \t\n\r\f\v]+'), lambda x: x <> '') AS w FROM (SELECT DISTINCT * FROM processed_documents))
        SELECT document_id, CASE WHEN len(w) = 0 THEN 0 WHEN len(w) < 3 THEN 1 ELSE len(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS n_shingles FROM w""",
}
