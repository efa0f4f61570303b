import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sieveline.functions import text
from sieveline.operators import chunking, curation, dedup, evaluation, loading, models, monitoring, retrieval
from sieveline.plans.runtime import numbered_by
from sieveline.sources import readers


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(make(F.col("c")).alias("v")).first()["v"]


def test_word_count(spark):
    for value, n in ((None, 0), ("", 0), (" \n\t ", 0), ("a", 1), (" a  b\n\nc ", 3)):
        assert one(spark, value, text.word_count) == n


def test_quality_score(spark):
    for n, ratio, want in ((100, 0.05, 0.5), (2000, 0.2, 1.0), (12000, 0.0, 0.25)):
        df = spark.createDataFrame([(n, ratio)], "n int, r double")
        assert df.select(curation.quality_score(F.col("n"), F.col("r")).alias("v")).first()["v"] == want


def test_enum(spark):
    for value, want in ((" SENIOR ", "senior"), ("boss", None), (None, None)):
        assert one(spark, value, lambda c: curation.safe_enum(c, ["senior", "mid"])) == want


def test_rounds(spark):
    assert one(spark, "there were 5 rounds, one technical round", curation.num_rounds) == 5
    assert one(spark, "nothing", curation.num_rounds) is None
    assert one(spark, "it was a 4 round process", curation.num_rounds) == 4 and one(spark, "12345 stages, " + "9" * 40 + " rounds", curation.num_rounds) == 12345


def test_redact_counts(spark):
    df = spark.createDataFrame([("mail a@b.co or 98765 43210",), (None,)], "content string")
    got = curation.redact(df).collect()
    assert got[0]["content"] == "mail [EMAIL] or [PHONE]" and got[0]["pii_counts"] == {"email": 1, "phone": 1}
    assert got[1]["content"] is None and got[1]["pii_counts"] == {}


def test_pipeline_keeps_every_row(spark):
    raw = spark.createDataFrame([(1, "gfg", "t", "   "), (2, "gfg", "t", "x" * 30), (3, "gfg", None, None)], "record_no bigint, source_platform string, title string, raw_content string")
    out = curation.run_pipeline(raw, ["content_normalizer", "quality_filter", "deduplicator"]).collect()
    assert {r["record_no"]: r["filter_reason"] for r in out} == {1: "empty_raw_content", 2: "too_short_1_words", 3: "empty_raw_content"}
    with pytest.raises(ValueError):
        curation.run_pipeline(raw, ["no_such_step"])


def test_dedup_first_stays(spark):
    df = spark.createDataFrame([(1, "Same  Text"), (2, "same text "), (3, "other")], "record_no bigint, content string").withColumn("filter_reason", F.lit(None).cast("string")).withColumn("filtered_at", F.lit(None).cast("string"))
    out = {r["record_no"]: r["filter_reason"] for r in curation.deduplicate(df).collect()}
    assert out == {1: None, 2: "exact_duplicate", 3: None}


def test_windows_cover_sentences(spark):
    body = " ".join(f"Sentence number {i} has six words." for i in range(40))
    got = one(spark, body, lambda c: chunking.windows(c, 60, 12))
    assert all(len(w.split()) <= 60 for w in got)
    assert got[1].startswith(got[0].split(". ")[-2]) or got[0].endswith(got[1][: got[1].index(".") + 1]) or got[1].split(". ")[0] in got[0]
    assert all(f"number {i} has" in " ".join(got) for i in range(40))


def test_header(spark):
    df = spark.createDataFrame([("A", "B", None, 0, 4)], "c string, r string, l string, i int, n int")
    assert df.select(chunking.header(*[F.col(x) for x in "crlin"]).alias("h")).first()["h"] == "Company: A | Role: B | Part: 1 of 4 | "


def test_metrics(spark):
    judged = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, 0)], "query_id bigint, item_id bigint, grade int")
    queries = spark.createDataFrame([(1, "x")], "query_id bigint, category string")

    def score(order):
        results = spark.createDataFrame([(1, item, i + 1, 1.0 - i / 10) for i, item in enumerate(order)], "query_id bigint, item_id bigint, rank int, score double")
        return evaluation.per_query(results, judged, queries, 10).first()

    assert score([1, 3, 2])["rr"] == 1.0 and score([3, 1, 2])["rr"] == 0.5 and score([3, 99])["rr"] == 0.0
    assert score([1, 2, 3])["recall"] == 1.0 and score([1, 3])["recall"] == 0.5
    assert abs(score([1, 2, 3])["precision"] - 2 / 3) < 1e-12
    assert score([1, 2, 3])["ndcg"] == 1.0 and score([3, 2, 1])["ndcg"] < 1.0


def test_rrf(spark):
    kind = "query_id bigint, item_id bigint, rank int, score double"
    a = spark.createDataFrame([(1, 1, 1, 0.9), (1, 2, 2, 0.8)], kind)
    b = spark.createDataFrame([(1, 1, 1, 3.0), (1, 3, 2, 2.0)], kind)
    got = retrieval.rrf([(a, 1.0), (b, 0.5)], 3).orderBy("rank").collect()
    assert got[0]["item_id"] == 1 and abs(got[0]["score"] - (1 / 61 + 0.5 / 61)) < 1e-8


def test_vector_topk_ignores_bad_vectors(spark):
    kind = "id bigint, embedding array<float>"
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 0.0]), (5, [1.0, 0.0, 0.0])], kind)
    got = retrieval.vector_topk(items.where("id = 1"), items, 3).orderBy("rank").collect()
    assert [(r["item_id"], r["score"]) for r in got] == [(1, 1.0), (4, 1.0)]
    assert retrieval.vector_topk(items.limit(0), items, 3).count() == 0


def test_bm25_meets_by_blocks(spark):
    r, words = random.Random(4), [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(["The", *r.choices(words, k=r.randint(3, 30))])) for i in range(700)]
    texts += [(i, texts[i - 700][1]) for i in range(700, 720)] + [(720, ""), (721, " \n"), (722, "odd")]
    asked = [(i, " ".join(["the", *r.choices(words, k=4)])) for i in range(40)] + [(40, "the"), (41, "unknown"), (42, ""), (43, "ODD w1 odd")]
    df = retrieval.bm25(spark.createDataFrame(asked, "query_id int, query_text string"), spark.createDataFrame(texts, "item_id int, body string"), 10)
    got = {(x["query_id"], x["item_id"], x["score"], x["rank"]) for x in df.collect()}
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()  # documents that share a term are never listed as pairs
    held = {i: Counter(t.lower().split()) for i, t in texts}
    mean = sum(sum(c.values()) for c in held.values()) / len(held)
    raw = {t: math.log((len(held) - n + 0.5) / (n + 0.5)) for t, n in Counter(t for c in held.values() for t in c).items()}
    idf = {t: x if x >= 0 else 0.25 * sum(raw.values()) / len(raw) for t, x in raw.items()}
    want = set()
    for q, t in asked:
        terms = Counter(t.lower().split())
        scores = ((round(sum(f * idf[w] * c[w] * 2.5 / (c[w] + 1.5 * (0.25 + 0.75 * sum(c.values()) / mean)) for w, f in terms.items() if w in c), 6), i) for i, c in held.items())
        want |= {(q, i, s, n) for n, (s, i) in enumerate(sorted((x for x in scores if x[0] > 0), key=lambda x: (-x[0], x[1]))[:10], 1)}
    assert got == want


def test_matches_all_by_blocks(spark):
    r, words = random.Random(5), [f"w{i}" for i in range(12)]
    texts = [(i, " ".join(["The", *r.choices(words, k=r.randint(1, 12))])) for i in range(1200)] + [(None, "w1 w2 w3"), (1201, ""), (1202, "of")]
    asked = [(i, " ".join(["the", *r.choices(words, k=r.randint(1, 5))])) for i in range(40)] + [(40, "the of"), (41, "w1 unknown"), (42, " "), (43, "W1\tw1 OF")]
    df = retrieval.matches_all(spark.createDataFrame(asked, "query_id int, query_text string"), spark.createDataFrame(texts, "item_id int, body string"), ["the", "of"])
    got = [(x["query_id"], x["item_id"]) for x in df.collect()]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()  # documents that share a term are never listed as pairs
    needed = {q: set(t.lower().split()) - {"the", "of"} for q, t in asked}
    want = {(q, i) for q, n in needed.items() for i, t in texts if n and n <= set(t.lower().split())}
    assert set(got) == want and len(got) == len(want) and (43, None) in want


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, p string, q string")
    new = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, p string, q string")
    assert {tuple(r) for r in loading.upsert(old, new, "k", ["q"]).collect()} == {(1, "a", "x"), (2, "b", "Y"), (3, "C", "Z")}
    assert {tuple(r) for r in loading.upsert(old, new, "k").collect()} == {(1, "a", "x"), (2, "B", "Y"), (3, "C", "Z")}


def test_drift_shift_floor(spark):
    ref = spark.createDataFrame([(0, 0.0, 0.0)], "dim int, mean double, std double")
    now = spark.createDataFrame([(0, 1.0, 0.0)], "dim int, mean double, std double")
    assert monitoring.shift(ref, now).first()["shift"] == pytest.approx(1e8)


def test_reply(spark):
    cases = {
        '```json\n{"relevance": 2}\n```': ("json", 2), "grade 1": ("parse_fallback", 1), "none": ("error", None), "score: 12": ("parse_fallback", 1), '{"relevance": "2"}': ("json", 2), '{"relevance": 1.9}': ("json", 1),
        '{"relevance": "2.0"}': ("parse_fallback", 2), '{"relevance": 7}': ("error", None), '{"relevance": 70}': ("parse_fallback", 0), '{"relevance": false}': ("json", 0), "": ("error", None), '[2]': ("parse_fallback", 2),
    }
    df = spark.createDataFrame([(r,) for r in [*cases, None]], "reply string")
    assert {r["reply"]: (r["how"], r["grade"]) for r in loading.parse_reply(df).collect()} == {**cases, None: ("error", None)}


def test_not_in_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    other = spark.createDataFrame([("a",), ("a",)], "o string")
    keys = lambda x: {r["k"] for r in loading.not_in(df, "k", x, "o").collect()}
    assert keys(other) == {"b"} and keys(other.union(spark.createDataFrame([(None,)], "o string"))) == set() and keys(other.limit(0)) == {"a", "b", None}


def test_numbers_in_order(spark):
    df = spark.range(0, 500, 1, 7).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("k"))
    assert [(r["k"], r["n"]) for r in numbered_by(df, "k", "n").orderBy("n").collect()] == [(f"{i:03}", i + 1) for i in range(500)]


def test_dimension_ids(spark):
    dim = spark.createDataFrame([(1, "Acme"), (7, "Beta")], "i int, n string")
    values = spark.createDataFrame([(" acme ",), ("Zeta",), ("Gamma",), (None,), (" ",), ("zeta",)], "v string")
    assert sorted(tuple(r) for r in loading.get_or_create(dim, "i", "n", values, "v").collect()) == [(1, "Acme"), (7, "Beta"), (8, "Gamma"), (9, "Zeta")]


def test_paywall_broken_state(spark):
    page = '<script>window.__APOLLO_STATE__ = {"Post:1": {"isLocked": true, </script><p>Subscribe to read</p>'
    assert one(spark, page, readers.paywall) == "Paywall CTA" and one(spark, None, readers.paywall) is None and one(spark, "", readers.paywall) is None


def test_projection(spark):
    df = spark.createDataFrame([("d", "body")], "document_id string, raw_content string")
    row = curation.project(df, renames={"raw_content": "content"}).first()
    assert row.asDict() | {"document_id": "d", "content": "body"} == row.asDict() and list(row.asDict()) == curation.rules.TARGET and row["role"] is None


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, " "), (3, None), (4, "b A a")], "k int, t string")
    got = {r["k"]: r["embedding"] for r in models.hashed_vectors(df, "k", "t").collect()}
    slots = {w: spark.sql(f"SELECT pmod(xxhash64('{w}'), 64) AS s").first()["s"] for w in "ab"}
    assert set(got) == {1, 4} and got[1] == got[4] and slots["a"] != slots["b"]
    assert got[1][slots["a"]] == pytest.approx(2 / 5**0.5) and got[1][slots["b"]] == pytest.approx(1 / 5**0.5) and sum(map(bool, got[1])) == 2


def test_sources(spark, tmp_path):
    xml = "<s:urlset><s:url><s:loc> a </s:loc><s:lastmod>2030-01-02</s:lastmod></s:url><s:url><s:loc>b</s:loc></s:url></s:urlset>"
    assert [(x["loc"], x["lastmod"]) for x in one(spark, xml, readers.sitemap_entries)] == [("a", "2030-01-02"), ("b", None)]
    (tmp_path / "q.csv").write_text(" query_id , text\n1, a \n")
    assert readers.read_csv(spark, str(tmp_path / "q.csv")).first()["text"] == "a"
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "q.csv"), ["nope"])
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "gfg_1.json").write_text('{"document_id": "x"}')
    (tmp_path / "b" / "gfg_2.json").write_text("{broken")
    got = readers.read_raw_json(spark, str(tmp_path), "b", ["gfg"], "document_id string").collect()
    assert sorted(r["document_id"] or "" for r in got) == ["", "x"]
    assert [p.rsplit("/", 1)[1] for p in readers.list_files(spark, str(tmp_path / "b"), ".json")] == ["gfg_2.json", "gfg_1.json"]
    assert readers.settings({"a": ["${HOME_X}"]}, {"HOME_X": "1"}) == {"a": ["1"]}


def test_near_duplicates(spark):
    body = [f"w{i}" for i in range(100)]
    part = lambda start, n: " ".join(body[start : start + n])
    # 1-3 form a chain: 2 is like 1, 3 is like 2 but not like 1, so 3 stays; 4 repeats 2; 5 is too short; 6 was accepted before
    rows = [(1, part(0, 80)), (2, part(7, 80)), (3, part(14, 80)), (4, part(7, 80).upper()), (5, part(0, 9)), (6, part(20, 80)), (7, None), (8, part(0, 80))]
    df = spark.createDataFrame(rows, "record_no bigint, content string").withColumn("filter_reason", F.lit(None).cast("string")).withColumn("filtered_at", F.lit(None).cast("string"))
    old = spark.createDataFrame([(part(20, 80),)], "c string").select(text.content_key(F.col("c")).alias("content_hash"))
    got = {r["record_no"]: (r["filter_reason"], r["near_duplicate_of"]) for r in curation.deduplicate(df, old).collect()}
    near = ("near_duplicate", 1)
    assert got == {1: (None, None), 2: near, 3: (None, None), 4: near, 5: (None, None), 6: ("exact_duplicate", None), 7: ("empty_content_at_dedup", None), 8: ("exact_duplicate", None)}


def test_greedy_rejects(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (2, 5), (3, 5)], "a bigint, b bigint")
    assert {tuple(r) for r in dedup.greedy_rejects(pairs).collect()} == {(2, 1), (4, 3), (5, 3)}


def test_pipeline_asks_accepted_documents(spark, tmp_path):
    story = " ".join(f"the interview round had question number{i} and the answer" for i in range(20))
    raw = [(1, story), (2, story + " which was fine")]
    spark.createDataFrame(raw, "record_no bigint, raw_content string").selectExpr(
        "record_no", "'gfg_1' AS document_id", "'gfg' AS source_platform", "'u' AS source_url", "'Interview at Xy' AS title", "raw_content", "'' AS content_hash"
    ).write.parquet(f"{tmp_path}/scraped_documents.parquet")
    spark.createDataFrame([], "company_id int, company_name string, aliases array<string>").write.parquet(f"{tmp_path}/companies.parquet")
    spark.createDataFrame([], "role_id int, title string, aliases array<string>").write.parquet(f"{tmp_path}/role_titles.parquet")
    spark.createDataFrame([(story,)], "c string").select(text.content_key(F.col("c")).alias("content_hash")).write.parquet(f"{tmp_path}/processed_documents.parquet")
    got = {r["record_no"]: r["filter_reason"] for r in curation._run(spark, str(tmp_path)).collect()}
    assert got[1] == "exact_duplicate" and got[2] != "exact_duplicate"


def test_entities_by_lists(spark):
    companies = spark.createDataFrame([(1, "Northern Data", ["ND"]), (2, "Northern Data Labs", None)], "company_id int, company_name string, aliases array<string>")
    roles = spark.createDataFrame([(1, "Software Engineer", ["SDE"]), (2, "Data Analyst II", None)], "role_id int, title string, aliases array<string>")
    rows = [
        (1, "nd Interview Experience for sde-2", "a heap and a SQL query"),
        (2, "acme books interview experience", "I applied for Software Engineer 3 there"),
        (3, "A story", "x " * 300 + "so northern data labs called, once nd; data analyst ii"),
        (4, None, None),
    ]
    got = {r["n"]: (r["company"], r["role"], r["topics"]) for r in curation.entities(spark.createDataFrame(rows, "n int, clean_title string, content string"), companies, roles).collect()}
    assert got == {
        1: ("Northern Data", "Software Engineer 2", ["dsa", "sql_dbms"]),
        2: ("Acme Books", "Software Engineer 3", []),
        3: ("Northern Data Labs", "Data Analyst 2", []),
        4: (None, None, []),
    }


def test_validate_is_the_last_step(spark):
    assert curation.STEPS[-1] == "schema_validator"
    full = "d gfg u h t c firm job".split()
    rows = [(1, *full, "t"), (2, *full[:4], " ", *full[5:], " "), (3, *full[:6], None, full[7], "t"), (4, "d", "blog", *full[2:], "t"), (5, *full, "")]
    df = spark.createDataFrame(rows, "n int, " + ", ".join(f"{c} string" for c in curation.rules.REQUIRED) + ", clean_title string")
    got = {r["n"]: (r["filter_reason"], r["title"]) for r in curation.validate(df).collect()}
    assert got == {1: (None, "t"), 2: ("missing_title", " "), 3: ("missing_company", "t"), 4: ("invalid_platform", "t"), 5: ("missing_title", "t")}
    assert {r["filter_reason"] for r in curation.validate(df.drop("role").where("n = 1")).collect()} == {"missing_role"}
    assert [r["step"] for r in curation.step_stats(curation.validate(df), curation.STEPS).collect()][-1] == "schema_validator"


def test_whole_rule_lists(spark, tmp_path):
    titles = [(1, "Acme Labs Interview Experience"), (2, "Selected at Acme Labs"), (3, "Hiring Process at Acme Labs"), (4, "nothing"), (5, None)]
    spark.createDataFrame(titles, "record_no bigint, title string").write.parquet(f"{tmp_path}/scraped_documents.parquet")
    got = {r["record_no"]: r["company"] for r in curation.QUERIES["title_company_all"](spark, str(tmp_path)).collect()}
    assert got == {1: "Acme Labs", 2: "Acme Labs", 3: "Acme Labs", 4: None, 5: None}
    marked = "> said **bold** and _slanted_ `code`\r\n---\n```\nx = 1\n```\n"
    spark.createDataFrame([(1, marked)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = spark.range(1).select(F.md5(F.lit("said bold and slanted code\n\n [code block removed] \n")).alias("h")).first()["h"]
    assert curation.QUERIES["markdown_strip_all"](spark, str(tmp_path)).first()["plain"] == plain
