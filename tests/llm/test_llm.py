"""Operators for training data against brute force and on awkward inputs."""

import os
import random
from collections import Counter

import numpy as np
import pytest

from sieveline.llm import canonical, dartminhash, incremental, multiindex, packing, pii, shingles, spam, splitting, tokenizer

VOCABULARY = tokenizer.vocabulary_path()
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")
KIND = "record_no bigint, scrape_batch_id string, title string, raw_content string"


def story(r, n=60):
    return " ".join(r.choice("alpha beta gamma delta round coding asked tree graph hash the a of was next then".split()) + str(r.randint(0, 9)) for _ in range(n))


@pytest.fixture(scope="module")
def records():
    r, rows = random.Random(5), []
    for i in range(60):
        body = story(r)
        rows.append((len(rows) + 1, "b1" if i < 30 else "b2", f"t{i}", body))
        for _ in range(r.randint(0, 3)):
            words = body.split()
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = "edited"
            rows.append((len(rows) + 1, r.choice(["b1", "b2", "b3"]), f"t{i}", " ".join(words)))
    rows += [(1001, "b1", None, None), (1002, "b2", "", " "), (1003, None, "x", "too short"), (1004, None, "t", story(r))]
    return rows


def truth(rows):
    sets = {}
    for no, _, t, c in rows:
        w = shingles.WORD.findall(shingles.text_of(t, c).lower())
        s = set(zip(w, w[1:], w[2:], strict=False))
        if len(s) >= 10:
            sets[no] = s
    keys = sorted(sets)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if 10 * len(sets[a] & sets[b]) >= 7 * len(sets[a] | sets[b])}


def test_near_duplicates(spark, records):
    df = spark.createDataFrame(records, KIND).selectExpr("*", "1 as n", "'x' as band", "'y' as h1")
    found = dartminhash.NearDuplicates(df, "record_no", "title", "raw_content", 70, 100, 3)
    pairs = truth(records)
    assert {tuple(r) for r in found.record_pairs().collect()} == pairs
    groups = {r["record_no"]: r["class_id"] for r in found.groups().collect()}
    assert all(groups[a] == groups[b] for a, b in pairs) and 1001 not in groups and len(groups) == len({r[0] for r in records}) - 3


def test_near_duplicates_empty(spark):
    df = spark.createDataFrame([], KIND)
    found = dartminhash.NearDuplicates(df, "record_no", "title", "raw_content")
    assert found.record_pairs().count() == 0 and found.groups().count() == 0


def test_dart_similarity():
    r = np.random.default_rng(1)
    common, a, b = (r.integers(1, 2**63, n).astype(np.uint64) for n in (60, 20, 20))
    e = np.concatenate([common, a, common, b])
    s = dartminhash.signatures(e, np.repeat([0, 1], 80), np.ones(160), 2, 2000)
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.05
    weights = np.concatenate([np.full(60, 2.0), np.full(20, 1.0), np.full(60, 2.0), np.full(20, 3.0)])
    s = dartminhash.signatures(e, np.repeat([0, 1], 80), weights, 2, 2000)
    assert abs((s[0] == s[1]).mean() - 120 / 200) < 0.05
    assert (dartminhash.signatures(e[:0], np.empty(0, int), np.empty(0), 1, 8) == 0).all()


def test_incremental(spark, records):
    df = spark.createDataFrame(records, KIND)
    links, accepted, rejected = truth(records), set(), set()
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for no, *_ in sorted(records, key=lambda x: ("b" + (x[1] or ""), x[0])):
        (rejected if near.get(no, set()) & accepted else accepted).add(no)
    assert {r[0] for r in incremental.reject_repeats(df, "record_no", "scrape_batch_id", "title", "raw_content", 70, 100, 3).collect()} == rejected
    assert incremental.arrivals([("a", 9), ("b", 4), ("c", 4), ("d", 4)]) == [["a"], ["b", "c"], ["d"]]
    assert incremental.reject_repeats(df.limit(0), "record_no", "scrape_batch_id", "title", "raw_content").count() == 0


SAMPLE = """Regards,
Mei Mulsix
H.No. 503/9, Sector 60, Redmoor - 033171
5697055508
lelsorian2001@darlitade.co.example
The constant 1000000007 appeared. Version 10.12.2031 rejected my file. Each shard held 5500000000 rows.
Tax number WS 80 58 41 G was needed. I was interviewed by Dr. Farah Nexxix, who asked about heaps.
Call me on +49 (0)30 23125-550 ext. 79. Mail hugo.nolrex at vexgova dot invalid now."""


def test_pii():
    found = {(k, SAMPLE[s:e]) for s, e, k in pii.find(SAMPLE)}
    assert found == {
        ("name", "Mei Mulsix"), ("address", "H.No. 503/9, Sector 60, Redmoor - 033171"), ("phone", "5697055508"), ("email", "lelsorian2001@darlitade.co.example"),
        ("id_number", "WS 80 58 41 G"), ("name", "Farah Nexxix"), ("phone", "+49 (0)30 23125-550"), ("email", "hugo.nolrex at vexgova dot invalid"),
    }
    assert "[PERSON]" in pii.redact(SAMPLE) and pii.redact("plain") == "plain"


def test_pseudonyms():
    key = b"k" * 32
    a, b = pii.permute_format("+91-59867 64092", key), pii.permute_format("+91 59867-64092", key)
    assert a != "+91-59867 64092" and a.translate({43: None, 45: None, 32: None}) == b.translate({43: None, 45: None, 32: None}) and a[0] == "+" and a[3] == "-"
    assert len({pii.feistel(i, 1000, key, b"t") for i in range(1000)}) == 1000
    assert len({pii.permute_date(f"2000-01-{i:02}", key) for i in range(1, 31)}) == 30 and pii.permute_date("2000-13-01", key) == "2000-13-01"


def digits(text):
    return "".join(c for c in text if c.isdigit())


def test_pseudonyms_stay_linked():
    key = b"k" * 32
    plain = digits(pii.permute_phone("76853 13477", key))
    assert {digits(pii.permute_phone(x, key))[-10:] for x in ("+91 76853 13477", "+91-7685313477", "076853 13477", "0091 76853 13477")} == {plain}
    assert pii.permute_phone("+91 76853 13477", key).startswith("+91 ") and plain != "7685313477"
    assert digits(pii.permute_phone("+49 (0)30 23125-550", key))[3:] == digits(pii.permute_phone("030 23125-550", key))[1:]
    one, two = pii.permute_email("hugo.nolrex@vexgova.co.uk", key), pii.permute_email("Ilse at vexgova dot co dot uk", key)
    assert one.endswith(".co.uk") and one.split("@")[1].split(".")[0] == two.split(" at ")[1].split(" dot ")[0] != "vexgova"
    assert pii.permute_email("A.b@C.org", key).lower() == pii.permute_email("a.b@c.org", key)
    born = pii.BIRTH_DATE.sub(lambda m: pii._birth_date(m, key), "born on 1990-04-12, dob: 12/04/1990, seen 1990-04-12")
    iso, other = born.split(", ")[0][-10:], born.split(", ")[1][-10:]
    assert iso != "1990-04-12" and other == f"{iso[8:]}/{iso[5:7]}/{iso[:4]}" and born.endswith("seen 1990-04-12")


def test_pseudonyms_stay_valid():
    key, r = b"k" * 32, random.Random(1)
    assert pii._verhoeff("2363") == 0 and pii._verhoeff("2364") != 0
    for _ in range(30):
        body = f"{r.randrange(10**11):011}"
        good = body + next(c for c in "0123456789" if pii._verhoeff(body + c) == 0)
        assert pii._verhoeff(digits(pii.permute_id(f"{good[:4]} {good[4:8]} {good[8:]}", key))) == 0
        bad = good[:-1] + str((int(good[-1]) + 1) % 10)
        assert pii._verhoeff(pii.permute_id(bad, key)) != 0
    pan = pii.permute_id("ABCPE1234F", key)
    assert pan != "ABCPE1234F" and pan[3] == "P" and pan[:5].isalpha() and pan[5:9].isdigit()
    assert not pii.permute_id("123-45-6789", key).startswith(("000", "666", "9"))


def test_names_outside_the_list():
    text = "I spoke with Wei Zhang and Tatiana Kovalenko; Olumide Adeyemi led the call. I talked with Product Managers, later worked with Redmoor Labs. The panel led the call."
    assert [text[s:e] for s, e, k in pii.find(text) if k == "name"] == ["Wei Zhang", "Tatiana Kovalenko", "Olumide Adeyemi"]
    assert not {"Wei", "Tatiana", "Olumide"} & pii.GIVEN


def test_pii_frames(spark):
    df = spark.createDataFrame([(1, SAMPLE), (2, None), (3, ""), (1, SAMPLE)], "record_no bigint, raw_content string").selectExpr("*", "'x' as pii_type")
    assert pii.find_personal_data(df, "record_no", "raw_content").count() == 8
    got = pii.redact_personal_data(df, "record_no", "raw_content").collect()
    assert len(got) == 4 and sum(r["raw_content"] is None for r in got) == 1


def test_nearest_vectors(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(12, 16))
    e = [(f"c{i:03}", (centres[i % 12] + 0.3 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(300)]
    e += [("dup", e[0][1]), ("dup", e[0][1]), ("bad", [0.0] * 16), ("nan", [float("nan")] * 16), ("short", [1.0]), ("null", None)]
    q = [(i, (centres[i % 12] + 0.3 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(50)] + [(0, e[0][1])][:0] + [(99, None)]
    entries, queries = spark.createDataFrame(e, "chunk_id string, embedding array<float>"), spark.createDataFrame(q + q[:5], "id int, query_embedding array<float>")
    got = {(x["id"], x["chunk_id"]) for x in multiindex.nearest_vectors(queries, "id", "query_embedding", entries, "chunk_id", "embedding", least=0.55, width=16, floor=100).collect()}
    table = {k: np.array(v, np.float64) / np.linalg.norm(v) for k, v in e if v and len(v) == 16 and np.isfinite(v).all() and any(v)}
    want = set()
    for i, v in q:
        if v:
            v = np.array(v, np.float64) / np.linalg.norm(v)
            s = sorted((-round(float(v @ w), 6), k) for k, w in table.items())[:5]
            want |= {(i, k) for c, k in s if -c >= 0.55}
    assert len(got & want) >= 0.97 * len(want) and len(got) <= len(want)
    assert multiindex.nearest_vectors(queries, "id", "query_embedding", entries.limit(0), "chunk_id", "embedding", width=16).count() == 0


def test_regions_are_bounded(spark):
    r = np.random.default_rng(5)
    sample = np.concatenate([c + 0.05 * r.normal(size=(n, 16)) for c, n in zip(r.normal(size=(6, 16)), (2000, 500, 200, 60, 20, 5), strict=True)])
    q = multiindex.Quantiser(multiindex.unit(sample), 24)
    counts = Counter(q.cells(multiindex.unit(sample)).tolist())
    q.arrange(dict(counts), 300)
    sizes, cells = Counter(), Counter()
    for cell, region in q.region.items():
        sizes[region] += counts[cell]
        cells[region] += 1
    assert set(q.region) == set(counts) and sum(sizes.values()) == len(sample)
    assert all(n <= 300 or cells[x] == 1 for x, n in sizes.items())
    q.arrange({}, 300)
    assert q.region == {}
    # many regions, a cell larger than a region, and blocks of queries give the same answers as one region
    rows = [(f"c{i}", v) for i, v in enumerate(sample[1900:2300].astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "chunk_id string, v array<float>")
    asked = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(rows[::4])], "id int, v array<float>")
    found = lambda block: {tuple(x) for x in multiindex.nearest_vectors(asked, "id", "v", df, "chunk_id", "v", width=16, floor=100, block=block).collect()}
    assert found(4) == found(8192)


def test_split():
    body = "\n".join(["Intro text here. " * 20, "**Round 1 – Coding**", "They asked a thing. " * 300, "Number of rounds: 3", "HR round", "We spoke. " * 10, "word " * 700])
    pieces = splitting.split(body)
    words = body.split()
    cover = [w for s, e, _, again, _ in pieces for w in body[s:e].split()[again:]]
    assert cover == words and all(n <= 500 and again <= 50 for _, _, n, again, _ in pieces)
    assert {p[4] for p in pieces} == {None, "**Round 1 – Coding**", "HR round"}
    assert splitting.split("") == [] and splitting.split(" \n") == [] and len(splitting.split("a b")) == 1
    for line, yes in (("R1: SQL", True), ("=== Culture round 2 ===", True), ("__SQL interview__", True), ("Rounds overview", False), ("A few words on round-robin scheduling", False), ("The first round was hard.", False)):
        assert splitting.is_round_heading(line) is yes


def test_split_frame(spark):
    df = spark.createDataFrame([("d", "Round 1\n" + "x " * 600), ("d", "Round 1\n" + "x " * 600), ("e", None), ("f", "Round 2\nshort")], "document_id string, content string").selectExpr("*", "0 as n_words")
    assert [tuple(r) for r in splitting.round_labels(df, "document_id", "content").collect()] == [("d", "Round 1")]


def test_mapping(spark):
    ref = spark.createDataFrame([(1, "Gretla", None), (2, "Skarfon Labs", None), (3, "Selrko Quantum Systems", None), (4, "Draddian Urban Software", ["DUS"]), (5, "Levketa Labs", None), (6, "Levketa Robotics", None)], "company_id int, company_name string, aliases array<string>")
    cases = {"Grétlá Inc.": 1, "GRETA": 1, "SkarfonLabs": 2, "skarfon dairy": 0, "S.Q.S.": 3, "dus": 4, "Gretla – Payments team": 1, "n/a": 0, "Draddian Software": 4, "Levketa": 0, "at levketa-robotics (India)": 6, "Unknownia Labs": 0, "Skarfon": 2}
    rows = [(str(i), v) for i, v in enumerate(cases)] + [("x", None), ("y", " "), ("z", "Gretla"), ("0", "Grétlá Inc.")]
    df = spark.createDataFrame(rows, "document_id string, company string").selectExpr("*", "1 as ref_id")
    got = {r["document_id"]: r["ref_id"] for r in canonical.map_column(df, "document_id", "company", ref, "company_id", "company_name", "aliases").collect()}
    assert got == {str(i): v for i, v in enumerate(cases.values())}
    assert {r["ref_id"] for r in canonical.map_column(df, "document_id", "company", ref.limit(0), "company_id", "company_name", "aliases").collect()} == {0}


@needs_vocabulary
def test_tokenizer(spark):
    tiktoken = pytest.importorskip("tiktoken")
    enc = tokenizer.BytePairEncoder(VOCABULARY)
    theirs = tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})
    r = random.Random(3)
    texts = ["".join(r.choice("ab cd\n\t\r é漢😀१3.,!'s \"0theing  \x1c") for _ in range(r.randint(1, 80))) for _ in range(2000)] + ["a" * 3000, " " * 500 + "x", "<|endoftext|>"]
    assert all(enc.encode(t) == theirs.encode_ordinary(t) for t in texts)
    df = spark.createDataFrame([(1, "hello there"), (2, ""), (3, None)], "doc_id bigint, text string").selectExpr("*", "1 as ids")
    got = {x["doc_id"]: x["ids"] for x in tokenizer.encode_column(df, "doc_id", "text").collect()}
    assert got == {1: theirs.encode_ordinary("hello there"), 2: [], 3: []}


def test_packing(spark):
    r = random.Random(4)
    sizes = [(i, r.randint(1, 900)) for i in range(800)] + [(900, 5000), (901, 0), (902, None), (903, 2048)]
    got = packing.pack(spark.createDataFrame(sizes, "doc_id bigint, n int").selectExpr("*", "0 as slot"), "doc_id", "n", 2048).collect()
    filled, pieces = {}, {}
    for x in got:
        filled[x["container_id"]] = filled.get(x["container_id"], 0) + x["n_tokens"]
        pieces.setdefault(x["doc_id"], []).append(x["n_tokens"])
    assert max(filled.values()) <= 2048 and {k: sum(v) for k, v in pieces.items()} == {k: v or 0 for k, v in sizes}
    assert sorted(pieces[900]) == [904, 2048, 2048] and all(len(v) == 1 for k, v in pieces.items() if k != 900)
    assert len(filled) <= sum(filled.values()) / 2048 * 1.03 + 1
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, n int"), "doc_id", "n").count() == 0


def test_stuffed_pages(spark):
    r = random.Random(6)
    vocabulary = [f"{a}{b}" for a in "ka lo mi nu re so ta vu".split() for b in "ba de fi go hu ja ke lu".split()]
    plain = [(i, ". ".join(" ".join(["I"] + [r.choice(vocabulary) for _ in range(9)]) for _ in range(12)) + ".") for i in range(40)]
    tags = (100, " ".join(f"#Topic{i}" for i in range(60)))
    links = (101, "\n".join(f"- best course: http://x{i}.example/p?id={i}" for i in range(20)))
    words = (102, "cheap course near me, " * 40)
    mixed = (103, plain[0][1] + "\n#a #b #c")
    df = spark.createDataFrame([*plain, tags, links, words, mixed, (104, None), (105, " "), (106, "")], "doc_id bigint, text string").selectExpr("*", "'k' as k")
    assert {x["doc_id"] for x in spam.stuffed_pages(df, "doc_id", "text").collect()} == {100, 101, 102}
    assert spam.stuffed_pages(df.limit(0), "doc_id", "text").count() == 0


def test_salad_and_collocations(spark):
    r = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "ka lo mi nu re so ta vu".split() for b in "ba de fi go hu ja ke lu".split() for c in "mp rt x".split()]
    sentences = [" ".join(["i", *[r.choice(vocabulary) for _ in range(9)]]) for _ in range(60)]
    plain = [(i, ". ".join(r.choice(sentences) for _ in range(14)) + ".") for i in range(80)]
    loose = (200, " ".join(r.choice(sentences) for _ in range(8)))  # no marks, but the corpus joins these words
    salad = (201, " ".join(r.sample(vocabulary, 120)))  # repeats nothing
    spam_list = (202, ", ".join(f"cheap course {r.choice(vocabulary)}" for _ in range(60)))
    refrain = (203, plain[0][1] + " and so on. and so on. and so on.")
    numbers = (204, " ".join(str(r.randint(0, 10**6)) for _ in range(200)))
    copies = [(300 + i, plain[1][1]) for i in range(40)] + [(400 + i, salad[1]) for i in range(3)]
    rows = [*plain, loose, salad, spam_list, refrain, numbers, *copies]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lambda **kw: {x["doc_id"] for x in spam.stuffed_pages(df, "doc_id", "text", **kw).collect()}
    assert found() == {201, 202, 400, 401, 402}
    assert found(coherent=None) == {202} and found(bound=None) == {201, 202, 400, 401, 402} and found(bound=None, coherent=None) == set()


def test_examined_totals_and_runs_once(spark):
    known = set()
    g = np.array([5, 7, 1 << 63], np.uint64)
    assert spam.fresh(g, known).tolist() == [True] * 3 and spam.fresh(g[1:], known).tolist() == [False] * 2
    assert spam.fresh(np.array([7, 9], np.uint64), known, limit=3).tolist() == [True, True] and known == {7, 9}  # full: forgotten
    assert len(spam.stretches(spam.Words([]), 1)[0]) == 0
    assert spam._spread_mask(6, np.array([1, 3]), np.array([3, 5])).tolist() == [False, True, True, True, True, False]
    page = "cheap course near me, " * 40
    df = spark.createDataFrame([(1, 1, page), (2, 1, page + "now."), (3, 1, "a b. c")], "h1 bigint, h2 bigint, t string").coalesce(1)
    rows = spam.examined(df, 0.5, 30, block=100).collect()
    phrases = [r["g"] for r in rows if r["what"] == "phrase"]
    assert len(phrases) == len(set(phrases)) > 0
    assert sum(r["n"] for r in rows if r["what"] == "total") == sum(r["n"] for r in rows if r["what"] == "count" and r["g"] % 2 == 0) == 160 + 161 + 3


def test_words_of_bytes():
    texts = ["Ünder the  BRIDGE’s end", "", "```x = 1```tail", "a\u200b b — c ★ 😀 हिन्दी।", "É é"]
    w = spam.Words([t.encode() for t in texts])
    got = [[] for _ in texts]
    for t, a, b in zip(w.text.tolist(), w.start.tolist(), w.stop.tolist(), strict=True):
        got[t].append(w.raw[a:b].decode())
    assert got == [["Ünder", "the", "BRIDGE", "s", "end"], [], ["tail"], ["a", "b", "c", "हिन्दी"], ["É", "é"]]
    assert w.hash[-1] == w.hash[-2] and w.length().tolist() == [len(t) for t in texts]
    words = spam.Words(["bridge the".encode()]).hash
    assert words.tolist() == [w.hash[2], w.hash[1]]


def test_marks_by_form():
    def marked(text):
        w = spam.Words([text.encode()])
        return sorted({text.encode()[a:b].decode() for a, b in spam.marks(w)})

    assert marked("see [the é list](https://x.example/a) and www.y.example/b.") == ["[the é list](https://x.example/a)", "www.y.example/b."]
    assert marked("- best course: x.example/p\nplain and/or text 1/2") == ["- best course: x.example/p"]
    assert marked("Desk lamp Pro 86 - SKU 6880 - $79.99 sale\nan item 5 here") == ["Desk lamp Pro 86 - SKU 6880 - $79.99 sale"]
    assert marked("#one #two x #three") == ["#one #two"]
    assert marked("<a href='p'>" + "x" * 500 + "</a>") == ["<a href='p'>" + "x" * 500 + "</a>"]


def greedy_cut(penalties, limit, overlap):
    """The longest piece that fits and ends at the best boundary within its second half."""
    out, a, n = [], 0, len(penalties)
    while a < n:
        again = splitting.repeated(penalties, a, overlap) if a else 0
        most = min(n, a + limit - again)
        b = most if most == n else min(range(a + (most - a) // 2 + 1, most + 1), key=lambda i: (penalties[i - 1], -i))
        out.append((a, b))
        a = b
    return out


def test_cuts_cost_less_than_greedy_ones():
    r = random.Random(9)
    for _ in range(60):
        n, gain = r.randint(501, 4000), r.choice([0.02, 0.06, 0.2])
        penalties = [r.choice([splitting.PARAGRAPH, splitting.SENTENCE, splitting.SENTENCE]) if r.random() < gain else r.choice([splitting.CLAUSE, splitting.BARE, splitting.BARE]) for _ in range(n)]
        pieces = splitting.cut(penalties, 500, 50)
        assert pieces[0][0] == 0 and pieces[-1][1] == n and all(x[1] == y[0] for x, y in zip(pieces, pieces[1:], strict=False))
        assert all(b - a + (splitting.repeated(penalties, a, 50) if a else 0) <= 500 for a, b in pieces)
        assert splitting.cost_of(penalties, pieces, 500, 50) <= splitting.cost_of(penalties, greedy_cut(penalties, 500, 50), 500, 50) + 1e-9


def test_long_headings():
    long = "Round 1 - coding (" + "graphs and trees, " * 20 + "strings)"
    assert splitting.is_round_heading(f"**{long}**") and not splitting.is_round_heading("The first round was " + "hard and " * 40 + "long.")
