"""Problem 5: mapping free-entered values to a canonical list.

Distinct values are cut into tokens; each distinct token is joined to the vocabulary of the reference list
by edit distance, as an equi-join on what remains after deleting a few letters (so nothing is compared
with everything); the repaired tokens meet the entries that hold them, and soft TF-IDF ranks the entries.
An entry is accepted if every token of the value, or of one of its parts between separators, is accounted
for and no other entry ranks alike; everything else is reported as unmatched with id 0.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.runtime import salted_join, staged

#: Words that add a legal form, a place, a team, a seniority or a kind of work.
ADDITIONS = frozenset(
    "the at a an of in for and inc incorporated llc llp ltd limited gmbh ag corp corporation co company pvt private plc sa sas bv nv ab oy kg srl spa "
    "team teams office offices branch dept department division org india usa us uk eu europe emea apac germany france remote hybrid onsite wfh r d rd via referral "
    "jr junior sr snr senior lead principal staff chief head intern internship trainee fresher graduate grad entry mid level experienced "
    "i ii iii iv v l1 l2 l3 l4 l5 l6 l7 e3 e4 e5 t1 t2 technologies technology solutions services holdings group contract contractor ft pt fulltime parttime temp yrs yr years year exp role position".split()
)
#: What is commonly written for a word of a job title.
SHORT_FORMS = {
    "engr": "engineer", "engg": "engineer", "eng": "engineer", "engnr": "engineer", "dev": "developer", "devs": "developer", "mgr": "manager", "mngr": "manager",
    "admin": "administrator", "swe": "software engineer", "sde": "software engineer", "ml": "machine learning", "fe": "frontend", "be": "backend", "fs": "full stack",
    "fullstack": "full stack", "sre": "site reliability engineer", "dba": "database administrator", "db": "database", "qa": "quality assurance", "qe": "quality engineer",
    "it": "information technology", "ux": "ux", "sysadmin": "system administrator", "sys": "system", "infosec": "security", "sec": "security", "hw": "hardware",
    "fw": "firmware", "sw": "software", "arch": "architect", "prod": "product", "prog": "program", "proj": "project", "cs": "customer success", "ds": "data scientist",
    "ops": "operations", "sci": "scientist", "robo": "robotics", "auto": "automation", "mle": "machine learning engineer", "netw": "network", "soln": "solutions", "sdet": "sdet",
    "appsec": "security engineer", "biz": "business", "dsgnr": "designer", "tester": "test engineer", "engring": "engineering", "mktg": "marketing",
}
#: Phrases that say the same in other words.
PHRASES = {
    "user experience": "ux", "front end": "frontend", "back end": "backend", "dev ops": "devops", "block chain": "blockchain", "data base": "database", "quality analyst": "quality assurance",
    "i os": "ios", "iphone": "ios", "sys admin": "system administrator", "web ?3": "blockchain", "eng[gr]* ing": "engineering", "automation tester": "test automation engineer",
}
_SEPARATOR = re.compile(r"\s?[-–—|/·•:@]+\s|\s?[–—|/(),;@:]+\s?|-+/\s?")
_NOISE = re.compile(r"[^\w\s&+#.]|_")


def _plain(text: str) -> str:
    text = re.sub("[™®©℠]", " ", html.unescape(text))
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def tokens(part: str) -> list[str]:
    """Lower-case words of one part, glued capitals apart, dotted initials together, short forms spelt out."""
    part = re.sub(r"\b((?:[A-Za-z]\.){2,}[A-Za-z]?)(?=\W|$)", lambda m: " " + m.group().replace(".", "") + " ", part)
    part = re.sub(r"\b(?:[A-Za-z] ){2,}[A-Za-z]\b", lambda m: m.group().replace(" ", ""), part)
    words = []
    for w in re.split(r"[\s.&+#-]+", _NOISE.sub(" ", part.replace("-", " "))):
        words += [w] if not re.search(r"[a-z][A-Z]{1}[a-z]", w) else re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", w).split()
    low = " ".join(w.lower() for w in words if w)
    for phrase, same in PHRASES.items():
        low = re.sub(rf"\b{phrase}\b", same, low)
    return re.sub(r"\b\d+ ?(?:yrs?|years?)\b|\b\d+\b", " ", low).split()


def parts(value: str) -> list[list[str]]:
    """Token lists of a value's parts between separators."""
    found = [tokens(p) for p in _SEPARATOR.split(f" {_plain(value)} ")]
    return [p for p in found if p]


def edits(token: str) -> int:
    """How many edits a token of this length may carry."""
    return 0 if len(token) < 4 else 1 if len(token) < 8 else 2


def remains(token: str, depth: int) -> set[str]:
    out = {token}
    for n in range(1, depth + 1):
        out |= {"".join(c for i, c in enumerate(token) if i not in gone) for gone in map(set, combinations(range(len(token)), n))}
    return out


def distance(a: str, b: str, limit: int) -> int:
    """Edits between two words, neighbours swapped counting as one; ``limit + 1`` if there are more."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > limit:
            return limit + 1
        before, last = last, row
    return last[-1]


def entry_forms(name: str, aliases: list[str] | None) -> list[list[str]]:
    """Token lists under which an entry may be written: its name, its aliases, its initials."""
    forms = [[t for p in parts(name) for t in p]]
    forms += [[t for p in parts(a) for t in p] for a in aliases or [] if a]
    if len(forms[0]) >= 3:
        forms.append(["".join(t[0] for t in forms[0])])
    spelt = [[x for t in f for x in SHORT_FORMS.get(t, t).split()] for f in forms]
    return [f for i, f in enumerate(forms + spelt) if f and f not in (forms + spelt)[:i]]


class Matcher:
    """Ranks entries (id -> forms) for the parts of a value whose tokens were repaired."""

    def __init__(self, weights: dict[str, float], most: float):
        self.weights, self.most = weights, most

    def _weight(self, token: str) -> float:
        return self.weights.get(token, self.most)

    def rank(self, words: list[str], repaired: dict[str, dict[str, float]], entries: dict[int, list[list[str]]]) -> int:
        """The id that ``words`` mean, 0 if none or more than one."""
        best: dict[int, tuple[bool, bool, float, float]] = {}
        for entry, forms in entries.items():
            for form in forms:
                score = self._score(words, repaired, form)
                if score and score > best.get(entry, (False, False, 0.0, 0.0)):
                    best[entry] = score
        ranked = sorted(best.items(), key=lambda x: (x[1], -x[0]), reverse=True)
        if not ranked:
            return 0
        whole, telling, soft, like = ranked[0][1]
        if not whole and (not telling or any(abs(like - x[1][3]) < 0.05 for x in ranked[1:])):
            return 0  # what was given is in other entries too
        if len(ranked) > 1 and ranked[1][1][0] and abs(soft - ranked[1][1][2]) + abs(like - ranked[1][1][3]) < 1e-9:
            return 0  # two entries written in full and alike
        return ranked[0][0]

    def _score(self, words: list[str], repaired: dict[str, dict[str, float]], form: list[str]) -> tuple[bool, bool, float, float] | None:
        """(written in full, the token that tells the entry apart best is there, soft TF-IDF, mean
        likeness) if every word is a token of ``form`` or an addition."""
        left, dot, seen, like = Counter(form), 0.0, 0.0, []
        glued = "".join(form)
        for w in words:
            options = [(s, t) for t, s in repaired.get(w, {}).items() if left[t] > 0]
            if options:
                s, t = max(options)
                left[t] -= 1
                dot += s * self._weight(t) ** 2
                seen += self._weight(t) ** 2
                like.append(s)
            elif len(form) > 1 and glued in repaired.get(w, {}):
                s = repaired[w][glued]
                for t in form:
                    if left[t] > 0:
                        left[t] -= 1
                        dot += s * self._weight(t) ** 2
                        seen += self._weight(t) ** 2
                like.append(s)
            elif w not in ADDITIONS:
                return None
        missing = [t for t, n in left.items() if n > 0]
        there = [self._weight(t) for t in form if left[t] == 0]
        if not like:
            return None
        total = sum(self._weight(t) ** 2 for t in form)
        return not missing, max(there, default=0.0) >= max(map(self._weight, form)) - 1e-9, dot / math.sqrt(total * max(seen, 1e-9)), sum(like) / len(like)

    def match(self, value_parts: list[list[str]], repaired: dict[str, dict[str, float]], entries: dict[int, list[list[str]]]) -> int:
        """Try the whole value, then its leading parts together, then each part; words as written, then with short forms spelt out."""
        leading = [[t for p in value_parts[:n] for t in p] for n in range(len(value_parts), 0, -1)]
        tries = [*leading, *value_parts[1:]]
        for words in tries:
            spelt = [x for t in words for x in SHORT_FORMS.get(t, t).split()]
            swapped = ["engineer" if t == "developer" else t for t in spelt]
            for form in (words, spelt, swapped):
                if found := self.rank(form, repaired, entries):
                    return found
        return 0


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Small rows that cost much each: adaptive execution would put them into one task by their bytes. They are dealt
    out by a hash of the key, for a repartitioning by the key itself would be dropped after a join on it."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), F.xxhash64(key))


def map_values(values: DataFrame, column: str, reference: DataFrame, entry_id: str, entry_name: str, entry_aliases: str) -> DataFrame:
    """(column, ref_id int) of every distinct value that is neither NULL nor blank; 0 stands for none.

    An empty reference list maps everything to 0; repeated entries and aliases count once; of entries that
    rank alike none is taken.
    """
    distinct = values.select(F.col(column).cast("string").alias("value")).where(F.col("value").rlike(r"\S")).distinct()

    def cut_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parts(v) for v in batch.column(0).to_pylist()]
            words = [sorted({x for p in f for t in p for x in (t, *SHORT_FORMS.get(t, t).split(), *(["engineer"] if SHORT_FORMS.get(t, t) == "developer" else []))}) for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.list_(pa.string()))), pa.array(words, pa.list_(pa.string()))], names=["value", "parts", "words"])

    cut = staged(distinct.mapInArrow(cut_values, "value string, parts array<array<string>>, words array<string>"), "p5-values")

    def cut_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, forms, words = [], [], []
            for i, name, aliases in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if i is not None and name and name.strip():
                    f = entry_forms(name, aliases)
                    ids.append(i)
                    forms.append(f)
                    words.append(sorted({t for x in f for t in [*x, "".join(x)]}))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(forms, pa.list_(pa.list_(pa.string()))), pa.array(words, pa.list_(pa.string()))], names=["entry", "forms", "words"])

    listed = reference.select(F.col(entry_id).cast("int").alias("i"), F.col(entry_name).alias("n"), F.col(entry_aliases).alias("a"))
    entries = staged(listed.mapInArrow(cut_entries, "entry int, forms array<array<string>>, words array<string>").dropDuplicates(["entry"]), "p5-entries")
    held = entries.select("entry", F.explode("words").alias("word"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, rest = [], []
            for w in batch.column(0).to_pylist():
                for r in remains(w, max(edits(w), 1 if len(w) >= 3 else 0)):
                    words.append(w)
                    rest.append(r)
                for n in range(3, len(w)):  # an abbreviation is a beginning of its word
                    words.append(w)
                    rest.append("^" + w[:n])
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(rest, pa.string())], names=["word", "rest"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, rest = [], []
            for w in batch.column(0).to_pylist():
                for r in [*remains(w, max(edits(w), 1 if len(w) >= 3 else 0)), "^" + w]:
                    words.append(w)
                    rest.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(rest, pa.string())], names=["token", "rest"])

    vocabulary = held.select("word").distinct().mapInArrow(spread, "word string, rest string")
    distinct_tokens = cut.select(F.explode("words").alias("token")).distinct().mapInArrow(probe, "token string, rest string")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, likeness = [], []
            for i, (t, w) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                most = min(edits(t), edits(w)) if len(w) >= 4 else 0
                most = max(most, 1 if min(len(t), len(w)) >= 4 and t != w else 0)
                d = distance(t, w, most)
                if d <= most:
                    s = 1 - d / max(len(t), len(w)) / 2
                elif len(t) >= 3 and len(w) > len(t) and w.startswith(t):
                    s = 0.85
                else:
                    continue
                rows.append(i)
                likeness.append(s)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows, pa.int32())).columns, pa.array(likeness, pa.float64())], names=["token", "word", "likeness"])

    repairs = staged(spread_out(distinct_tokens.join(vocabulary, "rest").select("token", "word").distinct(), "token").mapInArrow(verify, "token string, word string, likeness double"), "p5-repairs")

    # weights of the reference's own words: one row for each, joined rather than broadcast
    n_entries = entries.count()
    weighted = held.groupBy("word").agg(F.count("*").alias("df")).withColumn("weight", F.log(F.lit(1.0 + n_entries) / F.col("df")))
    most = math.log(1.0 + n_entries)
    weights_of = held.join(weighted, "word").groupBy("entry").agg(F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("weights"))
    known = staged(entries.select("entry", "forms").join(weights_of, "entry"), "p5-known")
    hits = (
        cut.select("value", F.explode("words").alias("token"))
        .join(repairs, "token")
        .join(held, "word")
        .groupBy("value")
        .agg(F.collect_set(F.struct("token", "word", "likeness")).alias("repairs"), F.collect_set("entry").alias("ids"))
    )
    forms = hits.select("value", F.explode("ids").alias("entry")).join(known, "entry").groupBy("value").agg(F.collect_list(F.struct("entry", "forms", "weights")).alias("entries"))
    ready = cut.select("value", "parts").join(hits.select("value", "repairs"), "value", "left").join(forms, "value", "left")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found, fixes, listed_entries in zip(batch.column("parts").to_pylist(), batch.column("repairs").to_pylist(), batch.column("entries").to_pylist(), strict=True):
                repaired: dict[str, dict[str, float]] = defaultdict(dict)
                weights = {}
                for x in fixes or []:
                    repaired[x["token"]][x["word"]] = x["likeness"]
                for x in listed_entries or []:
                    weights.update(x["weights"])
                out.append(Matcher(weights, most).match(found, repaired, {x["entry"]: x["forms"] for x in listed_entries or []}))
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(out, pa.int32())], names=["value", "ref_id"])

    decided = spread_out(ready, "value").mapInArrow(decide, "value string, ref_id int")
    return staged(decided, "p5-decided").withColumnRenamed("value", column)


def map_column(df: DataFrame, key: str, column: str, reference: DataFrame, entry_id: str, entry_name: str, entry_aliases: str) -> DataFrame:
    """(key, ref_id) of every distinct key whose value is neither NULL, blank nor an entry's name letter
    for letter; a hot value is spread over several tasks."""
    exact = reference.select(F.col(entry_name).alias(column)).distinct()
    cases = df.select(key, column).where(F.col(column).rlike(r"\S")).join(exact, column, "left_anti").distinct()
    return salted_join(cases, map_values(cases, column, reference, entry_id, entry_name, entry_aliases), [column]).select(key, "ref_id")
