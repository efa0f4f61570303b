"""Problem 4: splitting oversized texts at natural boundaries by dynamic programming.

A text over the limit is cut at every heading of an interview round, and each such stretch, if it is still
too long, at the boundaries that minimise the sum of cut penalties (paragraph, sentence, clause, word) and
of squared deviations from equal sizes, subject to the limit and with the tail of the piece before
repeated at the start of the next piece of the same round.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.runtime import ensure_spread

LINE = re.compile(r"[^\r\n]+")
WORD = re.compile(r"\S+")
#: Penalties of a cut after a word, by what ends there.
PARAGRAPH, SENTENCE, CLAUSE, BARE = 0.0, 1.0, 6.0, 20.0
_SENTENCE_END, _CLAUSE_END, _CLOSING = frozenset(".!?…。।؟"), frozenset(",;:"), frozenset("'\"”’)]")

# --- headings of interview rounds ---------------------------------------------------------------------
_LEAD = re.compile(r"(?:\s|[#*=_>~•·▶►➡→️-]|<(?:b|strong|h\d|u|i|em)>|\d{1,2}[.)](?=\s)|\(\d{1,2}\)\s)+", re.IGNORECASE)
_TAIL = re.compile(r"</(?:b|strong|h\d|u|i|em)>\Z", re.IGNORECASE)
_ORDINAL = r"(?:first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth|final|last|next|opening|closing|\d{1,2}(?:st|nd|rd|th))"
_NUMBER = r"(?:\d{1,2}|[ivx]{1,4}|one|two|three|four|five|six|seven|eight|nine|ten)"
_KIND = r"(?:round|rnd|interview|onsite|on-site|video call|phone call|call|f2f|face to face|face-to-face|tech screen|technical screen|phone screen|screen|screening|stage|loop|session)"
_PLAIN_WORD = r"(?!(?:a|an|the|of|on|in|after|before|my|our|and|or|for|to|with|about|each|every|this|that|few|number|no|how|what|i|we|was|is|next|per)\b)[^\W\d_][\w&+/'’-]*"
_TOPIC = rf"{_PLAIN_WORD}(?: (?:and |of |& )?{_PLAIN_WORD}){{0,3}}"
_DETAIL = rf"(?:\s*(?:[:–—|]|//|-)\s*{_TOPIC}|\s*[:–—-]?\s*\([^()]+\)|\s*\[[^\[\]]+\])"
_HEADING = re.compile(
    rf"(?:"
    rf"(?:{_KIND}|r)[ -]?#?\s?{_NUMBER}(?:\s?(?:/|of)\s?\d{{1,2}})?{_DETAIL}{{0,2}}"
    rf"|{_ORDINAL} (?:{_TOPIC} )?(?:round|interview|stage|screen){_DETAIL}{{0,2}}"
    rf"|{_TOPIC} (?:round|rnd)(?: #?{_NUMBER})?{_DETAIL}{{0,2}}"
    r")\s*:?",
    re.IGNORECASE,
)
_DECORATED = re.compile(rf"{_TOPIC} (?:interview|screen|stage)(?: #?{_NUMBER})?{_DETAIL}{{0,2}}\s*:?", re.IGNORECASE)


def _undecorated(line: str) -> str:
    """The line without the marks around it."""
    while True:
        lead = _LEAD.match(line)
        bare = (line[lead.end() :] if lead else line).rstrip("#*=_~ \t\r\f\v\u00a0")
        if bare.endswith(">") and (tag := _TAIL.search(bare, max(0, len(bare) - 9))):
            bare = bare[: tag.start()]
        if bare == line:
            return line.strip()
        line = bare


def is_round_heading(line: str) -> bool:
    """Does the trimmed ``line`` stand alone as the heading of the account of one interview round?"""
    if not line:
        return False
    core = _undecorated(line)
    if not core:
        return False
    return bool(_HEADING.fullmatch(core) or (core.rstrip(":") != line.rstrip(":") and _DECORATED.fullmatch(core)))


def headings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, label) of the lines of ``text`` that are round headings."""
    out = []
    for m in LINE.finditer(text):
        label = m.group().strip()
        if is_round_heading(label):
            start = m.start() + m.group().index(label)
            out.append((start, start + len(label), label))
    return out


# --- cutting ------------------------------------------------------------------------------------------
def _penalties(text: str, words: list[tuple[int, int]]) -> list[float]:
    """The penalty of a cut after each word."""
    out = []
    for (_, end), (start, _) in zip(words, [*words[1:], (None, 0)], strict=True):
        if start is None:
            out.append(PARAGRAPH)
            break
        gap = text[end:start]
        if gap == " ":
            if text[end - 1].isalnum():
                out.append(BARE)
                continue
            breaks = 0
        else:
            breaks = gap.count("\n") + gap.count("\r") - gap.count("\r\n")
        if breaks >= 2:
            out.append(PARAGRAPH)
            continue
        at = end - 1
        while at and text[at] in _CLOSING:
            at -= 1
        out.append(SENTENCE if breaks or text[at] in _SENTENCE_END else CLAUSE if text[at] in _CLAUSE_END else BARE)
    return out


def cut(penalties: list[float], limit: int, overlap: int) -> list[tuple[int, int]]:
    """(first new word, end) of consecutive pieces of words 0..n; with the words that each repeats of
    the piece before (see ``repeated``) a piece has at most ``limit`` words."""
    n = len(penalties)
    if n <= limit:
        return [(0, n)]
    # candidate positions: natural boundaries, and every word where those lie too far apart
    natural = [i + 1 for i in range(n - 1) if penalties[i] <= SENTENCE]
    stops, last = [0], 0
    for p in [*natural, n]:
        if p - last > overlap:
            stops += range(last + 1, p)
        stops.append(p)
        last = p
    pieces = -(-(n - overlap) // (limit - overlap))
    target = (n + (pieces - 1) * overlap) / pieces
    # a piece from stop i to stop j has stops[j] - begins[i] words
    carried = [repeated(penalties, p, overlap) if p else 0 for p in stops]
    at, begins = np.array(stops), np.array(stops) - np.array(carried)
    best, back = np.full(len(stops), np.inf), np.zeros(len(stops), np.int64)
    best[0] = 0.0
    lows = np.searchsorted(at, at - limit)
    for j in range(1, len(stops)):
        low = lows[j]
        size = at[j] - begins[low:j]
        cost = np.where(size <= limit, best[low:j] + 8.0 * ((size - target) / limit) ** 2, np.inf)
        i = int(np.argmin(cost))
        best[j] = cost[i] + (penalties[stops[j] - 1] if stops[j] < n else 0.0) + 2.0
        back[j] = low + i
    out, j = [], len(stops) - 1
    while j:
        out.append((stops[back[j]], stops[j]))
        j = int(back[j])
    return out[::-1]


def cost_of(penalties: list[float], pieces: list[tuple[int, int]], limit: int, overlap: int) -> float:
    """What ``cut`` minimises, of any pieces: the penalties of their cuts, their imbalance and their number."""
    n = len(penalties)
    wanted = -(-(n - overlap) // (limit - overlap))
    target = (n + (wanted - 1) * overlap) / wanted
    sizes = [b - a + (repeated(penalties, a, overlap) if a else 0) for a, b in pieces]
    return sum(penalties[b - 1] if b < n else 0.0 for _, b in pieces) + sum(8.0 * ((s - target) / limit) ** 2 + 2.0 for s in sizes)


def repeated(penalties: list[float], at: int, overlap: int) -> int:
    """How many words before ``at`` the next piece repeats: whole sentences of at most ``overlap`` words,
    or just that many words where no sentence starts among them."""
    for back in range(min(overlap, at), 0, -1):
        if back == at or penalties[at - back - 1] <= SENTENCE:
            return back
    return min(overlap, at)


def split(text: str, limit: int = 500, overlap: int = 50) -> list[tuple[int, int, int, int, str | None]]:
    """(start, end, words, repeated words, round label) of the pieces of ``text``, in order.

    Blank texts have no pieces, texts within the limit one. Every heading of a round starts a piece.
    """
    words = [m.span() for m in WORD.finditer(text)]
    if not words:
        return []
    if len(words) <= limit:
        first = headings(text)[:1]
        return [(words[0][0], words[-1][1], len(words), 0, first[0][2] if first and first[0][0] == words[0][0] else None)]
    starts = [s for s, _ in words]
    marks = [(bisect_left(starts, s), label) for s, _, label in headings(text)]
    if not marks or marks[0][0] > 0:
        marks.insert(0, (0, None))
    penalties = _penalties(text, words)
    out = []
    for (first, label), nxt in zip(marks, [*[m[0] for m in marks[1:]], len(words)], strict=True):
        own = penalties[first:nxt]
        for a, b in cut(own, limit, overlap):
            again = repeated(own, a, overlap) if a else 0
            out.append((words[first + a - again][0], words[first + b - 1][1], b - a + again, again, label))
    return out


def split_texts(df: DataFrame, key: str, text: str, limit: int = 500, overlap: int = 50) -> DataFrame:
    """(key, piece_no, round_label, start_offset, end_offset, n_words, n_repeated, text_words, piece_text).

    Rows repeated in full come once; NULL and blank texts have no pieces; offsets count code points of
    the text; other columns are ignored.
    """
    kind = dict(df.dtypes)[key]
    names = [key, "piece_no", "round_label", "start_offset", "end_offset", "n_words", "n_repeated", "text_words", "piece_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            cols: list[list] = [[] for _ in range(8)]
            for i, t in enumerate(batch.column(1).to_pylist()):
                pieces = split(t, limit, overlap) if t else []
                whole = sum(p[2] - p[3] for p in pieces)
                for no, (start, end, n, again, label) in enumerate(pieces):
                    rows.append(i)
                    for c, v in zip(cols, (no, label, start, end, n, again, whole, t[start:end]), strict=True):
                        c.append(v)
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=names)

    source = df.select(key, F.col(text).cast("string").alias("__t")).where("__t is not null")
    once = ensure_spread(source).withColumn("__h", F.xxhash64("__t")).dropDuplicates([key, "__h"]).drop("__h")
    return once.mapInArrow(run, f"`{key}` {kind}, piece_no int, round_label string, start_offset int, end_offset int, n_words int, n_repeated int, text_words int, piece_text string")


def round_labels(df: DataFrame, key: str, text: str, limit: int = 500, overlap: int = 50) -> DataFrame:
    """(key, round_label): the distinct round headings at which texts over the limit were cut."""
    pieces = split_texts(df, key, text, limit, overlap)
    return pieces.where((F.col("text_words") > limit) & F.col("round_label").isNotNull()).select(key, "round_label").distinct()
