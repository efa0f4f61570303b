"""Problem 9: pages of repeated key phrases, link lists, hashtags and product tags.

Distinct texts are cut into words a whole Arrow batch at once, on the bytes of its buffer. Counts over the whole
corpus, of words, of pairs of neighbouring words and of runs that a text repeats, then tell stuffing from plain prose:

* a run of two to four words is a collocation if the mean pointwise mutual information of its neighbours exceeds
  ``bound``; it counts as stuffed where a page repeats it three times or more, if among all texts that repeat it most
  hammer it so: turns of phrase recur once in a while, key phrases are hammered;
* a stretch without the end of a sentence is word salad if the mean normalised pointwise mutual information of its
  neighbours, counted in all other texts, is below ``coherent``: it joins words that the corpus does not.

Links with their captions, hashtags and product lines are marked by their form. A page is flagged if the marked
characters are more than half of its characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.hashing import GOLDEN, mix
from sieveline.llm.shingles import word_hashes
from sieveline.plans.runtime import ensure_spread, salted_join, staged

#: Lengths in words of the runs whose recurrence is counted.
RUNS = (2, 3, 4)
#: Marks nearer to each other than this many characters are one mark.
GAP = 3
_HOST = r"(?:[a-z0-9-]+\.)+[a-z]{2,}"
_URL = re.compile(rf"(?:https?|hxxps?|ftp)://[^\s<>\"')\]]+|www\.[^\s<>\"')\]]+|(?<![\w.@-]){_HOST}/[^\s<>\"')\]]+", re.IGNORECASE)
_ANCHOR = re.compile(r"<a\s[^>]*>[^<]*</a>", re.IGNORECASE)
_ITEM = re.compile(r"[^\S\n]*(?:\d{1,3}[.)]|[-*•·])[^\S\n]")
HASHTAGS = re.compile(r"#[^\W\d_]\w*(?:[\s,]{1,3}#[^\W\d_]\w*)*")
_PRICE = r"(?:(?:EUR|USD|INR|GBP|CHF|Rs\.?|[$€£₹])[ \t]?\d[\d.,]*|\d[\d.,]*[ \t]?(?:EUR|USD|INR|GBP|CHF|€|₹))"
_BAR = r"[ \t]*(?:[|,;/–—-]|//)[ \t]*"
_CODES = ("sku", "ean", "art", "item", "ref")
_NUMBERED = re.compile(rf"\b(?:SKU|EAN|Art\.?|Item|Ref)[^\w\n]{{0,3}}\w+{_BAR}{_PRICE}(?:[ \t](?:new|sale|used|in stock|sold out|free shipping|[★☆⭐]+))?", re.IGNORECASE)
_PRODUCT = re.compile(rf"(?:[^\W\d_][\w-]*[ \t]){{1,5}}\d{{1,4}}{_BAR}\Z")
CODE = re.compile(rb"```.*?```", re.DOTALL)

# --- words of a batch, on bytes -------------------------------------------------------------------------
_KIND = np.zeros(256, bool)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0, 9, 10, 11, 12, 13, 32]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Words:
    """The words of texts (UTF-8) laid end to end with a zero byte after each: places, hashes and texts.

    A word is a longest run of ASCII letters and digits and of bytes from 0x80 on, but for the blocks of
    punctuation, signs and emoji; Latin letters count in lower case. Fenced code has no words.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = joined = b"\0".join([*texts, b""])
        self.bytes = data = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.ends = np.cumsum(sizes) - 1  # the zero byte of each text
        self.begins = self.ends - sizes + 1
        self.texts = len(texts)
        word = _KIND[data]
        low = _LOWER[data]
        for lead, width in ((0xE2, 3), (0xC2, 2), (0xF0, 4)):
            at = np.flatnonzero(data == lead)
            for k in range(width if len(at) else 0):
                word[at + k] = False
        for lead, second, third in ((0xE3, 0x80, None), (0xE0, 0xA5, (0xA4, 0xA5)), (0xEF, 0xB8, None), (0xEF, 0xBB, (0xBF,))):
            at = np.flatnonzero(data == lead)
            at = at[data[at + 1] == second]
            if third:
                at = at[np.isin(data[at + 2], third)]
            for k in range(3):
                word[at + k] = False
        at = np.flatnonzero(data == 0xC3) + 1
        at = at[(data[at] < 0x9F) & (data[at] != 0x97)]
        low[at] += 32  # capital letters of Latin-1
        if b"```" in joined:
            for m in CODE.finditer(joined):
                if b"\0" not in m.group():
                    word[m.start() : m.end()] = False
        self.start, self.stop, self.hash = word_hashes(word, low)
        self.text = np.searchsorted(self.ends, self.start)
        # bytes that begin a character, summed: places in characters
        self.chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]

    def length(self) -> np.ndarray:
        """Characters of each text."""
        return self.chars[self.ends] - self.chars[self.begins]

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of every run of ``size`` words inside one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        g = np.full(n, size, np.uint64)
        for k in range(size):
            g = mix(g * GOLDEN + self.hash[k : k + n])
        at = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return g[at], at


def repeated(g: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, group starts, group sizes) of the keys that occur more than once under one owner; rows of a group
    stand together in ascending order."""
    key = mix(g ^ (owner.astype(np.uint64) * GOLDEN))
    bits = max(10, int(len(key)).bit_length() + 2)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    rows = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)  # a key alone in its slot has no equal
    rows = rows[np.argsort(key[rows], kind="stable")]
    first = np.flatnonzero(np.r_[True, key[rows][1:] != key[rows][:-1]]) if len(rows) else np.empty(0, np.int64)
    n = np.diff(np.r_[first, len(rows)])
    return rows, first[n > 1], n[n > 1]


def _within(counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def stretches(w: Words, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end) of the stretches of ``least`` words or more without the end of a sentence."""
    data = w.bytes
    stop = (data == 46) | (data == 33) | (data == 63)
    at = np.flatnonzero(stop[:-1] & _SPACE[data[1:]])
    wide = np.flatnonzero((data[:-2] == 0xE0) & (data[1:-1] == 0xA5) & ((data[2:] == 0xA4) | (data[2:] == 0xA5)) | (data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] == 0xA6))
    wide = np.r_[wide, np.flatnonzero((data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (data[2:] == 0x82))]
    edges = np.searchsorted(w.start, np.sort(np.r_[at, wide, w.ends]))
    edges = edges[np.r_[True, edges[1:] != edges[:-1]][: len(edges)]]
    first = np.r_[0, edges[:-1]] if len(edges) else edges
    keep = edges - first >= least
    return first[keep], edges[keep]


def marks(w: Words) -> list[tuple[int, int]]:
    """Spans in bytes of links with their captions and list items, hashtags and product lines, by their form; of any
    length. Signs are sought on the whole block, patterns are tried only at them."""
    data, raw, spans = w.bytes, w.raw, []
    text = lambda a, b: raw[a:b].decode("utf-8", "replace")
    line_of = lambda at: max(raw.rfind(b"\n", 0, at), raw.rfind(b"\0", 0, at)) + 1
    signs = link_signs(w)
    if len(signs):
        fence = np.flatnonzero(_FENCE[data])
        right = fence[np.searchsorted(fence, signs)]
        left = np.r_[-1, fence][np.searchsorted(fence, signs)] + 1
        last = 0
        for a, b in np.unique(np.stack([left, right], axis=1), axis=0).tolist():
            token = text(a, b)
            for m in _URL.finditer(token):
                start, end = (a + len(token[: x].encode()) for x in m.span())
                line = max(line_of(start), last)
                head = text(line, start)
                item = _ITEM.match(head)
                if item:
                    start = line
                elif head.endswith("](") and "[" in head[:-2]:  # [caption](link)
                    start, end = line + len(head[: head.rindex("[", 0, len(head) - 2)].encode()), end + (raw[end : end + 1] == b")")
                spans.append((start, end))
                last = end
    for at in np.unique(w.text[np.searchsorted(w.start, anchor_signs(w)).clip(max=len(w.start) - 1)]).tolist() if len(w.start) else ():
        page = text(w.begins[at], w.ends[at])
        spans += [tuple(int(w.begins[at]) + len(page[:x].encode()) for x in m.span()) for m in _ANCHOR.finditer(page)]
    last = 0
    for at in w.start[np.isin(w.hash, _CODE_HASHES)].tolist():
        end = min(x for x in (raw.find(b"\n", at), raw.find(b"\0", at)) if x >= 0)
        rest = text(at, end)
        if m := _NUMBERED.match(rest):
            line = max(line_of(at), last)
            head = text(line, at)
            name = _PRODUCT.search(head)
            last = at + len(m.group().encode())
            spans.append((line + len(head[: name.start()].encode()) if name else at, last))
    at = hash_signs(w)
    for t in np.unique(np.searchsorted(w.ends, at)).tolist() if len(at) else ():
        page = text(w.begins[t], w.ends[t])
        spans += [tuple(int(w.begins[t]) + len(page[:x].encode()) for x in m.span()) for m in HASHTAGS.finditer(page) if m.group().count("#") >= 2]
    return spans


_CODE_HASHES = Words([" ".join(_CODES).encode()]).hash
_FENCE = _SPACE.copy()
_FENCE[[34, 39, 40, 41, 60, 62, 91, 93]] = True


def link_signs(w: Words) -> np.ndarray:
    """Places of slashes after a dot or a slash in the same token, and of dots after "www"."""
    data = w.bytes
    slash, dots = np.flatnonzero(data == 47), np.flatnonzero(data == 46)
    space = np.flatnonzero(_SPACE[data])
    before = lambda x: np.r_[-1, x][np.searchsorted(x, slash)]
    found = slash[(before(dots) > before(space)) | ((slash > 0) & np.isin(data[slash - 1], (47, 58)))]
    dots = dots[dots >= 3]
    return np.r_[found, dots[(data[dots - 1] | 32 == 119) & (data[dots - 2] | 32 == 119) & (data[dots - 3] | 32 == 119)]]


def hash_signs(w: Words) -> np.ndarray:
    at = np.flatnonzero(w.bytes[:-1] == 35)
    return at[_KIND[w.bytes[at + 1]]]


def anchor_signs(w: Words) -> np.ndarray:
    at = np.flatnonzero(w.bytes[:-2] == 60)
    return at[(w.bytes[at + 1] | 32 == 97) & _SPACE[w.bytes[at + 2]]]


def signed_lines(w: Words) -> np.ndarray:
    """Which bytes lie in a line that holds a sign of a link, hashtag or product; of texts with an anchor all do."""
    data = w.bytes
    edges = np.flatnonzero((data == 10) | (data == 0))
    line = np.zeros(len(edges) + 1, bool)
    line[np.searchsorted(edges, np.concatenate([link_signs(w), hash_signs(w), w.start[np.isin(w.hash, _CODE_HASHES)]]))] = True
    inside = np.repeat(line[: len(edges)], np.diff(np.r_[-1, edges]))  # the last byte ends a line
    for t in np.unique(np.searchsorted(w.ends, anchor_signs(w))).tolist():
        inside[w.begins[t] : w.ends[t]] = True
    return inside


class Tally:
    """Counts of 64-bit keys with a flag, kept in bounded memory and given out sorted when full."""

    def __init__(self, limit: int = 1_500_000):
        self.limit, self.keys, self.flags, self.size = limit, [], [], 0

    def add(self, keys: np.ndarray, flags: np.ndarray | None = None) -> None:
        self.keys.append(keys)
        self.flags.append(flags if flags is not None else np.zeros(0, np.int64))
        self.size += len(keys)

    def full(self) -> bool:
        return self.size > self.limit

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, how often each, sum of flags of each); empties the tally."""
        keys, flags = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.keys, self.flags))
        self.keys, self.flags, self.size = [], [], 0
        if not len(flags):
            keys = np.sort(keys)
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
            return keys[first], np.diff(np.r_[first, len(keys)]), np.zeros(len(first), np.int64)
        values, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        return values, n, np.bincount(inverse, flags, len(values)).astype(np.int64)


_LISTS = "pairs array<bigint>, firsts array<bigint>, seconds array<bigint>"
_ROWS = f"h1 bigint, h2 bigint, t string, repeats array<bigint>, stretches array<struct<start: int, stop: int, {_LISTS.replace(' array', ': array')}>>, what string, g bigint, n bigint, m bigint, {_LISTS}"
_LONG = pa.list_(pa.int64())
_THREE = [("pairs", _LONG), ("firsts", _LONG), ("seconds", _LONG)]
_SCHEMA = pa.schema([
    ("h1", pa.int64()), ("h2", pa.int64()), ("t", pa.string()), ("repeats", _LONG), ("stretches", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), *_THREE]))),
    ("what", pa.string()), ("g", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), *_THREE,
])


def rows_of(size: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch of ``size`` rows whose other columns are NULL."""
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type) if size else pa.array([], f.type)) for f in _SCHEMA], schema=_SCHEMA)


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _spread_mask(n: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in the spans; these must not overlap."""
    edge = np.zeros(n + 1, np.int8)
    edge[start] += 1
    edge[stop] -= 1
    return np.cumsum(edge, dtype=np.int8)[:n] > 0


def examine(w: Words, share: float, least: int):  # noqa: ANN201
    """(habits, pages, phrases, words, joints) of the texts of ``w``.

    Habits are (runs that a text repeats, whether three times or more) for each length. Pages are (text, runs repeated
    three times, stretches) of the texts in which such runs, stretches and lines with signs together exceed ``share``:
    all others cannot be flagged. Phrases are the distinct runs of the pages with their joints.
    """
    words = w.hash & ~np.uint64(1)
    n = len(words)
    joint = mix(mix(w.hash[:-1]) * GOLDEN + w.hash[1:]) | np.uint64(1) if n > 1 else np.empty(0, np.uint64)
    inner = np.flatnonzero(w.text[1:] == w.text[:-1])
    habits, hammered = [], []
    inside = np.zeros(n, bool)
    for size in RUNS:
        g, first = w.runs(size)
        rows, at, counts = repeated(g, w.text[first])
        often = counts >= 3
        habits.append((g[rows[at]], often.astype(np.int64)))
        at, counts = at[often], counts[often]
        where = rows[np.repeat(at, counts) + _within(counts)]
        hammered.append((size, g[rows[at]], first[rows[at]]))
        for k in range(size):
            inside[first[where] + k] = True
    begin, end = stretches(w, least)
    # what can be marked at most: a mark is bridged to the next one within GAP characters
    data = signed_lines(w)
    at = np.flatnonzero(inside)
    if len(at):
        joined = np.r_[inside[1:], False][at] & (np.r_[w.text[1:], -1][at] == w.text[at])
        data |= _spread_mask(len(data), w.start[at], np.where(joined, np.r_[w.start[1:], 0][at], w.stop[at]))
    if len(begin):
        data |= _spread_mask(len(data), w.start[begin], w.stop[end - 1])
    opened = np.r_[0, np.cumsum(np.r_[data[0], data[1:] & ~data[:-1]])]
    covered = np.r_[0, np.cumsum(data & ((w.bytes & 0xC0) != 0x80))]
    most = covered[w.ends] - covered[w.begins] + GAP * (opened[w.ends + 1] - opened[w.begins] + 1)
    wanted = most > share * w.length()
    pages = {t: (t, [], []) for t in np.flatnonzero(wanted).tolist()}
    phrases = []
    for size, g, first in hammered:
        own = np.flatnonzero(wanted[w.text[first]])
        if not len(own):
            continue
        order = own[np.argsort(w.text[first[own]], kind="stable")]
        texts, start = np.unique(w.text[first[order]], return_index=True)
        for t, part in zip(texts.tolist(), np.split(g[order], start[1:]), strict=True):
            pages[t][1].append(part)
        kept, at = np.unique(g[own], return_index=True)
        at = first[own][at]
        phrases.append((kept, *[np.stack([x[at + k] for k in range(size - 1)], axis=1) for x in (joint, words, words[1:])]))
    numeric = _DIGIT[w.bytes[w.start]]
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        t = int(w.text[a])
        if wanted[t]:
            lettered = np.flatnonzero(~numeric[a : b - 1] & ~numeric[a + 1 : b]) + a
            if len(lettered) >= least - 1:
                base = w.begins[t]
                cells = {c: x.view(np.int64).tolist() for c, x in (("pairs", joint[lettered]), ("firsts", words[lettered]), ("seconds", words[lettered + 1]))}
                pages[t][2].append({"start": int(w.start[a] - base), "stop": int(w.stop[b - 1] - base), **cells})
    return habits, list(pages.values()), phrases, words, joint[inner]


def blocks(column: pa.Array, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows with about ``size`` bytes together; a zero byte becomes a blank."""
    at, held, texts = 0, 0, []
    for i, t in enumerate(column.cast(pa.binary()).to_pylist()):
        texts.append(t.replace(b"\0", b" "))
        held += len(t)
        if held >= size:
            yield at, texts
            at, held, texts = i + 1, 0, []
    if texts:
        yield at, texts


def fresh(g: np.ndarray, known: set[int], limit: int = 500_000) -> np.ndarray:
    """Which of the distinct runs ``g`` were not given out lately; they are added to ``known``, of bounded size."""
    if len(known) >= limit:
        known.clear()
    keys = g.tolist()
    new = np.fromiter((x not in known for x in keys), bool, len(keys))
    known.update(keys)
    return new


def examined(texts: DataFrame, share: float, least: int, block: int = 1_000_000) -> DataFrame:
    """One pass over (h1, h2, t), a block of about ``block`` bytes at a time. Rows of five kinds:

    * ``page``: texts that could be flagged, with their runs repeated three times, and stretches in bytes;
    * ``phrase``: such a run ``g`` and its joints;
    * ``habit``: runs that texts repeat, in how many texts, and in how many three times or more;
    * ``count``: keys of words (even) and of pairs of neighbouring words (odd) and how often they occur;
    * ``total``: how many words there are.
    """

    def tally_rows(what: str, tally: Tally) -> pa.RecordBatch:
        g, n, m = tally.take()
        return rows_of(len(g), what=pa.array([what] * len(g), pa.string()), g=longs(g), n=pa.array(n.astype(np.int64)), m=pa.array(m))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        habits, counts, known, total = Tally(), Tally(), set(), 0
        for batch in batches:
            for at, own in blocks(batch.column(2), block):
                found, pages, phrases, words, joints = examine(Words(own), share, least)
                counts.add(words)
                counts.add(joints)
                total += len(words)
                for g, often in found:
                    habits.add(g, often)
                if pages:
                    rows = pa.array([at + t for t, _, _ in pages], pa.int32())
                    repeats = pa.array([np.concatenate(g).view(np.int64) if g else [] for _, g, _ in pages], _LONG)
                    kept = [pa.array([p[2] for p in pages], _SCHEMA.field("stretches").type)]
                    yield rows_of(len(rows), h1=batch.column(0).take(rows), h2=batch.column(1).take(rows), t=batch.column(2).take(rows), repeats=repeats, stretches=kept[0], what=pa.array(["page"] * len(rows), pa.string()))
                for g, *lists in phrases:
                    new = fresh(g, known)
                    n, width = int(new.sum()), lists[0].shape[1]
                    offsets = pa.array(np.arange(0, n * width + 1, width), pa.int32())
                    three = {name: pa.ListArray.from_arrays(offsets, longs(x[new].reshape(-1))) for name, x in zip(("pairs", "firsts", "seconds"), lists, strict=True)}
                    yield rows_of(n, what=pa.array(["phrase"] * n, pa.string()), g=longs(g[new]), **three)
                if habits.full():
                    yield tally_rows("habit", habits)
                if counts.full():
                    yield tally_rows("count", counts)
        yield tally_rows("habit", habits)
        yield tally_rows("count", counts)
        yield rows_of(1, what=pa.array(["total"]), n=pa.array([total], pa.int64()))

    return texts.mapInArrow(run, _ROWS)


def covered(start: np.ndarray, stop: np.ndarray) -> int:
    """Characters inside the spans; a gap of a few signs between two of them belongs to them."""
    if not len(start):
        return 0
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1] + GAP])
    return int((reach[np.r_[first[1:] - 1, len(reach) - 1]] - start[first]).sum())


def _joints(units: DataFrame, *names: str) -> DataFrame:
    zipped = units.select(*names, F.explode(F.arrays_zip("pairs", "firsts", "seconds")).alias("z"))
    return zipped.select(*names, F.col("z.pairs").alias("p"), F.col("z.firsts").alias("a"), F.col("z.seconds").alias("b"))


def stuffed_pages(df: DataFrame, key: str, text: str, share: float = 0.5, hammered: float = 0.75, bound: float | None = 1.0, coherent: float | None = 0.0, least: int = 30) -> DataFrame:
    """(key, marked_share) of the texts whose marked characters exceed ``share`` of all.

    ``hammered``: of the texts that repeat a run of words, the part that must repeat it three times or more;
    ``bound``: the mean pointwise mutual information from which a run is a collocation; ``coherent``: the mean
    normalised information below which a stretch of ``least`` words or more without the end of a sentence is word
    salad (pairs with numbers do not count). None switches either test off: no run counts, then, and no stretch.

    NULL, empty and blank texts are never flagged; equal texts are examined once, are judged alike under all their
    keys and count once in every statistic. An empty table gives no rows; other columns are ignored.
    """
    source = ensure_spread(df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))).where(F.col("t").rlike(r"\S"))
    hashed = source.withColumns({"h1": F.xxhash64("t"), "h2": F.xxhash64(F.lit(1), "t")})
    seen = staged(examined(hashed.select("h1", "h2", "t").dropDuplicates(["h1", "h2"]), share, least), "p9-examined")
    pages = seen.where("what = 'page'").select("h1", "h2", "t", "repeats", "stretches")

    habits = seen.where("what = 'habit'").groupBy("g").agg(F.sum("m").alias("m"), F.sum("n").alias("n")).where(F.col("m") > hammered * F.col("n")).select("g")
    phrases = seen.where("what = 'phrase'").select("g", "pairs", "firsts", "seconds").dropDuplicates(["g"])
    in_runs = staged(_joints(phrases.join(habits, "g"), "g"), "p9-phrases")
    stretched = pages.select("h1", "h2", F.explode("stretches").alias("s")).select("h1", "h2", "s.*")
    in_stretches = staged(_joints(stretched, "h1", "h2", "start", "stop").groupBy("h1", "h2", "start", "stop", "p", "a", "b").agg(F.count("*").alias("c")), "p9-joints")

    # the counts of the words and pairs that are asked for, then each kind of joint is weighed once
    counts = seen.where("what = 'count'").select("g", "n")
    total = seen.where("what = 'total'").agg(F.sum("n")).first()[0] or 1
    kinds = staged(in_runs.select("p", "a", "b").union(in_stretches.select("p", "a", "b")).distinct(), "p9-kinds")
    needed = kinds.select(F.explode(F.array("p", "a", "b")).alias("g")).distinct()
    held = staged(counts.join(needed, "g", "left_semi").groupBy("g").agg(F.sum("n").alias("n")), "p9-needed")
    weighed = kinds
    for name in ("p", "a", "b"):
        weighed = weighed.join(held.select(F.col("g").alias(name), F.col("n").alias(f"n{name}")), name)
    weighed = staged(weighed, "p9-weighed")
    chance = F.col("na") * F.col("nb").cast("double") / float(total)

    scored = salted_join(in_runs, weighed, ["p", "a", "b"]).groupBy("g").agg(F.avg(F.log(F.col("np") / chance)).alias("pmi"))
    chosen = scored.where(F.lit(False) if bound is None else F.col("pmi") >= bound).select("g")
    repeats = pages.select("h1", "h2", F.explode("repeats").alias("g"))
    by_page = salted_join(repeats, chosen, ["g"]).groupBy("h1", "h2").agg(F.collect_list("g").alias("phrases"))

    # of a joint that no other text has, the normalised information is -1, its limit for pairs that never meet
    others = F.col("np") - F.col("c")
    information = F.when(others > 0, F.log(others / chance) / F.greatest(-F.log(others / float(total)), F.lit(1e-9))).otherwise(-1.0)
    salad = salted_join(in_stretches, weighed, ["p", "a", "b"]).groupBy("h1", "h2", "start", "stop").agg((F.sum(information * F.col("c")) / F.sum("c")).alias("npmi"))
    salad = salad.where(F.lit(False) if coherent is None else F.col("npmi") < coherent)
    salad_by_page = salad.groupBy("h1", "h2").agg(F.flatten(F.collect_list(F.array("start", "stop"))).alias("salad"))

    together = pages.select("h1", "h2", "t").join(by_page, ["h1", "h2"], "left").join(salad_by_page, ["h1", "h2"], "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shares = [], []
            chosen_runs, lists = batch.column("phrases"), batch.column("salad")
            for at, own in blocks(batch.column("t"), 1_000_000):
                w = Words(own)
                found = np.array(marks(w), np.int64).reshape(-1, 2)
                start, stop = [found[:, 0]], [found[:, 1]]
                # the page's own stuffed runs, looked up as (text, run)
                held = [np.asarray(chosen_runs[at + t].values, np.int64).view(np.uint64) if chosen_runs[at + t].is_valid else np.empty(0, np.uint64) for t in range(len(own))]
                keyed = np.concatenate([mix(g ^ (np.full(len(g), t, np.uint64) * GOLDEN)) for t, g in enumerate(held)])
                for size in RUNS:
                    g, first = w.runs(size)
                    first = first[np.isin(mix(g ^ (w.text[first].astype(np.uint64) * GOLDEN)), keyed)]
                    start.append(w.start[first])
                    stop.append(w.stop[first + size - 1])
                for t in range(len(own)):
                    if lists[at + t].is_valid:
                        x = np.asarray(lists[at + t].values, np.int64) + w.begins[t]
                        start.append(x[::2])
                        stop.append(x[1::2])
                a, b = np.concatenate(start), np.concatenate(stop)
                owner, length = np.searchsorted(w.ends, a), w.length()
                order = np.argsort(owner, kind="stable")
                a, b, owner = w.chars[a[order]], w.chars[b[order]], owner[order]
                edges = np.searchsorted(owner, np.arange(len(own) + 1))
                for t in range(len(own)):
                    n = covered(a[edges[t] : edges[t + 1]], b[edges[t] : edges[t + 1]])
                    if n > share * length[t]:
                        rows.append(at + t)
                        shares.append(n / int(length[t]))
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(shares, pa.float64())], names=["h1", "h2", "marked_share"])

    flagged = staged(together.mapInArrow(judge, "h1 bigint, h2 bigint, marked_share double"), "p9-flagged")
    # one text may stand under a third of all keys
    return salted_join(hashed.select("k", "h1", "h2"), flagged, ["h1", "h2"]).select(F.col("k").alias(key), "marked_share")
