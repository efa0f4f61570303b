"""Problem 7: encoding a corpus with a public byte-level BPE vocabulary in linear time.

The vocabulary's byte strings are mapped to Latin-1 and held in a pyahocorasick trie. A piece of text
is covered from left to right with the longest matching token; a token may follow another only if the
pair is what the merges themselves would leave side by side, which is decided by undoing merges and is
memoised. Where no token fits, the walk steps back to the next shorter match. The first cover reached
is the result of the merges. Pieces recur, so their ids are kept in a bounded memory.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.runtime import ensure_spread

TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the published pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the pattern means it, and cuts that never fall inside a piece: before each run of it.
SPACE = r" \t\n\x0b\x0c\r\x85\xa0  -     　"
COARSE = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


class BytePairEncoder:
    """Ids of texts by the rank file at ``path`` (lines of base64 token and rank)."""

    def __init__(self, path: str, memory: int = 300_000):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks, self.memory = ranks, memory
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), rank)
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.shorter: dict[int, int] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(PATTERN)

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The pair of tokens whose merge made ``token``; None for single bytes."""
        if token not in self.halves:
            parts = [self.ranks[bytes([x])] for x in self.bytes_of[token]]
            while len(parts) > 2:
                best, at = None, 0
                for i in range(len(parts) - 1):
                    r = self.ranks.get(self.bytes_of[parts[i]] + self.bytes_of[parts[i + 1]])
                    if r is not None and r < token and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                parts[at : at + 2] = [best]
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def _adjacent(self, left: int, right: int) -> bool:
        """Would the merges leave ``left`` directly before ``right``?

        Undo the later of the two merges that made them, again and again; the pair is ruled out if a
        token across the border has an earlier rank than the merges undone so far, which then would
        have come first (on the right side also at equal rank, as merges run from left to right)."""
        key = (left, right)
        fits = self.pairs.get(key)
        if fits is None:
            a, b, limit, fits = left, right, 1 << 31, True
            while True:
                across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
                if across is not None and across < limit:
                    fits = False
                    break
                half_a, half_b = self._halves(a), self._halves(b)
                if half_a is None and half_b is None:
                    break
                if half_b is None or (half_a is not None and a > b):
                    limit, a = a, half_a[1]
                else:
                    limit, b = b + 1, half_b[0]
            self.pairs[key] = fits
        return fits

    def _next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, -1 if none."""
        if token not in self.shorter:
            text = self.bytes_of[token].decode("latin-1")[:-1]
            n = self.trie.longest_prefix(text)
            while n and text[:n] not in self.trie:
                n -= 1
            self.shorter[token] = self.trie.get(text[:n]) if n else -1
        return self.shorter[token]

    def piece(self, data: bytes) -> list[int]:
        """Ids of one pre-split piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        text, n = data.decode("latin-1"), len(data)
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, self._match(text, 0)
        while at < n:
            while token >= 0:
                end = at + len(self.bytes_of[token])
                if not dead[end] and (not out or self._adjacent(out[-1], token)):
                    break
                token = self._next_shorter(token)
            if token >= 0:
                out.append(token)
                at = end
                if at < n:
                    token = self._match(text, at)
            else:
                dead[at] = 1
                token = out.pop()
                at -= len(self.bytes_of[token])
                token = self._next_shorter(token)
        return out

    def _match(self, text: str, at: int) -> int:
        window = text[at : at + self.longest]
        n = self.trie.longest_prefix(window)
        while window[:n] not in self.trie:
            n -= 1
        return self.trie.get(window[:n])

    def _fresh(self, part: str) -> tuple[int, ...]:
        ids: list[int] = []
        for x in self.split.findall(part):
            ids += self.piece(x.encode("utf-8", "replace"))
        got = tuple(ids)
        if len(part) <= 40:
            if len(self.known) >= self.memory:
                self.known.clear()
            self.known[part] = got
        return got

    def parts(self, text: str) -> list[tuple[int, ...]]:
        """The ids of ``text``, one tuple for each stretch of white space and word."""
        known, fresh = self.known, self._fresh
        return [known.get(p) or fresh(p) for p in COARSE.findall(text)]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.parts(text)))


@lru_cache(2)
def encoder(path: str) -> BytePairEncoder:
    return BytePairEncoder(path)


def vocabulary_path(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> str:
    return f"{folder}/{name}.tiktoken"


def encode_column(df: DataFrame, key: str, text: str, vocabulary: str | None = None, counts_only: bool = False) -> DataFrame:
    """(key, ids array<int>) of every row, or (key, n_tokens int) with ``counts_only``.

    NULL and empty texts have an empty list (0 tokens); texts of any length are encoded whole;
    repeated rows are encoded each; other columns are ignored; an empty table gives no rows.
    """
    path = vocabulary or vocabulary_path()
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = [enc.parts(t) if t else [] for t in batch.column(1).to_pylist()]
                sizes = np.fromiter((sum(map(len, x)) for x in lists), np.int32, len(lists))
                if counts_only:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes)], names=[key, "n_tokens"])
                    continue
                flat = np.fromiter(chain.from_iterable(chain.from_iterable(lists)), np.int32, int(sizes.sum()))
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[key, "ids"])

    out = "n_tokens int" if counts_only else "ids array<int>"
    return ensure_spread(df.select(key, F.col(text).cast("string").alias("__text"))).mapInArrow(run, f"`{key}` {kind}, {out}")
