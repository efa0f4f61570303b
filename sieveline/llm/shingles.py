"""Word-shingle sets of texts as sorted 64-bit integers, shared by the near-duplicate operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.hashing import GOLDEN, mix, similar

__all__ = ["GOLDEN", "WORD", "mix", "shingle_sets", "similar", "text_of", "word_hashes", "word_runs"]

WORD = re.compile(r"[a-z0-9]+")
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_KIND = np.zeros(256, bool)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(word: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, hash) of the longest runs of bytes with ``word`` set; the last byte must not be one."""
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.r_[0, edge]
    start, stop = edge[::2], edge[1::2]
    size = stop - start
    if not len(size):
        return start, stop, np.empty(0, np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    power = np.multiply.accumulate(np.full(int(size.max()), _STEP, np.uint64))
    return start, stop, mix(np.add.reduceat(_VALUE[low[word]] * power[place], first))


def word_runs(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the runs of ``size`` consecutive words of each text, all texts at once."""
    # of all characters only these two have lower cases with an ASCII letter and no ASCII letter themselves
    held = [(t.lower() if "\u0130" in t or "\u212a" in t else t).encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*held, b""]), np.uint8)
    start, _, h = word_hashes(_KIND[data], _LOWER[data])
    ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1)
    edges = np.searchsorted(start, np.r_[0, ends])
    n = max(len(h) - size + 1, 0)
    g = np.zeros(n, np.uint64)
    for k in range(size):
        g = mix(g * GOLDEN + h[k : k + n])
    return [np.unique(g[a : max(a, b - size + 1)]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def text_of(title: str | None, content: str | None) -> str:
    return f"{title or ''} {content or ''}"


def shingle_sets(df: DataFrame, key: str, title: str, content: str, keep: list[str] | None = None, size: int = 3, least: int = 10) -> DataFrame:
    """(key, keep..., n, h1, h2, shingles) of every row with at least ``least`` distinct runs.

    ``shingles`` is the sorted set as little-endian 64-bit integers, ``h1``/``h2`` are 128 bits
    over it: rows with equal pairs have equal sets. NULL texts count as empty.
    """
    keep = keep or []
    source = df.select(F.col(key).alias("__k"), F.col(title).cast("string").alias("__t"), F.col(content).cast("string").alias("__c"), *[F.col(c).alias(f"__x{i}") for i, c in enumerate(keep)])
    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{key}` {kinds[key]}", *[f"`{c}` {kinds[c]}" for c in keep], "n int", "h1 bigint", "h2 bigint", "shingles binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            texts = [text_of(t, c) for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            for at in range(0, len(texts), 256):
                for i, s in enumerate(word_runs(texts[at : at + 256], size), at):
                    if len(s) >= least:
                        rows.append(i)
                        sets.append(s.tobytes())
            picked = batch.take(pa.array(rows, pa.int32()))
            digests = [xxhash.xxh128_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    picked.column(0),
                    *picked.columns[3:],
                    pa.array([len(s) // 8 for s in sets], pa.int32()),
                    pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                    pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digests], pa.int64()),
                    pa.array(sets, pa.binary()),
                ],
                names=[key, *keep, "n", "h1", "h2", "shingles"],
            )

    return source.mapInArrow(run, schema)
