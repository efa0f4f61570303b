"""Sets of 64-bit hashes as bytes: mixing, MinHash bands and exact comparison, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs_of(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` word hashes; fewer words make one run."""
    n = max(len(words) - size + 1, min(len(words), 1))
    h = np.zeros(n, np.uint64)
    for k in range(min(size, len(words))):
        h = mix(h * GOLDEN + words[k : k + n])
    return np.unique(h)


def minhash_bands(elements: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``bands`` 64-bit keys of ``rows`` MinHash values each; the band's number is part of the key."""
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * GOLDEN)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 65_536 // len(seeds))
    for at in range(0, len(elements), step):
        least = np.minimum(least, mix(elements[at : at + step, None] ^ seeds).min(axis=0))
    key = np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN
    for r in range(rows):
        key = mix(key * GOLDEN + least.reshape(bands, rows)[:, r])
    return key


def banded(sets: DataFrame, key: str, bands: int, rows: int) -> DataFrame:
    """(key, n, bands array<bigint>) of every (key, n, shingles)."""
    kind = dict(sets.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [minhash_bands(np.frombuffer(x.as_buffer(), np.uint64), bands, rows) for x in batch.column("shingles")]
            flat = pa.array(np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=[key, "n", "bands"])

    return sets.select(key, "n", "shingles").mapInArrow(run, f"`{key}` {kind}, n int, bands array<bigint>")


def similar(pairs: DataFrame, share: int, of: int) -> DataFrame:
    """Keep the rows of ``pairs`` (… sa binary, sb binary …) whose sets have a Jaccard similarity
    of at least ``share / of``, compared in whole numbers; adds ``common``."""
    names = [c for c in pairs.columns if c not in ("sa", "sb")]
    schema = ", ".join([*[f"`{c}` {dict(pairs.dtypes)[c]}" for c in names], "common int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, common = [], []
            left, right = batch.column("sa"), batch.column("sb")
            for i in range(batch.num_rows):
                a, b = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if of * both >= share * (len(a) + len(b) - both):
                    rows.append(i)
                    common.append(both)
            picked = batch.select(names).take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(common, pa.int32())], names=[*names, "common"])

    return pairs.select(*names, "sa", "sb").mapInArrow(run, schema)
