"""Problem 1: near-duplicate records by DartMinHash signatures and banded joining.

Darts are thrown at the plane (weight x rank) of every element: a Poisson process of rate one
whose points depend only on a hash of the element and of the unit cell they fall in. A document
with element weights ``w`` keeps the darts whose weight coordinate lies below ``w`` and whose rank
lies below a limit chosen so that about ``k ln k + 2k`` darts remain; every dart names one of ``k``
coordinates, and a coordinate keeps its dart of earliest rank. Two documents agree in a coordinate
with a probability equal to their weighted Jaccard similarity, at a cost of ``k ln k`` darts instead
of ``k`` hashes for every element. Documents missing a coordinate throw more darts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.components import connected_components
from sieveline.llm.pairs import pairs_within
from sieveline.llm.shingles import GOLDEN, mix, shingle_sets, similar
from sieveline.plans.runtime import ensure_spread, salted_join, staged

#: Rank layers: [0, 1), [1, 2), [2, 4), [4, 8), [8, 16), [16, 32), then 32 wide.
_START = np.array([0.0, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0])
_WIDTH = np.array([1.0, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0])


def _cdf(mean: float) -> np.ndarray:
    upto = int(mean + 12 * np.sqrt(mean) + 12)
    i = np.arange(upto)
    return np.cumsum(np.exp(i * np.log(mean) - mean - np.cumsum(np.log(np.maximum(i, 1)))))


_CDFS = [_cdf(w) for w in _WIDTH]


def _layers(theta: np.ndarray) -> np.ndarray:
    """How many layers start below each rank limit; from [32, 64) on layers are 32 wide."""
    return np.where(theta <= 64, 1 + np.ceil(np.log2(np.clip(theta, 1, 64))), 7 + np.ceil((theta - 64) / 32)).astype(np.int64)


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... count-1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def signatures(elements: np.ndarray, owners: np.ndarray, weights: np.ndarray, documents: int, k: int, seed: int = 1) -> np.ndarray:
    """A (documents, k) array of 32-bit dart ids; ``owners`` gives the document of each element.

    Documents without elements of positive weight have a row of zeros.
    """
    best = np.full((documents, k), np.iinfo(np.uint64).max, np.uint64)
    total = np.bincount(owners, weights, documents)
    theta = np.where(total > 0, k * (np.log(k) + 2) / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    while todo.any():
        pick = todo[owners] & (weights > 0)
        e, own, w = elements[pick], owners[pick], weights[pick]
        cells = np.ceil(w).astype(np.int64)
        cell = _within(cells)
        e, own, w = np.repeat(e, cells), np.repeat(own, cells), np.repeat(w, cells)
        e = mix(e + (cell.astype(np.uint64) + np.uint64(seed)) * GOLDEN)
        n = _layers(theta[own])
        layer = _within(n)
        at = np.repeat(np.arange(len(e)), n)
        region = mix(e[at] + (layer.astype(np.uint64) + np.uint64(1)) * GOLDEN)
        u, kind = _unit(region), np.minimum(layer, 6)
        count = np.zeros(len(at), np.int64)
        for j in range(int(kind.max(initial=0)) + 1):
            own_kind, cdf = np.flatnonzero(kind == j), _CDFS[j]
            count[own_kind] = np.searchsorted(cdf, u[own_kind], "right")
        hit = np.flatnonzero(count)
        count = count[hit]
        dart = mix(np.repeat(region[hit], count) + (_within(count).astype(np.uint64) + np.uint64(7)) * GOLDEN)
        at, layer = np.repeat(at[hit], count), np.repeat(layer[hit], count)
        kind = np.minimum(layer, 6)
        start = _START[kind] + 32.0 * (layer - kind)
        place = mix(dart + np.uint64(1))  # its upper half is the rank, its lower half the coordinate
        rank = start + _WIDTH[kind] * ((place >> np.uint64(32)).astype(np.float64) * 2.0**-32)
        keep = rank < theta[own[at]]
        if (w != np.floor(w)).any():
            keep &= cell[at] + _unit(mix(dart + np.uint64(2))) < w[at]
        dart, rank, place, document = dart[keep], rank[keep], place[keep], own[at][keep]
        coordinate = ((place & np.uint64(0xFFFFFFFF)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        value = (np.minimum(rank * 2.0**20, 2.0**32 - 1).astype(np.uint64) << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF))
        np.minimum.at(best.reshape(-1), document * k + coordinate, value)
        todo &= (best == np.iinfo(np.uint64).max).any(axis=1)
        theta = np.where(todo, theta * 1.5, theta)
    return np.where(total[:, None] > 0, best & np.uint64(0xFFFFFFFF), np.uint64(0)).astype(np.uint32)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit keys of ``rows`` coordinates each; the band's number is part of the key."""
    documents, k = signature.shape
    bands = k // rows
    parts = signature[:, : bands * rows].astype(np.uint64).reshape(documents, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, (documents, bands)).copy()
    for r in range(rows):
        key = mix(key + parts[:, :, r] * np.uint64(0xD6E8FEB86659FD93) + GOLDEN)
    return key


def banded(sets: DataFrame, key: str, bands: int, rows: int) -> DataFrame:
    """(key, n, bands array<bigint>) of every shingle set, from DartMinHash signatures of unit weights."""
    kind = dict(sets.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
                elements = np.concatenate(parts)
                owners = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                keys = band_keys(signatures(elements, owners, np.ones(len(elements)), len(parts), bands * rows), rows)
                flat = pa.array(keys.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=[key, "n", "bands"])

    return sets.select(key, "n", "shingles").mapInArrow(run, f"`{key}` {kind}, n int, bands array<bigint>")


class NearDuplicates:
    """Near-duplicate records of one table.

    Rows with equal shingle sets are one class of copies; pairs are searched between the classes'
    representatives (smallest key) by banded joins and kept if the exact Jaccard similarity of the
    sets is at least ``share / of``. With the default 42 bands of 4 rows a pair at similarity 0.70
    is missed with probability (1 - 0.7^4)^42 < 1e-5, one at 0.8 with less than 1e-9.

    NULL or empty texts and texts with fewer than ``least`` distinct runs take no part. Repeated
    rows are copies of each other. An empty table gives no rows; other columns are ignored.
    """

    def __init__(self, df: DataFrame, key: str, title: str, content: str, share: int = 8, of: int = 10, size: int = 5, least: int = 10, bands: int = 42, rows: int = 4):
        self.key, self.share, self.of = key, share, of
        source = ensure_spread(df.select(key, title, content))
        self.sets = staged(shingle_sets(source, key, title, content, size=size, least=least), "p1-sets").withColumnRenamed(key, "record")
        self.members = staged(self._members(), "p1-members")
        reps = self.members.where("record = rep").select("record").distinct()
        self.representatives = self.sets.join(reps, "record", "left_semi").dropDuplicates(["record"])
        keys = banded(self.representatives.select("record", "n", "shingles"), "record", bands, rows)
        self.postings = staged(keys.select("record", "n", F.explode("bands").alias("band")), "p1-bands")

    def _members(self) -> DataFrame:
        first = self.sets.groupBy("h1", "h2").agg(F.min("record").alias("rep"))
        return self.sets.select("record", "h1", "h2").join(first, ["h1", "h2"]).select("record", "rep")

    def representative_pairs(self) -> DataFrame:
        """(a, b, common): similar representatives, a < b."""
        fits = (F.col("a_n") * self.of >= F.col("b_n") * self.share) & (F.col("b_n") * self.of >= F.col("a_n") * self.share)
        found = pairs_within(self.postings, ["band"], "record", ["n"]).where(fits).select("a", "b").distinct()
        sets = self.representatives.select("record", "shingles")
        held = found.join(sets.select(F.col("record").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("record").alias("b"), F.col("shingles").alias("sb")), "b")
        return similar(held, self.share, self.of)

    def record_pairs(self) -> DataFrame:
        """(record_a, record_b): every similar pair of different keys, copies expanded."""
        pairs = staged(self.representative_pairs().select("a", "b"), "p1-pairs")
        members = self.members.distinct()
        of_a = members.select(F.col("rep").alias("a"), F.col("record").alias("x"))
        of_b = members.select(F.col("rep").alias("b"), F.col("record").alias("y"))
        # the members, of which a class may hold many, are spread; the few pairs of a class are repeated
        across = salted_join(of_b, salted_join(of_a, pairs, ["a"]).select("x", "b"), ["b"]).select(F.least("x", "y").alias("record_a"), F.greatest("x", "y").alias("record_b"))
        copies = pairs_within(members, ["rep"], "record").select(F.col("a").alias("record_a"), F.col("b").alias("record_b"))
        return across.union(copies)

    def groups(self) -> DataFrame:
        """(record, class_id, links): one row per key in the source that takes part; class_id is the
        smallest key of its connected group, links the number of similar other classes of copies."""
        pairs = staged(self.representative_pairs().select("a", "b"), "p1-pairs")
        labels = connected_components(pairs, "a", "b")
        both = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("links"))
        named = labels.withColumnRenamed("node", "rep").join(both, "rep")
        return (
            self.members.distinct()
            .join(named, "rep", "left")
            .select(F.col("record").alias(self.key), F.coalesce("component", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
        )
