"""Problem 6: deduplicating new batches against all history.

The history is an inverted index on the shared file system: postings (token, record, batch, set size, place) of the
rare-token prefix of every record, as a table bucketed by token, and the sets themselves in small files, one for about
4,096 records each. A batch writes its own postings once, into the buckets; bucket meets bucket, so a probe shuffles
neither the history nor the batch. Pairs whose sizes cannot reach the similarity, or that share too few of their rarest
tokens, are dropped, the files with the sets of the surviving candidates are read (no others) and their overlap is
verified exactly. No text of the history is read again and no earlier file is rewritten; postings of a rejected record
stay and are passed over.

Tokens are ordered from rare to frequent by a frequency sketch of fixed size, frozen with the first batch: any fixed
order is correct, a good one keeps posting lists short. Of two records with a Jaccard similarity of ``t`` the
``n - least + COMMON`` rarest tokens have COMMON in common, ``least`` being the tokens they must share.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.shingles import mix, shingle_sets, similar
from sieveline.plans.runtime import ensure_spread, stage_path, staged

SKETCH = 1 << 18
COMMON = 6
#: Records whose sets share a file.
FILE_RECORDS = 4096


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens + np.uint64(11)) % np.uint64(SKETCH)).astype(np.int64)


def frequency_sketch(sets: DataFrame) -> np.ndarray:
    """Token counts of ``sets`` hashed into SKETCH slots; its size does not depend on the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for x in batch.column(0):
                np.add.at(total, _slots(np.frombuffer(x.as_buffer(), np.uint64)), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    counts = sets.select("shingles").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    sketch = np.zeros(SKETCH, np.int64)
    sketch[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    return sketch


def prefixes(sets: DataFrame, sketch: np.ndarray, share: int, of: int) -> DataFrame:
    """(token, record, batch, home, n, place) for the rarest tokens of every set, as many as a similar set of any size
    needs."""
    held = sets.sparkSession.sparkContext.broadcast(sketch)
    names = ["token", "record", "batch", "home", "n", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = held.value
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
            if not parts:
                continue
            sizes = np.array([len(p) for p in parts])
            flat, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
            order = np.lexsort((flat, counts[_slots(flat)], owner))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = sizes + share * sizes // -of + COMMON  # n - ceil(share n / of) + COMMON
            chosen = np.flatnonzero(place < kept[owner])
            at = pa.array(owner[chosen].astype(np.int32))
            cells = [pa.array(flat[order[chosen]].view(np.int64)), *[batch.column(c).take(at) for c in names[1:5]], pa.array(place[chosen].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cells, names=names)

    return sets.select("record", "batch", "home", "n", "shingles").mapInArrow(run, "token bigint, record bigint, batch int, home int, n int, place int")


class HistoryIndex:
    """Records of all earlier batches; ``accept`` decides what newly arrived and appends it.

    An arrival is one batch or several waiting ones; its rows count in order of (batch, record), so the
    result does not depend on how batches are taken together.
    """

    def __init__(self, spark: SparkSession, path: str, share: int, of: int):
        self.spark, self.path, self.share, self.of = spark, path, share, of
        self.sketch: np.ndarray | None = None
        self.homes, self.spans, self.held = 0, [], 0
        self.table = f"postings_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _meet(self, first: int, join: str) -> DataFrame:
        """(a, b, home): pairs of an earlier record and one of the batches from ``first`` on that share enough of
        their rarest tokens; both sides are read from the same buckets."""
        held = self.spark.table(self.table)
        old = held.select("token", F.col("record").alias("a"), F.col("batch").alias("ba"), "home", F.col("n").alias("na"), F.col("place").alias("pa"))
        new = held.where(F.col("batch") >= first).select("token", F.col("record").alias("b"), F.col("batch").alias("bb"), F.col("n").alias("nb"), F.col("place").alias("pb"))
        before = (F.col("ba") < F.col("bb")) | ((F.col("ba") == F.col("bb")) & (F.col("a") < F.col("b")))
        sizes = (F.col("na") * self.of >= F.col("nb") * self.share) & (F.col("nb") * self.of >= F.col("na") * self.share)
        least = F.ceil(F.lit(self.share) * (F.col("na") + F.col("nb")) / F.lit(self.of + self.share)).cast("int")
        near = old.join(new.hint(join), "token").where(before & sizes & (F.col("pa") < F.col("na") - least + COMMON) & (F.col("pb") < F.col("nb") - least + COMMON))
        return near.groupBy("a", "b", "home").agg(F.count("*").alias("shared")).where(F.col("shared") >= COMMON).select("a", "b", "home")

    def _sets(self, homes: list[int]) -> DataFrame:
        kind = "record bigint, batch int, n int, shingles binary"
        if not homes:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*[f"{self.path}/sets/lot={lot}/home={h}" for h in homes for lot in [self._lot(h)]])

    def _lot(self, home: int) -> int:
        return next(i for i, (first, end) in enumerate(self.spans) if first <= home < end)

    def accept(self, sets: DataFrame, first: int) -> DataFrame:
        """Rejected records of ``sets`` (record, batch, n, h1, h2, shingles), whose batches are numbered from ``first``
        on: those similar to an accepted one of the history or to one accepted before in this arrival."""
        if self.sketch is None:
            self.sketch = frequency_sketch(sets)
        heads = sets.groupBy("h1", "h2").agg(F.min(F.struct("batch", "record")).alias("at")).select("at.record")
        heads = staged(heads, "p6-heads")
        arrived = heads.count()
        slots = max(1, -(-arrived // FILE_RECORDS))
        base, lot = self.homes, len(self.spans)
        self.homes += slots
        self.spans.append((base, base + slots))
        home = (F.lit(base) + F.pmod(F.xxhash64("record"), F.lit(slots))).cast("int")
        firsts = sets.join(heads, "record", "left_semi").select("record", "batch", "n", "shingles", home.alias("home"))
        where = f"{self.path}/sets/lot={lot}"
        firsts.repartition(slots, "home").write.option("compression", "zstd").partitionBy("home").parquet(where)
        stored = self.spark.read.schema("record bigint, batch int, n int, shingles binary, home int").parquet(where)
        mine = prefixes(stored, self.sketch, self.share, self.of)
        writer = mine.repartition(self.buckets, "token").write.option("compression", "zstd").option("path", f"{self.path}/postings")
        writer.bucketBy(self.buckets, "token").sortBy("token").mode("append").saveAsTable(self.table)
        # a small arrival is hashed bucket by bucket and the history streams past it; a large one is merged
        pairs = self._meet(first, "shuffle_hash" if 4 * arrived <= self.held else "merge")
        self.held += arrived
        if lot:
            gone = self.spark.read.schema("record bigint").parquet(f"{self.path}/rejected")
            pairs = pairs.join(gone.select(F.col("record").alias("a")), "a", "left_anti")
        pairs = staged(pairs, "p6-candidates")
        touched = [r[0] for r in pairs.select("home").distinct().collect()]  # at most one number for each file of sets
        ours = self._sets(list(range(base, base + slots))).select(F.col("record").alias("b"), F.col("shingles").alias("sb"))
        theirs = self._sets(touched).select(F.col("record").alias("a"), F.col("shingles").alias("sa"))
        found = staged(similar(pairs.join(theirs, "a").join(ours, "b").select("a", "b", "home", "sa", "sb"), self.share, self.of).select("a", "b", "home"), "p6-links")
        old = found.where(F.col("home") < base).select(F.col("b").alias("record")).distinct()
        rejected = self._resolve(found.where(F.col("home") >= base).select("a", "b"), old)
        rejected.coalesce(1 + arrived // 1_000_000).write.mode("append").parquet(f"{self.path}/rejected")
        copies = sets.select("record").join(heads, "record", "left_anti")
        return rejected.union(copies)

    def close(self) -> None:
        """Forget the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def _resolve(self, links: DataFrame, gone: DataFrame) -> DataFrame:
        """Walk the batch in order of record without a loop over records: a record without an open
        earlier neighbour is accepted, its later neighbours are rejected, until no link is open."""
        parts = [staged(gone, "p6-gone")]
        while True:
            of_a, of_b = (parts[-1].select(F.col("record").alias(x)) for x in "ab")
            links = staged(links.join(of_a, "a", "left_anti").join(of_b, "b", "left_anti"), "p6-open")
            if links.isEmpty():
                break
            heads = links.select("a").distinct().join(links.select(F.col("b").alias("a")), "a", "left_anti")
            parts.append(staged(links.join(heads, "a", "left_semi").select(F.col("b").alias("record")).distinct(), "p6-hit"))
        return functools.reduce(DataFrame.union, parts)


def arrivals(batches: list[tuple[str, int]]) -> list[list[str]]:
    """Waiting batches in order, taken together as long as they do not outnumber the history: a
    backlog is worked off in few steps, a single new batch is one step."""
    out, past, waiting = [], 0, 0
    for name, rows in sorted(batches):
        if out and waiting and waiting + rows <= past:
            out[-1].append(name)
            waiting += rows
        else:
            out.append([name])
            past, waiting = past + waiting, rows
    return out


def reject_repeats(df: DataFrame, key: str, batch: str, title: str, content: str, share: int = 8, of: int = 10, size: int = 5, least: int = 10) -> DataFrame:
    """(key): the rows rejected when the batches arrive in order of ``batch``, rows in order of ``key``.

    A row is rejected if its similarity to a row accepted before is at least ``share / of``. NULL texts
    count as empty; rows with fewer than ``least`` distinct runs are always accepted and reject none;
    rows whose batch is NULL form a batch before all others. An empty table gives no rows.
    """
    spark = df.sparkSession
    if least * share < COMMON * of:
        raise ValueError("sets that small share too few tokens")
    source = ensure_spread(df.select(key, batch, title, content)).withColumn(batch, F.concat(F.lit("b"), F.coalesce(F.col(batch), F.lit(""))))
    sets = staged(shingle_sets(source, key, title, content, keep=[batch], size=size, least=least).withColumnsRenamed({key: "record", batch: "batch"}), "p6-sets")
    sizes = sorted((r[0], r[1]) for r in sets.groupBy("batch").count().collect())  # one short row for each batch
    if not sizes:
        return df.select(key).limit(0)
    numbers = spark.createDataFrame([(name, i) for i, (name, _) in enumerate(sizes)], "batch string, no int")
    sets = sets.join(F.broadcast(numbers), "batch").drop("batch").withColumnRenamed("no", "batch")
    index, out, first = HistoryIndex(spark, stage_path(spark, "p6-index"), share, of), None, 0
    for arrival in arrivals(sizes):
        end = first + len(arrival)
        gone = index.accept(sets.where(F.col("batch").between(first, end - 1)), first)
        out, first = gone if out is None else out.union(gone), end
    out = staged(out, "p6-out")
    index.close()
    return out.withColumnRenamed("record", key).withColumn(key, F.col(key).cast(dict(df.dtypes)[key]))
