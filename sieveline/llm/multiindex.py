"""Problem 3: the most similar vectors of every vector, by an inverted multi-index.

Each vector is cut into halves, and each half is quantised to ``K`` centroids of its own, so the
vectors fall into ``K * K`` cells. A query orders the centroids of either half by distance and walks the
cells in order of the summed distance with a heap until they hold enough entries; those are reranked by
their exact cosine.

Spread over a cluster: only the count of every cell (at most ``K * K`` numbers) reaches the driver, which
cuts the cells into regions of neighbours, of bounded size. Vectors are keyed by region, queries go to the regions
their cells lie in with the list of those cells, and each region's task multiplies matrices cell by cell.
A region of a single cell with more entries than a block holds is cut into blocks by a hash of the vector, one
with more queries than a block holds into blocks of queries, so no task grows with the data. Equal vectors are
indexed once and carry the smallest of their ids; equal queries are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.plans.runtime import ensure_spread, salted_join, staged


def valid_rows(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, float32 matrix) of the vectors of ``width`` values, none NaN or NULL, not all zero."""
    size = np.where(np.asarray(column.is_valid()), np.diff(column.offsets.to_numpy()), -1)
    rows = np.flatnonzero(size == width)
    if not len(rows):
        return rows, np.empty((0, width), np.float32)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    m = flat[column.offsets.to_numpy()[rows][:, None] + np.arange(width)] if len(rows) * width != len(flat) else flat.reshape(-1, width)
    good = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
    return rows[good], np.ascontiguousarray(m[good])


def packed(v: np.ndarray) -> bytes:
    """The bytes of a float32 vector, without loss: two a value where the lower halves are all zero, as in
    vectors stored with reduced precision, else four."""
    u = v.view(np.uint32)
    return v.tobytes() if (u & np.uint32(0xFFFF)).any() else (u >> np.uint32(16)).astype(np.uint16).tobytes()


def unpacked(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """The float32 matrix of a column of packed vectors."""
    rows = column.to_pylist()
    m = np.zeros((len(rows), width), np.uint32)
    short = np.array([len(r) == 2 * width for r in rows], bool)
    if short.any():
        m[short] = np.frombuffer(b"".join(r for r in rows if len(r) == 2 * width), np.uint16).reshape(-1, width).astype(np.uint32) << np.uint32(16)
    if not short.all():
        m[~short] = np.frombuffer(b"".join(r for r in rows if len(r) != 2 * width), np.uint32).reshape(-1, width)
    return m.view(np.float32)


def unit(m: np.ndarray) -> np.ndarray:
    x = m.astype(np.float32)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Lloyd's iterations from distinct sample rows; an empty centre keeps its place."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        label = nearest(x, centres)
        order = np.argsort(label, kind="stable")
        found, start = np.unique(label[order], return_index=True)
        sums = np.add.reduceat(x[order], start, axis=0)
        centres[found] = sums / np.diff([*start, len(x)])[:, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres**2).sum(axis=1)
    return np.concatenate([np.argmax(x[i : i + 8192] @ centres.T - half, axis=1) for i in range(0, max(len(x), 1), 8192)])


class Quantiser:
    """The centroids of both halves, the entries of every cell and the cells of every region."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.first = kmeans(sample[:, : self.half], k)
        self.second = kmeans(sample[:, self.half :], k)

    def cells(self, m: np.ndarray) -> np.ndarray:
        return nearest(m[:, : self.half], self.first) * len(self.second) + nearest(m[:, self.half :], self.second)

    def arrange(self, counts: dict[int, int], region_rows: int) -> None:
        """Cut the occupied cells into regions of ``region_rows`` entries at most, across the widest axis of their
        centroids again and again; only a region of a single cell may hold more."""
        cells = np.array(sorted(counts), np.int64)
        rows = np.array([counts[c] for c in cells.tolist()], np.int64)
        todo, self.region, regions = [np.arange(len(cells))] if len(cells) else [], {}, 0
        while todo:
            own = todo.pop()
            total = int(rows[own].sum())
            if total <= region_rows or len(own) == 1:
                self.region.update(dict.fromkeys(cells[own].tolist(), regions))
                regions += 1
                continue
            own = own[np.argsort(self.along(cells[own], rows[own]), kind="stable")]
            parts = -(-total // region_rows)
            cut = np.searchsorted(np.cumsum(rows[own]), total * (parts // 2) / parts)
            cut = int(np.clip(cut, 1, len(own) - 1))
            todo += [own[:cut], own[cut:]]
        self.counts = counts
        self.rows: dict[int, set[int]] = {}
        for c in counts:
            self.rows.setdefault(c // len(self.second), set()).add(c % len(self.second))

    def along(self, cells: np.ndarray, rows: np.ndarray, rounds: int = 20) -> np.ndarray:
        """Where the cells' centroids lie on the axis of their largest variance, by power iteration on the halves."""
        i, j = np.divmod(cells, len(self.second))
        rng = np.random.default_rng(7)
        a, b = rng.normal(size=self.first.shape[1]), rng.normal(size=self.second.shape[1])
        for _ in range(rounds):
            x = (self.first @ a)[i] + (self.second @ b)[j]
            x = (x - np.average(x, weights=rows)) * rows
            a, b = self.first.T @ np.bincount(i, x, len(self.first)), self.second.T @ np.bincount(j, x, len(self.second))
            norm = np.sqrt(a @ a + b @ b)
            if not norm:
                break
            a, b = a / norm, b / norm
        return (self.first @ a)[i] + (self.second @ b)[j]

    def walk(self, m: np.ndarray, enough: int) -> Iterator[list[int]]:
        """For every vector of ``m`` the occupied cells in order of summed distance until they hold
        ``enough`` entries. The heap holds the best open cell of each centroid of the first half that was met."""
        width, counts = len(self.second), self.counts
        for at in range(0, len(m), 1024):
            x = m[at : at + 1024]
            d1 = (self.first**2).sum(axis=1) - 2 * x[:, : self.half] @ self.first.T
            d2 = (self.second**2).sum(axis=1) - 2 * x[:, self.half :] @ self.second.T
            order = np.argsort(d2, axis=1)
            for a, b, o in zip(d1.tolist(), d2.tolist(), order.tolist(), strict=True):
                # a centroid of the first half enters with its least possible sum, unfolded when it is met
                nearest_second = b[o[0]]
                heap = [(a[i] + nearest_second, i, -1) for i in self.rows]
                heapify(heap)
                got, held = [], 0
                while heap and held < enough:
                    _, i, j = heappop(heap)
                    open_cells = self.rows[i]
                    if j >= 0:
                        cell = i * width + o[j]
                        got.append(cell)
                        held += counts[cell]
                    for p in range(j + 1, width):
                        if o[p] in open_cells:
                            heappush(heap, (a[i] + b[o[p]], i, p))
                            break
                yield got


def distinct_vectors(df: DataFrame, key: str, column: str, width: int, name: str) -> tuple[DataFrame, DataFrame]:
    """((key, h1, h2) of every row with a usable vector, (h1, h2, v) of every distinct one), staged.

    ``h1``/``h2`` are 128 bits over the vector's bytes. A partition repeats no vector that it met lately.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            rows, m = valid_rows(batch.column(1).cast(pa.list_(pa.float32())), width)
            if len(met) > 200_000:
                met.clear()
            digests, values = [], []
            for v in m:
                data = packed(v)
                d = xxhash.xxh128_digest(data)
                digests.append(d)
                values.append(None if d in met else data)
                met.add(d)
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(values, pa.binary())], names=[key, "h1", "h2", "v"])

    found = staged(ensure_spread(df.select(key, column)).mapInArrow(run, f"`{key}` {kind}, h1 bigint, h2 bigint, v binary"), name)
    return found.select(key, "h1", "h2"), found.where("v is not null").select("h1", "h2", "v").dropDuplicates(["h1", "h2"])


def nearest_vectors(
    queries: DataFrame,
    query_key: str,
    query_column: str,
    entries: DataFrame,
    entry_key: str,
    entry_column: str,
    k: int = 5,
    least: float = -1.0,
    width: int = 384,
    centroids: float = 0.45,
    sample_rows: int = 32_768,
    reach: float = 0.55,
    floor: int = 2000,
    block: int = 8192,
) -> DataFrame:
    """(query key, entry key, cosine): for every distinct query key its ``k`` most similar entries with
    a cosine of at least ``least``, rounded to six decimals; of equal ones the smaller entry key first.

    Vectors that are NULL, of another length, all zero, or hold NaN, infinite or NULL values take no
    part. Keys delivered twice count once; distinct entries may share a vector. Either table may be empty.
    Each half has ``centroids * sqrt(n)`` centroids for n distinct entries (16 to 1024), from a sample of
    about ``sample_rows`` of them; all entries are indexed. A query reranks ``reach * n ** 0.75`` entries, at
    least ``floor``.
    """
    spark: SparkSession = queries.sparkSession
    query_ids, query_vectors = distinct_vectors(queries, query_key, query_column, width, "p3-queries")
    entry_ids, entry_vectors = distinct_vectors(entries, entry_key, entry_column, width, "p3-entries")
    kinds = dict(queries.dtypes)[query_key], dict(entries.dtypes)[entry_key]
    # of equal vectors only the k smallest ids can be an answer
    smallest = Window.partitionBy("h1", "h2").orderBy(entry_key)
    few = entry_ids.distinct().withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k)
    carried = few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(entry_key)).alias("ids"))
    query_vectors = staged(query_vectors, "p3-asked")
    total = entry_vectors.select("h1").count()
    empty = spark.createDataFrame([], f"`{query_key}` {kinds[0]}, `{entry_key}` {kinds[1]}, cosine double")
    if not total:
        return empty
    # h1 is a hash: an even sample
    sample = entry_vectors.where(F.pmod("h1", F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_rows / total))).select("v").toArrow()
    if not sample.num_rows:  # chance may leave a handful of entries out
        sample = entry_vectors.select("v").limit(1).toArrow()
    quantiser = Quantiser(unit(unpacked(sample.column(0), width)), int(np.clip(centroids * np.sqrt(total), 16, 1024)))

    centres = spark.sparkContext.broadcast(quantiser)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = centres.value
        for batch in batches:
            m = unpacked(batch.column("v"), width)
            cell = quantiser.cells(unit(m)) if len(m) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

    placed = staged(entry_vectors.join(carried, ["h1", "h2"]).mapInArrow(place, f"h1 bigint, h2 bigint, v binary, ids array<{kinds[1]}>, cell int"), "p3-cells")
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # one small row for each occupied cell, 1024**2 at most
    # large regions: a query's vector goes once to each region that its cells lie in
    quantiser.arrange(counts, 4 * block)
    enough = max(floor, int(reach * total**0.75))
    sizes: dict[int, int] = {}
    for cell, region in quantiser.region.items():
        sizes[region] = sizes.get(region, 0) + counts[cell]
    blocks = {r: -(-n // (4 * block)) for r, n in sizes.items()}

    arranged = spark.sparkContext.broadcast(quantiser)  # one count and one region for each occupied cell

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = arranged.value
        for batch in batches:
            v = unpacked(batch.column("v"), width)
            rows, regions, cells = [], [], []
            for i, walked in enumerate(quantiser.walk(unit(v), enough) if len(v) else ()):
                by_region: dict[int, list[int]] = {}
                for c in walked:
                    by_region.setdefault(quantiser.region[c], []).append(c)
                for region, own in by_region.items():
                    rows.append(i)
                    regions.append(region)
                    cells.append(own)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("h1").take(at), batch.column("h2").take(at), pa.array(regions, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], names=["h1", "h2", "region", "cells"])

    # the routes are staged without the vectors, which join them only on their way to the regions
    sent = staged(query_vectors.mapInArrow(send, "h1 bigint, h2 bigint, region int, cells array<int>"), "p3-sent")
    asked = {r["region"]: r["count"] for r in sent.groupBy("region").count().collect()}  # one small row for each region
    query_blocks = {r: -(-n // (4 * block)) for r, n in asked.items()}
    # the layout of blocks is one small row for each region
    layout = spark.createDataFrame([(r, blocks[r], query_blocks.get(r, 1)) for r in blocks], "region int, entry_blocks int, query_blocks int")
    of_cell = spark.createDataFrame(list(quantiser.region.items()), "cell int, region int")
    entry_side = (
        placed.join(F.broadcast(of_cell), "cell")
        .join(F.broadcast(layout), "region")
        .withColumn("eb", F.pmod("h1", "entry_blocks").cast("int"))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("region", "eb", "qb", "v", "ids", "cell")
    )
    query_side = (
        sent.join(query_vectors, ["h1", "h2"])
        .join(F.broadcast(layout), "region")
        .withColumn("qb", F.pmod("h1", "query_blocks").cast("int"))
        .withColumn("eb", F.explode(F.sequence(F.lit(0), F.col("entry_blocks") - 1)))
        .select("region", "eb", "qb", "h1", "h2", "v", "cells")
    )

    ids_kind = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kinds[1]]
    none = pa.table({"h1": pa.array([], pa.int64()), "h2": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(ids_kind)), "cosine": pa.array([], pa.float64())})

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return none
        e, q = unpacked(left.column("v"), width), unpacked(right.column("v"), width)
        cell = left.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        eu, qu = unit(e[order]), unit(q) if len(q) else q
        held, start = np.unique(cell[order], return_index=True)
        span = {c: (s, t) for c, s, t in zip(held.tolist(), start.tolist(), [*start[1:].tolist(), len(order)], strict=True)}
        asking: dict[int, list[int]] = {}
        for i, cells in enumerate(right.column("cells").to_pylist()):
            for c in cells:
                if c in span:
                    asking.setdefault(c, []).append(i)
        hit_q, hit_e, hit_s = [], [], []
        for c, who in asking.items():
            s, t = span[c]
            step = 2048 if t - s <= block else 512  # scores of a large cell take no more memory
            for at in range(0, len(who), step):
                part = np.array(who[at : at + step])
                score = qu[part] @ eu[s:t].T
                if t - s > 2 * k:  # a float32 score that could still round into the k best is kept
                    edge = np.partition(score, t - s - k, axis=1)[:, t - s - k] - 2e-6
                    keep = score >= np.maximum(edge, least - 2e-6)[:, None]
                else:
                    keep = score >= least - 2e-6
                i, j = np.nonzero(keep)
                hit_q.append(part[i])
                hit_e.append(order[s + j])
                hit_s.append(score[i, j])
        i, j = (np.concatenate(hit_q), np.concatenate(hit_e)) if hit_q else (np.empty(0, int), np.empty(0, int))
        if len(i):
            s = np.concatenate(hit_s)
            by = np.lexsort((-s, i))
            i, j, s = i[by], j[by], s[by]
            first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            rank = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
            kth = np.full(len(q), -2.0)
            at_k = rank == k - 1
            kth[i[at_k]] = s[at_k]
            stay = s >= kth[i] - 4e-6
            i, j = i[stay], j[stay]
        a, b = q[i].astype(np.float64), e[j].astype(np.float64)
        cosine = np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
        cosine = np.round(cosine, 6)
        fine = cosine >= least
        i, j, cosine = i[fine], j[fine], cosine[fine]
        return pa.table({"h1": right.column("h1").take(pa.array(i)), "h2": right.column("h2").take(pa.array(i)), "ids": left.column("ids").take(pa.array(j)), "cosine": pa.array(cosine)})

    # a block of entries and a block of queries meet in a group of bounded size; with several partitions for each group
    # few groups share a task, however many there are
    groups = sum(blocks[r] * query_blocks.get(r, 1) for r in blocks)
    tasks = min(max(8 * groups, int(spark.conf.get("spark.sql.shuffle.partitions"))), 20_000)
    keys = ["region", "eb", "qb"]
    found = entry_side.repartition(tasks, *keys).groupBy(*keys).cogroup(query_side.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(rerank, f"h1 bigint, h2 bigint, ids array<{kinds[1]}>, cosine double")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("cosine"), entry_key)
    top = found.select("h1", "h2", F.explode("ids").alias(entry_key), "cosine").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
    answers = top.groupBy("h1", "h2").agg(F.collect_list(F.struct(entry_key, "cosine")).alias("hits"))
    # one query text may hold a third of all rows
    per_id = salted_join(query_ids.distinct(), staged(answers, "p3-answers"), ["h1", "h2"])
    return per_id.select(query_key, F.explode("hits").alias("hit")).select(query_key, f"hit.{entry_key}", "hit.cosine")
