"""Problem 8: filling containers of fixed capacity by shortest-pack-first over the length histogram.

Only the histogram of lengths, at most one count for each length up to the capacity, reaches the
driver. Lengths are placed longest first, each into the packing pattern with the most room left that
it fits, and many equal packs move at once: taking ``c`` items of one length onto a pattern that
stands ``m`` times splits the pattern into two counts. Patterns become ranges of container numbers,
items get a rank within their length, and the two are joined by rank range.
"""

from __future__ import annotations

from bisect import insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.plans.runtime import staged


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, count) of every packing pattern for the counts of lengths 1..capacity."""
    open_packs: dict[int, list[list]] = defaultdict(list)  # room left -> [pattern, count]
    rooms: list[int] = []  # rooms in use, ascending

    def put(room: int, pattern: tuple[int, ...], count: int) -> None:
        if not open_packs[room]:
            insort(rooms, room)
        open_packs[room].append([pattern, count])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                put(capacity - length, (length,), left)  # a fresh pack each; shorter lengths fill its room
                break
            room = rooms[-1]
            pattern, count = open_packs[room].pop()
            if not open_packs[room]:
                rooms.pop()
            taken = min(left, count)
            if taken < count:
                put(room, pattern, count - taken)
            put(room - length, (*pattern, length), taken)
            left -= taken
    return [(p, c) for packs in open_packs.values() for p, c in packs]


def pack(items: DataFrame, key: str, size: str, capacity: int = 2048) -> DataFrame:
    """(key, piece_no, n_tokens, container_id): one row for each item, or piece of an item longer
    than ``capacity``, which is cut into full pieces and a rest.

    Items of size 0 or NULL need no room and go to container 1 with n_tokens 0; repeated rows are items
    of their own; ties of equal length are ranked by key; an empty table gives no rows.
    """
    spark = items.sparkSession
    n = F.coalesce(F.col("__n"), F.lit(0))
    whole = items.select(F.col(key).alias("__key"), F.col(size).cast("bigint").alias("__n"))
    cut = whole.select(
        "__key",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / capacity), F.lit(0))), lambda i: F.greatest(F.least(n - i * capacity, F.lit(capacity)), F.lit(0)))).alias("piece_no", "n_tokens"),
    )
    # a spread sub-key keeps a length that holds a third of all items from landing in one task
    pieces = staged(cut.withColumn("slot", F.pmod(F.xxhash64("__key", "piece_no"), F.lit(128)).cast("int")), "p8-pieces")
    counts = pieces.where("n_tokens > 0").groupBy("n_tokens", "slot").count()
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("n_tokens").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)))
    histogram = {r["n_tokens"]: r["n"] for r in counts.groupBy("n_tokens").agg(F.sum("count").alias("n")).collect()}  # at most `capacity` rows

    ranges, base, used = [], 0, defaultdict(int)
    for pattern, count in shortest_pack_first(histogram, capacity):
        for length in pattern:
            ranges.append((length, used[length], used[length] + count, base - used[length]))
            used[length] += count
        base += count
    # its size is bound by the capacity: a step of the packing adds two patterns at most
    starts = spark.createDataFrame(ranges, "n_tokens bigint, first bigint, last bigint, shift bigint")
    by_length = starts.groupBy("n_tokens").agg(F.sort_array(F.collect_list(F.struct("first", "last", "shift"))).alias("ranges"))

    rank = F.row_number().over(Window.partitionBy("n_tokens", "slot").orderBy("__key", "piece_no")) - 1 + F.coalesce("before", F.lit(0))
    ranked = pieces.where("n_tokens > 0").join(before.select("n_tokens", "slot", "before"), ["n_tokens", "slot"]).withColumn("rank", rank)
    placed = ranked.join(F.broadcast(by_length), "n_tokens").select(
        "__key",
        "piece_no",
        "n_tokens",
        (F.col("rank") + F.element_at(F.filter("ranges", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["last"])), 1)["shift"] + 1).alias("container_id"),
    )
    nothing = pieces.where("n_tokens = 0").select("__key", "piece_no", "n_tokens", F.lit(1).cast("bigint").alias("container_id"))
    return placed.union(nothing).withColumnRenamed("__key", key)
