"""Pairs of the rows under one key, where a key may hold very many of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.runtime import staged


def pairs_within(df: DataFrame, keys: list[str], item: str, keep: list[str] | None = None, block: int = 512) -> DataFrame:
    """(a, b, a_x, b_x for each x of ``keep``): every two rows of ``df`` under equal ``keys`` with item a < b.

    Keys that one row holds are dropped first. The rows of a key are cut into blocks of about ``block`` by a hash of
    their item, and every two blocks meet under a key of their own, so no task gets all rows of a hot key. A pair
    comes once for each key it shares.
    """
    keep = keep or []
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1")
    sized = staged(df.join(counts, keys).withColumn("__blocks", F.ceil(F.col("__n") / block).cast("int")).drop("__n"), "shared-keys")
    placed = sized.withColumn("__x", F.pmod(F.xxhash64(item), F.col("__blocks")).cast("int")).withColumn("__y", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    cells = placed.select(*keys, item, *keep, "__x", F.least("__x", "__y").alias("__u"), F.greatest("__x", "__y").alias("__v"))

    def side(name: str) -> DataFrame:
        return cells.select(*keys, "__u", "__v", F.col("__x").alias(f"__{name}"), F.col(item).alias(name), *[F.col(c).alias(f"{name}_{c}") for c in keep])

    met = side("a").join(side("b"), [*keys, "__u", "__v"])
    # rows of one block meet in its own cell only
    met = met.where((F.col("a") < F.col("b")) & ((F.col("__a") != F.col("__b")) | (F.col("__u") == F.col("__v"))))
    return met.select("a", "b", *[f"{s}_{c}" for s in "ab" for c in keep])
