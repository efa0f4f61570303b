"""Session helpers: the shared staging folder, staged tables and salted joins.

Whatever must survive the loss of an executor is written as Parquet below the folder that the
session names in ``spark.checkpoint.dir``; only where that is unset (tests, a laptop) a local
folder is made.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def session(cores: int | str = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sieveline")
        .config("spark.sql.shuffle.partitions", shuffle)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once a session, so that Python workers can
    import them wherever they run; Spark's file server copies them, no shared folder is needed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="sieveline-ship-")) / "sieveline_modules.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent).as_posix())
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def staging_root(spark: SparkSession) -> str:
    """The session's shared folder; a local one is set only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.sparkContext.setCheckpointDir(_LOCAL[app])
    return _LOCAL[app]


def stage_path(spark: SparkSession, name: str) -> str:
    return os.path.join(staging_root(spark), "staged", f"{name}-{uuid.uuid4().hex[:12]}")


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table: lineage ends there,
    so no later task has to recompute it and a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def drop_staged(spark: SparkSession) -> None:
    """Remove everything staged by this engine; call it when no lazy result is in use any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staging_root(spark) + "/staged")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], salts: int = 8, how: str = "inner") -> DataFrame:
    """Equi-join whose left side may hold a third of its rows under one key.

    Left rows are spread over ``salts`` sub-keys by a hash of the whole row, so that a retried
    task places them alike; each right row (a few per key) is repeated once per sub-key.
    """
    salt = "__salt"
    hashable = [c for c, kind in left.dtypes if not kind.startswith(("map", "variant"))]
    spread = left.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.lit(salts)).cast("int"))
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*keys, salt], how).drop(salt)


def numbered_by(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with ``name`` = 1, 2, 3, ... in the order of the unique column ``order``. Rows are sorted by ranges and
    numbered within each; the ranges' sizes, one row for each, give the numbers they start from."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = staged(df.repartitionByRange(n, order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = {r["__range"]: r["count"] for r in parts.groupBy("__range").count().collect()}
    starts, at = [], 0
    for r in sorted(sizes):
        starts.append((r, at))
        at += sizes[r]
    begins = spark.createDataFrame(starts, "__range int, __start bigint")
    rank = F.row_number().over(Window.partitionBy("__range").orderBy(order))
    return parts.join(F.broadcast(begins), "__range").withColumn(name, F.col("__start") + rank).drop("__range", "__start")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_spread(df: DataFrame) -> DataFrame:
    """Spread rows over the default parallelism when the scan gives fewer partitions (small files)."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
