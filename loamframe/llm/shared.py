"""Scratch space and small helpers used by every operator in this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that fix how a scan is cut into partitions, so that two passes over the
#: same files see the same blocks however many executors there are, and keep batches small.
PINNED = {
    "spark.sql.files.minPartitionNum": "1",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}

#: What modules keep in a worker from task to task, for :func:`give_back`.
CACHES: list[dict] = []


def give_back(caches: bool = False) -> None:
    """Return memory that a worker has freed to the system; with ``caches``, drop :data:`CACHES` first.

    Workers are used again by the next operator's tasks, which need the room.
    """
    import pyarrow as pa

    if caches:
        for c in CACHES:
            c.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs on one machine a temporary one is
    chosen; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts lineage."""
    path = scratch(df.sparkSession, name)
    with drop_shuffles(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(spark: SparkSession, *paths: str | DataFrame) -> None:
    """Remove scratch paths, or what :func:`materialise` wrote, through Spark's own file systems."""
    for x in paths:
        path = x if isinstance(x, str) else getattr(x, "scratch_path", None)
        if path:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Hold session settings inside a block and put back what was set before."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def pinned(spark: SparkSession):  # noqa: ANN201
    """Hold :data:`PINNED` for the passes inside, which must not leave lazy scans behind."""
    return settings(spark, PINNED)


def drop_shuffles(spark: SparkSession):  # noqa: ANN201
    """Remove the shuffle files of each query inside when it ends, for results that are written and never planned again."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def open_fs(uri: str):
    """(file system, path) for a shared path, usable inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _plain(node) -> bool:  # noqa: ANN001
    """Whether a plan only reads Parquet files, with deterministic filters and projections."""
    kind = node.nodeName()
    if kind in ("Project", "Filter"):
        children = node.children()
        return node.deterministic() and all(_plain(children.apply(i)) for i in range(children.length()))
    return kind.startswith(("LogicalRelation", "Relation")) and "parquet" in node.toString()


def stable(docs: DataFrame) -> DataFrame:
    """``docs`` as a plain scan of files, which finds the same rows each time.

    Any other plan (one that shuffles, draws random numbers or runs Python, say) is
    written to the shared folder first.
    """
    return docs if _plain(docs._jdf.queryExecution().optimizedPlan()) else materialise(docs, "docs")


def numbered(docs: DataFrame) -> DataFrame:
    """Rows of a :func:`stable` scan with ``rid``, their place in it, which a second :func:`pinned` pass finds again."""
    return docs.withColumn("rid", F.monotonically_increasing_id())


def place() -> Column:
    """A row's file and its place there; the same however a :func:`stable` scan is cut."""
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a :func:`stable` scan whose :func:`place` is not in ``gone``, with all their columns."""
    free = next(f"place{i}" for i in range(len(docs.columns) + 1) if f"place{i}" not in {c.lower() for c in docs.columns})
    return docs.withColumn(free, place()).join(gone.select(F.col("place").alias(free)), free, "left_anti").drop(free)


#: A key that holds more than one in so many rows, and more than so many, is split by :func:`salted_join`.
SPREAD, FEW = 1000, 10_000


def salted_join(rows: DataFrame, keyed: DataFrame, on: list[str], other: list[str], total: int, how: str = "inner", counted: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``keyed`` on ``on``, hot keys dealt to many tasks.

    ``total`` is the number of ``rows``.  Fewer than :data:`SPREAD` keys can hold
    more than ``total / SPREAD`` rows each; these keys, and how many parts they are
    cut into, are broadcast.  Their rows are dealt by the hash of ``other``, and
    what ``keyed`` has for them is repeated once a part, less than ``2 * SPREAD``
    times in all.  Keys are counted in ``counted`` if that is cheaper to read than
    ``rows``, whose keys it must hold at least as often.
    """
    if total <= FEW:  # no key can hold more
        return rows.join(keyed, on, how)
    parts = F.ceil(F.count(F.lit(1)) * SPREAD / F.lit(max(total, 1))).cast("int")
    hot = (rows if counted is None else counted).groupBy(*on).agg(parts.alias("_parts")).where("_parts > 1")
    salt = F.pmod(F.xxhash64(*other), F.coalesce("_parts", F.lit(1))).cast("int")
    left = rows.join(F.broadcast(hot), on, "left").withColumn("_salt", salt).drop("_parts")
    right = keyed.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
