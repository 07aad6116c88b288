"""Status counters over artifacts, for tables and for streams alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamframe.operators.samples import progress_of


def stage_status(artifacts: DataFrame) -> DataFrame:
    """Artifacts and their mean size per stage; works on a stream in update or complete mode."""
    return artifacts.groupBy("stage").agg(F.count(F.lit(1)).alias("completed"), F.round(F.avg("size"), 4).alias("mean_size"))


def stage_files(spark: SparkSession, directory: str, stage: str, pattern: str) -> DataFrame:
    """A stream of the artifacts of a stage as they appear in a folder: ``stage``, ``file``, ``size``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(directory)
    return files.select(F.lit(stage).alias("stage"), F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"))


def progress_stream(artifacts: DataFrame, samples: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, halved: tuple[str, ...] = (), trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that hands the sink the progress of all stages after each batch."""

    def each(counted: DataFrame, batch: int) -> None:
        sink(progress_of(counted, samples, halved), batch)

    counts = artifacts.groupBy("stage").agg(F.count(F.lit(1)).alias("artifacts"))
    return counts.writeStream.outputMode("complete").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
