"""Read classification on a stream of FASTQ files.

Each micro-batch is classified as a batch (a read's hits never leave it) and its
rows are written to a folder of their own, so a batch that is run again replaces
itself.  Running totals are a second stream over what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from loamframe.functions.names import fastq_sample
from loamframe.operators import reads as R
from loamframe.operators import taxonomy as T

#: What a micro-batch writes.
CLASSIFIED = "sample string, read_id string, length int, hit_count long, tax_id int"


def classify_batch(rows: DataFrame, index: DataFrame, paths: DataFrame, paired: bool = False, **options: int) -> DataFrame:
    """Reads of FASTQ rows (``file``, ``pos``, ``read_id``, ``seq``) with ``sample`` and ``tax_id``.

    With ``paired`` a row has the second mate in ``seq2``; the mates' taxa meet and
    lengths add up.  A read is told apart by its file and place in it.  A row without
    ``read_id`` ends a file and stays, without a taxon.
    """
    sample = fastq_sample(F.col("file"), paired)
    ends = rows.where("read_id is null").select(sample.alias("sample"), F.lit(None).cast("string").alias("read_id"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("hit_count"), F.lit(None).cast("int").alias("tax_id"))
    rows = rows.where("read_id is not null")
    mates = [("seq", 1), ("seq2", 2)] if paired else [("seq", 1)]
    key = lambda m: F.struct(F.col("file"), F.col("pos"), F.lit(m).alias("mate"), sample.alias("sample"), F.col("read_id").alias("name"))
    each = rows.select(F.inline(F.array(*[F.struct(key(m).alias("read_id"), F.col(c).alias("seq")) for c, m in mates])))
    called = R.classify(each, index, paths, **options)
    flat = called.select(F.col("read_id.sample").alias("sample"), F.struct("read_id.file", "read_id.pos", "read_id.name").alias("read_id"), F.col("read_id.mate").alias("mate"), "path", "length", "hit_count")
    if paired:
        hits = flat.groupBy("sample", "read_id").agg(F.sum("hit_count").alias("hit_count"))
        done = T.merge_pairs(flat).join(hits, ["sample", "read_id"])
    else:
        done = flat.withColumn("tax_id", F.try_element_at("path", F.lit(-1)))
    called = done.select("sample", F.col("read_id.name").alias("read_id"), F.col("length").cast("int").alias("length"), F.col("hit_count").cast("long").alias("hit_count"), F.col("tax_id").cast("int").alias("tax_id"))
    return called.unionByName(ends)


def classify_stream(stream: DataFrame, index: DataFrame, paths: DataFrame, output: str, checkpoint: str, paired: bool = False, trigger: dict | None = None, **options: int) -> StreamingQuery:
    """Start classifying a stream of FASTQ rows into Parquet folders below ``output``, one a batch."""

    def each(rows: DataFrame, batch: int) -> None:
        held = rows.persist()  # a batch is looked at more than once and must not be read again
        classify_batch(held, index, paths, paired, **options).write.mode("overwrite").parquet(f"{output}/batch={batch}")
        held.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def running_counts(classified: DataFrame) -> DataFrame:
    """Reads of every sample and taxon, for a table or, in update or complete mode, a stream of classified reads."""
    reads = classified.where("read_id is not null") if "read_id" in classified.columns else classified
    return reads.groupBy("sample", "tax_id").agg(F.count(F.lit(1)).alias("direct_reads"))


def report_stream(classified: DataFrame, paths: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that hands the sink the whole clade report of all samples so far after each batch."""

    def each(rows: DataFrame, batch: int) -> None:
        sink(T.clade_report(rows, paths), batch)

    counts = running_counts(classified)
    return counts.writeStream.outputMode("complete").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


#: What the state of a sample gives when it ends.
FINISHED = "sample string, tax_id int, direct_reads long"


class SampleState(StatefulProcessor):
    """Reads of each taxon of one sample, given out once, when its last file has ended."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reads = handle.getMapState("reads", "tax_id int", "n long")
        self.ended = handle.getValueState("ended", "files long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802
        ended = self.ended.get()[0] if self.ended.exists() else 0
        wanted = 1
        for part in rows:
            ended += int(part["ended"].sum())
            wanted = int(part["files"].iloc[0])
            for tax, n in part.groupby("tax_id", dropna=False)["reads"].sum().items():
                at = (-1 if pd.isna(tax) else int(tax),)  # a key of state is never null
                before = self.reads.getValue(at)[0] if self.reads.containsKey(at) else 0
                self.reads.updateValue(at, (before + int(n),))
        if ended < wanted:
            self.ended.update((ended,))
            return
        counts = [(k[0], v[0]) for k, v in self.reads.iterator() if v[0]]
        self.reads.clear()
        self.ended.clear()
        # a sample without a read is told by a row of no reads
        taxa = pd.array([None if t < 0 else t for t, _ in counts] or [None], "Int32")
        yield pd.DataFrame({"sample": key[0], "tax_id": taxa, "direct_reads": [n for _, n in counts] or [0]})

    def close(self) -> None:
        """Nothing is held outside the state."""


def finished_samples(classified: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """A stream of ``sample``, ``tax_id`` and ``direct_reads`` of each sample, once it has ended.

    ``classified`` is a stream of classified reads with rows that end files.  A sample
    ends with its last file; ``files`` (``sample``, ``files``) says how many it has,
    else one.  A sample without reads has one row of 0 reads.  Only samples that have
    not ended are held.
    """
    rows = classified.withColumn("ended", F.col("read_id").isNull().cast("int")).withColumn("reads", F.col("read_id").isNotNull().cast("long"))
    rows = rows.select("sample", "tax_id", "reads", "ended")
    known = rows.withColumn("files", F.lit(1).cast("long")) if files is None else rows.join(files.select("sample", F.col("files").cast("long").alias("files")), "sample", "left").fillna(1, ["files"])
    return known.groupBy("sample").transformWithStateInPandas(SampleState(), FINISHED, "Append", "None")


def sample_report_stream(classified: DataFrame, paths: DataFrame, output: str, checkpoint: str, files: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that writes the clade report of each sample once, below ``output``, when the sample has ended.

    The session needs the RocksDB state store.  A batch that is run again replaces its own folder.
    """

    def each(rows: DataFrame, batch: int) -> None:
        held = rows.persist()
        if held.head(1):
            T.clade_report(held, paths).write.mode("overwrite").parquet(f"{output}/batch={batch}")
        held.unpersist()

    return finished_samples(classified, files).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
