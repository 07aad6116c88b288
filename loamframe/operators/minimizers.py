"""Minimizers of sequences, and a stored index of them that is joined without moving it.

Bases are two bits each.  A batch of sequences is one array: the numbers of all l-mers
come from joining halves, least numbers of windows from doubling, so a window costs a
few vector operations however long it is.  Runs of equal minimizers are one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

#: Two bits of each base; every other letter counts as A (fixed values).
_CODE = np.zeros(256, np.uint64)
for _i, _pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
    _CODE[[ord(c) for c in _pair]] = _i
#: Letters of a batch that are worked on at once.
SLICE = 1 << 18


def _joined(codes: np.ndarray, l: int, forward: bool) -> np.ndarray:
    """The number of the ``l`` codes from each place on, the first one highest if ``forward``, else lowest."""
    out: np.ndarray | None = None
    done, power, size = 0, codes, 1
    while True:
        if l & size:
            if out is None:
                out, done = power, size
            else:
                n = min(len(out) - size, len(power)) if len(out) > size else 0
                a, b = power[:n], out[size : size + n]  # ``size`` codes, then the ``done`` ones
                n = min(len(a), len(b))
                out = (a[:n] << np.uint64(2 * done)) | b[:n] if forward else a[:n] | (b[:n] << np.uint64(2 * size))
                done += size
        if done == l:
            return out
        n = max(0, len(power) - size)
        a, b = power[:n], power[size : size + n]
        power = (a << np.uint64(2 * size)) | b if forward else a | (b << np.uint64(2 * size))
        size *= 2


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` numbers from each place on."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def minimizers_of(codes: np.ndarray, k: int, l: int, toggle: int, spaced: int) -> np.ndarray:
    """The minimizer of each k-window of an array of codes."""
    if len(codes) < k:
        return np.zeros(0, np.int64)
    ahead = _joined(codes, l, True)
    back = _joined(np.uint64(3) - codes, l, False)
    least = np.minimum(ahead, back)
    if spaced:
        least = least & np.uint64(spaced)
    return (_least(least ^ np.uint64(toggle), k - l + 1) ^ np.uint64(toggle)).astype(np.int64)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows of about :data:`SLICE` letters; a longer row is alone."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE, "right")))
        yield i, j
        i = j


def _runs(k: int, l: int, toggle: int, spaced: int, length: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq = pc.fill_null(batch.column(1), "")
            sizes = np.minimum(pc.utf8_length(seq).to_numpy(zero_copy_only=False).astype(np.int64), 1 << 62 if length is None else length)
            for i, j in _slices(sizes):
                rows = [s[:length].encode("latin-1", "replace") for s in seq.slice(i, j - i).to_pylist()]
                found = minimizers_of(_CODE[np.frombuffer(b"".join(rows), np.uint8)], k, l, toggle, spaced)
                row = np.repeat(np.arange(i, j), sizes[i:j])[: len(found)]
                first = np.cumsum(sizes[i:j]) - sizes[i:j]
                pos = np.arange(len(found)) - first[row - i]
                inside = pos <= sizes[row] - k  # windows across two rows are none
                row, pos, found = row[inside], pos[inside], found[inside]
                new = np.ones(len(found), bool)
                new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(found)))
                columns = [batch.column(0).take(pa.array(row[at])), pa.array(pos[at], pa.int32()), pa.array(times, pa.int32()), pa.array(found[at], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [batch.schema.names[0], "pos", "times", "minimizer"])

    return runs


def minimizer_runs(reads: DataFrame, key: str, k: int = 35, l: int = 31, toggle: int = 0, spaced: int = 0, length: int | None = 256) -> DataFrame:
    """``key``, ``pos``, ``times`` and ``minimizer``: where a run of windows with one minimizer begins and how many there are.

    The minimizer of a k-window of ``seq`` is the l-mer that is least after XOR with
    ``toggle``; an l-mer counts as the lesser of itself and its reverse complement,
    masked with ``spaced`` unless that is 0.  Letters but A, C, G and T count as A; at
    most ``length`` letters count; null and sequences shorter than k give none.
    """
    if not 0 < l <= min(k, 31):
        raise ValueError("l-mers have 1 to 31 letters, and no more than windows")
    kind = reads.select(key).schema.fields[0]
    schema = StructType([kind, StructField("pos", IntegerType()), StructField("times", IntegerType()), StructField("minimizer", LongType())])
    seq = F.col("seq") if length is None else F.substring("seq", 1, length)  # what does not count stays out of Python
    return reads.select(key, seq.alias("seq")).mapInArrow(_runs(k, l, toggle, spaced, length), schema)


def write_index(index: DataFrame, table: str, buckets: int | None = None) -> None:
    """Store an index (``minimizer``, ``tax_id``) as a table in buckets of ``minimizer``, each sorted by it.

    With as many ``buckets`` as the jobs that read it have shuffle partitions, or
    more, only reads move in a look-up.
    """
    n = buckets or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one task a bucket, so a bucket is one file
    index.select("minimizer", "tax_id").repartition(n, "minimizer").write.mode("overwrite").bucketBy(n, "minimizer").sortBy("minimizer").saveAsTable(table)


def read_index(spark: SparkSession, table: str) -> DataFrame:
    """An index that :func:`write_index` stored."""
    return spark.table(table)


#: A minimizer with more than one in so many of the sampled rows is looked up apart.
SHARE = 1000


def hot_minimizers(found: DataFrame, index: DataFrame, share: int = SHARE) -> DataFrame:
    """``minimizer`` and ``tax_id`` (null: not in the index) of minimizers of more than one in ``share`` rows of ``found``, so of fewer than ``share``.

    ``found`` may be of a sample of reads: what is hot decides how rows are dealt, not what they give.
    """
    total = found.agg(F.count(F.lit(1))).scalar()
    many = found.groupBy("minimizer").agg(F.count(F.lit(1)).alias("k")).where((F.col("k") * share > total) & (F.col("k") > 1)).select("minimizer")
    return index.join(F.broadcast(many), "minimizer", "right").select("minimizer", "tax_id")


def look_up(found: DataFrame, index: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Runs with the index's ``tax_id``; those it lacks are left out.

    Rows of ``hot`` minimizers get their taxon from that small table, which is
    broadcast, and are dealt evenly; all others meet the index where it lies.
    """
    if hot is None:
        return found.join(index, "minimizer")
    small = F.broadcast(hot.select("minimizer", F.col("tax_id").alias("_hot"), F.lit(True).alias("_is_hot")))
    # numbers of l-mers are never negative, so a negative one meets nothing
    away = -1 - F.shiftright(F.abs(F.shiftright(F.xxhash64(key, "pos"), 1)), 1)
    keyed = found.join(small, "minimizer", "left").withColumn("_key", F.when(F.col("_is_hot"), away).otherwise(F.col("minimizer")))
    held = index.select(F.col("minimizer").alias("_at"), "tax_id")
    met = keyed.join(held, F.col("_key") == F.col("_at"), "left").withColumn("tax_id", F.coalesce("tax_id", "_hot"))
    return met.where("tax_id is not null").drop("_key", "_at", "_hot", "_is_hot")
