"""Exact duplicates by a Golomb-coded exchange of fingerprints.

Each scan partition sends its distinct 64-bit fingerprints, sorted and
Golomb-Rice coded, to the owners of their ranges.  An owner answers every
sender with a bitmap: which of its fingerprints are also held elsewhere.
Fingerprints marked there, or held twice by one sender, are suspects; only the
suspects' texts are shuffled, already grouped before the shuffle, and compared
byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.llm import golomb
from loamframe.llm.shared import discard, materialise, partitions, place, salted_join, stable, text_or_empty, without

#: Bounds of the log2 of the bits in the suspect filter that scans consult: 8 to 128 MB.
FEWEST_BITS, MOST_BITS = 26, 30


def _owners(fps: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each fingerprint: equal ranges of the unsigned order."""
    return ((fps >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def suspects(prints: DataFrame, owners: int) -> DataFrame:
    """Fingerprints held by two rows or more.

    ``prints`` has ``block`` (the sender) and ``fp``; the result has ``fp``, once
    for every sender that holds it.
    """

    def send(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        held = np.unique(table.column("fp").to_numpy().view(np.uint64))
        own = _owners(held, owners)
        ids, at = np.unique(own, return_index=True)
        parts = np.split(held, at[1:])
        return pa.table({"owner": pa.array(ids, pa.int64()), "block": pa.array([block] * len(ids), pa.int32()), "keys": pa.array([golomb.encode(p) for p in parts], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        held = [golomb.decode(x.as_py()) for x in table.column("keys")]
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        twice = values[counts > 1]
        marks = [np.packbits(np.isin(h, twice, assume_unique=True)).tobytes() for h in held]
        return pa.table({"owner": table.column("owner"), "block": table.column("block"), "marks": pa.array(marks, pa.binary())})

    def settle(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        fps = left.column("fp").to_numpy().view(np.uint64)
        held, counts = np.unique(fps, return_counts=True)
        own = _owners(held, owners)
        marks = {o.as_py(): m.as_py() for o, m in zip(right.column("owner"), right.column("marks"), strict=True)}
        _, sizes = np.unique(own, return_counts=True)
        bits = [np.unpackbits(np.frombuffer(marks[o], np.uint8))[:n] for o, n in zip(np.unique(own).tolist(), sizes.tolist(), strict=True)]
        twice = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        return pa.table({"fp": pa.array(held[twice | (counts > 1)].view(np.int64))})

    sent = prints.groupBy("block").applyInArrow(send, "owner long, block int, keys binary")
    answers = sent.groupBy("owner").applyInArrow(answer, "owner long, block int, marks binary")
    return prints.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(settle, "fp long")


def filter_bits(n: int) -> int:
    """log2 of the bits for ``n`` suspects, about 16 a suspect; beyond the bound more unique texts are shuffled, no less is found."""
    return min(MOST_BITS, max(FEWEST_BITS, (16 * n).bit_length()))


def bit_filter(fps: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2**bits`` bits with the bit of each fingerprint set."""
    size = 1 << bits
    parts = 64

    def mark(table: pa.Table) -> pa.Table:
        slots = table.column("slot").to_numpy()
        part = int(slots[0]) // (size // parts)
        m = np.zeros(size // parts, dtype=bool)
        m[slots - part * (size // parts)] = True
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(m).tobytes()], pa.binary())})

    slots = fps.select(F.pmod("fp", F.lit(size)).alias("slot")).distinct()
    rows = slots.groupBy(F.floor(F.col("slot") / (size // parts))).applyInArrow(mark, "part int, bits binary").collect()
    out = np.zeros(size // 8, np.uint8)
    for r in rows:
        out[r.part * (size // parts // 8) : (r.part + 1) * (size // parts // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One decision per row of ``docs`` (``doc_id``, ``text``).

    Returns ``place`` (the row's file and its place there), ``doc_id``, ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256``.  Texts, however long, are equal
    when their bytes are; null counts as empty.  The row with the largest
    ``doc_id`` stays; a null ``doc_id`` ranks below all others, and of repeated rows
    with that id one stays.  An empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    docs = stable(docs)
    owners = max(partitions(spark), docs.rdd.getNumPartitions())
    rows = docs.select(place().alias("place"), "doc_id", text_or_empty().alias("text"))
    table = materialise(rows.select("place", "doc_id", F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("sha"), F.spark_partition_id().alias("block")), "prints")
    found = materialise(suspects(table.select("block", "fp"), owners).distinct(), "suspects")
    bits = filter_bits(found.count())
    shared = spark.sparkContext.broadcast(bit_filter(found, bits))

    @F.pandas_udf(T.BooleanType())
    def may_be_suspect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        marks = shared.value
        for fp in batches:
            slot = fp.to_numpy() & ((1 << bits) - 1)
            yield pd.Series((marks[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1)

    texts = rows.select(F.xxhash64("text").alias("fp"), "text").where(may_be_suspect("fp"))
    same = texts.groupBy("fp", "text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same = materialise(same.select("fp", F.sha2("text", 256).alias("sha")), "verified")
    discard(spark, found)
    marked = materialise(table.where(may_be_suspect("fp")), "marked")
    total = marked.count()
    top = F.max(F.struct(F.col("doc_id"), F.col("place").alias("best"))).alias("top")
    best = marked.groupBy("fp", "sha").agg(top, F.count(F.lit(1)).alias("n")).join(same, ["fp", "sha"])
    decided = salted_join(marked, best, ["fp", "sha"], ["place"], total, "left").select("place", "doc_id", "sha", "top", "n")
    alone = table.where(~may_be_suspect("fp")).select("place", "doc_id", "sha", F.lit(None).cast(decided.schema["top"].dataType).alias("top"), F.lit(1).cast("long").alias("n"))
    return decided.unionByName(alone).select(
        "place", "doc_id",
        F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (F.col("top").isNull() | (F.col("place") == F.col("top.best"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Null, empty and long texts, repeated rows, null ids and empty tables as in
    :func:`exact_duplicates`.
    """
    docs = stable(docs)
    return without(docs, materialise(exact_duplicates(docs).where("not kept").select("place"), "gone"))
