"""Packing documents into fixed-length sequences as a cutting-stock problem.

Documents longer than a sequence are cut into full sequences and a rest.  The
lengths of all pieces form a histogram over a fixed number of bins.  A linear
program over patterns (what one sequence holds, by bin) is solved by column
generation: a knapsack dynamic program prices new patterns.  Patterns are used a
whole number of times, the rest is filled first-fit; pieces, ranked within
their bin, are assigned to the slots of the patterns.

Only the histogram and the patterns are on the driver, both bounded by the
number of bins; pieces are ranked and placed in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.llm.chunks import encoder
from loamframe.llm.shared import give_back, materialise, settings, text_or_empty

#: Tokens to a bin: a piece is planned as if rounded up to a multiple of this.
UNIT = 8
#: Pieces ranked together by one task, about.
RANK_GROUP = 20_000
#: Documents that a task reads at once.
BATCH = "500"
#: Stop when the linear program is proved this close to its optimum.
GAP = 1e-3


def _knapsack(values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best pattern for the dual values of bins 1..room."""
    best = np.zeros(room + 1)
    pick = np.zeros(room + 1, np.int64)
    sizes = np.arange(1, room + 1)
    for c in range(1, room + 1):
        v = best[c - sizes[:c]] + values[:c]
        k = int(np.argmax(v))
        if v[k] > best[c - 1]:
            best[c], pick[c] = v[k], k + 1
        else:
            best[c], pick[c] = best[c - 1], 0
    pattern, c = np.zeros(room, np.int64), room
    while c > 0:
        if pick[c]:
            pattern[pick[c] - 1] += 1
            c -= int(pick[c])
        else:
            c -= 1
    return float(best[room]), pattern


def solve_patterns(demand: np.ndarray, gap: float = GAP, rounds: int = 4000) -> list[tuple[np.ndarray, int]]:
    """[(pattern, times)] that together hold ``demand[b]`` pieces of ``b + 1`` units exactly.

    A pattern's units sum to at most ``len(demand)``.  The linear program starts
    from one pattern per bin and takes in the pattern the knapsack prices best.
    """
    room = len(demand)
    bins = np.flatnonzero(demand)
    left = demand.astype(np.int64).copy()
    plan: list[tuple[np.ndarray, int]] = []
    if len(bins):
        need = demand[bins].astype(float)
        basis = np.zeros((len(bins), room), np.int64)
        basis[np.arange(len(bins)), bins] = room // (bins + 1)
        inverse = np.diag(1.0 / basis[np.arange(len(bins)), bins])
        x = inverse @ need
        for _ in range(rounds):
            duals = inverse.sum(axis=0)
            values = np.zeros(room)
            values[bins] = np.maximum(duals, 0)
            worth, pattern = _knapsack(values, room)
            if worth <= 1 + gap:
                break
            way = inverse @ pattern[bins].astype(float)
            can = way > 1e-9
            if not can.any():
                break
            ratio = np.where(can, x / np.where(can, way, 1), np.inf)
            out = int(np.argmin(ratio))
            row = inverse[out] / way[out]
            inverse -= np.outer(way, row)
            inverse[out] = row
            basis[out] = pattern
            x = np.maximum(inverse @ need, 0)
        for pattern, times in sorted(zip(basis.tolist(), x.tolist(), strict=True), key=lambda p: -p[1]):
            p = np.array(pattern)
            used = p > 0
            n = int(min(np.floor(times + 1e-9), (left[used] // p[used]).min()))
            if n > 0:
                plan.append((p, n))
                left -= n * p
    while left.any():  # the rest, largest first
        pattern, free = np.zeros(room, np.int64), room
        for b in np.flatnonzero(left)[::-1]:
            n = min(int(left[b] - pattern[b]), free // (b + 1))
            pattern[b] += n
            free -= n * (b + 1)
        n = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan.append((pattern, n))
        left -= n * pattern
    return plan


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each bin go: runs of ranks, in arrays sorted by rank."""

    first_rank: dict[int, np.ndarray]
    first_sequence: dict[int, np.ndarray]
    each: dict[int, np.ndarray]


def lay_out(plan: list[tuple[np.ndarray, int]]) -> Slots:
    ranks: dict[int, list[int]] = {}
    sequences: dict[int, list[int]] = {}
    each: dict[int, list[int]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for b in np.flatnonzero(pattern).tolist():
            ranks.setdefault(b, []).append(taken.get(b, 0))
            sequences.setdefault(b, []).append(sequence)
            each.setdefault(b, []).append(int(pattern[b]))
            taken[b] = taken.get(b, 0) + times * int(pattern[b])
        sequence += times
    return Slots(*[{b: np.array(v, np.int64) for b, v in d.items()} for d in (ranks, sequences, each)])


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, keep_ids: bool, special: bool = False) -> DataFrame:
    """Pieces of every document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``row_key`` and, if asked, ``ids``."""
    schema = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, row_key long" + ", ids array<int>" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what the worker's tasks before have left
        enc = encoder(vocabulary, special)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            rows = []
            for i, raw in enumerate(enc.encode_all(b.column("text").to_pylist())):
                ids = np.frombuffer(raw + end, enc.dtype).astype("<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    rows.append((i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece.astype(np.int32) if keep_ids else None))
            if rows:
                of, start, length, crc, total, pieces = zip(*rows, strict=True)
                own = b.take(pa.array(of, pa.int64()))
                columns = {"doc_id": own.column("doc_id"), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int32()), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(total, pa.int64()), "row_key": own.column("row_key")}
                yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(pieces, pa.list_(pa.int32()))} if keep_ids else {}))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row_key"))
    return rows.select("doc_id", "row_key", "text").mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096, keep_ids: bool = False, special: bool = False) -> DataFrame:
    """Place every document in sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, with ``keep_ids``, ``ids``.
    Each document is closed by ``end_id``; null and empty texts hold it alone.
    Repeated rows and null ids are documents like any other; an empty table
    gives no pieces; a very long text gives full sequences and a rest; other columns
    are ignored.  Which of equally long pieces goes where is by a hash.  Sequences are numbered from 0 and filled without gaps.  With
    ``special``, strings of special tokens in a text give their ids.
    """
    spark = docs.sparkSession
    unit = UNIT if capacity % UNIT == 0 else 1
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH}):
        pieces = materialise(cut_documents(docs, vocabulary, end_id, capacity, keep_ids, special), "pieces")
    bin_of = F.floor((F.col("length") - 1) / unit).cast("int")
    histogram = pieces.groupBy(bin_of.alias("bin")).count().collect()
    demand = np.zeros(capacity // unit, np.int64)
    for r in histogram:
        demand[r["bin"]] = r["count"]
    slots = spark.sparkContext.broadcast(lay_out(solve_patterns(demand)))

    groups = max(1, int(demand.sum()) // RANK_GROUP)
    keyed = pieces.withColumn("bin", bin_of).withColumn("group", F.pmod(F.xxhash64("row_key", "start"), F.lit(groups)))
    earlier = W.partitionBy("bin").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    before = keyed.groupBy("bin", "group").count().select("bin", "group", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("bin", "group").orderBy("row_key", "start"))
    ranked = keyed.withColumn("within", within).join(before, ["bin", "group"]).withColumn("rank", F.col("within") - 1 + F.col("before"))

    @F.pandas_udf("sequence_id long, slot long")
    def place(bins: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        s = slots.value
        sequence, slot = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int64)
        b, r = bins.to_numpy(), ranks.to_numpy()
        for k in np.unique(b).tolist():
            at = np.flatnonzero(b == k)
            run = np.searchsorted(s.first_rank[k], r[at], "right") - 1
            step = r[at] - s.first_rank[k][run]
            sequence[at] = s.first_sequence[k][run] + step // s.each[k][run]
            slot[at] = k * capacity + step % s.each[k][run]
        return pd.DataFrame({"sequence_id": sequence, "slot": slot})

    placed = ranked.withColumn("at", place("bin", "rank")).select("*", "at.*")
    filled = W.partitionBy("sequence_id").orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(filled), F.lit(0)).alias("offset")
    columns = ["doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", offset]
    return placed.select(*columns, *["ids"] * keep_ids)
