"""Sequencing reads: minimizers, index, classification, screening, trimming, quality profile.

Sequences are text columns.  Minimizers and the adapter search work on Arrow batches
with numpy, everything else stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.operators import minimizers as M
from loamframe.operators import taxonomy as T

#: Bases of a read that count.
READ_LENGTH = 256


def digits(seq: Column, length: int | None = READ_LENGTH) -> Column:
    """Bases as digits 0-3, other letters as A; at most ``length`` of them."""
    cut = seq if length is None else F.substring(seq, 1, length)
    return F.translate(F.regexp_replace(F.upper(cut), "[^ACGT]", "A"), "ACGT", "0123")


def minimizers(reads: DataFrame, key: str, k: int = 35, l: int = 31, toggle: int = 0, spaced: int = 0, length: int | None = READ_LENGTH) -> DataFrame:
    """``key``, ``pos`` and ``minimizer`` of every k-window of ``seq``; sequences shorter than k give none."""
    runs = M.minimizer_runs(reads, key, k, l, toggle, spaced, length)
    return runs.select(key, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("times") - 1)).alias("pos"), "minimizer")


def build_index(references: DataFrame, paths: DataFrame, k: int = 35, l: int = 31, toggle: int = 0, spaced: int = 0) -> DataFrame:
    """``minimizer``, ``tax_id``: the lowest common ancestor of all taxa whose sequences (``tax_id``, ``seq``) have it.

    Of many root paths the common start is that of the least and the greatest, so
    two aggregates per minimizer are enough, combined before the shuffle.
    """
    found = M.minimizer_runs(references, "tax_id", k, l, toggle, spaced, None).select("tax_id", "minimizer").distinct()
    rows = found.join(paths.select("tax_id", "path"), "tax_id")
    ends = rows.groupBy("minimizer").agg(F.min("path").alias("a"), F.max("path").alias("b"))
    return ends.select("minimizer", F.element_at(T.lowest_common_ancestor(F.col("a"), F.col("b")), -1).alias("tax_id"))


def fold_hits(hits: DataFrame, paths: DataFrame) -> DataFrame:
    """``read_id``, ``hit_count``, ``path`` and ``tax_id`` from runs of hits (``read_id``, ``pos``, ``times``, ``tax_id``), folded in order.

    A path moves once for each taxon of a read.  From its second window on a run
    changes nothing more, so two stand for any number.
    """
    place = F.struct("pos", F.least("times", F.lit(2)).alias("times"))
    by_taxon = hits.groupBy("read_id", "tax_id").agg(F.collect_list(place).alias("at"), F.sum("times").alias("hits"))
    each = by_taxon.join(paths.select("tax_id", "path"), "tax_id").withColumn("t", F.struct("path", "at"))
    per_read = each.groupBy("read_id").agg(F.sum("hits").alias("hit_count"), F.collect_list("t").alias("taxa"))
    runs = F.flatten(F.transform("taxa", lambda t: F.transform(t["at"], lambda x: F.struct(x["pos"].alias("pos"), x["times"].alias("times"), t["path"].alias("path")))))
    folded = F.aggregate(F.array_sort(runs), F.array().cast("array<int>"), lambda held, x: F.when(x["times"] > 1, T.fold(T.fold(held, x["path"]), x["path"])).otherwise(T.fold(held, x["path"])))
    return per_read.select("read_id", "hit_count", folded.alias("path")).withColumn("tax_id", F.try_element_at("path", F.lit(-1)))


def classify(reads: DataFrame, index: DataFrame, paths: DataFrame, k: int = 35, l: int = 31, toggle: int = 0, spaced: int = 0, hot: DataFrame | None = None) -> DataFrame:
    """``read_id``, ``length``, ``hit_count`` and ``tax_id`` (null: unclassified) of every read (``read_id``, ``seq``).

    ``index`` may be a table in buckets, which stays where it is; ``hot``
    (:func:`loamframe.operators.minimizers.hot_minimizers`) keeps minimizers of very many reads apart.
    """
    hits = M.look_up(M.minimizer_runs(reads, "read_id", k, l, toggle, spaced), index, "read_id", hot)
    called = fold_hits(hits, paths)
    size = F.least(F.length("seq"), F.lit(READ_LENGTH)).alias("length")
    return reads.select("read_id", size).join(called, "read_id", "left").select("read_id", "length", F.coalesce("hit_count", F.lit(0)).cast("long").alias("hit_count"), "tax_id", "path")


def kmer_votes(reads: DataFrame, index: DataFrame, k: int = 35, l: int = 31, toggle: int = 0, spaced: int = 0) -> DataFrame:
    """``read_id``, ``tax_id`` (null: not in the index) and ``kmers`` of whole reads, for a confidence threshold."""
    found = M.minimizer_runs(reads, "read_id", k, l, toggle, spaced, None)
    return found.join(index, "minimizer", "left").groupBy("read_id", "tax_id").agg(F.sum("times").alias("kmers"))


def classification_lines(called: DataFrame) -> DataFrame:
    """``value``: flag, read, taxon, length and a mark, tab-separated; ``sample`` comes along."""
    hit = F.col("tax_id").isNotNull()
    return called.select(*["sample"] * ("sample" in called.columns), F.concat_ws("\t", F.when(hit, "C").otherwise("U"), F.col("read_id").cast("string"), F.coalesce("tax_id", F.lit(0)).cast("string"), F.col("length").cast("string"), F.when(hit, "1").otherwise("0")).alias("value"))


def screened(reads: DataFrame, references: DataFrame, k: int = 15, share: float = 0.5) -> DataFrame:
    """Add ``matches`` to reads (``read_id``, ``seq``): whether a mate has at least a ``share`` of its k-mers in ``references``.

    Whole reads count.  Rows with one ``read_id`` are mates and get the same answer,
    so pairs stay together.  Filter on ``matches`` for either side.
    """
    known = M.minimizer_runs(references.withColumn("_r", F.lit(0)), "_r", k, k, length=None).select("minimizer").distinct().withColumn("_known", F.lit(1))
    mates = reads.withColumn("_mate", F.struct("read_id", F.xxhash64("seq").alias("h")))
    found = M.minimizer_runs(mates, "_mate", k, k, length=None).join(known, "minimizer", "left")
    covered = found.groupBy("_mate").agg((F.sum(F.when(F.col("_known").isNotNull(), F.col("times")).otherwise(0)) / F.sum("times")).alias("share"))
    good = covered.where(F.col("share") >= share).select(F.col("_mate.read_id").alias("read_id")).distinct().withColumn("_hit", F.lit(True))
    return reads.join(good, "read_id", "left").withColumn("matches", F.coalesce("_hit", F.lit(False))).drop("_hit")


def _windows(length: int, step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tax, row, seq in zip(*(batch.column(c).to_pylist() for c in ("tax_id", "row", "seq")), strict=True):
                for i in range(0, max(0, len(seq) - length + 1), 10_000 * step):
                    at = range(i, min(i + 10_000 * step, len(seq) - length + 1), step)
                    keys = pa.StructArray.from_arrays([pa.array([tax] * len(at), pa.int32()), pa.array([row] * len(at), pa.int64()), pa.array(at, pa.int64())], ["tax_id", "row", "at"])
                    yield pa.RecordBatch.from_arrays([keys, pa.array([seq[p : p + length] for p in at], pa.string())], ["read_id", "seq"])

    return cut


def ancestor_shares(references: DataFrame, index: DataFrame, paths: DataFrame, length: int, k: int = 35, l: int = 31, toggle: int = 0, spaced: int = 0, step: int = 1) -> DataFrame:
    """``tax_id``, ``ancestor``, ``windows`` and ``share``: where reads of a taxon end up, for :func:`loamframe.operators.taxonomy.reestimate`.

    Every stretch of ``length`` letters of a taxon's ``references`` (``tax_id``,
    ``seq``), one a ``step``, is classified like a read.  Those called as the taxon or
    one of its ancestors are counted; ``share`` is of all stretches of the taxon.
    """
    rows = references.where("seq is not null").select(F.col("tax_id").cast("int").alias("tax_id"), F.monotonically_increasing_id().alias("row"), "seq")
    reads = rows.mapInArrow(_windows(length, step), "read_id struct<tax_id:int,row:long,at:long>, seq string")
    hits = M.look_up(M.minimizer_runs(reads, "read_id", k, l, toggle, spaced), index, "read_id")
    called = fold_hits(hits, paths).groupBy(F.col("read_id.tax_id").alias("tax_id"), F.col("tax_id").alias("ancestor")).agg(F.count(F.lit(1)).alias("windows"))
    number = F.floor((F.length("seq") - length) / step) + 1
    whole = rows.where(F.length("seq") >= length).groupBy("tax_id").agg(F.sum(number).alias("all"))
    own = called.join(paths.select("tax_id", "path"), "tax_id").where(F.array_contains("path", F.col("ancestor")))
    return own.join(whole, "tax_id").select("tax_id", "ancestor", "windows", (F.col("windows") / F.col("all")).alias("share"))


# ---- trimming ----------------------------------------------------------------------------


def qualities(text: Column, offset: int = 33) -> Column:
    """Phred qualities of a quality string."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c) - offset)


def clip(seq: Column, five: int = 0, three: int = 0) -> Column:
    """``five`` letters off the start and ``three`` off the end."""
    return F.substring(seq, F.lit(five + 1), F.greatest(F.lit(0), F.length(seq) - five - three))


def quality_cut(quality: Column, least: int = 20) -> Column:
    """Letters to keep: the cut before which the running sum of ``least`` minus quality, from the end, is greatest.

    The sum stops where it falls below 0.
    """
    q = F.reverse(qualities(quality))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("best"), F.lit(0).alias("cut"), F.lit(0).alias("at"), F.lit(False).alias("over"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["sum"] + (F.lit(least) - x)
        over = acc["over"] | (total < 0)
        better = ~over & (total > acc["best"])
        return F.struct(total.alias("sum"), F.when(better, total).otherwise(acc["best"]).alias("best"), F.when(better, acc["at"] + 1).otherwise(acc["cut"]).alias("cut"), (acc["at"] + 1).alias("at"), over.alias("over"))

    return F.length(quality) - F.aggregate(q, start, step)["cut"]


def poly_tail(seq: Column, least: int = 10, bases: str = "G") -> Column:
    """Letters to keep before a run of ``least`` or more of one of ``bases`` at the end."""
    runs = "|".join(f"{b}{{{least},}}" for b in bases)
    return F.length(F.regexp_replace(seq, f"({runs})$", ""))


def _edits(text: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Least edits of ``wanted`` against letters that begin at each place of each row, wherever they end.

    Rows are walked from their ends together; a row's automaton is two words of
    bits, one a letter of ``wanted``, and a place costs a dozen operations on all rows.
    """
    m, (rows, width) = len(wanted), text.shape
    one, top = np.uint64(1), np.uint64(1) << np.uint64(m - 1)
    every = np.uint64((1 << m) - 1)
    match = np.zeros(256, np.uint64)
    for i, c in enumerate(wanted[::-1]):
        match[c] |= one << np.uint64(i)
    up, down, score = np.full(rows, every), np.zeros(rows, np.uint64), np.full(rows, m, np.int32)
    out = np.full((rows, width + 1), m, np.int32)
    for p in range(width - 1, -1, -1):
        on = p < size
        eq = match[text[:, p]]
        x = eq | down
        with np.errstate(over="ignore"):
            d0 = ((((eq & up) + up) ^ up) | x) & every
        more, less = down | (~(d0 | up) & every), d0 & up
        step = ((more & top) != 0).astype(np.int32) - ((less & top) != 0)
        more, less = (more << one) & every, (less << one) & every  # a place may begin the match for nothing
        up, down = np.where(on, less | (~(d0 | more) & every), up), np.where(on, more & d0, down)
        score = np.where(on, score + step, score)
        out[:, p] = score
    return out


def _end_edits(tail: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Edits between ``wanted`` and each row's last 0, 1, ... letters; ``tail`` has rows' letters from the end on."""
    rows, width = tail.shape
    line = np.repeat(np.arange(len(wanted) + 1, dtype=np.int32)[None, :], rows, 0)
    out = np.empty((rows, width + 1), np.int32)
    out[:, 0] = line[:, -1]
    back = wanted[::-1]
    for i in range(width):
        new = np.empty_like(line)
        new[:, 0] = i + 1
        for j, c in enumerate(back):
            new[:, j + 1] = np.minimum(np.minimum(line[:, j + 1], new[:, j]) + 1, line[:, j] + (tail[:, i] != c))
        line = new
        out[:, i + 1] = line[:, -1]
    return out


def _cut_places(text: np.ndarray, size: np.ndarray, wanted: np.ndarray, overlap: int, error: float) -> np.ndarray:
    rows, width = text.shape
    m, most = len(wanted), int(error * len(wanted))
    far = np.int32(1 << 30)
    cost = np.full((rows, width + most + 1), far)
    if m >= overlap:
        whole = _edits(text, size, wanted)
        cost[:, : width + 1] = np.where(whole <= most, whole, far)
    for j in range(max(1, overlap), m):  # the read ends inside the adapter
        allowed = int(error * j)
        back = size[:, None] - 1 - np.arange(j + allowed)[None, :]
        tail = np.where(back >= 0, np.take_along_axis(text, np.maximum(back, 0), 1) if width else 0, 0)
        found = _end_edits(tail, wanted[:j])
        for n in range(max(1, j - allowed), j + allowed + 1):
            at = np.flatnonzero((size >= n) & (found[:, n] <= allowed))
            p = size[at] - n
            cost[at, p] = np.minimum(cost[at, p], found[at, n])
    cost[np.arange(width + most + 1)[None, :] >= size[:, None]] = far
    first = np.where((cost < far).any(1), (cost < far).argmax(1), size)
    # an edit lets the match begin a little early: take the best of the places right after it
    near = np.take_along_axis(cost, np.minimum(first[:, None] + np.arange(most + 1)[None, :], width + most), 1)
    return np.where(first < size, first + near.argmin(1), size)


#: Letters of reads that are searched at once.
AREA = 1 << 22


def adapter_cut(seq: Column, adapter: str, overlap: int = 1, error: float = 0.1) -> Column:
    """Letters to keep before the first place where ``adapter`` begins.

    A share ``error`` of its letters, rounded down, may be replaced, inserted or
    deleted.  Where the read ends inside the adapter, ``overlap`` letters or more of
    its start are compared with the read's end, and the share counts of these.  Of the
    first place that fits and those as many letters after it as may be edited, the
    one with the fewest edits is taken.  Adapters have up to 63 letters.
    """
    wanted = np.frombuffer(adapter.encode(), np.uint8)
    if not 0 < len(wanted) < 64:
        raise ValueError("an adapter has 1 to 63 letters")

    @F.pandas_udf("int")
    def cut(reads: pd.Series) -> pd.Series:
        texts = [t.encode("ascii", "replace") for t in reads.fillna("")]
        sizes = np.array([len(t) for t in texts], np.int64)
        keep = sizes.copy()
        order = np.argsort(sizes, kind="stable")[::-1]
        i = 0
        while i < len(order) and sizes[order[i]]:  # a long read shares its slice with few others
            width = int(sizes[order[i]])
            at = order[i : i + max(1, AREA // width)]
            letters = np.zeros((len(at), width), np.uint8)
            for row, k in enumerate(at):
                letters[row, : sizes[k]] = np.frombuffer(texts[k], np.uint8)
            keep[at] = _cut_places(letters, sizes[at], wanted, overlap, error)
            i += len(at)
        return pd.Series(keep).astype("Int32").mask(reads.isna().to_numpy())

    return cut(seq)


def trim_reads(reads: DataFrame, adapter: str | None = None, least_quality: int = 20, five: int = 0, three: int = 0, least_length: int = 20, overlap: int = 1, poly: str = "") -> DataFrame:
    """Clip, trim by quality, adapter and tails; reads of fewer than ``least_length`` letters go, with their mates.

    ``reads``: ``read_id``, ``mate``, ``seq``, ``qual``.
    """
    out = reads.withColumns({"seq": clip(F.col("seq"), five, three), "qual": clip(F.col("qual"), five, three)})

    def shorten(table: DataFrame, keep: Column) -> DataFrame:
        kept = table.withColumn("_keep", keep)
        return kept.withColumns({c: F.substring(c, F.lit(1), F.col("_keep")) for c in ("seq", "qual")}).drop("_keep")

    out = shorten(out, quality_cut(F.col("qual"), least_quality))
    if adapter is not None:
        out = shorten(out, adapter_cut(F.col("seq"), adapter, overlap))
    if poly:
        out = shorten(out, poly_tail(F.col("seq"), 10, poly))
    whole = out.groupBy("read_id").agg(F.min(F.length("seq")).alias("_least")).where(F.col("_least") >= least_length).select("read_id")
    return out.join(whole, "read_id", "left_semi")


# ---- quality profile ---------------------------------------------------------------------


def position_profile(reads: DataFrame, *keys: str) -> DataFrame:
    """Counts of every base and mean quality at every position, for each key (stage, sample, mate)."""
    letters = F.arrays_zip(F.filter(F.split("seq", ""), lambda c: c != "").alias("base"), qualities(F.col("qual")).alias("q"))
    each = reads.select(*keys, F.posexplode(letters).alias("pos", "x")).select(*keys, "pos", F.col("x")["base"].alias("base"), F.col("x")["q"].alias("q"))
    bases = [F.count_if(F.upper("base") == b).alias(b.lower()) for b in "ACGT"]
    return each.groupBy(*keys, "pos").agg(*bases, F.count_if(~F.upper("base").isin(*"ACGT")).alias("n"), F.avg("q").alias("mean_quality"))


def gc_histogram(reads: DataFrame, *keys: str) -> DataFrame:
    """Reads for each whole percentage of G and C; empty reads are left out."""
    gc = F.length(F.regexp_replace(F.upper("seq"), "[^GC]", ""))
    return reads.where(F.length("seq") > 0).groupBy(*keys, F.floor(gc * 100 / F.length("seq")).cast("int").alias("gc_pct")).agg(F.count(F.lit(1)).alias("reads"))


def length_histogram(reads: DataFrame, *keys: str) -> DataFrame:
    """Reads of each length."""
    return reads.groupBy(*keys, F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def duplication(reads: DataFrame, *keys: str) -> DataFrame:
    """Reads, distinct sequences and the share that repeats another."""
    by = reads.groupBy(*keys, "seq").agg(F.count(F.lit(1)).alias("k"))
    return by.groupBy(*keys).agg(F.sum("k").alias("reads"), F.count(F.lit(1)).alias("distinct_reads")).withColumn("duplicated", 1 - F.col("distinct_reads") / F.col("reads"))
