"""Document quality: histogram gradient-boosted trees over document statistics.

Every whole text becomes a short vector of statistics in one pass.  Trees grow
on a bounded sample of labelled rows, on histograms of binned statistics, and
are flattened into arrays, so a batch of documents walks all trees with array
lookups alone.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.llm.shared import give_back, materialise, pinned, place, stable, text_or_empty, without

#: Most labelled rows that trees are grown on: those of least hash.
MAX_TRAIN = 20_000
FOLDS, TREES, DEPTH, RATE, BINS, LAMBDA, LEAST = 5, 80, 4, 0.15, 48, 1.0, 20
#: Scores from here on count as good.
CUT = 0.3

_CLASS = np.zeros(256, np.int64)  # 0 other, then:
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[9, 11, 12, 13, 32]] = 4
_CLASS[10] = 5
_CLASS[[ord(c) for c in ".,;:'\"?-()"]] = 6
_CLASS[ord("!")] = 7
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 8
_CLASS[128:] = 9
_CLASSES = 10
STATISTICS = [
    "bytes", *[f"class{i}" for i in range(_CLASSES)], "entropy", "words", "word_mean", "word_std", "word_longest", "word_distinct", "word_top", "capitals",
    "lines", "line_mean", "line_distinct", "line_top", "line_ends", "line_short", "sentence", "links", "marks_per_word", "compressed", "word_pairs",
]


def statistics(text: str) -> np.ndarray:
    """The statistics of one whole text; zeros for an empty one."""
    out = np.zeros(len(STATISTICS), np.float32)
    raw = text.encode()
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    by_class = np.bincount(_CLASS, weights=counts, minlength=_CLASSES) / n
    p = counts[counts > 0] / n
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    k, m = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen, line_seen = Counter(words), Counter(lines)
    repeats = sum(map(str.__eq__, words, words[1:]))
    stops = int(counts[46] + counts[33] + counts[63])
    out[:] = [
        math.log1p(n), *by_class, float(-(p * np.log2(p)).sum()), math.log1p(len(words)), lengths.mean(), lengths.std(), math.log1p(lengths.max()),
        len(seen) / k, max(seen.values(), default=0) / k, sum(map(str.isupper, words)) / k,
        math.log1p(len(lines)), math.log1p(n / m), len(line_seen) / m, max(line_seen.values(), default=0) / m,
        sum(x.rstrip()[-1] in ".!?:;\"" for x in lines) / m, sum(len(x) < 30 for x in lines) / m,
        len(words) / (1 + stops), (text.count("http") + text.count("www.")) / k, (by_class[6] + by_class[7] + by_class[8]) * n / k,
        len(zlib.compress(raw, 1)) / n, repeats / k,
    ]
    return out


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: a node has a statistic, a threshold and two children; leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost trees on logistic loss; without rows, or with one class only, a constant."""
    rate = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    base = float(np.log(rate / (1 - rate)))
    none = np.zeros(0, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return Forest(none, none.astype(float), none, none, none.astype(float), none, base)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    f_n = x.shape[1]
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    margin = np.full(len(y), base)

    def node() -> int:
        k = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(k), right.append(k), value.append(0.0)
        return k

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        roots.append(node())
        leaf = np.full(len(y), roots[-1])
        level = [roots[-1]]
        for depth in range(DEPTH + 1):
            place = {k: i for i, k in enumerate(level)}
            slot = np.array([place.get(k, -1) for k in range(len(feature))])[leaf]
            here = np.flatnonzero(slot >= 0)
            size = len(level) * BINS
            sums = np.zeros((3, f_n, len(level), BINS))
            for f in range(f_n):
                code = slot[here] * BINS + binned[here, f]
                for q, w in enumerate((g[here], h[here], None)):
                    sums[q, f] = np.bincount(code, weights=w, minlength=size).reshape(len(level), BINS)
            total = sums[:, 0].sum(axis=2)
            lower = sums.cumsum(axis=3)
            upper = total[:, None, :, None] - lower
            gain = lower[0] ** 2 / (lower[1] + LAMBDA) + upper[0] ** 2 / (upper[1] + LAMBDA) - (total[0] ** 2 / (total[1] + LAMBDA))[None, :, None]
            gain[(lower[2] < LEAST) | (upper[2] < LEAST)] = -1
            following = []
            for i, k in enumerate(level):
                value[k] = -RATE * total[0, i] / (total[1, i] + LAMBDA)
                f, b = np.unravel_index(int(np.argmax(gain[:, i])), gain[:, i].shape)
                if depth == DEPTH or gain[f, i, b] <= 1e-6 or b >= len(cuts[f]):
                    continue
                feature[k], threshold[k] = int(f), float(cuts[f][b])
                left[k], right[k] = node(), node()
                mine = here[slot[here] == i]
                leaf[mine] = np.where(binned[mine, f] <= b, left[k], right[k])
                following += [left[k], right[k]]
            level = following
            if not level:
                break
        margin += np.array(value)[leaf]
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), base)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no rest by the number of folds; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per row of ``docs``: ``place``, ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1, others are ignored; of several
    the larger).  Trees see only rows that are not held out, at most ``max_train``
    of them, those of least hash; without labels every score is one half.  Null,
    empty and very long texts get a score like others; repeated rows score alike; a
    null ``doc_id`` is not held out; an empty table gives no rows; other columns
    are ignored.
    """
    spark = docs.sparkSession

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(caches=True)
        for b in batches:
            x = np.array([statistics(t) for t in b.column("text").to_pylist()], np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(STATISTICS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("place"), b.column("doc_id"), lists], ["place", "doc_id", "x"])

    with pinned(spark):
        rows = stable(docs).select(place().alias("place"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        table = materialise(rows.mapInArrow(describe, "place struct<file:long,at:long>, doc_id long, x array<float>"), "statistics")
    known = labels.where("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    rank = F.xxhash64("doc_id")
    labelled = table.where(~held_out(F.col("doc_id"))).select("place", "doc_id", rank.alias("rank")).join(known, "doc_id")
    n = labelled.count()
    wanted = max_train + 8 * math.isqrt(max_train) + 100
    if n > wanted:  # so few rows leave the tasks, however many tasks there are
        few = labelled.where(F.col("rank") < wanted * 2**64 // n - 2**63)
        if few.count() >= max_train:  # fewer only if many rows share an id
            labelled = few
    chosen = labelled.orderBy("rank", "place").limit(max_train).select("place", "quality")
    train = table.select("place", "x").join(F.broadcast(chosen), "place").toPandas()
    x = np.array(train["x"].tolist(), np.float64).reshape(len(train), len(STATISTICS))
    forest = spark.sparkContext.broadcast(grow(x, train["quality"].to_numpy(np.float64)))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(forest.value.score(np.array(x.tolist(), np.float64).reshape(len(x), len(STATISTICS))))

    scored = table.select("place", "doc_id", held_out(F.col("doc_id")).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    Null, empty and long texts, repeated rows, null ids and empty tables as in
    :func:`score_quality`.
    """
    docs = stable(docs)
    return without(docs, materialise(score_quality(docs, labels).where("predicted = 0").select("place"), "rejected"))
