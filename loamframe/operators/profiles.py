"""Summaries that merge: of reads at each stage, and of values for box plots.

A summary is one row a key: counts and sums that are exact, and sketches of quantiles
and of distinct sequences whose size does not grow.  Stages, lanes and samples are
merged from summaries alone, so reads are looked at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of quantile sketches: ranks are off by about 1.3 % at most, and groups of fewer values are exact.
QUANTILE_K = 200
#: Size of distinct sketches, as a power of two: counts are off by about 1.6 %.
DISTINCT_K = 12

_SUMS = ("reads", "letters", "gc", "unknown", "quality_letters", "quality")


def read_summary(reads: DataFrame, *keys: str) -> DataFrame:
    """One row for each key (stage, sample, mate) of reads (``seq``, ``qual``); empty reads count, null ones have no letters."""
    seq, qual = F.coalesce("seq", F.lit("")), F.coalesce("qual", F.lit(""))
    kept = lambda letters: F.length(F.regexp_replace(F.upper(seq), f"[^{letters}]", ""))
    # the sum of a string's signs, less what each stands above: no letter is a row of its own
    signs = F.aggregate(F.split(qual, ""), F.lit(0), lambda total, c: total + F.when(c == "", 0).otherwise(F.ascii(c) - 33))
    rows = reads.select(*keys, seq.alias("seq"), F.length(seq).alias("size"), kept("GC").alias("gc"), kept("ACGT").alias("known"), F.length(qual).alias("signs"), signs.alias("quality"))
    mean = F.try_divide(F.col("quality"), F.col("signs")).cast("double")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reads"), F.sum("size").alias("letters"), F.sum("gc").alias("gc"), F.sum(F.col("size") - F.col("known")).alias("unknown"), F.sum("signs").alias("quality_letters"), F.sum("quality").alias("quality"),
        F.min("size").alias("shortest"), F.max("size").alias("longest"),
        F.kll_sketch_agg_bigint(F.col("size").cast("long"), QUANTILE_K).alias("sizes"), F.kll_sketch_agg_double(mean, QUANTILE_K).alias("qualities"), F.hll_sketch_agg("seq", DISTINCT_K).alias("sequences"),
    )


def merged_summary(summaries: DataFrame, *keys: str) -> DataFrame:
    """Summaries of the same keys as one."""
    sketches = [F.kll_merge_agg_bigint("sizes", QUANTILE_K).alias("sizes"), F.kll_merge_agg_double("qualities", QUANTILE_K).alias("qualities"), F.hll_union_agg("sequences").alias("sequences")]
    return summaries.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS], F.min("shortest").alias("shortest"), F.max("longest").alias("longest"), *sketches)


def summary_table(summaries: DataFrame, *keys: str) -> DataFrame:
    """What a summary tells: exact counts and shares, and by sketch quartiles and the share of reads that repeat another."""
    share = lambda a, b: F.coalesce(F.try_divide(100.0 * F.col(a), F.col(b)), F.lit(0.0))
    quartile = lambda kind, c, r: getattr(F, f"kll_sketch_get_quantile_{kind}")(F.col(c), F.lit(r))
    distinct = F.least(F.hll_sketch_estimate("sequences"), F.col("reads"))
    known = F.col("quality_letters") > 0
    return summaries.select(
        *keys, "reads", "letters", share("gc", "letters").alias("gc_pct"), share("unknown", "letters").alias("unknown_pct"), F.try_divide("letters", "reads").alias("mean_length"), "shortest", "longest", F.try_divide("quality", "quality_letters").alias("mean_quality"),
        *[quartile("bigint", "sizes", r).alias(f"length_{n}") for n, r in _QUARTILES], *[F.when(known, quartile("double", "qualities", r)).alias(f"quality_{n}") for n, r in _QUARTILES],
        distinct.alias("distinct_reads"), (1 - F.try_divide(distinct, F.col("reads"))).alias("duplicated"),
    )


_QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


def box_summary(values: DataFrame, *keys: str, value: str = "v") -> DataFrame:
    """One mergeable row for each key of finite values; nulls and what is not finite are counted apart."""
    number = F.col(value).cast("double")
    good = F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf")), number)
    rows = values.select(*keys, good.alias("v"))
    return rows.groupBy(*keys).agg(
        F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("without"), F.sum("v").alias("sum"), F.sum(F.col("v") * F.col("v")).alias("square"), F.min("v").alias("min"), F.max("v").alias("max"), F.kll_sketch_agg_double("v", QUANTILE_K).alias("values")
    )


def merged_boxes(boxes: DataFrame, *keys: str) -> DataFrame:
    """Box summaries of the same keys as one."""
    return boxes.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "without", "sum", "square")], F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("values", QUANTILE_K).alias("values"))


def box_statistics(boxes: DataFrame, *keys: str, reach: float = 1.5) -> DataFrame:
    """Mean, deviation, quartiles and fences ``reach`` quartile distances out, no further than the least and greatest value.

    A quartile is the least value that has its share of the values at or below it.
    """
    mean = F.try_divide("sum", "n")
    spread = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), (F.col("square") - F.col("n") * mean * mean) / (F.col("n") - 1))))
    some = F.col("n") > 0
    out = boxes.select(*keys, "n", "without", mean.alias("mean"), spread.alias("std"), "min", *[F.when(some, F.kll_sketch_get_quantile_double(F.col("values"), F.lit(r))).alias(n) for n, r in _QUARTILES], "max")
    width = (F.col("q3") - F.col("q1")) * reach
    return out.withColumn("low_fence", F.greatest(F.col("min"), F.col("q1") - width)).withColumn("high_fence", F.least(F.col("max"), F.col("q3") + width))


def histogram(values: DataFrame, width: float, *keys: str, value: str = "v") -> DataFrame:
    """Values in each bin of a width, exact: ``bin`` is the bin's lower end."""
    at: Column = F.floor(F.col(value) / width) * width
    return values.where(F.col(value).isNotNull()).groupBy(*keys, at.cast("double").alias("bin")).agg(F.count(F.lit(1)).alias("values"))


def dataset_quality(counts: DataFrame, factors: DataFrame, samples: DataFrame) -> DataFrame:
    """One row for each sample and ``stage`` (raw, normalised): library size, genes found and the box of its log2 values.

    ``counts``: ``gene``, ``sample``, ``n``; ``factors``: ``sample``, ``size_factor``;
    ``samples``: ``sample``, ``group``.  Cells that are missing are zeros; samples
    without counts stay, with none.
    """
    genes = counts.select("gene").distinct().agg(F.count(F.lit(1))).scalar()
    rows = counts.join(factors, "sample")
    each = rows.select("sample", "n", F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.log2(v + 1).alias("v")) for s, v in (("raw", F.col("n")), ("normalised", F.col("n") / F.col("size_factor")))])))
    boxes = box_statistics(box_summary(each, "sample", "stage"), "sample", "stage")
    sizes = counts.groupBy("sample").agg(F.sum("n").alias("library_size"), F.count_if(F.col("n") > 0).alias("genes_found"))
    every = samples.select("sample", "group", F.explode(F.array(F.lit("raw"), F.lit("normalised"))).alias("stage"))
    return every.join(sizes, "sample", "left").join(boxes, ["sample", "stage"], "left").withColumn("genes_missing", genes - F.coalesce("genes_found", F.lit(0)))
