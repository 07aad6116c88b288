"""Gene sets: overlap counts and running-sum scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.functions.special import hypergeometric_p
from loamframe.operators import expression as X


def overlap_counts(tests: DataFrame, sets: DataFrame) -> DataFrame:
    """Counts for an over-representation test per ``comparison`` and ``term``.

    ``tests``: ``comparison``, ``gene``, ``hit``; its genes are the universe.
    Gives ``set_hits``, ``set_size``, ``hits`` and ``universe``.
    """
    totals = tests.groupBy("comparison").agg(F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("universe"))
    members = tests.join(sets.select("term", "gene").distinct(), "gene")
    cells = members.groupBy("comparison", "term").agg(F.count_if("hit").alias("set_hits"), F.count(F.lit(1)).alias("set_size"))
    return cells.join(totals, "comparison").select("comparison", "term", "set_hits", "set_size", "hits", "universe")


def enrichment_scores(stats: DataFrame, sets: DataFrame, least: int = 10, most: int = 500) -> DataFrame:
    """Largest deviation of the weighted running sum per ``comparison`` and ``term``.

    ``stats``: ``comparison``, ``gene``, ``stat``; ranks fall with ``stat``, ties by
    gene.  The sum has its extremes just before and at a member, so only members
    are looked at.  Sets outside ``least``..``most`` members are left out, and so
    are sets of all genes or without weight.
    """
    ranked = stats.withColumn("rank", F.row_number().over(W.partitionBy("comparison").orderBy(F.desc("stat"), "gene")))
    sizes = stats.groupBy("comparison").agg(F.count(F.lit(1)).alias("genes"))
    term = W.partitionBy("comparison", "term")
    upto = term.orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    m = ranked.join(sets.select("term", "gene").distinct(), "gene").withColumn("w", F.abs("stat"))
    m = m.withColumn("i", F.row_number().over(term.orderBy("rank"))).withColumn("h", F.sum("w").over(upto))
    m = m.withColumn("k", F.count(F.lit(1)).over(term)).withColumn("s", F.sum("w").over(term)).join(sizes, "comparison")
    m = m.where((F.col("k") >= least) & (F.col("k") <= most) & (F.col("k") < F.col("genes")) & (F.col("s") > 0))
    missed = (F.col("rank") - F.col("i")) / (F.col("genes") - F.col("k"))
    top, low = F.max(F.col("h") / F.col("s") - missed), F.min((F.col("h") - F.col("w")) / F.col("s") - missed)
    return m.groupBy("comparison", "term").agg(F.max("k").alias("set_size"), F.when(top >= -low, top).otherwise(low).alias("score"))


def over_representation(tests: DataFrame, sets: DataFrame, least: int = 5, padj: float | None = 0.05, qvalue: float | None = 0.2) -> DataFrame:
    """Terms with more hits than chance: overlap counts with ``p``, ``padj`` and ``qvalue``.

    ``tests``: ``comparison`` (a direction may be part of it), ``gene``, ``hit``.
    Comparisons of fewer than ``least`` hits are left out; only terms with a hit are
    tested.  Cutoffs of None keep all terms.
    """
    counts = overlap_counts(tests, sets).where((F.col("hits") >= least) & (F.col("set_hits") > 0))
    tested = counts.withColumn("p", hypergeometric_p(F.col("set_hits"), F.col("set_size"), F.col("hits"), F.col("universe")))
    adjusted = X.storey(tested, "comparison").join(X.benjamini_hochberg(tested, "comparison").select("comparison", "term", "padj"), ["comparison", "term"])
    if padj is not None:
        adjusted = adjusted.where(F.col("padj") < padj)
    return adjusted if qvalue is None else adjusted.where(F.col("qvalue") < qvalue)


def directions(results: DataFrame) -> DataFrame:
    """Results as tests for :func:`over_representation`: each comparison once a direction, with its significant genes as hits."""
    both = results.withColumn("direction", F.explode(F.array(F.lit("Upregulated"), F.lit("Downregulated"))))
    return both.select(F.concat_ws(" ", "comparison", "direction").alias("comparison"), "gene", (F.col("significance") == F.col("direction")).alias("hit"))


def permuted_enrichment(stats: DataFrame, sets: DataFrame, permutations: int = 1000, least: int = 10, most: int = 500, seed: int = 42) -> DataFrame:
    """Running-sum scores with ``nes``, ``p`` and ``padj`` from permuted gene labels.

    A permutation gives the gene of every place in the list to another one, by the
    order of a hash.  p is the share of permuted scores of the same sign that are as
    far out, one added to both counts; ``nes`` is the score over their mean.
    """
    by = W.partitionBy("comparison")
    ranked = stats.withColumn("place", F.row_number().over(by.orderBy(F.desc("stat"), "gene")))
    one = ranked.select("comparison", "place", "stat")
    runs = ranked.select("comparison", "gene", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("run"))
    shuffled = runs.withColumn("place", F.row_number().over(W.partitionBy("comparison", "run").orderBy(F.xxhash64("gene", "run", F.lit(seed)), "gene")))
    null_stats = shuffled.join(one, ["comparison", "place"]).select(F.struct("comparison", "run").alias("comparison"), "gene", "stat")
    null = enrichment_scores(null_stats, sets, least, most).select("comparison.comparison", "term", F.col("score").alias("null"))
    seen = enrichment_scores(stats, sets, least, most)
    both = seen.join(null, ["comparison", "term"], "left")
    same = F.signum("null") == F.signum("score")
    out = both.groupBy("comparison", "term", "set_size", "score").agg(
        F.count_if(same).alias("n"), F.count_if(same & (F.abs("null") >= F.abs("score"))).alias("far"), F.avg(F.when(same, F.abs("null"))).alias("mean")
    )
    tested = out.select("comparison", "term", "set_size", "score", F.try_divide("score", "mean").alias("nes"), ((F.col("far") + 1) / (F.col("n") + 1)).alias("p"))
    return X.benjamini_hochberg(tested, "comparison")
