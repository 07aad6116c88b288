"""From tests to results: adjusted p-values, labels, top lists, summaries and plot tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.operators import expression as X


def shape_results(tests: DataFrame, method: str = "bonferroni", p: float = 0.05, fold: float = 1.0, symbols: DataFrame | None = None) -> DataFrame:
    """Add ``padj``, ``significance`` and ``gene_name`` to tests (``comparison``, ``gene``, ``log2_fold_change``, ``p``).

    ``method`` is ``bonferroni`` or ``bh``.  Names come from ``symbols`` (``gene``,
    ``symbol``) and fall back to the gene's id.
    """
    adjusted = X.bonferroni(tests, "comparison") if method == "bonferroni" else X.benjamini_hochberg(tests, "comparison")
    out = adjusted.withColumn("significance", X.significance(F.col("padj"), F.col("log2_fold_change"), p, fold))
    if symbols is None:
        return out.withColumn("gene_name", F.col("gene").cast("string"))
    return out.join(symbols, "gene", "left").withColumn("gene_name", F.coalesce("symbol", F.col("gene").cast("string"))).drop("symbol")


def differential_expression(counts: DataFrame, comparisons: DataFrame, groups: DataFrame, method: str = "bonferroni", p: float = 0.05, fold: float = 1.0) -> DataFrame:
    """Welch tests of all comparisons in one grouped job, shaped as results."""
    return shape_results(X.welch(counts, comparisons, groups), method, p, fold)


def best_first(name: str = "padj") -> list[Column]:
    return [F.asc_nulls_last(name), F.col("gene").asc()]


def top_significant(results: DataFrame, most: int = 50) -> DataFrame:
    """The ``most`` rows of least adjusted p of every comparison; ties by gene."""
    return X.top_by(results, "comparison", best_first(), most)


def top_directions(results: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` significant rows of least adjusted p in each direction of every comparison."""
    from pyspark.sql import Window as W

    some = results.where("significance <> 'Not Significant'")
    rank = F.row_number().over(W.partitionBy("comparison", "significance").orderBy(*best_first()))
    return some.withColumn("rank", rank).where(F.col("rank") <= most)


def summary(results: DataFrame) -> DataFrame:
    """Genes, significant ones, up and down, and the significant percentage, for every comparison."""
    up, down = (F.count_if(F.col("significance") == s) for s in ("Upregulated", "Downregulated"))
    total = F.count(F.lit(1))
    share = F.round(F.coalesce(F.try_divide((up + down) * 100.0, total), F.lit(0.0)), 2)
    return results.groupBy("comparison").agg(total.alias("total_genes"), (up + down).alias("significant"), up.alias("upregulated"), down.alias("downregulated"), share.alias("significant_pct"))


def summary_json(results: DataFrame, parameters: dict[str, float | str], most: int = 10) -> DataFrame:
    """``value``: one JSON object for every comparison with parameters, counts and the top genes of each direction."""
    gene = F.struct("gene", "log2_fold_change", "padj")
    ordered = F.array_sort(F.collect_list(F.struct("rank", gene.alias("g"))))
    lists = top_directions(results, most).groupBy("comparison", "significance").agg(ordered["g"].alias("genes"))
    wide = lists.groupBy("comparison").agg(*[F.first(F.when(F.col("significance") == s, F.col("genes")), ignorenulls=True).alias(f"top_{s.lower()}") for s in ("Upregulated", "Downregulated")])
    made = F.struct(*[F.lit(v).alias(k) for k, v in parameters.items()])
    all_of = F.struct("comparison", made.alias("parameters"), "total_genes", "significant", "upregulated", "downregulated", "significant_pct", "top_upregulated", "top_downregulated")
    return summary(results).join(wide, "comparison", "left").select("comparison", F.to_json(all_of).alias("value"))


def volcano(results: DataFrame, average: list[str]) -> DataFrame:
    """``x`` (fold change), ``y`` (-log10 of the adjusted p) and ``a`` (the first of ``average`` that is known) of finite rows."""
    rows = results.where(X.finite("log2_fold_change", "padj"))
    return rows.select("comparison", "gene", "significance", F.col("log2_fold_change").alias("x"), X.minus_log10(F.col("padj")).alias("y"), F.coalesce(*average).alias("a"))


def volcano_labels(results: DataFrame, most: int, named: str | None = None, genes: tuple[str, ...] = ()) -> DataFrame:
    """Genes to label: the ``most`` significant ones, and those that match ``named`` or are in ``genes``."""
    some = top_significant(results.where("significance <> 'Not Significant'"), most).select("comparison", "gene")
    also = F.col("gene").cast("string").isin(*genes) if genes else F.lit(False)
    if named is not None:
        also = also | F.col("gene").cast("string").rlike(named)
    return some.unionByName(results.where(also).select("comparison", "gene")).distinct()


def heatmap(results: DataFrame, counts: DataFrame, most: int = 50, log: bool = True, added: float = 1e-10) -> DataFrame:
    """z-scores of the top genes of every comparison in every sample; missing cells are left out."""
    top = top_significant(results, most).select("comparison", "gene")
    own = counts.join(top.select("gene").distinct(), "gene", "left_semi")
    values = own.withColumn("v", F.log2(F.col("n") + 1) if log else F.col("n").cast("double"))
    return X.z_scores(values, "v", added=added).select("gene", "sample", "z").join(top, "gene")
