"""Text forms of taxonomy tables, ready for ``write.text``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.operators.diffexp import summary, summary_json, top_significant
from loamframe.operators.expression import normalised_counts
from loamframe.operators.learning import mean_importance, metrics_summary, top_importances
from loamframe.operators.reads import classification_lines
from loamframe.operators.reports import report_lines


def lineage_lines(direct: DataFrame, paths: DataFrame) -> DataFrame:
    """``sample`` and ``value``: direct reads and the names from the root down, tab-separated.

    Taxa without reads give no line; every node on the way is named.
    """
    names = paths.select(F.col("tax_id").alias("step"), "name")
    steps = paths.select("tax_id", F.posexplode("path").alias("pos", "step")).join(names, "step")
    lineage = steps.groupBy("tax_id").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("l"))
    line = F.concat_ws("\t", F.col("direct_reads").cast("string"), F.array_join("l.name", "\t", ""))
    return direct.where("direct_reads > 0").join(lineage, "tax_id").select("sample", line.alias("value"))


def write_table(table: DataFrame, path: str, sep: str = "\t") -> None:
    """A table as text with a header; nulls are empty."""
    table.write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").csv(path)


def write_lines(lines: DataFrame, path: str, order: str | None = None) -> None:
    """``value`` of every row as a line, in a folder for each ``sample`` where there is one and sorted within it by ``order``.

    A large sample is dealt to several tasks and so has several files; with an
    ``order`` their names follow it.
    """
    if "sample" not in lines.columns:
        lines.select("value").write.mode("overwrite").text(path)
        return
    # both leave the number of tasks to Spark, which puts small samples together
    dealt = lines.hint("rebalance", "sample") if order is None else lines.repartitionByRange("sample", order).sortWithinPartitions("sample", order)
    dealt.select("sample", "value").write.mode("overwrite").partitionBy("sample").text(path)


def tool_matrix(counts: DataFrame, tool: str, samples: list[str]) -> DataFrame:
    """Wide matrix of one tool's counts (``tool``, ``sample``, ``gene``, ``n``); a gene that a sample lacks is null."""
    return counts.where(F.col("tool") == tool).groupBy("gene").pivot("sample", samples).agg(F.sum("n"))


def combined_matrix(counts: DataFrame, tools: list[str], samples: list[str]) -> DataFrame:
    """Wide matrix of all tools, columns ending in ``_<tool>``; with one tool plain sample names."""
    if len(tools) == 1:
        return tool_matrix(counts, tools[0], samples)
    keyed = counts.where(F.col("tool").isin(*tools)).withColumn("column", F.concat_ws("_", "sample", "tool"))
    return keyed.groupBy("gene").pivot("column", [f"{s}_{t}" for t in tools for s in samples]).agg(F.sum("n"))


def write_results(results: DataFrame, path: str, most: int = 50) -> None:
    """Results of all comparisons, and the best of each, as two tables with headers."""
    write_table(results, f"{path}/results", ",")
    write_table(top_significant(results, most), f"{path}/top{most}", ",")


def write_summary(results: DataFrame, path: str, parameters: dict[str, float | str]) -> None:
    """A JSON object for every comparison, and one table over all."""
    summary_json(results, parameters).select("value").write.mode("overwrite").text(f"{path}/summary")
    write_table(summary(results), f"{path}/comparisons", ",")


def write_normalised(counts: DataFrame, factors: DataFrame, path: str, samples: list[str]) -> None:
    """Wide normalised counts and their log1p."""
    rows = normalised_counts(counts, factors)
    for column, name in (("norm", "normalised"), ("log1p_norm", "log1p")):
        write_table(rows.groupBy("gene").pivot("sample", samples).agg(F.first(column)), f"{path}/{name}", ",")


def write_report(report: DataFrame, path: str, places: int = 2) -> None:
    """Report text of every sample, in order of lines."""
    write_lines(report_lines(report, places), path, "line_no")


def write_classification(called: DataFrame, path: str) -> None:
    """A line for every read, in a folder for each sample."""
    write_lines(classification_lines(called), path)


def write_enrichment(terms: DataFrame, path: str) -> None:
    """Enriched terms in a folder for each ontology and direction."""
    terms.write.mode("overwrite").partitionBy("ontology", "direction").option("header", True).csv(path)


def write_contaminants(flagged: DataFrame, path: str) -> None:
    """Flagged taxa, one a line."""
    flagged.where("contaminant").select(F.col("tax_id").cast("string").alias("value")).write.mode("overwrite").text(path)


def write_forest(metrics: DataFrame, importances: DataFrame, predictions: DataFrame, path: str, most: int = 100) -> None:
    """Metrics of folds, summary, importances, the best of them and a text report."""
    mean = mean_importance(importances)
    write_table(metrics, f"{path}/cv_folds_metrics", ",")
    write_table(mean.orderBy(F.desc("importance"), "gene"), f"{path}/feature_importances", ",")
    write_table(top_importances(mean, most), f"{path}/top{most}_feature_importances", ",")
    cells = predictions.agg(*[F.count_if((F.col("label") == i) & (F.col("prediction") == j)).alias(f"true{i}_predicted{j}") for i in (0, 1) for j in (0, 1)])
    both = metrics_summary(metrics).withColumn("confusion", cells.select(F.struct(*cells.columns)).scalar())
    both.write.mode("overwrite").json(f"{path}/summary")
    text = F.format_string("Accuracy (mean, std): %.3f, %.3f\nROC-AUC (mean, std): %.3f, %.3f", "mean_accuracy", "std_accuracy", "mean_roc_auc", "std_roc_auc")
    both.select(text.alias("value")).write.mode("overwrite").text(f"{path}/report")
