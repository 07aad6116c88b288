"""Taxonomy reports in text order (``sample``, ``line_no``, ``depth``, ...): lineages, clades, composition, lines.

A report lists a tree in depth-first order, two blanks a level.  Everything that
needs the order works per sample on ``line_no``; a sample's report has a line per
taxon, so a sample fits a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.operators.taxonomy import percent

#: Code of a rank, and of ranks that begin with "sub" (fixed values).
RANK_CODES = {
    "superkingdom": "D", "domain": "D", "kingdom": "K", "phylum": "P", "class": "C", "order": "O", "family": "F", "genus": "G", "species": "S",
    "subspecies": "S1", "strain": "S2",
}
SUB_CODES = {"kingdom": "K1", "phylum": "P1", "class": "C1", "order": "O1", "family": "F1", "genus": "G1", "species": "S1"}


def rank_code(rank: Column, name: Column) -> Column:
    """Code of a rank; root and unclassified are told by name, unknown ranks are a hyphen."""
    out = F.when(name == "root", "R").when(name == "unclassified", "U")
    for r, code in RANK_CODES.items():
        out = out.when(rank == r, code)
    for r, code in SUB_CODES.items():
        out = out.when(rank.startswith("sub") & rank.contains(r), code)
    top = rank.isin("cellular root", "acellular root") | (name == "cellular organisms")
    return out.when(top, "R1").otherwise("-")


def report_lineage(report: DataFrame, levels: int = 40) -> DataFrame:
    """Add ``path``: ``line_no`` of every ancestor and of the line itself, from the top down.

    The parent of a line is the last line before it with a smaller depth.  For each
    level the last line seen there is carried along; of those, what lies above a line
    are the levels that rise in line number: a level that was skipped, or left behind
    by a shallower line, drops out.
    """
    seen = W.partitionBy("sample").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    last = F.array(*[F.last(F.when(F.col("depth") == k, F.col("line_no")), ignorenulls=True).over(seen) for k in range(levels)])
    above = F.filter(F.slice(last, 1, F.col("depth") + 1), lambda x: x.isNotNull())

    def rising(held: Column, x: Column) -> Column:
        return F.when((F.size(held) == 0) | (F.try_element_at(held, F.lit(-1)) < x), F.concat(held, F.array(x))).otherwise(held)

    return report.withColumn("path", F.aggregate(above, F.array().cast("array<int>"), lambda held, x: rising(held, x.cast("int"))))


def lineage_names(report: DataFrame, levels: int = 40) -> DataFrame:
    """``sample``, ``line_no``, ``tax_id``, ``direct_reads`` and ``lineage``, the names from the top down."""
    steps = report_lineage(report, levels).select("sample", "line_no", "tax_id", "direct_reads", F.posexplode("path").alias("at", "step"))
    names = report.select("sample", F.col("line_no").alias("step"), "name")
    ordered = F.array_sort(F.collect_list(F.struct("at", "name")))
    return steps.join(names, ["sample", "step"]).groupBy("sample", "line_no", "tax_id", "direct_reads").agg(ordered["name"].alias("lineage"))


def lineage_text(report: DataFrame, levels: int = 40) -> DataFrame:
    """``sample``, ``line_no`` and ``value``: direct reads and lineage, tab-separated, of lines with direct reads."""
    lines = lineage_names(report.where("tax_id <> '0'"), levels).where("direct_reads > 0")
    return lines.select("sample", "line_no", F.concat_ws("\t", F.col("direct_reads").cast("string"), F.array_join("lineage", "\t")).alias("value"))


def recompute_clades(report: DataFrame, levels: int = 40) -> DataFrame:
    """Clade reads and percentages from direct reads alone; a sample's total is the sum of its lines without a parent."""
    steps = report_lineage(report, levels).select("sample", F.explode("path").alias("line_no"), "direct_reads")
    clades = steps.groupBy("sample", "line_no").agg(F.sum("direct_reads").alias("clade_reads"))
    out = report.drop("clade_reads", "pct").join(clades, ["sample", "line_no"])
    total = F.sum("direct_reads").over(W.partitionBy("sample"))
    return out.withColumn("pct", F.round(percent(F.col("clade_reads"), total), 5))


def decontaminate(report: DataFrame, contaminants: DataFrame, levels: int = 40) -> DataFrame:
    """The report with direct reads of contaminants (``tax_id`` as text) set to zero and clades computed again."""
    bad = contaminants.select(F.trim(F.col("tax_id").cast("string")).alias("tax_id")).distinct().withColumn("_hit", F.lit(True))
    clean = report.join(bad, "tax_id", "left").withColumn("direct_reads", F.when(F.col("_hit"), F.lit(0)).otherwise(F.col("direct_reads")).cast("long")).drop("_hit")
    return recompute_clades(clean, levels)


def report_lines(report: DataFrame, places: int = 2) -> DataFrame:
    """``sample``, ``line_no``, ``value``: report text, the percentage six wide, lines without reads left out."""
    indent = F.expr("repeat('  ', depth)")
    # rounds the number as stored, to even where it is a tie, as C's printf does; format_string rounds its shortest decimals up
    pattern = "0." + "0" * places if places else "0"
    long = F.coalesce(F.expr(f"format_number(cast(pct AS double), '{pattern}')"), F.lit("null"))
    pct = F.lpad(long, 6, " ")
    line = F.concat_ws("\t", F.when(F.length(long) > 6, long).otherwise(pct), F.col("clade_reads").cast("string"), F.col("direct_reads").cast("string"), "rank_code", F.col("tax_id").cast("string"), F.concat(indent, "name"))
    return report.where("clade_reads > 0 or rank_code = 'U'").select("sample", "line_no", line.alias("value"))


def in_report_order(report: DataFrame, paths: DataFrame) -> DataFrame:
    """A report by tree (``tax_id``, ``rank``, ``name``) as lines: unclassified first, then depth first by path.

    Adds ``line_no``, ``rank_code`` and, from the root at 0, ``depth``.
    """
    rows = report.drop("depth").join(paths.select("tax_id", "path"), "tax_id", "left")
    place = F.when(F.col("tax_id") == 0, F.array(F.lit(-1))).otherwise(F.coalesce("path", F.array(F.lit(2**31 - 1), F.col("tax_id"))))
    rows = rows.withColumn("_place", place).withColumn("depth", F.greatest(F.lit(0), F.size("_place") - 1))
    line = (F.row_number().over(W.partitionBy("sample").orderBy("_place")) - 1).alias("line_no")
    return rows.select("sample", line, "pct", "clade_reads", "direct_reads", rank_code(F.col("rank"), F.col("name")).alias("rank_code"), F.col("tax_id").cast("string").alias("tax_id"), "name", "depth")


def domain_table(report: DataFrame) -> DataFrame:
    """Host, bacterial, viral, other classified and unclassified reads of every sample with reads, and percentages.

    Host is the last line with taxon 2759 or 9606; other lines count by their last
    line too; other classified is what is left of the root, not below 0.
    """
    last = lambda cond: F.coalesce(F.max_by(F.when(cond, F.col("clade_reads")), F.when(cond, F.col("line_no"))), F.lit(0))
    tax = F.col("tax_id")
    unclassified = F.coalesce(F.col("rank_code") == "U", F.lit(False))
    known = ~unclassified
    wide = report.groupBy("sample").agg(
        last(known & tax.isin("2759", "9606")).alias("host"), last(known & (tax == "2")).alias("bacterial"), last(known & (tax == "10239")).alias("viral"),
        last(known & (tax == "1")).alias("root"), last(unclassified).alias("unclassified"),
    )
    rest = F.greatest(F.lit(0), F.col("root") - F.col("bacterial") - F.col("viral") - F.col("host"))
    out = wide.withColumn("other", rest).withColumn("total", F.col("root") + F.col("unclassified")).where("total > 0")
    parts = ["host", "bacterial", "viral", "other", "unclassified"]
    return out.select("sample", *parts, "total", *[(F.col(c) / F.col("total") * 100).alias(f"{c}_pct") for c in parts])


def taxon_pivot(report: DataFrame, taxa: dict[str, str]) -> DataFrame:
    """Clade reads and percentage of chosen taxa (column name to id), by their first line; 0 where a taxon is missing."""
    first = lambda c, t: F.coalesce(F.min_by(F.when(F.col("tax_id") == t, F.col(c)), F.when(F.col("tax_id") == t, F.col("line_no"))), F.lit(0))
    return report.groupBy("sample").agg(*[x for name, t in taxa.items() for x in (first("clade_reads", t).alias(f"{name}_reads"), first("pct", t).cast("double").alias(f"{name}_pct"))])


def at_rank(report: DataFrame, code: str = "S", column: str = "rank_code") -> DataFrame:
    """Rows of one rank."""
    return report.where(F.trim(F.col(column)) == code)


def top_species(abundance: DataFrame, report: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` species of every sample by fraction: ``sample``, ``name``, ``fraction``, ``origin``.

    ``abundance`` has ``sample``, ``name``, ``fraction``; samples that it lacks fall
    back to the species lines of ``report``.
    """
    own = abundance.select("sample", "name", F.col("fraction").cast("double").alias("fraction"), F.lit("abundance").alias("origin"))
    rest = at_rank(report).join(own.select("sample").distinct(), "sample", "left_anti")
    rest = rest.select("sample", "name", (F.col("pct") / 100).cast("double").alias("fraction"), F.lit("report").alias("origin"))
    rank = F.row_number().over(W.partitionBy("sample").orderBy(F.desc("fraction"), "name"))
    return own.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= most)


def prefer_clean(reports: DataFrame, cleaned: DataFrame, keys: list[str]) -> DataFrame:
    """One ``report`` a key: the cleaned one where there is one."""
    return reports.withColumnRenamed("report", "_raw").join(cleaned.withColumnRenamed("report", "_clean"), keys, "full").select(*keys, F.coalesce("_clean", "_raw").alias("report"))


def taxon_matrix(report: DataFrame) -> DataFrame:
    """Direct reads of every taxon in every sample, 0 where a report lacks it: ``tax_id``, ``sample``, ``n``.

    Each taxon's samples are filled up from the list of all samples, which is short.
    """
    samples = report.agg(F.array_sort(F.collect_set("sample"))).scalar()
    cells = report.groupBy("tax_id", "sample").agg(F.sum("direct_reads").alias("direct_reads"))
    held = cells.groupBy("tax_id").agg(F.map_from_entries(F.collect_list(F.struct("sample", "direct_reads"))).alias("m"))
    return held.select("tax_id", "m", F.explode(samples).alias("sample")).select("tax_id", "sample", F.coalesce(F.col("m")[F.col("sample")], F.lit(0)).alias("n"))


def all_sources(**reports: DataFrame) -> DataFrame:
    """Reports of several sources (rRNA reads and unmapped reads, say) as one table with ``source``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [r.withColumn("source", F.lit(name)) for name, r in reports.items()])
