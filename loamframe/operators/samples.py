"""Samples and their metadata: names, groups, controls, symbols, alignment of tables, progress of stages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.operators.expression import one_of_each

# ---- groups and flags --------------------------------------------------------------------


def blank_to_null(text: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def keep_groups(metadata: DataFrame, column: str, *groups: str) -> DataFrame:
    """Rows of the groups named; blank and missing groups are dropped."""
    return metadata.withColumn(column, blank_to_null(F.col(column))).where(F.col(column).isin(*groups))


def at_least(values: DataFrame, column: str, least: float) -> DataFrame:
    """Rows with at least so many reads."""
    return values.where(F.col(column) >= least)


def with_default(table: DataFrame, column: str, value: object) -> DataFrame:
    """The table with a column of one value where it has none of that name."""
    return table if column in table.columns else table.withColumn(column, F.lit(value))


def control_flags(metadata: DataFrame, column: str, name: str = "is_control") -> DataFrame:
    """Add a flag read off a column of booleans, numbers or text.

    Text is read as a logical word; if that fails for any row, all rows are flagged
    that hold one of the words neg, control, true, yes or a 1.
    """
    kind = metadata.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.BooleanType):
        parsed = c
    elif isinstance(kind, T.NumericType):
        parsed = c != 0
    else:
        parsed = F.when(c.isin("TRUE", "true", "T", "True"), True).when(c.isin("FALSE", "false", "F", "False"), False)
    unclear = metadata.agg(F.coalesce(F.bool_or(parsed.isNull()), F.lit(False))).scalar()
    words = F.coalesce(c.cast("string").rlike("(?i)neg|control|true|yes|1"), F.lit(False))
    return metadata.withColumn(name, F.when(unclear, words).otherwise(parsed))


def status_by_rules(rules: list[tuple[Column, str]], other: str | None = None) -> Column:
    """The value of the first rule that holds, else ``other``."""
    out = F.when(rules[0][0], rules[0][1])
    for condition, value in rules[1:]:
        out = out.when(condition, value)
    return out.otherwise(other)


def annotated(rows: DataFrame, lanes: list[str], excluded_type: str, outcome: str) -> DataFrame:
    """Annotation rows of the lanes named whose sample type is another one and whose outcome is known."""
    return rows.where(F.col("lane").isin(*lanes) & (F.col("sampleType") != excluded_type) & F.col(outcome).isNotNull())


def map_levels(level: Column, names: dict[str, str]) -> Column:
    """New names of levels; a level without one keeps its own."""
    return reduce(lambda out, kv: F.when(level == kv[0], F.lit(kv[1])).otherwise(out), names.items(), level)


def id_type(genes: DataFrame, order: str | Column, most: int = 100) -> DataFrame:
    """One row, ``id_type``, from the first ``most`` distinct ids (``gene``) in the table's ``order``.

    ENSEMBL if any begins like one of its genes, ENTREZID if all are digits, else SYMBOL.
    """
    ids = genes.select(F.col("gene").cast("string").alias("gene"), (F.col(order) if isinstance(order, str) else order).alias("_at"))
    first = ids.groupBy("gene").agg(F.min("_at").alias("_at")).orderBy("_at", "gene").limit(most)
    ensembl, numbers = F.bool_or(F.col("gene").rlike("^ENS[A-Z]*G")), F.bool_and(F.col("gene").rlike("^[0-9]+$"))
    return first.agg(F.when(ensembl, "ENSEMBL").when(numbers, "ENTREZID").otherwise("SYMBOL").alias("id_type"))


# ---- names and order ---------------------------------------------------------------------


def unique_names(table: DataFrame, column: str, order: list[Column | str], name: str | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """Names made unique: the second of a name gets ``.1``, the third ``.2`` and so on, in the order given."""
    k = F.row_number().over(W.partitionBy(*within, column).orderBy(*order)) - 1
    text = F.col(column).cast("string")
    return table.withColumn(name or column, F.when(k > 0, F.concat_ws(".", text, k.cast("string"))).otherwise(text))


def first_symbols(mapping: DataFrame) -> DataFrame:
    """``gene`` and its first symbol that is not blank, by ``position``."""
    known = mapping.withColumn("symbol", blank_to_null(F.col("symbol"))).where("symbol is not null")
    return known.groupBy("gene").agg(F.min_by("symbol", F.struct("position", "symbol")).alias("symbol"))


def named_genes(table: DataFrame, mapping: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Add ``gene_name``: the gene's symbol or else its id, made unique in order of ids."""
    named = table.join(first_symbols(mapping), "gene", "left").withColumn("gene_name", F.coalesce("symbol", F.col("gene").cast("string"))).drop("symbol")
    return unique_names(named, "gene_name", ["gene"], within=within)


def in_sample_order(samples: DataFrame, group: str = "group", control: str = "CTL", case: str = "CASES") -> DataFrame:
    """Add ``position``: controls first, then cases, then the others, each by name."""
    kind = F.when(F.col(group) == control, 0).when(F.col(group) == case, 1).otherwise(2)
    listed = samples.withColumn("_kind", kind).agg(F.array_sort(F.collect_list(F.struct("_kind", "sample")))["sample"]).scalar()
    return samples.withColumn("position", F.array_position(listed, F.col("sample")).cast("int"))


# ---- tables side by side -----------------------------------------------------------------


def _some(table: DataFrame, what: str) -> DataFrame:
    if table.isEmpty():
        raise ValueError(f"no sample is in both {what}")
    return table


def with_metadata(counts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Counts of the samples that metadata knows, with its columns; an error if there are none."""
    return _some(counts.join(metadata, "sample"), "counts and metadata")


def aligned(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both feature tables cut to the samples they share; an error if there are none."""
    shared = _some(left.select("sample").intersect(right.select("sample")), "feature tables")
    return tuple(t.join(shared, "sample", "left_semi") for t in (left, right))


def with_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of labelled samples with their label; an error if there are none."""
    return _some(features.join(labels.select("sample", "label"), "sample"), "features and labels")


def metadata_for(samples: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row of metadata, the first by all its columns, for every sample; nulls where there is none."""
    one = one_of_each(metadata, ["sample"], [c for c in metadata.columns if c != "sample"] or ["sample"])
    return samples.select("sample").distinct().join(one, "sample", "left")


def match_either_way(reports: DataFrame, sheet: DataFrame) -> DataFrame:
    """The first row of ``sheet`` (by ``position``) whose ``sample`` holds a report's name or is held by it.

    Both tables list samples; a report without a match keeps nulls.
    """
    theirs = sheet.withColumnRenamed("sample", "matched")
    held = F.contains(F.col("name"), F.col("matched")) | F.contains(F.col("matched"), F.col("name"))
    met = reports.join(theirs, held, "left")
    return one_of_each(met, ["name"], [F.asc_nulls_last("position")])


# ---- columns, progress, dataflow ---------------------------------------------------------


def column_statistics(table: DataFrame) -> DataFrame:
    """One row a column: count, distinct values, the most frequent and its count, and, of numbers, moments and quartiles.

    Values are counted first, so a column's task sees each distinct value once.
    """
    numeric = {f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType)}
    long = table.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"), (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("x")) for c in table.columns])))
    counted = long.where("value is not null").groupBy("column", "value", "x").agg(F.count(F.lit(1)).alias("c"))
    mean = F.sum(F.col("x") * F.col("c")) / F.sum(F.when(F.col("x").isNotNull(), F.col("c")))
    square = F.sum(F.col("x") * F.col("x") * F.col("c"))
    n = F.sum(F.when(F.col("x").isNotNull(), F.col("c")))
    spread = F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (square - n * mean * mean) / (n - 1))))
    quartiles = F.percentile("x", [0.25, 0.5, 0.75], F.col("c"))
    best = F.min_by("value", F.struct(-F.col("c"), F.col("value")))
    return counted.groupBy("column").agg(
        F.sum("c").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("top"), F.max("c").alias("freq"), mean.alias("mean"), spread.alias("std"), F.min("x").alias("min"), quartiles.alias("q"), F.max("x").alias("max")
    ).select("column", "count", "unique", "top", "freq", "mean", "std", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def progress(artifacts: DataFrame, samples: DataFrame, halved: tuple[str, ...] = ()) -> DataFrame:
    """:func:`progress_of` the artifacts of every ``stage``."""
    return progress_of(artifacts.groupBy("stage").agg(F.count(F.lit(1)).alias("artifacts")), samples, halved)


def progress_of(counted: DataFrame, samples: DataFrame, halved: tuple[str, ...] = ()) -> DataFrame:
    """``completed`` and ``processing`` samples of every stage that has ``artifacts``.

    Stages in ``halved`` have one artifact a mate.  What is not completed counts as
    processing, not below 0.
    """
    total = samples.agg(F.count(F.lit(1))).scalar()
    half = F.col("stage").isin(*halved) if halved else F.lit(False)
    completed = F.when(half, F.floor(F.col("artifacts") / 2)).otherwise(F.col("artifacts")).cast("long")
    return counted.withColumn("completed", completed).withColumn("processing", F.greatest(F.lit(0), total - F.col("completed")))


def trimming_summary(reports: DataFrame, sheet: DataFrame, outputs: DataFrame) -> DataFrame:
    """Trimming reports by sample and mate with megabytes read, kept and dropped.

    ``reports``: ``name``, ``mate`` and counts; ``sheet``: ``sample``, ``position``,
    ``mate``, ``input_mb``; ``outputs``: ``name``, ``mate``, ``kept_mb``.
    """
    key = F.concat_ws(" ", "name", "mate")
    theirs = sheet.withColumnRenamed("mate", "its_mate").withColumnRenamed("sample", "matched")
    held = (F.col("mate") == F.col("its_mate")) & (F.contains(F.col("name"), F.col("matched")) | F.contains(F.col("matched"), F.col("name")))
    met = one_of_each(reports.join(theirs, held, "left").withColumn("_key", key), ["_key"], [F.asc_nulls_last("position")]).drop("_key", "its_mate", "position")
    both = met.join(outputs, ["name", "mate"], "left")
    kept, given = F.coalesce("kept_mb", F.lit(0.0)), F.coalesce("input_mb", F.lit(0.0))
    return both.withColumns({"kept_mb": F.round(kept, 2), "reduced_mb": F.round(F.greatest(F.lit(0.0), given - kept), 2), "input_mb": F.round(given, 2)})


def rrna_share(logs: DataFrame) -> DataFrame:
    """Percentage of rRNA reads of every sample, 0 without reads."""
    return logs.withColumn("rrna_pct", F.round(F.coalesce(F.try_divide(F.col("rrna") * 100.0, F.col("total")), F.lit(0.0)), 2))


def mixed(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def gathered(table: DataFrame, key: str, value: str) -> DataFrame:
    """Values of every key as one sorted list; for keys with a bounded number of values."""
    return table.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("values"))


def with_suffix(table: DataFrame, column: str, suffix: str) -> DataFrame:
    """The table with ``suffix`` after every id."""
    return table.withColumn(column, F.concat(F.col(column).cast("string"), F.lit(suffix)))


def if_empty(table: DataFrame, default: DataFrame) -> DataFrame:
    """The table, or, if it has no row, another one; decided where the plan runs."""
    none = table.agg(F.count(F.lit(1)) == 0).scalar()
    return table.unionByName(default.where(none))


def in_both(a: DataFrame, b: DataFrame, key: str = "sample") -> DataFrame:
    """Distinct keys of both tables."""
    return a.select(key).intersect(b.select(key))


def only_in_first(a: DataFrame, b: DataFrame, key: str = "sample") -> DataFrame:
    """Rows of the first table whose key the second lacks."""
    return a.join(b.select(key), key, "left_anti")


def optional(table: DataFrame, *stages: tuple[bool, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The table through each stage whose switch is on."""
    return reduce(lambda t, s: t.transform(s[1]) if s[0] else t, stages, table)
