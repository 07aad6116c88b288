"""Gene counts in long form (``gene``, ``sample``, ``n``): filters, normalisation, tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.functions.special import student_p


def merge_counts(counts: DataFrame, samples: list[str], key: str = "sample") -> DataFrame:
    """Wide matrix, one column per sample; a gene that a sample lacks is null, not 0."""
    return counts.groupBy("gene").pivot(key, samples).agg(F.sum("n"))


def cpm(counts: DataFrame) -> DataFrame:
    """Counts per million of the sample's total."""
    totals = counts.groupBy("sample").agg(F.sum("n").alias("library_size"))
    return counts.join(totals, "sample").select("gene", "sample", "n", F.try_divide(F.col("n") * 1e6, F.col("library_size")).alias("cpm"))


def log_cpm(counts: DataFrame, prior: float = 2.0) -> DataFrame:
    """Log2 counts per million with a prior count scaled by the library's size."""
    totals = counts.groupBy("sample").agg(F.sum("n").alias("size"))
    mean = totals.agg(F.avg("size")).scalar()
    sizes = totals.withColumn("p", F.try_divide(prior * F.col("size"), mean))
    value = F.log2(F.try_divide((F.col("n") + F.col("p")) * 1e6, F.col("size") + 2 * F.col("p")))
    return counts.join(sizes, "sample").select("gene", "sample", value.alias("log_cpm"))


def low_count_filter(counts: DataFrame, least_cpm: float, least_samples: int | Column) -> DataFrame:
    """Genes above ``least_cpm`` in at least ``least_samples`` samples, with the number of those."""
    return cpm(counts).groupBy("gene").agg(F.count_if(F.col("cpm") > least_cpm).alias("samples_above")).where(F.col("samples_above") >= least_samples)


def smallest_group(groups: DataFrame) -> Column:
    """Size of the smallest group, as a scalar for :func:`low_count_filter`."""
    return groups.groupBy("group").count().agg(F.min("count")).scalar()


def share_filter(values: DataFrame, column: str, least: float, samples: int | Column, share: float = 0.5, whole: bool = True) -> DataFrame:
    """Genes with ``column`` of at least ``least`` in a share of ``samples``, rounded up with ``whole``."""
    wanted = F.lit(share) * samples
    wanted = F.ceil(wanted) if whole else wanted
    return values.groupBy("gene").agg(F.count_if(F.col(column) >= least).alias("samples_above")).where(F.col("samples_above") >= wanted)


def sample_count(counts: DataFrame) -> Column:
    """Number of samples, as a scalar."""
    return counts.agg(F.count_distinct("sample")).scalar()


def size_factors(counts: DataFrame, samples: int | Column | None = None) -> DataFrame:
    """Median of ratios to the geometric mean, over genes positive in all ``samples`` (those of ``counts`` if not given)."""
    wanted = sample_count(counts) if samples is None else samples
    positive = counts.where("n > 0").groupBy("gene").agg(F.count(F.lit(1)).alias("k"), F.avg(F.log("n")).alias("log_mean")).where(F.col("k") == wanted)
    ratio = counts.join(positive, "gene").select("sample", (F.log("n") - F.col("log_mean")).alias("r"))
    return ratio.groupBy("sample").agg(F.exp(F.median("r")).alias("size_factor"))


def normalised_counts(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """``norm`` (counts over their sample's size factor), ``log2_norm`` (of ``norm + 1``) and ``log1p_norm``."""
    out = counts.join(factors, "sample").select("gene", "sample", "n", F.try_divide("n", "size_factor").alias("norm"))
    return out.select("*", F.log2(F.col("norm") + 1).alias("log2_norm"), F.log1p("norm").alias("log1p_norm"))


def library_sizes(counts: DataFrame, genes: int | Column | None = None) -> DataFrame:
    """``library_size`` and ``mean_expression`` over all genes of every sample."""
    wanted = counts.agg(F.count_distinct("gene")).scalar() if genes is None else genes
    return counts.groupBy("sample").agg(F.sum("n").alias("library_size")).withColumn("mean_expression", F.try_divide(F.col("library_size"), wanted))


def sum_by(values: DataFrame, *keys: str, value: str = "n") -> DataFrame:
    """Sum of ``value`` over rows with the same keys."""
    return values.groupBy(*keys).agg(F.sum(value).alias(value))


def bounded_sample(values: DataFrame, by: str, key: str, most: int = 3000, seed: int = 42) -> DataFrame:
    """At most ``most`` rows of every group, those of least hash, for plots of a distribution."""
    order = W.partitionBy(by).orderBy(F.xxhash64(key, F.lit(seed)), key)
    return values.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most).drop("_k")


def z_scores(values: DataFrame, column: str, sample_deviation: bool = False, added: float = 0.0) -> DataFrame:
    """Add ``z``, per gene, with the population or the sample deviation plus ``added``; what is not finite is 0."""
    w = W.partitionBy("gene")
    spread = (F.stddev_samp if sample_deviation else F.stddev_pop)(column).over(w) + added
    z = F.try_divide(F.col(column) - F.avg(column).over(w), spread)
    return values.withColumn("z", F.coalesce(number(z), F.lit(0.0)))


def variance_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Variance of every gene before and after normalisation (``gene``, ``sample``, ``v`` each)."""
    of = lambda x, name: x.groupBy("gene").agg(F.var_samp("v").alias(name))
    return of(before, "variance_before").join(of(after, "variance_after"), "gene")


def variance_test(change: DataFrame) -> DataFrame:
    """One row: Welch test between the variances before and after."""
    agg = change.agg(*[f(f"variance_{s}").alias(f"{k}_{s}") for s in ("before", "after") for k, f in (("mean", F.avg), ("var", F.var_samp), ("k", F.count))])
    a, b = F.col("var_before") / F.col("k_before"), F.col("var_after") / F.col("k_after")
    df = F.try_divide((a + b) * (a + b), a * a / (F.col("k_before") - 1) + b * b / (F.col("k_after") - 1))
    out = agg.select("mean_before", "mean_after", F.try_divide(F.col("mean_before") - F.col("mean_after"), F.sqrt(a + b)).alias("t_stat"), df.alias("df"))
    return out.withColumn("p", student_p(F.col("t_stat"), F.col("df")))


def _full(n: str, k: Column, size: Column) -> tuple[Column, Column]:
    """(mean, sample variance) of ``size`` values of which ``k`` are given and the others are 0."""
    mean = F.sum(n) / size
    spread = k * F.var_pop(n) + k * (F.avg(n) - mean) * (F.avg(n) - mean) + (size - k) * mean * mean
    return mean, F.when(size > 1, spread / (size - 1))


def group_stats(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``mean``, ``var`` and ``k`` (samples) of every gene in every group; cells that are missing are zeros.

    ``groups``: ``sample``, ``group``.  A gene without any read in a group has no row there.
    """
    sizes = groups.groupBy("group").agg(F.count_distinct("sample").alias("k"))
    # samples are few; cells stay where they are, by gene if they lie so
    rows = counts.join(F.broadcast(groups), "sample").join(F.broadcast(sizes), "group")
    mean, var = _full("n", F.count("n"), F.max("k"))
    return rows.groupBy("gene", "group").agg(mean.alias("mean"), var.alias("var"), F.max("k").alias("k"))


def welch(counts: DataFrame, comparisons: DataFrame, groups: DataFrame) -> DataFrame:
    """Welch statistic, degrees of freedom, p and log2 fold change of every gene in every comparison.

    ``comparisons``: ``comparison``, ``control``, ``treatment``; ``groups``:
    ``sample``, ``group``.  Missing cells are zeros.  t is positive where the control
    is higher; where both groups are constant t is 0 and p is 1; with one replicate
    in a group t, its degrees of freedom and p are null.  Each cell is read once
    however many comparisons there are: groups are summed up first, and a gene's
    groups meet in one map.
    """
    zero = F.struct(F.lit(0.0).alias("mean"), F.lit(0.0).alias("var"))
    per_gene = group_stats(counts, groups).groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("group", F.struct("mean", F.coalesce("var", F.lit(0.0)).alias("var"))))).alias("m"))
    sizes = groups.groupBy("group").agg(F.count_distinct("sample").alias("k"))
    sided = comparisons.join(sizes.withColumnsRenamed({"group": "control", "k": "k_c"}), "control").join(sizes.withColumnsRenamed({"group": "treatment", "k": "k_t"}), "treatment")
    every = sided.agg(F.collect_list(F.struct("comparison", "control", "treatment", "k_c", "k_t"))).scalar()
    rows = per_gene.select("gene", "m", F.inline(every))
    of = lambda side: F.coalesce(F.col("m")[F.col(side)], zero)
    rows = rows.select("comparison", "gene", "k_c", "k_t", of("control").alias("c"), of("treatment").alias("t"))
    a, b = F.col("c.var") / F.col("k_c"), F.col("t.var") / F.col("k_t")
    constant = (F.col("c.var") == 0) & (F.col("t.var") == 0)
    enough = (F.col("k_c") > 1) & (F.col("k_t") > 1)
    t = F.when(enough, F.when(constant, F.lit(0.0)).otherwise(F.try_divide(F.col("c.mean") - F.col("t.mean"), F.sqrt(a + b))))
    df = F.when(enough, F.try_divide((a + b) * (a + b), a * a / F.nullif(F.col("k_c") - 1, F.lit(0)) + b * b / F.nullif(F.col("k_t") - 1, F.lit(0))))
    out = rows.select("comparison", "gene", F.col("c.mean").alias("mean_control"), F.col("t.mean").alias("mean_treatment"), log2_ratio(F.col("t.mean"), F.col("c.mean")).alias("log2_fold_change"), t.alias("t_stat"), df.alias("df"), (enough & constant).alias("same"))
    return out.withColumn("p", F.when(F.col("same"), F.lit(1.0)).otherwise(student_p(F.col("t_stat"), F.col("df")))).drop("same")


def log2_ratio(above: Column, below: Column) -> Column:
    """log2 of the ratio of two means, one added to each."""
    return F.log2((above + 1) / (below + 1))


def minus_log10(p: Column) -> Column:
    """-log10 of p, finite where p is 0."""
    return -F.log10(p + 1e-300)


def number(x: Column) -> Column:
    """The value, or null where it is NaN."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def bonferroni(tests: DataFrame, by: str) -> DataFrame:
    """Add ``padj``: p times the number of all rows of the comparison, at most 1; null where p is null or NaN."""
    sizes = tests.groupBy(by).agg(F.count(F.lit(1)).alias("m"))
    p = number(F.col("p"))
    return tests.join(sizes, by).withColumn("padj", F.when(p.isNotNull(), F.least(F.lit(1.0), p * F.col("m")))).drop("m")


def benjamini_hochberg(tests: DataFrame, by: str) -> DataFrame:
    """Add ``padj``: the least, over p-values not below, of p times count over rank; null where p is null or NaN.

    Rows without a p-value stay and do not count.  Equal p-values share the highest
    of their ranks, so ranks are running sums over distinct values: a comparison's
    task sorts no more than its distinct p-values.
    """
    p = number(F.col("p"))
    distinct = tests.select(by, p.alias("_p")).where("_p is not null").groupBy(by, "_p").agg(F.count(F.lit(1)).alias("c"))
    up = W.partitionBy(by).orderBy("_p").rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy(by).orderBy(F.desc("_p")).rowsBetween(W.unboundedPreceding, 0)
    ranked = distinct.withColumn("rank", F.sum("c").over(up)).withColumn("m", F.sum("c").over(W.partitionBy(by)))
    adjusted = ranked.select(by, "_p", F.least(F.lit(1.0), F.min(F.col("_p") * F.col("m") / F.col("rank")).over(down)).alias("padj"))
    return tests.withColumn("_p", p).join(adjusted, [by, "_p"], "left").drop("_p")


def storey(tests: DataFrame, by: str, cut: float = 0.5) -> DataFrame:
    """Add ``qvalue``: Benjamini-Hochberg values times the estimated share of true null hypotheses.

    The share is the number of p-values above ``cut`` over the number expected there
    if all were null, at most 1.
    """
    p = number(F.col("p"))
    above = F.count_if(p > cut) / (F.count(p) * (1 - cut))
    share = tests.groupBy(by).agg(F.least(F.lit(1.0), F.coalesce(above, F.lit(1.0))).alias("pi0"))
    return benjamini_hochberg(tests, by).join(share, by).withColumn("qvalue", F.col("padj") * F.col("pi0")).drop("padj", "pi0")


def significance(padj: Column, lfc: Column, p: float = 0.05, fold: float = 1.0) -> Column:
    """Direction of a significant change; NaN and null are not significant."""
    good = F.coalesce(F.nanvl(padj, F.lit(None)), F.lit(1.0)) < p
    return F.when(good & (lfc > fold), "Upregulated").when(good & (lfc < -fold), "Downregulated").otherwise("Not Significant")


def all_pairs(groups: DataFrame) -> DataFrame:
    """Every unordered pair of distinct groups as a comparison, the earlier in order as control.

    Levels are few; they meet as one sorted list, not in a join.
    """
    levels = groups.where("group is not null").agg(F.array_sort(F.collect_set("group")).alias("g"))
    pairs = levels.select("g", F.posexplode("g").alias("i", "control")).select("control", F.explode(F.slice("g", F.col("i") + 2, F.size("g"))).alias("treatment"))
    return pairs.select(F.concat_ws("_vs_", "treatment", "control").alias("comparison"), "control", "treatment")


def pairs_by_appearance(metadata: DataFrame, columns: list[str], order: str) -> DataFrame:
    """All pairs of levels of every group column with two levels or more: ``group_column``, ``control``, ``treatment``.

    A level that appears first, by ``order``, is the control.
    """
    long = metadata.select(order, F.inline(F.array(*[F.struct(F.lit(c).alias("group_column"), F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias("level")) for c in columns])))
    levels = long.where("level is not null").groupBy("group_column", "level").agg(F.min(order).alias("at"))
    lists = levels.groupBy("group_column").agg(F.array_sort(F.collect_list(F.struct("at", "level"))).alias("g")).where("size(g) > 1")
    pairs = lists.select("group_column", "g", F.posexplode("g.level").alias("i", "control"))
    return pairs.select("group_column", "control", F.explode(F.slice("g.level", F.col("i") + 2, F.size("g"))).alias("treatment"))


def prevalence_filter(values: DataFrame, samples: int, least: float) -> DataFrame:
    """Genes that are not 0 in at least a share of all samples; missing cells count as 0."""
    return values.groupBy("gene").agg((F.count_if(F.col("n") != 0) / F.lit(samples)).alias("prevalence")).where(F.col("prevalence") >= least)


def variance_filter(values: DataFrame, above: float, samples: int | Column) -> DataFrame:
    """Genes whose population variance over all ``samples`` exceeds a threshold; missing cells are zeros."""
    k = F.count("n")
    mean = F.sum("n") / samples
    spread = k * F.var_pop("n") + k * (F.avg("n") - mean) * (F.avg("n") - mean) + (samples - k) * mean * mean
    return values.groupBy("gene").agg((spread / samples).alias("variance")).where(F.col("variance") > above)


def finite(*columns: str) -> Column:
    """Whether all columns are finite numbers."""
    ok = F.lit(True)
    for c in columns:
        x = number(F.col(c))
        ok = ok & x.isNotNull() & (F.abs(x) != float("inf"))
    return ok


def varying(values: DataFrame, column: str = "v") -> DataFrame:
    """Rows of genes whose values are all finite and not constant."""
    good = values.groupBy("gene").agg(F.every(finite(column)).alias("ok"), F.var_samp(column).alias("var")).where("ok and var > 0").select("gene")
    return values.join(good, "gene", "left_semi")


def numeric_or_zero(table: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and all numeric ones, null there as 0."""
    numeric = [f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keep]
    return table.select(*keep, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in numeric])


def coverage_summary(counts: DataFrame, lengths: DataFrame, read_length: int) -> DataFrame:
    """Mean and exact median of count x read length / gene length, per sample."""
    c = counts.join(lengths, "gene").select("sample", F.try_divide(F.col("n") * read_length, F.col("length")).alias("coverage"))
    return c.groupBy("sample").agg(F.avg("coverage").alias("mean_coverage"), F.median("coverage").alias("median_coverage"), F.count(F.lit(1)).alias("genes"))


def relative_abundance(counts: DataFrame, top: int, host: str | None = None) -> DataFrame:
    """Share of each of the overall ``top`` genes in its sample's total, both without ``host``; a total of 0 counts as 1."""
    own = counts if host is None else counts.where(F.col("gene") != host)
    best = own.groupBy("gene").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "gene").limit(top).select("gene")
    totals = own.groupBy("sample").agg(F.sum("n").alias("all"))
    cells = own.join(best, "gene").groupBy("gene", "sample").agg(F.sum("n").alias("n"))
    whole = F.when(F.col("all") == 0, F.lit(1)).otherwise(F.col("all"))
    return cells.join(totals, "sample").select("gene", "sample", (F.col("n") / whole).alias("share"))


def top_by(table: DataFrame, by: str, order: list[Column | str], most: int) -> DataFrame:
    """The first ``most`` rows of every group in the order given."""
    return table.withColumn("_k", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("_k") <= most).drop("_k")


def one_of_each(table: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key, the first in the order given."""
    return table.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")
