"""Taxon counts: roll-up along the tree, per-sample reports, decontamination, composition."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.functions.special import hypergeometric_p


def _cut(df: DataFrame) -> DataFrame:
    """``df`` through ``spark.checkpoint.dir``; only on one machine, where none is set, through a temporary folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint()


def taxonomy_paths(nodes: DataFrame, levels: int) -> DataFrame:
    """Add ``path`` (ids from the root down), ``lineage`` (their ids, ranks and names) and ``depth`` to ``nodes`` (``tax_id``, ``parent_id``, ``rank``, ``name``).

    The root has a null parent.  Pointers double: in each round every node takes over
    the way up that the node at the top of its own has found, so ``levels`` are
    climbed in log2(``levels``) joins.  Each plan would hold the one before twice, so
    rounds are cut by checkpoints; up to four levels, where there is little to save,
    nodes climb one level a join in one plan.  Nodes that do not reach the root within
    ``levels`` are left out, also those on a cycle.
    """
    deep = levels > 4
    own = F.struct(F.col("tax_id").alias("id"), "rank", "name")
    first = out = nodes.withColumn("lineage", F.array(own)).withColumn("_top", F.col("parent_id"))
    for _ in range((levels - 1).bit_length() if deep else levels - 1):
        above = (out if deep else first).select(F.col("tax_id").alias("_at"), F.col("lineage").alias("_above"), F.col("_top").alias("_next"))
        # nodes that have arrived look for themselves, in vain, so that they do not meet in one task
        up = out.join(above, (F.coalesce("_top", "tax_id") == F.col("_at")) & F.col("_top").isNotNull(), "left")
        # an id without a node ends the climb short of the root
        met = F.col("_at").isNotNull()
        out = up.select(*nodes.columns, F.when(met, F.concat("_above", "lineage")).otherwise(F.col("lineage")).alias("lineage"), F.when(met, F.col("_next")).otherwise(F.col("_top")).alias("_top"))
        out = _cut(out) if deep else out
    depth = F.size("lineage")
    return out.where(F.col("_top").isNull() & (depth <= levels)).select(*nodes.columns, "lineage", F.col("lineage.id").alias("path"), depth.alias("depth"))


def direct_counts(reads: DataFrame) -> DataFrame:
    """Reads per ``sample`` and ``tax_id``; unclassified reads have a null taxon."""
    return reads.groupBy("sample", "tax_id").agg(F.count(F.lit(1)).alias("direct_reads"))


def clade_counts(direct: DataFrame, paths: DataFrame) -> DataFrame:
    """Reads of each node with all its descendants, per sample."""
    lineage = direct.join(paths.select("tax_id", "path"), "tax_id")
    return lineage.select("sample", F.explode("path").alias("tax_id"), "direct_reads").groupBy("sample", "tax_id").agg(F.sum("direct_reads").alias("clade_reads"))


def percent(part: Column, total: Column) -> Column:
    """Share in percent; 0 where the total is 0 or missing."""
    return F.coalesce(F.try_divide(part * 100.0, total), F.lit(0.0))


def clade_report(direct: DataFrame, paths: DataFrame, root: int = 1) -> DataFrame:
    """Per-sample report: nodes with reads in their clade, and the unclassified row (``tax_id`` 0).

    Depth first, a clade is an interval: a sample's rows are put in that order with
    running sums, a node opens where the path before does not hold it and closes
    where the next does not, and its clade is the difference of the two sums.  So
    each node of a report is two rows, however many taxa lie below it and however
    deep.  A sample has at most a row a taxon there, whatever its reads.  Rows of
    ``direct`` that repeat add up.  Ids outside the tree get a row of their own
    below the root, whose clade they count in.
    """
    node = lambda i, rank, name: F.struct(i.cast("int").alias("id"), F.lit(rank).alias("rank"), name.alias("name"))
    none = F.array(node(F.lit(0), "unclassified", F.lit("unclassified")))
    other = F.array(node(F.lit(root), "root", F.lit("root")), node(F.col("tax_id"), "unknown", F.col("tax_id").cast("string")))
    held = direct.join(paths.select("tax_id", "lineage"), "tax_id", "left")
    lineage = F.coalesce("lineage", F.when(F.col("tax_id").isNull(), none).otherwise(other))
    # ids outside the tree come last, so that the root is opened, and named, by a node of the tree if there is one
    held = held.select("sample", "direct_reads", F.col("tax_id").isNull().cast("int").alias("base"), F.col("lineage").isNull().alias("outside"), lineage.alias("lineage")).withColumn("path", F.col("lineage.id"))
    order = W.partitionBy("sample").orderBy(F.col("path")[0], "outside", "path")
    common = lambda a: F.coalesce(F.size(F.array_intersect("path", a)), F.lit(0))
    rows = held.select(
        "base", "sample", "direct_reads", "lineage",
        common(F.coalesce(F.lag("path").over(order), F.array().cast("array<int>"))).alias("before"),
        common(F.coalesce(F.lead("path").over(order), F.array().cast("array<int>"))).alias("after"),
        F.sum("direct_reads").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("upto"),
        F.sum("direct_reads").over(order.rangeBetween(W.currentRow, W.currentRow)).alias("own"),
    )
    depth, zero = F.size("lineage"), F.lit(0).cast("long")
    opened = F.transform(
        F.slice("lineage", F.col("before") + 1, depth),
        lambda n, i: F.struct(n["id"].alias("id"), n["rank"].alias("rank"), n["name"].alias("name"), (F.col("before") + i + 1 - F.col("base")).alias("depth"), (F.col("direct_reads") - F.col("upto")).alias("clade"), F.when(F.col("before") + i + 1 == depth, F.col("own")).otherwise(zero).alias("own")),
    )
    closed = F.transform(
        F.slice("lineage", F.col("after") + 1, depth),
        lambda n: F.struct(n["id"].alias("id"), F.lit(None).cast("string").alias("rank"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("depth"), F.col("upto").alias("clade"), zero.alias("own")),
    )
    rolled = rows.select("sample", F.inline(F.concat(opened, closed))).groupBy("sample", F.col("id").alias("tax_id")).agg(
        F.max("rank").alias("rank"), F.max("name").alias("name"), F.max("depth").alias("depth"), F.sum("clade").alias("clade_reads"), F.sum("own").alias("direct_reads"),
    )
    total = F.sum("direct_reads").over(W.partitionBy("sample"))
    return rolled.withColumn("pct", F.round(percent(F.col("clade_reads"), total), 4))


def drop_contaminants(direct: DataFrame, contaminants: DataFrame) -> DataFrame:
    """Direct counts with those of contaminants set to zero; the rows stay.  Ids are compared as text."""
    flagged = contaminants.select(F.trim(F.col("tax_id").cast("string")).alias("_bad")).distinct()
    hit = direct.join(flagged, F.col("tax_id").cast("string") == F.col("_bad"), "left")
    return hit.select("sample", "tax_id", F.when(F.col("_bad").isNotNull(), F.lit(0)).otherwise(F.col("direct_reads")).alias("direct_reads"))


def composition(report: DataFrame, groups: dict[str, int], root: int) -> DataFrame:
    """Reads of chosen clades per sample, the rest of the root's clade, and the unclassified ones."""
    of = lambda t: F.coalesce(F.max(F.when(F.col("tax_id") == t, F.col("clade_reads"))), F.lit(0))
    wide = report.groupBy("sample").agg(*[of(t).alias(name) for name, t in groups.items()], of(root).alias("root_reads"), of(0).alias("unclassified"))
    rest = F.greatest(F.lit(0), F.col("root_reads") - reduce(Column.__add__, [F.col(n) for n in groups]))
    return wide.withColumn("other", rest).withColumn("total", F.col("root_reads") + F.col("unclassified")).where("total > 0").drop("root_reads")


def lowest_common_ancestor(a: Column, b: Column) -> Column:
    """Path shared by two root paths."""
    return F.array_intersect(a, b)


def fold(held: Column, path: Column) -> Column:
    """A read's path so far after one more hit."""
    meets = (F.size(path) == F.size(held)) & (path != held)
    return F.when(F.size(path) > F.size(held), path).when(meets, lowest_common_ancestor(held, path)).otherwise(held)


def classify_reads(hits: DataFrame) -> DataFrame:
    """Fold each read's hits in order (``read_id``, ``pos``, ``path``).

    A deeper hit replaces the one held, an equally deep other one meets it at
    their common ancestor, a shallower one is ignored.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pos", "path")))

    start = F.array().cast("array<int>")
    return hits.groupBy("read_id").agg(ordered.alias("hits"), F.count(F.lit(1)).alias("hit_count")).select("read_id", "hit_count", F.aggregate("hits", start, lambda held, hit: fold(held, hit["path"])).alias("path")).withColumn("tax_id", F.element_at("path", -1))


def merge_pairs(mates: DataFrame) -> DataFrame:
    """One row per read of ``mates`` (``sample``, ``read_id``, ``mate``, ``path``, ``length``).

    The mates' taxa meet at their lowest common ancestor and their lengths add
    up; an unclassified mate (null path) leaves the other's taxon.
    """
    path = lambda k: F.max(F.when(F.col("mate") == k, F.col("path")))
    both = mates.groupBy("sample", "read_id").agg(path(1).alias("a"), path(2).alias("b"), F.sum("length").alias("length"))
    met = F.coalesce(lowest_common_ancestor(F.col("a"), F.col("b")), F.col("a"), F.col("b"))
    return both.select("sample", "read_id", F.try_element_at(met, F.lit(-1)).alias("tax_id"), met.alias("path"), "length")


def prevalence_counts(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Per taxon, in how many control and other samples it is present and absent.

    ``counts`` has one row per ``tax_id`` and ``sample``.
    """
    totals = samples.agg(F.struct(F.count_if("is_control").alias("controls"), F.count_if(~F.col("is_control")).alias("others"))).scalar()
    seen = counts.where("n > 0").join(samples, "sample")
    present = seen.groupBy("tax_id").agg(F.count_if("is_control").alias("control_present"), F.count_if(~F.col("is_control")).alias("other_present"))
    out = present.withColumn("_t", totals)
    return out.select("tax_id", "control_present", (F.col("_t.controls") - F.col("control_present")).alias("control_absent"), "other_present", (F.col("_t.others") - F.col("other_present")).alias("other_absent"))


def contaminants(prevalence: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Add ``p`` and ``contaminant`` to :func:`prevalence_counts`.

    p is the chance that a taxon as common lies in control samples as often as seen
    (one-sided exact test on the 2x2 table); below ``threshold`` it is flagged.
    """
    present = F.col("control_present") + F.col("other_present")
    controls = F.col("control_present") + F.col("control_absent")
    total = present + F.col("control_absent") + F.col("other_absent")
    out = prevalence.withColumn("p", hypergeometric_p(F.col("control_present"), controls, present, total))
    return out.withColumn("contaminant", F.col("p") < threshold)


def with_confidence(votes: DataFrame, paths: DataFrame, least: float) -> DataFrame:
    """Taxon of every read whose clade has at least a share ``least`` of its k-mers, walking up from the one it was given.

    ``votes``: ``read_id``, ``tax_id`` (null: no hit), ``kmers``, ``called``.  A read
    without such a node has a null ``tax_id``.
    """
    own = paths.select("tax_id", F.col("path").alias("own"))
    called = paths.select(F.col("tax_id").alias("called"), F.col("path").alias("up"))
    rows = votes.join(own, "tax_id", "left").join(called, "called", "left")
    per_read = rows.groupBy("read_id").agg(F.max("up").alias("up"), F.sum("kmers").alias("total"), F.collect_list(F.struct("own", "kmers")).alias("v"))
    support = lambda node: F.aggregate("v", F.lit(0).cast("long"), lambda acc, x: acc + F.when(F.array_contains(x["own"], node), x["kmers"]).otherwise(0))
    good = F.filter("up", lambda node: support(node) >= least * F.col("total"))
    return per_read.select("read_id", F.try_element_at(good, F.lit(-1)).alias("tax_id"))


def reestimate(report: DataFrame, paths: DataFrame, shares: DataFrame, least: int = 10) -> DataFrame:
    """Reads at a rank with those above it handed down: ``sample``, ``tax_id``, ``assigned``, ``added``, ``estimate``, ``fraction``.

    ``report``: ``sample``, ``tax_id``, ``direct_reads``, ``clade_reads``.  ``shares``:
    ``tax_id`` (a node at the rank), ``ancestor`` and ``share``, the expected part
    of a node's k-mers that only identify the ancestor.  Nodes at the rank with fewer
    than ``least`` reads in their clade are dropped first.
    """
    at_rank = shares.select("tax_id").distinct()
    assigned = report.join(at_rank, "tax_id", "left_semi").where(F.col("clade_reads") >= least).select("sample", "tax_id", F.col("clade_reads").alias("assigned"))
    above = report.select("sample", F.col("tax_id").alias("ancestor"), F.col("direct_reads").alias("held"))
    wanted = assigned.join(shares, "tax_id").join(above, ["sample", "ancestor"]).where("tax_id <> ancestor")
    weight = F.col("assigned") * F.col("share")
    part = F.try_divide(weight, F.sum(weight).over(W.partitionBy("sample", "ancestor")))
    added = wanted.withColumn("part", part).groupBy("sample", "tax_id").agg(F.sum(F.col("held") * F.col("part")).alias("added"))
    out = assigned.join(added, ["sample", "tax_id"], "left").withColumn("added", F.coalesce("added", F.lit(0.0)))
    out = out.withColumn("estimate", F.col("assigned") + F.col("added"))
    return out.withColumn("fraction", F.try_divide("estimate", F.sum("estimate").over(W.partitionBy("sample"))))
