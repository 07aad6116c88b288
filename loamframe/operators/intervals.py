"""Reads on genes by overlapping intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bin_width(intervals: DataFrame, least: int = 64) -> int:
    """A width for bins: about what nine of ten intervals span, so that few are in more than two bins."""
    found = intervals.where("start <= end").agg(F.percentile_approx(F.col("end") - F.col("start") + 1, 0.9, 1000)).first()[0]
    return max(least, int(found or least))


def count_features(alignments: DataFrame, exons: DataFrame, width: int | None = None, stranded: bool = False) -> DataFrame:
    """Reads per ``gene`` that overlap exons of that gene alone.

    ``alignments``: ``read``, ``contig``, ``start``, ``end``; ``exons``: ``gene``,
    ``contig``, ``start``, ``end``; ends are inclusive.  With ``stranded`` both have a
    ``strand`` that must agree.  Both sides are spread over bins and meet by equality
    of contig and bin; without ``width`` it follows the exons.  Where an overlap is
    in several bins only the first counts it.
    """
    width = width or bin_width(exons)
    on = ["contig", "bin", *["strand"] * stranded]
    bins = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))).alias("bin")
    strand = ["strand"] * stranded
    a = alignments.where("start <= end").select("read", "contig", *strand, "start", "end", bins)
    e = exons.where("start <= end").select("gene", "contig", *strand, F.col("start").alias("first"), F.col("end").alias("last"), bins)
    met = a.join(e, on).where("start <= last AND first <= end").where(F.col("bin") == F.floor(F.greatest("start", "first") / width))
    genes = met.groupBy("read").agg(F.min("gene").alias("gene"), F.max("gene").alias("other"))
    return genes.where("gene = other").groupBy("gene").agg(F.count(F.lit(1)).alias("n"))


# ---- spliced alignments ------------------------------------------------------------------


def blocks(start: Column, cigar: Column) -> Column:
    """Stretches of the reference (``start``, ``end``, inclusive) that a read's letters lie on.

    ``M``, ``=`` and ``X`` make up a block and go on one that ends right before them;
    ``N`` and ``D`` pass over the reference; other signs do not move on it.
    """
    steps = F.arrays_zip(
        F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)[MIDNSHP=X]"), 1), lambda x: x.cast("long")).alias("n"),
        F.regexp_extract_all(cigar, F.lit("[0-9]+([MIDNSHP=X])"), 1).alias("op"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(held: Column, x: Column) -> Column:
        on, past = x["op"].isin("M", "=", "X"), held["at"] + x["n"]
        last = F.try_element_at(held["blocks"], F.lit(-1))
        joined = last["end"] == held["at"] - 1
        before = F.when(joined, F.slice(held["blocks"], 1, F.size(held["blocks"]) - 1)).otherwise(held["blocks"])
        new = F.struct(F.when(joined, last["start"]).otherwise(held["at"]).alias("start"), (past - 1).alias("end"))
        moves = on | x["op"].isin("N", "D")
        return F.struct(F.when(moves, past).otherwise(held["at"]).alias("at"), F.when(on & (x["n"] > 0), F.concat(before, F.array(new))).otherwise(held["blocks"]).alias("blocks"))

    return F.aggregate(steps, F.struct(start.cast("long").alias("at"), none.alias("blocks")), step)["blocks"]


def merged_exons(exons: DataFrame, strand: bool = False) -> DataFrame:
    """The union of each gene's exons, as stretches that do not touch: letters in two exons of a gene are there once."""
    by = ["gene", "contig", *["strand"] * strand]
    order = W.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("start") > reach + 1)).cast("int")
    rows = exons.where("start <= end").withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(order))
    return rows.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def count_spliced(alignments: DataFrame, exons: DataFrame, least: int = 1, width: int | None = None, stranded: bool = False) -> DataFrame:
    """Reads per ``gene`` whose blocks share ``least`` letters or more with the exons of that gene alone.

    ``alignments``: ``read``, ``contig``, ``start``, ``cigar``; ``exons`` as in
    :func:`count_features`.  What a read passes over, an intron, counts for nothing.
    Rows with one ``read`` are parts or mates of it.  What blocks share with exons moves
    once, to its read; exons, far fewer than blocks, are hashed where the two meet.
    """
    strand = ["strand"] * stranded
    held = merged_exons(exons, stranded)
    width = width or bin_width(held)
    bins = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))).alias("bin")
    cut = alignments.select("read", "contig", *strand, F.inline(blocks(F.col("start"), F.col("cigar"))))
    a = cut.select("read", "contig", *strand, "start", "end", bins)
    e = held.select("gene", "contig", *strand, F.col("start").alias("first"), F.col("end").alias("last"), bins)
    met = a.join(e.hint("shuffle_hash"), ["contig", "bin", *strand]).where("start <= last AND first <= end").where(F.col("bin") == F.floor(F.greatest("start", "first") / width))
    letters = (F.least("end", "last") - F.greatest("start", "first") + 1).alias("letters")
    shared = met.select("read", "gene", letters).repartition("read").groupBy("read", "gene").agg(F.sum("letters").alias("letters")).where(F.col("letters") >= least)
    genes = shared.groupBy("read").agg(F.min("gene").alias("gene"), F.max("gene").alias("other"))
    return genes.where("gene = other").groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
