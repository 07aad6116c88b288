"""Queries on mergeable summaries.  Documents' letters are reads, brands genes, suppliers samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.operators import expression as X
from loamframe.operators import profiles as P
from loamframe.operators import reads as S
from loamframe.plans import read_queries as Q
from loamframe.plans import registry as R


def _staged(spark: SparkSession, d: str) -> DataFrame:
    """Reads as they are, and clipped at both ends."""
    rows = R._table(spark, d, "documents").select(F.coalesce("lang", F.lit("")).alias("lang"), "source", Q._letters("text").alias("seq")).withColumn("qual", F.translate("seq", "ACGTacgt", "5?IA+I5B"))
    clipped = rows.withColumns({c: S.clip(F.col(c), 6, 4) for c in ("seq", "qual")})
    return rows.withColumn("stage", F.lit("raw")).unionByName(clipped.withColumn("stage", F.lit("clipped")))


def stage_profile(spark: SparkSession, d: str) -> DataFrame:
    """Summaries of every source, merged by language; the parts that are exact."""
    by_source = P.read_summary(_staged(spark, d), "stage", "lang", "source")
    out = P.summary_table(P.merged_summary(by_source, "stage", "lang"), "stage", "lang")
    return out.select("stage", "lang", "reads", "letters", "shortest", "longest", *[F.round(c, 4).alias(c) for c in ("gc_pct", "unknown_pct", "mean_length", "mean_quality")])


def box_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Log values of a sample: fewer than the sketch holds, so its quartiles are exact."""
    values = R._counts(spark, d).select("sample", F.log2(F.col("n") + 1).alias("v"))
    out = P.box_statistics(P.box_summary(values, "sample"), "sample")
    return out.select("sample", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q1", "median", "q3", "max", "low_fence", "high_fence")])


def value_histogram(spark: SparkSession, d: str) -> DataFrame:
    values = R._table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("v"))
    return P.histogram(values, 2500.0, "l_returnflag")


def dataset_quality(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d)
    out = P.dataset_quality(counts, X.size_factors(counts), R._groups(spark, d))
    return out.select("sample", "group", "stage", "library_size", "genes_found", "genes_missing", *[F.round(c, 3).alias(c) for c in ("mean", "min", "max")])


QUERIES = (stage_profile, box_statistics, value_histogram, dataset_quality)

_LETTERS = "regexp_replace(coalesce(text, ''), '[^ACGTacgt]', '', 'g')"

SQL = {
    "stage_profile": f"""
WITH r AS (SELECT coalesce(lang, '') AS lang, {_LETTERS} AS seq FROM documents),
s AS (SELECT 'raw' AS stage, * FROM r UNION ALL SELECT 'clipped', lang, substring(seq, 7, greatest(0, length(seq) - 10)) FROM r),
q AS (SELECT *, list_sum(list_transform(string_split(translate(seq, 'ACGTacgt', '5?IA+I5B'), ''), lambda c: CASE WHEN c = '' THEN 0 ELSE ascii(c) - 33 END)) AS q, length(regexp_replace(upper(seq), '[^GC]', '', 'g')) AS gc FROM s)
SELECT stage, lang, count(*) AS reads, sum(length(seq))::BIGINT AS letters, min(length(seq))::INT AS shortest, max(length(seq))::INT AS longest, round(100 * sum(gc) / sum(length(seq)), 4) AS gc_pct, 0.0::DOUBLE AS unknown_pct,
  round(avg(length(seq)), 4) AS mean_length, round(sum(q) / sum(length(seq)), 4) AS mean_quality FROM q GROUP BY 1, 2""",
    "box_statistics": f"""
{R._COUNTS}, v AS (SELECT sample, log2(n + 1) AS v FROM counts),
b AS (SELECT sample, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS median, quantile_disc(v, 0.75) AS q3, max(v) AS max FROM v GROUP BY 1)
SELECT sample, n, round(mean, 4) AS mean, round(std, 4) AS std, round(min, 4) AS min, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(max, 4) AS max,
  round(greatest(min, q1 - 1.5 * (q3 - q1)), 4) AS low_fence, round(least(max, q3 + 1.5 * (q3 - q1)), 4) AS high_fence FROM b""",
    "value_histogram": "SELECT l_returnflag, (floor(l_extendedprice / 2500) * 2500)::DOUBLE AS bin, count(*) AS values FROM lineitem GROUP BY 1, 2",
    "dataset_quality": f"""
{R._COUNTS}, {R._GROUPS}, p AS (SELECT gene, avg(ln(n)) AS m FROM counts WHERE n > 0 GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT sample) FROM counts)),
f AS (SELECT sample, exp(median(ln(n) - m)) AS f FROM counts JOIN p USING (gene) WHERE n > 0 GROUP BY sample),
t AS (SELECT sample, sum(n) AS library_size, count(*) FILTER (n > 0) AS genes_found FROM counts GROUP BY 1),
e AS (SELECT sample, 'raw' AS stage, log2(n + 1) AS v FROM counts JOIN f USING (sample) UNION ALL SELECT sample, 'normalised', log2(n / f + 1) FROM counts JOIN f USING (sample)),
b AS (SELECT sample, stage, avg(v) AS mean, min(v) AS min, max(v) AS max FROM e GROUP BY 1, 2)
SELECT g.sample, g.grp AS "group", s.stage, library_size, genes_found, (SELECT count(DISTINCT gene) FROM counts) - coalesce(genes_found, 0) AS genes_missing, round(mean, 3) AS mean, round(min, 3) AS min, round(max, 3) AS max
FROM groups g CROSS JOIN (SELECT unnest(['raw', 'normalised']) AS stage) s LEFT JOIN t ON t.sample = g.sample LEFT JOIN b ON b.sample = g.sample AND b.stage = s.stage""",
}
