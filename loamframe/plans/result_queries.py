"""Queries on counts, tests and models.  Suppliers are samples, regions groups, brands or parts genes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.operators import diffexp as D
from loamframe.operators import enrichment as E
from loamframe.operators import expression as X
from loamframe.operators import learning as L
from loamframe.operators import models as M
from loamframe.plans import registry as R


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    return R._table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("sample")).agg(F.sum("l_quantity").alias("n"))


def _by_gene(spark: SparkSession, d: str) -> DataFrame:
    """:func:`_sparse` for what goes on by gene: rows move to their genes once, as few to a task as if each file part were dealt in eight.

    A cell has hardly more than one row, so adding up before they move only fills memory.
    """
    rows = R._table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("sample"), F.col("l_quantity").alias("n"))
    return rows.repartition(8 * rows.rdd.getNumPartitions(), "gene").groupBy("gene", "sample").agg(F.sum("n").alias("n"))


def _rounded(table: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    return table.withColumns({c: F.round(c, places) for c in columns})


_WELCH = ("mean_control", "mean_treatment", "log2_fold_change", "t_stat", "df")


def welch_sparse(spark: SparkSession, d: str) -> DataFrame:
    groups = R._groups(spark, d)
    return _rounded(X.welch(_by_gene(spark, d), X.all_pairs(groups), groups), *_WELCH).select("comparison", "gene", *_WELCH)


def welch_dge(spark: SparkSession, d: str) -> DataFrame:
    groups = R._groups(spark, d)
    return D.differential_expression(_by_gene(spark, d), X.all_pairs(groups), groups, "bh", 0.2, 0.1)


def group_means(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.group_stats(_by_gene(spark, d), R._groups(spark, d)), "mean", "var")


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Fold changes from quantities and p-values from keys, so that SQL knows both."""
    key = F.col("gene") * 7919 % 1000
    p = F.when(key % 41 == 0, F.lit(None)).when(key % 43 == 0, F.lit(float("nan"))).otherwise(key / 200000)
    return R._gene_totals(spark, d).select("comparison", "gene", ((F.col("n") - 250) / 100).alias("log2_fold_change"), p.alias("p"), (F.col("n") / 7).alias("mean"))


def dge_results(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(D.shape_results(_results(spark, d)), "log2_fold_change", "padj", places=6).select("comparison", "gene", "log2_fold_change", "padj", "significance", "gene_name")


def _shaped(spark: SparkSession, d: str) -> DataFrame:
    return D.shape_results(_results(spark, d))


def top_genes(spark: SparkSession, d: str) -> DataFrame:
    return D.top_significant(_shaped(spark, d), 50).select("comparison", "gene", F.round("padj", 6).alias("padj"))


def top_directions(spark: SparkSession, d: str) -> DataFrame:
    return D.top_directions(_shaped(spark, d), 10).select("comparison", "significance", "rank", "gene")


def dge_summary(spark: SparkSession, d: str) -> DataFrame:
    return D.summary(_shaped(spark, d))


def volcano_table(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(D.volcano(_shaped(spark, d), ["mean"]), "x", "y", "a")


def volcano_labels(spark: SparkSession, d: str) -> DataFrame:
    return D.volcano_labels(_shaped(spark, d), 20, "^1.9$", ("7",))


def heatmap(spark: SparkSession, d: str) -> DataFrame:
    tests = _shaped(spark, d).withColumn("gene", F.col("gene"))
    return _rounded(D.heatmap(tests, _sparse(spark, d), 5, added=0.0), "z")


def bh_adjust_nulls(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("p_size") % 7 == 0, F.lit(None)).when(F.col("p_size") % 11 == 0, F.lit(float("nan"))).otherwise(F.floor(F.col("p_retailprice") / 50) / 50)
    tests = R._table(spark, d, "part").select("p_partkey", F.col("p_type").alias("comparison"), p.alias("p"))
    return _rounded(X.benjamini_hochberg(tests, "comparison").join(X.bonferroni(tests, "comparison").select("p_partkey", F.col("padj").alias("bonferroni")), "p_partkey"), "padj", "bonferroni").select("p_partkey", "comparison", "padj", "bonferroni")


def storey_qvalues(spark: SparkSession, d: str) -> DataFrame:
    tests = R._table(spark, d, "part").select("p_partkey", F.col("p_type").alias("comparison"), (F.col("p_retailprice") / 2500).alias("p"))
    return X.storey(tests, "comparison").select("p_partkey", F.round("qvalue", 4).alias("qvalue"))


def normalised_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d)
    return _rounded(X.normalised_counts(counts, X.size_factors(counts)), "norm", "log2_norm", "log1p_norm")


def tmm_factors(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.tmm_factors(_sparse(spark, d)), "factor", places=6)


def count_filters(spark: SparkSession, d: str) -> DataFrame:
    """Genes that pass the filter on counts per million and, as ``by_count``, also the one on counts."""
    counts = _sparse(spark, d)
    n = X.sample_count(counts)
    by_cpm = X.share_filter(X.cpm(counts), "cpm", 1.0, n, 0.25).withColumnRenamed("samples_above", "by_cpm")
    by_count = X.share_filter(counts, "n", 10.0, n, 0.25).withColumnRenamed("samples_above", "by_count")
    return by_cpm.join(by_count, "gene", "left")


def library_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(X.library_sizes(_sparse(spark, d)), "mean_expression")


def variance_change(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d)
    return _rounded(X.variance_change(counts.select("gene", "sample", F.col("n").alias("v")), X.log_cpm(counts).select("gene", "sample", F.col("log_cpm").alias("v"))), "variance_before", "variance_after")


def distribution_sample(spark: SparkSession, d: str) -> DataFrame:
    return X.bounded_sample(_sparse(spark, d), "sample", "gene", 300)


def largest_change(spark: SparkSession, d: str) -> DataFrame:
    """One row a gene: the comparison with the largest change."""
    return X.one_of_each(_results(spark, d), ["gene"], [F.desc(F.abs("log2_fold_change")), "comparison"]).select("gene", "comparison", F.round("log2_fold_change", 4).alias("log2_fold_change"))


def pca_gram(spark: SparkSession, d: str) -> DataFrame:
    values = _by_gene(spark, d).select("gene", "sample", F.log2(F.col("n") + 1).alias("v"))
    samples = X.sample_count(R._table(spark, d, "lineitem").select(F.col("l_suppkey").alias("sample")))
    return M.sample_gram(values, samples, places=3)


def pca_scores(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d).withColumn("v", F.log2(F.col("n") + 1))
    return M.component_scores(counts, X.sample_count(counts), scale=True)


def _design(spark: SparkSession, d: str, counts: DataFrame) -> M.Design:
    """A design over the samples that have counts."""
    return M.design(R._groups(spark, d).join(counts.select("sample").distinct(), "sample", "left_semi"), "group", "ASIA")


def linear_model_coef(spark: SparkSession, d: str) -> DataFrame:
    counts = _sparse(spark, d)
    values = counts.select("gene", "sample", F.col("n").alias("v"))
    return _rounded(M.linear_coefficients(values, _design(spark, d, counts)), "beta", "mean", "s2").select("gene", "coef", "beta", "mean", "s2", "df")


def dge_linear(spark: SparkSession, d: str) -> DataFrame:
    counts = _sparse(spark, d)
    made = _design(spark, d, counts)
    return M.moderated(M.voom_coefficients(counts, made), made)


def dge_negative_binomial(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d)
    return M.negative_binomial(counts, _design(spark, d, counts), X.size_factors(counts))


def dge_quasi_likelihood(spark: SparkSession, d: str) -> DataFrame:
    counts = R._counts(spark, d)
    return M.negative_binomial(counts, _design(spark, d, counts), X.size_factors(counts), quasi=True)


def batch_adjusted(spark: SparkSession, d: str) -> DataFrame:
    values = X.log_cpm(R._counts(spark, d)).select("gene", "sample", F.col("log_cpm").alias("v"))
    return M.adjust_batches(values, R._table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample"), (F.col("s_nationkey") % 5).alias("batch")))


def enrichment_tests(spark: SparkSession, d: str) -> DataFrame:
    return E.over_representation(R._gene_totals(spark, d).withColumn("hit", F.col("n") > 250), R._sets(spark, d), padj=None, qvalue=None)


def enrichment_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of both directions of every comparison."""
    return E.overlap_counts(E.directions(_shaped(spark, d)), R._sets(spark, d))


def permuted_enrichment(spark: SparkSession, d: str) -> DataFrame:
    return E.permuted_enrichment(R._gene_totals(spark, d).withColumn("stat", F.col("n") - 200), R._sets(spark, d), 20, 2, 500)


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    values = L.features(R._counts(spark, d), R._table(spark, d, "supplier").count(), 0.1, 0.001, scale=True)
    return _rounded(values, "v", "zero").select("gene", "sample", "v", "zero")


def binary_labels(spark: SparkSession, d: str) -> DataFrame:
    return L.binary_labels(R._groups(spark, d), "group", "EUROPE", "ASIA")


def forest_cv(spark: SparkSession, d: str) -> DataFrame:
    """Mean importance of embedding components for telling two labels apart."""
    rows = R._table(spark, d, "embeddings").where("label < 2").select(F.col("vec_id").alias("sample"), "label", F.posexplode("embedding").alias("at", "x"))
    values = rows.select(F.col("at").cast("long").alias("gene"), "sample", F.col("x").cast("double").alias("v"), F.lit(0.0).alias("zero"))
    labels = L.folds(R._table(spark, d, "embeddings").where("label < 2").select(F.col("vec_id").alias("sample"), "label"), 3)
    table, names = L.feature_vectors(values, labels)
    return L.mean_importance(L.forest_cross_validation(table, names, 3, 20, 4)[2])


QUERIES = (
    welch_sparse, welch_dge, group_means, dge_results, top_genes, top_directions, dge_summary, volcano_table, volcano_labels, heatmap, bh_adjust_nulls, storey_qvalues,
    normalised_counts, tmm_factors, count_filters, library_sizes, variance_change, distribution_sample, largest_change, pca_gram, pca_scores, linear_model_coef, dge_linear,
    dge_negative_binomial, dge_quasi_likelihood, batch_adjusted, enrichment_tests, enrichment_counts, permuted_enrichment, feature_table, binary_labels, forest_cv,
)

_RESULTS = """
WITH tests AS (SELECT l_returnflag AS comparison, l_partkey AS gene, (sum(l_quantity) - 250) / 100 AS lfc, sum(l_quantity) / 7 AS mean,
  CASE WHEN l_partkey * 7919 % 1000 % 41 = 0 OR l_partkey * 7919 % 1000 % 43 = 0 THEN NULL ELSE (l_partkey * 7919 % 1000) / 200000 END AS p FROM lineitem GROUP BY 1, 2),
results AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(1.0, p * count(*) OVER (PARTITION BY comparison)) END AS padj FROM tests),
shaped AS (SELECT *, CASE WHEN padj < 0.05 AND lfc > 1 THEN 'Upregulated' WHEN padj < 0.05 AND lfc < -1 THEN 'Downregulated' ELSE 'Not Significant' END AS significance FROM results)"""

SQL = {
    "welch_sparse": R._welch(R._SPARSE),
    "group_means": f"""{R._SPARSE}, {R._GROUPS}, size AS (SELECT grp, count(*) AS k FROM groups GROUP BY 1)
SELECT gene, grp AS "group", round(sum(n) / max(k), 4) AS mean, CASE WHEN max(k) > 1 THEN round((count(n) * var_pop(n) + count(n) * (avg(n) - sum(n) / max(k)) ** 2 + (max(k) - count(n)) * (sum(n) / max(k)) ** 2) / (max(k) - 1), 4) END AS var, max(k) AS k
FROM counts JOIN groups USING (sample) JOIN size USING (grp) GROUP BY 1, 2""",
    "dge_results": f"{_RESULTS} SELECT comparison, gene, round(lfc, 6) AS log2_fold_change, round(padj, 6)::DOUBLE AS padj, significance, gene::VARCHAR AS gene_name FROM shaped",
    "top_genes": f"{_RESULTS} SELECT comparison, gene, round(padj, 6)::DOUBLE AS padj FROM shaped QUALIFY row_number() OVER (PARTITION BY comparison ORDER BY padj NULLS LAST, gene) <= 50",
    "top_directions": f"{_RESULTS} SELECT comparison, significance, (row_number() OVER w)::INT AS rank, gene FROM shaped WHERE significance <> 'Not Significant' WINDOW w AS (PARTITION BY comparison, significance ORDER BY padj NULLS LAST, gene) QUALIFY rank <= 10",
    "dge_summary": f"""{_RESULTS} SELECT comparison, count(*) AS total_genes, count(*) FILTER (significance <> 'Not Significant') AS significant, count(*) FILTER (significance = 'Upregulated') AS upregulated,
count(*) FILTER (significance = 'Downregulated') AS downregulated, round(count(*) FILTER (significance <> 'Not Significant') * 100.0 / count(*), 2)::DOUBLE AS significant_pct FROM shaped GROUP BY 1""",
    "volcano_table": f"{_RESULTS} SELECT comparison, gene, significance, round(lfc, 4) AS x, round(-log10(padj + 1e-300), 4) AS y, round(mean, 4) AS a FROM shaped WHERE padj IS NOT NULL",
    "volcano_labels": f"""{_RESULTS}, best AS (SELECT comparison, gene FROM shaped WHERE significance <> 'Not Significant' QUALIFY row_number() OVER (PARTITION BY comparison ORDER BY padj NULLS LAST, gene) <= 20)
SELECT * FROM best UNION SELECT comparison, gene FROM shaped WHERE regexp_matches(gene::VARCHAR, '^1.9$') OR gene = 7""",
    "heatmap": f"""{_RESULTS}, best AS (SELECT comparison, gene FROM shaped QUALIFY row_number() OVER (PARTITION BY comparison ORDER BY padj NULLS LAST, gene) <= 5),
c AS (SELECT l_partkey AS gene, l_suppkey AS sample, log2(sum(l_quantity) + 1) AS v FROM lineitem WHERE l_partkey IN (SELECT gene FROM best) GROUP BY 1, 2),
z AS (SELECT gene, sample, round(coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0), 4) AS z FROM c WINDOW w AS (PARTITION BY gene))
SELECT gene, sample, z, comparison FROM z JOIN best USING (gene)""",
    "bh_adjust_nulls": """
WITH t AS (SELECT p_partkey, p_type AS comparison, CASE WHEN p_size % 7 = 0 OR p_size % 11 = 0 THEN NULL ELSE floor(p_retailprice / 50) / 50 END AS p FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY comparison ORDER BY p, p_partkey) AS k, count(*) OVER (PARTITION BY comparison) AS m FROM t WHERE p IS NOT NULL),
a AS (SELECT p_partkey, least(1, min(p * m / k) OVER (PARTITION BY comparison ORDER BY k DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM r)
SELECT p_partkey, comparison, round(padj, 4)::DOUBLE AS padj, CASE WHEN p IS NOT NULL THEN round(least(1, p * count(*) OVER (PARTITION BY comparison)), 4) END::DOUBLE AS bonferroni FROM t LEFT JOIN a USING (p_partkey)""",
    "storey_qvalues": """
WITH r AS (SELECT p_partkey, p_type AS comparison, p_retailprice / 2500 AS p, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) AS k, count(*) OVER (PARTITION BY p_type) AS m FROM part),
s AS (SELECT comparison, least(1.0, count(*) FILTER (p > 0.5) / (count(*) * 0.5)) AS pi0 FROM r GROUP BY 1),
a AS (SELECT p_partkey, comparison, least(1, min(p * m / k) OVER (PARTITION BY comparison ORDER BY k DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM r)
SELECT p_partkey, round(padj * pi0, 4)::DOUBLE AS qvalue FROM a JOIN s USING (comparison)""",
    "normalised_counts": f"""
{R._COUNTS}, p AS (SELECT gene, avg(ln(n)) AS m FROM counts WHERE n > 0 GROUP BY gene HAVING count(*) = (SELECT count(DISTINCT sample) FROM counts)),
f AS (SELECT sample, exp(median(ln(n) - m)) AS f FROM counts JOIN p USING (gene) GROUP BY sample)
SELECT gene, sample, n, round(n / f, 4) AS norm, round(log2(n / f + 1), 4) AS log2_norm, round(ln(n / f + 1), 4) AS log1p_norm FROM counts JOIN f USING (sample)""",
    "tmm_factors": f"""
{R._SPARSE}, t AS (SELECT sample, sum(n) AS size, count(*) FILTER (n > 0) AS held FROM counts GROUP BY 1), g AS (SELECT count(DISTINCT gene) AS genes FROM counts WHERE n > 0),
x AS (SELECT sample, n / size AS x FROM counts JOIN t USING (sample) WHERE n > 0 UNION ALL SELECT sample, 0.0 FROM t, g, LATERAL (SELECT unnest(range(genes - held)))),
q AS (SELECT sample, quantile_cont(x, 0.75) AS q FROM x GROUP BY 1), ref AS (SELECT sample FROM q ORDER BY abs(q - (SELECT avg(q) FROM q)), sample LIMIT 1),
r AS (SELECT gene, n AS r, size AS rs FROM counts JOIN ref USING (sample) JOIN t USING (sample) WHERE n > 0),
m AS (SELECT sample, round(log2(n / size) - log2(r / rs), 9) AS m, round((log2(n / size) + log2(r / rs)) / 2, 9) AS a, (size - n) / size / n + (rs - r) / rs / r AS v FROM counts JOIN t USING (sample) JOIN r USING (gene) WHERE n > 0),
k AS (SELECT *, count(*) OVER (PARTITION BY sample) AS k, rank() OVER (PARTITION BY sample ORDER BY m) + (count(*) OVER (PARTITION BY sample, m) - 1) / 2 AS rm, rank() OVER (PARTITION BY sample ORDER BY a) + (count(*) OVER (PARTITION BY sample, a) - 1) / 2 AS ra FROM m),
w AS (SELECT *, CASE WHEN rm BETWEEN floor(k * 0.3) + 1 AND k - floor(k * 0.3) AND ra BETWEEN floor(k * 0.05) + 1 AND k - floor(k * 0.05) AND v > 0 THEN 1 / v END AS w FROM k),
f AS (SELECT sample, coalesce(l, 0) AS l FROM t LEFT JOIN (SELECT sample, CASE WHEN max(abs(m)) < 1e-6 THEN 0 ELSE sum(w * m) / sum(w) END AS l FROM w GROUP BY 1) USING (sample))
SELECT sample, round(2 ** (l - avg(l) OVER ()), 6) AS factor FROM f""",
    "count_filters": f"""
{R._SPARSE}, s AS (SELECT count(DISTINCT sample) AS s FROM counts), c AS (SELECT gene, n, n * 1e6 / sum(n) OVER (PARTITION BY sample) AS cpm FROM counts),
k AS (SELECT gene, count(*) FILTER (cpm >= 1) AS a, count(*) FILTER (n >= 10) AS b FROM c GROUP BY 1)
SELECT gene, a AS by_cpm, CASE WHEN b >= ceil(0.25 * s) THEN b END AS by_count FROM k, s WHERE a >= ceil(0.25 * s)""",
    "library_sizes": f"{R._SPARSE} SELECT sample, sum(n) AS library_size, round(sum(n) / (SELECT count(DISTINCT gene) FROM counts), 4) AS mean_expression FROM counts GROUP BY 1",
    "variance_change": f"""
{R._COUNTS}, t AS (SELECT sample, sum(n) AS size FROM counts GROUP BY 1), p AS (SELECT sample, size, 2 * size / (SELECT avg(size) FROM t) AS p FROM t)
SELECT gene, round(var_samp(n), 4) AS variance_before, round(var_samp(log2((n + p) * 1e6 / (size + 2 * p))), 4) AS variance_after FROM counts JOIN p USING (sample) GROUP BY 1""",
    "largest_change": f"{_RESULTS} SELECT gene, comparison, round(lfc, 4) AS log2_fold_change FROM tests QUALIFY row_number() OVER (PARTITION BY gene ORDER BY abs(lfc) DESC, comparison) = 1",
    "pca_gram": f"""
{R._SPARSE}, s AS (SELECT count(DISTINCT sample) AS s FROM counts), v AS (SELECT gene, sample, log2(n + 1) AS v FROM counts),
f AS (SELECT g.gene, sample, coalesce(v, 0) AS v FROM (SELECT DISTINCT gene FROM v) g CROSS JOIN (SELECT DISTINCT sample FROM v) LEFT JOIN v USING (gene, sample)),
c AS (SELECT gene, sample, v - avg(v) OVER (PARTITION BY gene) AS v FROM f)
SELECT a.sample AS a, b.sample AS b, round(sum(a.v * b.v), 3) AS g FROM c a JOIN c b USING (gene) GROUP BY 1, 2""",
    "linear_model_coef": f"""
{R._SPARSE}, {R._GROUPS}, s AS (SELECT sample, grp FROM groups WHERE sample IN (SELECT sample FROM counts)),
f AS (SELECT gene, sample, grp, coalesce(n, 0) AS v FROM (SELECT DISTINCT gene FROM counts) CROSS JOIN s LEFT JOIN counts USING (gene, sample)),
m AS (SELECT gene, grp, avg(v) AS m, sum(v * v) - count(*) * avg(v) ** 2 AS ss FROM f GROUP BY 1, 2),
g AS (SELECT gene, avg(v) AS mean, (SELECT sum(ss) FROM m WHERE m.gene = f.gene) / (count(*) - count(DISTINCT grp)) AS s2, (count(*) - count(DISTINCT grp))::DOUBLE AS df FROM f GROUP BY gene)
SELECT m.gene, CASE WHEN m.grp = 'ASIA' THEN '(Intercept)' ELSE 'group' || m.grp END AS coef, round(m.m - CASE WHEN m.grp = 'ASIA' THEN 0 ELSE a.m END, 4) AS beta, round(mean, 4) AS mean, round(s2, 4) AS s2, df
FROM m JOIN m a ON a.gene = m.gene AND a.grp = 'ASIA' JOIN g ON g.gene = m.gene""",
    "enrichment_counts": f"""
{_RESULTS}, sets AS (SELECT p_type || ' ' || p_size AS term, p_partkey AS gene FROM part), t AS (SELECT comparison || ' ' || way AS comparison, gene, significance = way AS hit FROM shaped CROSS JOIN (VALUES ('Upregulated'), ('Downregulated')) w(way))
SELECT comparison, term, count(*) FILTER (hit) AS set_hits, count(*) AS set_size, any_value(hits) AS hits, any_value(universe) AS universe
FROM t JOIN sets USING (gene) JOIN (SELECT comparison, count(*) FILTER (hit) AS hits, count(*) AS universe FROM t GROUP BY 1) USING (comparison) GROUP BY 1, 2""",
    "feature_table": f"""
{R._COUNTS}, s AS (SELECT count(*) AS s FROM supplier), v AS (SELECT gene, sample, ln(n + 1) AS v FROM counts),
f AS (SELECT g.gene, s_suppkey AS sample, coalesce(v, 0) AS v FROM (SELECT DISTINCT gene FROM v) g CROSS JOIN supplier LEFT JOIN v ON v.gene = g.gene AND v.sample = s_suppkey),
t AS (SELECT gene, avg(v) AS m, stddev_pop(v) AS sd, count(*) FILTER (v <> 0) / count(*) AS held FROM f GROUP BY 1 HAVING held >= 0.1 AND var_pop(v) > 0.001)
SELECT gene, sample, round((v - m) / sd, 4) AS v, round(-m / sd, 4) AS zero FROM v JOIN t USING (gene)""",
    "binary_labels": f"WITH {R._GROUPS} SELECT sample, (grp = 'EUROPE')::INT AS label FROM groups WHERE grp IN ('EUROPE', 'ASIA')",
}
